"""The queries with SQL against it, the pipeline's stages, and the guard of the entry point."""

import subprocess
import sys
from pathlib import Path

import pytest

import corpus_pipeline
from check import compare
from tillwater.llm import packing, registry

ROOT = Path(__file__).resolve().parents[2]


@pytest.mark.parametrize("name", list(registry.SQL))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    outcome = compare(spark, duck, registry.QUERIES[name], registry.SQL[name], sf_dir)
    assert outcome.startswith("ok") and "types differ" not in outcome, outcome


def test_there_is_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))


def test_stages_in_turn(spark, odd_documents, documents, tmp_path):
    spark.createDataFrame([(8, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = odd_documents
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert docs.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    ids = {r.doc_id for r in docs.collect()}
    assert 8 in ids and 7 not in ids and 9 not in ids and not ids & {1, 2, 3, 4, 5}


def test_run_is_the_stages_in_turn(spark, odd_documents, tmp_path):
    odd_documents.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(8, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
    want = packing.pack(docs).count()
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == want


def test_the_entry_point_works_without_the_subpackage(tmp_path):
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith(('corpus_pipeline', 'tillwater.llm')):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "names = set(e.queries())\n"
        "assert not any(n.startswith('op') and n[2:3].isdigit() for n in names) and 'pipeline' not in names\n"
        "assert 'fact_sales_init' in names and set(e.oracle_sql()) <= names\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
