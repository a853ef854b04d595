r"""Toxicity: a subsequence string kernel, Nyström landmarks and a linear support vector machine.

Units are lower-cased words without marks at their ends (long ones in overlapping pieces), with
a sign for the word's start, which with three letters makes the shortest unit; three or more single
letters in a row are one unit, with and without the first of them, so a spaced-out insult is one
too, also behind a word of one letter. The kernel of two units counts common subsequences of ``LENGTH`` characters,
each weighed by ``DECAY`` per character that it spans, so gaps and inserted characters cost
little. Sentences are sets of units: their kernel is the sum of unit kernels to the power
``POWER`` (a multi-instance kernel, in which near-equal units count most).

Landmarks are units that the labelled training sentences tell apart best. A sentence's features
are its kernels with the landmarks, whitened by the landmarks' own kernel matrix (Nyström), on
which a squared-hinge SVM is trained: all sentences of clean documents against, in each toxic
document, the sentence that scores highest, chosen anew each round, and against toxic sentences
with a character put into their telling units, so that what an insertion leaves of a kernel
suffices. A document's score is a logistic function of its best sentence.

Being linear, the model is one number per unit. Each Python worker keeps the numbers of units
it has met; the memo is bounded and changes no result.

The fit takes a bounded sample: per class the ``TRAIN_ROWS`` labelled rows of lowest id hash with
at most ``TRAIN_CHARS`` characters. Scoring reads every whole text.

Defined results: a NULL or empty text has no sentence and gets the score of one without any
landmark; NULL ids are scored and held out; of labels that disagree on an id the toxic one
counts, NULL labels none; of several texts of one labelled id the first in order is learnt from; repeated
rows are scored each; without labels of both classes every
score is 0; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LENGTH, DECAY, POWER = 4, 0.8, 1.5
LANDMARKS = 48
TRAIN_ROWS = 3_000
TRAIN_CHARS = 20_000
#: Longest unit; longer words are cut into pieces that overlap by half.
UNIT = 16
#: Self-kernels count at most as this unit's, so that long words are not shrunk to nothing.
_FULL = "^abcdef"
#: Kernels below this (after the power) count as none.
FLOOR = 0.17
RIDGE = 1e-4
#: Toxic sentences are learnt once more in so many forms, with one of these put into the units that give
#: them away, and weigh as much as the others together; clean sentences weigh so much more than toxic ones.
INSERTIONS, MARKS, CLEAN = 3, "-*x", 6.0
ROUNDS = 5
#: Sentence scores (margins at -1 and 1) above this say no more than this.
CLIP = 1.5
#: Share of toxic documents for which scores are calibrated, whatever the sample's share.
TOXIC_SHARE = 0.25
MEMO = 600_000
BATCH = 4_096
_SENTENCE = re.compile(r"[.!?]+\s|[\r\n]+|[.!?]+$")
_SPACED = re.compile(r"(?<!\S)(?:\S[ \t]+){2,}\S(?!\S)")
_ENDS = ".,;:!?\"'()[]{}<>#*$%&|-_~+=/\\`´’‘“”«»…"


def _closed_up(spaced: re.Match) -> str:
    """Single letters in a row as one word, and once more without the first: it may be a word of its own."""
    word = re.sub(r"[ \t]+", "", spaced[0])
    return f"{word} {word[1:]}"


def sentences(text: str) -> list[list[str]]:
    """The units of each sentence of ``text``."""
    joined = _SPACED.sub(_closed_up, text.lower())
    out = []
    for sentence in _SENTENCE.split(joined):
        found = []
        for word in sentence.split():
            word = word.strip(_ENDS)
            if len(word) < UNIT:
                if len(word) + 1 >= LENGTH:
                    found.append("^" + word)
            else:
                found.append("^" + word[: UNIT - 1])
                found += [word[at : at + UNIT] for at in range(UNIT // 2, len(word) - UNIT // 2, UNIT // 2)]
        if found:
            out.append(list(dict.fromkeys(found)))  # a set: repetition says nothing new
    return out


def _codes(units: list[str]) -> np.ndarray:
    width = max(map(len, units))
    return np.array([list(map(ord, u.ljust(width, "\0"))) for u in units], np.int32)


def _pair_kernel(a: np.ndarray, b: np.ndarray, length: int = LENGTH, decay: float = DECAY) -> np.ndarray:
    """Row by row: sum over common subsequences of ``length`` characters of decay ** (both spans)."""
    n, square, decay = len(a), np.float32(decay * decay), np.float32(decay)
    a, b = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    # ends[i][t]: weight of common subsequences of i characters, up to here in a and t in b
    ends = [np.ones((len(b) + 1, n), np.float32)]
    ends += [np.zeros((len(b) + 1, n), np.float32) for _ in range(length - 1)]
    total = np.zeros(n, np.float32)
    for s in range(len(a)):
        same = ((a[s] == b) & (b != 0)) * square
        total += (same * ends[length - 1][:-1]).sum(axis=0)
        for i in range(length - 2, -1, -1):  # longest first: each reads the state before this character
            ends[i + 1] *= decay
            run = np.zeros(n, np.float32)
            for t in range(len(b)):
                run *= decay
                run += same[t] * ends[i][t]
                ends[i + 1][t + 1] += run
    return total


def subsequence_kernel(units: list[str], others: list[str]) -> np.ndarray:
    """All kernels of ``units`` with ``others``; pairs that share too few characters have none."""
    out = np.zeros((len(units), len(others)), np.float32)
    if not units or not others:
        return out
    a, b = _codes(units), _codes(others)
    shared = np.zeros(out.shape, np.int16)
    for code in np.unique(b[(b != 0) & (b != ord("^"))]):
        shared += np.minimum((a == code).sum(axis=1)[:, None], (b == code).sum(axis=1)[None, :]).astype(np.int16)
    left, right = np.nonzero(shared >= LENGTH)
    for at in range(0, len(left), BATCH):
        rows, columns = left[at : at + BATCH], right[at : at + BATCH]
        out[rows, columns] = _pair_kernel(a[rows], b[columns])
    return out


def sizes_of(units: list[str]) -> np.ndarray:
    """Roots of the self-kernels, those of long units as a unit of seven characters has."""
    codes = _codes(units)
    own = np.concatenate([_pair_kernel(codes[at : at + BATCH], codes[at : at + BATCH]) for at in range(0, len(units), BATCH)])
    return np.minimum(np.sqrt(own), _SCALE)


_SCALE = float(np.sqrt(_pair_kernel(_codes([_FULL]), _codes([_FULL]))[0]))


def unit_features(units: list[str], landmarks: list[str], sizes: np.ndarray) -> np.ndarray:
    """Scaled kernels of units with landmarks to the power, without those below the floor."""
    out = np.zeros((len(units), len(landmarks)), np.float32)
    order = sorted(range(len(units)), key=lambda k: len(units[k]))
    for at in range(0, len(order), BATCH):
        rows = order[at : at + BATCH]
        some = [units[k] for k in rows]
        kernel = subsequence_kernel(some, landmarks)
        near = kernel.max(axis=1) >= FLOOR ** (1 / POWER) * _SCALE * sizes.min() * 0.2
        if near.any():
            kept = np.flatnonzero(near)
            own = sizes_of([some[k] for k in kept])
            out[np.array(rows)[kept]] = np.minimum(kernel[kept] / (own[:, None] * sizes), 1.5) ** POWER
    out[out < FLOOR] = 0
    return out


class Model:
    """Landmarks with their weights in a sentence's score, and the logistic function of the best one."""

    def __init__(self, landmarks: list[str], weights: np.ndarray, bias: float, slope: float, shift: float):
        self.landmarks, self.weights, self.bias, self.slope, self.shift = landmarks, weights, bias, slope, shift
        self.sizes = sizes_of(landmarks) if landmarks else np.zeros(0, np.float32)
        self.memo: dict[str, float] = {}

    def __getstate__(self):
        return {**self.__dict__, "memo": {}}

    def learn(self, units: set[str]) -> None:
        new = [u for u in units if u not in self.memo]
        if len(self.memo) + len(new) > MEMO:
            self.memo.clear()
            new = list(units)
        if new:
            values = unit_features(new, self.landmarks, self.sizes) @ self.weights
            self.memo.update(zip(new, values.tolist()))

    def best(self, split: list[list[str]]) -> float:
        """The highest sentence score, within the clip; that of no landmark at all, if there is no sentence."""
        known = self.memo
        return min(self.bias + max((sum(known[u] for u in found) for found in split), default=0.0), CLIP)

    def score(self, texts: list[str | None]) -> list[float]:
        if not self.landmarks:
            return [0.0] * len(texts)
        out, at = [], 0
        while at < len(texts):
            # whole texts, as many at a time as keep the set of units small
            splits, units = [], set()
            while at < len(texts) and len(units) < MEMO // 2:
                split = sentences(texts[at] or "")
                units.update(u for found in split for u in found)
                splits.append(split)
                at += 1
            self.learn(units)
            values = self.slope * np.array([self.best(split) for split in splits]) + self.shift
            out += (1 / (1 + np.exp(-np.clip(values, -50, 50)))).tolist()
        return out


def choose_landmarks(docs: list[list[list[str]]], toxic: np.ndarray, count: int) -> tuple[list[str], dict[str, float]]:
    """Units and word beginnings that tell the classes apart, no two nearly alike, and how well units do."""
    holders: dict[str, set[int]] = defaultdict(set)
    seen = Counter()
    for k, split in enumerate(docs):
        units = {u for found in split for u in found}
        seen.update(units if toxic[k] else ())
    wanted = {u for u, n in seen.items() if n >= 2}
    for k, split in enumerate(docs):
        for u in {u for found in split for u in found if u in wanted}:
            holders[u].add(k)
    n_toxic, n_clean = int(toxic.sum()), int((~toxic).sum())

    def contrast(at: set[int]) -> float:
        a = sum(map(toxic.__getitem__, at))
        p, q = (a + 0.5) / (n_toxic + 1), (len(at) - a + 0.5) / (n_clean + 1)
        return float((p - q) / np.sqrt(p * (1 - p) / n_toxic + q * (1 - q) / n_clean))

    rated = {u: contrast(at) for u, at in holders.items()}
    top = sorted(rated, key=lambda u: (-rated[u], u))[:300]
    stems = {u[:n] for u in top if u[0] == "^" for n in range(LENGTH + 2, min(len(u), 10))}
    for stem in stems - set(rated):
        at = set().union(*(holders[u] for u in top if u.startswith(stem)))
        rated[stem] = contrast(at)
    against = sorted(rated, key=lambda u: (rated[u], u))[: count // 6]  # units of clean documents
    chosen: list[str] = []
    for unit in [*sorted((u for u in rated if rated[u] > 3), key=lambda u: (-rated[u], u))[:600], *against]:
        limit = count if rated[unit] < 0 else count - len(against)
        if len(chosen) >= limit:
            continue
        if chosen:
            near = subsequence_kernel([unit], chosen)[0] / (sizes_of([unit]) * sizes)
            if near.max() > 0.85:
                continue
        chosen.append(unit)
        sizes = sizes_of(chosen)
    return chosen, rated


def squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weights (bias last) of a linear SVM, by Newton steps on the rows inside the margin."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    base = ridge * weight.sum() * np.eye(x.shape[1])
    base[-1, -1] *= 1e-3
    for _ in range(30):
        inside = y * (x @ w) < 1
        xi, wi = x[inside], weight[inside]
        new = np.linalg.solve(base + xi.T @ (xi * wi[:, None]), xi.T @ (wi * y[inside]))
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w


def _broken(unit: str) -> list[str]:
    """The unit with one character put in at each place after the first letter."""
    return [unit[:at] + mark + unit[at:] for at in range(2, len(unit)) for mark in MARKS]


def train(texts: list[str], toxic: np.ndarray, count: int = LANDMARKS) -> Model:
    docs = [sentences(t) for t in texts]
    landmarks, rated = choose_landmarks(docs, toxic, count) if toxic.any() and not toxic.all() else ([], {})
    if not landmarks:
        return Model([], np.zeros(0), 0.0, 0.0, 0.0)
    model = Model(landmarks, np.zeros(len(landmarks)), 0.0, 1.0, 0.0)
    units = sorted({u for split in docs for found in split for u in found})
    features = unit_features(units, landmarks, model.sizes)
    active = {u: features[k] for k, u in enumerate(units) if features[k].any()}
    gram = subsequence_kernel(landmarks, landmarks) / np.outer(model.sizes, model.sizes)
    gram = np.minimum(gram, 1.5) ** POWER
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T

    # toxic sentences once more, with a character put into the units that give them away
    broken = {u: _broken(u) for u in landmarks if rated.get(u, 0) > 0}
    new = sorted({v for u, found in broken.items() for v in found} - set(active))
    for unit, row in zip(new, unit_features(new, landmarks, model.sizes)):
        if row.any():
            active[unit] = row
    owner, rows, empty = [], [], 0
    for k, split in enumerate(docs):
        for found in split:
            near = [active[u] for u in found if u in active]
            if near:
                owner.append(k)
                rows.append(np.sum(near, axis=0))
            else:
                empty += not toxic[k]
    extra = []
    for k in np.flatnonzero(toxic):
        for found in docs[k]:
            hit = [u for u in found if u in broken]
            for at in range(INSERTIONS if hit else 0):
                near = [active[u] for u in found if u in active and u not in broken]
                near += [active[v] for u in hit if (v := broken[u][(k + at * 7) % len(broken[u])]) in active]
                if near:
                    extra.append(np.sum(near, axis=0))
    owner, raw = np.array(owner), np.array(rows)
    x = raw @ root
    clean = ~toxic[owner]
    inserted = np.array(extra).reshape(-1, len(landmarks)) @ root
    against = np.vstack([x[clean], np.zeros((1, x.shape[1]))])
    # clean sentences weigh CLEAN times as much together as toxic documents, those without landmarks little
    counts = np.concatenate([np.ones(clean.sum()), [min(empty, clean.sum()) + 1]])
    counts *= CLEAN * toxic.sum() / counts.sum()
    score = raw.sum(axis=1)
    for _ in range(ROUNDS):
        best: dict[int, int] = {}
        for at in np.flatnonzero(~clean):
            if owner[at] not in best or score[at] > score[best[owner[at]]]:
                best[owner[at]] = at
        found = x[sorted(best.values())]
        w = squared_hinge(
            np.vstack([found, inserted, against]),
            np.concatenate([np.ones(len(found) + len(inserted)), -np.ones(len(against))]),
            np.concatenate([np.ones(len(found)), np.full(len(inserted), len(found) / max(1, len(inserted))), counts]),
        )
        score = x @ w[:-1] + w[-1]
    model.weights, model.bias = root @ w[:-1], float(w[-1])
    top = np.full(len(docs), model.bias)
    np.maximum.at(top, owner, score)
    top = np.minimum(top, CLIP)
    model.slope, model.shift = _logistic(top, toxic.astype(float))
    return model


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of P(y | x), with a little ridge, by Newton steps; y = 1 weighs ``TOXIC_SHARE``."""
    z, w = np.stack([x, np.ones(len(x))], axis=1), np.zeros(2)
    c = np.where(y == 1, TOXIC_SHARE / y.mean(), (1 - TOXIC_SHARE) / (1 - y.mean()))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(
            z.T @ (z * (c * p * (1 - p))[:, None]) + 1e-3 * np.eye(2), z.T @ (c * (y - p)) - 1e-3 * w
        )
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 0.0)), float(w[1])


def held_out(doc_id: Column) -> Column:
    """Rows that the fit never sees."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    )
    short = docs.select("doc_id", "text").where(F.length("text") <= TRAIN_CHARS).where("doc_id IS NOT NULL")
    usable = known.join(short.select("doc_id"), "doc_id", "left_semi")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = usable.where("toxic").orderBy(*order).limit(train_rows).union(
        usable.where("NOT toxic").orderBy(*order).limit(train_rows)
    )
    picked = short.join(F.broadcast(chosen), "doc_id")  # at most 2 x train_rows ids
    sample = picked.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows = sample.orderBy("doc_id").toPandas()
    return train(rows["text"].tolist(), rows["toxic"].to_numpy(bool))


def _scored(batches: Iterator[pd.DataFrame], model: Model) -> Iterator[pd.DataFrame]:
    for batch in batches:
        scores = model.score(batch["text"].tolist())
        yield pd.DataFrame({"doc_id": batch["doc_id"], "score": scores})


def score(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, train_rows))
    kind = dict(docs.dtypes)["doc_id"]
    keyed = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    rated = keyed.mapInPandas(lambda batches: _scored(batches, model.value), "doc_id string, score double")
    return rated.withColumn("doc_id", F.col("doc_id").cast(kind)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
