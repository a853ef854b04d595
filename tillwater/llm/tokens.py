"""Token ids of a byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import re
import sys
from array import array

#: Beyond the Latin letters, Unicode versions of the two libraries might differ.
_BEYOND_LATIN = re.compile("[^\x00-ɏ]")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids as unsigned 32-bit numbers, equal to those of ``tokenizers`` for the text.

    Where the same vocabulary lies beside the file as ranks, ``tiktoken`` computes them, about
    four times faster; texts beyond Latin letters go to ``tokenizers`` itself.
    """

    _made: dict[str, "Encoder"] = {}

    @classmethod
    def shared(cls, path: str) -> "Encoder":
        """The encoder of this Python worker."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True  # their strings are ordinary text here
        self._ranked = None
        try:
            import public_tokenizers
            import tiktoken

            with open(path.removesuffix(".json") + ".tiktoken", "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self._ranked = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )
        except (ImportError, FileNotFoundError):
            pass  # then ``tokenizers`` encodes every text

    def ids(self, text: str) -> array:
        if self._ranked is not None and not _BEYOND_LATIN.search(text):
            return array("I", self._ranked.encode_ordinary(text))
        return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids)

    def little_endian(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit bytes."""
        found = self.ids(text)
        if sys.byteorder == "big":
            found.byteswap()
        return found.tobytes()
