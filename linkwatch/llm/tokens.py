"""Token ids of whole texts from a tokenizer file, fast on repetitive prose.

Byte-level BPE splits a text before every blank that a visible character
follows, so each stretch between such blanks has the same ids wherever it
stands.  Stretches are encoded once per worker by the ``tokenizers`` library
and looked up afterwards.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

# a blank that white space or the end of the text follows
_RUN = re.compile(r" (?=\s|\Z)")
_CUT = re.compile(r" (?=\S)")
CACHED_STRETCHES = 600_000
LONGEST_CACHED = 48
ROW = 512


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class StretchEncoder:
    """Encodes texts to little-endian id bytes.

    ``dtype`` is the narrowest unsigned integer that holds the vocabulary and
    ``reserved``.  At most ``cached`` stretches are remembered; then the memory
    starts anew, so a worker's memory is bounded whatever it reads.
    """

    def __init__(self, path: str, reserved: int = 0, cached: int = CACHED_STRETCHES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        size = max(self.tokenizer.get_vocab_size(with_added_tokens=True), reserved + 1)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.spelled = np.zeros(max(size, max(vocabulary.values()) + 1), np.int64)
        for token, number in vocabulary.items():
            self.spelled[number] = len(token)
        self.cached = cached
        self.first: dict[str, bytes] = {"": b""}
        self.later: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.dtype).tobytes() for x in found]

    def _ids_of_stretches(self, stretches: list[str]) -> list[bytes]:
        """Ids of stretches that each follow a blank, encoded many in a row.

        Tokens of this kind spell their bytes, so byte counts say where a
        stretch ends.
        """
        out: list[bytes] = []
        width = self.dtype.itemsize
        rows = [stretches[i : i + ROW] for i in range(0, len(stretches), ROW)]
        found = self.tokenizer.encode_batch_fast(
            [" " + " ".join(row) for row in rows], add_special_tokens=False
        )
        for row, encoding in zip(rows, found, strict=True):
            ids = np.array(encoding.ids, self.dtype)
            ends = np.cumsum(self.spelled[ids])
            wanted = np.cumsum([1 + (len(x) if x.isascii() else len(x.encode())) for x in row])
            last = np.searchsorted(ends, wanted)
            if not np.array_equal(ends[np.minimum(last, len(ends) - 1)], wanted):
                out += self._ids([" " + x for x in row])
                continue
            blob, at = ids.tobytes(), 0
            for end in ((last + 1) * width).tolist():
                out.append(blob[at:end])
                at = end
        return out

    def _learn(self, memory: dict[str, bytes], wanted: set[str], blank: str) -> dict[str, bytes]:
        """The stretches of this batch that are not remembered; short ones are from now on."""
        if len(memory) > self.cached:
            memory.clear()
            memory[""] = self._ids([blank])[0] if blank else b""
        new = [x for x in wanted if x not in memory]
        extra = {}
        found = self._ids_of_stretches(new) if blank else self._ids(new)
        for x, ids in zip(new, found, strict=True):
            (memory if len(x) <= LONGEST_CACHED else extra)[x] = ids
        return extra

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Id bytes of each text; a null text is an empty one."""
        split = [
            [""] if not t else _CUT.split(t) if _RUN.search(t) else t.split(" ") for t in texts
        ]
        long_first = self._learn(self.first, {x[0] for x in split}, "")
        wanted: set[str] = set()
        for x in split:
            wanted.update(x[1:])
        long_later = self._learn(self.later, wanted, " ")
        out = []
        for x in split:
            head = self.first.get(x[0])
            head = long_first[x[0]] if head is None else head
            if long_later:
                tail = [self.later.get(w) or long_later[w] for w in x[1:]]
            else:
                tail = map(self.later.__getitem__, x[1:])
            out.append(head + b"".join(tail))
        return out


@lru_cache(maxsize=4)
def encoder(path: str, reserved: int = 0) -> StretchEncoder:
    """One encoder per worker process and tokenizer file."""
    return StretchEncoder(path, reserved)
