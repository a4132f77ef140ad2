"""Words of whole texts and their hashes, vectorised over the bytes of one text.

A word is a maximal run of bytes other than space and the controls 0x09 to
0x0D, which is also how ``bytes.split()`` cuts. Word and k-gram hashes are
polynomials modulo 2**64 over mixed values; they agree between machines and
runs, as nothing in them depends on Python's own salted hash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column | str) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """Hashes of words and of runs of words; keeps power tables, so make one per task."""

    def __init__(self):
        self._values = mix(np.arange(1001, 1257, dtype=np.uint64))
        self._space = np.zeros(256, bool)
        self._space[[9, 10, 11, 12, 13, 32]] = True
        self._values[self._space] = 0
        self._base = 0x9E3779B97F4A7C17
        self._inverse = pow(self._base, -1, 1 << 64)
        self._powers = self._inverses = np.ones(1, np.uint64)

    def _tables(self, n: int) -> None:
        if n > len(self._powers):
            size = 1 << max(12, n.bit_length())
            for name, base in (("_powers", self._base), ("_inverses", self._inverse)):
                table = np.ones(size, np.uint64)
                table[1:] = np.uint64(base)
                setattr(self, name, np.multiply.accumulate(table))

    def words(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, hashes) of the words in ``data``."""
        raw = np.frombuffer(data, np.uint8)
        space = np.ones(len(raw) + 2, bool)
        space[1:-1] = self._space[raw]
        edges = np.flatnonzero(space[1:] != space[:-1])
        starts, ends = edges[::2], edges[1::2]
        if not len(starts):
            return starts, ends, np.zeros(0, np.uint64)
        self._tables(len(raw))
        terms = self._values[raw]
        terms *= self._powers[: len(raw)]
        return starts, ends, mix(np.add.reduceat(terms, starts) * self._inverses[starts])

    def sums(self, hashes: np.ndarray) -> np.ndarray:
        """Running polynomial over word hashes, from which any run has its hash."""
        self._tables(len(hashes) + 1)
        out = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * self._powers[: len(hashes)], out=out[1:])
        return out

    def runs(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of the words from each start up to its end."""
        total = (sums[ends] - sums[starts]) * self._inverses[starts]
        return mix(total + (ends - starts).astype(np.uint64))

    def grams(self, sums: np.ndarray, k: int) -> np.ndarray:
        """Hash of each run of ``k`` consecutive words, as :meth:`runs` has it."""
        n = len(sums) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((sums[k:] - sums[:-k]) * self._inverses[:n] + np.uint64(k))

    def sequence(self, hashes: np.ndarray) -> tuple[int, int]:
        """128 bits of a sequence of word hashes, as two longs."""
        ends = [self.sums(h)[-1:] + np.uint64(len(hashes)) for h in (hashes, mix(hashes))]
        return tuple(int(mix(e).view(np.int64)[0]) for e in ends)

    def tag(self, hashes: np.ndarray) -> int:
        """32 bits of a sequence of word hashes, to tell apart texts of rows that share an id."""
        return int(np.int64(self.sequence(hashes)[0]).astype(np.int32))


def encoded(text: str | None) -> bytes:
    """UTF-8 bytes; b"" for null."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")
