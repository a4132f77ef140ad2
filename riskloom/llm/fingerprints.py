"""Context-triggered piecewise hashing of texts.

A rolling hash of the last ``REACH`` bytes ends a chunk wherever its low bits
are zero, so boundaries depend on local content and move along with it. With L
low bits chunks are 2**L bytes long on average. A fingerprint ``L:one:two`` holds
the chunk hashes (two characters each) at the smallest L whose average gives at
most ``USUAL`` chunks for the text's length, and those at L + 1. Texts that repeat
themselves may have more; from ``MOST`` chunks on, L rises. Boundaries at L + 1 are
among those at L.

Two fingerprints are compared where block sizes are compatible: equal L, or L
that differ by one, where the one's second list meets the other's first. Their
likeness is 1 - d / (m + n) for lists of m and n chunks at edit distance d
(insertions and deletions cost 1), the better one if two pairs of lists meet;
it is 0 for incompatible sizes and 1 for equal fingerprints.

Null texts count as empty. Empty texts have the fingerprint ``2::`` and are
alike. Fingerprints cover whole texts of any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from riskloom.llm.words import encoded, mix

REACH = 7
LEAST_BITS = 2
USUAL, MOST = 64, 256
DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
# Rows of a bucket of neighbouring ids, and most buckets; beyond, buckets grow.
BUCKET_ROWS, MOST_BUCKETS = 1_000, 20_000


class Fingerprinter:
    """Makes fingerprints; keeps power tables, so make one per task."""

    def __init__(self):
        self._values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self._base = 0xD1342543DE82EF95
        self._inverse = pow(self._base, -1, 1 << 64)
        self._powers = self._inverses = np.ones(1, np.uint64)
        self._pairs = np.array([a + b for a in DIGITS for b in DIGITS])

    def _tables(self, n: int) -> None:
        if n > len(self._powers):
            size = 1 << max(12, n.bit_length())
            for name, base in (("_powers", self._base), ("_inverses", self._inverse)):
                table = np.ones(size, np.uint64)
                table[1:] = np.uint64(base)
                setattr(self, name, np.multiply.accumulate(table))

    def __call__(self, text: str | None) -> str:
        data = encoded(text)
        if not data:
            return f"{LEAST_BITS}::"
        terms = self._values[np.frombuffer(data, np.uint8)]
        n = len(terms)
        self._tables(n)
        rolling = terms.copy()
        for back in range(1, min(REACH, n)):
            rolling[back:] += terms[:-back] * self._powers[back]
        rolling = mix(rolling)
        bits = max(LEAST_BITS, (-(-n // USUAL) - 1).bit_length())
        ends = np.flatnonzero(rolling & np.uint64((1 << bits) - 1) == 0)
        while len(ends) >= MOST:
            bits += 1
            ends = ends[rolling[ends] & np.uint64((1 << bits) - 1) == 0]
        coarse = ends[rolling[ends] & np.uint64((2 << bits) - 1) == 0]
        placed = terms * self._powers[:n]
        return f"{bits}:{self._chunks(placed, ends)}:{self._chunks(placed, coarse)}"

    def _chunks(self, placed: np.ndarray, ends: np.ndarray) -> str:
        starts = np.concatenate([[0], ends + 1])
        starts = starts[starts < len(placed)]
        hashes = mix(np.add.reduceat(placed, starts) * self._inverses[starts])
        return "".join(self._pairs[(hashes >> np.uint64(52)).astype(np.int64)])


def _alike(one: str, two: str) -> float:
    """1 - edit distance over the summed lengths, by bits of a longest common subsequence."""
    a = [one[i : i + 2] for i in range(0, len(one), 2)]
    b = [two[i : i + 2] for i in range(0, len(two), 2)]
    if not a or not b:
        return float(one == two)
    places: dict[str, int] = {}
    for i, chunk in enumerate(a):
        places[chunk] = places.get(chunk, 0) | 1 << i
    full = (1 << len(a)) - 1
    state = full
    for chunk in b:
        hit = state & places.get(chunk, 0)
        state = ((state + hit) | (state - hit)) & full
    common = len(a) - state.bit_count()
    return 2 * common / (len(a) + len(b))


def likeness(one: str, two: str) -> float:
    """Likeness of two fingerprints, 0 to 1."""
    if one == two:
        return 1.0
    bits, fine, coarse = one.split(":")
    other, fine2, coarse2 = two.split(":")
    step = int(bits) - int(other)
    if step == 0:
        return max(_alike(fine, fine2), _alike(coarse, coarse2))
    if step == 1:
        return _alike(fine, coarse2)
    if step == -1:
        return _alike(coarse, fine2)
    return 0.0


def in_sequence(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bucket, tail, id, text), each bucket's rows together and in descending id.

    A bucket ends with a ``tail`` row, the first row of the next bucket (of the
    first bucket after the last one), so that each row can see its successor
    while texts are shuffled once. Buckets hold about BUCKET_ROWS rows. Null ids
    come after all others; rows of one id are ordered by text.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    count = rows.count()
    buckets = max(1, min(MOST_BUCKETS, -(-count // BUCKET_ROWS)))
    shares = [i / buckets for i in range(1, buckets)]
    cuts = np.zeros(0, np.int64)
    if shares:
        found = rows.agg(F.percentile_approx("id", shares, 100_000)).first()[0]
        cuts = np.unique(np.array(found or [], np.int64))

    @F.pandas_udf(T.IntegerType())
    def place(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ids.to_numpy(np.int64), side="left").astype(np.int32))

    known = rows.where("id is not null").select("id", place("id").alias("bucket"))
    # At most MOST_BUCKETS rows: the first id of each bucket.
    tops = sorted(known.groupBy("bucket").agg(F.max("id")).collect(), reverse=True)
    heads = [(top, tops[i - 1][0]) for i, (_, top) in enumerate(tops)]
    lowest = tops[-1][0] if tops else 0
    heads = rows.sparkSession.createDataFrame(heads, "id long, follows int")
    bucket = F.when(F.col("id").isNull(), F.lit(lowest)).otherwise(place(F.coalesce("id", F.lit(0))))
    spots = F.array(
        F.struct(F.col("own").alias("bucket"), F.lit(0).alias("tail")),
        F.struct(F.col("follows").alias("bucket"), F.lit(1).alias("tail")),
    )
    spread = (
        rows.withColumn("own", bucket)
        .join(F.broadcast(heads), "id", "left")
        .withColumn("spot", F.explode(F.filter(spots, lambda s: s["bucket"].isNotNull())))
        .select("spot.bucket", "spot.tail", "id", "text")
    )
    if not tops:
        # All ids are null: the first text in order follows the last.
        first = rows.orderBy("text").limit(1)
        spread = spread.unionByName(
            first.select(F.lit(lowest).alias("bucket"), F.lit(1).alias("tail"), "id", "text")
        )
    return (
        spread
        .repartition("bucket")
        .sortWithinPartitions("bucket", "tail", F.desc_nulls_last("id"), "text")
    )


COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compared(text: str, next_: str, own: str, following: str, make: Fingerprinter) -> tuple:
    half = len(text) // 2
    edited = text[: len(text) - half] + next_[:half]
    after = make(edited)
    digest = hashlib.sha256(encoded(edited)).hexdigest()
    return len(text), digest, own, after, likeness(own, after), likeness(own, following)


def against_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of texts, of edited texts and how alike they are.

    An edited text is a text whose last half (rounded down) is replaced by as
    many code points from the start of the next text in descending id.
    """
    schema = to_arrow_schema(T.StructType.fromDDL(COMPARED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Fingerprinter()
        waiting, done = None, []

        def settle(next_: str, print_: str) -> None:
            id_, text, own = waiting[1:]
            done.append((id_, *_compared(text, next_, own, print_, make)))

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*done), schema)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for batch in batches:
            for bucket, tail, id_, text in zip(*(c.to_pylist() for c in batch.columns)):
                text = text or ""
                print_ = make(text)
                if waiting is not None:
                    same = waiting[0] == bucket
                    settle(text if same else "", print_ if same else make(""))
                waiting = None if tail else (bucket, id_, text, print_)
            if done:
                yield flush()
        if waiting is not None:
            settle("", make(""))
            yield flush()

    return in_sequence(docs, id_col, text_col).mapInArrow(run, COMPARED)
