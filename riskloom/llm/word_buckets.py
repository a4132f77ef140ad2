"""Target-distribution importance resampling over hashed runs of words.

A document's features are its runs of 1 to ``most`` consecutive words; a feature's bucket
is the crc32 of its bytes modulo the number of buckets. Buckets of the documents and of
the target texts are counted, a bucket's gain is the log ratio of its smoothed shares, and
a document weighs the sum of its features' gains. Gumbel noise that only depends on the id
turns the largest weights into a sample without replacement.

Words are looked up in an Aho-Corasick automaton. Its keys are the distinct words of a
slice of text between delimiters, its payloads each word's crc32 and length. A scan emits
the payloads in the order of the text; the crc32 of a run follows from the payloads of
adjacent words alone (``crc(ab)`` is ``crc(a)`` shifted by ``len(b)`` zero bytes, plus
``crc(b)``), so no run is ever spelled out. Slices are of bounded size, hence so are
automata, whatever the number of distinct words in all documents; long texts are cut
into slices at delimiters and their payloads follow on.

Texts are scanned once; their features are written, and counted and weighed from there.
Shuffled are bucket counts (at most one row a bucket and task) and, for the ranking, one
narrow row a document, in ranges: no task ranks more than its range.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.sources.staging import discard, staged

BUCKETS, LEAST_WORDS, PERCENT, SEED = 10_000, 20, 10, 2024
# Bytes of text that share an automaton, and of one text that are scanned at a time.
SLICE = 1 << 22

# ASCII letters in lower case, digits and all bytes from 0x80 as they are, others to spaces.
_KEPT = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def _zeros() -> np.ndarray:
    """``[k, i, b]``: the crc register with byte ``b`` at place ``i``, after 2**k zero bytes."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(0xEDB88320), byte >> 1)
    one = np.empty((4, 256), np.uint32)
    values = np.arange(256, dtype=np.uint32)
    for i in range(4):
        register = values << np.uint32(8 * i)
        one[i] = byte[register & 255] ^ (register >> 8)
    tables = [one]
    for _ in range(31):
        last = tables[-1]
        tables.append(np.stack([_through(last, last[i]) for i in range(4)]))
    return np.stack(tables)


def _through(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (
        table[0][crc & 255]
        ^ table[1][(crc >> 8) & 255]
        ^ table[2][(crc >> 16) & 255]
        ^ table[3][crc >> 24]
    )


class Payloads:
    """crc32 and length of the words of texts, and of runs of words."""

    def __init__(self):
        self._tables = _zeros()
        self._space = np.uint32(zlib.crc32(b" "))

    def followed(self, crc: np.ndarray, crc2: np.ndarray, length2: np.ndarray) -> np.ndarray:
        """crc32 of pairs of strings from that of each and the length of the second."""
        crc, length2 = crc.copy(), length2.copy()
        k = 0
        while (more := length2 > 0).any():
            odd = more & (length2 & 1 == 1)
            crc[odd] = _through(self._tables[k], crc[odd])
            length2 >>= 1
            k += 1
        return crc ^ crc2

    def scanned(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(crc32, length) of the words of each text, in order, by one automaton for all."""
        spaced = [b" " + t.translate(_KEPT) + b" " for t in texts]
        automaton = ahocorasick.Automaton()
        for word in {w for t in spaced for w in t.split()}:
            # One character a byte: the library's keys are text.
            automaton.add_word(f" {word.decode('latin-1')} ", (zlib.crc32(word) << 32) | len(word))
        if not len(automaton):
            return [(np.zeros(0, np.uint32), np.zeros(0, np.int64)) for _ in texts]
        automaton.make_automaton()
        out = []
        for text in spaced:
            found = np.fromiter((v for _, v in automaton.iter(text.decode("latin-1"))), np.uint64)
            out.append(((found >> np.uint64(32)).astype(np.uint32), found.astype(np.uint32).astype(np.int64)))
        return out

    def runs(self, crc: np.ndarray, length: np.ndarray, most: int) -> Iterator[np.ndarray]:
        """crc32 of the runs of 1 word, of 2 words and so on, words joined by one space."""
        spaced = self.followed(np.full_like(crc, self._space), crc, length) if most > 1 else crc
        run = crc
        for size in range(1, most + 1):
            if size > 1:
                run = self.followed(run[:-1], spaced[size - 1 :], length[size - 1 :] + 1)
            yield run
            if len(run) < 2:
                return

    def buckets(self, texts: list[str | None], most: int, buckets: int) -> Iterator[np.ndarray]:
        """Buckets of all features of each text."""
        for part in slices([(t or "").encode("utf-8", "surrogatepass") for t in texts]):
            scans = iter(self.scanned([piece for pieces in part for piece in pieces]))
            for pieces in part:
                own = [next(scans) for _ in pieces]
                crc = np.concatenate([c for c, _ in own]) if len(own) > 1 else own[0][0]
                length = np.concatenate([n for _, n in own]) if len(own) > 1 else own[0][1]
                yield np.concatenate([run % buckets for run in self.runs(crc, length, most)])


def pieces(data: bytes) -> list[bytes]:
    """A text cut at delimiters, each piece of ``SLICE`` bytes or one longer word."""
    out, at = [], 0
    while len(data) - at > SLICE:
        end = at + SLICE
        while end < len(data) and _KEPT[data[end]] != 32:
            end += 1
        out.append(data[at:end])
        at = end
    return [*out, data[at:]]


def slices(texts: list[bytes]) -> Iterator[list[list[bytes]]]:
    """Texts in pieces, as many at a time as make about ``SLICE`` bytes, one at least."""
    part, size = [], 0
    for text in texts:
        part.append(pieces(text))
        size += len(text)
        if size >= SLICE:
            yield part
            part, size = [], 0
    if part:
        yield part


def featured(texts: DataFrame, text_col: str, most: int, buckets: int) -> DataFrame:
    """(key, buckets array<int>): the features of each row, whose column ``key`` stays.

    A table: texts are scanned once, and all that follows reads numbers.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Payloads()
        for batch in batches:
            at, rows, size = 0, [], 0
            for found in of.buckets(batch.column(1).to_pylist(), most, buckets):
                rows.append(found.astype(np.int32))
                size += len(found)
                if size > SLICE or at + len(rows) == batch.num_rows:
                    lists = _lists(rows)
                    keys = batch.column(0).slice(at, len(rows))
                    yield pa.RecordBatch.from_arrays([keys, lists], ["key", "buckets"])
                    at, rows, size = at + len(rows), [], 0

    kind = texts.schema["key"].dataType.simpleString()
    return staged(
        texts.select("key", text_col).mapInArrow(scan, f"key {kind}, buckets array<int>"), "features"
    )


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows), pa.int32()))


def bucket_counts(features: DataFrame, buckets: int) -> DataFrame:
    """(bucket long, n long): how many features of all rows are in each bucket that has any."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": held, "n": total[held]})

    counted = features.select("buckets").mapInArrow(count, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """(bucket, gain) of every bucket, also of those without features."""
    both = source.withColumnRenamed("n", "s").join(target.withColumnRenamed("n", "t"), "bucket", "full")
    known = (
        source.sparkSession.range(buckets)
        .withColumnRenamed("id", "bucket")
        .join(both, "bucket", "left")
        .select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t"))
    )
    sums = known.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    s, t, all_s, all_t = (F.col(c).cast("double") for c in ("s", "t", "all_s", "all_t"))
    ratio = ((t + 1) * (all_s + buckets)) / ((s + 1) * (all_t + buckets))
    # One row of sums beside a row per bucket.
    return known.crossJoin(F.broadcast(sums)).select(
        "bucket", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long").alias("gain")
    )


def noise(id_col: str, seed: int) -> Column:
    """Gumbel noise in thousandths from a digest of the id; that of a null id is of no digits."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    uniform = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))).cast("long")


def ranked(rows: DataFrame, among: Column, order: list[Column]) -> DataFrame:
    """A table of ``rows`` with ``place``: 1, 2, 3... in ``order`` where ``among``, else null.

    Rows are dealt out by ranges of the order and written; a place is the rows of
    earlier ranges and the place within the range.
    """
    dealt = rows.withColumn("_among", among).repartitionByRange(F.desc("_among"), *order)
    placed = staged(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = placed.where("_among").groupBy("_range").agg(F.count("*").alias("_n"))
    # One row a range, as many as shuffle partitions.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_range", "_among").orderBy(*order))
    place = F.when(F.col("_among"), F.col("_before") + within)
    return placed.join(F.broadcast(sizes), "_range", "left").withColumn("place", place).drop(
        "_among", "_range", "_before"
    )


def resampled(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    most: int = 1,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """(``id_col``, n_features, weight, score, rank) for every row of ``docs``, all but the id long.

    ``rank`` is null for documents that are not drawn; drawn are ``percent`` of a hundred
    of those with ``least_words`` words, the highest scores, ties to smaller ids (null ids
    last). Only these columns are read, so others may have any names. Null and empty texts
    have no features and weigh 0. Rows that share an id are rows of their own with the same
    noise; equal rows take places one after the other. Without target texts all gains come
    from the documents alone; without documents there are no rows.
    """
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    aims = target.select(F.lit(0).alias("key"), F.col(target_col).alias("text"))
    source, aimed = (featured(t, "text", most, buckets) for t in (rows, aims))
    table = staged(gains(bucket_counts(source, buckets), bucket_counts(aimed, buckets), buckets), "gains")
    # As long as there are buckets, whatever the tables' size.
    gain = np.zeros(buckets, np.int64)
    for bucket, value in table.collect():
        gain[bucket] = value
    sent = docs.sparkSession.sparkContext.broadcast(gain)
    discard(table, aimed)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value
        for batch in batches:
            lists = batch.column(1)
            # Sums over rows as differences of running sums, which also fits empty rows.
            sums = np.concatenate([[0], np.cumsum(gain[lists.flatten().to_numpy()])])
            words = np.diff(lists.offsets.to_numpy())
            ends = np.cumsum(words)
            weights = sums[ends] - sums[ends - words]
            values = [batch.column(0), pa.array(words, pa.int64()), pa.array(weights, pa.int64())]
            yield pa.RecordBatch.from_arrays(values, ["key", "n_features", "weight"])

    kind = rows.schema["key"].dataType.simpleString()
    weighed = source.mapInArrow(weigh, f"key {kind}, n_features long, weight long")
    scored = staged(weighed.withColumn("score", F.col("weight") + noise("key", seed)), "scores")
    discard(source)
    # n words make n + (n-1) + ... runs, so a least number of words is one of features.
    least = sum(max(least_words - i, 0) for i in range(most))
    placed = ranked(scored, F.col("n_features") >= least, [F.desc("score"), F.asc_nulls_last("key")])
    discard(scored)
    drawn = placed.agg(F.floor(F.count("place") * F.lit(percent) / F.lit(100)).cast("long").alias("k"))
    rank = F.when(F.col("place") <= F.col("k"), F.col("place")).cast("long").alias("rank")
    return placed.crossJoin(F.broadcast(drawn)).select(
        F.col("key").alias(id_col), "n_features", "weight", "score", rank
    )
