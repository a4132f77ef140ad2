"""Removal of globally repeated chunks of lines.

A text is cut into chunks at boundaries that its lines choose themselves: before a line
whose rolling hash, over the hashes of it and the line before, is less than that of its
neighbours. So boundaries are two lines apart at least and three on average; none is set
before the second or the last line, so every chunk of a text of several lines has two or
more. A stretch of more than ``MOST_LINES`` lines without boundary is cut at that length
(a single line left over stays with the piece before). Lines put in or taken out move
later chunks along but change only those around them. A chunk of at least ``LEAST_LINES``
lines goes if the same bytes are a chunk of a document with a smaller id, or an earlier
chunk of the same document.

Chunks are first matched by 128-bit hashes, without their texts. Only repeated
ones are read again and grouped by their bytes. A hash that stands for different
bytes removes nothing.

Texts of documents with repeated chunks are sorted to their chunk lists at every
size; those of other documents stay in place while the ids of the former are few.

Lines end at line feeds. Null texts stay null and have no lines; an empty text is
one empty line. A text all of whose chunks go becomes empty and its row stays.
Rows with a null id are only compared within themselves; rows that share an id
never remove each other's chunks. Other columns pass through, whatever their names, but
for one named ``_kept``, which the result's replaces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.tables import few_or_shuffled, packed, settled, unpacked
from riskloom.llm.words import encoded

FACTOR, MODULUS = 31, 4294967291
LEAST_LINES, MOST_LINES = 2, 16


def chunks(text: str | None) -> list[bytes]:
    """Chunks of a text; joined by line feeds they are the text."""
    if text is None:
        return []
    lines = encoded(text).split(b"\n")
    if len(lines) < 4:
        return [b"\n".join(lines)]
    hashes = [int.from_bytes(hashlib.md5(line).digest()[:4], "big") for line in lines]
    rolled = [(h + FACTOR * b) % MODULUS for b, h in zip([0, *hashes], hashes)]
    starts = [i for i in range(2, len(lines) - 1) if rolled[i - 1] > rolled[i] <= rolled[i + 1]]
    out = []
    for start, end in zip([0, *starts], [*starts, len(lines)]):
        pieces = max(1, (end - start - 2) // MOST_LINES + 1)
        cuts = [start + MOST_LINES * k for k in range(pieces)]
        out += [b"\n".join(lines[a:b]) for a, b in zip(cuts, [*cuts[1:], end])]
    return out


def eligible(chunk: bytes) -> bool:
    return chunk.count(b"\n") >= LEAST_LINES - 1


def chunk_hash(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def _hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Distinct hashes of a text's eligible chunks."""
    for batch in batches:
        rows = [
            (id_, h)
            for id_, text in zip(batch["id"], batch["text"])
            for h in {chunk_hash(c) for c in chunks(text) if eligible(c)}
        ]
        yield pd.DataFrame(rows, columns=["id", "h"])


def _bytes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The chunks with one of the asked hashes."""
    for batch in batches:
        rows = []
        for id_, text, asked in zip(batch["id"], batch["text"], batch["asked"]):
            wanted = {bytes(h) for h in asked}
            for chunk in set(filter(eligible, chunks(text))):
                h = chunk_hash(chunk)
                if h in wanted:
                    rows.append((id_, h, chunk))
        yield pd.DataFrame(rows, columns=["id", "h", "chunk"])


KEPT = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("lines", T.LongType()),
        T.StructField("removed", T.LongType()),
    ]
)


@F.pandas_udf(KEPT)
def kept(texts: pd.Series, gone: pd.Series) -> pd.DataFrame:
    """Texts without the chunks whose hashes are ``gone`` and without own repeats."""
    rows = []
    for text, hashes in zip(texts, gone):
        if text is None:
            rows.append((None, 0, 0))
            continue
        drop = set() if hashes is None else {bytes(h) for h in hashes}
        seen, left, removed, lines = set(), [], 0, 0
        for chunk in chunks(text):
            count = chunk.count(b"\n") + 1
            lines += count
            if eligible(chunk):
                if chunk in seen or (drop and chunk_hash(chunk) in drop):
                    removed += count
                    continue
                seen.add(chunk)
            left.append(chunk)
        rows.append((b"\n".join(left).decode("utf-8", "surrogatepass"), lines, removed))
    return pd.DataFrame(rows, columns=["text", "lines", "removed"])


def without_repeated_chunks(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with the column ``_kept``: struct of text, lines and removed lines."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = texts.where(F.col("id").isNotNull())
    held = settled(texts.mapInPandas(_hashes, "id long, h binary"), "hashes")
    # Written first: a join of tables is one whose frequent keys can be split.
    repeated = settled(
        held.groupBy("h")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"))
        .where("low < high")
        .select("h"),
        "repeated",
    )
    found = settled(held.join(repeated, "h", "left_semi"), "found")
    asked = found.groupBy("id").agg(F.collect_list("h").alias("asked"))
    some = few_or_shuffled(found.select("id").distinct())
    firsts = settled(
        texts.join(some, "id", "left_semi")
        .join(asked.hint("merge"), "id")
        .mapInPandas(_bytes, "id long, h binary, chunk binary")
        .groupBy("h", "chunk")
        .agg(F.min("id").alias("first"))
        .groupBy("h")
        .agg(F.count("*").alias("kinds"), F.min("first").alias("first"))
        .where("kinds = 1"),
        "firsts",
    )
    gone = settled(
        found.join(firsts, "h")
        .where(F.col("id") > F.col("first"))
        .groupBy("id")
        .agg(F.collect_list("h").alias("_gone")),
        "gone",
    )
    cut = few_or_shuffled(gone.select(F.col("id").alias("_id")))
    rows = packed(docs, _id=F.col(id_col).cast("long"), _text=F.col(text_col))
    rows = (
        rows.join(cut, "_id", "left_semi")
        .join(gone.withColumnRenamed("id", "_id").hint("merge"), "_id")
        .unionByName(
            rows.join(cut, "_id", "left_anti").withColumn("_gone", F.lit(None).cast("array<binary>"))
        )
    )
    return unpacked(rows.withColumn("_kept", kept("_text", "_gone")), docs.columns, "_kept")
