"""Word spans that an earlier document already holds, found on a De Bruijn graph.

Windows of ``WINDOW`` consecutive words are edges between their first and last
``WINDOW - 1`` words. A word is to be removed where a window over it also starts
in a document with a smaller id. Writing every edge of the corpus as a row would
multiply it, so edges travel in pieces:

1. Every window selects the least-hashed of its ``KEY``-word grams. Equal windows
   select equal grams, so a window can only repeat where its gram occurs in two
   documents. Neighbouring windows that select the same gram form a piece, a
   ready path of edges. Documents whose whole word sequence equals that of a
   smaller id need no graph; all their windows repeat.
2. Pieces whose gram repeats are joined with the first document that holds a
   piece of equal words. Elsewhere all their windows repeat. In its first
   document, a piece is only opened into single edges if its gram has pieces of
   other words too; these edges are joined with their first document likewise.
3. Placed pieces and edges are compacted: they make one path as long as both
   their document and their source go on without a branch between.
4. Path and source are read again at their coordinates, and only spans whose
   words have equal SHA-256 digests stay. A source is asked once for each span,
   however many documents repeat it.

Texts that are null, empty or shorter than a window have no spans. Rows with a
null id are neither sources nor cut. Rows that share an id never cut each other
(no id is smaller); their spans are told apart by a tag of the text. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.rows import map_rows
from riskloom.llm.tables import few_or_shuffled, settled
from riskloom.llm.words import WordHasher, encoded, mix
from riskloom.sources.staging import discard, staged

WINDOW = 13
KEY = 5
# Texts whose pieces are handed on at a time.
ROWS = 512
# Requests of one text that travel in one row.
LISTED = 4_096
SCANNED = (
    "id long, n long, k1 long, k2 long, key array<long>, pos array<int>, len array<int>, "
    "s1 array<long>, s2 array<int>"
)


def _running(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over each run of ``width`` values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = pick(values[:-step], values[step:])
        done += step
    return values


def window_keys(hasher: WordHasher, sums: np.ndarray, window: int, key: int) -> np.ndarray:
    """Per window, the least hash of its key grams."""
    grams = hasher.grams(sums, key)
    width = window - key + 1
    return _running(grams, width, np.minimum) if len(grams) >= width else grams[:0]


def _half(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _scan(window: int, key: int):
    """Per text, its length, sequence hash and pieces."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher()
        for batch in (b.iloc[i : i + ROWS] for b in batches for i in range(0, len(b), ROWS)):
            rows = []
            for id_, text in zip(batch["id"], batch["text"]):
                words = hasher.words(encoded(text))[2]
                sums, others = hasher.sums(words), hasher.sums(mix(words))
                keys = window_keys(hasher, sums, window, key)
                starts = np.flatnonzero(np.diff(keys, prepend=keys[:1] + np.uint64(1)))
                ends = np.append(starts[1:], len(keys)) + window - 1 if len(keys) else starts
                rows.append(
                    (
                        id_,
                        len(words),
                        *hasher.sequence(words),
                        keys[starts].view(np.int64),
                        starts.astype(np.int32),
                        (ends - starts).astype(np.int32),
                        hasher.runs(sums, starts, ends).view(np.int64),
                        _half(hasher.runs(others, starts, ends)),
                    )
                )
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCANNED.split(", ")])

    return run


def _edges(window: int):
    """The single windows of the requested pieces."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher()
        for batch in batches:
            parts = []
            for id_, text, tag, pieces in zip(*(batch[c] for c in ("id", "text", "tag", "asked"))):
                words = hasher.words(encoded(text))[2]
                if hasher.tag(words) != tag:
                    continue
                at = np.concatenate(
                    [np.arange(p["pos"], p["pos"] + p["len"] - window + 1) for p in pieces]
                )
                e1 = hasher.runs(hasher.sums(words), at, at + window).view(np.int64)
                e2 = _half(hasher.runs(hasher.sums(mix(words)), at, at + window))
                own = np.full(len(at), id_, np.int64), np.full(len(at), tag, np.int32)
                parts.append((*own, at.astype(np.int32), e1, e2))
            if parts:
                columns = [np.concatenate(c) for c in zip(*parts)]
                yield pd.DataFrame(dict(zip(("id", "tag", "pos", "e1", "e2"), columns)))

    return run


# A span and where its source has it.
REQUEST = ("id", "tag", "pos", "len", "sid", "stag", "spos")


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digest of the words of each requested span."""
    hasher = WordHasher()
    for batch in batches:
        rows = []
        for id_, text, tag, spans in zip(*(batch[c] for c in ("id", "text", "tag", "asked"))):
            data = encoded(text)
            if hasher.tag(hasher.words(data)[2]) != tag:
                continue
            words = data.split()
            for span in spans:
                part = b" ".join(words[span["pos"] : span["pos"] + span["len"]])
                source = span["sid"], span["stag"], span["spos"]
                own = id_, tag, span["pos"], span["len"]
                rows.append((*own, *source, hashlib.sha256(part).digest()))
        yield pd.DataFrame(rows, columns=[*REQUEST, "digest"])


def _with_texts(texts: DataFrame, asked: DataFrame, *fields: str) -> DataFrame:
    """(id, tag, text, asked): the requests of each text beside it, in lists of bounded size."""
    turn = F.row_number().over(Window.partitionBy("id", "tag").orderBy("pos", "len"))
    asked = settled(
        asked.withColumn("list", F.floor((turn - 1) / LISTED))
        .groupBy("id", "tag", "list")
        .agg(F.collect_list(F.struct(*fields)).alias("asked"))
        .drop("list"),
        "asked",
    )
    wanted = few_or_shuffled(asked.select("id").distinct())
    return texts.join(wanted, "id", "left_semi").join(asked, "id")


def repeated_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    key: int = KEY,
) -> DataFrame:
    """(doc_id, tag, start, end): word spans to remove, which may overlap or touch.

    ``tag`` tells apart the texts of rows that share an id.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = texts.where(F.col("id").isNotNull())
    scan = settled(texts.mapInPandas(_scan(window, key), SCANNED), "scanned")
    scanned = scan.where(F.col("n") >= window).withColumn(
        "tag", F.shiftright(F.shiftleft("k1", 32), 32).cast("int")
    )
    heads = scanned.groupBy("k1", "k2").agg(F.min("id").alias("first"), F.count("*").alias("rows"))
    copies = staged(
        scanned.select("id", "k1", "k2", "n", "tag")
        .join(heads.where("rows > 1"), ["k1", "k2"])
        .where(F.col("id") > F.col("first"))
        .select("id", "tag", "n"),
        "copies",
    )
    whole = copies.select("id", "tag", F.lit(0).cast("long").alias("start"), F.col("n").alias("end"))

    gone = few_or_shuffled(copies.select("id", "tag").distinct())
    distinct = scanned.join(gone, ["id", "tag"], "left_anti")
    repeated = settled(
        distinct.select("id", F.explode("key").alias("key"))
        .groupBy("key")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"))
        .where("low < high")
        .select("key"),
        "repeated",
    )
    piece = F.explode(F.arrays_zip("key", "pos", "len", "s1", "s2")).alias("piece")
    pieces = settled(
        distinct.select("id", "tag", piece)
        .select("id", "tag", "piece.*")
        .join(repeated, "key", "left_semi"),
        "pieces",
    )
    discard(scan, repeated)
    first = F.min(F.struct("id", "tag", "pos")).alias("src")
    firsts = settled(pieces.groupBy("s1", "s2", "key").agg(first), "firsts")
    branching = firsts.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    opened = pieces.join(
        firsts.join(branching, "key", "left_semi").select("s1", "s2", "src"), ["s1", "s2"]
    ).where(F.col("id") == F.col("src.id"))
    edges = settled(
        _with_texts(texts, opened.select("id", "tag", "pos", "len"), "pos", "len").mapInPandas(
            _edges(window), "id long, tag int, pos int, e1 long, e2 int"
        ),
        "edges",
    )
    held = edges.groupBy("e1", "e2").agg(first, F.max("id").alias("high")).where("src.id < high")
    place = ["id", "tag", "pos", "len", "src.id as sid", "src.tag as stag", "src.pos as spos"]
    placed = (
        pieces.join(firsts.select("s1", "s2", "src"), ["s1", "s2"])
        .where(F.col("id") > F.col("src.id"))
        .selectExpr(*place)
        .union(
            edges.withColumn("len", F.lit(window))
            .join(held.select("e1", "e2", "src"), ["e1", "e2"])
            .where(F.col("id") > F.col("src.id"))
            .selectExpr(*place)
        )
        .withColumn("shift", F.col("spos") - F.col("pos"))
    )
    # Of one document and one alignment with one source: bounded by the document's length.
    alignment = ["id", "tag", "sid", "stag", "shift"]
    along = Window.partitionBy(*alignment).orderBy("pos", "len")
    reached = F.max(F.col("pos") + F.col("len")).over(along.rowsBetween(Window.unboundedPreceding, -1))
    paths = settled(
        placed.withColumn("branch", F.when(F.col("pos") <= reached, 0).otherwise(1))
        .withColumn("run", F.sum("branch").over(along))
        .groupBy(*alignment, "run")
        .agg(
            F.min("pos").alias("pos"),
            (F.max(F.col("pos") + F.col("len")) - F.min("pos")).alias("len"),
        )
        .withColumn("spos", F.col("pos") + F.col("shift"))
        .select(*REQUEST),
        "paths",
    )
    discard(pieces, firsts, edges)
    # A source's own request names itself; paths have sources of smaller ids.
    sources = paths.select("sid", "stag", "spos", "len").distinct()
    asked = paths.union(
        sources.selectExpr(
            "sid as id", "stag as tag", "spos as pos", "len", "sid", "stag", "spos"
        )
    )
    read = _with_texts(texts, asked, *REQUEST[2:]).mapInPandas(
        _digests,
        "id long, tag int, pos int, len int, sid long, stag int, spos int, digest binary",
    )
    digests = settled(
        read.groupBy(*REQUEST)
        .agg(F.min("digest").alias("digest"), F.max("digest").alias("high"))
        .where("digest = high")
        .drop("high"),
        "digests",
    )
    held = digests.where("id = sid").select("sid", "stag", "spos", "len", "digest")
    start, end = F.col("pos").cast("long"), (F.col("pos") + F.col("len")).cast("long")
    spans = (
        digests.where("id > sid")
        .join(held, held.columns, "left_semi")
        .select("id", "tag", start.alias("start"), end.alias("end"))
    )
    return spans.union(whole).withColumnRenamed("id", "doc_id")


def cut(text: str | None, spans, hasher: WordHasher) -> tuple[list[bytes], int]:
    """(words left, number of words removed) of a text with its own and others' spans."""
    data = encoded(text)
    words = data.split()
    if not spans:
        return words, 0
    own = hasher.tag(hasher.words(data)[2])
    change = np.zeros(len(words) + 1, np.int64)
    for span in spans:
        if span["tag"] == own:
            change[span["start"]] += 1
            change[span["end"]] -= 1
    kept = np.cumsum(change[:-1]) == 0
    return [words[i] for i in np.flatnonzero(kept)], int(len(words) - kept.sum())


def _cutter():
    hasher = WordHasher()

    def one(id_, text, spans):
        words, removed = cut(text, spans, hasher)
        left = b" ".join(words).decode("utf-8", "surrogatepass")
        return id_, len(words) + removed, removed, left

    return one


def without_repeats(
    docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): texts without the words of ``spans``.

    Rows without spans are not shuffled as long as the ids that have some are few.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    spans = settled(spans, "spans")
    per_doc = spans.groupBy(F.col("doc_id").alias("id")).agg(
        F.collect_list(F.struct("tag", "start", "end")).alias("spans")
    )
    ids = few_or_shuffled(spans.select(F.col("doc_id").alias("id")).distinct())
    none = F.lit(None).cast(per_doc.schema["spans"].dataType)
    rows = (
        texts.join(ids, "id", "left_semi")
        .join(per_doc, "id")
        .select("id", "text", "spans")
        .unionByName(texts.join(ids, "id", "left_anti").withColumn("spans", none))
    )
    return map_rows(rows, _cutter, "doc_id long, n_words long, n_removed long, kept string")
