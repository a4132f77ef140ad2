"""The training-data pipeline: five stages over ``documents``, each a written table.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last
return the columns of their input, whatever other columns it has; each works on all that
its predecessor kept. Null and empty texts pass the classifier by their score, lose no
lines, are nobody's near duplicates, and are taken 0 times by the mix. Rows that share an
id are rows of their own, but for near duplicates, where the id stands for the row. Empty
tables stay empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import labelled, line_dedup, minhash_dedup, mixing, quality_gam
from riskloom.llm import sentencepiece_tokens as tokens
from riskloom.llm.tables import packed, unpacked
from riskloom.llm.words import word_count
from riskloom.sources.staging import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# A document whose quality score is lower is rejected.
LEAST_QUALITY = 0.3


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier rejects; labels only serve its training."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_gam.train(docs, labels, labelled.fold("doc_id", 5) != 0)
    scored = packed(docs, score=model.column("text"))
    return unpacked(scored.where(F.col("score") >= LEAST_QUALITY), docs.columns)


def line_chunks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated chunks of lines out of the texts; no row goes, null texts stay null."""
    rows = packed(docs, doc_id=F.col("doc_id"), text=F.col("text"))
    cut = line_dedup.without_repeated_chunks(rows).select("_row", "_kept.text")
    cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return unpacked(cut, docs.columns, "text", "n_chars").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, that with the smallest id."""
    return minhash_dedup.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each document as often as the mix takes it; those taken 0 times go."""
    rows = packed(
        docs, doc_id=F.col("doc_id"), source=F.col("source"), size=word_count("text")
    )
    mixed = mixing.with_copies(rows).where("_copies > 0")
    copies = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))
    return unpacked(mixed.select("_row", copies.alias("copy")), docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of what is left, and whether they decode to the text they came from.

    A null text has null ids, no tokens and null checks.
    """
    found = tokens.with_tokens(docs.select("doc_id", "source", "lang", "text"))
    ids = F.col("_tokens.ids")
    return found.select(
        "doc_id",
        "source",
        "lang",
        F.coalesce(F.size(ids), F.lit(0)).alias("n_tokens"),
        ids.alias("ids"),
        (F.col("_tokens.decoded") == F.col("text")).alias("round_trip"),
        F.col("_tokens.parity").alias("parity"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_chunks),
    ("minhash_near_dedup", near_duplicates),
    ("mix_sources", mix_sources),
    ("sentencepiece", sentencepiece),
]

# The classifier, the mix's dual and the tokenizer can't be written in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
