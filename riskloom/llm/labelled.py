"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for null ids."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


def share(labels: DataFrame, label: str, keep: Column) -> float:
    """Smoothed share of ones among all labelled ids where ``keep``; half without any."""
    known = labels.where(keep & F.col(label).isNotNull()).groupBy("doc_id").agg(F.min(label).alias("label"))
    row = known.agg(F.sum("label").alias("ones"), F.count("*").alias("rows")).first()
    return ((row["ones"] or 0) + 1) / (row["rows"] + 2)


def sample(labels: DataFrame, label: str, keep: Column, limits: dict[int, int]) -> DataFrame:
    """(doc_id, label, turn): labelled rows where ``keep``, at most ``limits[value]`` per value.

    The rows are those with the least hash of their id, so the choice follows
    neither the size nor the order of the table. Ids labelled more than once
    count with their smallest label.
    """
    known = (
        labels.where(keep & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("label"))
        .withColumn("turn", F.xxhash64("doc_id"))
    )
    parts = [
        known.where(F.col("label") == value).orderBy("turn", "doc_id").limit(most)
        for value, most in limits.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out
