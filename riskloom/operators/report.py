"""Summaries of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABELS = ("high", "medium", "low")


def label_distribution(scored: DataFrame, label: str = "risk_label") -> DataFrame:
    """(label, count, percent) for each label, zero rows included.

    One aggregation to one row, then unpivoted: no join, no second scan.
    """
    totals = scored.agg(
        F.count("*").alias("_total"),
        *(F.count_if(F.col(label) == name).alias(name) for name in LABELS),
    )
    counts = totals.unpivot("_total", list(LABELS), "label", "count")
    percent = F.coalesce(F.col("count") / F.nullif("_total", F.lit(0)) * 100.0, F.lit(0.0))
    return counts.select("label", "count", percent.alias("percent"))


def posts_per_group(posts: DataFrame, group: str = "subreddit") -> DataFrame:
    """(group, posts) (R2)."""
    return posts.groupBy(group).agg(F.count("*").alias("posts"))


def author_coverage(authors: DataFrame, existing: DataFrame) -> DataFrame:
    """One row: unique, known and still to be fetched authors (R2)."""
    known = existing.select("username").distinct().withColumn("_known", F.lit(True))
    marked = authors.join(known, "username", "left")
    return marked.agg(
        F.count("*").alias("authors"),
        F.count("_known").alias("known"),
        F.count_if(F.col("_known").isNull()).alias("to_fetch"),
    )


def items_per_user(users: DataFrame, items: DataFrame) -> DataFrame:
    """(username, items), zero rows included (R2)."""
    counts = items.groupBy("username").agg(F.count("*").alias("items"))
    return users.join(counts, "username", "left").fillna(0, subset=["items"])
