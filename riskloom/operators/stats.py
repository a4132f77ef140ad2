"""Per-user stats that merge (U4, U9 over runs, T3): kept between runs, read instead of items.

Partial stats are what U4 needs of some scores: largest, decimal sum, how many are high, how
many there are. Those of two sets of scores merge to those of both, in any order, so a run
scores new items only, and days merge to windows. Taking a user back is replacing its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.model import DEFAULT_MODEL
from riskloom.operators.users import SUM_TYPE
from riskloom.sources.buckets import BUCKETS, BucketStore, Written
from riskloom.sources.staging import discard, staged

STATS = T.StructType(
    [
        T.StructField("username", T.StringType()),
        T.StructField("max_score", T.DoubleType()),
        T.StructField("sum_score", T.DecimalType(38, 12)),
        T.StructField("high_scores", T.LongType()),
        T.StructField("scores", T.LongType()),
    ]
)


def partial_stats(score: str = "score", high: float = DEFAULT_MODEL.high) -> list[Column]:
    """Aggregates of a score column."""
    value = F.col(score)
    return [
        F.max(value).alias("max_score"),
        F.sum(value.cast(SUM_TYPE)).alias("sum_score"),
        F.count_if(value >= F.lit(high)).alias("high_scores"),
        F.count(value).alias("scores"),
    ]


def merged_stats() -> list[Column]:
    """Aggregates of partial stats, which give partial stats again."""
    return [
        F.max("max_score").alias("max_score"),
        F.sum("sum_score").alias("sum_score"),
        F.sum("high_scores").alias("high_scores"),
        F.sum("scores").alias("scores"),
    ]


def whole_stats() -> list[Column]:
    """The columns of U4 from partial stats; null without scores, but for the counts."""
    return [
        F.col("max_score").alias("max_post_score"),
        F.when(F.col("scores") > 0, F.col("sum_score").cast("double") / F.col("scores")).alias(
            "average_score"
        ),
        F.col("high_scores").alias("count_high_posts"),
        F.col("scores").alias("total_posts"),
    ]


def stats_store(spark: SparkSession, root: str, buckets: int = BUCKETS) -> BucketStore:
    """Partial stats below ``root``, one row per user, bucketed by user."""
    return BucketStore(spark, root, "username", {"stats": STATS}, buckets)


def add_to_stats(
    store: BucketStore,
    scores: DataFrame,
    again: DataFrame | None = None,
    high: float = DEFAULT_MODEL.high,
) -> Written:
    """Merges a delivery of ``(username, score)`` into the store.

    Users of ``again(username)`` were fetched again: what the store has of them is taken
    back, so that only this delivery counts, also where it has none of their items. Scores
    of other users are added. Only the buckets of these users are read and written.
    Null users are left out.
    """
    new = staged(
        scores.where("username is not null").groupBy("username").agg(*partial_stats(high=high)),
        "stats",
    )
    users = new.select("username")
    if again is not None:
        again = again.select("username").dropna().distinct()
        users = users.unionByName(again)
    touched = store.touched(users)
    old = store.read("stats", touched)
    if again is not None:
        old = old.join(again, "username", "left_anti")
    merged = old.unionByName(new).groupBy("username").agg(*merged_stats())
    written = store.write({"stats": merged}, touched)
    discard(new)
    return written


def stats_of(store: BucketStore) -> DataFrame:
    """(username, U4's columns) of users with scores."""
    return store.read("stats").where("scores > 0").select("username", *whole_stats())
