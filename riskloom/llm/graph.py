"""Connected components over links that stay in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.sources.staging import staged


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every end of ``links(a long, b long)``.

    ``component`` is the smallest id that can be reached. Rounds of large and
    small stars move every link towards the smallest end it can see; a number
    of rounds logarithmic in the longest path is enough. Each round is a
    written table, so lineage stays short and a lost executor costs one round
    at most. Only one row of sums comes to the driver per round.
    """
    edges = staged(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (
            both.join(least, "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .where(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = staged(small, "links")
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == before:
            break
        before = now
    ends = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    tops = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return ends.union(tops)
