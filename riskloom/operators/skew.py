"""Top-n per group and checked broadcasts where one key owns a large part of the rows.

Joins on frequent keys need nothing of their own: outer, semi and anti joins are
written plainly with the frequent side on the left, and adaptive execution
splits its large partitions while the other side, which holds a key once, is
read by each part. What adaptive execution can't split is a window, so top-n
per group takes two rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Parts of a group in the first of two top-n rounds.
TOP_SPLITS = 64
# Most keys that are broadcast after being counted.
BROADCAST_KEYS = 500_000


def few(keys: DataFrame, limit: int = BROADCAST_KEYS) -> bool:
    """Whether ``keys`` were counted to hold at most ``limit`` rows."""
    return keys.limit(limit + 1).count() <= limit


def having_few(
    left: DataFrame, right: DataFrame, keys: list[str], broadcast_keys: int = BROADCAST_KEYS
) -> DataFrame:
    """Left semi join to ``right``, which is expected to be, but need not be, small.

    Its distinct keys are counted first, up to the limit. Within it they are
    broadcast and wide rows of ``left`` stay where they are.
    """
    wanted = right.select(*keys).dropna().distinct()
    marked = F.broadcast(wanted) if few(wanted, broadcast_keys) else wanted
    return left.join(marked, keys, "left_semi")


def top_per_group(
    df: DataFrame, group: list[str], order: list[Column], n: int, rank: str = "_rank"
) -> DataFrame:
    """First ``n`` rows per group in ``order``, with their rank, in two rounds.

    The first round ranks within parts of a group. A part is made of whole map
    tasks: each cuts a group to ``n`` rows before the shuffle, so at most ``n``
    rows per group and task are written and a part receives a fraction of
    them. The choice of parts can't show in the result. The second round ranks
    the at most ``TOP_SPLITS * n`` rows left of a group.
    """
    number = F.row_number()
    part = Window.partitionBy(*group, "_part").orderBy(*order)
    whole = Window.partitionBy(*group).orderBy(*order)
    return (
        df.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(TOP_SPLITS)))
        .withColumn(rank, number.over(part))
        .where(F.col(rank) <= n)
        .drop("_part")
        .withColumn(rank, number.over(whole))
        .where(F.col(rank) <= n)
    )
