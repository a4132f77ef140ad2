"""Small helpers for tables between jobs."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.sources.staging import staged

# Most rows of a narrow table that are broadcast, once counted.
BROADCAST_ROWS = 1_000_000


def few_or_shuffled(rows: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``rows`` as a written table, marked for broadcast if counted to be few."""
    rows = staged(rows, "rows")
    return F.broadcast(rows) if rows.count() <= limit else rows


def settled(df: DataFrame, name: str) -> DataFrame:
    """``staged``, after which the shuffle files that made the table may go.

    Spark's cleaner removes the files of a finished job once the driver's JVM
    has collected the objects that stood for them. A quiet driver may take half
    an hour to do so, while the executors' disks fill; this asks for it now.
    """
    table = staged(df, name)
    gc.collect()
    df.sparkSession._jvm.java.lang.System.gc()
    return table


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """``columns`` of ``df`` by new names, beside all of its own columns in the struct ``_row``.

    Operators that add columns of their own on the way do so here, where an input's
    columns can have any names without meeting them.
    """
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"), *(c.alias(n) for n, c in columns.items()))


def unpacked(df: DataFrame, names: list[str], *out: str) -> DataFrame:
    """The columns ``names`` of the struct ``_row`` and the columns ``out``, which replace their likes."""
    row = F.col("_row")
    return df.select(*(row[c].alias(c) for c in names if c not in out), *out)


def running(rows: DataFrame, order: list[Column], *values: str) -> DataFrame:
    """A table of ``rows`` with ``before_<value>``: the sum of a value over earlier rows.

    Rows are dealt out by ranges of the order and written; a sum is that of the earlier
    ranges and that of the earlier rows in the range, so no task orders more than a range.
    ``order`` should tell rows apart.
    """
    dealt = rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    placed = staged(dealt, "ranges")
    sums = placed.groupBy("_range").agg(*(F.sum(v).alias(f"_{v}") for v in values))
    # One row a range, as many as shuffle partitions.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_range", *(F.coalesce(F.sum(f"_{v}").over(earlier), F.lit(0)).alias(f"_{v}") for v in values))
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = {
        f"before_{v}": F.col(f"_{v}") + F.coalesce(F.sum(v).over(within), F.lit(0)) for v in values
    }
    joined = placed.join(F.broadcast(sums), "_range").withColumns(before)
    return joined.drop("_range", *(f"_{v}" for v in values))
