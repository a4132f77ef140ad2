"""Filters, budgets, ordering and per-author history selection."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.skew import top_per_group
from riskloom.sources.staging import staged

# The published defaults.
TARGET_GROUPS = ("news", "worldnews", "politics", "PublicFreakout", "unpopularopinion", "Palestine")
PER_GROUP = 30
TOTAL = 180
LOOKBACK_DAYS = 10
MAX_ITEMS = 100


def drop_promoted(df: DataFrame, promoted: str = "promoted") -> DataFrame:
    """Drops rows whose promoted mark is exactly "true" (L1)."""
    return df.where(~F.col(promoted).eqNullSafe(F.lit("true")))


def drop_invalid(df: DataFrame, required: tuple[str, ...] = ("id", "created_utc")) -> DataFrame:
    """Drops rows without an id or a time (L2)."""
    return df.dropna(subset=list(required))


def cutoff(as_of: dt.datetime, days: int = LOOKBACK_DAYS) -> float:
    """Epoch second where the lookback from ``as_of`` (naive is UTC) begins."""
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=dt.timezone.utc)
    return (as_of - dt.timedelta(days=days)).timestamp()


def lookback(
    df: DataFrame, as_of: dt.datetime, days: int = LOOKBACK_DAYS, ts: str = "created_utc"
) -> DataFrame:
    """Rows no older than ``days`` before ``as_of``; the boundary is kept (L3).

    The bound is a literal, so it reaches the scan as a pushed filter.
    """
    return df.where(F.col(ts) >= F.lit(cutoff(as_of, days)))


def prefix_until_old(
    df: DataFrame,
    keys: list[str],
    pos: str,
    oldest: float,
    ts: str = "created_utc",
) -> DataFrame:
    """Rows before the key's first row older than ``oldest``, in ``pos`` order (L4).

    Newer rows after an old one are lost too. The first old position is an
    aggregate joined back, not a window over the whole key. ``df`` is read
    twice and should be a table.
    """
    old = df.where(F.col(ts) < F.lit(oldest))
    first_old = old.groupBy(*keys).agg(F.min(pos).alias("_first_old"))
    marked = df.join(first_old, keys, "left")
    before = F.col("_first_old").isNull() | (F.col(pos) < F.col("_first_old"))
    return marked.where(before).drop("_first_old")


def newest_first_order(ts: str = "created_utc", tie: str = "id") -> list[Column]:
    return [F.desc(ts), F.asc(tie)]


def newest_per_group(
    df: DataFrame, group: str, n: int = PER_GROUP, ts: str = "created_utc", tie: str = "id"
) -> DataFrame:
    """The ``n`` newest rows per group, ties by id, with ``rank``."""
    return top_per_group(df, [group], newest_first_order(ts, tie), n, rank="rank")


def global_budget(
    ranked: DataFrame,
    group: str,
    priority: tuple[str, ...] = TARGET_GROUPS,
    per_group: int = PER_GROUP,
    total: int = TOTAL,
) -> DataFrame:
    """Shares ``total`` among groups in ``priority`` order.

    Each takes up to ``per_group``, or what is left. ``ranked`` comes from
    :func:`newest_per_group`. Serving one group after the other, newest first,
    is taking the first ``total`` rows by group position and rank: one top-n,
    without counting or joining.
    """
    position = F.array_position(F.lit(list(priority)), F.col(group))
    served = ranked.where((F.col("rank") <= per_group) & (position > 0))
    return served.orderBy(position, "rank").limit(total)


def split_budget(items: DataFrame, max_items: int = MAX_ITEMS, user: str = "username") -> DataFrame:
    """Newest submissions and comments within one budget per user.

    Submissions take at most half (the larger half); comments take what the
    submissions left. Unused comment budget does not go back.
    """
    if max_items <= 0:
        return items.limit(0)
    half = (max_items + 1) // 2
    known = items.where(F.col("kind").isin("submission", "comment"))
    ranked = top_per_group(known, [user, "kind"], newest_first_order(), max_items)
    # At most 2 * max_items rows per user from here on.
    submissions = F.count_if(F.col("kind") == "submission").over(Window.partitionBy(user))
    allowed = F.when(F.col("kind") == "submission", F.lit(half)).otherwise(
        F.lit(max_items) - F.least(submissions, F.lit(half))
    )
    return ranked.withColumn("_allowed", allowed).where("_rank <= _allowed").drop("_rank", "_allowed")


def newest_first(items: DataFrame, user: str = "username") -> DataFrame:
    """Rows ordered by user, newest first.

    A range-partitioned sort whose key includes time and id, so a frequent
    user spans several partitions.
    """
    return items.orderBy(user, *newest_first_order())


def newest_first_rank(items: DataFrame, user: str = "username") -> DataFrame:
    """Adds each item's ``rank`` in its user's newest-first order.

    Rows are range-partitioned by user, time and id, and written so that their
    ranges stay as they are. Rank = the user's rows in earlier ranges + rank
    within the range. A user may span any number of ranges, whether or not its
    times differ, and no window holds more than one range.
    """
    order = newest_first_order()
    ranges = items.repartitionByRange(user, *order).withColumn("_range", F.spark_partition_id())
    placed = staged(ranges, "ranges")
    before = Window.partitionBy(user).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(user, "_range")
        .agg(F.count("*").alias("_n"))
        .select(user, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    within = F.row_number().over(Window.partitionBy(user, "_range").orderBy(*order))
    offsets = offsets.withColumnsRenamed({user: "_user", "_range": "_of"})
    # Null users are a group like any other.
    same = F.col(user).eqNullSafe(F.col("_user")) & (F.col("_range") == F.col("_of"))
    ranked = placed.withColumn("_within", within).join(offsets, same, "left")
    return ranked.withColumn("rank", F.col("_before") + F.col("_within")).drop(
        "_range", "_before", "_within", "_user", "_of"
    )


def unique_authors(posts: DataFrame) -> DataFrame:
    """Distinct non-empty authors as ``username``."""
    return posts.select(F.col("author").alias("username")).where("username != ''").distinct()


def authors_to_fetch(authors: DataFrame, existing: DataFrame) -> DataFrame:
    """Authors without history so far (L10). Both sides hold a user once."""
    return authors.join(existing.select("username"), "username", "left_anti")


def merge_new_wins(
    existing: DataFrame,
    new: DataFrame,
    new_keys: DataFrame,
    key: str = "username",
) -> DataFrame:
    """``existing`` with every user of ``new_keys`` replaced whole by ``new``.

    Keys come from the user table: a user fetched again without items wins too.
    """
    return existing.join(new_keys.select(key), key, "left_anti").unionByName(new)


def attach_history(authors: DataFrame, items: DataFrame) -> DataFrame:
    """Authors left outer join items; authors without items stay.

    Written as items of these authors plus authors without items, since an
    outer join cannot split a frequent key on its nullable side.
    """
    own = items.join(authors.select("username"), "username", "left_semi")
    idle = authors.join(items.select("username").distinct(), "username", "left_anti")
    return own.unionByName(idle, allowMissingColumns=True)


def top_risky(scored: DataFrame, n: int = 5) -> DataFrame:
    """Highest scores first, ties by id."""
    return scored.orderBy(F.desc("risk_score"), "id").limit(n)


def in_groups(
    df: DataFrame, groups: tuple[str, ...] = TARGET_GROUPS, group: str = "subreddit"
) -> DataFrame:
    """Rows of the listed groups."""
    return df.where(F.col(group).isin(*groups))
