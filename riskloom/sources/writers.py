"""Writers for posts, histories and scored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from riskloom.functions.features import fixed
from riskloom.operators.select import newest_first_rank
from riskloom.schemas import HISTORY, ITEM, SCORED_POST_COLUMNS, USER_RISK_COLUMNS, USERS
from riskloom.sources.staging import remove_path

# Items per line of the nested history export.
ITEMS_PER_LINE = 1000


def write_posts(posts: DataFrame, path: str) -> None:
    """Posts as JSON lines in UTF-8 (S5). Null fields are written as nulls."""
    posts.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_history(users: DataFrame, items: DataFrame, path: str) -> None:
    """Flat user and item tables (S6); users without items are kept."""
    users.select(*USERS.names).write.mode("overwrite").parquet(f"{path}/users")
    items.select(*HISTORY.names).write.mode("overwrite").parquet(f"{path}/items")


def nest_history(
    users: DataFrame, items: DataFrame, items_per_line: int = ITEMS_PER_LINE
) -> DataFrame:
    """(username, part, items) with items newest first, for interchange.

    A part holds ``items_per_line`` items, the last one of a user what is left;
    a user's parts in order are the user's items newest first. No array grows
    with the user. Users without items have one empty part, number 0.
    """
    ranked = newest_first_rank(items.select(*HISTORY.names))
    part = F.floor((F.col("rank") - 1) / items_per_line).cast("int")
    placed = ranked.withColumn("part", part)
    entry = F.struct("rank", *ITEM.names)
    nested = placed.groupBy("username", "part").agg(F.sort_array(F.collect_list(entry)).alias("_i"))
    item = F.transform("_i", lambda i: F.struct(*(i[n].alias(n) for n in ITEM.names)))
    nested = nested.select("username", "part", item.alias("items"))
    none = F.array().cast(f"array<{ITEM.simpleString()}>")
    return users.join(nested, "username", "left").select(
        "username",
        F.coalesce("part", F.lit(0)).alias("part"),
        F.coalesce("items", none).alias("items"),
    )


def write_history_nested(users: DataFrame, items: DataFrame, path: str) -> None:
    nest_history(users, items).write.mode("overwrite").json(path)


def write_scored_posts_jsonl(scored: DataFrame, path: str) -> None:
    """Scored posts as JSON lines with nested features."""
    rows = scored.select(*SCORED_POST_COLUMNS)
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def scored_post_csv_rows(scored: DataFrame) -> DataFrame:
    """The twelve CSV columns in order, features as a JSON string."""
    return scored.select(*SCORED_POST_COLUMNS).withColumn(
        "risk_features", F.to_json("risk_features")
    )


def write_scored_posts_csv(scored: DataFrame, path: str) -> bool:
    """Scored posts as CSV with header (S8); nothing is left without rows.

    Rows are counted as they are written, so the scores are computed once.
    """
    seen = Observation()
    rows = scored_post_csv_rows(scored).observe(seen, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    if not seen.get["rows"]:
        remove_path(scored.sparkSession, path)
    return seen.get["rows"] > 0


def scored_user_csv_rows(users: DataFrame) -> DataFrame:
    """The eight CSV columns in order, floats with four decimals."""
    floats = {c: fixed(F.col(c), "0.0000") for c in ("score", "max_post_score", "average_score")}
    return users.select(*USER_RISK_COLUMNS).withColumns(floats)


def write_scored_users_csv(users: DataFrame, path: str) -> None:
    """Scored users as CSV with header."""
    rows = scored_user_csv_rows(users)
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_scored_users_jsonl(users: DataFrame, path: str) -> None:
    """Scored users as JSON lines in full precision."""
    users.select(*USER_RISK_COLUMNS).write.mode("overwrite").json(path)
