"""User risk from item scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.features import fixed, label
from riskloom.model import DEFAULT_MODEL, RiskModel
from riskloom.operators.posts import score_items
from riskloom.schemas import USER_RISK_COLUMNS

# Fixed values.
MIN_CONFIDENT_ITEMS = 5
HIGH_POST_FACTOR = 0.2
NO_ACTIVITY = (
    "No historical activity or scored posts found for this user; user_score set to 0.00 (low)."
)
FROM_HISTORY = "derived from historical activity only (last window)."
FROM_POSTS = "no user history found; score derived from current scored posts only."
# Scores are summed as decimals, so that the mean does not depend on row order.
SUM_TYPE = "decimal(28,12)"

_STATS = ("max_post_score", "average_score", "count_high_posts", "total_posts")


def stats_columns(score: str = "score", high: float = DEFAULT_MODEL.high) -> list[Column]:
    """Maximum, mean, number of high scores, number of scores (U4)."""
    value = F.col(score)
    return [
        F.max(value).alias("max_post_score"),
        (F.sum(value.cast(SUM_TYPE)).cast("double") / F.count(value)).alias("average_score"),
        F.count_if(value >= F.lit(high)).alias("count_high_posts"),
        F.count(value).alias("total_posts"),
    ]


def user_stats(
    scores: DataFrame, user: str = "username", high: float = DEFAULT_MODEL.high
) -> DataFrame:
    """One row of :func:`stats_columns` per user (U4).

    Every aggregate combines before the shuffle: a user with a third of the
    items costs the final task one row per map task.
    """
    return scores.groupBy(user).agg(*stats_columns(high=high))


def user_score(maximum: Column, mean: Column, n_high: Column) -> Column:
    """max(maximum, mean + 0.2 ln(1 + high posts)); may exceed 1."""
    raised = mean + F.lit(HIGH_POST_FACTOR) * F.log(F.lit(1) + n_high)
    return F.greatest(maximum, raised)


def fallback_scores(scored: DataFrame, score: str = "risk_score") -> DataFrame:
    """Flat (author, score) of usable rows: named author, numeric score."""
    value = F.col(score).try_cast("double")
    usable = scored.select("author", value.alias("score"))
    return usable.where("author != '' and score is not null")


def with_fallback(
    users: DataFrame,
    item_scores: DataFrame,
    fallback: DataFrame,
) -> DataFrame:
    """(username, score, from_posts): item scores, or post scores of users without.

    Both joins are semi joins with the frequent side on the left, which adaptive
    execution splits by rows, whether or not their scores differ.
    """
    posts = fallback.select(F.col("author").alias("username"), "score")
    idle = users.join(item_scores.select("username").distinct(), "username", "left_anti")
    used = posts.join(idle, "username", "left_semi")
    own = item_scores.select("username", "score").join(users, "username", "left_semi")
    return own.withColumn("from_posts", F.lit(False)).unionByName(
        used.withColumn("from_posts", F.lit(True))
    )


def user_explanation(min_confident: int = MIN_CONFIDENT_ITEMS) -> Column:
    """Counts, scores, provenance and low-confidence note (U8)."""
    total = F.col("total_posts").cast("string")
    text = F.concat_ws(
        "; ",
        F.concat(
            F.col("count_high_posts").cast("string"),
            F.lit(" high-risk posts out of "),
            total,
            F.lit(" items"),
        ),
        F.concat(F.lit("max_post_score="), fixed(F.col("max_post_score"))),
        F.concat(
            F.lit("user_score="), fixed(F.col("score")), F.lit(" ("), F.col("label"), F.lit(")")
        ),
        F.when(F.col("_from_posts"), F.lit(FROM_POSTS)).otherwise(FROM_HISTORY),
        F.when(
            F.col("total_posts") < min_confident,
            F.concat(F.lit("low-confidence estimate (only "), total, F.lit(" items available).")),
        ),
    )
    return F.when(F.col("total_posts") == 0, F.lit(NO_ACTIVITY)).otherwise(text)


def risk_of_stats(
    stats: DataFrame, high: float, medium: float, min_confident: int = MIN_CONFIDENT_ITEMS
) -> DataFrame:
    """User score, label and explanation of per-user stats."""
    score = user_score(*(F.col(c) for c in _STATS[:3]))
    df = stats.withColumn("score", F.when(F.col("total_posts") > 0, score).otherwise(0.0))
    df = df.withColumn("label", label(F.col("score"), high, medium))
    return df.withColumn("explanation", user_explanation(min_confident)).select(*USER_RISK_COLUMNS)


def score_users_from_stats(
    users: DataFrame,
    own: DataFrame,
    fallback: DataFrame | None = None,
    *,
    high: float = DEFAULT_MODEL.high,
    medium: float = DEFAULT_MODEL.medium,
    min_confident: int = MIN_CONFIDENT_ITEMS,
) -> DataFrame:
    """User risk for each of ``users`` from their stats, one row per user.

    ``own`` has the columns of :func:`user_stats`, as has what ``fallback(author, score)``
    is reduced to: no join sees a frequent user, and the fallback choice is made on those
    rows.
    """
    joined = users.select("username").distinct().join(own, "username", "left")
    joined = joined.withColumn("_from_posts", F.lit(False))
    if fallback is not None:
        posts = user_stats(fallback.withColumnRenamed("author", "username"), high=high)
        posts = posts.select("username", *(F.col(c).alias(f"_{c}") for c in _STATS))
        idle = F.col("total_posts").isNull()
        joined = joined.join(posts, "username", "left").withColumns(
            {
                **{c: F.when(idle, F.col(f"_{c}")).otherwise(F.col(c)) for c in _STATS},
                "_from_posts": idle & F.col("_total_posts").isNotNull(),
            }
        )
    filled = joined.fillna(0, subset=list(_STATS))
    return risk_of_stats(filled, high, medium, min_confident)


def score_users_from_scores(
    users: DataFrame,
    item_scores: DataFrame,
    fallback: DataFrame | None = None,
    *,
    high: float = DEFAULT_MODEL.high,
    medium: float = DEFAULT_MODEL.medium,
    min_confident: int = MIN_CONFIDENT_ITEMS,
) -> DataFrame:
    """User risk for each of ``users`` from (username, score) rows."""
    own = user_stats(item_scores, high=high)
    return score_users_from_stats(
        users, own, fallback, high=high, medium=medium, min_confident=min_confident
    )


def score_users(
    users: DataFrame,
    items: DataFrame,
    fallback: DataFrame | None = None,
    model: RiskModel = DEFAULT_MODEL,
    min_confident: int = MIN_CONFIDENT_ITEMS,
) -> DataFrame:
    """User risk from history items, scored with ``model``.

    The result covers exactly ``users``; ``fallback(author, score)`` counts
    only for those without items.
    """
    return score_users_from_scores(
        users,
        score_items(items, model),
        fallback,
        high=model.high,
        medium=model.medium,
        min_confident=min_confident,
    )
