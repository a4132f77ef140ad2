"""User scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import sql, tables
from bindings.registry import query
from riskloom.operators import posts, stats, users
from riskloom.sources import writers
from riskloom.sources.staging import fresh_path, staged

MODEL = tables.CALIBRATED
ITEM_SCORES = f"{sql.ITEMS}, u_posts AS (SELECT *, '' AS title FROM items), {sql.scored('u_posts', MODEL, 'si')}, own AS (SELECT username, id, risk_score AS score FROM si)"
POST_SCORES = f"{sql.POSTS}, {sql.scored('posts', MODEL, 'sp')}, posted AS (SELECT author AS username, risk_score AS score FROM sp)"


@query(
    "u1_items_as_posts",
    f"WITH {sql.ITEMS} SELECT id, url, subreddit, author, '' AS title, text, created_utc, CAST(NULL AS VARCHAR) AS language FROM items",
)
def items_as_posts(spark, sf):
    return posts.items_as_posts(tables.items(spark, sf)).select(
        "id", "url", "subreddit", "author", "title", "text", "created_utc", "language"
    )


@query("u2_score_items", f"WITH {ITEM_SCORES} SELECT username, id, score FROM own")
def score_items(spark, sf):
    return posts.score_items(tables.items(spark, sf), MODEL)


def item_scores(spark, sf):
    return posts.score_items(tables.items(spark, sf), MODEL)


def post_scores(spark, sf):
    scored = posts.score_posts(tables.posts(spark, sf), MODEL)
    return users.fallback_scores(scored.select("author", "risk_score"))


@query(
    "u3_with_fallback",
    f"""WITH {sql.USERS}, {ITEM_SCORES}, {POST_SCORES}
    SELECT username, score, false AS from_posts FROM own WHERE username IN (SELECT username FROM users)
    UNION ALL
    SELECT username, score, true FROM posted
    WHERE username IN (SELECT username FROM users) AND username NOT IN (SELECT username FROM own)""",
)
def with_fallback(spark, sf):
    own, posted = item_scores(spark, sf), post_scores(spark, sf)
    return users.with_fallback(
        tables.users(spark, sf), staged(own, "u3-items"), staged(posted, "u3-posts")
    )


@query("u4_user_stats", f"WITH {sql.ACTIVITY} SELECT username, {sql.stats()} FROM activity GROUP BY username")
def user_stats(spark, sf):
    return users.user_stats(tables.activity(spark, sf))


ACTIVE_RISK = f"WITH {sql.ACTIVITY}, au AS (SELECT DISTINCT username FROM activity), {sql.user_risk('au', 'activity', None)}"


def active_risk(spark, sf):
    activity = tables.activity(spark, sf).select("username", "score")
    return users.score_users_from_scores(activity.select("username").distinct(), activity)


@query("u5_user_score", f"{ACTIVE_RISK} SELECT username, score FROM risk")
def user_score(spark, sf):
    return active_risk(spark, sf).select("username", "score")


@query("u6_user_label", f"{ACTIVE_RISK} SELECT username, label FROM risk")
def user_label(spark, sf):
    return active_risk(spark, sf).select("username", "label")


FULL = f"WITH {sql.USERS}, {ITEM_SCORES}, {POST_SCORES}, {sql.user_risk('users', 'own', 'posted')}"


@query("u7_no_activity", f"{FULL} SELECT {sql.USER_COLUMNS} FROM risk WHERE total_posts = 0")
def no_activity(spark, sf):
    return score_users(spark, sf).where("total_posts = 0")


@query("u8_user_explanation", f"{FULL} SELECT username, explanation FROM risk")
def user_explanation(spark, sf):
    return score_users(spark, sf).select("username", "explanation")


@query("u9_score_users", f"{FULL} SELECT {sql.USER_COLUMNS} FROM risk")
def score_users(spark, sf):
    return users.score_users(
        tables.users(spark, sf), tables.items(spark, sf), post_scores(spark, sf), MODEL
    )


@query("u9_incremental", f"{FULL} SELECT {sql.USER_COLUMNS} FROM risk")
def incremental(spark, sf):
    """Stats kept over three deliveries; every fifth user is fetched again in the last.

    What those users had before is other items (all of them twice), so that not taking
    them back would show.
    """
    scored = staged(item_scores(spark, sf), "scores")
    number = F.substring("username", 2, 10).cast("int")
    part = F.substring_index("id", ":", 1).cast("long") % 3
    fetched = number % 5 == 0
    store = stats.stats_store(spark, fresh_path(spark, "stats"), buckets=8)
    once = scored.where(~fetched)
    stats.add_to_stats(store, once.where(part == 0).unionByName(scored.where(fetched)), high=MODEL.high)
    stats.add_to_stats(store, once.where(part == 1).unionByName(scored.where(fetched)), high=MODEL.high)
    again = tables.users(spark, sf).where(fetched)
    last = once.where(part == 2).unionByName(scored.where(fetched))
    stats.add_to_stats(store, last, again, high=MODEL.high)
    return users.score_users_from_stats(
        tables.users(spark, sf), stats.stats_of(store), post_scores(spark, sf), high=MODEL.high, medium=MODEL.medium
    )


@query(
    "u9_score_users_default",
    f"""WITH {sql.USERS}, {sql.ITEMS}, u_posts AS (SELECT *, '' AS title FROM items),
    {sql.scored('u_posts', tables.DEFAULT_MODEL, 'si')}, own AS (SELECT username, id, risk_score AS score FROM si),
    {sql.user_risk('users', 'own', None)} SELECT {sql.USER_COLUMNS} FROM risk""",
)
def score_users_default(spark, sf):
    return users.score_users(tables.users(spark, sf), tables.items(spark, sf))


@query("u10_fallback_scores", f"WITH {POST_SCORES} SELECT username AS author, score FROM posted WHERE username <> ''")
def fallback_scores(spark, sf):
    return post_scores(spark, sf)


@query(
    "s9_scored_user_csv_rows",
    f"""{ACTIVE_RISK} SELECT username, printf('%.4f', score) AS score, label,
      printf('%.4f', max_post_score) AS max_post_score, printf('%.4f', average_score) AS average_score,
      count_high_posts, total_posts, explanation FROM risk""",
)
def scored_user_csv_rows(spark, sf):
    return writers.scored_user_csv_rows(active_risk(spark, sf))


@query(
    "s9_scored_users_csv",
    f"""{ACTIVE_RISK} SELECT username, printf('%.4f', score) AS score, label,
      printf('%.4f', max_post_score) AS max_post_score, printf('%.4f', average_score) AS average_score,
      CAST(count_high_posts AS VARCHAR) AS count_high_posts, CAST(total_posts AS VARCHAR) AS total_posts,
      explanation FROM risk""",
)
def scored_users_csv(spark, sf):
    """The rows written as CSV and read back as text."""
    path = fresh_path(spark, "users-csv")
    writers.write_scored_users_csv(active_risk(spark, sf), path)
    return spark.read.csv(path, header=True, escape='"')
