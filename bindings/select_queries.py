"""Filters, budgets, ordering, history selection (L1-L12, L14) and stage counts (R2)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from bindings import sql, tables
from bindings.registry import query
from riskloom.operators import report, select

A = f"WITH {sql.ACTIVITY}"
CUTOFF = select.cutoff(tables.AS_OF)


@query(
    "l1_drop_promoted",
    """SELECT event_id, event_type FROM events
    WHERE NOT (event_type = 'click' AND event_id % 2 = 0)""",
)
def drop_promoted(spark, sf):
    mark = F.when(F.col("event_type") == "click", F.when(F.col("event_id") % 2 == 0, "true").otherwise("True"))
    marked = tables.read(spark, sf, "events").withColumn("promoted", mark)
    return select.drop_promoted(marked).select("event_id", "event_type")


@query(
    "l2_drop_invalid",
    f"{A} SELECT id, created_utc FROM activity WHERE CAST(id AS BIGINT) % 7 <> 0 AND CAST(id AS BIGINT) % 5 <> 0",
)
def drop_invalid(spark, sf):
    number = F.col("id").cast("long")
    df = tables.activity(spark, sf).select(
        F.when(number % 7 != 0, F.col("id")).alias("id"),
        F.when(number % 5 != 0, F.col("created_utc")).alias("created_utc"),
    )
    return select.drop_invalid(df)


@query(
    "l3_lookback",
    f"{A} SELECT id, username, created_utc FROM activity WHERE created_utc >= {CUTOFF}e0",
)
def lookback(spark, sf):
    recent = select.lookback(tables.activity(spark, sf), tables.AS_OF)
    return recent.select("id", "username", "created_utc")


@query(
    "l4_prefix_until_old",
    f"""{A}, p AS (SELECT *, CAST(id AS BIGINT) * 7919 % 10007 AS pos FROM activity),
    f AS (SELECT username, min(pos) AS first_old FROM p WHERE created_utc < {CUTOFF - 15 * 86400}e0 GROUP BY username)
    SELECT id, username, pos FROM p LEFT JOIN f USING (username) WHERE first_old IS NULL OR pos < first_old""",
)
def prefix_until_old(spark, sf):
    """Events in a scrambled page order; at some position the first old one ends a user."""
    pos = F.col("id").cast("long") * 7919 % 10007
    df = tables.activity(spark, sf).withColumn("pos", pos)
    oldest = select.cutoff(tables.AS_OF - dt.timedelta(days=15))
    kept = select.prefix_until_old(df, ["username"], "pos", oldest)
    return kept.select("id", "username", "pos")


RANKED = """r AS (SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY created_utc DESC, id) AS rank FROM activity)"""


@query(
    "l5_newest_per_group",
    f"{A}, {RANKED} SELECT id, subreddit, created_utc, rank FROM r WHERE rank <= 30",
)
def newest_per_group(spark, sf):
    newest = select.newest_per_group(tables.activity(spark, sf), "subreddit")
    return newest.select("id", "subreddit", "created_utc", "rank")


PRIORITY = ("error", "signup", "view", "purchase", "click")


@query(
    "l6_global_budget",
    f"""{A}, {RANKED}, o(subreddit, pos) AS (VALUES {', '.join(f"('{g}', {i})" for i, g in enumerate(PRIORITY))}),
    n AS (SELECT subreddit, pos, least(count(*), 30) AS n FROM r JOIN o USING (subreddit) GROUP BY ALL),
    s AS (SELECT subreddit, least(30, 100 - coalesce(sum(n) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS share FROM n)
    SELECT id, subreddit, rank FROM r JOIN s USING (subreddit) WHERE rank <= share""",
)
def global_budget(spark, sf):
    newest = select.newest_per_group(tables.activity(spark, sf), "subreddit")
    taken = select.global_budget(newest, "subreddit", PRIORITY, total=100)
    return taken.select("id", "subreddit", "rank")


def budget_sql(source: str, max_items: int) -> str:
    half = (max_items + 1) // 2
    return f"""b1 AS (SELECT *, row_number() OVER (PARTITION BY username, kind ORDER BY created_utc DESC, id) AS rn,
      count(*) FILTER (kind = 'submission') OVER (PARTITION BY username) AS subs FROM {source}),
    budgeted AS (SELECT * FROM b1
      WHERE rn <= CASE WHEN kind = 'submission' THEN {half} ELSE {max_items} - least(subs, {half}) END)"""


for _max in (7, 100):

    @query(
        f"l7_split_budget_{_max}",
        f"{A}, {budget_sql('activity', _max)} SELECT id, username, kind FROM budgeted",
    )
    def split_budget(spark, sf, max_items=_max):
        kept = select.split_budget(tables.activity(spark, sf), max_items)
        return kept.select("id", "username", "kind")


@query(
    "l8_newest_first_rank",
    f"""{A} SELECT id, username, row_number() OVER (PARTITION BY username ORDER BY created_utc DESC, id) AS rank
    FROM activity""",
)
def newest_first_rank(spark, sf):
    ranked = select.newest_first_rank(tables.activity(spark, sf))
    return ranked.select("id", "username", "rank")


@query("l8_newest_first", f"{A} SELECT id, username, created_utc FROM activity")
def newest_first(spark, sf):
    return select.newest_first(tables.activity(spark, sf).select("id", "username", "created_utc"))


@query("l9_unique_authors", f"WITH {sql.POSTS} SELECT DISTINCT author AS username FROM posts WHERE author <> ''")
def unique_authors(spark, sf):
    return select.unique_authors(tables.posts(spark, sf))


@query(
    "l10_authors_to_fetch",
    f"""WITH {sql.POSTS}, {sql.ITEMS}
    SELECT DISTINCT author AS username FROM posts WHERE author NOT IN (SELECT username FROM items)""",
)
def authors_to_fetch(spark, sf):
    known = tables.items(spark, sf).select("username").distinct()
    return select.authors_to_fetch(select.unique_authors(tables.posts(spark, sf)), known)


@query(
    "l11_merge_new_wins",
    f"""WITH {sql.ITEMS}, {sql.ACTIVITY}, new_users AS (
      SELECT DISTINCT username FROM activity WHERE CAST(substr(username, 2) AS INT) % 3 = 0),
    new AS (SELECT id, username FROM activity
      WHERE username IN (SELECT username FROM new_users) AND CAST(substr(username, 2) AS INT) % 2 = 0)
    SELECT id, username FROM items WHERE username NOT IN (SELECT username FROM new_users)
    UNION ALL SELECT id, username FROM new""",
)
def merge_new_wins(spark, sf):
    """Every third active user is fetched again; the odd ones of them without items."""
    number = F.substring("username", 2, 10).cast("int")
    active = tables.activity(spark, sf).where(number % 3 == 0).select("id", "username")
    existing = tables.items(spark, sf).select("id", "username")
    fetched = active.select("username").distinct()
    return select.merge_new_wins(existing, active.where(number % 2 == 0), fetched)


@query(
    "l12_attach_history",
    f"""WITH {sql.POSTS}, {sql.ITEMS}, a AS (SELECT DISTINCT author AS username FROM posts)
    SELECT username, id, kind FROM a LEFT JOIN items USING (username)""",
)
def attach_history(spark, sf):
    authors = select.unique_authors(tables.posts(spark, sf))
    items = tables.items(spark, sf).select("username", "id", "kind")
    return select.attach_history(authors, items)


@query(
    "l14_in_groups",
    f"WITH {sql.POSTS} SELECT id, subreddit FROM posts WHERE subreddit IN ('src1', 'src3', 'src19')",
)
def in_groups(spark, sf):
    wanted = select.in_groups(tables.posts(spark, sf), ("src1", "src3", "src19"))
    return wanted.select("id", "subreddit")


@query("r2_posts_per_group", f"WITH {sql.POSTS} SELECT subreddit, count(*) AS posts FROM posts GROUP BY subreddit")
def posts_per_group(spark, sf):
    return report.posts_per_group(tables.posts(spark, sf))


@query(
    "r2_author_coverage",
    f"""WITH {sql.POSTS}, {sql.ITEMS}, a AS (SELECT DISTINCT author AS username FROM posts)
    SELECT count(*) AS authors, count(*) FILTER (username IN (SELECT username FROM items)) AS known,
      count(*) FILTER (username NOT IN (SELECT username FROM items)) AS to_fetch FROM a""",
)
def author_coverage(spark, sf):
    authors = select.unique_authors(tables.posts(spark, sf))
    return report.author_coverage(authors, tables.items(spark, sf))


@query(
    "r2_items_per_user",
    f"""WITH {sql.USERS}, {sql.ITEMS}
    SELECT username, count(id) AS items FROM users LEFT JOIN items USING (username) GROUP BY username""",
)
def items_per_user(spark, sf):
    return report.items_per_user(tables.users(spark, sf), tables.items(spark, sf))
