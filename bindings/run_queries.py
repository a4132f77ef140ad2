"""Jobs (J1-J5) and streams."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from bindings import sql, tables
from bindings.post_queries import FULL_DETECTED
from bindings.registry import query
from bindings.select_queries import budget_sql
from bindings.source_queries import (
    CHAINED,
    CHAINED_ITEMS,
    EXTRACTED,
    SCORED,
    chained_items,
    chained_posts,
)
from riskloom.functions import text as tx
from riskloom.operators.pages import extract_posts
from riskloom.operators.select import cutoff, global_budget
from riskloom.plans import jobs
from riskloom.plans.restart import resumable_run
from riskloom.schemas import POST
from riskloom.sources.staging import fresh_path
from riskloom.streaming import flows

GROUPS = ("src3", "src1", "src17", "src0", "src9", "src5")
# Within the span of the conversations, so that the lookback cuts some of them.
CONFIG = jobs.RunConfig(
    as_of=dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc) + dt.timedelta(hours=6),
    groups=GROUPS,
    total=130,
    lookback_days=1,
    max_items=6,
    model=tables.CALIBRATED,
)
OLDEST = cutoff(CONFIG.as_of, CONFIG.lookback_days)

COLLECTED = f"""{EXTRACTED},
ord(subreddit, pos) AS (VALUES {', '.join(f"('{g}', {i})" for i, g in enumerate(GROUPS))}),
rk AS (SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY created_utc DESC, id) AS rank
  FROM extracted JOIN ord USING (subreddit)),
cnt AS (SELECT subreddit, pos, least(count(*), 30) AS n FROM rk GROUP BY ALL),
shr AS (SELECT subreddit, least(30, 130 - coalesce(sum(n) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS share FROM cnt),
collected AS (SELECT id, url, subreddit, author, title, text, created_utc, language FROM rk JOIN shr USING (subreddit) WHERE rank <= share)"""

AUTHORS = "authors AS (SELECT DISTINCT author AS username FROM collected)"


def fetched_sql(users: str) -> str:
    """CTEs: what fetching the history of ``users(username)`` finds, as ``budgeted``."""
    return f"""xi AS (SELECT username, replace(id, ':', '-') AS id, 'https://forum.example/x' AS url, subreddit,
    username AS author, kind, {sql.strip('text')} AS text, created_utc
  FROM items WHERE username IN (SELECT username FROM {users}) AND created_utc >= {OLDEST}e0),
{budget_sql('xi', CONFIG.max_items)}"""


ENRICHED = f"{AUTHORS}, {fetched_sql('authors')}"


def listing_pages(spark, sf):
    return tables.listing_pages(tables.posts(spark, sf))


def user_pages(spark, sf):
    return tables.user_pages(tables.items(spark, sf))


@query("j1_collect", f"WITH {sql.POSTS}, {COLLECTED} SELECT * FROM collected")
def collect(spark, sf):
    return jobs.collect_job(spark, listing_pages(spark, sf), fresh_path(spark, "j1"), CONFIG)


@query(
    "j1_page_errors",
    f"""WITH {sql.POSTS} SELECT subreddit AS group_name, CAST(id AS BIGINT) AS page_no,
      'https://forum.example/l/' || id AS url, 1 AS attempt,
      'NestedTooDeep: more than 64 items are open at once' AS error
    FROM posts WHERE CAST(id AS BIGINT) % 7 = 3 AND subreddit IN ({', '.join(f"'{g}'" for g in GROUPS)})""",
)
def page_errors(spark, sf):
    """Every seventh page opens items without end and is reported, not lost."""
    endless = F.repeat(F.lit('<div class="thing">'), 100)
    pages = listing_pages(spark, sf).withColumn(
        "html", F.when(F.col("page_no") % 7 == 3, endless).otherwise(F.col("html"))
    )
    out = fresh_path(spark, "j1-errors")
    jobs.collect_job(spark, pages, out, CONFIG)
    schema = "group_name string, page_no long, url string, attempt int, error string"
    return spark.read.schema(schema).json(f"{out}/errors")


@query("j1_collect_stream", f"WITH {sql.POSTS}, {COLLECTED} SELECT * FROM collected")
def collect_stream(spark, sf):
    """Posts of landed pages that arrive in deliveries, every fourth of them twice; budgets over what is kept."""
    landing = fresh_path(spark, "j1-landing")
    posts = extract_posts(listing_pages(spark, sf)).select(*POST.names)
    again = F.when(F.xxhash64("id") % 4 == 0, 2).otherwise(1)
    landed = posts.select("*", F.explode(F.sequence(F.lit(1), again)).alias("copy"))
    landed.repartition(6, "id", "copy").select(*POST.names).write.parquet(landing)
    stream = flows.stream_table(spark, landing, POST, maxFilesPerTrigger=2)
    newest = flows.newest_stream(
        spark, stream, fresh_path(spark, "j1-stream"), CONFIG.per_group, buckets=8
    )
    kept = global_budget(newest, "subreddit", GROUPS, CONFIG.per_group, CONFIG.total)
    return kept.select(*POST.names)


J2_SQL = f"""WITH {sql.POSTS}, {sql.ITEMS}, {COLLECTED}, {ENRICHED}
    SELECT a.username, id, kind, text, created_utc FROM authors a LEFT JOIN budgeted USING (username)"""


@query("j2_enrich_stop_at_old", J2_SQL)
def enrich_stop_at_old(spark, sf):
    """Newest-first pages, read up to the first item older than the lookback."""
    posts = jobs.collect(listing_pages(spark, sf), CONFIG)
    newest_first = F.lit(1 << 40) - F.col("created_utc").cast("long")
    items = tables.items(spark, sf).withColumn("_page", newest_first)
    pages = tables.user_pages(items, page_no=F.col("_page"))
    users, items = jobs.enrich_job(
        spark, posts, pages, None, fresh_path(spark, "j2"), replace(CONFIG, stop_at_old=True)
    )
    return users.join(items.select("username", "id", "kind", "text", "created_utc"), "username", "left")


@query(
    "j2_items_per_user",
    f"""WITH {sql.POSTS}, {sql.ITEMS}, {COLLECTED}, {ENRICHED}
    SELECT a.username, count(id) AS items FROM authors a LEFT JOIN budgeted USING (username) GROUP BY a.username""",
)
def items_per_user(spark, sf):
    posts = jobs.collect(listing_pages(spark, sf), CONFIG)
    out = fresh_path(spark, "j2")
    jobs.enrich_job(spark, posts, user_pages(spark, sf), None, out, CONFIG)
    return spark.read.schema("username string, items long").json(f"{out}/items_per_user")


@query(
    "j2_enrich",
    f"""WITH {sql.POSTS}, {sql.ITEMS}, {COLLECTED}, {ENRICHED}
    SELECT a.username, id, kind, text, created_utc FROM authors a LEFT JOIN budgeted USING (username)""",
)
def enrich(spark, sf):
    posts = jobs.collect(listing_pages(spark, sf), CONFIG)
    users, items = jobs.enrich_job(
        spark, posts, user_pages(spark, sf), None, fresh_path(spark, "j2"), CONFIG
    )
    return users.join(items.select("username", "id", "kind", "text", "created_utc"), "username", "left")


@query(
    "j2_enrich_again",
    f"""WITH {sql.POSTS}, {sql.ITEMS}, {COLLECTED}, {ENRICHED},
    known AS (SELECT DISTINCT author AS username FROM posts WHERE CAST(substr(author, 2) AS INT) % 3 = 0)
    SELECT username, NULL AS id FROM known
    UNION ALL
    SELECT a.username, id FROM authors a LEFT JOIN budgeted USING (username)
    WHERE a.username NOT IN (SELECT username FROM known)""",
)
def enrich_again(spark, sf):
    """Known users (here all without items) are kept as they are and not fetched."""
    posts = jobs.collect(listing_pages(spark, sf), CONFIG)
    known = tables.posts(spark, sf).select(F.col("author").alias("username")).distinct()
    known = known.where(F.substring("username", 2, 10).try_cast("int") % 3 == 0)
    no_items = tables.items(spark, sf).where(F.lit(False))
    users, items = jobs.enrich_job(
        spark, posts, user_pages(spark, sf), (known, no_items), fresh_path(spark, "j2"), CONFIG
    )
    return users.join(items.select("username", "id"), "username", "left")


CHAINED_COLLECTED = COLLECTED.replace(EXTRACTED, CHAINED)


@query("j1_collect_chained", f"WITH {sql.POSTS}, {CHAINED_COLLECTED} SELECT * FROM collected")
def collect_chained(spark, sf):
    """Pages without numbers: their links order them, and a lost page ends its listing."""
    return jobs.collect_job(spark, chained_posts(spark, sf), fresh_path(spark, "j1"), CONFIG)


@query(
    "j2_enrich_chained",
    f"""WITH {sql.POSTS}, items0 AS (SELECT * FROM ({sql.ITEMS.split("AS (", 1)[1].rstrip().removesuffix(")")})),
    {CHAINED_ITEMS.replace("FROM items)", "FROM items0)")},
    items AS (SELECT * FROM paged_items WHERE number % 4 <> 0 AND {sql.REACHED}),
    {COLLECTED}, {ENRICHED}
    SELECT a.username, id, kind, text, created_utc FROM authors a LEFT JOIN budgeted USING (username)""",
)
def enrich_chained(spark, sf):
    """A pinned old item ends a listing at once, a lost page at itself."""
    posts = jobs.collect(listing_pages(spark, sf), CONFIG)
    users, items = jobs.enrich_job(
        spark,
        posts,
        chained_items(spark, sf),
        None,
        fresh_path(spark, "j2"),
        replace(CONFIG, stop_at_old=True),
    )
    return users.join(items.select("username", "id", "kind", "text", "created_utc"), "username", "left")


KNOWN = """known AS (SELECT DISTINCT author AS username FROM posts WHERE CAST(substr(author, 2) AS INT) % 3 = 0),
    again AS (SELECT username FROM known WHERE CAST(substr(username, 2) AS INT) % 9 = 0),
    fetched AS (SELECT username FROM authors EXCEPT SELECT username FROM known UNION SELECT username FROM again)"""


@query(
    "j2_enrich_store",
    f"""WITH {sql.POSTS}, {sql.ITEMS}, {COLLECTED}, {AUTHORS}, {KNOWN}, {fetched_sql('fetched')}
    SELECT username, 'old-' || id AS id, kind, text, created_utc
    FROM (SELECT username FROM known EXCEPT SELECT username FROM fetched) LEFT JOIN items USING (username)
    UNION ALL
    SELECT username, id, kind, text, created_utc FROM fetched LEFT JOIN budgeted USING (username)""",
)
def enrich_store(spark, sf):
    """A bucketed history of users with and without items, of whom some are fetched again."""
    posts = jobs.collect(listing_pages(spark, sf), CONFIG)
    number = F.substring("username", 2, 10).try_cast("int")
    known = tables.posts(spark, sf).select(F.col("author").alias("username")).distinct()
    known = known.where(number % 3 == 0)
    held = tables.items(spark, sf).join(known, "username", "left_semi")
    held = held.withColumn("id", F.concat(F.lit("old-"), "id"))
    store = jobs.history_store(spark, fresh_path(spark, "history"), buckets=8)
    jobs.merge_into_history(store, known, held)
    jobs.enrich_store_job(
        spark,
        posts,
        user_pages(spark, sf),
        store,
        fresh_path(spark, "j2"),
        CONFIG,
        again=known.where(number % 9 == 0),
    )
    items = store.read("items").select("username", "id", "kind", "text", "created_utc")
    return store.read("users").join(items, "username", "left")


@query(
    "j3_score_posts",
    f"{SCORED} SELECT id, risk_score, risk_label, {sql.post_explanation()} AS risk_explanation FROM scored",
)
def score_posts(spark, sf):
    table = jobs.score_posts_job(spark, tables.posts(spark, sf), fresh_path(spark, "j3"), CONFIG)
    return table.select("id", "risk_score", "risk_label", "risk_explanation")


def labelled_texts(spark, sf):
    title = F.substring_index("text", "\n", 1)
    return tables.read(spark, sf, "documents").select(
        "lang", tx.scoring_text(title, F.col("text")).alias("text")
    )


@query(
    "j3_score_posts_language",
    f"""WITH {sql.POSTS}, {sql.scored('posts', CONFIG.model)}, {FULL_DETECTED},
    f AS (SELECT scored.* EXCLUDE (language),
        CASE WHEN length(full_text) < 20 THEN 'unknown' ELSE lb.lang END AS language
      FROM scored LEFT JOIN lb ON lb.doc_id = CAST(id AS BIGINT))
    SELECT id, language, risk_score, {sql.post_explanation('language')} AS risk_explanation FROM f""",
)
def score_posts_language(spark, sf):
    """Profiles trained and written by one job, read and applied by the next."""
    out = fresh_path(spark, "j3")
    profiles = jobs.train_profiles_job(spark, labelled_texts(spark, sf), f"{out}/profiles")
    table = jobs.score_posts_job(spark, tables.posts(spark, sf), f"{out}/posts", CONFIG, profiles)
    return table.select("id", "language", "risk_score", "risk_explanation")


def risk_sql(users: str, items: str, posts: str) -> str:
    return f"""ip AS (SELECT *, '' AS title FROM {items}), {sql.scored('ip', CONFIG.model, 'si')},
    own AS (SELECT username, id, risk_score AS score FROM si),
    {sql.scored(posts, CONFIG.model, 'sp')}, posted AS (SELECT author AS username, risk_score AS score FROM sp),
    {sql.user_risk(users, 'own', 'posted')} SELECT {sql.USER_COLUMNS} FROM risk"""


@query("j4_score_users", f"WITH {sql.USERS}, {sql.ITEMS}, {sql.POSTS}, {risk_sql('users', 'items', 'posts')}")
def score_users(spark, sf):
    out = fresh_path(spark, "j4")
    scored = jobs.score_posts_job(spark, tables.posts(spark, sf), f"{out}/posts", CONFIG)
    return jobs.score_users_job(
        spark, tables.users(spark, sf), tables.items(spark, sf), scored, f"{out}/users", CONFIG
    )


@query(
    "j5_full_run",
    f"WITH {sql.POSTS}, {sql.ITEMS}, {COLLECTED}, {ENRICHED}, {risk_sql('authors', 'budgeted', 'collected')}",
)
def full_run(spark, sf):
    """Landed pages in, user risk out."""
    return jobs.full_run(
        spark, listing_pages(spark, sf), user_pages(spark, sf), fresh_path(spark, "j5"), CONFIG
    )


@query(
    "j5_full_run_language",
    f"""WITH {sql.POSTS}, {COLLECTED}, {sql.scored('collected', CONFIG.model)}, {FULL_DETECTED},
    f AS (SELECT scored.* EXCLUDE (language),
        CASE WHEN length(full_text) < 20 THEN 'unknown' ELSE lb.lang END AS language
      FROM scored LEFT JOIN lb ON lb.doc_id = CAST(id AS BIGINT))
    SELECT id, language, risk_score, {sql.post_explanation('language')} AS risk_explanation FROM f""",
)
def full_run_language(spark, sf):
    """The scored posts of a full run that trains profiles on labelled texts first."""
    out = fresh_path(spark, "j5")
    jobs.full_run(
        spark,
        listing_pages(spark, sf),
        user_pages(spark, sf),
        out,
        CONFIG,
        labelled=labelled_texts(spark, sf),
    )
    scored = spark.read.parquet(f"{out}/scored_posts/table")
    return scored.select("id", "language", "risk_score", "risk_explanation")


@query(
    "j5_restarted_run",
    f"WITH {sql.POSTS}, {sql.ITEMS}, {COLLECTED}, {ENRICHED}, {risk_sql('authors', 'budgeted', 'collected')}",
)
def restarted_run(spark, sf):
    """A run that ends after the history, taken up by another."""
    out = fresh_path(spark, "j5")
    versions = {"listing_pages": sf, "user_pages": sf}
    pages = listing_pages(spark, sf), user_pages(spark, sf)
    resumable_run(spark, *pages, out, CONFIG, versions, until="history")
    return resumable_run(spark, *pages, out, CONFIG, versions)


def table_stream(spark, sf, name):
    # A glob, as a stream's plain path must be a folder and a table may be one file.
    path = f"{sf}/{name}.parquet"
    stream = flows.stream_table(spark, f"{sf}/{name}*.parquet", spark.read.parquet(path).schema)
    return tables.dealt(stream) if name in tables.TEXT_TABLES else stream


@query(
    "t1_stream_scores",
    f"{SCORED} SELECT id, risk_score, risk_label, {sql.post_explanation()} AS risk_explanation FROM scored",
)
def stream_scores(spark, sf):
    stream = table_stream(spark, sf, "documents")
    scored = flows.stream_scores(tables.as_posts(stream), tables.CALIBRATED)
    columns = ["id", "risk_score", "risk_label", "risk_explanation"]
    return flows.drain(spark, scored.select(*columns), "t1")


def event_stream(spark, sf):
    stream = table_stream(spark, sf, "events")
    ts = F.timestamp_micros(tables.micros("ts"))
    return stream.select(
        "event_id",
        tables.numbered("u", F.col("user_id")).alias("username"),
        F.least(F.col("value") / F.lit(100.0), F.lit(1.0)).alias("score"),
        ts.alias("ts"),
    )


@query(
    "t2_deduplicated",
    "SELECT event_id, 'u' || user_id AS username, epoch_us(ts) AS micros FROM events",
)
def deduplicated(spark, sf):
    """Every third event is delivered twice."""
    copies = F.when(F.col("event_id") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    again = event_stream(spark, sf).withColumn("copy", F.explode(copies))
    once = flows.deduplicated(again, ["event_id"])
    return flows.drain(
        spark, once.select("event_id", "username", F.unix_micros("ts").alias("micros")), "t2"
    )


@query(
    "t3_rolling_user_risk",
    f"""WITH {sql.ACTIVITY}, d AS (SELECT *, CAST(floor(created_utc / 86400) AS BIGINT) AS day FROM activity),
    w AS (SELECT username, score, (day - k) * 86400 AS window_start FROM d, (SELECT unnest(range(0, 10)) AS k)),
    s AS (SELECT username, window_start, {sql.stats()} FROM w GROUP BY ALL),
    c AS (SELECT *, window_start + 864000 AS window_end, {sql.USER_SCORE} AS score FROM s)
    SELECT username, window_start, window_end, max_post_score, average_score, count_high_posts, total_posts,
      score, {sql.label('score')} AS label FROM c""",
)
def rolling_user_risk(spark, sf):
    """All windows, those still open at the newest event as they stand."""
    scores = event_stream(spark, sf)
    latest = flows.rolling_risk_stream(spark, scores, fresh_path(spark, "t3"), buckets=8)
    times = {c: F.unix_seconds(c) for c in ("window_start", "window_end")}
    return latest.withColumns(times)


@query(
    "t4_upsert",
    """SELECT user_id, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id % 4 DESC, event_id DESC) = 1""",
)
def upsert(spark, sf):
    """Four deliveries, each over several files; a user's row in a later one wins."""
    landing = fresh_path(spark, "t4-landing")
    rows = tables.read(spark, sf, "events").select("user_id", "event_id", "value")
    landed = rows.withColumn("delivery", F.col("event_id") % 4)
    landed.repartition(8, F.xxhash64("event_id")).write.parquet(landing)
    # The files of all deliveries arrive one by one in no order.
    stream = flows.stream_table(spark, landing, landed.schema, maxFilesPerTrigger=3)
    last = flows.upsert_stream(
        spark, stream, "user_id", "event_id", fresh_path(spark, "t4"), "delivery", buckets=8
    )
    return last.drop("delivery")
