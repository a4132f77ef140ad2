"""Readers, writers, landed pages and extraction.

Files are written from the tables below the shared folder and read back.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from bindings import sql, tables
from bindings.registry import query
from riskloom import schemas
from riskloom.functions import normalize as nz
from riskloom.model import FEATURES
from riskloom.operators import pages as pg
from riskloom.operators import posts, users
from riskloom.sources import readers, writers
from riskloom.sources.staging import fresh_path, staged


LENIENT = f"""WITH {sql.POSTS}, n AS (SELECT *, CAST(id AS BIGINT) AS k FROM posts)
    SELECT id, CASE WHEN k % 3 = 0 THEN '' ELSE url END AS url, subreddit,
      CASE WHEN k % 7 = 0 THEN '' ELSE author END AS author, title, text,
      CASE WHEN k % 11 = 0 THEN 0e0 ELSE created_utc END AS created_utc, language FROM n"""


def uneven_posts(spark, sf):
    """Posts with missing, null and empty fields and numeric ids."""
    number = F.col("id").cast("long")
    return tables.posts(spark, sf).select(
        number.alias("id"),
        F.when(number % 3 != 0, F.col("url")).alias("url"),
        "subreddit",
        F.when(number % 7 == 0, "").otherwise(F.col("author")).alias("author"),
        "title",
        F.when(number % 5 == 0, "").otherwise(F.col("text")).alias("text"),
        F.when(number % 5 == 0, F.col("text")).alias("selftext"),
        F.when(number % 11 != 0, F.col("created_utc")).alias("created_utc"),
    )


@query("s1_lenient_posts", LENIENT)
def lenient_posts(spark, sf):
    """Uneven posts as lines among stray lines that hold arrays."""
    rows = uneven_posts(spark, sf)
    lines = rows.select(F.to_json(F.struct("*")).alias("value"))
    stray = rows.where(F.col("id") % 4 == 0).select(F.lit('["no", "post"]').alias("value"))
    path = fresh_path(spark, "lenient")
    lines.unionByName(stray).write.text(path)
    return readers.read_posts(spark, path, lines=True)


def one_file_each(documents, path):
    """Writes (part, value) so that each value is a file of its own."""
    documents.write.partitionBy("part").text(path)
    return path


@query("s1_posts_document", LENIENT)
def posts_document(spark, sf):
    """Uneven posts in whole documents, each an array over several lines."""
    rows = uneven_posts(spark, sf).withColumn("part", F.col("id") % 5)
    post = F.to_json(F.struct(*rows.columns[:-1]))
    # A document's lines are written one by one, as it may be larger than a row can be.
    lines = Window.partitionBy("part").orderBy("id")
    opening = F.when(F.row_number().over(lines) == 1, "[").otherwise(",")
    closing = F.when(F.lead(F.lit(1)).over(lines).isNull(), "]").otherwise("")
    posts = rows.select("part", "id", post.alias("_post"))
    documents = posts.select("part", F.concat(opening, "_post", closing).alias("value"))
    return readers.read_posts(spark, one_file_each(documents, fresh_path(spark, "documents")))


@query("s2_strict_posts", f"WITH {sql.POSTS} SELECT * FROM posts")
def strict_posts(spark, sf):
    path = fresh_path(spark, "strict")
    tables.posts(spark, sf).drop("language").write.json(path)
    return readers.read_posts_strict(spark, path, lines=True)


HISTORIES = f"""WITH {sql.ITEMS}, t AS (SELECT *, CAST(string_split(id, ':')[2] AS INT) AS turn FROM items)
    SELECT DISTINCT u.username, i.id, i.kind, i.created_utc
    FROM (SELECT DISTINCT username FROM t) u LEFT JOIN (SELECT * FROM t WHERE turn % 3 <> 1) i USING (username)"""


def damaged_items(spark, sf):
    """Items some of which lack their kind."""
    turn = F.element_at(F.split("id", ":"), 2).cast("int")
    return tables.items(spark, sf).withColumn("kind", F.when(turn % 3 != 1, F.col("kind")))


@query("s3_history_document", HISTORIES)
def history_document(spark, sf):
    """Whole documents of users with their items; users without a sound item stay."""
    items = damaged_items(spark, sf)
    entry = F.struct(*schemas.ITEM.names)
    users_ = items.groupBy("username").agg(F.collect_list(entry).alias("items"))
    users_ = users_.withColumn("part", F.pmod(F.xxhash64("username"), F.lit(4)))
    documents = users_.groupBy("part").agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("username", "items")))).alias("value")
    )
    path = one_file_each(documents, fresh_path(spark, "histories"))
    found, kept = readers.read_history(spark, path)
    return found.join(kept.select("username", "id", "kind", "created_utc"), "username", "left")


@query("s3_history", HISTORIES)
def history(spark, sf):
    """Nested lines in which some items lack their kind; those users stay."""
    items, damaged = tables.items(spark, sf), damaged_items(spark, sf)
    path = fresh_path(spark, "history")
    writers.write_history_nested(items.select("username").distinct(), damaged, path)
    found, kept = readers.read_history_lines(spark, path)
    return found.join(kept.select("username", "id", "kind", "created_utc"), "username", "left")


@query(
    "s4_fallback_scores",
    """SELECT 'u' || user_id AS author, least(value / 1e2, 1e0) AS score FROM events
    WHERE event_id % 10 <> 0 AND event_id % 11 <> 0 AND event_id % 13 <> 0""",
)
def csv_fallback_scores(spark, sf):
    number = F.col("event_id")
    score = F.least(F.col("value") / F.lit(100.0), F.lit(1.0)).cast("string")
    rows = tables.read(spark, sf, "events").select(
        F.lit('said "no",\nthen left').alias("text"),
        F.when(number % 10 == 0, "").otherwise(tables.numbered("u", F.col("user_id"))).alias("author"),
        F.when(number % 11 == 0, "abc").when(number % 13 != 0, score).alias("risk_score"),
    )
    path = fresh_path(spark, "fallback")
    rows.write.option("header", True).option("escape", '"').csv(path)
    return readers.read_fallback_scores(spark, path)


@query("s5_raw_posts", f"WITH {sql.POSTS} SELECT * FROM posts")
def raw_posts(spark, sf):
    path = fresh_path(spark, "posts")
    writers.write_posts(tables.posts(spark, sf), path)
    return spark.read.schema(schemas.POST).json(path)


@query(
    "s6_nested_history",
    f"""WITH {sql.USERS}, {sql.ITEMS}
    SELECT username, coalesce((r - 1) // 7, 0) AS part, coalesce((r - 1) % 7, -1) AS place, coalesce(id, '') AS id,
      coalesce(text, '') AS text
    FROM users LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY username ORDER BY created_utc DESC, id) AS r
      FROM items) USING (username)""",
)
def nested_history(spark, sf):
    """Every item with its part and its place in it, seven to a part."""
    nested = writers.nest_history(tables.users(spark, sf), tables.items(spark, sf), 7)
    return nested.select("username", "part", F.posexplode_outer("items").alias("place", "item")).select(
        "username",
        F.col("part").cast("long").alias("part"),
        F.coalesce("place", F.lit(-1)).cast("long").alias("place"),
        F.coalesce("item.id", F.lit("")).alias("id"),
        F.coalesce("item.text", F.lit("")).alias("text"),
    )


@query("s6_flat_history", f"WITH {sql.ITEMS} SELECT * FROM items")
def flat_history(spark, sf):
    items = tables.items(spark, sf)
    path = fresh_path(spark, "flat")
    writers.write_history(items.select("username").distinct(), items, path)
    return readers.read_history_tables(spark, path)[1]


SCORED = f"WITH {sql.POSTS}, {sql.scored('posts', tables.CALIBRATED)}"
SCORED_COLUMNS = f"""id, url, subreddit, author, title, text, created_utc, 'unknown' AS language, risk_score,
  risk_label, {sql.post_explanation()} AS risk_explanation, {', '.join(FEATURES)}"""


def scored(spark, sf):
    return posts.scored_records(tables.posts(spark, sf), tables.CALIBRATED)


@query("s7_scored_posts_jsonl", f"{SCORED} SELECT {SCORED_COLUMNS} FROM scored")
def scored_posts_jsonl(spark, sf):
    path = fresh_path(spark, "jsonl")
    rows = scored(spark, sf)
    writers.write_scored_posts_jsonl(rows, path)
    back = spark.read.schema(rows.schema).json(path)
    return back.select(*(c for c in back.columns if c != "risk_features"), "risk_features.*")


@query("s8_scored_posts_csv", f"{SCORED} SELECT {SCORED_COLUMNS} FROM scored")
def scored_posts_csv(spark, sf):
    """Quotes, commas and line ends in the texts survive the round trip."""
    path = fresh_path(spark, "csv")
    rows = scored(spark, sf)
    writers.write_scored_posts_csv(rows, path)
    back = spark.read.csv(path, header=True, multiLine=True, escape='"')
    features = F.from_json("risk_features", rows.schema["risk_features"].dataType)
    numbers = {c: F.col(c).cast("double") for c in ("created_utc", "risk_score")}
    return back.withColumns({**numbers, "risk_features": features}).select(
        *(c for c in back.columns if c != "risk_features"), "risk_features.*"
    )


USER_RISK = f"WITH {sql.ACTIVITY}, au AS (SELECT DISTINCT username FROM activity), {sql.user_risk('au', 'activity', None)}"


@query("s10_scored_users_jsonl", f"{USER_RISK} SELECT {sql.USER_COLUMNS} FROM risk")
def scored_users_jsonl(spark, sf):
    activity = tables.activity(spark, sf).select("username", "score")
    risk = users.score_users_from_scores(activity.select("username").distinct(), activity)
    path = fresh_path(spark, "users")
    writers.write_scored_users_jsonl(risk, path)
    return spark.read.schema(risk.schema).json(path)


ATTEMPTS = """tries AS (
  SELECT page_id, page_id % 4 AS group_no, page_id // 4 AS page_no, 'https://forum.example/' || page_id AS url,
    length(html) AS n, attempt,
    CASE WHEN page_id % 83 = 1 THEN CASE attempt WHEN 3 THEN 200 ELSE 500 END
         WHEN page_id % 97 = 2 THEN CASE attempt WHEN 1 THEN 404 ELSE 200 END
         WHEN page_id % 5 = 0 THEN CASE attempt WHEN 1 THEN 503 ELSE 200 END
         ELSE CASE attempt WHEN 1 THEN 200 ELSE 404 END END AS status
  FROM pages, (SELECT unnest([1, 2, 3]) AS attempt)),
first_done AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY attempt) AS rn FROM tries
  WHERE attempt <= 2 AND status IN (200, 403, 404)),
ok AS (SELECT * FROM first_done WHERE rn = 1 AND status = 200)"""


def attempts(spark, sf):
    number = F.col("page_id")
    landed = tables.read(spark, sf, "pages").withColumn(
        "attempt", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))
    )
    first = F.col("attempt") == 1
    status = (
        F.when(number % 83 == 1, F.when(F.col("attempt") == 3, 200).otherwise(500))
        .when(number % 97 == 2, F.when(first, 404).otherwise(200))
        .when(number % 5 == 0, F.when(first, 503).otherwise(200))
        .otherwise(F.when(first, 200).otherwise(404))
    )
    return landed.select(
        "page_id",
        (number % 4).alias("group_no"),
        F.floor(number / 4).alias("page_no"),
        tables.numbered("https://forum.example/", number).alias("url"),
        "attempt",
        status.alias("status"),
        "html",
    )


@query("s11_usable_pages", f"WITH {ATTEMPTS} SELECT page_id, attempt, n FROM ok")
def usable_pages(spark, sf):
    usable = pg.usable_pages(attempts(spark, sf))
    return usable.select("page_id", "attempt", F.length("html").cast("long").alias("n"))


@query(
    "s11_usable_listings",
    f"""WITH {ATTEMPTS}, gone AS (SELECT group_no, min(page_no) AS p FROM tries
      WHERE url NOT IN (SELECT url FROM ok) GROUP BY group_no)
    SELECT page_id, attempt, n FROM ok LEFT JOIN gone USING (group_no) WHERE p IS NULL OR page_no < p""",
)
def usable_listings(spark, sf):
    usable = pg.usable_pages(attempts(spark, sf), ["group_no"])
    return usable.select("page_id", "attempt", F.length("html").cast("long").alias("n"))


@query(
    "s12_conform",
    """SELECT CAST(event_id AS VARCHAR) AS id, props AS url, event_type AS subreddit, CAST(user_id AS VARCHAR) AS author,
      '' AS title, event_type AS text, value AS created_utc, CAST(NULL AS VARCHAR) AS language FROM events""",
)
def conform(spark, sf):
    source = tables.read(spark, sf, "events").select(
        F.col("event_type").alias("subreddit"),
        F.col("event_type").alias("text"),
        F.col("event_id").alias("id"),
        F.col("user_id").alias("author"),
        F.col("value").alias("created_utc"),
        F.col("props").alias("url"),
        F.lit("").alias("title"),
    )
    return readers.conform(source, schemas.POST)


EXTRACTED = f"""x0 AS (SELECT *, CAST(id AS BIGINT) AS k, {sql.strip('title')} AS t, {sql.strip('text')} AS b FROM posts),
extracted AS (SELECT id, 'https://old.reddit.com/p/' || id AS url, subreddit,
  CASE WHEN k % 10 = 9 THEN '[deleted]' ELSE author END AS author, t AS title,
  concat_ws(chr(10) || chr(10), nullif(t, ''), nullif(b, '')) AS text, floor(created_utc) AS created_utc,
  CAST(NULL AS VARCHAR) AS language FROM x0)"""


@query("x1_extract_posts", f"WITH {sql.POSTS}, {EXTRACTED} SELECT * FROM extracted")
def extract_posts(spark, sf):
    """Each document is put on a listing page and must come back as it was."""
    return pg.extract_posts(tables.listing_pages(tables.posts(spark, sf)))


@query(
    "x2_extract_items",
    f"""WITH {sql.ITEMS} SELECT username, replace(id, ':', '-') AS id, 'https://forum.example/x' AS url,
      subreddit, username AS author, kind, {sql.strip('text')} AS text, created_utc FROM items""",
)
def extract_items(spark, sf):
    return pg.extract_items(tables.user_pages(tables.items(spark, sf)))


@query(
    "x3_normalize_epoch",
    """SELECT event_id, CASE event_id % 6
        WHEN 0 THEN (epoch_us(ts) // 1000) / 1e3 WHEN 1 THEN CAST(epoch_us(ts) // 1000000 AS DOUBLE)
        WHEN 2 THEN epoch_us(ts) / 1e6 WHEN 3 THEN (epoch_us(ts) - 7200000000) / 1e6
        WHEN 4 THEN CAST(epoch_us(date_trunc('day', ts)) AS DOUBLE) / 1e6 END AS created_utc
    FROM events""",
)
def normalize_epoch(spark, sf):
    """Milliseconds, seconds, ISO times without zone and with one, dates, and neither."""
    micros, kind = tables.micros("ts"), F.col("event_id") % 6
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    attr = (
        F.when(kind == 0, F.floor(micros / 1000).cast("string"))
        .when(kind == 1, F.concat(F.lit(" "), F.floor(micros / 1000000).cast("string")))
        .when(kind == 2, "")
        .when(kind == 3, "soon")
    )
    time = (
        F.when(kind == 2, iso)
        .when(kind == 3, F.concat(iso, F.lit("+02:00")))
        .when(kind == 4, F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == 5, "yesterday")
    )
    events = tables.read(spark, sf, "events").select("event_id", attr.alias("a"), time.alias("t"))
    return events.select("event_id", nz.normalize_epoch(F.col("a"), F.col("t")).alias("created_utc"))


@query(
    "x4_item_id",
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(event_id AS VARCHAR) WHEN 1 THEN 'y' || event_id
      WHEN 2 THEN 'plain' || event_id END AS id FROM events""",
)
def item_id(spark, sf):
    number, kind = F.col("event_id"), F.col("event_id") % 4
    fullname = F.when(kind == 0, tables.numbered("t3_", number)).when(kind == 3, "")
    element = F.when(kind == 1, tables.numbered("thing_t1_y", number)).when(
        kind == 2, tables.numbered("plain", number)
    )
    events = tables.read(spark, sf, "events")
    return events.select("event_id", nz.item_id(fullname, element).alias("id"))


@query(
    "x5_resolve_url",
    """SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'https://old.reddit.com/p/' || page_id
      WHEN 1 THEN url WHEN 2 THEN 'https://old.reddit.com/u/' || page_id ELSE '' END AS url FROM pages""",
)
def resolve_url(spark, sf):
    number, kind = F.col("page_id"), F.col("page_id") % 4
    permalink = F.when(kind == 0, tables.numbered(" /p/", number)).when(kind == 1, "")
    link = F.when(kind == 1, F.col("url")).when(kind == 2, tables.numbered("/u/", number))
    pages = tables.read(spark, sf, "pages").select("page_id", "url")
    return pages.select("page_id", nz.resolve_url(permalink, link).alias("url"))


@query(
    "x6_next_link",
    f"""WITH {sql.POSTS} SELECT CAST(id AS BIGINT) AS page_no, '/r/' || subreddit || '?after=t3_' || id || '&count=25' AS next
    FROM posts""",
)
def next_link(spark, sf):
    pages = tables.listing_pages(tables.posts(spark, sf))
    return pages.select("page_no", pg.next_link(F.col("html")).alias("next"))


@query(
    "x6_page_chains",
    f"""WITH RECURSIVE {sql.ACTIVITY}, {sql.chained('activity', 'subreddit', tables.PER_PAGE)},
    sizes AS (SELECT subreddit AS listing, number, max(page) AS last FROM paged GROUP BY ALL),
    nodes AS (
      SELECT listing, number, last, unnest(range(0, last + 1)) AS p FROM sizes),
    linked AS (
      SELECT *, 'https://forum.example/list/' || listing || CASE WHEN p = 0 THEN '' ELSE '?count=25&after=x_' || p END AS url,
        CASE WHEN p = 1 AND number % 5 = 2 THEN NULL WHEN p < last THEN p + 1 WHEN number % 3 = 0 AND last > 0 THEN 1 END AS on_p
      FROM nodes),
    walk AS (
      SELECT listing, p, 1 AS page_no FROM nodes WHERE p = 0
      UNION ALL
      SELECT w.listing, l.on_p, w.page_no + 1 FROM walk w JOIN linked l ON l.listing = w.listing AND l.p = w.p
      WHERE l.on_p IS NOT NULL AND w.page_no <= l.last)
    SELECT listing, url, CAST(min(page_no) AS BIGINT) AS page_no FROM walk JOIN linked USING (listing, p) GROUP BY ALL""",
)
def page_chains(spark, sf):
    """Pages of 25 items in the order of their next links, which are all that orders them."""
    listing = {"subreddit": "listing"}
    pages = tables.chained(tables.activity(spark, sf), listing, F.concat(F.lit("<p>"), "id", F.lit("</p>")))
    return pg.page_numbers(pg.parsed_pages(pages), ["listing"])


CHAINED = f"""{EXTRACTED.replace("extracted AS", "single AS")},
{sql.chained('single', 'subreddit', tables.PER_PAGE)},
extracted AS (
  SELECT id, url, subreddit, author, title, text, created_utc, language FROM paged WHERE {sql.REACHED}
  UNION ALL
  SELECT DISTINCT 'pin', '', subreddit, 'pin', '', '', 946684800, CAST(NULL AS VARCHAR) FROM paged WHERE number % 4 = 0)"""


def chained_posts(spark, sf):
    return tables.chained(
        tables.posts(spark, sf), {"subreddit": "group_name"}, tables.listed_post()
    )


@query("x1_extract_posts_chained", f"WITH {sql.POSTS}, {CHAINED} SELECT * FROM extracted")
def extract_posts_chained(spark, sf):
    """Several pages of 25 posts, pinned ones first, second pages that fail, links that return."""
    parsed = staged(pg.parsed_pages(chained_posts(spark, sf)), "parsed")
    return pg.extract_posts(parsed, usable=pg.usable_keys(parsed, ["group_name"]))


def chained_items(spark, sf):
    return tables.chained(
        tables.items(spark, sf), {"username": "username", "kind": "kind"}, tables.listed_item(), 2
    )


CHAINED_ITEMS = f"""{sql.chained('items', "username || '/' || kind", 2, 'paged_items')}"""


@query(
    "x2_extract_items_chained",
    f"""WITH {sql.ITEMS}, {CHAINED_ITEMS}
    SELECT username, replace(id, ':', '-') AS id, page + 1 AS page_no, {sql.strip('text')} AS text
    FROM paged_items WHERE {sql.REACHED}
    UNION ALL
    SELECT DISTINCT username, 'pin', 1, '' FROM paged_items WHERE number % 4 = 0""",
)
def extract_items_chained(spark, sf):
    """Items of users' pages, which come with the number of the page they were on."""
    parsed = staged(pg.parsed_pages(chained_items(spark, sf)), "parsed")
    raw = pg.raw_items(parsed, "username", usable=pg.usable_keys(parsed, ["username", "kind"]))
    return raw.select(
        "username",
        nz.item_id(F.col("raw_fullname"), F.col("raw_element_id")).alias("id"),
        "page_no",
        F.coalesce("raw_md_text", F.lit("")).alias("text"),
    ).distinct()


@query(
    "x6_next_link_raw_pages",
    "SELECT page_id, CAST(NULL AS VARCHAR) AS next, CAST(NULL AS VARCHAR) AS error FROM pages",
)
def next_link_raw_pages(spark, sf):
    """Real page markup parses without errors and has no listing parts."""
    pages = tables.read(spark, sf, "pages").select("page_id", pg.parse_page("html").alias("p"))
    return pages.select("page_id", "p.next", "p.error")


@query(
    "x7_compose_text",
    f"""WITH {sql.POSTS}, k AS (SELECT id, CASE WHEN CAST(id AS BIGINT) % 3 = 0 THEN '' ELSE title END AS t,
      CASE WHEN CAST(id AS BIGINT) % 5 = 0 THEN '' ELSE text END AS b FROM posts)
    SELECT id, concat_ws(chr(10) || chr(10), nullif(t, ''), nullif(b, '')) AS text FROM k""",
)
def compose_text(spark, sf):
    number = F.col("id").cast("long")
    title = F.when(number % 3 == 0, "").otherwise(F.col("title"))
    body = F.when(number % 5 == 0, "").otherwise(F.col("text"))
    return tables.posts(spark, sf).select("id", nz.compose_text(title, body).alias("text"))
