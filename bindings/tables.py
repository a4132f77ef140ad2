"""Test tables in model shape, and the models they are scored with."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.model import DEFAULT_MODEL, RiskModel
from riskloom.operators.select import newest_first_rank

# The test corpus is invented prose that the default vocabulary hardly meets.
# This model uses words the corpus has, so that every rule is exercised.
CALIBRATED = RiskModel(
    violent=("der", "la", "was", "have"),
    hate=("und", "el", "les", "not"),
    intensifiers=("from", "für", "pour", "this"),
    threats=(r"\b(of|in) (the|a)\b", r"\b(de|en) la\b"),
)
MODELS = {"default": DEFAULT_MODEL, "calibrated": CALIBRATED}

EPOCH = 1704067200  # 2024-01-01 UTC
AS_OF = dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc)


# The test tables are single files of one row group. Those with texts are dealt out to
# that many tasks per core before CPU-heavy work, whatever their size.
TEXT_TABLES = ("documents", "conversations", "pages")
TASKS_PER_CORE = 3


def dealt(df: DataFrame) -> DataFrame:
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism * TASKS_PER_CORE)


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    table = spark.read.parquet(f"{sf}/{name}.parquet")
    return dealt(table) if name in TEXT_TABLES else table


def micros(ts: str) -> Column:
    """Epoch microseconds of a zone-less timestamp read as UTC, in any session zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})")


def numbered(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def posts(spark: SparkSession, sf: str) -> DataFrame:
    return as_posts(read(spark, sf, "documents"))


def as_posts(docs: DataFrame) -> DataFrame:
    """documents as posts."""
    return docs.select(
        F.col("doc_id").cast("string").alias("id"),
        numbered("https://forum.example/p/", F.col("doc_id")).alias("url"),
        F.col("source").alias("subreddit"),
        numbered("u", F.col("doc_id") % 150).alias("author"),
        F.substring_index("text", "\n", 1).alias("title"),
        "text",
        (F.col("doc_id") + F.lit(float(EPOCH))).alias("created_utc"),
        F.lit(None).cast("string").alias("language"),
    )


def items(spark: SparkSession, sf: str) -> DataFrame:
    """conversations as history items, one per turn."""
    turns = read(spark, sf, "conversations")
    return turns.select(
        numbered("u", F.col("conv_id") % 120).alias("username"),
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        numbered("https://forum.example/c/", F.col("conv_id")).alias("url"),
        numbered("g", F.col("conv_id") % 7).alias("subreddit"),
        numbered("u", F.col("conv_id") % 120).alias("author"),
        F.when(F.col("role") == "user", "submission").otherwise("comment").alias("kind"),
        "text",
        (F.col("conv_id") * 60 + F.col("turn") + F.lit(float(EPOCH))).alias("created_utc"),
    )


def activity(spark: SparkSession, sf: str) -> DataFrame:
    """events as timed activity."""
    events = read(spark, sf, "events")
    return events.select(
        F.col("event_id").cast("string").alias("id"),
        numbered("u", F.col("user_id")).alias("username"),
        F.col("event_type").alias("subreddit"),
        F.when(F.col("event_type").isin("signup", "purchase"), "submission")
        .otherwise("comment")
        .alias("kind"),
        (micros("ts") / F.lit(1e6)).alias("created_utc"),
        F.least(F.col("value") / F.lit(100.0), F.lit(1.0)).alias("score"),
    )


def users(spark: SparkSession, sf: str) -> DataFrame:
    """customers as known accounts; most have neither history nor posts."""
    return read(spark, sf, "customer").select(numbered("u", F.col("c_custkey")).alias("username"))


def escape(text: Column) -> Column:
    """Text or attribute value as HTML."""
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def listed_post() -> Column:
    """A post as an item of a listing page; rows alternate between attribute styles."""
    number = F.col("id").cast("long")
    name = F.when(number % 2 == 0, F.concat(F.lit('data-fullname="t3_'), "id", F.lit('"'))).otherwise(
        F.concat(F.lit('id="thing_t3_'), "id", F.lit('"'))
    )
    seconds = F.col("created_utc").cast("long")
    stamp = F.when(number % 2 == 0, seconds * 1000).otherwise(seconds).cast("string")
    return F.concat(
        F.lit('<div class=" thing link" '),
        name,
        F.lit(' data-promoted="false" data-timestamp="'),
        stamp,
        F.lit('" data-subreddit="'),
        F.col("subreddit"),
        F.lit('" data-author="'),
        F.when(number % 10 == 9, F.lit("")).otherwise(F.col("author")),
        F.lit('" data-permalink="/p/'),
        F.col("id"),
        F.lit('"><p class="title"><a class="title may-blank" href="#"> '),
        escape(F.col("title")),
        F.lit(' </a><br></p><div class="expando"><div class="usertext-body md-container">'),
        F.lit('<div class="md">'),
        escape(F.col("text")),
        F.lit("</div></div></div></div>"),
    )


def listing_pages(posts: DataFrame) -> DataFrame:
    """A landed listing page around each post.

    Every third page also has a promoted item and every fourth an item without a time.
    """
    number = F.col("id").cast("long")
    thing = listed_post()
    promoted = F.lit('<div class="thing" data-promoted="true" id="t3_ad" data-timestamp="1"></div>')
    timeless = F.lit('<div class="thing" id="t3_x"><a class="title">x</a></div>')
    html = F.concat(
        F.lit("<html><head><script>var a = '<div class=\"thing\">';</script></head><body>"),
        F.when(number % 3 == 0, promoted).otherwise(""),
        F.when(number % 4 == 0, timeless).otherwise(""),
        thing,
        F.lit('<div class="nav-buttons"><span class="next-button"><a href="/r/'),
        F.col("subreddit"),
        F.lit("?after=t3_"),
        F.col("id"),
        F.lit('&amp;count=25" rel="next">next</a></span></div><div class="md">footer</div>'),
        F.lit("</body></html>"),
    )
    return posts.select(
        number.alias("page_no"),
        numbered("https://forum.example/l/", number).alias("url"),
        F.col("subreddit").alias("group_name"),
        html.alias("html"),
        F.lit(200).alias("status"),
        F.lit(1).alias("attempt"),
    )


def user_pages(items: DataFrame, page_no: Column | None = None) -> DataFrame:
    """A landed user page around each history item."""
    html = listed_item()
    return items.select(
        "username",
        "kind",
        (F.lit(1) if page_no is None else page_no).alias("page_no"),
        F.concat(F.lit("https://forum.example/u/"), "id").alias("url"),
        html.alias("html"),
        F.lit(200).alias("status"),
        F.lit(1).alias("attempt"),
    )


def listed_item() -> Column:
    """A history item as an item of a user's page."""
    moment = F.expr(
        "date_format(timestampadd(SECOND, cast(created_utc as bigint), "
        "TIMESTAMP_NTZ'1970-01-01 00:00:00'), \"yyyy-MM-dd'T'HH:mm:ss\")"
    )
    return F.concat(
        F.lit("<div class='thing comment' id='t1_"),
        F.replace("id", F.lit(":"), F.lit("-")),
        F.lit("' data-subreddit='"),
        F.col("subreddit"),
        F.lit("' data-url='https://forum.example/x'><p class='tagline'><time datetime='"),
        moment,
        F.lit("+00:00'>then</time></p><form><div class='usertext-body'><div class=md><p>"),
        escape(F.col("text")),
        F.lit("</p></div></div></form></div>"),
    )


PER_PAGE = 25


def chained(
    rows: DataFrame, listing: dict[str, str], item: Column, per_page: int = PER_PAGE
) -> DataFrame:
    """Landed pages of ``per_page`` items, newest first, that only their links order.

    ``listing`` names the columns that key a listing. The first page of every fourth
    listing opens with a pinned item of the year 2000. The second page never comes in
    every fifth listing and with the second attempt in the others. The last page of
    every third listing links back to the second.
    """
    key = F.concat_ws("/", *listing)
    number = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long") % 60
    keyed = rows.select(*listing, "id", "created_utc", item.alias("_item"), key.alias("_key"))
    ranked = newest_first_rank(keyed, "_key")
    placed = ranked.withColumn("_page", F.floor((F.col("rank") - 1) / per_page).cast("long"))
    pages = placed.groupBy(*listing, "_key", "_page").agg(
        F.sort_array(F.collect_list(F.struct("rank", "_item"))).alias("_items")
    )
    sizes = pages.groupBy("_key").agg(F.max("_page").alias("_last"))

    def url(page: Column) -> Column:
        start = F.concat(F.lit("https://forum.example/list/"), "_key")
        after = F.concat(F.lit("?count=25&after=x_"), page.cast("string"))
        return F.when(page == 0, start).otherwise(F.concat(start, after))

    on = F.when(F.col("_page") < F.col("_last"), url(F.col("_page") + 1)).when(
        (F.col("_number") % 3 == 0) & (F.col("_last") > 0), url(F.lit(1))
    )
    link = F.concat(F.lit('<span class="next-button"><a href="'), escape(on), F.lit('">on</a></span>'))
    pinned = F.lit(
        '<div class="thing" data-fullname="t3_pin" data-timestamp="946684800" data-author="pin"></div>'
    )
    body = F.concat(
        F.when((F.col("_page") == 0) & (F.col("_number") % 4 == 0), pinned).otherwise(""),
        F.array_join(F.transform("_items", lambda i: i["_item"]), ""),
        F.coalesce(link, F.lit("")),
    )
    attempts = F.when(F.col("_page") == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    tried = (
        pages.join(sizes, "_key")
        .withColumn("_number", number)
        .select("*", F.explode(attempts).alias("attempt"))
    )
    failed = (F.col("_page") == 1) & ((F.col("attempt") == 1) | (F.col("_number") % 5 == 2))
    return tried.select(
        *(F.col(c).alias(name) for c, name in listing.items()),
        url(F.col("_page")).alias("url"),
        F.when(~failed, body).alias("html"),
        F.when(failed, 503).otherwise(200).alias("status"),
        "attempt",
    )
