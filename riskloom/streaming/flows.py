"""Streaming post scoring, de-duplication, rolling user risk, upsert (T1-T4), newest posts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.model import DEFAULT_MODEL, RiskModel
from riskloom.operators.posts import scored_records
from riskloom.operators.select import PER_GROUP, newest_per_group
from riskloom.operators.stats import STATS, merged_stats, partial_stats, whole_stats
from riskloom.operators.users import user_score
from riskloom.functions.features import label
from riskloom.sources.buckets import BUCKETS, BucketStore, Written
from riskloom.sources.staging import fresh_path

LATENESS = "1 day"
PANE, WINDOW = "1 day", "10 days"
_SPAN = T.StructType([T.StructField(c, T.TimestampType()) for c in ("start", "end")])
PANES = T.StructType([T.StructField("pane", _SPAN), *STATS.fields])


def stream_table(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """A stream over the Parquet files of ``path``."""
    return spark.readStream.schema(schema).options(**options).parquet(path)


def stream_scores(posts: DataFrame, model: RiskModel = DEFAULT_MODEL) -> DataFrame:
    """Scored records of a post stream (T1): the batch expressions, stateless."""
    return scored_records(posts, model)


def deduplicated(
    items: DataFrame, keys: list[str], ts: str = "ts", lateness: str = LATENESS
) -> DataFrame:
    """Items once per key, whenever the repeats come within ``lateness``."""
    return items.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(keys)


def daily_stats(
    scores: DataFrame,
    ts: str = "ts",
    lateness: str = LATENESS,
    pane: str = PANE,
    high: float = DEFAULT_MODEL.high,
) -> DataFrame:
    """(pane, username, partial stats) of ``(username, ts, score)``: a row per user and pane.

    Works on streams and on tables. Rows are not multiplied: each is in one pane.
    """
    panes = scores.withWatermark(ts, lateness).groupBy(F.window(ts, pane).alias("pane"), "username")
    return panes.agg(*partial_stats(high=high))


def risk_of_panes(
    panes: DataFrame,
    window: str = WINDOW,
    slide: str = PANE,
    model: RiskModel = DEFAULT_MODEL,
    moment: str = "pane",
) -> DataFrame:
    """User risk over sliding windows that are put together from panes.

    ``moment`` is the window column of an aggregation, or a time within the pane.
    """
    grouped = panes.groupBy(F.window(moment, window, slide).alias("w"), "username")
    stats = grouped.agg(*merged_stats()).select("w", "username", *whole_stats())
    score = user_score(
        F.col("max_post_score"), F.col("average_score"), F.col("count_high_posts")
    )
    df = stats.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "username",
        "max_post_score",
        "average_score",
        "count_high_posts",
        "total_posts",
        score.alias("score"),
    )
    return df.withColumn("label", label(F.col("score"), model.high, model.medium))


def rolling_user_risk(
    scores: DataFrame,
    ts: str = "ts",
    lateness: str = LATENESS,
    window: str = WINDOW,
    slide: str = PANE,
    model: RiskModel = DEFAULT_MODEL,
) -> DataFrame:
    """User risk over a sliding lookback of ``(username, ts, score)``.

    Works on tables and, for windows that the watermark has closed, on append streams.
    Scores combine to one row per user and ``slide`` first; only those rows are multiplied
    by the windows that they are part of. Rows of a pane behind the watermark are dropped.
    """
    return risk_of_panes(daily_stats(scores, ts, lateness, slide, model.high), window, slide, model)


def pane_store(spark: SparkSession, out: str, buckets: int = BUCKETS) -> BucketStore:
    """Where :func:`rolling_risk_stream` keeps panes, bucketed by user."""
    return BucketStore(spark, f"{out}/panes", "username", {"panes": PANES}, buckets)


def rolling_risk_stream(
    spark: SparkSession,
    scores: DataFrame,
    out: str,
    ts: str = "ts",
    lateness: str = LATENESS,
    window: str = WINDOW,
    slide: str = PANE,
    model: RiskModel = DEFAULT_MODEL,
    buckets: int = BUCKETS,
) -> DataFrame:
    """T3 as a stream that also delivers open windows: runs over what has arrived.

    The stream's state is one row of partial stats per user and pane that is still open.
    A micro-batch replaces the panes that it changed in a bucketed store, which holds
    each pane once, however often it changed; a batch run again puts the same panes in.
    Windows are put together when the result is read. A late row counts in all windows
    of its pane as long as the pane is open, which ``lateness`` says.
    """
    store = pane_store(spark, out, buckets)

    def apply(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        touched = store.touched(batch)
        kept = store.read("panes", touched, number).join(batch, ["username", "pane"], "left_anti")
        store.write({"panes": kept.unionByName(batch)}, touched, number)
        batch.unpersist()

    panes = daily_stats(scores, ts, lateness, slide, model.high)
    query = (
        panes.select(*PANES.names)
        .writeStream.outputMode("update")
        .foreachBatch(apply)
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return risk_of_panes(store.read("panes"), window, slide, model, "pane.start")


def drain(spark: SparkSession, stream: DataFrame, name: str, out: str | None = None) -> DataFrame:
    """Runs an append stream over what has arrived and returns the sink's table.

    Sink and checkpoint lie below the shared folder, so the query can be taken
    up again by another driver.
    """
    out = out or fresh_path(spark, name)
    query = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{out}/table")
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/table")


def _newest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the largest by ``order`` and, where that is equal, by all columns."""
    columns = [c for c in rows.columns if c not in keys]
    place = F.struct(*order, *(c for c in columns if c not in order))
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*columns), place).alias("_row"))
    return best.select(*keys, "_row.*").select(*rows.columns)


def upsert_stream(
    spark: SparkSession,
    updates: DataFrame,
    key: str,
    order: str,
    out: str,
    delivery: str | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Keeps the newest row per ``key`` in a bucketed store below ``out`` (T4).

    Newest is by ``order``, or by (``delivery``, ``order``) where rows carry the
    number of their delivery; equal places are settled by the other columns. It
    does not matter in which order or micro-batch files arrive.

    Micro-batch n makes version n + 1 from version n, reading and writing only the
    buckets of its keys. A batch that is run again after a failure makes its own
    version again and reads none of its output. Returns the last version's rows.
    """
    places = [order] if delivery is None else [delivery, order]
    store = upsert_store(spark, updates.schema, key, out, buckets)

    def apply(batch: DataFrame, number: int) -> None:
        upsert_batch(store, batch, number, places)

    query = (
        updates.writeStream.foreachBatch(apply)
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return store.read("rows")


def upsert_store(
    spark: SparkSession, schema: T.StructType, key: str, out: str, buckets: int = BUCKETS
) -> BucketStore:
    """The store that :func:`upsert_stream` keeps."""
    return BucketStore(spark, f"{out}/store", key, {"rows": schema}, buckets)


def upsert_batch(store: BucketStore, batch: DataFrame, number: int, places: list[str]) -> Written:
    """Version ``number + 1`` of the store: the newest of its rows and the batch's per key."""
    batch = batch.persist()
    touched = store.touched(batch)
    rows = store.read("rows", touched, number).unionByName(batch)
    written = store.write({"rows": _newest(rows, [store.key], places)}, touched, number)
    batch.unpersist()
    return written


def newest_store(
    spark: SparkSession, schema: T.StructType, group: str, out: str, buckets: int = BUCKETS
) -> BucketStore:
    """The store that :func:`newest_stream` keeps: at most n rows of each group."""
    return BucketStore(spark, f"{out}/newest", group, {"rows": schema}, buckets)


def newest_batch(
    store: BucketStore, batch: DataFrame, number: int, n: int, ts: str, tie: str
) -> Written:
    """Version ``number + 1`` of the store: the ``n`` newest per group of its rows and the batch's."""
    batch = batch.persist()
    touched = store.touched(batch)
    rows = store.read("rows", touched, number).unionByName(batch)
    once = _newest(rows, [store.key, tie], [ts])
    kept = newest_per_group(once, store.key, n, ts, tie).drop("rank")
    written = store.write({"rows": kept}, touched, number)
    batch.unpersist()
    return written


def newest_stream(
    spark: SparkSession,
    posts: DataFrame,
    out: str,
    n: int = PER_GROUP,
    group: str = "subreddit",
    ts: str = "created_utc",
    tie: str = "id",
    buckets: int = BUCKETS,
) -> DataFrame:
    """The ``n`` newest posts per group over all deliveries, with ``rank`` (L5 as a stream).

    What is kept is bounded: n rows a group, in a store of which a micro-batch reads and
    writes the buckets of its groups. Rows of one group and id, null ids too, are one post,
    the newest of them, equal ones settled by all columns. A post that fell out of the n
    newest can't come back unless it is delivered again newer, so the rows kept say all:
    after each delivery they are what the batch operator finds in all deliveries, in
    whichever order they came. Budgets (L6) apply to the result.
    """
    store = newest_store(spark, posts.schema, group, out, buckets)

    def apply(batch: DataFrame, number: int) -> None:
        newest_batch(store, batch, number, n, ts, tie)

    query = (
        posts.writeStream.foreachBatch(apply)
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return newest_per_group(store.read("rows"), group, n, ts, tie)
