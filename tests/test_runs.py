"""Jobs and streams."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from riskloom.operators import stats, users
from riskloom.operators.pages import extract_posts
from riskloom.plans import jobs
from riskloom.schemas import HISTORY, POST
from riskloom.sources import readers
from riskloom.streaming import flows

AS_OF = dt.datetime(2024, 1, 11, tzinfo=dt.timezone.utc)
DAY = 86400
START = AS_OF.timestamp() - 10 * DAY
PAGES = "group_name string, page_no int, url string, html string, status int, attempt int"
USER_PAGES = "username string, kind string, page_no int, url string, html string, status int, attempt int"


def thing(item, ts, author, text):
    return (
        f'<div class="thing" data-fullname="t3_{item}" data-timestamp="{int(ts)}" data-author="{author}">'
        f'<a class="title">{text}</a><div class="expando"><div class="md">{text}</div></div></div>'
    )


@pytest.fixture(scope="module")
def landed(spark):
    harsh = "Anyone who plans a massacre should be wiped out."
    listing = [
        ("news", 1, "l1", thing("1", START, "ann", "kill") + thing("2", START + 1, "bob", "tea"), 200, 1),
        ("news", 2, "l2", "", 404, 1),
        ("news", 3, "l3", thing("3", START + 9, "eve", "late"), 200, 1),
        ("politics", 1, "l4", thing("4", START + 2, "ann", "kill kill murder"), 200, 1),
        ("other", 1, "l5", thing("5", START + 3, "sam", "no"), 200, 1),
    ]
    history = [
        ("ann", "comment", 1, "u1", thing("a1", START, "ann", harsh) + thing("a2", START - 1, "ann", harsh), 500, 1),
        ("ann", "comment", 1, "u1", thing("a1", START, "ann", harsh) + thing("a2", START - 1, "ann", harsh), 200, 2),
        ("sam", "comment", 1, "u2", thing("s1", START, "sam", harsh), 200, 1),
    ]
    return spark.createDataFrame(listing, PAGES), spark.createDataFrame(history, USER_PAGES)


def test_full_run(spark, landed, tmp_path):
    out = str(tmp_path / "run")
    risk = jobs.full_run(spark, *landed, out, jobs.RunConfig(AS_OF))
    got = {r.username: r for r in risk.collect()}
    assert set(got) == {"ann", "bob"}
    assert got["ann"].score == pytest.approx(0.40) and got["ann"].total_posts == 1
    assert "current scored posts only" in got["bob"].explanation
    posts = spark.read.json(f"{out}/posts/json")
    assert sorted(r.id for r in posts.collect()) == ["1", "2", "4"]
    labels = {r.label: r["count"] for r in spark.read.json(f"{out}/scored_posts/labels").collect()}
    assert sum(labels.values()) == 3 and set(labels) == {"high", "medium", "low"}
    fallback = readers.read_fallback_scores(spark, f"{out}/scored_posts/csv")
    assert fallback.count() == 3


def test_full_run_with_language(spark, landed, tmp_path):
    texts = [("en", "the house and the garden of the king"), ("de", "das Haus und der Garten des Herrn")]
    labelled = spark.createDataFrame(texts, "lang string, text string")
    listing, history = landed
    german = listing.withColumn("html", F.replace("html", F.lit(">tea<"), F.lit(">der Garten und das Haus des Herrn<")))
    jobs.full_run(spark, german, history, str(tmp_path), jobs.RunConfig(AS_OF), labelled=labelled)
    scored = spark.read.parquet(f"{tmp_path}/scored_posts/table").collect()
    assert {r.id: r.language for r in scored}["2"] == "de"
    assert spark.read.parquet(f"{tmp_path}/profiles").count() > 2


def test_enrichment_skips_known_users(spark, landed, tmp_path):
    listing, history = landed
    posts = extract_posts(listing)
    known_users = spark.createDataFrame([("ann",), ("old",)], "username string")
    kept = spark.createDataFrame([("old", "o", "", "", "old", "comment", "x", 1.0)], HISTORY)
    cfg = jobs.RunConfig(AS_OF)
    users, items = jobs.enrich_job(
        spark, posts, history, (known_users, kept), str(tmp_path / "h"), cfg
    )
    assert sorted(r.username for r in users.collect()) == ["ann", "bob", "eve", "old", "sam"]
    assert sorted(r.id for r in items.collect()) == ["o", "s1"]
    (coverage,) = spark.read.json(f"{tmp_path}/h/coverage").collect()
    assert (coverage.authors, coverage.known, coverage.to_fetch) == (4, 1, 3)


def test_failing_pages_are_written(spark, landed, tmp_path, monkeypatch):
    listing, history = landed
    bad = listing.withColumn(
        "html", F.when(F.col("url") == "l4", "<div class='thing'>" * 100).otherwise(F.col("html"))
    )
    jobs.collect_job(spark, bad, str(tmp_path / "c"), jobs.RunConfig(AS_OF))
    errors = spark.read.schema("group_name string, url string, error string").json(f"{tmp_path}/c/errors")
    assert [(r.url, "64 items" in r.error) for r in errors.collect()] == [("l4", True)]
    posts = extract_posts(listing)
    for stop in (False, True):
        cfg = jobs.RunConfig(AS_OF, stop_at_old=stop)
        _, items = jobs.enrich_job(spark, posts, history, None, f"{tmp_path}/{stop}", cfg)
        assert sorted(r.id for r in items.collect()) == ["a1", "s1"]
        counts = spark.read.json(f"{tmp_path}/{stop}/items_per_user").collect()
        assert {r.username: r["items"] for r in counts} == {"ann": 1, "bob": 0, "eve": 0, "sam": 1}


def test_observed_counts(spark, tmp_path):
    cfg = jobs.RunConfig(AS_OF)
    posts = spark.createDataFrame([("1", "", "g", "a", "t", "kill", 1.0, None)], POST)
    people = spark.createDataFrame([("a",), ("b",)], "username string")
    seen, written = Observation(), Observation()
    scored = jobs.score_posts_job(spark, posts, f"{tmp_path}/p", cfg, observation=seen)
    none = spark.createDataFrame([], HISTORY)
    jobs.score_users_job(spark, people, none, scored, f"{tmp_path}/u", cfg, observation=written)
    assert seen.get == {"posts_scored": 1} and written.get == {"users_written": 2}


def test_a_failing_stage_ends_the_run(spark, landed, tmp_path):
    listing, history = landed
    broken = listing.withColumn("html", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        jobs.full_run(spark, broken, history, str(tmp_path / "r"), jobs.RunConfig(AS_OF))
    assert not (tmp_path / "r" / "scored_users").exists()


SCORES = "username string, ts timestamp, score double"


def rows(*days):
    start = dt.datetime(2024, 1, 1)
    return [("u", start + dt.timedelta(days=d), s) for d, s in days]


def land(spark, path, *days):
    spark.createDataFrame(rows(*days), SCORES).coalesce(1).write.mode("append").parquet(path)


def test_rolling_risk_drops_late_rows(spark, tmp_path):
    path = str(tmp_path / "in")
    schema = spark.createDataFrame([], SCORES).schema
    land(spark, path, (0.5, 0.9), (15.5, 0.1))
    land(spark, path, (16.5, 0.2))  # lets the watermark take effect
    land(spark, path, (0.6, 1.0), (17.5, 0.2))  # the first is behind it
    stream = flows.stream_table(spark, path, schema, maxFilesPerTrigger=1)
    got = flows.drain(spark, flows.rolling_user_risk(stream), "t3").collect()
    by_end = {r.window_end: r for r in got}
    first = by_end[dt.datetime(2024, 1, 2)]
    assert (first.total_posts, first.max_post_score, first.label) == (1, 0.9, "high")
    assert first.score == pytest.approx(0.9 + 0.2 * 0.6931471805599453)
    assert max(by_end) <= dt.datetime(2024, 1, 17)


def test_batch_and_stream_windows_agree(spark, tmp_path):
    path = str(tmp_path / "in")
    land(spark, path, *((d / 3, (d % 7) / 7) for d in range(60)))
    table = spark.read.parquet(path)
    stream = flows.stream_table(spark, path, table.schema)
    got = {tuple(r) for r in flows.drain(spark, flows.rolling_user_risk(stream), "t3").collect()}
    batch = flows.rolling_user_risk(table).collect()
    closed = max(r.ts for r in table.collect()) - dt.timedelta(days=1)
    assert got == {tuple(r) for r in batch if r.window_end <= closed} and got


def test_deduplication_across_batches(spark, tmp_path):
    path = str(tmp_path / "in")
    land(spark, path, (0.1, 1.0), (0.1, 1.0), (0.2, 1.0))
    land(spark, path, (0.1, 1.0), (0.3, 1.0))
    stream = flows.stream_table(
        spark, path, spark.read.parquet(path).schema, maxFilesPerTrigger=1
    )
    once = flows.drain(spark, flows.deduplicated(stream, ["username", "ts"]), "t2")
    assert once.count() == 3


def test_open_windows_are_delivered_as_they_stand(spark, tmp_path):
    path = str(tmp_path / "in")
    for part in range(3):
        land(spark, path, *((d / 3, (d % 7) / 7) for d in range(part, 60, 3)))
    table = spark.read.parquet(path)
    stream = flows.stream_table(spark, path, table.schema, maxFilesPerTrigger=1)
    out = str(tmp_path / "out")
    risk = flows.rolling_risk_stream(spark, stream, out, lateness="30 days", buckets=4)
    got = {tuple(r) for r in risk.collect()}
    assert got == {tuple(r) for r in flows.rolling_user_risk(table).collect()}
    # A pane changed in several batches is kept once, and no row was multiplied on the way.
    panes = flows.pane_store(spark, out, 4).read("panes")
    assert panes.count() == panes.select("username", "pane").distinct().count() == 20
    assert panes.agg(F.sum("scores")).first()[0] == 60
    # Later files go on where the run ended; a late row amends its open pane.
    land(spark, path, (0.5, 1.0), (21, 0.5))
    risk = flows.rolling_risk_stream(spark, stream, out, lateness="30 days", buckets=4)
    table = spark.read.parquet(path)
    assert {tuple(r) for r in risk.collect()} == {tuple(r) for r in flows.rolling_user_risk(table).collect()}


def test_upsert_does_not_depend_on_the_order_of_files(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    for row in (("a", 5, "newest"), ("a", 3, "older")):
        spark.createDataFrame([row], "k string, n long, v string").write.mode("append").parquet(path)
        stream = flows.stream_table(spark, path, spark.read.parquet(path).schema)
        last = flows.upsert_stream(spark, stream, "k", "n", out)
    assert [tuple(r) for r in last.collect()] == [("a", 5, "newest")]


def test_upsert_resumes_and_new_wins(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "k string, n long, v string, d int"

    def deliver(*rows):
        rows = [(*r, deliver.number) for r in rows]
        deliver.number += 1
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        stream = flows.stream_table(spark, path, spark.read.parquet(path).schema)
        last = flows.upsert_stream(spark, stream, "k", "n", out, delivery="d")
        return {tuple(r) for r in last.drop("d").collect()}

    deliver.number = 0

    assert deliver(("a", 1, "x"), ("a", 2, "y"), ("b", 5, "z")) == {("a", 2, "y"), ("b", 5, "z")}
    assert deliver(("b", 1, "new"), ("c", 1, "c")) == {("a", 2, "y"), ("b", 1, "new"), ("c", 1, "c")}
    assert deliver(("d", 1, "d")) >= {("a", 2, "y"), ("d", 1, "d")}
    assert sorted(p.name for p in (tmp_path / "out/store/manifest").glob("v*")) == ["v2", "v3"]


def test_stats_over_deliveries_equal_all_at_once(spark, tmp_path):
    store = stats.stats_store(spark, str(tmp_path), buckets=4)

    def deliver(rows, again=None):
        df = spark.createDataFrame(rows, "username string, score double")
        people = None if again is None else spark.createDataFrame([(a,) for a in again], "username string")
        return stats.add_to_stats(store, df, people)

    deliver([("a", 0.1), ("a", 0.9), ("b", 0.2), (None, 1.0)])
    deliver([("a", 0.3), ("c", 0.85)])
    # b is fetched again with other items, c without any, d was not known.
    done = deliver([("b", 0.5), ("b", 0.6), ("a", 0.2)], again=["b", "c", "d"])
    got = {tuple(r) for r in stats.stats_of(store).collect()}
    left = [("a", 0.1), ("a", 0.9), ("a", 0.3), ("a", 0.2), ("b", 0.5), ("b", 0.6)]
    whole = users.user_stats(spark.createDataFrame(left, "username string, score double"))
    assert got == {tuple(r) for r in whole.collect()}
    assert done.version == 3 and set(done.buckets) == set(
        store.touched(spark.createDataFrame([(u,) for u in "abcd"], "username string"))
    )
    people = spark.createDataFrame([(u,) for u in "abcd"], "username string")
    risk = users.score_users_from_stats(people, stats.stats_of(store))
    assert {tuple(r) for r in risk.collect()} == {
        tuple(r)
        for r in users.score_users_from_scores(
            people, spark.createDataFrame(left, "username string, score double")
        ).collect()
    }
