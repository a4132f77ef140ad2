"""Runs taken up where they failed, posts and profiles kept over deliveries."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from riskloom.model import DEFAULT_MODEL
from riskloom.operators import language
from riskloom.operators.select import global_budget, newest_per_group
from riskloom.plans import jobs, restart
from riskloom.schemas import POST
from riskloom.streaming import flows
from tests.test_runs import AS_OF, landed  # noqa: F401

CONFIG = jobs.RunConfig(AS_OF)
VERSIONS = {"listing_pages": "1", "user_pages": "1"}
JOBS = ("collect_job", "enrich_job", "score_posts_job", "score_users_job")


@pytest.fixture()
def ran(monkeypatch):
    """Names of the jobs in the order in which they are run."""
    names = []
    for name in JOBS:
        def counted(*args, _name=name, _job=getattr(jobs, name), **more):
            names.append(_name)
            return _job(*args, **more)

        monkeypatch.setattr(jobs, name, counted)
    return names


def content(df):
    return sorted(map(str, df.collect()))


def test_a_restart_goes_on_at_the_failed_stage(spark, landed, tmp_path, ran, monkeypatch):
    out = str(tmp_path / "run")
    with monkeypatch.context() as broken:
        # Ends J3 after its table is written.
        broken.setattr(jobs.writers, "write_scored_posts_csv", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            restart.resumable_run(spark, *landed, out, CONFIG, VERSIONS)
    assert ran == list(JOBS[:3])
    assert restart.RunLog(spark, out).finished() == ["posts", "history"]
    ran.clear()
    risk = restart.resumable_run(spark, *landed, out, CONFIG, VERSIONS)
    assert ran == list(JOBS[2:])
    whole = jobs.full_run(spark, *landed, str(tmp_path / "whole"), CONFIG)
    assert content(risk) == content(whole)
    ran.clear()
    assert content(restart.resumable_run(spark, *landed, out, CONFIG, VERSIONS)) == content(whole)
    assert ran == []


def test_only_what_depends_on_a_change_runs_again(spark, landed, tmp_path, ran):
    out = str(tmp_path / "run")
    restart.resumable_run(spark, *landed, out, CONFIG, VERSIONS)
    ran.clear()
    restart.resumable_run(spark, *landed, out, CONFIG, {**VERSIONS, "user_pages": "2"})
    assert ran == ["enrich_job", "score_users_job"]
    ran.clear()
    strict = replace(CONFIG, model=replace(DEFAULT_MODEL, high=0.2))
    risk = restart.resumable_run(spark, *landed, out, strict, {**VERSIONS, "user_pages": "2"})
    assert ran == ["score_posts_job", "score_users_job"]
    assert content(risk) == content(jobs.full_run(spark, *landed, str(tmp_path / "whole"), strict))


def test_a_failed_rerun_is_not_taken_for_finished(spark, landed, tmp_path, monkeypatch):
    out = str(tmp_path / "run")
    restart.resumable_run(spark, *landed, out, CONFIG, VERSIONS)
    changed = {**VERSIONS, "listing_pages": "2"}
    with monkeypatch.context() as broken:
        broken.setattr(jobs.writers, "write_posts", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            restart.resumable_run(spark, *landed, out, CONFIG, changed)
    # Neither the new version nor the old one, whose table is overwritten.
    assert "posts" not in restart.RunLog(spark, out).finished()


def test_runs_need_versions_and_known_stages(spark, landed, tmp_path):
    with pytest.raises(ValueError, match="user_pages"):
        restart.resumable_run(spark, *landed, str(tmp_path), CONFIG, {"listing_pages": "1"})
    with pytest.raises(ValueError, match="no stage"):
        restart.resumable_run(spark, *landed, str(tmp_path), CONFIG, VERSIONS, until="end")


def test_profiles_train_once_for_a_restarted_run(spark, landed, tmp_path, monkeypatch):
    texts = [("en", "the house and the garden of the king"), ("de", "das Haus und der Garten des Herrn")]
    labelled = spark.createDataFrame(texts, "lang string, text string")
    versions = {**VERSIONS, "labelled": "1"}
    run = lambda **more: restart.resumable_run(
        spark, *landed, str(tmp_path / "run"), CONFIG, versions, labelled=labelled, **more
    )
    assert run(until="posts") is None
    monkeypatch.setattr(jobs, "train_profiles_job", lambda *_: 1 / 0)
    assert run().count() == 2


def post(number, group, day, text="t"):
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp() + 86400 * day
    return (str(number), None, group, "a", "", text, at, None)


def test_newest_posts_over_deliveries(spark, tmp_path):
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    kinds = [f.dataType.simpleString() for f in POST]
    schema = ", ".join(f"{n} {'double' if n == 'created_utc' else k}" for n, k in zip(POST.names, kinds))
    deliveries = [
        # One group with most rows, a null group, a tie on the time.
        [post(i, "hot", i % 17) for i in range(200)] + [post(900, None, 1), post(901, "few", 2)],
        # Delivered again: older, newer, the same.
        [post(16, "hot", 0), post(3, "hot", 40, "newer"), post(901, "few", 2)],
        [post(i, "hot", 16) for i in range(300, 310)] + [post(902, "few", 9)],
    ]
    seen = []
    for number, rows in enumerate(deliveries):
        frame = spark.createDataFrame(rows, schema)
        frame = frame.withColumn("created_utc", F.col("created_utc").cast(POST["created_utc"].dataType))
        frame.coalesce(1).write.mode("append").parquet(landing)
        stream = flows.stream_table(spark, landing, POST)
        got = flows.newest_stream(spark, stream, out, 5, buckets=4)
        latest = {}
        for row in (seen := seen + rows):
            key = row[2], row[0]
            latest[key] = max(latest.get(key, row), row, key=lambda r: r[6])
        groups = {}
        for row in latest.values():
            groups.setdefault(row[2], []).append(row)
        want = [
            (group, rank, r[0], r[5])
            for group, own in groups.items()
            for rank, r in enumerate(sorted(own, key=lambda r: (-r[6], r[0]))[:5], 1)
        ]
        rows = got.select("subreddit", "rank", "id", "text").collect()
        assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
        kept = flows.newest_store(spark, POST, "subreddit", out, 4).read("rows")
        assert kept.count() == len(want)
    budget = global_budget(got, "subreddit", ("few", "hot"), 5, 4)
    assert [r.subreddit for r in budget.collect()] == ["few", "few", "hot", "hot"]
    assert newest_per_group(kept, "subreddit", 1).count() == 3


def test_a_batch_of_posts_run_twice(spark, tmp_path):
    store = flows.newest_store(spark, POST, "subreddit", str(tmp_path), 4)
    text = lambda rows: spark.createDataFrame(
        [(r[0], r[2], r[6]) for r in rows], "id string, subreddit string, at double"
    ).select(*(
        F.col("at").cast(f.dataType).alias(f.name) if f.name == "created_utc"
        else F.col(f.name) if f.name in ("id", "subreddit") else F.lit(None).cast(f.dataType).alias(f.name)
        for f in POST
    ))
    one, two = text([post(1, "a", 1), post(2, "a", 2)]), text([post(3, "a", 3), post(4, "b", 1)])
    flows.newest_batch(store, one, 0, 2, "created_utc", "id")
    for _ in range(2):
        flows.newest_batch(store, two, 1, 2, "created_utc", "id")
        assert sorted(r.id for r in store.read("rows").collect()) == ["2", "3", "4"]


def test_profiles_of_deliveries_are_those_of_all_texts(spark, tmp_path):
    texts = [("en", "the king and the house"), ("de", "das Haus des Königs"), ("fr", "la maison du roi"),
             ("en", "weather and news"), ("de", None), (None, "nobody's words"), ("en", "ab")]
    frame = lambda rows: spark.createDataFrame(rows, "lang string, text string")
    store = jobs.profile_store(spark, str(tmp_path / "store"))
    for number, part in enumerate((texts[:2], texts[2:5], [], texts[5:])):
        jobs.add_to_profiles_job(store, frame(part), number)
    again = jobs.add_to_profiles_job(store, frame(texts[5:]), 3)
    assert again.version == 4 and len(again.buckets) <= 1
    assert content(jobs.stored_profiles(store)) == content(language.train_language_profiles(frame(texts)))
