"""Every registered query against its SQL counterpart, and the shape of the plans."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from bindings import load_all, tables
from riskloom.operators import posts, select, users
from riskloom.plans import jobs
from tools.compare import database, rows

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = load_all().QUERIES, load_all().ORACLES


@pytest.fixture(scope="module")
def db():
    return database(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    got = rows(df.columns, df.collect())
    result = db.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == rows(columns, result.fetchall())


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_scoring_does_not_shuffle(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    scored = posts.scored_records(tables.as_posts(df))
    assert "Exchange" not in plan(scored)
    # Without the explanation nothing but the score's inputs is computed.
    only = plan(posts.score_posts(tables.as_posts(df)).select("id", "risk_score"))
    assert "no explicit harmful" not in only and "format_number" not in only


def test_lookback_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "items")
    tables.activity(spark, SF).write.parquet(path)
    recent = select.lookback(spark.read.parquet(path), dt.datetime(2024, 1, 31))
    text = plan(recent.select("id"))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(created_utc", text)
    assert re.search(r"ReadSchema: struct<id:string,created_utc:double>", text)


def test_top_n_limits_before_its_shuffles(spark):
    df = spark.read.parquet(f"{SF}/events.parquet").withColumn("created_utc", F.col("value"))
    text = plan(select.newest_per_group(df.withColumnRenamed("event_id", "id"), "event_type", 30))
    assert text.count("WindowGroupLimit") == 4  # partial and final, in both rounds


def test_user_stats_combine_before_the_shuffle(spark):
    df = spark.read.parquet(f"{SF}/events.parquet").select(
        F.col("user_id").alias("username"), F.col("value").alias("score"), "props"
    )
    text = plan(users.user_stats(df.select("username", "score")))
    assert "partial_max" in text and "ReadSchema: struct<user_id:bigint,value:double>" in text


@pytest.mark.parametrize(
    "name",
    [n for n in QUERIES if n[0] in "lurp" and not n.startswith("l6")],
)
def test_no_cross_joins_and_no_global_windows(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "SinglePartition" not in text or "Window" not in text


def test_collecting_parses_each_page_once_and_shuffles_no_page(spark):
    listing = spark.createDataFrame(
        [("g", 1, "u", "<div class='thing'>", 200, 1)],
        "group_name string, page_no int, url string, html string, status int, attempt int",
    )
    df = jobs.collect(listing, jobs.RunConfig(dt.datetime(2024, 1, 1), groups=("g",)))
    text = plan(df)
    assert text.count("ArrowEvalPython") == 1
    shuffled = df._jdf.queryExecution().optimizedPlan().toString()
    above_parse = shuffled[: shuffled.index("ArrowEvalPython")]
    assert "html" not in above_parse


@pytest.mark.parametrize("few", [True, False])
def test_histories_parse_each_page_once_and_shuffle_no_body(spark, monkeypatch, few):
    monkeypatch.setattr(jobs, "few", lambda keys: few)
    pages = spark.createDataFrame(
        [("u", "comment", 1, "l", "<div class='thing'>", 200, 1)],
        "username string, kind string, page_no int, url string, html string, status int, attempt int",
    )
    authors = spark.createDataFrame([("u",)], "username string")
    df = jobs.pages_of(pages, authors)
    assert plan(df).count("ArrowEvalPython") == 1
    logical = df._jdf.queryExecution().optimizedPlan().toString()
    assert "html" not in logical[: logical.index("ArrowEvalPython")]


def test_every_query_is_registered_once(spark):
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
