"""Bucketed stores: what a run rewrites, repeats, failures, and the jobs on them."""

from __future__ import annotations


import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.pages import extract_posts
from riskloom.plans import jobs
from riskloom.schemas import HISTORY
from riskloom.sources.buckets import BucketStore
from riskloom.streaming import flows
from test_runs import AS_OF, landed  # noqa: F401

ROW = T.StructType().add("k", "string").add("n", "long").add("v", "string")


def store_at(spark, path, buckets=64):
    return BucketStore(spark, str(path), "k", {"rows": ROW}, buckets)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_a_run_writes_the_buckets_of_its_keys_only(spark, tmp_path):
    history = jobs.history_store(spark, str(tmp_path), buckets=1000)
    people = spark.range(2000).select(F.concat(F.lit("u"), "id").alias("username"))
    empty = spark.createDataFrame([], HISTORY)
    first = jobs.merge_into_history(history, people, empty)
    assert first.rows == {"users": 2000, "items": 0} and len(first.buckets) > 800
    before = history.manifest()
    # One user in a hundred is new or fetched again.
    again = spark.createDataFrame([(f"u{i}",) for i in range(1995, 2015)], "username string")
    items = spark.createDataFrame([("u1999", "i", "", "", "", "comment", "x", 1.0)], HISTORY)
    second = jobs.merge_into_history(history, again, items)
    assert len(second.buckets) <= 20 and second.rows["items"] == 1
    assert second.rows["users"] < 120
    after = history.manifest()
    same = [k for k, path in before.items() if after[k] == path]
    assert len(same) >= len(before) - 20
    assert history.read("users").count() == 2015 and history.read("items").count() == 1


def test_known_users_with_items_are_replaced_whole(spark, landed, tmp_path):  # noqa: F811
    listing, pages = landed
    store = jobs.history_store(spark, f"{tmp_path}/history", buckets=8)
    people = spark.createDataFrame([("ann",), ("old",), ("sam",)], "username string")
    held = [("ann", "a0", 5.0), ("ann", "a9", 6.0), ("old", "o", 7.0), ("sam", "s0", 8.0)]
    held = spark.createDataFrame([(u, i, "", "", u, "comment", "x", t) for u, i, t in held], HISTORY)
    jobs.merge_into_history(store, people, held)
    posts, cfg = extract_posts(listing), jobs.RunConfig(AS_OF)
    again = spark.createDataFrame([("ann",), ("gone",)], "username string")
    done = jobs.enrich_store_job(spark, posts, pages, store, f"{tmp_path}/out", cfg, again)
    assert done.version == 2
    # bob and eve are new; gone was never known and has no pages; sam stays as held.
    assert rows_of(store.read("users")) == [("ann",), ("bob",), ("eve",), ("gone",), ("old",), ("sam",)]
    assert rows_of(store.read("items").select("username", "id")) == [("ann", "a1"), ("old", "o"), ("sam", "s0")]
    # Nothing is left to fetch: no bucket is written.
    done = jobs.enrich_store_job(spark, posts, pages, store, f"{tmp_path}/out2", cfg)
    assert (done.version, done.buckets, done.rows) == (3, [], {"users": 0, "items": 0})
    assert store.read("users").count() == 6


def test_a_batch_rewrites_its_buckets_and_may_run_twice(spark, tmp_path):
    store = store_at(spark, tmp_path)
    rows = spark.range(5000).selectExpr("concat('k', id) as k", "id as n", "'a' as v")
    flows.upsert_batch(store, rows, 0, ["n"])
    before = store.manifest()
    assert len(before) == 64
    keys, seen = [], set()
    for r in rows.withColumn("b", store.bucket()).orderBy("n").collect():
        if len(seen) < 3 or r.b in seen:
            seen.add(r.b)
            keys.append(r.k)
        if len(keys) > 20:
            break
    batch = spark.createDataFrame([(k, 9999, "b") for k in keys] + [(keys[0], -1, "c")], ROW)
    done = flows.upsert_batch(store, batch, 1, ["n"])
    assert done.buckets == sorted(seen) and len(seen) == 3 and done.rows["rows"] < 400
    changed = {b for (_, b), path in store.manifest().items() if before["rows", b] != path}
    assert changed == seen
    once = rows_of(store.read("rows"))
    assert len(once) == 5000 and sum(v == "b" for _, _, v in once) == len(keys)
    # The same batch again, as after a failure between its commit and the checkpoint.
    assert flows.upsert_batch(store, batch, 1, ["n"]).version == done.version
    assert rows_of(store.read("rows")) == once
    flows.upsert_batch(store, batch.limit(1), 2, ["n"])
    flows.upsert_batch(store, batch.limit(1), 3, ["n"])
    assert store.versions() == [3, 4]
    # Nothing but the last two versions' buckets is on disk.
    held = {f.split("/bucket_no")[0].rsplit("/", 1)[1] + f.rsplit("=", 1)[1] for f in store._listed(f"{tmp_path}/data/*/bucket_no=*")}
    live = {*store.manifest(3).values(), *store.manifest(4).values()}
    assert held == {f.split("/bucket_no")[0].rsplit("/", 1)[1] + f.rsplit("=", 1)[1] for f in live}


def test_a_failure_before_the_commit_changes_nothing(spark, tmp_path):
    store = store_at(spark, tmp_path, 4)
    good = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), (None, 3, "z")], ROW)
    store.write({"rows": good}, store.touched(good))
    bad = good.withColumn("v", F.when(F.col("n") < 9, F.raise_error(F.lit("lost"))).cast("string"))
    with pytest.raises(Exception, match="lost"):
        store.write({"rows": bad}, range(4))
    assert store.versions() == [1] and store.read("rows").count() == 3
    with pytest.raises(Exception, match="not replaced"):
        store.write({"rows": good}, [])
    assert rows_of(store.read("rows").na.fill("")) == [("", 3, "z"), ("a", 1, "x"), ("b", 2, "y")]


def test_reading_some_buckets_lists_no_others(spark, tmp_path):
    store = store_at(spark, tmp_path, 16)
    assert store.read("rows").count() == 0 and store.manifest() == {}
    rows = spark.range(400).selectExpr("concat('k', id) as k", "id as n", "'a' as v")
    store.write({"rows": rows}, range(16))
    some = store.read("rows", [3, 5])
    assert all("bucket_no=3/" in f or "bucket_no=5/" in f for f in some.inputFiles())
    assert {r.b for r in some.select(store.bucket().alias("b")).distinct().collect()} == {3, 5}


def test_a_frequent_key_is_written_by_several_tasks(spark, tmp_path):
    store = store_at(spark, tmp_path, 4)
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        rows = spark.range(0, 40_000, 1, 8).selectExpr("'hot' as k", "id as n", "sha2(string(id), 256) as v")
        store.write({"rows": rows}, store.touched(rows))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    assert len(store.manifest()) == 1 and len(store.read("rows").inputFiles()) > 1
    assert store.read("rows").count() == 40_000
