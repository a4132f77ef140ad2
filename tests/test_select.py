"""Selection operators against plain Python, with and without split keys."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import select as sl

ITEM = "username string, kind string, id string, created_utc double"


def made_items(seed=1, n=600):
    """One user holds a third of the rows; many times are equal."""
    rng = random.Random(seed)
    users = ["hot"] * 5 + [f"u{i}" for i in range(10)]
    return [
        (rng.choice(users), rng.choice(["submission", "comment"]), f"i{i:04}", float(rng.randrange(200)))
        for i in range(n)
    ]


def by_user(rows, *keys):
    groups = {}
    for r in rows:
        groups.setdefault(tuple(r[k] for k in keys), []).append(r)
    return groups


def newest(rows):
    return sorted(rows, key=lambda r: (-r[3], r[2]))


def test_lookback_keeps_the_boundary(spark):
    as_of = dt.datetime(2024, 1, 11)
    edge = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp()
    df = spark.createDataFrame([(edge - 0.001,), (edge,), (edge + 1,)], "created_utc double")
    assert [r[0] for r in sl.lookback(df, as_of).collect()] == [edge, edge + 1]


def test_prefix_until_old(spark):
    rows = [(*r, i) for i, r in enumerate(made_items())]
    df = spark.createDataFrame(rows, ITEM + ", pos long")
    got = sl.prefix_until_old(df, ["username"], "pos", 10.0)
    want = set()
    for group in by_user(rows, 0).values():
        for r in group:
            if r[3] < 10.0:
                break
            want.add(r[2])
    assert sorted(r.id for r in got.collect()) == sorted(want)


def test_newest_per_group(spark):
    rows = made_items()
    got = sl.newest_per_group(spark.createDataFrame(rows, ITEM), "username", 7).collect()
    want = {
        (u, r[2], k + 1)
        for (u,), group in by_user(rows, 0).items()
        for k, r in enumerate(newest(group)[:7])
    }
    assert {(r.username, r.id, r["rank"]) for r in got} == want


@pytest.mark.parametrize("total", [0, 1, 9, 10, 17, 1000])
def test_global_budget(spark, total):
    sizes = {"a": 3, "b": 12, "c": 5, "d": 8, "other": 50}
    rows = [(g, f"{g}{i:02}", float(i)) for g, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "g string, id string, created_utc double")
    order = ("b", "missing", "a", "d", "c")
    taken = sl.global_budget(sl.newest_per_group(df, "g", 6), "g", order, per_group=6, total=total)
    got = {g: 0 for g in sizes} | {r.g: r["count"] for r in taken.groupBy("g").count().collect()}
    want, left = {g: 0 for g in sizes}, total
    for g in order:
        take = min(sizes.get(g, 0), 6, left)
        left -= take
        if g in want:
            want[g] = take
    assert got == want and sum(got.values()) <= total


@pytest.mark.parametrize("max_items", [0, 1, 2, 7, 40, 10_000])
def test_split_budget(spark, max_items):
    rows = made_items() + [("quiet", "comment", f"q{i}", 1.0) for i in range(9)]
    got = sl.split_budget(spark.createDataFrame(rows, ITEM), max_items).collect()
    want = set()
    for group in by_user(rows, 0).values():
        subs = [r for r in newest(group) if r[1] == "submission"][: (max_items + 1) // 2]
        comments = [r for r in newest(group) if r[1] == "comment"][: max_items - len(subs)]
        want |= {r[2] for r in subs + comments}
    assert sorted(r.id for r in got) == sorted(want)


@pytest.mark.parametrize("times", [200, 1])
def test_newest_first_rank(spark, times):
    rows = [(*r[:3], r[3] % times) for r in made_items()]
    df = spark.createDataFrame(rows, ITEM)
    # Keep the ranges of this small table apart.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = sl.newest_first_rank(df)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {
        (r[2], k + 1) for group in by_user(rows, 0).values() for k, r in enumerate(newest(group))
    }
    assert {(r.id, r["rank"]) for r in ranked.collect()} == want
    ordered = [r.id for r in sl.newest_first(df).where("username = 'hot'").collect()]
    assert ordered == [r[2] for r in newest(by_user(rows, 0)[("hot",)])]


def test_merge_new_wins_by_user_and_is_idempotent(spark):
    old = spark.createDataFrame(made_items(1), ITEM)
    new = spark.createDataFrame([("hot", "comment", "n1", 1.0), ("new", "comment", "n2", 1.0)], ITEM)
    keys = spark.createDataFrame([("hot",), ("new",), ("u1",)], "username string")
    once = sl.merge_new_wins(old, new, keys)
    want = {r[2] for r in made_items(1) if r[0] not in ("hot", "u1")} | {"n1", "n2"}
    assert {r.id for r in once.collect()} == want
    twice = sl.merge_new_wins(once, new, keys)
    assert sorted(r.id for r in twice.collect()) == sorted(want)


def test_attach_history(spark):
    rows = made_items()
    authors = spark.createDataFrame([("hot",), ("u1",), ("idle",)], "username string")
    got = sl.attach_history(authors, spark.createDataFrame(rows, ITEM)).collect()
    want = [(r[0], r[2]) for r in rows if r[0] in ("hot", "u1")] + [("idle", None)]
    assert sorted((r.username, r.id or "") for r in got) == sorted((u, i or "") for u, i in want)


def test_top_n_writes_at_most_n_rows_per_group_and_task(spark):
    df = spark.range(0, 60_000, numPartitions=6).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise("cold").alias("g"),
        F.col("id").cast("string").alias("id"),
        (F.col("id") % 97).cast("double").alias("created_utc"),
    )
    ranked = sl.newest_per_group(df, "g", 5)
    assert ranked.count() == 10
    ranked.collect()
    plan = ranked._jdf.queryExecution().executedPlan()
    written = []

    def walk(node):
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            written.append(node.metrics().apply("shuffleRecordsWritten").value())
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            return walk(node.plan())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    assert max(written) <= 2 * 6 * 5


def test_null_users_are_ranked_too(spark):
    rows = [(None, "comment", f"n{i}", float(i)) for i in range(5)] + [("u", "comment", "a", 1.0)]
    got = sl.newest_first_rank(spark.createDataFrame(rows, ITEM)).collect()
    assert sorted((r.id, r["rank"]) for r in got) == [("a", 1)] + [(f"n{i}", 5 - i) for i in range(5)]


def test_authors_and_promoted(spark):
    df = spark.createDataFrame([("b",), ("",), (None,), ("a",), ("b",)], "author string")
    assert sorted(r.username for r in sl.unique_authors(df).collect()) == ["a", "b"]
    marks = spark.createDataFrame([("true",), ("True",), (None,), ("",)], "promoted string")
    assert sl.drop_promoted(marks).count() == 3


def test_top_risky_breaks_ties_by_id(spark):
    df = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.9)], "id string, risk_score double")
    assert [r.id for r in sl.top_risky(df, 2).collect()] == ["c", "a"]
