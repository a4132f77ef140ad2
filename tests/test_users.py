from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from riskloom.operators import users as us
from riskloom.operators.users import FROM_HISTORY, FROM_POSTS, NO_ACTIVITY
from riskloom.schemas import HISTORY

# Nine words, one of them violent, and a threat: 0.30 * 1/3 + 0.15 + 0.15.
HARSH = "Anyone who plans a massacre should be wiped out."
CALM = ["The ferry leaves at noon.", "Bread rises slowly here.", "Our garden has new roses."]


def item(user, n, text):
    return (user, f"{user}{n}", "", "", user, "comment", text, float(n))


@pytest.fixture(scope="module")
def scored(spark):
    users = spark.createDataFrame(
        [(u,) for u in ("mira", "jonas", "adele", "kofi", "lena", "jonas")], "username string"
    )
    rows = [item("mira", 0, HARSH), item("lena", 0, CALM[0]), item("stranger", 0, HARSH)]
    rows += [item("jonas", i, t) for i, t in enumerate(CALM)]
    items = spark.createDataFrame(rows, HISTORY)
    fallback = spark.createDataFrame([("adele", 0.9), ("lena", 0.9)], "author string, score double")
    return {r.username: r for r in us.score_users(users, items, fallback).collect()}


def test_users_are_the_given_ones(scored):
    assert set(scored) == {"mira", "jonas", "adele", "kofi", "lena"}


def test_single_item(scored):
    row = scored["mira"]
    assert row.score == pytest.approx(0.40) and row.label == "low"
    assert (row.count_high_posts, row.total_posts) == (0, 1)
    assert row.explanation == (
        "0 high-risk posts out of 1 items; max_post_score=0.40; user_score=0.40 (low); "
        f"{FROM_HISTORY}; low-confidence estimate (only 1 items available)."
    )


def test_calm_items(scored):
    row = scored["jonas"]
    assert (row.score, row.label, row.total_posts, row.average_score) == (0.0, "low", 3, 0.0)


def test_fallback_only(scored):
    row = scored["adele"]
    assert row.score == pytest.approx(0.9 + 0.2 * math.log(2)) and row.score > 1
    assert row.label == "high" and FROM_POSTS in row.explanation


def test_no_activity(scored):
    row = scored["kofi"]
    assert (row.score, row.max_post_score, row.total_posts) == (0.0, 0.0, 0)
    assert row.label == "low" and row.explanation == NO_ACTIVITY


def test_fallback_is_ignored_with_history(scored):
    assert scored["lena"].score == 0.0 and FROM_HISTORY in scored["lena"].explanation


def test_confident_from_five_items_and_custom_thresholds(spark):
    users = spark.createDataFrame([("u",)], "username string")
    scores = spark.createDataFrame([("u", 0.3)] * 5, "username string, score double")
    (row,) = us.score_users_from_scores(users, scores, high=0.3, medium=0.1).collect()
    assert row.count_high_posts == 5 and row.label == "high"
    assert row.score == pytest.approx(0.3 + 0.2 * math.log(6))
    assert "low-confidence" not in row.explanation


def test_mean_does_not_depend_on_order(spark):
    values = [0.1, 0.7, 1 / 3, 0.15, 2 / 3, 0.05] * 50
    df = spark.createDataFrame([("u", v) for v in values], "username string, score double")
    means = {
        us.user_stats(df.repartition(n).sortWithinPartitions(order)).first().average_score
        for n in (1, 3, 7)
        for order in (F.asc("score"), F.desc("score"))
    }
    assert len(means) == 1


def test_row_level_fallback(spark):
    users = spark.createDataFrame([("a",), ("b",), ("c",)], "username string")
    own = spark.createDataFrame([("a", 0.5), ("x", 0.1)], "username string, score double")
    posted = spark.createDataFrame(
        [("a", 0.9), ("y", 0.9)] + [("b", i / 100) for i in range(50)], "author string, score double"
    )
    got = us.with_fallback(users, own, posted).collect()
    assert sorted((r.username, r.score, r.from_posts) for r in got) == sorted(
        [("a", 0.5, False)] + [("b", i / 100, True) for i in range(50)]
    )


def test_fallback_scores_drop_what_cannot_be_used(spark):
    rows = [("", "0.5"), (None, "0.5"), ("a", None), ("a", "abc"), ("a", "0.25"), ("a", "0.75")]
    df = spark.createDataFrame(rows, "author string, risk_score string")
    assert sorted(map(tuple, us.fallback_scores(df).collect())) == [("a", 0.25), ("a", 0.75)]
