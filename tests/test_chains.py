"""Ranks along links, page numbers from next links, and the jobs on pages without numbers."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from test_runs import AS_OF, START, USER_PAGES, thing

from riskloom.operators import chains, pages
from riskloom.plans import jobs


def ranks(spark, links, starts):
    links = spark.createDataFrame(links, "id string, next string")
    starts = spark.createDataFrame([(s,) for s in starts], "id string")
    return {r.id: r.rank for r in chains.chain_ranks(links, starts).collect()}


def walked(links, starts):
    on, out = dict(links), {}
    for start in starts:
        at, rank = start, 1
        while at is not None and out.get(at, 1 << 60) > rank:
            out[at] = rank
            at, rank = on.get(at), rank + 1
    return out


def test_a_thousand_pages_take_about_ten_rounds(spark, monkeypatch):
    names = [f"p{i}" for i in range(1000)]
    random.Random(1).shuffle(names)
    links = list(zip(names, [*names[1:], None]))
    rounds = []
    kept = chains.staged
    monkeypatch.setattr(chains, "staged", lambda df, name: (rounds.append(name), kept(df, name))[1])
    assert ranks(spark, links, names[:1]) == {n: i + 1 for i, n in enumerate(names)}
    assert rounds.count("reached") <= 13


@pytest.mark.parametrize(
    "links, starts",
    [
        ([("a", "b"), ("b", "c"), ("c", None)], ["a"]),
        # Back to the middle, back to the start, onto itself.
        ([("a", "b"), ("b", "c"), ("c", "b")], ["a"]),
        ([("a", "b"), ("b", "a")], ["a"]),
        ([("a", "a")], ["a"]),
        # A cycle that no start leads to, a broken chain, a start without a row.
        ([("a", "b"), ("x", "y"), ("y", "x"), ("c", "d")], ["a"]),
        ([("a", "gone"), ("b", "c")], ["a", "alone"]),
        # Two chains that meet: the shorter way counts.
        ([("a", "b"), ("b", "m"), ("m", "n"), ("s", "m")], ["a", "s"]),
        ([], ["a"]),
        ([("a", "b")], []),
    ],
)
def test_ranks_are_those_of_a_walk(spark, links, starts):
    assert ranks(spark, links, starts) == walked(links, starts)


def test_first_pages_by_their_url(spark):
    urls = ["https://x/r/a/new/", "https://x/r/a/new/?count=25&after=t3_1", "https://x/?after=1", None, "https://x/after=1"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in df.select(chains.opens_listing(F.col("url"))).collect()] == [True, False, False, True, True]


def link(url):
    return f'<span class="next-button"><a href="{url}">on</a></span>'


@pytest.fixture(scope="module")
def chained(spark):
    old = START - 9
    rows = [
        # ann: pinned old item first; bob: three pages, the middle one with a second attempt.
        ("ann", "comment", "/u/ann", thing("a0", old, "ann", "pin") + thing("a1", START, "ann", "x"), 200, 1),
        ("bob", "comment", "https://f/u/bob", thing("b1", START + 3, "bob", "x") + link("https://f/u/bob?after=2"), 200, 1),
        ("bob", "comment", "https://f/u/bob?after=2", None, 500, 1),
        ("bob", "comment", "https://f/u/bob?after=2", thing("b2", START + 2, "bob", "x") + link("https://f/u/bob?after=3"), 200, 2),
        ("bob", "comment", "https://f/u/bob?after=3", thing("b3", START + 1, "bob", "x") + thing("b4", old, "bob", "x"), 200, 1),
        # cat: the middle page is lost, so the last one is not reached. Its link to the first is no way in.
        ("cat", "comment", "https://f/u/cat", thing("c1", START + 3, "cat", "x") + link("https://f/u/cat?after=2"), 200, 1),
        ("cat", "comment", "https://f/u/cat?after=2", None, 404, 1),
        ("cat", "comment", "https://f/u/cat?after=3", thing("c3", START, "cat", "x") + link("https://f/u/cat"), 200, 1),
        # The same url in another listing is another page.
        ("cat", "submission", "https://f/u/bob?after=3", thing("c9", START, "cat", "x"), 200, 1),
    ]
    schema = USER_PAGES.replace("page_no int, ", "")
    return spark.createDataFrame(rows, schema)


def test_numbers_come_from_links(spark, chained):
    parsed = pages.parsed_pages(chained)
    found = chains.page_numbers(parsed, ["username", "kind"])
    got = {(r.username, r.kind, r.url.rsplit("/", 1)[1]): r.page_no for r in found.collect()}
    assert got == {
        ("ann", "comment", "ann"): 1,
        ("bob", "comment", "bob"): 1,
        ("bob", "comment", "bob?after=2"): 2,
        ("bob", "comment", "bob?after=3"): 3,
        ("cat", "comment", "cat"): 1,
        ("cat", "comment", "cat?after=2"): 2,
    }
    # Landed pages are parsed for their links on the way.
    keys = pages.usable_keys(chained, ["username", "kind"]).collect()
    assert sorted((r.username, r.page_no, r.attempt) for r in keys) == [
        ("ann", 1, 1), ("bob", 1, 1), ("bob", 2, 2), ("bob", 3, 1), ("cat", 1, 1)
    ]


@pytest.mark.parametrize("stop, want", [(True, ["b1", "b2", "b3", "c1"]), (False, ["a1", "b1", "b2", "b3", "c1"])])
def test_enrichment_of_pages_without_numbers(spark, chained, tmp_path, stop, want):
    posts = spark.createDataFrame([("ann",), ("bob",), ("cat",)], "author string")
    cfg = jobs.RunConfig(AS_OF, stop_at_old=stop)
    _, items = jobs.enrich_job(spark, posts, chained, None, str(tmp_path), cfg)
    assert sorted(r.id for r in items.collect()) == want
    none = jobs.enrich_job(spark, posts, chained.limit(0), None, f"{tmp_path}/none", cfg)[1]
    assert none.isEmpty()
