"""Landed pages: parsing, normalising, usable attempts."""

from __future__ import annotations

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from riskloom.functions import normalize as nz
from riskloom.operators import pages as pg
from riskloom.sources.listing_html import parse_listing

PAGE = """<!DOCTYPE html><html><head><title>x</title><script>'<div class="thing">'</script></head><body>
<div class="side"><div class="md">sidebar</div></div>
<div class="thing promoted" data-promoted="true" data-fullname="t3_ad" data-timestamp="1700000000"></div>
<div class='link  thing' data-fullname="t3_ms" data-timestamp="1700000000123" data-subreddit="news"
  data-author="ann" data-permalink=" /r/news/ms " data-url="http://other"><p>
  <a class="title may-blank" href="#"> Fish &amp; <b>chips </b><!-- c --> now</a><img src=x><br>
  <div class="expando"><div class="md"><p>first &lt;line&gt;</p>
   <p> second <a>link</a></p><style>p{}</style></div></div></div>
<div class=thing id="thing_t3_s" data-timestamp="1700000001" data-url="https://abs/x"></div>
<div class="thing" id="iso" data-timestamp="soon"><time datetime="2024-01-01T00:00:00+02:00">t</time></div>
<div class="thing" id="naive"><time datetime="2024-01-01T00:00:00"></time><div class="md">own text</div></div>
<div class="thing" id="bad"><time>t</time><time datetime="2024-01-01"></time></div>
<div class="thing" id="" data-timestamp="5"></div>
<div class="thing" data-timestamp="5"></div>
<div class="nothing" id="no" data-timestamp="5"></div>
<div class="nav"><span class="next-button"><b><a href="/next?a=1&amp;b=2">n</a></b><a href="/no"></a></span></div>
<div class="md">footer</div></body></html>"""


def page(spark, html, **columns):
    df = spark.createDataFrame([(html,)], "html string")
    return df.withColumns({k: F.lit(v) for k, v in columns.items()})


def test_listing_page_to_posts(spark):
    posts = pg.extract_posts(page(spark, PAGE, group_name="fallback"), "https://base")
    got = {r.id: r for r in posts.collect()}
    assert set(got) == {"ms", "s", "iso", "naive"}
    ms = got["ms"]
    assert (ms.subreddit, ms.author, ms.url) == ("news", "ann", "https://base/r/news/ms")
    assert ms.title == "Fish &chipsnow"
    assert ms.text == "Fish &chipsnow\n\nfirst <line>\nsecond\nlink"
    assert ms.created_utc == 1700000000.123
    s = got["s"]
    assert (s.subreddit, s.author, s.url) == ("fallback", "[deleted]", "https://abs/x")
    assert (s.title, s.text, s.created_utc) == ("", "", 1700000001.0)
    assert got["iso"].created_utc == 1704067200.0 - 7200
    assert got["naive"].created_utc == 1704067200.0 and got["naive"].text == ""


def test_user_page_to_items(spark):
    df = page(spark, PAGE, username="bob", kind="comment")
    got = {r.id: r for r in pg.extract_items(df).collect()}
    assert set(got) == {"ad", "ms", "s", "iso", "naive"}  # promoted ones are not dropped here
    assert got["ms"].text == "first <line>\nsecond\nlink" and got["ms"].author == "ann"
    assert got["s"].author == "bob" and got["s"].subreddit == ""
    assert got["naive"].text == "own text" and got["naive"].kind == "comment"


def test_old_item_ends_a_user_listing(spark):
    def thing(i, ts):
        return f'<div class="thing" id="t1_{i}" data-timestamp="{ts}"></div>'

    rows = [
        ("u", "comment", 1, thing("a", 50) + thing("b", 10) + thing("c", 60)),
        ("u", "comment", 2, thing("d", 70)),
        ("u", "submission", 1, thing("e", 40)),
    ]
    df = spark.createDataFrame(rows, "username string, kind string, page_no int, html string")
    assert {r.id for r in pg.extract_items(df, 30.0).collect()} == {"a", "e"}
    assert {r.id for r in pg.extract_items(df).collect()} == {"a", "b", "c", "d", "e"}


@pytest.mark.parametrize(
    "html, link",
    [
        (PAGE, "/next?a=1&b=2"),
        ("<span class='next-button'><a>no href</a><a href='/x'></a></span>", None),
        ("<span class='next-button'></span><a href='/x'></a>", None),
        ("<span class='next-button'/><span class='next-button'><a href=y></a></span>", None),
        ("<span class='next-button'><a href='/1'></a></span><span class='next-button'><a href='/2'>", "/1"),
        ("", None),
    ],
)
def test_next_link(html, link):
    assert parse_listing(html)["next"] == link


def test_unclosed_and_stray_tags():
    html = (
        '</div></p><div class="thing" id="a"><div class="expando"><p>x<p>y</div>'
        '<div class="expando"><div class="md">z<br>w</i> v</div></div><div class="md">later</div>'
        '</div><div class="thing" id="b"><a class="title">open'
    )
    a, b = parse_listing(html)["items"]
    assert a["expando_text"] is None and a["md_text"] == "z\nw\nv"
    assert b["element_id"] == "b" and b["title"] == "open"


def test_nested_items_share_inner_text():
    html = '<div class="thing" id="o"><div class="thing" id="i"><div class="md">t</div></div></div>'
    outer, inner = parse_listing(html)["items"]
    assert (outer["element_id"], outer["md_text"]) == ("o", "t")
    assert (inner["element_id"], inner["md_text"]) == ("i", "t")


def test_a_failing_page_is_a_row(spark, monkeypatch):
    df = page(spark, None)
    (row,) = df.select(pg.parse_page("html").alias("p")).collect()
    assert row.p.error is None and row.p["items"] == []
    assert pg.page_errors(page(spark, PAGE, page_id=1), "page_id").count() == 0


def test_pages_go_to_python_in_small_batches(spark, capsys):
    """Arrow batches hold 10,000 rows, of pages of any length."""
    pages = spark.range(2500).select(
        "id", F.concat(F.lit('<div class="thing" id="'), "id", F.lit('"><div class="md">t</div></div>')).alias("html"),
        F.lit("g").alias("group_name"), F.lit(200).alias("status"),
    ).coalesce(1)
    for rows in (pg.parsed_pages(pages), pg.raw_items(pages, "id"), pages.select(pg.next_link(F.col("html")))):
        capsys.readouterr()
        rows.explain()
        plan = capsys.readouterr().out
        assert "BatchEvalPython" in plan and "Arrow" not in plan and "Pandas" not in plan
    got = pg.raw_items(pages, "id")
    assert got.where("raw_element_id = id and raw_md_text = 't' and item_no = 0").count() == got.count() == 2500


def test_epoch_forms(spark):
    attrs = [
        ("1700000000", 1700000000.0), (" 1700000000123 ", 1700000000.123), ("10000000000", 1e10),
        ("10000000001", 10000000.001), ("1_000", 1000.0), ("+5", 5.0), ("-5", -5.0), ("0", 0.0),
        ("1.5", None), ("", None), ("x", None), (None, None),
    ]
    df = spark.createDataFrame(attrs, "a string, want double")
    for r in df.select("a", "want", nz.normalize_epoch(F.col("a"), F.lit(None).cast("string")).alias("got")).collect():
        assert r.got == r.want, r.a


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_iso_forms_match_python_in_any_session_zone(spark, zone):
    forms = [
        "2024-01-01", "2024-01-01T05", "2024-01-01T05Z", "2024-01-01T05:06", "2024-02-29 05:06:07",
        "2024-01-01T05:06:07.5", "2024-01-01T05:06:07.123456+00:00", "2024-01-01T05:06:07,25+0200",
        "2024-01-01T05:06-03", "2024-1-1", "2024", "x", "", "2024-13-01", "2024-01-01T25:00",
    ]

    def python(text):
        try:
            moment = dt.datetime.fromisoformat(text)
        except ValueError:
            return None
        return (moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc)).timestamp()

    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(f,) for f in forms if f != "2024-01-01T25:00"], "t string")
        got = df.select("t", nz.normalize_epoch(F.lit(None).cast("string"), F.col("t")).alias("e"))
        for r in got.collect():
            assert r.e == python(r.t), r.t
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_item_ids(spark):
    rows = [("t3_a", "x", "a"), ("", "thing_t1_b", "b"), (None, "c", "c"), ("", "", None), ("t3_", None, "")]
    df = spark.createDataFrame(rows, "f string, i string, want string")
    for r in df.select("want", nz.item_id(F.col("f"), F.col("i")).alias("got")).collect():
        assert r.got == r.want


ATTEMPTS = [
    # listing, page_no, url, (status per attempt)
    ("g", 1, "g1", (200,)),
    ("g", 2, "g2", (500, 200)),
    ("g", 3, "g3", (403, 200)),
    ("g", 4, "g4", (200,)),
    ("h", 1, "h1", (500, 500, 200)),
    ("h", 2, "h2", (200, 404)),
    ("k", 1, "k1", (None, 200)),
    ("k", 2, "k2", (200, 200)),
]


@pytest.mark.parametrize("broadcast_keys", [1, 1_000_000])
def test_usable_pages(spark, broadcast_keys):
    rows = [
        (g, n, url, i + 1, s, f"{url}#{i + 1}")
        for g, n, url, statuses in ATTEMPTS
        for i, s in enumerate(statuses)
    ]
    df = spark.createDataFrame(
        rows, "g string, page_no int, url string, attempt int, status int, html string"
    )
    alone = {r.html for r in pg.usable_pages(df).collect()}
    assert alone == {"g1#1", "g2#2", "g4#1", "h2#1", "k1#2", "k2#1"}
    listed = pg.usable_pages(df, ["g"], broadcast_keys=broadcast_keys).collect()
    assert {r.html for r in listed} == {"g1#1", "g2#2", "k1#2", "k2#1"}
    shared = [("a", 1, "x", 1, 404, "gone"), ("a", 2, "dup", 1, 200, "in a"), ("b", 1, "dup", 1, 200, "in b")]
    both = pg.usable_pages(spark.createDataFrame(shared, df.schema), ["g"], broadcast_keys=broadcast_keys)
    assert [r.html for r in both.collect()] == ["in b"]


def test_items_without_end_are_refused_at_once(spark):
    page = "<div class='thing'>some text " * 4000
    row = spark.createDataFrame([(page,)], "html string").select(pg.parse_page("html").alias("p")).first()
    assert row.p["items"] == [] and "64 items" in row.p["error"]
    assert len(parse_listing("<div class='thing'>" * 64)["items"]) == 64
    start = time.perf_counter()
    with pytest.raises(ValueError):
        parse_listing(page)
    assert time.perf_counter() - start < 0.5
