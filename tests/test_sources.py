from __future__ import annotations

import csv
import glob
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from riskloom.operators import posts, users
from riskloom.schemas import HISTORY, ITEM, POST
from riskloom.sources import readers, staging, writers

POST_ROW = dict(id="1", url="u", subreddit="s", author="a", title="t", text="x", created_utc=1.5)
ITEM_ROW = dict(id="1", url="u", subreddit="s", author="a", kind="comment", text="x", created_utc=1.0)


def write(path, value):
    path.write_text(json.dumps(value, ensure_ascii=False), encoding="utf-8")
    return str(path)


def test_lenient_array(spark, tmp_path):
    data = [
        POST_ROW,
        5,
        "text",
        None,
        [POST_ROW],
        {"id": 7, "selftext": "self", "created_utc": "12.5", "language": "de"},
        {"id": "8", "text": "", "selftext": "ſ – “quoted”", "author": None},
        {},
    ]
    got = readers.read_posts(spark, write(tmp_path / "p.json", data)).collect()
    assert got[0].asDict() == {**POST_ROW, "language": None}
    assert [(r.id, r.text, r.created_utc, r.language, r.author) for r in got[1:]] == [
        ("7", "self", 12.5, "de", ""), ("8", "ſ – “quoted”", 0.0, None, ""), ("", "", 0.0, None, ""),
    ]


TRICKY = [
    {"id": "1", "text": 'braces },{ ]} "quoted" \\', "title": "\\\\"},
    3,
    {"id": "2", "text": "}", "selftext": "[{", "url": '"}'},
    {},
    "}{",
    [{"id": "no"}, [{}]],
    {"id": "3", "extra": {"a": [{"b": "}"}]}, "text": "\n}\n"},
    {"id": "4", "text": "“}” \t" * 40},
    None,
]


@pytest.fixture(params=["37", "1m"])
def blocks(spark, request):
    """Files are read in blocks of so many bytes."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("indent", [None, 2])
def test_documents_are_read_in_pieces(spark, tmp_path, blocks, indent):
    """No row holds a document, and wherever it is cut its elements come back."""
    (tmp_path / "d").mkdir()
    for n in range(3):
        text = json.dumps(TRICKY[n:], indent=indent, ensure_ascii=n == 1) + "\n " * n
        (tmp_path / "d" / f"{n}.json").write_text(text, encoding="utf-8")
    got = readers.read_posts(spark, str(tmp_path / "d")).collect()
    expected = [
        (p.get("id", ""), p.get("text", p.get("selftext", "")), p.get("title", ""), p.get("url", ""))
        for n in range(3) for p in TRICKY[n:] if isinstance(p, dict)
    ]
    assert sorted((r.id, r.text, r.title, r.url) for r in got) == sorted(expected)
    longest = readers._pieces(spark, str(tmp_path / "d")).agg(F.max(F.length("value"))).first()[0]
    assert longest < 200


def test_sound_documents(spark, tmp_path, blocks):
    texts = ["[]", " [ ] ", "[1]", "[1,\n{}\n]\n", '[{},{}, "]"]', '["\\\\"]', '["}"]']
    for n, text in enumerate(texts):
        (tmp_path / f"{n}.json").write_text(text, encoding="utf-8")
    got = readers._elements(spark, str(tmp_path), False).collect()
    expected = [x if isinstance(x, str) else json.dumps(x) for text in texts for x in json.loads(text)]
    assert sorted(r.value for r in got) == sorted(expected)


@pytest.mark.parametrize("text", ["[", "[{},]", "[,{}]", "[{}{}]", "[{}][{}]", "[1]}", "[{}] x", '[{"a}]', "[1,]"])
def test_broken_documents_fail(spark, tmp_path, text):
    (tmp_path / "p.json").write_text(text, encoding="utf-8")
    with pytest.raises(PySparkException, match="(malformed JSON|expected a JSON array) in .*p.json"):
        readers._elements(spark, str(tmp_path / "p.json"), False).collect()


def test_lenient_reader_wants_an_array(spark, tmp_path):
    with pytest.raises(PySparkException, match="expected a JSON array"):
        readers.read_posts(spark, write(tmp_path / "p.json", {"id": 1})).collect()


@pytest.mark.parametrize("change", [{"extra": 1}, {"text": ...}])
def test_strict_reader_rejects_other_fields(spark, tmp_path, change):
    row = {k: v for k, v in {**POST_ROW, **change}.items() if v is not ...}
    with pytest.raises(PySparkException, match="fields"):
        readers.read_posts_strict(spark, write(tmp_path / "p.json", [row])).collect()


def test_strict_reader_rejects_a_single_incomplete_post(spark, tmp_path):
    rows = [POST_ROW, {**POST_ROW, "author": None}]
    with pytest.raises(PySparkException, match="required field"):
        readers.read_posts_strict(spark, write(tmp_path / "p.json", rows)).collect()


def test_strict_reader_reads_what_conforms(spark, tmp_path):
    rows = [POST_ROW, {**POST_ROW, "language": "fr", "id": "2"}]
    got = readers.read_posts_strict(spark, write(tmp_path / "p.json", rows))
    assert [r.asDict() for r in got.collect()] == [{"language": None, **r} for r in rows]
    assert got.columns == POST.names


@pytest.mark.parametrize("lines", [False, True])
def test_malformed_posts_fail_with_their_file(spark, tmp_path, lines):
    whole = "\n".join([json.dumps(POST_ROW)] * 2) if lines else json.dumps([POST_ROW] * 2)
    (tmp_path / "p.json").write_text(whole[:-9], encoding="utf-8")
    for read in (readers.read_posts, readers.read_posts_strict):
        with pytest.raises(PySparkException, match="malformed JSON in .*p.json"):
            read(spark, str(tmp_path / "p.json"), lines).collect()


def test_malformed_histories_fail(spark, tmp_path):
    whole = json.dumps({"a": [ITEM_ROW] * 3})
    (tmp_path / "h.json").write_text(whole[:-20], encoding="utf-8")
    with pytest.raises(PySparkException, match="expected a JSON object in .*h.json"):
        readers.read_history(spark, str(tmp_path / "h.json"))[1].collect()
    (tmp_path / "l.json").write_text(json.dumps({"username": "a", "items": [ITEM_ROW]})[:-9], encoding="utf-8")
    with pytest.raises(Exception, match="FAILFAST|[Mm]alformed"):
        readers.read_history_lines(spark, str(tmp_path / "l.json"))[1].collect()


def test_history_document(spark, tmp_path):
    lacking = {k: v for k, v in ITEM_ROW.items() if k != "kind"}
    data = {"a": [ITEM_ROW, lacking, {**ITEM_ROW, "id": "2"}], "b": [], "c": [lacking]}
    found, items = readers.read_history(spark, write(tmp_path / "h.json", data))
    assert sorted(r.username for r in found.collect()) == ["a", "b", "c"]
    assert sorted((r.username, r.id) for r in items.collect()) == [("a", "1"), ("a", "2")]


def test_absent_files_are_empty(spark, tmp_path):
    nowhere = str(tmp_path / "nowhere")
    for read in (readers.read_history, readers.read_history_lines, readers.read_history_tables):
        found, items = read(spark, nowhere)
        assert found.count() == 0 and items.columns == HISTORY.names
    assert readers.read_fallback_scores(spark, nowhere).count() == 0


@pytest.mark.parametrize("per_line", [2, 1000])
def test_nested_history_splits_large_users(spark, per_line):
    rows = [("u", f"{i:02}", "", "", "u", "comment", "x", float(i % 5)) for i in range(11)]
    items = spark.createDataFrame(rows, HISTORY)
    people = spark.createDataFrame([("u",), ("idle",)], "username string")
    writers_rows = writers.nest_history(people, items, per_line)
    got = writers_rows.collect()
    assert [r["items"] for r in got if r.username == "idle"] == [[]]
    parts = [r["items"] for r in got if r.username == "u"]
    parts = [r["items"] for r in sorted(got, key=lambda r: r.part) if r.username == "u"]
    assert [len(p) for p in parts] == ([2] * 5 + [1] if per_line == 2 else [11])
    newest = sorted(rows, key=lambda r: (-r[7], r[1]))
    assert [i.id for p in parts for i in p] == [r[1] for r in newest]
    assert list(parts[0][0].asDict()) == ITEM.names


def scored(spark, *texts):
    rows = [(str(i), "u", "s", "a", "", t, 1.0, None) for i, t in enumerate(texts)]
    return posts.scored_records(spark.createDataFrame(rows, POST))


def test_scored_post_csv_is_read_by_other_readers(spark, tmp_path):
    texts = ['say "kill",\nthen \\ go', "plain", 'ends with \\"', "ünï"]
    assert writers.write_scored_posts_csv(scored(spark, *texts).coalesce(1), str(tmp_path / "o"))
    (part,) = glob.glob(f"{tmp_path}/o/part-*.csv")
    with open(part, encoding="utf-8", newline="") as f:
        rows = list(csv.DictReader(f))
    assert [r["text"] for r in rows] == texts
    assert list(rows[0]) == [
        "id", "url", "subreddit", "author", "title", "text", "created_utc", "language", "risk_score",
        "risk_label", "risk_explanation", "risk_features",
    ]
    assert list(json.loads(rows[0]["risk_features"])) == [
        "violent", "hate", "keyword_density", "intensifiers", "threat", "all_caps",
    ]


def test_no_csv_without_rows(spark, tmp_path):
    assert not writers.write_scored_posts_csv(scored(spark).limit(0), str(tmp_path / "o"))
    assert not (tmp_path / "o").exists()


def test_json_keeps_characters_and_nulls(spark, tmp_path):
    df = spark.createDataFrame([("1", "u", "s", "a", "t", "é – 日本  ", 1.0, None)], POST)
    writers.write_posts(df.coalesce(1), str(tmp_path / "o"))
    (part,) = glob.glob(f"{tmp_path}/o/part-*.json")
    line = open(part, encoding="utf-8").read()
    assert "é – 日本" in line and json.loads(line)["language"] is None


def test_scored_users_csv_has_four_decimals(spark, tmp_path):
    people = spark.createDataFrame([("carol",)], "username string")
    posted = spark.createDataFrame([("carol", 0.9)], "author string, score double")
    none = spark.createDataFrame([], "username string, score double")
    risk = users.score_users_from_scores(people, none, posted)
    writers.write_scored_users_csv(risk.coalesce(1), str(tmp_path / "o"))
    (part,) = glob.glob(f"{tmp_path}/o/part-*.csv")
    (row,) = csv.DictReader(open(part, encoding="utf-8"))
    assert (row["score"], row["average_score"], row["total_posts"]) == ("1.0386", "0.9000", "1")
    assert list(row) == [
        "username", "score", "label", "max_post_score", "average_score", "count_high_posts",
        "total_posts", "explanation",
    ]


def test_conform(spark):
    df = spark.range(1).select(
        F.col("id"), *(F.lit("x").alias(n) for n in POST.names if n not in ("id", "language", "created_utc")),
        F.lit(3).alias("created_utc"), F.lit(1).alias("other"),
    )
    got = readers.conform(df, POST)
    assert got.schema.simpleString() == POST.simpleString() and got.first().created_utc == 3.0
    with pytest.raises(ValueError, match="author"):
        readers.conform(df.drop("author"), POST)


def test_shared_folder_falls_back_to_the_contexts_own(spark):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master, folder = "local[2]", None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        conf, sparkContext = Conf(), Context()

    first = staging.shared_folder(Session())
    assert first and staging.shared_folder(Session()) == first
    Session.sparkContext.folder, Session.sparkContext.master = None, "spark://there"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_folder(Session())


def test_discarded_tables_are_gone(spark):
    table = staging.staged(spark.range(3), "kept")
    assert staging.path_exists(spark, table.staged_path)
    staging.discard(table)
    assert not staging.path_exists(spark, table.staged_path)


def test_shared_folder_is_the_session_setting(spark):
    assert staging.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert staging.fresh_path(spark, "x") != staging.fresh_path(spark, "x")
