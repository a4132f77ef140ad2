"""The operators on small tables: hard rows, planted cases and brute force."""

from __future__ import annotations

import hashlib
import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm import (
    fingerprints,
    labelled,
    line_dedup,
    minhash_dedup,
    mixing,
    quality_gam,
    sentencepiece_tokens,
    substring_dedup,
    top_products,
    toxicity,
    url_filter,
)
from riskloom.llm.graph import components
from riskloom.llm.tables import running
from riskloom.llm.words import WordHasher, word_count

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Clashing names of extra columns.
CLASHING = (
    "_id _gone _kept _rate _part _cell _host _rule _p _x _tokens _score _size _row _source _text "
    "_copies _target _key _class _cut _base _url _said _raw _f0 _folder _blocked _verdict _path"
).split()
EXTRA = ", id long, n long, gone string, size string, key string"
EXTRA += "".join(f", {name} string" for name in CLASHING)
RNG = random.Random(5)
LEXICON = ["w%d" % i for i in range(3000)]


def prose(n: int) -> str:
    return " ".join(RNG.choice(LEXICON) for _ in range(n))


def hard_rows() -> list[tuple]:
    long = prose(30_000)
    shared = prose(60)
    texts = [None, "", "   \n\t", "one", "two words", long, long, shared, shared, prose(40) + " " + shared]
    rows = [(i, t, "en" if i % 3 else None, None if i % 4 == 0 else f"s{i % 3}", None) for i, t in enumerate(texts)]
    rows += [rows[7], (None, shared, None, None, 3), (None, None, None, None, None)]
    return [(*r, 1, 2, "x", "y", "z", *CLASHING) for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(hard_rows(), DOCS + EXTRA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS + EXTRA)


# Near duplicates


def linked(texts: dict[int, str]) -> dict[int, int]:
    sets = {}
    for i, t in texts.items():
        w = t.lower().split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    comp = {i: i for i in texts}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    comp[y] = x
    return {i: find(i) for i in texts}


def test_near_duplicates_of_hard_rows(spark, docs, empty):
    got = minhash_dedup.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert all((r.component_id, r.kept) == (None, True) for r in by[None])
    assert [by[i][0].n_shingles for i in range(5)] == [0, 0, 0, 1, 1]
    assert [by[i][0].component_id for i in range(10)] == [0, 1, 2, 3, 4, 5, 5, 7, 7, 9]
    assert len(by[7]) == 2 and all(r.kept for r in by[7])
    kept = minhash_dedup.keep_one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2
    assert minhash_dedup.near_duplicates(empty).count() == 0


def test_crowds_of_edited_copies_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "CROWD", 4)
    monkeypatch.setattr(minhash_dedup, "BLOCK", 16)
    base = prose(120).split()
    texts = {}
    for i in range(90):
        words = list(base)
        for _ in range(RNG.choice([0, 1, 2, 4, 6, 9])):
            words[RNG.randrange(120)] = RNG.choice(LEXICON)
        texts[i] = " ".join(words).upper() if i % 9 == 0 else " ".join(words)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(frame).collect()}
    assert got == linked(texts)


def test_pruning_keeps_pairs_at_the_threshold():
    fewest = minhash_dedup.least_matches(200, 40, 0.75, 1e-6)
    for n, m in zip(range(40, 201, 40), fewest):
        chance = sum(math.comb(n, k) * 0.75**k * 0.25 ** (n - k) for k in range(m))
        assert chance < 2e-6 and m / n > 0.25


def test_components_of_a_long_path(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


# Repeated passages and line chunks


def covered(texts: dict[int, str], width: int = 13) -> dict[int, list[str]]:
    first, out = {}, {}
    for i in sorted(texts):
        w = texts[i].split()
        for j in range(len(w) - width + 1):
            first.setdefault(tuple(w[j : j + width]), i)
    for i, t in texts.items():
        w = t.split()
        gone = set()
        for j in range(len(w) - width + 1):
            if first[tuple(w[j : j + width])] < i:
                gone |= set(range(j, j + width))
        out[i] = [x for k, x in enumerate(w) if k not in gone]
    return out


def test_passages_by_brute_force(spark):
    passages = [prose(RNG.randint(12, 80)) for _ in range(6)] + ["again " * 40]
    texts = {}
    for i in range(70):
        parts = [prose(RNG.randint(0, 30)), RNG.choice(passages), prose(RNG.randint(0, 9)), RNG.choice(passages)]
        texts[i] = "  \n".join(parts)
    texts[70], texts[71] = texts[3], " ".join(texts[4].split()[5:25])
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    left = substring_dedup.without_repeats(frame, substring_dedup.repeated_spans(frame))
    got = {r.doc_id: (r.kept, r.n_words, r.n_removed) for r in left.collect()}
    want = covered(texts)
    for i, words in want.items():
        n = len(texts[i].split())
        assert got[i] == (" ".join(words), n, n - len(words)), i


def test_a_source_is_asked_once_for_a_span_that_many_repeat(spark, monkeypatch):
    asked = []

    def recorded(df, name):
        table = settled(df, name)
        if name == "asked":
            asked.append(table.agg(F.max(F.size("asked"))).first()[0])
        return table

    settled = substring_dedup.settled
    monkeypatch.setattr(substring_dedup, "settled", recorded)
    common, other = prose(40), prose(40)
    texts = {i: f"{prose(5)} {common} {prose(i % 4)}" for i in range(60)}
    # A source of more spans than a list holds.
    texts |= {100 + i: f"{prose(5)} {' '.join(other.split()[i:])}" for i in range(20)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)

    def found():
        left = substring_dedup.without_repeats(frame, substring_dedup.repeated_spans(frame))
        return {r.doc_id: r.kept for r in left.collect()}

    want = {i: " ".join(words) for i, words in covered(texts).items()}
    assert found() == want and max(n for n in asked if n) < 40
    asked.clear()
    monkeypatch.setattr(substring_dedup, "LISTED", 3)
    assert found() == want and max(n for n in asked if n) <= 3


def test_passages_of_hard_rows(spark, docs, empty):
    left = substring_dedup.without_repeats(docs, substring_dedup.repeated_spans(docs))
    got = {(r.doc_id, r.n_words): r.n_removed for r in left.collect()}
    assert got[6, 30_000] == 30_000 and got[5, 30_000] == 0
    assert got[7, 60] == 0 and got[8, 60] == 60 and got[9, 100] == 60 and got[None, 60] == 0
    assert left.count() == docs.count()
    spans = substring_dedup.repeated_spans(empty)
    assert substring_dedup.without_repeats(empty, spans).count() == 0


def test_line_chunks(spark, docs, empty):
    lines = [f"line {i} {RNG.random()}" for i in range(40)]
    texts = ["\n".join(lines), "new first line\n" + "\n".join(lines), "\n".join(lines[10:]) + "\nend"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r._kept for r in line_dedup.without_repeated_chunks(frame).collect()}
    assert (got[0].removed, got[0].text) == (0, texts[0])
    # Boundaries move along: all but the lines at the edges of the shift go.
    assert got[1].removed >= 30 and got[1].lines == 41 and got[1].text.startswith("new first line")
    assert got[2].removed >= 20 and got[2].text.endswith("end")
    for t in texts:
        assert b"\n".join(line_dedup.chunks(t)).decode() == t
    cut = line_dedup.without_repeated_chunks(docs)
    assert cut.columns == [*(c for c in docs.columns if c != "_kept"), "_kept"] and cut.count() == docs.count()
    assert cut.where("text is null and _kept.text is not null").isEmpty()
    assert line_dedup.without_repeated_chunks(empty).count() == 0


def test_chunks_leave_no_single_lines(spark):
    lines = [f"line {RNG.random()}" for _ in range(200)]
    for size in (2, 3, 5, 17, 200):
        parts = line_dedup.chunks("\n".join(lines[:size]))
        assert all(2 <= c.count(b"\n") + 1 <= line_dedup.MOST_LINES + 1 for c in parts)
    same = line_dedup.chunks("\n".join(["x"] * 100))
    assert sum(c.count(b"\n") + 1 for c in same) == 100 and len(same) > 4
    assert line_dedup.chunks("one") == [b"one"] and line_dedup.chunks("") == [b""]
    own = ["\n".join(f"own {RNG.random()}" for _ in range(30)) for _ in range(8)]
    block = {n: "\n".join(lines[100 : 100 + n]) for n in (5, 20)}
    texts = ["\n".join(lines), "\n".join(lines), f"{own[0]}\n{block[20]}\n{own[1]}"]
    texts += [f"{own[2]}\n{block[20]}\n{own[3]}", "\n".join(lines[:2]), "\n".join(lines[:2])]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r._kept for r in line_dedup.without_repeated_chunks(frame).collect()}
    # Nothing of a byte-identical copy stays, and a block's edges at most.
    assert got[1].removed == 200 and got[1].text == "" and got[5].removed == 2
    assert got[2].removed >= 14 and got[3].removed >= got[2].removed
    assert set(own[2].split("\n")) <= set(got[3].text.split("\n"))


def test_a_hash_of_different_bytes_removes_nothing(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "chunk_hash", lambda chunk: b"0" * 16)
    texts = [(0, "a\nb\nc\nd\ne\nf"), (1, "g\nh\ni\nj\nk\nl")]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    got = line_dedup.without_repeated_chunks(frame).select("_kept.removed").collect()
    assert [r.removed for r in got] == [0, 0]


# Largest products


def test_products_by_brute_force(spark):
    rng = np.random.default_rng(3)
    lengths = np.exp(rng.normal(0, 1.5, 700))
    x = rng.normal(size=(700, 12)) * lengths[:, None]
    x[5] = x[6] = x[7] = 0
    x[20] = x[21]
    vectors = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    vectors += [(900, None), (901, [1.0, None]), (902, [float("nan")] * 12), (903, [float("inf")] * 12), (None, [1.0] * 12), (904, [0.5, 2.0]), (906, [1.0, -1.0]), (908, [])]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    items = frame.select("vec_id", top_products.scaled("embedding", 256.0).alias("vec"))
    queries = items.where("vec_id % 10 = 0 or vec_id > 900").withColumnRenamed("vec_id", "query_id")
    got = {}
    for r in top_products.top_products(queries, items, 5, block_rows=64, query_rows=16).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    exact = {i: [math.floor(256 * float(np.float32(v))) for v in row] for i, row in enumerate(x)}
    for q in range(0, 700, 10):
        scores = sorted((-sum(a * b for a, b in zip(exact[q], e)), i) for i, e in exact.items() if i != q)
        want = [(k + 1, i, -s) for k, (s, i) in enumerate(scores[:5])]
        assert sorted(got[q]) == want
    assert got[904] == [(1, 906, 128 * 256 - 512 * 256)] and 902 not in got and 908 not in got
    none = items.where("false")
    assert top_products.top_products(none.withColumnRenamed("vec_id", "query_id"), none).count() == 0


def test_few_long_vectors_neither_gather_queries_nor_stop_pruning(spark, monkeypatch):
    rounds = []

    def recorded(visits, *rest):
        rounds.append(visits)
        return visited(visits, *rest)

    visited = top_products._visited
    monkeypatch.setattr(top_products, "_visited", recorded)
    rng = np.random.default_rng(4)
    x = rng.integers(-100, 100, (300, 8))
    x[:3] *= np.array([[50], [700], [9000]])
    frame = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "vec_id long, vec array<int>")
    asked = frame.withColumnRenamed("vec_id", "query_id")
    got = {}
    for r in top_products.top_products(asked, frame, 5, block_rows=64, query_rows=16).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in range(300):
        scores = sorted((-int(x[q] @ x[i]), i) for i in range(300) if i != q)[:5]
        assert sorted(got[q]) == [(n + 1, i, -v) for n, (v, i) in enumerate(scores)]
    first, second = rounds
    groups = first.groupBy("dim", "bucket", "block", "batch").count()
    assert groups.agg(F.max("count")).first()[0] < 64
    assert second.where("bound = double('-inf')").isEmpty()


def test_products_of_large_components(spark):
    rows = [(i, [float(i), 1.0, -2.0]) for i in range(20)]
    rows += [(50, [3e5, 1.0, 0.0]), (52, [4e8, 4e8, 1.0]), (53, [4e8, -4e8, 1.0]), (54, [float("inf"), 1.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    items = frame.select("vec_id", top_products.scaled("embedding", 256.0).alias("vec"))
    asked = items.where("vec_id in (3, 50, 53)").withColumnRenamed("vec_id", "query_id")
    exact = {i: [math.floor(256 * v) for v in row] for i, row in rows if i != 54}
    got = {}
    for r in top_products.top_products(asked, items, 5, block_rows=8, query_rows=2).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in (3, 50, 53):
        scores = sorted((-sum(a * b for a, b in zip(exact[q], e)), i) for i, e in exact.items() if i != q)[:5]
        assert sorted(got[q]) == [(n + 1, i, -v) for n, (v, i) in enumerate(scores)]


def test_products_beyond_64_bits_are_exact():
    x, q = np.array([[1 << 62, 1 << 62], [1 << 62, -(1 << 62)], [3, 4]]), np.array([1 << 62, 1 << 62])
    largest = np.sqrt((x.astype(float) ** 2).sum(1)) * 2.0**62.5
    assert top_products._products(x, q, largest).tolist() == [1 << 125, 0, 7 << 62]


# Mixing


def reshared(sizes: list[int], weights: list[int], cap: int = 3) -> list[float]:
    target, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while free and left > 1e-9:
        total = sum(weights[i] for i in free)
        given = {i: left * weights[i] / total for i in free}
        over = {i for i in free if given[i] > cap * sizes[i]}
        if not over:
            for i in free:
                target[i] = given[i]
            break
        for i in over:
            target[i] = cap * sizes[i]
            left -= target[i]
        free -= over
    return target


def test_targets_reshare_what_the_cap_leaves(spark):
    sizes = {None: 10, "a": 1000, "b": 5, "c": 300, "ä": 20, "z": 0}
    frame = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    order = ["a", "b", "c", "z", "ä", None]
    want = reshared([sizes[s] for s in order], [1, 2, 3, 1, 2, 3])
    assert [got[s] for s in order] == pytest.approx(want)


def test_mix_of_hard_rows(spark, docs, empty):
    sized = docs.withColumn("words", word_count("text"))
    mixed = mixing.with_copies(sized, size_col="words")
    out = ["_source_size", "_target", "_copies"]
    assert mixed.columns == [*(c for c in sized.columns if c not in out), *out]
    assert mixed.where("_rate != '_rate' or _part != '_part' or _cell != '_cell'").isEmpty()
    rows = mixed.collect()
    assert len(rows) == docs.count()
    assert all(0 <= r._copies <= 3 and (r.words > 0 or r._copies == 0) for r in rows)
    nothing = empty.withColumn("words", word_count("text"))
    assert mixing.with_copies(nothing, size_col="words").count() == 0


def test_rates_are_tilted_and_meet_the_target(spark):
    sizes = [int(s) for s in np.random.default_rng(1).lognormal(5, 1, 2000)]
    rows = [(i, "few" if i % 10 == 0 else "many", s) for i, s in enumerate(sizes)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = mixing.with_copies(sized).groupBy("source").agg(
        F.sum(F.col("_copies") * F.col("size")).alias("taken"), F.first("_target").alias("target")
    )
    for r in got.collect():
        assert abs(r.taken / r.target - 1) < 0.002


def test_copies_are_the_rounded_rates_of_the_optimum(spark):
    sizes = [int(s) + 1 for s in np.random.default_rng(2).lognormal(4, 1.5, 1500)]
    rows = [(i, "abc"[i % 3] if i % 7 else None, s) for i, s in enumerate(sizes)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long")
    found = mixing.with_copies(sized, weights=(1, 5, 2)).collect()
    for source in ("a", "b", "c", None):
        own = [r for r in found if r.source == source]
        size = np.array([r.size for r in own], float)
        target, low, high = own[0]._target, -200.0, 200.0

        def rate(t):
            return np.minimum(3.0, np.exp(np.clip(t * size / size.mean(), -700, 2)))

        for _ in range(200):
            middle = (low + high) / 2
            low, high = (middle, high) if rate(middle) @ size < target else (low, middle)
        for r, want in zip(own, rate(low)):
            assert math.floor(want - 1e-6) <= r._copies <= math.ceil(want + 1e-6)
        assert abs(sum(r._copies * r.size for r in own) - target) <= max(r.size for r in own)


def test_extreme_sizes_end_without_error(spark):
    rows = [(i, "s", 10**9 if i % 50 == 0 else 1) for i in range(500)] + [(1000, "t", 10**9), (1001, "u", 1)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long")
    found = mixing.with_copies(sized).collect()
    assert len(found) == 502 and all(0 <= r._copies <= 3 for r in found)


def test_running_sums_over_ranges(spark):
    rows = [(RNG.randint(0, 50), i, RNG.randint(1, 9)) for i in range(300)]
    frame = spark.createDataFrame(rows, "a int, b int, v long").repartition(7)
    got = {(r.a, r.b): r.before_v for r in running(frame, [F.desc("a"), F.asc("b")], "v").collect()}
    total = 0
    for a, b, v in sorted(rows, key=lambda r: (-r[0], r[1])):
        assert got[a, b] == total
        total += v


# Fingerprints


def test_next_texts_of_rows_without_ids(spark):
    texts = ["first text of all", "second one", "third"]
    frame = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    rows = fingerprints.against_edited(frame).collect()
    want = set()
    for own, after in zip(texts, [*texts[1:], texts[0]]):
        half = len(own) // 2
        edited = own[: len(own) - half] + after[:half]
        want.add((len(own), hashlib.sha256(edited.encode()).hexdigest()))
    assert {(r.n_chars, r.edited_sha256) for r in rows} == want


def test_fingerprints_follow_the_text():
    make = fingerprints.Fingerprinter()
    text = prose(2000)
    assert make(text) == make(text) and fingerprints.likeness(make(text), make(text)) == 1
    shifted = fingerprints.likeness(make(text), make("some words put first " + text))
    assert shifted > 0.9 > 0.2 > fingerprints.likeness(make(text), make(prose(2000)))
    assert make(None) == make("") == "2::" and fingerprints.likeness("2::", "2::") == 1
    assert fingerprints.likeness("2:aabb:aa", "5:aabb:aa") == 0
    one = [text[:700], text[100:800], text[:1400]]
    assert fingerprints.likeness(make(one[0]), make(one[2])) > 0.5


def test_edit_distance_by_brute_force():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(last[j - 1] if x == y else 1 + min(row[-1], last[j]))
        return row[-1]

    for _ in range(50):
        a, b = ([RNG.choice(["aa", "ab", "bb", "ba"]) for _ in range(RNG.randint(1, 80))] for _ in range(2))
        want = 1 - distance(a, b) / (len(a) + len(b))
        assert fingerprints._alike("".join(a), "".join(b)) == pytest.approx(want)


def test_fingerprints_of_hard_rows(docs, empty):
    rows = fingerprints.against_edited(docs).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert {r.fingerprint for r in rows if r.doc_id in (0, 1)} == {"2::"}
    assert fingerprints.against_edited(empty).count() == 0


# Classifiers


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_learns_a_pair(spark, docs, empty):
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x[:3000], y[:3000])
    assert (0, 1) in model.pairs
    assert (((model.score(x[3000:]) > 0.5) == y[3000:]).mean()) > 0.95
    none = quality_gam.train(docs, labels_of(spark, []), F.lit(True))
    assert {r.s for r in docs.select(none.column("text").alias("s")).collect()} == {0.5}
    one = quality_gam.train(docs, labels_of(spark, [(3, 1, 0), (3, 1, 0), (7, None, None)]), F.lit(True))
    scores = [r.s for r in docs.select(one.column("text").alias("s")).collect()]
    assert len(scores) == docs.count() and all(0 < s < 1 for s in scores)
    assert empty.select(one.column("text")).count() == 0


def test_quality_scores_mean_the_natural_share_at_every_size(spark):
    rng = np.random.default_rng(4)
    shares = []
    for ones, zeros in ((45, 255), (4500, 25_500)):
        y = np.concatenate([np.ones(ones), np.zeros(zeros)])
        x = rng.normal(y[:, None] * 1.2, 1.0, (len(y), 3))
        if len(y) > 20_000:
            # As train() draws it: half of the bound for either label, weighed back.
            taken = np.concatenate([np.flatnonzero(y == 1), np.flatnonzero(y == 0)[:10_000]])
            model = quality_gam.fit(x[taken], y[taken], ones / len(y))
        else:
            model = quality_gam.fit(x, y, ones / len(y))
        test = rng.normal((rng.random(20_000) < 0.15)[:, None] * 1.2, 1.0, (20_000, 3))
        scores = model.score(test)
        assert abs(scores.mean() - 0.15) < 0.05
        shares.append((scores >= quality_gam.THRESHOLD).mean())
    assert abs(shares[0] - shares[1]) < 0.05


def test_natural_share_counts_ids_once(spark):
    labels = labels_of(spark, [(1, 1, 0), (1, 1, 0), (2, 0, 0), (3, 0, 0), (4, 1, 0), (5, None, 0)])
    assert labelled.share(labels, "quality", F.col("doc_id") < 4) == pytest.approx(2 / 5)
    assert labelled.share(labels.limit(0), "quality", F.lit(True)) == 0.5


def test_toxicity_finds_planted_words(spark, docs, empty):
    rows, labels = [], []
    for i in range(400):
        bad = i % 2
        words = prose(40).split()
        if bad:
            words.insert(RNG.randrange(40), RNG.choice(["zorkhead", "blargface", "qwibble"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, bad))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(frame, labels_of(spark, labels), labelled.fold("doc_id", 4) != 2)
    scored = frame.select("doc_id", model.column("text").alias("s")).collect()
    right = sum((r.s >= 0.3) == bool(r.doc_id % 2) for r in scored)
    assert right / len(rows) > 0.95
    hard = docs.select(model.column("text").alias("s")).collect()
    assert len(hard) == docs.count() and all(0 <= r.s <= 1 for r in hard)
    assert empty.select(model.column("text")).count() == 0
    none = toxicity.train(frame, labels_of(spark, []), F.lit(True))
    assert {r.s for r in docs.select(none.column("text").alias("s")).collect()} == {0.0}


# Urls


def test_urls_of_hard_rows(spark):
    urls = [None, "", "no scheme", "HTTP://A.Example.COM/en/x?y#z", "x://net/es/", "x://planet/es/", "http://a.net", "http://www.example.com/en/?a=1", "x://com?q=http://b.net/es/"]
    urls += ["http://h%d.example.org/de/%d" % (i, i) for i in range(30)] + ["x://" + "a" * 100_000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = {r.page_id: r for r in url_filter.judged(pages).collect()}
    assert len(rows) == len(urls)
    assert all((rows[i]._host, rows[i]._path) == ("", "") for i in (0, 1, 2))
    assert (rows[3]._host, rows[3]._path, rows[3]._rule.rule) == ("a.example.com", "/en/x", "example.com/en/")
    assert [rows[i]._rule and rows[i]._rule.rule for i in (4, 5, 6, 7, 8)] == ["net/es/", None, None, "www.example.com/en/", None]
    assert {r._verdict for r in rows.values()} <= {"allow", "block"}
    assert url_filter.judged(pages.where("false")).count() == 0


def test_statistics_cover_rare_folders_and_leave_the_row_out(spark):
    urls = [f"http://a{i % 2}.org/f{i // 3}.html" for i in range(3_000)] + ["http://b.com/f1.html"]
    rules = (("allow", "a0.org", "/"), ("block", "a1.org", "/"))
    rows = spark.createDataFrame([(u,) for u in urls], "_url string").select("*", *(c.alias(n) for c, n in zip(url_filter.parts("_url"), ("_host", "_path"))))
    rows = rows.withColumn("_rule", url_filter.rule_of(rules)).withColumn("_folder", F.split_part("_path", F.lit("/"), F.lit(2)))
    stats = url_filter._statistic(rows.where("_rule is not null"), "_folder")
    found = rows.join(stats, "_folder", "left").select("_url", url_filter._others_blocked("_folder", 0.5).alias("s"))
    labels = [(u.split("/", 3)[3], "a1.org" in u) for u in urls[:-1]]
    want = []
    for at, url in enumerate(urls):
        others = [bad for i, (folder, bad) in enumerate(labels) if i != at and i // 3 == (at // 3 if at < 3000 else 1)]
        want.append((url, round((sum(others) + 2.0) / (len(others) + 4.0), 9)))
    assert sorted((r._url, round(r.s, 9)) for r in found.collect()) == sorted(want)


def test_entropy_by_brute_force(spark):
    hosts = ["", "a", "aabbbc", "xyz.example.com", "ab" * 50, "z" * 100_000]
    frame = spark.createDataFrame([(h, "", h) for h in hosts], "_host string, _path string, _url string")
    got = {r._host: r.e for r in frame.select("_host", url_filter.lexical()["entropy"].alias("e")).collect()}
    for host in hosts:
        shares = [host.count(c) / len(host) for c in set(host)]
        assert got[host] == pytest.approx(-sum(p * math.log2(p) for p in shares), abs=1e-9)


def test_url_filter_passes_columns_of_any_name(spark):
    schema = "page_id long, url string" + "".join(f", {c} string" for c in CLASHING)
    urls = ["http://a.com/x", "http://b.net/es/1", "http://c.org/y", "http://d.com/es/z", None]
    pages = spark.createDataFrame([(i, u, *CLASHING) for i, u in enumerate(urls)], schema)
    found = url_filter.judged(pages)
    out = ["_host", "_path", "_rule", "_verdict", "_blocked"]
    assert found.columns == [*(c for c in pages.columns if c not in out), *out]
    assert found.where("_p = '_p' and _x = '_x' and _url = '_url'").count() == len(urls)


# SentencePiece


def wire(number: int, value) -> bytes:
    def varint(n):
        out = b""
        while n > 127:
            out += bytes([n & 127 | 128])
            n >>= 7
        return out + bytes([n])

    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, bytes):
        return varint(number << 3 | 2) + varint(len(value)) + value
    return varint(number << 3) + varint(value)


def unigram_model(fallback: bool, trim: int) -> bytes:
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    if fallback:
        pieces += [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)]
    words = ["▁", "a", "b", "c", "d", "▁a", "ab", "abc", "▁the", "cd", "bcd", "▁▁", "é"]
    pieces += [(w, -1.5 - 0.37 * i, 1) for i, w in enumerate(words)]
    data = b"".join(wire(1, wire(1, p.encode()) + wire(2, s) + wire(3, k)) for p, s, k in pieces)
    data += wire(2, wire(3, 1) + wire(35, int(fallback)))
    return data + wire(3, wire(1, b"identity") + wire(3, 1) + wire(4, trim))


@pytest.mark.parametrize("fallback, trim", [(True, 0), (False, 0), (True, 1)])
def test_unigram_models_agree_with_the_library(fallback, trim):
    from sentencepiece import SentencePieceProcessor

    data = unigram_model(fallback, trim)
    reference = SentencePieceProcessor(model_proto=data)
    model = sentencepiece_tokens.parse_model(data)
    ours = Tokenizer.from_str(sentencepiece_tokens.build(model).to_str())
    texts = ["", "abc", "the abcd ab", "a  b   c", "dé cab", " abc ", "bcdbcd the", "aéb"]
    if fallback:
        texts += ["x日y", "abc 😀 the"]
    want = [reference.encode(t) for t in texts]
    assert [i.tolist() for i in sentencepiece_tokens.encode(ours, texts)] == want
    assert model.by_words == (not trim)
    if model.by_words:
        by_words = sentencepiece_tokens.WordEncoder(ours)
        for _ in range(2):
            ids, back = by_words(texts)
            assert [i.tolist() for i in ids] == want
            # Spelled out of words, as the library decodes whole texts.
            assert not fallback or back == [reference.decode(i) for i in want]
            assert by_words(texts, False)[1] == [None] * len(texts)
        assert by_words([]) == ([], []) and by_words(["", "abc"])[0][0].tolist() == []
    if fallback:
        decoder = sentencepiece_tokens.Decoder(ours)
        assert decoder([np.array(i) for i in want]) == [reference.decode(i) for i in want]


def test_words_that_decode_to_something_else():
    model = sentencepiece_tokens.parse_model(unigram_model(False, 0))
    ours = Tokenizer.from_str(sentencepiece_tokens.build(model).to_str())
    texts = ["abc xyz the", "the abc", "xyz", "q", "ab  xyz", "the xyz abc xyz ab"]
    ids, back = sentencepiece_tokens._whole(ours, sentencepiece_tokens.Decoder(ours), texts, True)
    assert back != texts
    by_words = sentencepiece_tokens.WordEncoder(ours)
    for _ in range(2):
        own, spelled = by_words(texts)
        assert [i.tolist() for i in own] == [i.tolist() for i in ids]
        assert spelled == back


def test_tokens_of_hard_rows(docs, empty):
    rows = sentencepiece_tokens.with_tokens(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r._tokens.ids is None) == (r.text is None)
        if r.text is not None:
            assert r._tokens.parity and r._tokens.decoded == r.text
    assert sentencepiece_tokens.with_tokens(empty).count() == 0


def test_word_hashes_cut_as_split_does():
    hasher = WordHasher()
    data = "a  b\x0bc\u00a0d\u2003e \x1ff\r\ng é".encode()
    starts, ends, hashes = hasher.words(data)
    words = [data[a:b] for a, b in zip(starts, ends)]
    assert words == data.split()
    again = hasher.words(b"  " + data)[2]
    assert (again == hashes).all() and len(set(hashes)) == len(set(words))


# The pipeline's stages


def test_stages_on_hard_rows(spark, docs, empty, tmp_path):
    import corpus_pipeline

    rows = [(i, int(i % 3 > 0), 0) for i in range(12)] + [(None, 1, 0)]
    labels_of(spark, rows).write.parquet(f"{tmp_path}/labels.parquet")
    for start in (docs, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, start, str(tmp_path))
            got = out.collect()
            if name == "sentencepiece":
                assert out.columns[:4] == ["doc_id", "source", "lang", "n_tokens"]
                assert len(got) == start.count()
                assert all(r.round_trip is r.parity is (None if r.ids is None else True) for r in got)
                continue
            assert out.columns == start.columns and out.dtypes == start.dtypes
            # Columns that operators use inside come back as they were.
            assert all(all(r[c] == c for c in CLASHING) for r in got)
            if name == "line_dedup":
                assert len(got) == start.count()
                assert all(r.text is None or r.n_chars == len(r.text) for r in got)
            if name == "mix_sources":
                assert all((r.text or "").split() for r in got)
