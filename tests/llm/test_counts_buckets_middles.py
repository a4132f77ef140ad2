"""Token counts, resampling and fill-in-the-middle: hard rows, brute force, round trips."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from functools import reduce

import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from riskloom.llm import fill_in_middle, token_counts, word_buckets

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# Extra columns with the names that operators use inside.
EXTRA = (
    ", id string, row string, no string, name string, map string, place string, score string, "
    "weight string, n string, n_bytes string, rank string, output string, _text string, "
    "_among string, _range string, form string, _n string"
)
N_EXTRA = EXTRA.count(" string")
RNG = random.Random(11)
ODD = ["a", "aa", "b", " ", "  ", "the", "ing", "-", "--", "=", "\n", "日", "本", "🙂", "0", "é"]
ODD += [".", "...", "A", "ab", "tion", " th", "▁", "<s>", "\x00", "\t", "*", "<P", "<M>", "￿"]


def odd(most: int) -> str:
    return "".join(RNG.choice(ODD) for _ in range(RNG.randint(0, most)))


def hard_texts() -> list[str | None]:
    return [None, "", " ", "\n\t", "one", "<P>x", "é" * 300, "a" * 3000, odd(4_000), "same", "same"]


@pytest.fixture(scope="module")
def texts():
    return [*hard_texts(), *(odd(60) for _ in range(60))]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, *["x"] * N_EXTRA) for i, t in enumerate(texts)]
    rows += [rows[9], (9, "another of the id", *["y"] * N_EXTRA), (None, "no id", *["z"] * N_EXTRA)]
    rows += [(None, None, *[None] * N_EXTRA)]
    return spark.createDataFrame(rows, "doc_id long, text string" + EXTRA).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def machine():
    with open(MODEL, "rb") as file:
        return token_counts.Transducer(token_counts.grammar(file.read()))


# Token counts


def test_counts_are_the_librarys(machine, library):
    own = machine.own
    for text in [odd(60) for _ in range(500)] + [t or "" for t in hard_texts()]:
        assert machine.count(token_counts.spaced(own, text)) == len(library.encode(text)), text


def test_chunk_maps_compose_to_the_count(machine, library):
    for text in [odd(60) or "x" for _ in range(200)] + ["a" * 999, "=" * 301 + " " * 90, "ab" * 500]:
        size = RNG.choice([1, 2, 3, 5, 9, 40])
        maps = [machine.map(left, part) for _, left, part in token_counts.cut(machine.own, text, size)]
        want = len(library.encode(text))
        assert token_counts.total(reduce(token_counts.composed, maps)) == want, text
        # Composing is associative: halves first gives the same.
        half = len(maps) // 2
        if half:
            a, b = (reduce(token_counts.composed, part) for part in (maps[:half], maps[half:]))
            assert token_counts.total(token_counts.composed(a, b)) == want


def test_forgetful_transducer_counts_the_same(machine, library):
    small = token_counts.Transducer(machine.own, kept=50)
    for text in [odd(60) for _ in range(200)]:
        assert small.count(token_counts.spaced(small.own, text)) == len(library.encode(text))


def test_characters_without_bytes_make_one_token_a_run(machine):
    own = token_counts.Grammar(
        machine.own.scores, machine.own.prefixes, machine.own.pairs, False, machine.own.dummy_prefix
    )
    each = token_counts.Transducer(own)
    for text in ("a🜁🜁 🜁b", "🜁" * 40, "x"):
        runs = len(re.findall("🜁+", text))
        plain = token_counts.spaced(own, text)
        want = runs + sum(machine.count(p) for p in re.split("🜁+", plain) if p)
        assert each.count(plain) == want
        maps = [each.map(left, part) for _, left, part in token_counts.cut(own, text, 3)]
        assert token_counts.total(reduce(token_counts.composed, maps)) == want


@pytest.mark.parametrize("chunk", [50, token_counts.CHUNK])
def test_counts_of_hard_rows(docs, library, chunk):
    found = token_counts.token_counts(docs, MODEL, chunk=chunk)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens"]
    want = [
        (r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "")))
        for r in docs.select("doc_id", "text").collect()
    ]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


def test_counts_of_no_rows(empty):
    assert token_counts.token_counts(empty, MODEL).count() == 0


# Resampling


def words(text: str | None) -> list[bytes]:
    data = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    return re.findall(rb"[0-9a-z\x80-\xff]+", data)


def features(text: str | None, most: int) -> list[int]:
    own = words(text)
    return [
        zlib.crc32(b" ".join(own[i : i + n])) % word_buckets.BUCKETS
        for n in range(1, most + 1)
        for i in range(len(own) - n + 1)
    ]


def noise(doc_id) -> int:
    name = "" if doc_id is None else str(doc_id)
    h = int(hashlib.sha256(f"2024:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def resampled(rows, target, most, least, percent):
    s, t = [0] * word_buckets.BUCKETS, [0] * word_buckets.BUCKETS
    for counts, texts in ((s, [r[1] for r in rows]), (t, target)):
        for text in texts:
            for b in features(text, most):
                counts[b] += 1
    S, T, n = sum(s), sum(t), word_buckets.BUCKETS
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + n) / ((s[b] + 1) * (T + n)))) for b in range(n)]
    out = []
    for doc_id, text in rows:
        own = features(text, most)
        weight = sum(gain[b] for b in own)
        out.append([doc_id, len(own), weight, weight + noise(doc_id), None, len(words(text))])
    among = sorted(
        (r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0)
    )
    for i, r in enumerate(among[: len(among) * percent // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


@pytest.mark.parametrize("most", [1, 3])
def test_resampling_by_brute_force(spark, docs, most):
    target = ["One the ING ab, tion", None, "", "日本 é the the-the same another"]
    aims = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    found = word_buckets.resampled(docs, aims, most=most, least_words=4, percent=40)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, found.collect()), key=repr) == resampled(rows, target, most, 4, 40)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]


def test_resampling_of_empty_tables(docs, empty):
    assert word_buckets.resampled(empty, docs).count() == 0
    found = word_buckets.resampled(docs, empty, percent=100, least_words=0)
    ranks = sorted(r.rank for r in found.collect())
    assert ranks == list(range(1, docs.count() + 1))


def test_payloads_follow_on_over_slices(monkeypatch):
    text = " ".join("w%d" % RNG.randint(0, 40) for _ in range(500)) + " " + "long" * 30
    want = features(text, 2)
    monkeypatch.setattr(word_buckets, "SLICE", 64)
    (found,) = word_buckets.Payloads().buckets([text], 2, word_buckets.BUCKETS)
    assert list(found) == want


# Fill in the middle


def test_transformed_texts_by_brute_force(docs):
    made = fill_in_middle.transformed(docs)
    back = fill_in_middle.restored("output", "form")
    found = made.select("*", back.text.alias("restored"), back.sha256.alias("sha")).collect()
    texts = sorted(((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=repr)
    # The text of a row is what it restores to.
    null = lambda r: (r.doc_id, r.restored or None)
    assert sorted(map(null, found), key=repr) == sorted(((i, t or None) for i, t in texts), key=repr)
    for r in found:
        text, name = r.restored, "" if r.doc_id is None else r.doc_id
        u = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
        d = hashlib.sha256(f"1:{name}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(d[i : i + 8], 16) for i in range(0, 32, 8))
        a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
        p, m, s = ("".join(part) for part in (u[:a], u[a:b], u[b:]))
        form = "psm" if h4 % 100 >= 20 else "spm"
        if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
            form = "plain"
        out = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
        sizes = (None, None) if form == "plain" else (len(p), len(m))
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == (len(u), form, *sizes, out)
        assert r.output_sha256 == hashlib.sha256(out.encode()).hexdigest()
        assert r.sha == hashlib.sha256(text.encode()).hexdigest()
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_units_over_blocks(monkeypatch):
    monkeypatch.setattr(fill_in_middle, "BLOCK", 7)
    for text in [odd(200) for _ in range(100)]:
        u, data = re.findall(r"[A-Za-z]+|[^A-Za-z]", text), text.encode()
        assert fill_in_middle.units(data) == len(u)
        at = sorted(RNG.randint(0, len(u)) for _ in range(2))
        want = [len("".join(u[:i]).encode()) for i in at]
        assert fill_in_middle.unit_starts(data, at) == want


def test_no_output_texts_unless_asked(docs, empty):
    made = fill_in_middle.transformed(docs, texts=False)
    assert made.where("output is not null or output_sha256 is null").isEmpty()
    assert fill_in_middle.transformed(empty).count() == 0
    same = made.where("doc_id = 9").groupBy("output_sha256").count().agg(F.max("count")).first()[0]
    assert same == 2
