from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import language as lg

TEXTS = [
    ("en", "the quick brown fox and the lazy dog were in the house of the king"),
    ("de", "der schnelle Fuchs und der faule Hund waren im Haus des Königs und nicht"),
    ("fr", "le renard et le chien paresseux étaient dans la maison de la reine"),
    ("en", "this is what they have been thinking about the weather and the news"),
]


def brute_counts(text):
    p = [ord(c) for c in text.lower()]
    counts = {}
    for a, b, c in zip(p, p[1:], p[2:]):
        h = (a * 961 + b * 31 + c) % lg.BUCKETS
        counts[h] = counts.get(h, 0) + 1
    return counts


def brute_profiles():
    totals = {}
    for lang, text in TEXTS:
        for h, n in brute_counts(text).items():
            totals.setdefault(lang, {}).setdefault(h, 0)
            totals[lang][h] += n
    return {
        lang: {
            h: round(1000 * math.log((n + 1) / (sum(c.values()) + lg.BUCKETS)))
            for h, n in [*c.items(), (lg.UNSEEN, 0)]
        }
        for lang, c in totals.items()
    }


@pytest.fixture(scope="module")
def profiles(spark):
    df = spark.createDataFrame([*TEXTS, ("en", None)], "lang string, text string").repartition(3)
    return lg.train_language_profiles(df)


def test_profiles_match_brute_force(profiles):
    got = {}
    for r in profiles.collect():
        got.setdefault(r.lang, {})[r.bucket] = r.weight
    assert got == brute_profiles()


def test_detection_matches_brute_force(spark, profiles):
    texts = [
        "the dog and the fox", "und der Hund nicht mehr da", "la maison de la reine est belle",
        "zzzz qqqq xxxx wwww jjjj", "short", "", "日本語のテキストはここにあります、そして長いです",
        "nineteen characters", "𝔘𝔫𝔦𝔠𝔬𝔡𝔢 beyond the basic plane",
    ]
    model = brute_profiles()

    def brute(text):
        if len(text) < 20:
            return "unknown"
        score = {
            lang: sum(n * w.get(h, w[lg.UNSEEN]) for h, n in brute_counts(text).items())
            for lang, w in model.items()
        }
        return min(score, key=lambda k: (-score[k], k))

    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in lg.detect_language(df, profiles).collect():
        assert r.language == brute(r.text), r.text


def test_without_profiles_all_is_unknown(spark, profiles):
    detect = lg.detector(profiles.limit(0))
    df = spark.createDataFrame([("a text of more than twenty characters",)], "t string")
    assert df.select(detect(F.col("t"))).first()[0] == "unknown"


def test_short_texts_are_scored_together(spark, profiles):
    rng = random.Random(2)
    words = " ".join(t for _, t in TEXTS).split()
    texts = [" ".join(rng.choice(words) for _ in range(5)) for _ in range(200)] + ["", "ab", "abc"]
    weights = np.array([[rng.randint(-9000, 0) for _ in range(lg.BUCKETS)] for _ in range(3)])
    want = [int(np.argmax(weights @ lg._trigram_counts(t, lg.BUCKETS))) for t in texts]
    assert [i for part in lg._slices(texts, 900) for i in lg._best(part, weights)] == want
    assert list(lg._best(["a"], weights)) == [0]
