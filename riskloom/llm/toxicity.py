"""Toxicity by compression distance to two trained dictionaries.

Two zstandard dictionaries are trained on words in their blanks: one on words
of ordinary labelled texts, one on words that toxic labelled texts have far more
often. The windows of a text are its distinct lower-cased words. Each is
compressed twice, once with either dictionary; the bytes that the toxic one
saves over the ordinary one are the window's margin. How many windows of a text
reach each margin, and how many windows it has, enter a logistic calibration
whose outcome is the score. The calibration is fitted on labelled texts that
the dictionaries have not seen.

Dictionaries are used as raw content and windows end in a fixed frame that both
dictionaries end in too: the frame costs the same bytes either way and gives
short words the room that the format's block headers and match search need.

Training words are counted in Spark over a bounded sample of labelled documents
(parameters below). A word counts once per document, and only if no earlier
document had it between the same neighbours, so that copies of one text do not
make its words look frequent. Scores use nothing but the whole text. Null and
empty texts have no windows and get the score of that. Without labelled texts of
both kinds every score is 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.labelled import sample
from riskloom.llm.words import encoded
from riskloom.sources.staging import staged

# Labelled documents used at most, per label.
TOXIC_DOCS, ORDINARY_DOCS = 4_000, 8_000
# Toxic documents that must hold a toxic word, at least and as a share of all toxic ones,
# and how many times as often as ordinary documents they must hold it.
LEAST_DOCS, LEAST_SHARE, TIMES = 3, 0.015, 6.0
# Distinct words that are handed to the trainer at most, most frequent first.
TOXIC_WORDS, ORDINARY_WORDS = 5_000, 50_000
TOXIC_BYTES, ORDINARY_BYTES = 8_192, 32_768
# Words in a training sample at most, repeated as their counts are.
PIECES = 400_000
LEVEL = 6
MARGINS = 8
# Words whose margin a task keeps.
KEPT_WORDS = 200_000
FRAME = b"<window:0123456789ABCDEFGHIJKLMNOP>"
BREAKS = re.compile(rb"[^\w\x80-\xff]+")


def window_words(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and underscores, and non-ASCII bytes."""
    return BREAKS.sub(b" ", encoded(text).lower()).split()


def _first_uses(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The first use of each distinct word of a text with its neighbours."""
    for batch in batches:
        rows = []
        for label, text in zip(batch["label"], batch["text"]):
            words, seen = window_words(text), set()
            for before, word, after in zip([b"", *words], words, [*words[1:], b""]):
                if word not in seen:
                    seen.add(word)
                    rows.append((label, word, before + b" " + after))
        yield pd.DataFrame(rows, columns=["label", "word", "between"])


def _trained(words: list[tuple[bytes, int]], size: int) -> bytes:
    """Dictionary content for words with their counts."""
    scale = min(1.0, PIECES / sum(n for _, n in words))
    pieces = [b" " + w + b" " for w, n in words for _ in range(max(1, round(n * scale)))]
    # The trainer wants its samples mixed; a fixed seed keeps reruns alike.
    order = np.random.default_rng(7).permutation(len(pieces))
    try:
        return zstandard.train_dictionary(size, [pieces[i] for i in order]).as_bytes()
    except zstandard.ZstdError:
        # Too few samples to train on: the words themselves, most frequent last.
        return b"".join(dict.fromkeys(reversed(pieces)))[-size:]


@dataclass
class CompressionModel:
    """Two dictionaries and the calibration's weights."""

    toxic: bytes = b""
    ordinary: bytes = b""
    weights: np.ndarray | None = None

    def _compressor(self, content: bytes) -> zstandard.ZstdCompressor:
        content += FRAME
        params = zstandard.ZstdCompressionParameters.from_level(
            LEVEL,
            source_size=64,
            dict_size=len(content),
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
        )
        dictionary = zstandard.ZstdCompressionDict(
            content, dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )
        dictionary.precompute_compress(compression_params=params)
        return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=params)

    def counter(self):
        """A function from a text to its features; keeps the margins of seen words."""
        toxic, ordinary = self._compressor(self.toxic), self._compressor(self.ordinary)
        margins: dict[bytes, int] = {}

        def features(text: str | None) -> list[float]:
            words = set(window_words(text))
            new = [w for w in words if w not in margins]
            if new:
                if len(margins) > KEPT_WORDS:
                    margins.clear()
                    new = list(words)
                windows = [b" " + w + b" " + FRAME for w in new]
                for word, a, b in zip(
                    new,
                    ordinary.multi_compress_to_buffer(windows, threads=1),
                    toxic.multi_compress_to_buffer(windows, threads=1),
                ):
                    margins[word] = len(a) - len(b)
            reached = Counter(min(margins[w], MARGINS) for w in words)
            return [1.0, float(np.log1p(len(words)))] + [
                float(np.log1p(reached.get(m, 0))) for m in range(1, MARGINS + 1)
            ]

        return features

    def features_column(self, text: str | Column) -> Column:
        model = self

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def counted(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            features = model.counter()
            for batch in texts:
                yield pd.Series([features(t) for t in batch])

        return counted(text)

    def column(self, text: str | Column) -> Column:
        """Score of a text column."""
        if self.weights is None:
            return F.lit(0.0)
        model = self

        @F.pandas_udf(T.DoubleType())
        def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            features = model.counter()
            for batch in texts:
                x = np.array([features(t) for t in batch]).reshape(len(batch), -1)
                total = x @ model.weights if len(batch) else np.zeros(0)
                yield pd.Series(1 / (1 + np.exp(-np.clip(total, -30, 30))))

        return scored(text)


def _calibrated(x: np.ndarray, y: np.ndarray, share: float) -> np.ndarray:
    """Weights of a ridge logistic fit, rows weighed to a ``share`` of toxic texts."""
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    ridge = np.full(x.shape[1], 0.01)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + ridge * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 3.0 / max(1e-12, np.abs(step).max()))
    return w


def train(
    docs: DataFrame,
    labels: DataFrame,
    keep: Column,
    label: str = "toxic",
    toxic_docs: int = TOXIC_DOCS,
    ordinary_docs: int = ORDINARY_DOCS,
) -> CompressionModel:
    """Model trained on the labelled documents where ``keep``, bounded per label."""
    share = labels.where(keep & F.col(label).isNotNull()).agg(F.avg(label)).first()[0] or 0.0
    chosen = sample(labels, label, keep, {0: ordinary_docs, 1: toxic_docs})
    chosen = staged(chosen.withColumn("half", F.pmod("turn", F.lit(2))), "chosen")
    sizes = {(r["half"], r["label"]): r["count"] for r in chosen.groupBy("half", "label").count().collect()}
    if any(sizes.get((h, v), 0) == 0 for h in (0, 1) for v in (0, 1)):
        return CompressionModel()
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    counts = staged(
        rows.where("half = 0")
        .select("label", "text")
        .mapInPandas(_first_uses, "label int, word binary, between binary")
        .distinct()
        .groupBy("word")
        .agg(F.count_if(F.col("label") == 1).alias("t"), F.count_if(F.col("label") == 0).alias("o")),
        "uses",
    )
    rate = (F.col("t") / sizes[0, 1]) / ((F.col("o") + 1) / sizes[0, 0])
    toxic = (
        counts.where((F.col("t") >= max(LEAST_DOCS, LEAST_SHARE * sizes[0, 1])) & (rate > TIMES))
        .orderBy(F.desc("t"), "word")
        .limit(TOXIC_WORDS)
        .collect()
    )
    ordinary = counts.where("o > 1").orderBy(F.desc("o"), "word").limit(ORDINARY_WORDS).collect()
    if not toxic or not ordinary:
        return CompressionModel()
    model = CompressionModel(
        _trained([(bytes(r["word"]), r["t"]) for r in toxic], TOXIC_BYTES),
        _trained([(bytes(r["word"]), r["o"]) for r in ordinary], ORDINARY_BYTES),
    )
    found = (
        rows.where("half = 1")
        .select("turn", "doc_id", "label", model.features_column("text").alias("x"))
        .toPandas()
        .sort_values(["turn", "doc_id"])
    )
    model.weights = _calibrated(np.array(found["x"].tolist()), found["label"].to_numpy(float), share)
    return model
