"""SentencePiece encoding and decoding on the tokenizers library.

A serialized model is parsed from its protobuf wire format: pieces with scores
and kinds, the model type, and the settings of the normaliser. From them a
tokenizers pipeline is built that does the same:

* normaliser: the model's character map if it has one, trimming of surplus
  spaces if it asks for that, a leading metaspace, spaces to metaspaces;
* model: unigram pieces with their scores, or byte pairs whose merges are all
  pairs of pieces that concatenate to a piece, in the order of that piece's
  score; unknown characters fall back to byte pieces where the model has them;
* decoder: bytes fused to characters, metaspaces to spaces, the leading one
  dropped.

If no piece has a metaspace after another character, text is first split before
metaspaces, which changes no result. A text whose words stand between single spaces
is then the pieces of its words one after the other: a task remembers the pieces of
words it has met, and which of them the library decodes to something else, and hands
only new ones to it. Other texts, and those of models that rewrite characters, go to it
whole.

Texts are encoded in batches of bounded size, on one thread unless tasks have
several cores. The ids of every text are held against those of the sentencepiece
library, which encodes it whole, unless ``parity`` is turned off.
The model's bytes are read once on the driver and broadcast (about half a MB), so
executors need no file. Null texts give null ids, empty ones no ids; texts of
any length are encoded whole. Other columns pass through, but for one named ``_tokens``,
which the result's replaces.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
METASPACE = "▁"
# Characters that are encoded at a time.
BATCH_CHARS = 1 << 20
# Words whose pieces a task remembers, and new ones that are one text for the library.
REMEMBERED, NEW_WORDS = 500_000, 4_096
# Fixed values of the public model format: kinds of pieces and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def wire_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message; numbers for varints, else bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, data[at : at + size]
        at += size


@dataclass
class PieceModel:
    """What the serialized model says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    type: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trim_spaces: bool = True
    escape_spaces: bool = True
    suffix: bool = False

    @property
    def splits(self) -> bool:
        """Whether no piece has a metaspace after another character."""
        return not any(METASPACE in p.lstrip(METASPACE) for p, _, kind in self.pieces if kind == NORMAL)

    @property
    def by_words(self) -> bool:
        """Whether words between single spaces can be encoded one by one."""
        own = any(kind == USER_DEFINED for _, _, kind in self.pieces)
        return self.splits and self.dummy_prefix and not (own or self.charsmap or self.trim_spaces)

    @property
    def unknown(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)


def parse_model(data: bytes) -> PieceModel:
    model = PieceModel()
    for number, value in wire_fields(data):
        if number == 1:
            own = dict(wire_fields(value))
            score = struct.unpack("<f", own[2])[0] if 2 in own else 0.0
            model.pieces.append((own.get(1, b"").decode("utf-8"), score, own.get(3, NORMAL)))
        elif number == 2:
            own = dict(wire_fields(value))
            model.type = own.get(3, UNIGRAM)
            model.byte_fallback = bool(own.get(35, 0))
            model.suffix = bool(own.get(24, 0))
        elif number == 3:
            own = dict(wire_fields(value))
            model.charsmap = own.get(2, b"")
            model.dummy_prefix = bool(own.get(3, 1))
            model.trim_spaces = bool(own.get(4, 1))
            model.escape_spaces = bool(own.get(5, 1))
    if model.type not in (UNIGRAM, BPE) or model.suffix or not model.escape_spaces:
        raise ValueError("only unigram and byte-pair models with leading metaspaces are supported")
    return model


def merges(model: PieceModel) -> list[tuple[str, str]]:
    """Pairs of pieces that make a piece, best score first."""
    usable = {p: s for p, s, kind in model.pieces if kind in (NORMAL, USER_DEFINED, UNUSED)}
    found = [
        (-score, at, piece[:cut], piece[cut:])
        for at, (piece, score) in enumerate(usable.items())
        for cut in range(1, len(piece))
        if piece[:cut] in usable and piece[cut:] in usable
    ]
    return [(a, b) for _, _, a, b in sorted(found)]


def build(model: PieceModel) -> Tokenizer:
    """The model as a tokenizers pipeline."""
    unknown = model.unknown
    if model.type == UNIGRAM:
        core = models.Unigram(
            [(p, s) for p, s, _ in model.pieces], unknown, byte_fallback=model.byte_fallback
        )
    else:
        core = models.BPE(
            vocab={p: i for i, (p, _, _) in enumerate(model.pieces)},
            merges=merges(model),
            unk_token=model.pieces[unknown][0],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
            # The library's own memory of words is of use only where ours is not used.
            cache_capacity=0 if model.by_words else 20_000,
        )
    out = Tokenizer(core)
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.trim_spaces:
        steps += [
            normalizers.Replace(Regex("^ +| +$"), ""),
            normalizers.Replace(Regex(" {2,}"), " "),
        ]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(METASPACE))
    steps.append(normalizers.Replace(" ", METASPACE))
    out.normalizer = normalizers.Sequence(steps)
    if model.splits:
        out.pre_tokenizer = pre_tokenizers.Split(Regex(f"{METASPACE}+[^{METASPACE}]*"), "isolated")
    own = [p for p, _, kind in model.pieces if kind == USER_DEFINED]
    if own:
        out.add_tokens([AddedToken(p, normalized=True, special=False) for p in own])
    scheme = "always" if model.dummy_prefix else "never"
    out.decoder = decoders.Sequence(
        [decoders.ByteFallback(), decoders.Metaspace(METASPACE, prepend_scheme=scheme)]
    )
    return out


def slices(texts: list[str | None], chars: int) -> Iterator[list[str | None]]:
    """Runs of texts of about ``chars`` characters; a longer text is a run of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= chars or i == len(texts) - 1:
            yield texts[start : i + 1]
            start, size = i + 1, 0


def encode(tokenizer: Tokenizer, texts: list[str]) -> list[np.ndarray]:
    """Ids of each text, without special tokens."""
    found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    return [np.array(e.ids, np.int32) for e in found]


def _undropped(tokenizer: Tokenizer) -> Tokenizer:
    """The tokenizer with a decoder that keeps all spaces."""
    out = Tokenizer.from_str(tokenizer.to_str())
    out.decoder = decoders.Sequence(
        [decoders.Replace(METASPACE, " "), decoders.ByteFallback(), decoders.Fuse()]
    )
    return out


class Decoder:
    """Decodes ids on the library's threads.

    The pipeline's own decoder drops all metaspaces of the first piece, where
    only the leading one is not text. Texts that open with a piece of several
    are decoded without dropping any, and lose one space here.
    """

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer
        self.exact: Tokenizer | None = None
        pieces = tokenizer.get_vocab(with_added_tokens=False)
        self.several = {i for p, i in pieces.items() if p.startswith(METASPACE * 2)}

    def __call__(self, ids: list[np.ndarray]) -> list[str]:
        lists = [i.tolist() for i in ids]
        out = self.tokenizer.decode_batch(lists, skip_special_tokens=False)
        for i, own in enumerate(lists):
            if own and own[0] in self.several:
                self.exact = self.exact or _undropped(self.tokenizer)
                out[i] = self.exact.decode(own, skip_special_tokens=False)[1:]
        return out


def _spaced(text: str) -> bool:
    """Whether a text is empty or has spaces that are not single between words."""
    return not text or "  " in text or text[0] == " " or text[-1] == " " or METASPACE in text


def _whole(
    tokenizer: Tokenizer, decoder: Decoder, texts: list[str], decoded: bool
) -> tuple[list[np.ndarray], list]:
    """Ids of each text, and what they decode to or None, all by the library."""
    ids = encode(tokenizer, texts)
    return ids, decoder(ids) if decoded else [None] * len(ids)


class Words(dict):
    """Numbers of words in the order they are first met; looking up a new one adds it."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class WordEncoder:
    """Encodes texts as :func:`encode` and decodes them, looking up words it has met before.

    New words go to the library many at a time, between single spaces, and so do their ids
    to be decoded. The decoded text of words between single spaces is that of its words
    between single spaces: where each decodes to itself, it is the text. What a word decodes
    to is kept only where that is something else.
    """

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer, self.decoder = tokenizer, Decoder(tokenizer)
        pieces = tokenizer.get_vocab(with_added_tokens=False)
        self.opens = np.zeros(max(pieces.values()) + 1, bool)
        self.opens[[i for p, i in pieces.items() if p.startswith(METASPACE)]] = True
        self._forget()

    def _forget(self) -> None:
        self.known = Words()
        self.other: dict[int, str] = {}
        self.ids, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _learn(self) -> None:
        """Adds the ids of the new words and what they decode to."""
        words, self.known.new = self.known.new, []
        first = len(self.known) - len(words)
        found, starts = [self.ids], [self.starts]
        size = len(self.ids)
        for at in range(0, len(words), NEW_WORDS):
            own = words[at : at + NEW_WORDS]
            (ids,) = encode(self.tokenizer, [" ".join(own)])
            # Exactly the first piece of each word opens with a metaspace.
            begins = np.flatnonzero(self.opens[ids])
            (joined,) = self.decoder([ids])
            spelled = joined.split(" ")
            if len(spelled) != len(own):
                spelled = self.decoder(np.split(ids, begins[1:]))
            pairs = enumerate(zip(own, spelled), first + at)
            self.other.update((n, s) for n, (w, s) in pairs if w != s)
            found.append(ids)
            starts.append(size + np.append(begins[1:], len(ids)))
            size += len(ids)
        self.ids, self.starts = np.concatenate(found), np.concatenate(starts)

    def __call__(self, texts: list[str], decoded: bool = True) -> tuple[list[np.ndarray], list]:
        """Ids of each text, and what they decode to or None."""
        whole = [_spaced(t) for t in texts]
        rest = encode(self.tokenizer, [t for t, w in zip(texts, whole) if w])
        rest = iter(zip(rest, self.decoder(rest) if decoded else [None] * len(rest)))
        if len(self.known) > REMEMBERED:
            self._forget()
        split = (t.split(" ") for t, w in zip(texts, whole) if not w)
        places = [n for ws in split for n in map(self.known.__getitem__, ws)]
        if self.known.new:
            self._learn()
        at = np.array(places, np.int64)
        lengths = self.starts[at + 1] - self.starts[at]
        ends = np.cumsum(lengths)
        taken = np.arange(ends[-1] if len(ends) else 0) + np.repeat(
            self.starts[at] - (ends - lengths), lengths
        )
        ids = self.ids[taken]
        others = np.isin(at, list(self.other)) if self.other else np.zeros(len(at), bool)
        out, back, first, start = [], [], 0, 0
        for text, w in zip(texts, whole):
            if w:
                own, spelled = next(rest)
            else:
                last = first + text.count(" ") + 1
                own, start = ids[start : ends[last - 1]], ends[last - 1]
                spelled = text if decoded else None
                if decoded and others[first:last].any():
                    words = zip(places[first:last], text.split(" "))
                    spelled = " ".join(self.other.get(n, word) for n, word in words)
                first = last
            out.append(own)
            back.append(spelled)
        return out, back


ENCODED = T.StructType(
    [
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("decoded", T.StringType()),
        T.StructField("parity", T.BooleanType()),
    ]
)


def with_tokens(
    docs: DataFrame,
    text_col: str = "text",
    model_path: str = MODEL_PATH,
    threads: int | None = None,
    decoded: bool = True,
    parity: bool = True,
) -> DataFrame:
    """``docs`` with the column ``_tokens``: struct of ids, decoded text and parity.

    ``decoded`` and ``parity`` are null unless asked for.
    A task encodes on as many ``threads`` as the session gives it cores
    (``spark.task.cpus``); more would take the cores of other tasks.
    """
    threads = threads or int(docs.sparkSession.conf.get("spark.task.cpus", "1"))
    with open(model_path, "rb") as file:
        data = file.read()
    model = parse_model(data)
    by_words = model.by_words
    sent = docs.sparkSession.sparkContext.broadcast((data, build(model).to_str()))

    @F.pandas_udf(ENCODED)
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        # Read by the library's thread pool when it starts, in this worker.
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = str(threads > 1).lower()
        serialized, pipeline = sent.value
        tokenizer = Tokenizer.from_str(pipeline)
        if by_words:
            coded = WordEncoder(tokenizer)
        else:
            coded = partial(_whole, tokenizer, Decoder(tokenizer))
        reference = None
        if parity:
            from sentencepiece import SentencePieceProcessor

            reference = SentencePieceProcessor(model_proto=serialized)
        # Ids take many times the room of their text until they are packed: small slices.
        for part in (p for batch in batches for p in slices(batch.tolist(), BATCH_CHARS)):
            texts = [t for t in part if t is not None]
            ids, back = coded(texts, decoded)
            same = [None] * len(ids)
            if reference is not None:
                theirs = reference.encode(texts, num_threads=threads, return_type="numpy")
                same = [np.array_equal(a, b) for a, b in zip(theirs, ids)]
            rows = zip(ids, back, same)
            yield pd.DataFrame(
                [(None, None, None) if t is None else next(rows) for t in part],
                columns=["ids", "decoded", "parity"],
            )

    return docs.withColumn("_tokens", tokens(text_col))
