"""Token counts of whole texts by a transducer that is compiled from a tokenizer's model.

A byte-pair model merges neighbours, best score first, and a sequence of pieces is the
model's result exactly if no merge crosses any border between two neighbours. So the
pieces of a text's prefix are those of a shorter prefix and one more piece, and which
one it is depends on a bounded stretch of the text before. That makes a finite-state
transducer over characters. Its state is

* the longest end of the text that begins a piece, and
* for each place in it where a piece may have begun, the piece that ends there and how
  many more or fewer tokens than at the first such place there were.

A transition carries the number of tokens that it adds to the count of the first place,
which may be negative. States and transitions are made when first needed and kept, up to
a bound, by each worker; a text then costs one lookup a character.

A long text is cut into chunks of equal length that run on different tasks. A chunk does
not know the state it is entered in, so it runs from every state that its left neighbours'
characters allow, places that a piece may have crossed the cut from included; runs that
meet go on as one. Its map says, for each way in (place before the cut, piece that ends
there) and each way out, how many tokens lie between. Maps compose associatively, a
bounded number at a time, in rounds as many as the logarithm of the chunks: the up-sweep
of a prefix scan, whose last value is all that a count needs. However long a text is, no
task holds more of it than a chunk beyond the cutting itself.

Counts are those of the sentencepiece library: a metaspace before the text, spaces as
metaspaces, bytes for characters that the model lacks (or one token for a run of them),
control symbols inside texts as ordinary text. Null and empty texts have no tokens. Models
that rewrite characters, trim spaces, or have pieces of the user's are refused, not
approximated.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.rows import map_rows
from riskloom.llm.sentencepiece_tokens import BPE, BYTE, CONTROL, METASPACE, NORMAL, UNKNOWN, parse_model
from riskloom.sources.staging import discard, staged

# Characters of a chunk; chunk maps that compose in one step; transitions a worker keeps.
CHUNK, FAN, KEPT = 1 << 16, 32, 600_000
# What ends where no merge can cross, and a character that the model lacks.
BORDER, LACKING = "", "\uffff"

Map = list[tuple[int, str, int, str, int]]
MAPPED = "row long, no long, map array<struct<i:int,enters:string,o:int,leaves:string,n:long>>"


@dataclass
class Grammar:
    """What a model says about characters and borders."""

    scores: dict[str, float]
    prefixes: set[str]
    pairs: set[str]
    byte_fallback: bool
    dummy_prefix: bool

    @property
    def longest(self) -> int:
        return max(map(len, self.scores))


def grammar(data: bytes) -> Grammar:
    """Of a serialized byte-pair model."""
    model = parse_model(data)
    if model.type != BPE or model.charsmap or model.trim_spaces:
        raise ValueError("only byte-pair models that leave characters and spaces as they are")
    scores = {p: s for p, s, kind in model.pieces if kind == NORMAL}
    if any(kind not in (NORMAL, UNKNOWN, CONTROL, BYTE) for _, _, kind in model.pieces):
        raise ValueError("pieces of the user's and unused ones are not supported")
    if any(c not in scores for p in scores for c in p):
        raise ValueError("every character of a piece must be a piece")
    return Grammar(
        scores,
        {p[:i] for p in scores for i in range(1, len(p))},
        {p[i : i + 2] for p in scores for i in range(len(p) - 1)},
        model.byte_fallback,
        model.dummy_prefix,
    )


class Transducer:
    """Deterministic over characters; a row maps a character to (row, tokens added).

    The key "" of a row, which is no character, holds its state: (end of the text that
    begins a piece, ((places back, piece that ends there, tokens more), ...)).
    """

    def __init__(self, own: Grammar, kept: int = KEPT):
        self.own, self.kept = own, kept
        self.opens = {p[0] for p in own.pairs}
        self._whole: dict[str, bool] = {}
        self._apart: dict[tuple[str, str], bool] = {}
        self.forget()

    def forget(self) -> None:
        """Drops all states; called between texts once there are more than ``kept``."""
        self.rows: dict[tuple, dict] = {}
        self.made = 0
        self._apart.clear()
        self.start = self.row(("", ((0, BORDER, 0),)))

    def row(self, state: tuple) -> dict:
        found = self.rows.get(state)
        if found is None:
            found = self.rows[state] = {"": state}
        return found

    def _merged(self, text: str, border: int) -> bool:
        """Whether merging ends with pieces up to and from ``border`` (0: with one piece)."""
        scores = self.own.scores
        parts = list(text)
        at = border
        while len(parts) > (2 if border else 1):
            best, where = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, where = score, i
            if best is None:
                return False
            if border:
                if where == at - 1:
                    return False
                if where < at:
                    at -= 1
            parts[where : where + 2] = [parts[where] + parts[where + 1]]
        # Two parts that could still merge do.
        return not border or parts[0] + parts[1] not in scores

    def whole(self, piece: str) -> bool:
        """Whether merging makes the piece of its own characters."""
        found = self._whole.get(piece)
        if found is None:
            found = self._whole[piece] = len(piece) == 1 or self._merged(piece, 0)
        return found

    def apart(self, a: str, b: str) -> bool:
        """Whether no merge crosses the border between two pieces."""
        if a == BORDER or a[-1] + b[0] not in self.own.pairs:
            return True
        found = self._apart.get((a, b))
        if found is None:
            found = self._apart[a, b] = self._merged(a + b, len(a))
        return found

    def tokens(self, before: str, piece: str) -> int:
        """That a piece, or a character that the model lacks, adds."""
        if piece in self.own.scores:
            return 1
        if self.own.byte_fallback:
            return len(piece.encode("utf-8", "surrogatepass"))
        return int(before != LACKING)

    def step(self, row: dict, char: str) -> tuple[dict, int]:
        """Makes the transition; a row without places is left where no way leads on."""
        end, places = row[""]
        scores, prefixes = self.own.scores, self.own.prefixes
        found = None
        for back, before, n in places:
            piece = end[len(end) - back :] + char
            known = not back or (piece in scores and self.whole(piece))
            if known and self.apart(before, piece):
                found = (0, piece, n + self.tokens(before, piece))
                break
        after = end + char
        while after and after not in prefixes:
            after = after[1:]
        ahead = []
        if found:
            piece = found[1]
            if char not in scores and not self.own.byte_fallback:
                piece = LACKING
            elif char not in self.opens:
                piece = BORDER
            ahead.append((0, piece, found[2]))
        for back, before, n in places:
            if back < len(after) and after[len(after) - back - 1 :] in prefixes:
                if not back and before and before[-1] + char not in self.own.pairs:
                    before = BORDER
                ahead.append((back + 1, before, n))
        base = ahead[0][2] if ahead else 0
        state = (after, tuple((b, p, n - base) for b, p, n in ahead))
        made = row[char] = (self.row(state), base)
        self.made += 1
        return made

    def run(self, row: dict, text: str) -> tuple[dict, int]:
        total = 0
        for char in text:
            try:
                row, n = row[char]
            except KeyError:
                row, n = self.step(row, char)
            total += n
        return row, total

    def count(self, text: str) -> int:
        """Tokens of a whole text as :func:`spaced` has it."""
        if self.made > self.kept:
            self.forget()
        row, total = self.run(self.start, text)
        return total + row[""][1][0][2]

    def ways_in(self, left: str) -> list[tuple[int, str]]:
        """(places back, piece that ends there) that a cut after ``left`` may be met with."""
        own, found = self.own, []
        for back in range(min(own.longest, len(left) + 1)):
            if back and left[len(left) - back :] not in own.prefixes:
                continue
            before = left[: len(left) - back]
            crossed = before[-1:] + left[len(left) - back :][:1]
            if not before or (crossed not in own.pairs if back else before[-1] not in self.opens):
                lacks = not back and before and before[-1] not in own.scores
                found.append((back, LACKING if lacks and not own.byte_fallback else BORDER))
                continue
            for size in range(1, min(own.longest, len(before)) + 1):
                piece = before[len(before) - size :]
                if size == 1 or (piece in own.scores and self.whole(piece)):
                    found.append((back, piece))
        return found

    def map(self, left: str, text: str) -> Map:
        """Of a chunk after the characters ``left``, all there are or twice the longest piece."""
        if self.made > self.kept:
            self.forget()
        # Runs in step: row -> {way in: tokens}; those that meet share the row.
        lanes: dict[int, tuple[dict, dict]] = {}

        def enter(row: dict, ways: dict) -> None:
            if row[""][1]:
                lanes.setdefault(id(row), (row, {}))[1].update(ways)

        # From a way in, the next piece ends beyond the cut: no other place lies before it.
        for back, piece in self.ways_in(left) if left else [(0, BORDER)]:
            state = (left[len(left) - back :] if back else "", ((back, piece, 0),))
            enter(self.row(state), {(back, piece): 0})
        at = 0
        while at < len(text):
            # A single run goes on to the end, several a few characters at a time.
            size = len(text) if len(lanes) == 1 else 8
            moving, lanes = lanes, {}
            for row, ways in moving.values():
                row, n = self.run(row, text[at : at + size])
                enter(row, {way: m + n for way, m in ways.items()})
            at += size
        return [
            (*way, back, piece, n + more)
            for row, ways in lanes.values()
            for way, n in ways.items()
            for back, piece, more in row[""][1]
        ]


def composed(first: Map, second: Map) -> Map:
    """The map of two chunks that follow each other."""
    on: dict[tuple[int, str], list] = {}
    for i, enters, o, leaves, n in second:
        on.setdefault((i, enters), []).append((o, leaves, n))
    return [
        (i, enters, o, leaves, n + more)
        for i, enters, via, piece, n in first
        for o, leaves, more in on.get((via, piece), ())
    ]


def total(whole: Iterable[tuple]) -> int:
    """Tokens of a text whose chunks' maps are composed to ``whole``."""
    (n,) = {n for _, _, o, _, n in whole if o == 0}
    return n


def spaced(own: Grammar, text: str) -> str:
    """The text with metaspaces."""
    lead = METASPACE if own.dummy_prefix and text else ""
    return lead + text.replace(" ", METASPACE)


def cut(own: Grammar, text: str, chunk: int) -> Iterator[tuple[int, str, str]]:
    """(number, characters before, characters) of each chunk."""
    text = spaced(own, text)
    reach = 2 * own.longest
    for no, at in enumerate(range(0, len(text), chunk)):
        yield no, text[max(0, at - reach) : at], text[at : at + chunk]


def token_counts(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
) -> DataFrame:
    """(``id_col``, n_bytes, n_tokens) for every row of ``docs``.

    Reads these two columns only, so others may have any names. Null and empty texts
    have 0 and 0. Null and repeated ids are rows like any other. Texts of more than
    ``chunk`` characters are cut and counted by :meth:`Transducer.map`, the rest whole
    by :meth:`Transducer.count`; results do not depend on ``chunk``. The model's file is
    read once, on the driver.
    """
    with open(model_path, "rb") as file:
        own = grammar(file.read())
    # A worker keeps its transducer beside the grammar, for its later tasks.
    sent = docs.sparkSession.sparkContext.broadcast({"own": own})

    def machine() -> Transducer:
        kept = sent.value
        if "machine" not in kept:
            kept["machine"] = Transducer(kept["own"])
        return kept["machine"]

    @F.pandas_udf("long")
    def whole(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        each = machine()
        for batch in batches:
            yield pd.Series([each.count(spaced(each.own, t)) for t in batch], dtype="int64")

    def cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value["own"]
        for batch in batches:
            for row, text in zip(batch.column("row"), batch.column("text")):
                for no, left, part in cut(own, text.as_py(), chunk):
                    values = {"row": [row.as_py()], "no": [no], "left": [left], "part": [part]}
                    yield pa.RecordBatch.from_pydict(values)

    def mapper() -> Callable:
        each = machine()
        return lambda row, no, left, part: (row, no, each.map(left, part))

    def folder() -> Callable:
        def fold(row: int, no: int, maps: list[dict]) -> tuple:
            return row, no, reduce(composed, ([tuple(w.values()) for w in m["map"]] for m in maps))

        return fold

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    long = F.coalesce(F.length("text") > chunk, F.lit(False))
    counted = texts.where(~long).select(
        "id", size, whole(F.coalesce("text", F.lit(""))).alias("n_tokens")
    )
    rows = staged(
        texts.where(long).select(F.monotonically_increasing_id().alias("row"), "id", size, "text"),
        "long-texts",
    )
    # Chunks are dealt out anew, as one text may be most of a task's input.
    parts = rows.select("row", "text").mapInArrow(cutter, "row long, no long, left string, part string")
    maps = staged(map_rows(parts.repartition("row", "no"), mapper, MAPPED), "chunk-maps")
    last = maps.agg(F.max("no")).first()[0] or 0
    while last:
        near = maps.groupBy("row", F.floor(F.col("no") / FAN).cast("long").alias("of"))
        lists = near.agg(F.sort_array(F.collect_list(F.struct("no", "map"))).alias("maps"))
        wider = staged(map_rows(lists, folder, MAPPED), "chunk-maps")
        discard(maps)
        maps, last = wider, last // FAN
    total = F.filter("map", lambda way: way["o"] == 0)[0]["n"].alias("n_tokens")
    joined = rows.select("row", "id", "n_bytes").join(maps.select("row", total), "row")
    return counted.unionByName(joined.drop("row")).withColumnRenamed("id", id_col)
