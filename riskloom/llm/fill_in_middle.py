"""Fill-in-the-middle transformation of texts with a piece table.

A document is a list of descriptors (buffer, start, end) over buffers that never change:
its text and one buffer of sentinels. Cutting splits the text's descriptor at unit borders
into prefix, middle and suffix; an arrangement permutes the descriptors and puts sentinels
between; undoing it applies the inverse permutation to the descriptors of an output and
leaves the sentinels out. Texts are put together, or hashed, by streaming the descriptors;
no step copies a part of a text into another.

Units are runs of ASCII letters and single other characters. Which documents stay plain,
which form the others take and where they are cut depends on the id alone, by a digest.
A map over rows: no shuffle, and memory of a few times the longest text (its units are
found block by block).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.rows import map_rows
from riskloom.llm.words import encoded

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
SEED, PLAIN_FROM, SPM_BELOW = 1, 90, 20
# Bytes whose units are found at a time.
BLOCK = 1 << 20
# Which part of (prefix, middle, suffix) stands at each place of an output, and the
# sentinel in front of it.
ARRANGEMENTS = {
    "psm": ((0, PREFIX), (2, SUFFIX), (1, MIDDLE)),
    "spm": ((2, SUFFIX), (0, PREFIX), (1, MIDDLE)),
}

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_FIRST = (np.arange(256) & 0xC0) != 0x80


@dataclass(frozen=True)
class Piece:
    """A stretch of a buffer."""

    buffer: bytes
    start: int
    end: int

    def split(self, *at: int) -> list[Piece]:
        """Pieces up to, between and from places of the buffer in ascending order."""
        ends = (self.start, *at, self.end)
        return [Piece(self.buffer, a, b) for a, b in zip(ends, ends[1:])]

    @property
    def view(self) -> memoryview:
        return memoryview(self.buffer)[self.start : self.end]

    @property
    def chars(self) -> int:
        """Code points."""
        return sum(int(_FIRST[raw].sum()) for raw in blocks(self.view))


def blocks(data: bytes | memoryview) -> Iterator[np.ndarray]:
    raw = np.frombuffer(data, np.uint8)
    for at in range(0, len(raw), BLOCK):
        yield raw[at : at + BLOCK]


def _begins(data: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """(place, whether each byte begins a unit) of each block."""
    at, letter_before = 0, False
    for raw in blocks(data):
        letter = _LETTER[raw]
        before = np.empty_like(letter)
        before[0], before[1:] = letter_before, letter[:-1]
        yield at, np.where(letter, ~before, _FIRST[raw])
        at, letter_before = at + len(raw), bool(letter[-1])


def units(data: bytes) -> int:
    return sum(int(begins.sum()) for _, begins in _begins(data))


def unit_starts(data: bytes, wanted: list[int]) -> list[int]:
    """Bytes before so many units, in ascending order."""
    out, seen = [], 0
    for at, begins in _begins(data):
        here = int(begins.sum())
        found = None
        while len(out) < len(wanted) and wanted[len(out)] < seen + here:
            found = np.flatnonzero(begins) if found is None else found
            out.append(at + int(found[wanted[len(out)] - seen]))
        seen += here
    return out + [len(data)] * (len(wanted) - len(out))


def draws(key: str) -> list[int]:
    """Four 32-bit numbers of a key's digest."""
    digest = hashlib.sha256(key.encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def cut(text: bytes, h1: int, h2: int) -> tuple[int, list[Piece]]:
    """Number of units, and prefix, middle and suffix."""
    n = units(text)
    ends = sorted((h1 % (n + 1), h2 % (n + 1)))
    return n, Piece(text, 0, len(text)).split(*unit_starts(text, ends))


def arranged(parts: list[Piece], form: str) -> list[Piece]:
    """The parts in the order of the form, each behind its sentinel."""
    out = []
    for part, sentinel in ARRANGEMENTS[form]:
        at = SENTINELS.index(sentinel)
        out += [Piece(SENTINELS, at, at + len(sentinel)), parts[part]]
    return out


def parts_of(output: bytes, form: str) -> list[Piece]:
    """Prefix, middle and suffix as pieces of an output, from it and its form alone.

    The text holds no sentinel, or its form would be plain: the first of each is the one
    put there.
    """
    found, at = [], 0
    for _, sentinel in ARRANGEMENTS[form]:
        at = output.index(sentinel, at)
        found.append((at, at := at + len(sentinel)))
    ends = [start for start, _ in found[1:]] + [len(output)]
    placed = [Piece(output, start, end) for (_, start), end in zip(found, ends)]
    inverse = sorted(range(3), key=lambda place: ARRANGEMENTS[form][place][0])
    return [placed[place] for place in inverse]


def joined(pieces: Iterable[Piece]) -> bytes:
    return b"".join(p.view for p in pieces)


def digest(pieces: Iterable[Piece]) -> str:
    """Hex SHA-256 of the text that the pieces spell."""
    out = hashlib.sha256()
    for piece in pieces:
        out.update(piece.view)
    return out.hexdigest()


def form_of(text: bytes, h3: int, h4: int, plain_from: int, spm_below: int) -> str:
    if not text or h3 % 100 >= plain_from or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return "plain"
    return "spm" if h4 % 100 < spm_below else "psm"


def transformed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    plain_from: int = PLAIN_FROM,
    spm_below: int = SPM_BELOW,
    texts: bool = True,
) -> DataFrame:
    """(``id_col``, n, form, prefix_chars, middle_chars, output, output_sha256) per row.

    ``n`` counts units. The two lengths are in code points and null for plain documents.
    ``output`` is null unless ``texts``; its digest is there anyway. A null text is an
    empty one: plain, with an empty output. A null id draws as one without digits. Rows
    with the same id and text give the same row. Other columns are not read.
    """
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("name"),
    )

    def build() -> Callable:
        def each(key: object, text: str | None, name: str) -> tuple:
            h1, h2, h3, h4 = draws(f"{seed}:{name}")
            data = encoded(text)
            n, parts = cut(data, h1, h2)
            form = form_of(data, h3, h4, plain_from, spm_below)
            plain = form == "plain"
            out = [Piece(data, 0, len(data))] if plain else arranged(parts, form)
            sizes = (None, None) if plain else (parts[0].chars, parts[1].chars)
            spelled = joined(out).decode("utf-8", "surrogatepass") if texts else None
            return key, n, form, *sizes, spelled, digest(out)

        return each

    schema = (
        f"id {rows.schema['id'].dataType.simpleString()}, n long, form string, "
        "prefix_chars long, middle_chars long, output string, output_sha256 string"
    )
    return map_rows(rows, build, schema).withColumnRenamed("id", id_col)


def original(output: str | None, form: str | None) -> list[Piece]:
    """The text that an output was made of, as pieces of the output."""
    data = encoded(output)
    return parts_of(data, form) if form in ARRANGEMENTS else [Piece(data, 0, len(data))]


def restored(output: Column | str, form: Column | str) -> Column:
    """Struct of the text that was transformed and its digest, from these two alone.

    A null output is that of an empty text.
    """

    @F.pandas_udf("text string, sha256 string")
    def undone(outputs: pd.Series, forms: pd.Series) -> pd.DataFrame:
        found = [original(o, f) for o, f in zip(outputs, forms)]
        texts = [joined(p).decode("utf-8", "surrogatepass") for p in found]
        return pd.DataFrame({"text": texts, "sha256": [digest(p) for p in found]})

    return undone(output, form)
