"""Text primitives with Unicode-exact character classes.

``\\w`` and ``\\b`` differ between regex engines, so word characters and
whitespace are spelled out as classes and boundaries as look-arounds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]"
NOT_AFTER_WORD = rf"(?<!{WORD})"
NOT_BEFORE_WORD = rf"(?!{WORD})"
SPACE_CLASS = r"\p{IsWhite_Space}\x1c-\x1f"

# Every character of SPACE_CLASS, for trim().
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def matches(text: Column, pattern: str) -> Column:
    """All whole matches of ``pattern``, left to right."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def count_matches(text: Column, pattern: str) -> Column:
    return F.size(matches(text, pattern))


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    return F.length(strip(text)) == 0


def blank_to_null(text: Column) -> Column:
    return F.when(~is_blank(text), text)


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of word characters."""
    return matches(text, f"{WORD}+")


def tokens(text: Column) -> Column:
    """Words, lower-cased after splitting."""
    return F.transform(words(text), F.lower)


def scoring_text(title: Column, *bodies: Column) -> Column:
    """Title, newline, first non-blank body; the whole stripped.

    A collected post repeats its title inside ``text``, so its title words
    count twice. That is the rule, not an oversight.
    """
    body = F.coalesce(*(blank_to_null(b) for b in bodies), F.lit(""))
    return strip(F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), body))


def with_unicode_boundaries(*patterns: str) -> str:
    """One case-insensitive pattern for any of ``patterns``, ``\\b`` spelled out.

    Where all of them start (end) at a word boundary, it is tested once for
    all, which decides most positions of a text with a single look-behind.
    """
    bare = list(patterns)
    head = tail = ""
    if all(p.startswith(r"\b") for p in bare):
        head, bare = NOT_AFTER_WORD, [p[2:] for p in bare]
    if all(p.endswith(r"\b") for p in bare):
        tail, bare = NOT_BEFORE_WORD, [p[:-2] for p in bare]
    boundary = f"(?:(?<={WORD}){NOT_BEFORE_WORD}|{NOT_AFTER_WORD}(?={WORD}))"
    spelled = (p.replace(r"\b", boundary) for p in bare)
    return f"(?iu){head}(?:{'|'.join(spelled)}){tail}"
