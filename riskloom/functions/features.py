"""Post features, weighted score, label and explanation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.functions import text as tx
from riskloom.model import FEATURES

# A word with at least three letters, all of them upper case.
_OTHER = rf"[^\p{{L}}{tx.SPACE_CLASS}]"
_CAPS_CHAR = rf"[^\p{{Ll}}\p{{Lt}}\p{{Lm}}\p{{Lo}}{tx.SPACE_CLASS}]"
_NOT_SPACE = rf"[^{tx.SPACE_CLASS}]"
CAPS_WORD = (
    rf"(?<!{_NOT_SPACE})(?=(?:{_OTHER}*+\p{{Lu}}){{3}}){_CAPS_CHAR}++(?!{_NOT_SPACE})"
)
ANY_WORD = f"{_NOT_SPACE}+"
# What a text must hold to have such a word; quick to rule out.
_CAPS_RUN = rf"\p{{Lu}}{_OTHER}*+\p{{Lu}}{_OTHER}*+\p{{Lu}}"


def listed(words: Column, terms: tuple[str, ...]) -> Column:
    """Lower-cased ``words`` that are in ``terms``, in order and with repeats."""
    if not terms:
        return F.array().cast("array<string>")
    return F.transform(F.filter(words, lambda w: F.lower(w).isin(*terms)), F.lower)


def lexicon_hits(text: Column, terms: tuple[str, ...]) -> Column:
    """Lexicon words of ``text``, in order and with repeats."""
    return listed(tx.words(text), terms)


def distinct_terms(hits: Column) -> Column:
    return F.sort_array(F.array_distinct(hits))


def lexicon_feature(hits: Column, cap: float) -> tuple[Column, Column, Column]:
    """(feature value, count with repeats, sorted distinct terms)."""
    count = F.size(hits)
    return F.least(count / F.lit(cap), F.lit(1.0)), count, distinct_terms(hits)


def keyword_density(n_tokens: Column, violent: Column, hate: Column, cap: float) -> Column:
    """Share of lexicon words among tokens over ``cap``; 0 without tokens."""
    share = (violent + hate) / n_tokens
    return F.when(n_tokens > 0, F.least(share / F.lit(cap), F.lit(1.0))).otherwise(0.0)


def threat_hits(text: Column, patterns: tuple[str, ...]) -> Column:
    """Matched threats, pattern by pattern, each left to right.

    Most texts hold none, so one combined test guards the separate passes.
    """
    none = F.array().cast("array<string>")
    if not patterns:
        return none
    found = F.concat(*(tx.matches(text, tx.with_unicode_boundaries(p)) for p in patterns))
    return F.when(text.rlike(tx.with_unicode_boundaries(*patterns)), found).otherwise(none)


def threat_feature(hits: Column) -> Column:
    return F.when(F.size(hits) > 0, F.lit(1.0)).otherwise(F.lit(0.0))


def all_caps_feature(text: Column, cap: float) -> Column:
    """Share of upper-case words over ``cap``; 0 without words."""
    share = tx.count_matches(text, CAPS_WORD) / tx.count_matches(text, ANY_WORD)
    return F.when(text.rlike(_CAPS_RUN), F.least(share / F.lit(cap), F.lit(1.0))).otherwise(0.0)


def combine(features: dict[str, Column], weights: tuple[tuple[str, float], ...]) -> Column:
    """Weighted sum in the order of ``weights``, clamped to [0, 1] (P10)."""
    total = F.lit(0.0)
    for name, weight in weights:
        total = total + F.lit(weight) * features[name]
    return F.greatest(F.lit(0.0), F.least(total, F.lit(1.0)))


def label(score: Column, high: float, medium: float) -> Column:
    """high / medium / low, both thresholds inclusive."""
    return (
        F.when(score >= F.lit(high), "high").when(score >= F.lit(medium), "medium").otherwise("low")
    )


def feature_record(features: dict[str, Column]) -> Column:
    """The feature breakdown as a struct."""
    return F.struct(*(features[name].alias(name) for name in FEATURES))


def fixed(value: Column, pattern: str = "0.00") -> Column:
    """Fixed decimals, rounding the exact binary value (not its short decimal form)."""
    return F.call_function("format_number", value, F.lit(pattern))


def post_explanation(
    language: Column,
    score: Column,
    risk_label: Column,
    violent: Column,
    hate: Column,
    n_intensifiers: Column,
    threats: Column,
    all_caps: Column,
    density: Column,
) -> Column:
    """Human-readable reasons, joined by ``"; "``.

    Fixed values: the names, brackets and sentences below are part of the format.
    """

    def terms(name: str, hits: Column) -> Column:
        shown = F.array_join(F.slice(distinct_terms(hits), 1, 5), ", ")
        return F.when(
            F.size(hits) > 0,
            F.concat(F.lit(f"{name}="), F.size(hits).cast("string"), F.lit(" ("), shown, F.lit(")")),
        )

    harmless = (F.size(violent) == 0) & (F.size(hate) == 0) & (F.size(threats) == 0)
    return F.concat_ws(
        "; ",
        F.concat(F.lit("language="), language),
        F.concat(F.lit("score="), fixed(score), F.lit(" ("), risk_label, F.lit(")")),
        terms("violent", violent),
        terms("hate", hate),
        F.when(
            n_intensifiers > 0, F.concat(F.lit("intensifiers="), n_intensifiers.cast("string"))
        ),
        F.when(
            F.size(threats) > 0,
            F.concat(F.lit("threat=("), F.array_join(F.slice(threats, 1, 3), "; "), F.lit(")")),
        ),
        F.when(all_caps > 0, F.concat(F.lit("allcaps="), fixed(all_caps))),
        F.when(density > 0, F.concat(F.lit("density="), fixed(density))),
        F.when(harmless, F.lit("no explicit harmful keywords")),
    )
