"""Post scoring (P14, P15, U1, U2) and the large-lexicon variant of P4."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import features as ft
from riskloom.functions import text as tx
from riskloom.functions.normalize import post_id
from riskloom.model import DEFAULT_MODEL, RiskModel
from riskloom.operators.skew import few
from riskloom.schemas import SCORED_POST_COLUMNS

# A word of some 20 bytes each: a broadcast table of some tens of megabytes.
BROADCAST_TERMS = 500_000
BODY_COLUMNS = ("text", "selftext", "body", "content")


def post_text(posts: DataFrame) -> Column:
    """The scoring text from whichever body columns the table has."""
    return tx.scoring_text(F.col("title"), *(F.col(c) for c in BODY_COLUMNS if c in posts.columns))


def with_features(df: DataFrame, text: Column, model: RiskModel = DEFAULT_MODEL) -> DataFrame:
    """Adds the hit columns, ``risk_features``, ``risk_score`` and ``risk_label``.

    A chain of projections, no shuffle. Each regular expression runs once per
    row: what is used more than once is named in an earlier projection.
    """
    df = df.withColumn("_text", text)
    df = df.withColumns(
        {
            "_words": tx.words(F.col("_text")),
            "_threats": ft.threat_hits(F.col("_text"), model.threats),
            "_caps": ft.all_caps_feature(F.col("_text"), model.caps_cap),
        }
    )
    # One pass over the words finds all vocabulary; lexicons share the few hits.
    df = df.withColumns(
        {"_tokens": F.size("_words"), "_hits": ft.listed(F.col("_words"), model.vocabulary)}
    )
    df = df.withColumns(
        {
            "_violent": ft.listed(F.col("_hits"), model.violent),
            "_hate": ft.listed(F.col("_hits"), model.hate),
            "_intensifiers": F.size(ft.listed(F.col("_hits"), model.intensifiers)),
        }
    )
    n_violent, n_hate = F.size("_violent"), F.size("_hate")
    features = {
        "violent": ft.lexicon_feature(F.col("_violent"), model.lexicon_cap)[0],
        "hate": ft.lexicon_feature(F.col("_hate"), model.lexicon_cap)[0],
        "keyword_density": ft.keyword_density(
            F.col("_tokens"), n_violent, n_hate, model.density_cap
        ),
        "intensifiers": F.least(
            F.col("_intensifiers") / F.lit(model.lexicon_cap), F.lit(1.0)
        ),
        "threat": ft.threat_feature(F.col("_threats")),
        "all_caps": F.col("_caps"),
    }
    df = df.withColumn("risk_features", ft.feature_record(features))
    named = {name: F.col("risk_features")[name] for name in features}
    df = df.withColumn("risk_score", ft.combine(named, model.weights))
    return df.withColumn("risk_label", ft.label(F.col("risk_score"), model.high, model.medium))


def score_posts(
    posts: DataFrame, model: RiskModel = DEFAULT_MODEL, language: Column | None = None
) -> DataFrame:
    """Posts with language, score, label, explanation and features.

    ``language`` is computed from the ``_text`` column, see
    :func:`riskloom.operators.language.detector`; without one it is "unknown".
    Keeps all input columns, so a scored record is its post's own row. Posts with
    ``post_id`` get it as ``id`` where that is missing or empty (P16).
    """
    if "post_id" in posts.columns:
        own = [F.col("id")] if "id" in posts.columns else []
        posts = posts.withColumn("id", post_id(*own, F.col("post_id"))).drop("post_id")
    df = with_features(posts, post_text(posts), model)
    df = df.withColumn("language", F.lit("unknown") if language is None else language)
    explanation = ft.post_explanation(
        F.col("language"),
        F.col("risk_score"),
        F.col("risk_label"),
        F.col("_violent"),
        F.col("_hate"),
        F.col("_intensifiers"),
        F.col("_threats"),
        F.col("risk_features.all_caps"),
        F.col("risk_features.keyword_density"),
    )
    df = df.withColumn("risk_explanation", explanation)
    return df.select(*(c for c in df.columns if not c.startswith("_")))


def scored_records(
    posts: DataFrame, model: RiskModel = DEFAULT_MODEL, language: Column | None = None
) -> DataFrame:
    """The scored-post feed: fixed columns in fixed order."""
    return score_posts(posts, model, language).select(*SCORED_POST_COLUMNS)


def items_as_posts(items: DataFrame) -> DataFrame:
    """History items in post shape: no title, no language."""
    return items.withColumns({"title": F.lit(""), "language": F.lit(None).cast("string")})


def score_items(items: DataFrame, model: RiskModel = DEFAULT_MODEL) -> DataFrame:
    """(username, id, score) per history item.

    Language and explanation do not affect user risk and are not computed.
    """
    posts = items_as_posts(items)
    scored = with_features(posts, post_text(posts), model)
    return scored.select("username", "id", F.col("risk_score").alias("score"))


def lexicon_counts(
    df: DataFrame,
    key: str,
    text: str,
    lexicon: DataFrame,
    broadcast_terms: int = BROADCAST_TERMS,
) -> DataFrame:
    """(key, count, terms) of words in ``lexicon(term)`` for every text (P4, many terms).

    For vocabularies too large for an expression. One of at most
    ``broadcast_terms`` terms (counted first) is broadcast, and words outside
    it are gone before the first shuffle. Beyond that, words are counted per
    text and joined by term. Texts without a hit have count 0; ``key`` is unique.
    """
    terms = lexicon.select("term").dropna().distinct()
    words = df.select(key, F.explode(tx.tokens(F.col(text))).alias("term"))
    if few(terms, broadcast_terms):
        hits = words.join(F.broadcast(terms), "term", "left_semi").withColumn("n", F.lit(1))
    else:
        counted = words.groupBy(key, "term").agg(F.count("*").alias("n"))
        hits = counted.join(terms, "term", "left_semi")
    found = hits.groupBy(key).agg(
        F.sum("n").alias("count"), F.sort_array(F.collect_set("term")).alias("terms")
    )
    return df.select(key).join(found, key, "left").select(
        key,
        F.coalesce("count", F.lit(0)).alias("count"),
        F.coalesce("terms", F.array().cast("array<string>")).alias("terms"),
    )
