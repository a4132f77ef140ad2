"""Text features, post scoring, language, post reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import sql, tables
from bindings.registry import query
from riskloom.functions import features as ft
from riskloom.functions import normalize as nz
from riskloom.functions import text as tx
from riskloom.model import FEATURES
from riskloom.operators import language, posts, report, select
from riskloom.plans import jobs
from riskloom.sources.staging import fresh_path

DOC_TEXT = f"""WITH {sql.POSTS}, t AS (
  SELECT *, {sql.strip("title || chr(10) || text")} AS full_text FROM posts)"""


def documents_text(spark, sf):
    return tables.posts(spark, sf).withColumn(
        "full_text", tx.scoring_text(F.col("title"), F.col("text"))
    )


@query(
    "p1_scoring_text",
    f"""WITH {sql.POSTS}, v AS (
      SELECT id, CASE WHEN length(id) % 2 = 0 THEN title ELSE '' END AS title,
        CASE WHEN doc_id % 3 = 0 THEN ' ' || chr(9) ELSE text END AS text,
        CASE WHEN doc_id % 3 = 0 THEN chr(10) || text || chr(160) END AS body
      FROM posts JOIN documents USING (text) WHERE id = CAST(doc_id AS VARCHAR))
    SELECT id, {sql.strip("title || chr(10) || CASE WHEN " + sql.strip("text") + " <> '' THEN text ELSE coalesce(body, '') END")} AS full_text
    FROM v""",
)
def scoring_text(spark, sf):
    number = F.col("id").cast("long")
    blank = number % 3 == 0
    df = tables.posts(spark, sf).select(
        "id",
        F.when(F.length("id") % 2 == 0, F.col("title")).otherwise("").alias("title"),
        F.when(blank, F.lit(" \t")).otherwise(F.col("text")).alias("text"),
        F.when(blank, F.concat(F.lit("\n"), "text", F.lit("\xa0"))).alias("body"),
    )
    return df.select("id", posts.post_text(df).alias("full_text"))


PROFILES_SQL = f"""WITH t AS (SELECT lang, list_transform(regexp_extract_all(lower(text), '(?s).'), lambda c: unicode(c)) AS cp
      FROM documents),
    g AS (SELECT lang, unnest(list_transform(range(1, len(cp) - 1),
      lambda i: (cp[i] * 961 + cp[i + 1] * 31 + cp[i + 2]) % {language.BUCKETS})) AS bucket FROM t),
    n AS (SELECT lang, bucket, count(*) AS n FROM g GROUP BY ALL),
    s AS (SELECT lang, sum(n) AS total FROM n GROUP BY lang)
    SELECT lang, bucket, CAST(round(1000 * ln((n + 1)::DOUBLE / (total + {language.BUCKETS}))) AS BIGINT) AS weight
    FROM n JOIN s USING (lang)
    UNION ALL
    SELECT lang, -1, CAST(round(1000 * ln(1::DOUBLE / (total + {language.BUCKETS}))) AS BIGINT) FROM s"""


@query("p2a_language_profiles", PROFILES_SQL)
def language_profiles(spark, sf):
    return language.train_language_profiles(tables.read(spark, sf, "documents"))


@query("p2a_profiles_of_deliveries", PROFILES_SQL)
def profiles_of_deliveries(spark, sf):
    """Three deliveries of labelled texts counted one after the other, the last of them twice."""
    store = jobs.profile_store(spark, fresh_path(spark, "p2a"))
    texts = tables.read(spark, sf, "documents")
    for number in (0, 1, 2, 2):
        part = texts.where(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == number)
        jobs.add_to_profiles_job(store, part, number)
    return jobs.stored_profiles(store)


DETECTED = f"""lt AS (SELECT doc_id, text, list_transform(regexp_extract_all(lower(text), '(?s).'), lambda c: unicode(c)) AS cp
      FROM documents),
    lg AS (SELECT doc_id, unnest(list_transform(range(1, len(cp) - 1),
      lambda i: (cp[i] * 961 + cp[i + 1] * 31 + cp[i + 2]) % {language.BUCKETS})) AS bucket FROM lt),
    dn AS (SELECT doc_id, bucket, count(*) AS n FROM lg GROUP BY ALL),
    ln AS (SELECT lang, bucket, sum(n) AS n FROM dn JOIN documents USING (doc_id) GROUP BY ALL),
    lall AS (SELECT lang, sum(n) AS total FROM ln GROUP BY lang),
    lw AS (SELECT lang, b.bucket, CAST(round(1000 * ln((coalesce(n, 0) + 1)::DOUBLE / (total + {language.BUCKETS}))) AS BIGINT) AS weight
      FROM lall CROSS JOIN (SELECT DISTINCT bucket FROM ln) b LEFT JOIN ln USING (lang, bucket)),
    ls AS (SELECT doc_id, lang, sum(n * weight) AS s FROM dn JOIN lw USING (bucket) GROUP BY ALL),
    lb AS (SELECT doc_id, lang FROM ls QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, lang) = 1)"""


@query(
    "p2b_detect_language",
    f"""WITH {DETECTED}
    SELECT doc_id, CASE WHEN length(text) < 20 THEN 'unknown' ELSE lb.lang END AS language
    FROM documents LEFT JOIN lb USING (doc_id)""",
)
def detect_language(spark, sf):
    docs = tables.read(spark, sf, "documents")
    profiles = language.train_language_profiles(docs)
    return language.detect_language(docs, profiles).select("doc_id", "language")


@query(
    "p3_tokens",
    f"""{DOC_TEXT}, k AS (SELECT id, unnest({sql.tokens('full_text')}) AS token FROM t)
    SELECT token, count(*) AS uses, count(DISTINCT id) AS posts FROM k GROUP BY token""",
)
def tokens(spark, sf):
    """Token frequencies; a token is counted per post before the shuffle by token."""
    words = documents_text(spark, sf).select("id", F.explode(tx.tokens(F.col("full_text"))).alias("token"))
    per_post = words.groupBy("token", "id").agg(F.count("*").alias("n"))
    return per_post.groupBy("token").agg(F.sum("n").alias("uses"), F.count("*").alias("posts"))


def lexicon_query(key: str, lexicon: str, model_name: str) -> None:
    model = tables.MODELS[model_name]
    terms = getattr(model, lexicon)

    @query(
        f"{key}_{lexicon}_{model_name}",
        f"""{DOC_TEXT}, h AS (SELECT id, {sql.hits(terms, sql.tokens('full_text'))} AS hs FROM t)
        SELECT id, least(len(hs) / 3e0, 1e0) AS feature, len(hs) AS hit_count,
          array_to_string(list_sort(list_distinct(hs)), ' ') AS terms FROM h""",
    )
    def run(spark, sf):
        df = documents_text(spark, sf).withColumn(
            "_hits", ft.lexicon_hits(F.col("full_text"), terms)
        )
        feature, count, found = ft.lexicon_feature(F.col("_hits"), model.lexicon_cap)
        return df.select(
            "id",
            feature.alias("feature"),
            count.cast("long").alias("hit_count"),
            F.array_join(found, " ").alias("terms"),
        )


for _model in tables.MODELS:
    lexicon_query("p4", "violent", _model)
    lexicon_query("p5", "hate", _model)
    lexicon_query("p6", "intensifiers", _model)


@query(
    "p4_large_lexicon",
    f"""{DOC_TEXT}, lex AS (SELECT DISTINCT lower(r) AS term FROM (
        SELECT unnest(regexp_extract_all(p_name, '{sql.WORD}+')) AS r FROM part
        UNION ALL SELECT unnest(regexp_extract_all(text, '{sql.WORD}+')) FROM benchmark)),
    k AS (SELECT id, unnest({sql.tokens('full_text')}) AS term FROM t),
    f AS (SELECT id, count(*) AS n, array_to_string(list_sort(list_distinct(list(term))), ' ') AS terms
      FROM k JOIN lex USING (term) GROUP BY id)
    SELECT id, coalesce(n, 0) AS hit_count, coalesce(terms, '') AS terms FROM t LEFT JOIN f USING (id)""",
)
def large_lexicon(spark, sf):
    """A vocabulary taken from tables: words of part names and benchmark items."""
    names = tables.read(spark, sf, "part").select(F.col("p_name").alias("text"))
    texts = names.unionByName(tables.read(spark, sf, "benchmark").select("text"))
    lexicon = texts.select(F.explode(tx.tokens(F.col("text"))).alias("term"))
    counts = posts.lexicon_counts(documents_text(spark, sf), "id", "full_text", lexicon)
    return counts.select(
        "id", F.col("count").alias("hit_count"), F.array_join("terms", " ").alias("terms")
    )


def scored_query(
    name: str, select_sql: str, columns: list[str], model_name: str = "calibrated"
) -> None:
    model = tables.MODELS[model_name]
    text = f"WITH {sql.POSTS}, {sql.scored('posts', model)} SELECT {select_sql} FROM scored"

    @query(name, text)
    def run(spark, sf):
        df = tables.posts(spark, sf)
        return posts.with_features(df, posts.post_text(df), model).selectExpr(*columns)


scored_query(
    "p7_keyword_density",
    "id, len(toks) AS tokens, keyword_density",
    ["id", "cast(_tokens as long) as tokens", "risk_features.keyword_density"],
)
for _model in tables.MODELS:
    scored_query(
        f"p8_threats_{_model}",
        "id, threat, len(th) AS hit_count, array_to_string(th, '|') AS hits",
        [
            "id",
            "risk_features.threat",
            "cast(size(_threats) as long) as hit_count",
            "array_join(_threats, '|') as hits",
        ],
        _model,
    )
scored_query("p9_all_caps", "id, all_caps", ["id", "risk_features.all_caps"])
scored_query("p10_combined_score", "id, risk_score", ["id", "risk_score"])
scored_query("p11_labels", "id, risk_label", ["id", "risk_label"])
scored_query("p12_feature_record", f"id, {', '.join(FEATURES)}", ["id", "risk_features.*"])


def full_scoring_query(name: str, select_sql: str, columns: list, model_name: str) -> None:
    model = tables.MODELS[model_name]

    @query(name, f"WITH {sql.POSTS}, {sql.scored('posts', model)} SELECT {select_sql} FROM scored")
    def run(spark, sf):
        return posts.score_posts(tables.posts(spark, sf), model).select(*columns)


for _model in tables.MODELS:
    full_scoring_query(
        f"p13_explanation_{_model}",
        f"id, {sql.post_explanation()} AS risk_explanation",
        ["id", "risk_explanation"],
        _model,
    )
    full_scoring_query(
        f"p14_score_posts_{_model}",
        f"id, author, risk_score, risk_label, {', '.join(FEATURES)}, "
        f"{sql.post_explanation()} AS risk_explanation",
        ["id", "author", "risk_score", "risk_label", "risk_features.*", "risk_explanation"],
        _model,
    )


@query(
    "p15_scored_records",
    f"""WITH {sql.POSTS}, {sql.scored('posts', tables.CALIBRATED)}
    SELECT id, url, subreddit, author, title, text, created_utc, 'unknown' AS language, risk_score,
      risk_label, {sql.post_explanation()} AS risk_explanation, {', '.join(FEATURES)} FROM scored""",
)
def scored_records(spark, sf):
    records = posts.scored_records(tables.posts(spark, sf), tables.CALIBRATED)
    return records.select(
        *(c for c in records.columns if c != "risk_features"), "risk_features.*"
    )


FULL_DETECTED = DETECTED.replace(
    "FROM documents),\n    lg", "FROM (SELECT CAST(id AS BIGINT) AS doc_id, full_text AS text FROM scored)),\n    lg"
)


@query(
    "p15_scored_records_with_language",
    f"""WITH {sql.POSTS}, {sql.scored('posts', tables.CALIBRATED)}, {FULL_DETECTED},
    f AS (SELECT scored.* EXCLUDE (language),
        CASE WHEN length(full_text) < 20 THEN 'unknown' ELSE lb.lang END AS language
      FROM scored LEFT JOIN lb ON lb.doc_id = CAST(id AS BIGINT))
    SELECT id, language, risk_score, risk_label, {sql.post_explanation('language')} AS risk_explanation FROM f""",
)
def scored_records_with_language(spark, sf):
    """Profiles are trained on the scoring texts, then applied to them."""
    labelled = tables.read(spark, sf, "documents").select(
        "lang",
        tx.scoring_text(F.substring_index("text", "\n", 1), F.col("text")).alias("text"),
    )
    detect = language.detector(language.train_language_profiles(labelled))
    records = posts.scored_records(
        tables.posts(spark, sf), tables.CALIBRATED, detect(F.col("_text"))
    )
    return records.select("id", "language", "risk_score", "risk_label", "risk_explanation")


@query(
    "p16_post_id",
    """SELECT doc_id, CASE WHEN doc_id % 3 = 0 OR doc_id % 3 = 1 THEN 'alt' || doc_id
      ELSE CAST(doc_id AS VARCHAR) END AS post_id FROM documents""",
)
def post_id(spark, sf):
    number = F.col("doc_id")
    given = F.when(number % 3 == 0, F.lit(None)).when(number % 3 == 1, "").otherwise(
        number.cast("string")
    )
    docs = tables.read(spark, sf, "documents")
    return docs.select("doc_id", nz.post_id(given, tables.numbered("alt", number)).alias("post_id"))


@query(
    "l13_top_risky",
    f"""WITH {sql.POSTS}, {sql.scored('posts', tables.CALIBRATED)}
    SELECT id, risk_score, risk_label FROM scored ORDER BY risk_score DESC, id LIMIT 5""",
)
def top_risky(spark, sf):
    scored = posts.score_posts(tables.posts(spark, sf), tables.CALIBRATED)
    return select.top_risky(scored.select("id", "risk_score", "risk_label"))


for _model in tables.MODELS:

    @query(
        f"r1_label_distribution_{_model}",
        f"""WITH {sql.POSTS}, {sql.scored('posts', tables.MODELS[_model])},
        labels(label) AS (VALUES ('high'), ('medium'), ('low')),
        n AS (SELECT label, count(id) AS count FROM labels LEFT JOIN scored ON label = risk_label GROUP BY label)
        SELECT label, count, count::DOUBLE / sum(count) OVER () * 1e2 AS percent FROM n""",
    )
    def label_distribution(spark, sf, model=tables.MODELS[_model]):
        return report.label_distribution(posts.score_posts(tables.posts(spark, sf), model))
