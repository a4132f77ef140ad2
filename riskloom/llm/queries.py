"""Queries ``opN_*`` over the test tables, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import (
    fill_in_middle,
    fingerprints,
    labelled,
    line_dedup,
    minhash_dedup,
    mixing,
    quality_gam,
    sentencepiece_tokens,
    substring_dedup,
    token_counts,
    top_products,
    toxicity,
    url_filter,
    word_buckets,
)
from riskloom.llm.words import word_count
from riskloom.sources.staging import staged

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


MINHASH_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
  FROM words),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
best AS (SELECT x, min(y) AS c FROM reach GROUP BY x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c AS component_id, doc_id = c AS kept
FROM sets JOIN best ON best.x = sets.doc_id
"""


@query("op7_minhash_near_dedup", MINHASH_SQL)
def op7(spark: SparkSession, sf: str) -> DataFrame:
    """One row per document with its near-duplicate component."""
    return minhash_dedup.near_duplicates(table(spark, sf, "documents"))


SUBSTRING_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM words WHERE len(w) >= 13),
keyed AS (SELECT doc_id, i, array_to_string(w[i:i+12], ' ') AS k FROM windows),
covered AS (
  SELECT doc_id, unnest(range(i, i + 13)) AS place
  FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS first FROM keyed)
  WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, place FROM covered),
places AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS place, unnest(w) AS word FROM words WHERE len(w) > 0),
kept AS (
  SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.place) AS t, count(*) AS n
  FROM places p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.place = g.place GROUP BY p.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""


@query("op8_substring_dedup", SUBSTRING_SQL)
def op8(spark: SparkSession, sf: str) -> DataFrame:
    """Per document, how many words repeat a passage of an earlier one, and a digest of the rest."""
    docs = table(spark, sf, "documents")
    left = substring_dedup.without_repeats(docs, substring_dedup.repeated_spans(docs))
    return left.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


TOP_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum([q.e[i] * c.e[i] FOR i IN range(1, len(q.e) + 1)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op1_top_products", TOP_SQL)
def op1(spark: SparkSession, sf: str) -> DataFrame:
    """The five largest integer products for every fiftieth vector."""
    vectors = table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("long"), top_products.scaled("embedding", 256.0).alias("vec")
    )
    asked = vectors.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    return top_products.top_products(asked, vectors, k=5)


@query("op9_mix_sources")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    """Words taken of each document in a mix of sources by weight."""
    sized = staged(
        table(spark, sf, "documents").select("doc_id", "source", word_count("text").alias("size")),
        "sized",
    )
    return mixing.with_copies(sized).select(
        "doc_id",
        "size",
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_copies") * F.col("size")).alias("taken"),
    )


def judged(docs: DataFrame, score: Column, folds: int, held: int) -> DataFrame:
    """(doc_id, held_out, score, predicted)."""
    held_out = F.coalesce(labelled.fold("doc_id", folds) == held, F.lit(False))
    return docs.select("doc_id", held_out.alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.3).cast("int")
    )


@query("op10_quality_classifier")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    """Quality of every document, learned from labels outside the held-out fold."""
    docs = table(spark, sf, "documents")
    model = quality_gam.train(docs, table(spark, sf, "labels"), labelled.fold("doc_id", 5) != 0)
    return judged(docs, model.column("text"), 5, 0)


@query("op3_toxicity")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity of every document, learned from labels outside the held-out fold."""
    docs = table(spark, sf, "documents")
    model = toxicity.train(docs, table(spark, sf, "labels"), labelled.fold("doc_id", 4) != 2)
    return judged(docs, model.column("text"), 4, 2)


@query("op5_fingerprints")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints.against_edited(table(spark, sf, "documents"))


LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
hashed AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i FROM lines),
rolled AS (
  SELECT *, (u + 31 * coalesce(lag(u) OVER w, 0)) % 4294967291 AS r, count(*) OVER (PARTITION BY doc_id) AS n
  FROM (SELECT *, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS u FROM hashed)
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
cuts AS (
  SELECT *, i > 2 AND i < n AND r < lag(r) OVER w AND r <= lead(r) OVER w AS cut FROM rolled
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
stretches AS (
  SELECT *, greatest(1, max(CASE WHEN cut THEN i END) OVER (PARTITION BY doc_id ORDER BY i)) AS first FROM cuts),
numbered AS (
  SELECT doc_id, i, line, struct_pack(f := coalesce(first, 1), k := greatest(0, least((i - coalesce(first, 1)) // 16,
    (count(*) OVER (PARTITION BY doc_id, first) - 2) // 16))) AS chunk
  FROM stretches),
chunks AS (
  SELECT doc_id, chunk, string_agg(line, chr(10) ORDER BY i) AS t, count(*) AS n
  FROM numbered GROUP BY doc_id, chunk),
placed AS (
  SELECT *, n > 1 AND row_number() OVER (PARTITION BY t, n > 1 ORDER BY doc_id, chunk) > 1 AS gone FROM chunks)
SELECT d.doc_id, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_lines,
  CAST(coalesce(sum(n) FILTER (gone), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(string_agg(t, chr(10) ORDER BY chunk) FILTER (NOT gone), '')) AS kept_sha256
FROM documents d LEFT JOIN placed p ON p.doc_id = d.doc_id GROUP BY d.doc_id
"""


@query("op2_line_dedup", LINES_SQL)
def op2(spark: SparkSession, sf: str) -> DataFrame:
    """Per document, how many lines lie in repeated chunks, and a digest of the rest."""
    cut = line_dedup.without_repeated_chunks(table(spark, sf, "documents"))
    return cut.select(
        "doc_id",
        F.col("_kept.lines").alias("n_lines"),
        F.col("_kept.removed").alias("n_removed"),
        F.sha2(F.coalesce(F.col("_kept.text"), F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


@query("op4_sentencepiece")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of every document, whether they decode to its text and are the library's."""
    found = sentencepiece_tokens.with_tokens(table(spark, sf, "documents"))
    ids = F.col("_tokens.ids")
    return found.select(
        "doc_id",
        F.coalesce(F.size(ids), F.lit(0)).alias("n_tokens"),
        F.xxhash64(ids).alias("ids_hash"),
        (F.col("_tokens.decoded") == F.col("text")).alias("round_trip"),
        F.col("_tokens.parity").alias("parity"),
    )


@query("op6_url_filter")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    """Verdict on the url of every page."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    return url_filter.judged(pages).select(
        "page_id",
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule.rule").alias("rule"),
        F.col("_verdict").alias("verdict"),
    )


TOKEN_LIMIT = 4096


@query("op11_token_counts")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes and tokens of every document, and whether the tokens pass the limit."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    counts = token_counts.token_counts(table(spark, sf, "documents"), path)
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


RESAMPLED_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT CAST(i AS BIGINT) AS i, CAST(i AS BIGINT) AS v, 0 AS k FROM range(256) AS r(i)
  UNION ALL
  SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
crcs AS (SELECT list(v ORDER BY i) AS crc FROM bits WHERE k = 8),
docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
words AS (
  SELECT r, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM docs),
aimed AS (
  SELECT unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
known AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM words UNION SELECT w FROM aimed)),
hashed AS (
  SELECT w, xor(list_reduce(
      [CAST('0x' || h[2 * i + 1:2 * i + 2] AS BIGINT) FOR i IN range(length(h) // 2)],
      lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8), CAST(4294967295 AS BIGINT)),
    4294967295) % 10000 AS bucket
  FROM known, crcs),
features AS (SELECT r, bucket FROM words JOIN hashed USING (w)),
source AS (SELECT bucket, count(*) AS n FROM features GROUP BY bucket),
target AS (SELECT bucket, count(*) AS n FROM aimed JOIN hashed USING (w) GROUP BY bucket),
sums AS (
  SELECT (SELECT CAST(count(*) AS DOUBLE) FROM words) AS all_s,
    (SELECT CAST(count(*) AS DOUBLE) FROM aimed) AS all_t),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(
    ((coalesce(target.n, 0) + 1) * (all_s + 10000)) / ((source.n + 1) * (all_t + 10000)))) AS BIGINT) AS gain
  FROM source LEFT JOIN target USING (bucket), sums),
weights AS (
  SELECT r, count(*) AS n, sum(gain) AS w FROM features JOIN gains USING (bucket) GROUP BY r),
scored AS (
  SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(w, 0) AS BIGINT) AS weight,
    CAST(coalesce(w, 0) + floor(-1000 * ln(-ln((CAST(CAST('0x' || substr(sha256(
      '2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS DOUBLE) + 0.5)
      / 4294967296.0))) AS BIGINT) AS score
  FROM docs LEFT JOIN weights USING (r)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) OVER (PARTITION BY n_features >= 20) AS n
  FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank
FROM placed
"""


@query("op12_importance_resampling", RESAMPLED_SQL)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    """Documents drawn to look like the benchmark texts: weight, score and rank of each."""
    return word_buckets.resampled(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


MIDDLE_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
drawn AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n,
    CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS a,
    CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
        OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
      WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM cut),
parts AS (
  SELECT doc_id, text, n, form,
    array_to_string(u[1:least(a, b)], '') AS p,
    array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
    array_to_string(u[greatest(a, b) + 1:n], '') AS s
  FROM drawn)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""


@query("op13_fill_in_middle", MIDDLE_SQL)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of every document's transformed text and of the text restored from that."""
    made = fill_in_middle.transformed(table(spark, sf, "documents"))
    back = fill_in_middle.restored("output", "form").sha256.alias("restored_sha256")
    columns = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256")
    return made.select(*columns, back)
