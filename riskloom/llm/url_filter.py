"""URL filtering by rules and by gradient-boosted trees on lexical features.

A rule names a host and a path. It fits its host and all subdomains, if the
url's path starts with the rule's; of several, the longest wins. Urls that a rule
fits are labelled by it, and from them boosted trees learn to judge the others by
what their text looks like: length, depth, shares of digits and other characters,
entropy of the host, parameters, and how often urls with the same last label of
the host or the same first folder were blocked among the labelled ones.

Everything runs on DataFrame functions and Spark's own boosted trees. At most
``TRAINING_ROWS`` labelled urls are used for training, those with the least hash
of the url; suffix statistics count all of them. Without labelled urls of both
kinds, urls without a rule are blocked only if all labelled ones are.

Null urls and urls without ``://`` have an empty host and path, no rule, and are
judged by the method like others. Rows of one url get one verdict. Other columns
pass through.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.tables import few_or_shuffled, packed, unpacked
from riskloom.sources.staging import staged

# Rules given with the task: (verdict, host, path), the host without a path for all its paths.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
TRAINING_ROWS = 20_000
TREES, DEPTH, BINS, SEED = 20, 4, 64, 7
SMOOTHING = 4.0


def parts(url: str) -> tuple[Column, Column]:
    """(host, path) of a url column, empty where it is null or has no ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(
        F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1),
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        "abcdefghijklmnopqrstuvwxyz",
    )
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits ``_host`` and ``_path``, else null.

    Rules are written ``host/path``; the length is that of the whole.
    """
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    chosen = None
    for verdict, host, path in ordered:
        fits = ((F.col("_host") == host) | F.col("_host").endswith(f".{host}")) & F.col(
            "_path"
        ).startswith(path)
        found = F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, found) if chosen is None else chosen.when(fits, found)
    return chosen


def lexical(url: str = "_url") -> dict[str, Column]:
    """Features of the url's own text."""
    length = F.length(url)
    share = lambda pattern: F.regexp_count(url, F.lit(pattern)) / F.greatest(length, F.lit(1))
    letters = F.filter(F.split("_host", ""), lambda c: c != "")
    size = F.greatest(F.size(letters), F.lit(1)).cast("double")
    # Runs of equal letters in order: one pass, whatever the number of different ones.
    term = lambda run: run * F.log2(F.greatest(run, F.lit(1.0)))

    def count(s: Column, c: Column) -> Column:
        longer = F.struct(c.alias("last"), (s["run"] + 1).alias("run"), s["sum"].alias("sum"))
        other = F.struct(
            c.alias("last"), F.lit(1.0).alias("run"), (s["sum"] + term(s["run"])).alias("sum")
        )
        return F.when(s["last"] == c, longer).otherwise(other)

    none = F.struct(F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"))
    entropy = F.log2(size) - F.aggregate(
        F.array_sort(letters), none, count, lambda s: (s["sum"] + term(s["run"])) / size
    )
    return {
        "length": length,
        "host_length": F.length("_host"),
        "path_length": F.length("_path"),
        "labels": F.size(F.split("_host", r"\.")),
        "depth": F.regexp_count("_path", F.lit("/[^/]")),
        "digits": share("[0-9]"),
        "hyphens": F.regexp_count("_host", F.lit("-")),
        "marks": share("[^A-Za-z0-9]"),
        "entropy": entropy,
        "parameters": F.regexp_count(url, F.lit("[?&][^=&#]+=")),
        "fragment": F.contains(F.col(url), F.lit("#")).cast("int"),
        "secure": F.col(url).startswith("https").cast("int"),
        "page": F.col("_path").rlike(r"\.[a-z]+$").cast("int"),
    }


def _statistic(labelled: DataFrame, column: str) -> DataFrame:
    """(value, urls, blocked urls) of every value."""
    blocked = F.count_if(F.col("_rule.verdict") == "block")
    return labelled.groupBy(column).agg(
        F.count("*").alias(f"{column}_urls"), blocked.alias(f"{column}_blocked")
    )


def _others_blocked(column: str, prior: float) -> Column:
    """Smoothed share of blocked urls among the others with the value."""
    own = F.coalesce(F.col("_rule").isNotNull().cast("int"), F.lit(0))
    own_blocked = F.coalesce((F.col("_rule.verdict") == "block").cast("int"), F.lit(0))
    blocked = F.coalesce(f"{column}_blocked", F.lit(0)) - own_blocked
    urls = F.coalesce(f"{column}_urls", F.lit(0)) - own
    return (blocked + SMOOTHING * prior) / (urls + SMOOTHING)


def judged(
    pages: DataFrame, url_col: str = "url", rules=RULES, training_rows: int = TRAINING_ROWS
) -> DataFrame:
    """``pages`` with ``_host``, ``_path``, ``_rule`` (null without one), ``_verdict``, ``_blocked``.

    ``_blocked`` is the method's score for urls without a rule. Columns of these names are
    replaced, others pass through.
    """
    host, path = parts("_url")
    rows = (
        packed(pages, _url=F.coalesce(F.col(url_col), F.lit("")))
        .withColumn("_host", host)
        .withColumn("_path", path)
        .withColumn("_rule", rule_of(rules))
        .withColumn("_suffix", F.substring_index("_host", ".", -1))
        .withColumn("_folder", F.split_part("_path", F.lit("/"), F.lit(2)))
    )
    labelled = rows.where("_rule is not null")
    verdict = F.col("_rule.verdict")
    sizes = labelled.agg(
        F.count("*").alias("n"), F.count_if(verdict == "block").alias("blocked")
    ).first()
    if not 0 < sizes["blocked"] < sizes["n"]:
        score = F.lit(1.0 if sizes["blocked"] else 0.0)
    else:
        prior = sizes["blocked"] / sizes["n"]
        features = lexical()
        for column in ("_suffix", "_folder"):
            rows = rows.join(few_or_shuffled(_statistic(labelled, column)), column, "left")
            features[f"{column}_blocked"] = _others_blocked(column, prior)
        numbers = [c.cast("double").alias(f"_f{i}") for i, c in enumerate(features.values())]
        names = [f"_f{i}" for i in range(len(numbers))]
        assemble = VectorAssembler(inputCols=names, outputCol="_x")
        sample = (
            rows.where("_rule is not null")
            .select("_url", (verdict == "block").cast("double").alias("_y"), *numbers)
            .orderBy(F.xxhash64("_url"), "_url")
            .limit(training_rows)
        )
        trees = GBTClassifier(
            featuresCol="_x",
            labelCol="_y",
            maxIter=TREES,
            maxDepth=DEPTH,
            maxBins=BINS,
            seed=SEED,
            stepSize=0.3,
            predictionCol="_said",
        )
        trees = trees.setProbabilityCol("_p").setRawPredictionCol("_raw")
        trees = trees.fit(assemble.transform(staged(sample, "training")).select("_x", "_y"))
        rows = trees.transform(assemble.transform(rows.select("*", *numbers)))
        score = vector_to_array("_p")[1]
    rows = rows.withColumn("_blocked", score)
    rows = rows.withColumn(
        "_verdict",
        F.coalesce(verdict, F.when(F.col("_blocked") >= 0.5, "block").otherwise("allow")),
    )
    return unpacked(rows, pages.columns, "_host", "_path", "_rule", "_verdict", "_blocked")
