"""Exact largest inner products with norm-bucketed pruning.

Vectors of integers are grouped by length into buckets whose lengths differ by
a factor of ``RATIO`` at most, and each bucket into blocks of bounded size. A
first round scores every query against one block of each of the longest buckets
that together hold more than k vectors, which bounds its k-th best score from below. The bound prunes the second round:

* a bucket whose longest vector can't reach the bound is not visited;
* in a visited block, the bound over the two lengths is a local cosine
  threshold. Where it is low, vectors too short to reach the bound are left
  out (length pruning); where it is high, each of the query's largest
  coordinates confines the same coordinate of a unit vector to an interval
  (coordinate pruning), and vectors outside any of them are left out;
* what is left is verified by its exact product.

Queries visit blocks in batches: a task holds one block of vectors and one
batch of queries, however many there are of either.

Null vectors, vectors with null or non-finite components, and rows with a null
id take no part. Components are 64-bit integers; products that could pass 64 bits
are summed as Python integers. A scaled component or a product of a block's best
that does pass them is an error, never a wrong number. Empty vectors
score 0 with each other; vectors of different dimensions are never compared.
Ties go to the smaller id. Rows that share an id are never each other's
answers, and an id that occurs more than once may be answered once per row.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.sources.staging import staged

BLOCK_ROWS = 512
QUERY_ROWS = 128
RATIO = 0.9
# Coordinates of a query that confine its partners.
FOCUS = 6
# Local cosine threshold from which coordinates prune better than length.
COORDINATE_FROM = 0.15
# What components and products stay below.
LIMIT = 1 << 63


def scaled(vector: str, factor: float) -> Column:
    """floor(factor * component) as array<long>.

    Null, so that the vector takes no part, if a component is null, not finite, or does
    not fit 64 bits once scaled; other vectors are not touched by that.
    """
    value = lambda x: F.lit(factor) * x.cast("double")
    usable = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(value(x)) < float(LIMIT))
    )
    return F.when(usable, F.transform(vector, lambda x: F.floor(value(x)))).cast("array<long>")


def _products(x: np.ndarray, q: np.ndarray, largest: np.ndarray) -> np.ndarray:
    """Exact products; Python integers if any may pass 64 bits, going by ``largest``."""
    # Sums modulo 2**64 are exact where the product itself fits.
    scores = x @ q
    wide = largest >= LIMIT * (1 - 1e-9)
    if wide.any():
        scores = scores.astype(object)
        scores[wide] = x[wide].astype(object) @ q.astype(object)
    return scores


def _answers(k: int, focus: int):
    def run(queries: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        if not len(queries) or not len(items):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in columns})
        items = items.sort_values(["length", "vec_id"], ascending=[False, True])
        x = np.stack(items["vec"].to_numpy()).astype(np.int64).reshape(len(items), -1)
        ids, lengths = items["vec_id"].to_numpy(np.int64), items["length"].to_numpy(float)
        unit = x / np.maximum(lengths, 1e-300)[:, None]
        out = []
        for id_, vec, length, bound in queries[["query_id", "vec", "length", "bound"]].itertuples(
            index=False
        ):
            q = np.asarray(vec, np.int64)
            near = _candidates(q, float(length), float(bound), unit, lengths, focus)
            near = near[ids[near] != id_]
            scores = _products(x[near], q, float(length) * lengths[near])
            # The bound is a rounded score, so scores are rounded likewise.
            reach = scores.astype(float) >= bound
            near, scores = near[reach], scores[reach]
            if scores.dtype == object:
                best = sorted(range(len(near)), key=lambda i: (-scores[i], ids[near[i]]))[:k]
                if any(not -LIMIT <= scores[i] < LIMIT for i in best):
                    raise OverflowError(f"a product of query {id_} passes 64 bits")
                best = np.array(best, np.int64)
            else:
                best = np.lexsort((ids[near], -scores))[:k]
            out.append((np.full(len(best), id_), ids[near[best]], scores[best].astype(np.int64)))
        return pd.DataFrame({c: np.concatenate(v) for c, v in zip(columns, zip(*out))})

    return run


def _candidates(
    q: np.ndarray, length: float, bound: float, unit: np.ndarray, lengths: np.ndarray, focus: int
) -> np.ndarray:
    """Positions of vectors (longest first) that may have a product of ``bound`` or more."""
    every = np.arange(len(lengths))
    if not math.isfinite(bound) or length == 0 or lengths[0] == 0 or bound <= 0:
        return every
    slack = 1e-9
    local = bound / (length * lengths[0])
    if local > 1 + slack:
        return every[:0]
    if local < COORDINATE_FROM:
        return every[: np.searchsorted(-lengths, -bound / length * (1 - slack), side="right")]
    local = min(local, 1.0)
    a = q / length
    at = np.argsort(-np.abs(a), kind="stable")[:focus]
    a = np.clip(a[at], -1, 1)
    spread = np.sqrt((1 - local * local) * (1 - a * a))
    low = np.where(a < -local, -1.0, a * local - spread) - slack
    high = np.where(a > local, 1.0, a * local + spread) + slack
    inside = (unit[:, at] >= low) & (unit[:, at] <= high)
    return np.flatnonzero(inside.all(axis=1))


def top_products(
    queries: DataFrame,
    items: DataFrame,
    k: int = 5,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
    focus: int = FOCUS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` items of largest product per query.

    ``queries(query_id long, vec array<long>)``, ``items(vec_id long, vec array<long>)``.
    """
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    step = math.log(1 / RATIO)
    bucket = F.when(F.col("length") > 0, F.floor(F.log("length") / step)).otherwise(-1)
    items = staged(
        items.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull())
        .withColumn("length", length)
        .withColumn("bucket", bucket.cast("int"))
        .withColumn("dim", F.size("vec")),
        "items",
    )
    # One row per dimension and length class: 64-bit integers have some 500 classes.
    sizes = staged(
        items.groupBy("dim", "bucket").agg(
            F.count("*").alias("rows"), F.max("length").alias("longest")
        ),
        "sizes",
    ).withColumn("blocks", F.ceil(F.col("rows") / block_rows).cast("int"))
    placed = items.join(sizes.select("dim", "bucket", "blocks"), ["dim", "bucket"]).withColumn(
        "block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int")
    )
    total = queries.where(F.col("query_id").isNotNull() & F.col("vec").isNotNull())
    total = staged(
        total.withColumn("length", length).withColumn("dim", F.size("vec")), "queries"
    )
    batches = max(1, -(-total.count() // query_rows))
    total = total.withColumn("batch", F.pmod(F.xxhash64("query_id"), F.lit(batches)).cast("int"))

    longer = Window.partitionBy("dim").orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    longest = sizes.withColumn("longer", F.coalesce(F.sum("rows").over(longer), F.lit(0)))
    # The query itself may be one of them.
    seeds = (
        total.join(longest.where(F.col("longer") < k + 1), "dim")
        .withColumn("block", F.pmod(F.xxhash64("query_id", F.lit(1)), "blocks").cast("int"))
        .withColumn("bound", F.lit(float("-inf")))
    )
    first = _visited(seeds, placed, k, focus)
    bounds = first.groupBy("query_id").agg(
        F.get(F.sort_array(F.collect_list("score"), False), F.lit(k - 1)).cast("double").alias("bound")
    )
    bounded = total.join(staged(bounds, "bounds"), "query_id", "left").withColumn(
        "bound", F.coalesce("bound", F.lit(float("-inf")))
    )
    reached = (F.col("bound") <= 0) | (
        F.col("bound") <= F.col("length") * F.col("longest") * (1 + 1e-9)
    )
    visits = (
        bounded.join(sizes, "dim")
        .where(reached)
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    found = _visited(visits, placed, k, focus)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _visited(visits: DataFrame, placed: DataFrame, k: int, focus: int) -> DataFrame:
    """Best answers of each block for each query that visits it."""
    key = ["dim", "bucket", "block", "batch"]
    visits = visits.select(*key, "query_id", "vec", "length", "bound")
    batches = visits.select(*key[:3], F.col("batch").alias("part")).distinct()
    held = placed.join(batches, key[:3]).select(
        *key[:3], F.col("part").alias("batch"), "vec_id", "vec", "length"
    )
    return (
        visits.groupBy(*key)
        .cogroup(held.groupBy(*key))
        .applyInPandas(_answers(k, focus), "query_id long, vec_id long, score long")
    )
