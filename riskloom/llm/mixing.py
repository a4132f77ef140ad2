"""Mixing sources to target weights by entropy balancing.

Each source is to contribute a target number of words. Targets follow the
sources' weights and stop at ``CAP`` times what a source has; what that leaves
is shared by weight among the others (a water level, found by running sums over
ranges of the sources). Within a source, document rates r are those of maximum
entropy that meet the target,

    minimise  sum r (log r - 1)   with   sum r * size = target,  0 <= r <= CAP,

whose solution is the exponential tilt r = min(CAP, exp(t * size / mean size)).
The dual has one unknown t per source. Newton steps find it, kept inside a
proven bracket, and every fourth step halves that; every step is one aggregate over (source, size) counts, for all
sources at once. Rates become whole copies in one more pass: documents round up
in the order of a hash of their id, and per source the cut between up and down
is settled size class by size class from the largest, each passing its
remainder on, so that the error left is about the smallest document.

Sums run over exact decimals and longs, so reruns agree bit for bit. No step
groups the documents of a source in one task. Null sources are a source, ordered
last. Documents without words (null, empty, blank) are taken 0 times. Rows that
share an id are counted one by one and rounded alike. Other columns pass through
:func:`with_copies` unchanged, whatever their names, but for those that it adds, which
replace their likes.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.tables import few_or_shuffled, packed, running, unpacked
from riskloom.sources.staging import staged

WEIGHTS = (1, 2, 3)
CAP = 3
# Steps per written table; relative error at which a source is done.
STEPS, TOLERANCE = 4, 1e-9
# Cells of the rounding order within a size class.
CELLS = 2048
EXACT = "decimal(38,12)"


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP
) -> DataFrame:
    """(source, docs, source_size, least, target) from ``sized(source, size)``.

    One row per source; sources are ordered by code point, null last, and take
    the weights in turn.
    """
    totals = sized.groupBy("source").agg(
        F.count_if(F.col("size") > 0).alias("docs"),
        F.sum("size").alias("source_size"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"),
    )
    ordered = running(totals.withColumn("one", F.lit(1)), [F.asc_nulls_last("source")], "one")
    place = (F.col("before_one") % len(weights) + 1).cast("int")
    weighed = ordered.withColumns(
        {
            "weight": F.element_at(F.array(*map(F.lit, weights)), place),
            "full": F.col("source_size") * F.lit(cap),
        }
    )
    weighed = weighed.withColumn("level", F.col("full") / F.col("weight")).drop("before_one", "one")
    # Sources fill up in the order of their levels; the water stands below the first that
    # the rest does not fill.
    by_level = [F.asc("level"), F.asc_nulls_last("source")]
    filling = running(weighed, by_level, "full", "weight")
    sums = weighed.agg(F.sum("source_size").alias("all"), F.sum("weight").alias("weights"))
    water = (F.col("all") - F.col("before_full")) / (F.col("weights") - F.col("before_weight"))
    reached = (
        filling.crossJoin(F.broadcast(sums))
        .withColumn("water", water)
        .agg(F.min_by("water", F.when(F.col("water") <= F.col("level"), F.col("level"))).alias("water"))
    )
    target = F.least(F.col("full"), F.coalesce(F.col("water") * F.col("weight"), F.col("full")))
    return weighed.crossJoin(F.broadcast(reached)).select(
        "source", "docs", "source_size", "least", target.cast("double").alias("target")
    )


def _rate(tilt: Column, size: Column, mean: Column, cap: int) -> Column:
    top = math.log(cap)
    bent = F.least(tilt * size / mean, F.lit(top))
    return F.when(bent >= top, F.lit(float(cap))).otherwise(F.exp(bent))


def tilts(sized: DataFrame, targets: DataFrame, cap: int = CAP) -> DataFrame:
    """``targets`` with the tilt and mean size of each source; ``tilt`` is null for rate 0."""
    counts = staged(
        sized.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n")), "counts"
    )
    mean = F.col("source_size") / F.col("docs")
    share = F.col("target") / F.col("source_size")
    smallest = F.col("least") / mean
    more = F.col("target") >= F.col("source_size")
    full = F.col("target") >= F.col("source_size") * (cap * (1 - 1e-12))
    low = F.when(more, 0.0).otherwise(F.log(share) / smallest)
    high = F.when(more, F.lit(math.log(cap)) / smallest).otherwise(0.0)
    start = F.when(full, high).otherwise(F.greatest(low, F.least(high, F.log(share))))
    state = (
        targets.where("target > 0")
        .select("source", "target", mean.alias("mean"), low.alias("low"), high.alias("high"), start.alias("tilt"), full.alias("done"))
    )
    state = staged(state, "tilts")
    while not state.where(~F.col("done")).isEmpty():
        # The last step of a table halves the bracket, so that all are done some time.
        for step in range(STEPS):
            state = _step(counts, state, cap, newton=step < STEPS - 1)
        state = staged(state, "tilts")
    found = state.select(F.col("source").alias("_s"), "mean", "tilt")
    joined = targets.join(found, targets["source"].eqNullSafe(found["_s"]), "left")
    return joined.drop("_s")


def _step(counts: DataFrame, state: DataFrame, cap: int, newton: bool = True) -> DataFrame:
    """One safeguarded Newton step, or one that halves the bracket, for every source."""
    kept = ["target", "mean", "low", "high", "tilt", "done"]
    rows = counts.join(
        state.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))
    )
    z = F.col("size") / F.col("mean")
    rate = _rate(F.col("tilt"), F.col("size"), F.col("mean"), cap)
    first = F.col("n") * z * rate
    second = F.when(rate < cap, F.col("n") * z * z * rate).otherwise(0.0)
    sums = rows.groupBy("source", *kept).agg(
        F.sum(first.cast(EXACT)).cast("double").alias("first"),
        F.sum(second.cast(EXACT)).cast("double").alias("second"),
    )
    goal = F.col("target") / F.col("mean")
    gap = F.col("first") - goal
    narrow = F.greatest(F.lit(1.0), F.abs("low"), F.abs("high")) * 1e-14
    done = F.col("done") | (F.abs(gap) <= goal * TOLERANCE) | (F.col("high") - F.col("low") <= narrow)
    low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
    high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
    ahead = F.col("tilt") - gap / F.nullif("second", F.lit(0.0))
    inside = F.lit(newton) & (ahead > F.col("new_low")) & (ahead < F.col("new_high"))
    middle = (F.col("new_low") + F.col("new_high")) / 2
    return (
        sums.withColumn("new_low", low)
        .withColumn("new_high", high)
        .withColumn("is_done", done)
        .withColumn("next", F.when(F.col("is_done"), F.col("tilt")).when(inside, ahead).otherwise(middle))
        .select(
            "source",
            "target",
            "mean",
            F.col("new_low").alias("low"),
            F.col("new_high").alias("high"),
            F.col("next").alias("tilt"),
            F.col("is_done").alias("done"),
        )
    )


def _cuts(rows: pd.DataFrame) -> pd.DataFrame:
    """Per size class of one source, the cell before which documents round up."""
    rows = rows.sort_values(["class", "cell"], ascending=[False, True])
    carry = float(rows["carry"].iloc[0])
    out = []
    for class_, part in rows.groupby("class", sort=False):
        goal = float(part["expected"].sum()) + carry
        reached = np.concatenate([[0], part["words"].to_numpy(np.int64).cumsum()])
        best = int(np.argmin(np.abs(reached - goal)))
        carry = goal - float(reached[best])
        cells = part["cell"].to_numpy(np.int64)
        out.append((class_, CELLS if best == len(cells) else int(cells[best])))
    frame = pd.DataFrame(out, columns=["class", "cut"])
    frame.insert(0, "key", rows["key"].iloc[0])
    return frame


def with_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    size_col: str = "size",
    weights: tuple[int, ...] = WEIGHTS,
    cap: int = CAP,
) -> DataFrame:
    """``docs`` with the columns ``_source_size``, ``_target`` and ``_copies`` (0 to ``cap``).

    Only narrow columns are shuffled; rows of ``docs`` stay in their partitions
    while the sources are few.
    """
    rows = packed(
        docs, _id=F.col(id_col), _source=F.col(source_col), _size=F.col(size_col).cast("long")
    )
    sized = rows.select(F.col("_source").alias("source"), F.col("_size").alias("size"))
    targets = staged(source_targets(sized, weights, cap), "targets")
    known = tilts(sized, targets, cap).select(
        F.col("source").alias("_s"),
        F.coalesce("source_size", F.lit(0)).alias("_source_size"),
        F.col("target").alias("_target"),
        F.col("mean").alias("_mean"),
        F.col("tilt").alias("_tilt"),
        F.xxhash64("source", F.col("source").isNull()).alias("_key"),
    )
    known = few_or_shuffled(known)
    rated = rows.join(known, F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s")
    size = F.col("_size")
    rate = F.when(
        F.col("_tilt").isNotNull() & (size > 0), _rate(F.col("_tilt"), size, F.col("_mean"), cap)
    ).otherwise(0.0)
    rated = rated.withColumn("_rate", rate).withColumn("_base", F.floor("_rate"))
    part = F.col("_rate") - F.col("_base")
    chance = F.pmod(F.xxhash64("_id", F.lit("round")), F.lit(1 << 40)) / float(1 << 40)
    cell = F.floor((chance - F.col("_part") + 1) * (CELLS // 2)).cast("long")
    class_ = F.when(F.col("_part") > 0, F.floor(F.log2(size)).cast("int"))
    rated = (
        rated.withColumn("_part", part).withColumn("_cell", cell).withColumn("_class", class_)
    )
    whole = rated.groupBy("_key").agg(
        (
            F.max("_target").cast(EXACT)
            - F.sum((F.col("_rate") * size).cast(EXACT))
        ).alias("carry")
    )
    cells = (
        rated.where(F.col("_class").isNotNull())
        .groupBy("_key", "_class", "_cell")
        .agg(
            F.sum(size).alias("words"),
            F.sum((F.col("_part") * size).cast(EXACT)).alias("expected"),
        )
        .join(whole, "_key")
        .select(
            F.col("_key").alias("key"),
            F.col("_class").alias("class"),
            F.col("_cell").alias("cell"),
            "words",
            F.col("expected").cast("double"),
            F.col("carry").cast("double"),
        )
    )
    cuts = cells.groupBy("key").applyInPandas(_cuts, "key long, class int, cut long")
    cuts = few_or_shuffled(
        cuts.select(F.col("key").alias("_key"), F.col("class").alias("_class"), F.col("cut").alias("_cut"))
    )
    up = F.coalesce((F.col("_cell") < F.col("_cut")).cast("long"), F.lit(0))
    mixed = rated.join(cuts, ["_key", "_class"], "left").withColumn("_copies", F.col("_base") + up)
    return unpacked(mixed, docs.columns, "_source_size", "_target", "_copies")
