"""Near-duplicate documents: MinHash bands, Bayesian pruning, exact verification.

Documents are linked where the Jaccard similarity of their sets of distinct
five-word shingles (A-Z lower-cased) reaches the threshold. The plan:

1. One pass over the texts gives each row its set size, a 128-bit hash of its
   word sequence and a MinHash signature. Rows with equal sequences form a
   class, stood for by its smallest id; only representatives go on.
2. Signatures are cut into bands. Representatives that agree on a whole band
   share a bucket.
3. Candidates of a bucket are compared signature batch by signature batch. With
   a uniform prior, the chance that a pair reaches the threshold after m of n
   hashes agree is P(Binomial(n + 1, threshold) <= m); a pair goes once that
   is below ``miss``. Survivors are verified on their full sets.
4. Verified links are closed into components.

No bucket is expanded into all its pairs: its members are first compared with
one hub, and after closing the links, only members of *different* components
remain to be compared, with further hubs and finally with each other. A pair
inside one component can't change the result, so no link between components is
lost to this. Before that, documents leave whose shingles are so often their
own alone that no other document can reach the threshold. In buckets that stay
crowded even so (many edited copies of one text, each too far from most others)
members are compared in square blocks of bounded size: a task holds two blocks,
prunes by signatures, verifies by one product of incidence matrices, and hands
on no more links than it has rows.

Each row of the input gives one row. Null texts, empty texts and texts without
words have no shingles and are linked with nothing; with fewer words than a
shingle, the whole sequence is the only shingle. Rows with a null id are linked
with nothing (null component, kept). Rows that share an id are one document.
Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.graph import components
from riskloom.llm.rows import map_rows
from riskloom.llm.words import WordHasher, encoded, mix
from riskloom.sources.staging import staged

SHINGLE = 5
THRESHOLD = 0.75
# A pair at the threshold shares no band with probability (1 - 0.75**5)**40 = 2e-5.
BANDS, ROWS = 40, 5
# Signature values compared at a time.
BATCH = 40
# Chance of dropping a pair that reaches the threshold, for each batch.
MISS = 1e-6
# Rounds in which buckets are compared with one hub before all that is left.
HUB_ROUNDS = 2
# Open buckets with more members are compared in blocks of that many rows.
CROWD, BLOCK = 64, 512
# Shingles of a block pair that are multiplied at a time.
COLUMNS = 4096
# Most ids that are broadcast, once counted.
BROADCAST_IDS = 1_000_000

SIGNED = "id long, n long, k1 long, k2 long, sig binary"


def shingles(hasher: WordHasher, text: str | None, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, sorted distinct shingle hashes)."""
    words = hasher.words(encoded(text).lower())[2]
    return words, np.unique(hasher.grams(hasher.sums(words), min(k, len(words)) or k))


def signature(shingles: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """Upper halves of the least product per multiplier."""
    least = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 1024):
        products = np.multiply.outer(multipliers, shingles[i : i + 1024])
        np.minimum(least, products.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def _multipliers(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _sign(k: int, n_hashes: int):
    def build():
        hasher, multipliers = WordHasher(), _multipliers(n_hashes)

        def sign(id_, text):
            words, grams = shingles(hasher, text, k)
            if not len(words):
                return id_, 0, None, None, None
            k1, k2 = hasher.sequence(words)
            return id_, len(grams), k1, k2, signature(grams, multipliers).tobytes()

        return sign

    return build


def _band(bands: int, rows: int):
    weights = _multipliers(rows)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = mix(np.arange(bands, dtype=np.uint64) + np.uint64(7))
        for batch in batches:
            if not len(batch):
                continue
            values = np.frombuffer(b"".join(batch["sig"]), np.uint32).reshape(-1, bands, rows)
            keys = mix((mix(values.astype(np.uint64)) * weights).sum(axis=2, dtype=np.uint64) ^ number)
            yield pd.DataFrame(
                {
                    "bucket": keys.ravel().view(np.int64),
                    "id": np.repeat(batch["id"].to_numpy(np.int64), bands),
                    "n": np.repeat(batch["n"].to_numpy(np.int64), bands),
                }
            )

    return run


def least_matches(n_hashes: int, batch: int, threshold: float, miss: float) -> list[int]:
    """Per batch end, the fewest agreeing hashes with which a pair stays."""
    out = []
    for n in range(batch, n_hashes + 1, batch):
        below = 0.0
        for m in range(n + 1):
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= miss:
                out.append(m)
                break
    return out


def _prune(n_hashes: int, batch: int, least: list[int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            if not len(frame):
                continue
            left = np.frombuffer(b"".join(frame["sig_a"]), np.uint32).reshape(-1, n_hashes)
            right = np.frombuffer(b"".join(frame["sig_b"]), np.uint32).reshape(-1, n_hashes)
            alive, matches = np.arange(len(frame)), np.zeros(len(frame), np.int64)
            for i, fewest in enumerate(least):
                part = slice(i * batch, (i + 1) * batch)
                matches[alive] += (left[alive, part] == right[alive, part]).sum(axis=1)
                alive = alive[matches[alive] >= fewest]
            yield frame.iloc[alive][["a", "b"]]

    return run


def _sets(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher()
        for batch in batches:
            grams = [shingles(hasher, text, k)[1].view(np.int64) for text in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "grams": grams})

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("id").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("id").alias("b"), F.col("grams").alias("gb"))
    common = F.size(F.array_intersect("ga", "gb"))
    union = F.size("ga") + F.size("gb") - F.col("common")
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .withColumn("common", common)
        .where(100 * F.col("common") >= percent * union)
        .select("a", "b")
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
    miss: float = MISS,
    hub_rounds: int = HUB_ROUNDS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``."""
    percent, n_hashes = round(100 * threshold), bands * rows
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = staged(map_rows(texts, _sign(shingle, n_hashes), SIGNED), "signed")
    usable = signed.where(F.col("id").isNotNull() & (F.col("n") > 0))
    classes = staged(usable.groupBy("k1", "k2").agg(F.min("id").alias("rep")), "classes")
    first = classes.withColumnRenamed("rep", "id")
    reps = staged(
        usable.join(first, ["k1", "k2", "id"], "left_semi").select("id", "n", "sig"), "reps"
    )
    banded = reps.mapInPandas(_band(bands, rows), "bucket long, id long, n long")
    shared = (
        banded.groupBy("bucket")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"))
        .where("low < high")
        .select("bucket")
    )
    buckets = staged(banded.join(shared, "bucket"), "buckets")
    sets = staged(
        _only(texts, buckets.select("id").distinct()).mapInPandas(
            _sets(shingle), "id long, grams array<long>"
        ),
        "sets",
    )
    least = least_matches(n_hashes, BATCH, threshold, miss)
    prune = _prune(n_hashes, BATCH, least)

    comp = tested = None
    for number in range(hub_rounds + 1):
        if number == 1:
            alone = _alone(sets, _open(buckets, comp).select("id").distinct(), percent)
            buckets = staged(buckets.join(alone, "id", "left_anti"), "buckets")
        if number < hub_rounds:
            pairs, crowded = _hub_pairs(buckets, comp, number, percent), None
        else:
            members = staged(_open(buckets, comp), "members")
            pairs, crowded = _all_pairs(members, percent), _crowded(members)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = staged(pairs, "pairs")
        tested = pairs if tested is None else tested.union(pairs)
        left = reps.select(F.col("id").alias("a"), F.col("sig").alias("sig_a"))
        right = reps.select(F.col("id").alias("b"), F.col("sig").alias("sig_b"))
        alive = pairs.join(left, "a").join(right, "b").mapInPandas(prune, "a long, b long")
        links = _verified(alive, sets, percent)
        if crowded is not None:
            held = crowded.join(reps.select("id", "sig"), "id").join(sets, "id")
            blocks = _squares(held).groupBy("bucket", "i", "j")
            links = links.union(blocks.applyInPandas(_linked(n_hashes, least, percent), "a long, b long"))
        links = staged(links, "verified")
        if not links.isEmpty():
            comp = _merged(comp, links)
    labels = classes.select("k1", "k2", F.col("rep").alias("id"))
    if comp is None:
        labels = labels.withColumn("component_id", F.col("id"))
    else:
        labels = labels.join(comp, "id", "left").withColumn(
            "component_id", F.coalesce("comp", "id")
        )
    labels = labels.select("k1", "k2", "component_id")
    known = F.col("id").isNotNull()
    found = signed.select("id", "n", "k1", "k2").join(labels, ["k1", "k2"], "left")
    component = F.when(known, F.coalesce("component_id", "id"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


def _with_component(buckets: DataFrame, comp: DataFrame | None) -> DataFrame:
    if comp is None:
        return buckets.withColumn("comp", F.col("id"))
    return buckets.join(comp, "id", "left").withColumn("comp", F.coalesce("comp", "id"))


def _open(buckets: DataFrame, comp: DataFrame | None) -> DataFrame:
    """Members of buckets whose members are not all in one component."""
    members = _with_component(buckets, comp)
    ends = members.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    return members.join(ends.where("low < high").select("bucket"), "bucket")


def _hub_pairs(
    buckets: DataFrame, comp: DataFrame | None, number: int, percent: int
) -> DataFrame:
    """(a, b): members of open buckets with one member of another component as hub.

    The first hub is the smallest id, later ones follow a hash of id and round.
    """
    members = _with_component(buckets, comp)
    turn = F.xxhash64("id", F.lit(number)) if number else F.col("id")
    hubs = (
        members.groupBy("bucket")
        .agg(
            F.min("comp").alias("low"),
            F.max("comp").alias("high"),
            F.min(F.struct(turn.alias("turn"), "id", "comp", "n")).alias("hub"),
        )
        .where("low < high")
        .select("bucket", "hub.id", "hub.comp", "hub.n")
    )
    return _pairs(members, hubs, F.col("comp") != F.col("comp2"), percent)


def _all_pairs(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs across components in buckets of at most CROWD open members."""
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size"))
    few = staged(members.join(sizes.where(F.col("size") <= CROWD), "bucket").drop("size"), "few")
    return _pairs(few, few, F.col("comp") < F.col("comp2"), percent)


def _pairs(members: DataFrame, others: DataFrame, apart: Column, percent: int) -> DataFrame:
    others = others.select(
        "bucket", *(F.col(c).alias(f"{c}2") for c in ("id", "comp", "n"))
    )
    alike = 100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")
    return (
        members.join(others, (members["bucket"] == others["bucket"]) & apart & alike)
        .select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b"))
        .distinct()
    )


def _crowded(members: DataFrame) -> DataFrame:
    """Members of larger buckets with the number of blocks of their bucket."""
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size"))
    crowds = sizes.where(F.col("size") > CROWD).select(
        "bucket", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")
    )
    return members.join(crowds, "bucket")


def _squares(members: DataFrame) -> DataFrame:
    """Each member once for every pair (i, j) of blocks that its block is in."""
    block = F.pmod(F.xxhash64("id", "bucket"), "blocks").cast("int")
    return (
        members.withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .select("bucket", "i", "j", "block", "id", "comp", "n", "sig", "grams")
    )


def _linked(n_hashes: int, least: list[int], percent: int):
    """Links between two blocks: enough of those that verify to join what they join."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        i, j = rows["i"].iloc[0], rows["j"].iloc[0]
        left, right = rows[rows["block"] == i], rows[rows["block"] == j]
        n, m = (x["n"].to_numpy(np.int64) for x in (left, right))
        small, large = np.minimum.outer(n, m), np.maximum.outer(n, m)
        alive = np.not_equal.outer(left["comp"].to_numpy(), right["comp"].to_numpy())
        alive &= 100 * small >= percent * large
        if i == j:
            alive &= np.less.outer(left["id"].to_numpy(), right["id"].to_numpy())
        a, b = (
            np.frombuffer(b"".join(x["sig"]), np.uint32).reshape(-1, n_hashes).T.copy()
            for x in (left, right)
        )
        matches = np.zeros(alive.shape, np.int16)
        batch = n_hashes // len(least)
        for step, fewest in enumerate(least):
            if not alive.any():
                break
            for h in range(step * batch, (step + 1) * batch):
                matches += np.equal.outer(a[h], b[h])
            alive &= matches >= fewest
        if alive.any():
            common = _common(left["grams"].tolist(), right["grams"].tolist())
            alive &= 100 * common >= percent * (np.add.outer(n, m) - common)
        at, to = np.nonzero(alive)
        ends = left["id"].to_numpy()[at], right["id"].to_numpy()[to]
        parts = left["comp"].to_numpy()[at], right["comp"].to_numpy()[to]
        keep, root = [], {}

        def find(x: int) -> int:
            while root.get(x, x) != x:
                root[x] = root.get(root[x], root[x])
                x = root[x]
            return x

        for k, (x, y) in enumerate(zip(*parts)):
            x, y = find(x), find(y)
            if x != y:
                root[x] = y
                keep.append(k)
        return pd.DataFrame({"a": ends[0][keep], "b": ends[1][keep]}, dtype=np.int64)

    return run


def _common(left: list, right: list) -> np.ndarray:
    """Sizes of the intersections of all sets on the left with all on the right."""
    sets = [np.asarray(x, np.int64) for x in (*left, *right)]
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    token, at, holders = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(holders > 1) - 1
    keep = holders[at] > 1
    owner, at = owner[keep], shared[at[keep]]
    out = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int((holders > 1).sum()), COLUMNS):
        here = (at >= start) & (at < start + COLUMNS)
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[owner[here], at[here] - start] = 1
        out += held[: len(left)] @ held[len(left) :].T
    return out.astype(np.int64)


def _alone(sets: DataFrame, ids: DataFrame, percent: int) -> DataFrame:
    """Ids among ``ids`` that no other of them can be linked with.

    Shingles that no other set holds are in no intersection but in every union.
    """
    held = sets.join(ids, "id", "left_semi")
    own = (
        held.select("id", F.explode("grams").alias("gram"))
        .groupBy("gram")
        .agg(F.count("*").alias("holders"), F.min("id").alias("id"))
        .where("holders = 1")
        .groupBy("id")
        .agg(F.count("*").alias("own"))
    )
    size = F.size("grams")
    return (
        held.select("id", size.alias("size"))
        .join(own, "id")
        .where(100 * (F.col("size") - F.col("own")) < percent * F.col("size"))
        .select("id")
    )


def _only(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``texts`` with an id in ``ids``; texts stay in place where ids are few."""
    ids = staged(ids, "ids")
    few = ids.count() <= BROADCAST_IDS
    return texts.join(F.broadcast(ids) if few else ids, "id", "left_semi")


def _merged(comp: DataFrame | None, links: DataFrame) -> DataFrame:
    """(id, comp) after adding ``links`` to the components in ``comp``."""
    if comp is None:
        return staged(components(links).withColumnRenamed("component", "comp"), "comp")
    for end in ("a", "b"):
        names = comp.select(F.col("id").alias(end), F.col("comp").alias("_c"))
        links = links.join(names, end, "left").withColumn(end, F.coalesce("_c", end)).drop("_c")
    moved = staged(components(links), "moved")
    onto = moved.select(F.col("id").alias("comp"), F.col("component").alias("_c"))
    old = comp.join(onto, "comp", "left").select("id", F.coalesce("_c", "comp").alias("comp"))
    new = moved.join(comp, "id", "left_anti").select("id", F.col("component").alias("comp"))
    return staged(old.union(new), "comp")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without near duplicates of a document with a smaller id."""
    gone = near_duplicates(docs, id_col, text_col).where(~F.col("kept"))
    return docs.join(gone.select(F.col("doc_id").alias(id_col)), id_col, "left_anti")
