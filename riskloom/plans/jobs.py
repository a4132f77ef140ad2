"""Collect, enrich, score posts, score users, and the full run.

Stages hand over through written Parquet tables. That cuts the lineage, so a
lost executor costs the tasks of one stage, and each sink of a stage reads the
table instead of recomputing the scores.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riskloom.model import DEFAULT_MODEL, RiskModel
from riskloom.operators import report
from riskloom.operators.language import (
    COUNTS,
    detector,
    merged_counts,
    profile_weights,
    train_language_profiles,
    trigram_counts,
)
from riskloom.operators.pages import extract_items, extract_posts, parsed_pages, usable_keys
from riskloom.operators.posts import scored_records
from riskloom.operators.select import (
    LOOKBACK_DAYS,
    MAX_ITEMS,
    PER_GROUP,
    TARGET_GROUPS,
    TOTAL,
    authors_to_fetch,
    cutoff,
    global_budget,
    in_groups,
    lookback,
    merge_new_wins,
    newest_per_group,
    split_budget,
    top_risky,
    unique_authors,
)
from riskloom.operators.skew import few
from riskloom.operators.users import MIN_CONFIDENT_ITEMS, fallback_scores, score_users
from riskloom.schemas import HISTORY, POST, USERS
from riskloom.sources import readers, writers
from riskloom.sources.buckets import BUCKETS, BucketStore, Written
from riskloom.sources.staging import discard, staged


@dataclass(frozen=True)
class RunConfig:
    """What a run collects, how far it looks back and how it scores."""

    as_of: dt.datetime
    groups: tuple[str, ...] = TARGET_GROUPS
    per_group: int = PER_GROUP
    total: int = TOTAL
    lookback_days: int = LOOKBACK_DAYS
    max_items: int = MAX_ITEMS
    min_confident: int = MIN_CONFIDENT_ITEMS
    # True ends a user's listing at the first item older than the lookback, as
    # a page-by-page crawl does; False filters by time alone.
    stop_at_old: bool = False
    model: RiskModel = field(default_factory=lambda: DEFAULT_MODEL)


def collect(listing_pages: DataFrame, cfg: RunConfig) -> DataFrame:
    """Newest posts of the configured groups within the budgets.

    Pages may come parsed, see :func:`riskloom.operators.pages.parsed_pages`.
    """
    wanted = listing_pages.where(F.col("group_name").isin(*cfg.groups))
    usable = usable_keys(wanted, ["group_name"])
    posts = in_groups(extract_posts(wanted, usable=usable), cfg.groups)
    ranked = newest_per_group(posts, "subreddit", cfg.per_group)
    return global_budget(ranked, "subreddit", cfg.groups, cfg.per_group, cfg.total).select(
        *POST.names
    )


def collect_job(
    spark: SparkSession, listing_pages: DataFrame, out: str, cfg: RunConfig
) -> DataFrame:
    """Landed listing pages -> ``out``: table, JSON lines, posts per group, errors.

    Pages without ``page_no`` are put in order by their next links. Each page is parsed once; items and pages that failed come from that table.
    """
    wanted = listing_pages.where(F.col("group_name").isin(*cfg.groups))
    parsed = staged(parsed_pages(wanted), "parsed")
    collect(parsed, cfg).write.mode("overwrite").parquet(f"{out}/table")
    _write_errors(parsed, ["group_name"], f"{out}/errors")
    discard(parsed)
    posts = spark.read.parquet(f"{out}/table")
    writers.write_posts(posts, f"{out}/json")
    report.posts_per_group(posts).write.mode("overwrite").json(f"{out}/groups")
    return posts


def _write_errors(parsed: DataFrame, keys: list[str], path: str) -> None:
    keys = [*keys, *(c for c in ("page_no",) if c in parsed.columns)]
    errors = parsed.where("error is not null").select(*keys, "url", "attempt", "error")
    errors.write.mode("overwrite").json(path)


def pages_of(user_pages: DataFrame, authors: DataFrame) -> DataFrame:
    """Parsed pages of ``authors``; bodies are not shuffled, however many they are.

    Few authors are broadcast before the parse. With more, all pages are parsed
    where they lie and the small parsed rows are joined.
    """
    wanted = authors.select("username").dropna().distinct()
    if few(wanted):
        return parsed_pages(user_pages.join(F.broadcast(wanted), "username", "left_semi"))
    return parsed_pages(user_pages).join(wanted, "username", "left_semi")


def fetch_history(parsed: DataFrame, cfg: RunConfig) -> DataFrame:
    """Budgeted recent items from parsed user pages, which should be a table."""
    oldest = cutoff(cfg.as_of, cfg.lookback_days) if cfg.stop_at_old else None
    items = extract_items(parsed, oldest, usable=usable_keys(parsed, ["username", "kind"]))
    return split_budget(lookback(items, cfg.as_of, cfg.lookback_days), cfg.max_items)


def enrich_job(
    spark: SparkSession,
    posts: DataFrame,
    user_pages: DataFrame,
    known: tuple[DataFrame, DataFrame] | None,
    out: str,
    cfg: RunConfig,
) -> tuple[DataFrame, DataFrame]:
    """Adds the history of authors not yet in ``known`` (users, items).

    ``out`` must be a new path, never the one ``known`` is read from.
    """
    fetched = unique_authors(posts)
    if known is not None:
        report.author_coverage(fetched, known[0]).write.mode("overwrite").json(f"{out}/coverage")
        fetched = authors_to_fetch(fetched, known[0])
    fetched.write.mode("overwrite").parquet(f"{out}/fetched")
    new_users = spark.read.schema(USERS).parquet(f"{out}/fetched")
    parsed = staged(pages_of(user_pages, new_users), "parsed")
    _write_errors(parsed, ["username", "kind"], f"{out}/errors")
    users, items = new_users, fetch_history(parsed, cfg)
    if known is not None:
        users = merge_new_wins(known[0], users, new_users)
        items = merge_new_wins(known[1], items, new_users)
    writers.write_history(users, items.select(*HISTORY.names), out)
    discard(parsed)
    users, items = readers.read_history_tables(spark, out)
    report.items_per_user(users, items).write.mode("overwrite").json(f"{out}/items_per_user")
    return users, items


def history_store(spark: SparkSession, root: str, buckets: int = BUCKETS) -> BucketStore:
    """The bucketed history below ``root``: users, and items by the user they belong to."""
    return BucketStore(spark, root, "username", {"users": USERS, "items": HISTORY}, buckets)


def merge_into_history(store: BucketStore, new_users: DataFrame, new_items: DataFrame) -> Written:
    """L11 on a store: users of ``new_users`` are replaced whole, bucket by bucket.

    Buckets without such a user are neither read nor written.
    """
    touched = store.touched(new_users)
    merged = {
        "users": merge_new_wins(store.read("users", touched), new_users, new_users),
        "items": merge_new_wins(store.read("items", touched), new_items, new_users),
    }
    return store.write(merged, touched)


def enrich_store_job(
    spark: SparkSession,
    posts: DataFrame,
    user_pages: DataFrame,
    store: BucketStore,
    out: str,
    cfg: RunConfig,
    again: DataFrame | None = None,
) -> Written:
    """J2 on a history that stays: what :func:`enrich_job` adds goes into ``store``.

    Authors that the store knows are skipped, but for those in ``again(username)``:
    they are fetched although they are known, and what is found now replaces all that
    the store has of them. Of the store only the buckets of the authors are read, and
    only those of fetched users are written. Reports go below ``out``.
    """
    authors = staged(unique_authors(posts), "authors")
    known = store.read("users", store.touched(authors))
    report.author_coverage(authors, known).write.mode("overwrite").json(f"{out}/coverage")
    fetched = authors_to_fetch(authors, known)
    if again is not None:
        fetched = fetched.unionByName(again.select("username")).dropna().distinct()
    fetched.write.mode("overwrite").parquet(f"{out}/fetched")
    new_users = spark.read.schema(USERS).parquet(f"{out}/fetched")
    parsed = staged(pages_of(user_pages, new_users), "parsed")
    _write_errors(parsed, ["username", "kind"], f"{out}/errors")
    written = merge_into_history(store, new_users, fetch_history(parsed, cfg).select(*HISTORY.names))
    discard(parsed, authors)
    return written


def train_profiles_job(spark: SparkSession, labelled: DataFrame, out: str) -> DataFrame:
    """Language profiles of ``labelled(lang, text)`` as a table, for J3 and J5."""
    train_language_profiles(labelled).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def profile_store(spark: SparkSession, root: str, buckets: int = 8) -> BucketStore:
    """Trigram counts that stay below ``root``: at most 4,096 rows a language."""
    return BucketStore(spark, root, "lang", {"counts": COUNTS}, buckets)


def add_to_profiles_job(store: BucketStore, labelled: DataFrame, number: int) -> Written:
    """Adds the texts of delivery ``number``, from 0, to the counts of ``store``.

    Delivery n makes version n + 1 from version n, so running the last one again counts
    its texts once. Only the buckets of its languages are read and written.
    """
    counts = staged(trigram_counts(labelled), "counts")
    touched = store.touched(counts)
    both = store.read("counts", touched, number).unionByName(counts)
    written = store.write({"counts": merged_counts(both)}, touched, number)
    discard(counts)
    return written


def stored_profiles(store: BucketStore, version: int | None = None) -> DataFrame:
    """Profiles of all texts counted up to a version, the last one unless told."""
    return profile_weights(store.read("counts", version=version))


def score_posts_job(
    spark: SparkSession,
    posts: DataFrame,
    out: str,
    cfg: RunConfig,
    profiles: DataFrame | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """Scored posts as a Parquet table, JSON lines, CSV, and two reports.

    An ``observation`` receives ``posts_scored`` without another pass.
    """
    language = None if profiles is None else detector(profiles)(F.col("_text"))
    scored = scored_records(posts, cfg.model, language)
    if observation is not None:
        scored = scored.observe(observation, F.count(F.lit(1)).alias("posts_scored"))
    scored.write.mode("overwrite").parquet(f"{out}/table")
    table = spark.read.parquet(f"{out}/table")
    writers.write_scored_posts_jsonl(table, f"{out}/jsonl")
    writers.write_scored_posts_csv(table, f"{out}/csv")
    report.label_distribution(table).write.mode("overwrite").json(f"{out}/labels")
    top_risky(table.select("id", "risk_score", "risk_label")).write.mode("overwrite").json(
        f"{out}/top"
    )
    return table


def score_users_job(
    spark: SparkSession,
    users: DataFrame,
    items: DataFrame,
    scored_posts: DataFrame | None,
    out: str,
    cfg: RunConfig,
    observation: Observation | None = None,
) -> DataFrame:
    """User risk as a Parquet table, JSON lines and CSV.

    An ``observation`` receives ``users_written`` without another pass.
    """
    fallback = None if scored_posts is None else fallback_scores(scored_posts)
    scored = score_users(users, items, fallback, cfg.model, cfg.min_confident)
    if observation is not None:
        scored = scored.observe(observation, F.count(F.lit(1)).alias("users_written"))
    scored.write.mode("overwrite").parquet(f"{out}/table")
    table = spark.read.parquet(f"{out}/table")
    writers.write_scored_users_csv(table, f"{out}/csv")
    writers.write_scored_users_jsonl(table, f"{out}/jsonl")
    return table


def full_run(
    spark: SparkSession,
    listing_pages: DataFrame,
    user_pages: DataFrame,
    out: str,
    cfg: RunConfig,
    known: tuple[DataFrame, DataFrame] | None = None,
    profiles: DataFrame | None = None,
    labelled: DataFrame | None = None,
) -> DataFrame:
    """All stages in order below ``out``; the first failure ends the run.

    Posts get a language from ``profiles``, a table that an earlier run has
    written, or from profiles trained on ``labelled(lang, text)`` first.
    """
    if profiles is None and labelled is not None:
        profiles = train_profiles_job(spark, labelled, f"{out}/profiles")
    posts = collect_job(spark, listing_pages, f"{out}/posts", cfg)
    users, items = enrich_job(spark, posts, user_pages, known, f"{out}/history", cfg)
    scored = score_posts_job(spark, posts, f"{out}/scored_posts", cfg, profiles)
    return score_users_job(spark, users, items, scored, f"{out}/scored_users", cfg)
