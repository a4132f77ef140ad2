"""A full run that goes on where an earlier one ended.

Each finished stage leaves a record below ``out/run``: a digest of what it was made of,
that is the versions of its input tables, the settings it uses and the digests of the
stages before it. A stage whose record says the same is not run again, its tables are read.
So a run that failed is taken up at the failed stage, new user pages leave the collected
posts as they are, and another risk model scores again without fetching anything.

Records are tiny tables; the success mark of the write is the commit. A stage's record goes
before its tables are replaced, so tables half written are never taken for finished.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from riskloom.plans import jobs
from riskloom.schemas import POST
from riskloom.sources import readers
from riskloom.sources.staging import path_exists, remove_path

STAGES = ("profiles", "posts", "history", "scored_posts", "scored_users")
RECORD = "stage string, inputs string"


def digest(*parts: object) -> str:
    return hashlib.sha256(json.dumps(parts, default=str).encode()).hexdigest()


class RunLog:
    """What the stages below ``out`` were made of."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.root = spark, f"{out.rstrip('/')}/run"

    def inputs(self, stage: str) -> str | None:
        """The digest of a finished stage's inputs; None if it has not finished."""
        path = f"{self.root}/{stage}"
        if not path_exists(self.spark, f"{path}/_SUCCESS"):
            return None
        return self.spark.read.schema(RECORD).json(path).head()["inputs"]

    def forget(self, stage: str) -> None:
        remove_path(self.spark, f"{self.root}/{stage}")

    def finish(self, stage: str, inputs: str) -> None:
        row = self.spark.createDataFrame([(stage, inputs)], RECORD).coalesce(1)
        row.write.mode("overwrite").json(f"{self.root}/{stage}")

    def finished(self) -> list[str]:
        return [s for s in STAGES if self.inputs(s) is not None]

    def made(self, stage: str, inputs: str, make: Callable[[], object]) -> str:
        """Runs ``make`` unless the stage has finished with these inputs; returns their digest."""
        if self.inputs(stage) != inputs:
            self.forget(stage)
            make()
            self.finish(stage, inputs)
        return inputs


def resumable_run(
    spark: SparkSession,
    listing_pages: DataFrame,
    user_pages: DataFrame,
    out: str,
    cfg: jobs.RunConfig,
    versions: Mapping[str, str],
    known: tuple[DataFrame, DataFrame] | None = None,
    profiles: DataFrame | None = None,
    labelled: DataFrame | None = None,
    until: str = STAGES[-1],
) -> DataFrame | None:
    """As :func:`riskloom.plans.jobs.full_run`, without the stages that ``out`` has already.

    ``versions`` names the state of each given table by its parameter's name, such as a
    snapshot's number or a delivery's day; a table whose name changes counts as new. With
    ``until`` the run ends after that stage. Returns the users' risk, or None if it ends before.
    """
    given = {
        "listing_pages": listing_pages,
        "user_pages": user_pages,
        "known": known,
        "profiles": profiles,
        "labelled": labelled,
    }
    unnamed = [name for name, table in given.items() if table is not None and name not in versions]
    if unnamed:
        raise ValueError(f"tables without a version: {', '.join(unnamed)}")
    if until not in STAGES:
        raise ValueError(f"no stage {until}")
    log = RunLog(spark, out)
    named = {name: None if table is None else versions[name] for name, table in given.items()}

    language = named["profiles"]
    if profiles is None and labelled is not None:
        path = f"{out}/profiles"
        language = log.made(
            "profiles",
            digest(named["labelled"]),
            lambda: jobs.train_profiles_job(spark, labelled, path),
        )
        profiles = spark.read.parquet(path)
    if until == "profiles":
        return None

    collected = log.made(
        "posts",
        digest(named["listing_pages"], cfg.groups, cfg.per_group, cfg.total),
        lambda: jobs.collect_job(spark, listing_pages, f"{out}/posts", cfg),
    )
    posts = spark.read.schema(POST).parquet(f"{out}/posts/table")
    if until == "posts":
        return None

    looked_back = (cfg.as_of, cfg.lookback_days, cfg.max_items, cfg.stop_at_old)
    enriched = log.made(
        "history",
        digest(collected, named["user_pages"], named["known"], looked_back),
        lambda: jobs.enrich_job(spark, posts, user_pages, known, f"{out}/history", cfg),
    )
    users, items = readers.read_history_tables(spark, f"{out}/history")
    if until == "history":
        return None

    scored = log.made(
        "scored_posts",
        digest(collected, language, repr(cfg.model)),
        lambda: jobs.score_posts_job(spark, posts, f"{out}/scored_posts", cfg, profiles),
    )
    scored_posts = spark.read.parquet(f"{out}/scored_posts/table")
    if until == "scored_posts":
        return None

    log.made(
        "scored_users",
        digest(enriched, scored, repr(cfg.model), cfg.min_confident),
        lambda: jobs.score_users_job(spark, users, items, scored_posts, f"{out}/scored_users", cfg),
    )
    return spark.read.parquet(f"{out}/scored_users/table")
