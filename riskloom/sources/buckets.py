"""Tables bucketed by a key's hash, of which a run rewrites only the buckets it touches.

A store holds one or more tables that share a key. Each version has a manifest: a small
table of (table, bucket, path), at most one row per table and bucket. A write puts the
touched buckets below a new path and then the next manifest, in which the other buckets
keep their paths. The manifest's success mark is the commit: a run that fails before it
leaves the version before as it was, and running it again does no harm. The last two
versions stay, so readers of the one before are not cut off.

How many rows a run reads and writes thus depends on how many keys it touches, not on
how many there are. A bucket that one key fills is written by several tasks
(``rebalance``).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.sources.staging import remove_path

BUCKETS = 64
MANIFEST = "table string, bucket int, path string"


@dataclass(frozen=True)
class Written:
    """What a write did."""

    version: int
    buckets: list[int]
    rows: dict[str, int] = field(default_factory=dict)


class BucketStore:
    """Tables below ``root``, named in ``schemas``, all with the column ``key``.

    ``buckets`` is fixed when the first version is written. Null keys share a bucket.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        key: str,
        schemas: Mapping[str, T.StructType],
        buckets: int = BUCKETS,
    ):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        self.schemas, self.buckets = dict(schemas), buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets that the keys of ``rows`` fall into: at most as many as there are."""
        found = rows.select(self.bucket().alias("bucket")).distinct().collect()
        return sorted(r["bucket"] for r in found)

    def _listed(self, pattern: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(pattern)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        found = path.getFileSystem(conf).globStatus(path)
        return [f.getPath().toString() for f in found or []]

    def versions(self) -> list[int]:
        """Numbers of the committed versions that are still there."""
        marks = self._listed(f"{self.root}/manifest/v*/_SUCCESS")
        return sorted(int(m.split("/")[-2][1:]) for m in marks)

    def manifest(self, version: int | None = None) -> dict[tuple[str, int], str]:
        """(table, bucket) -> path; of the last version unless told. Empty before the first."""
        if version is None:
            version = max(self.versions(), default=0)
        if not version:
            return {}
        rows = self.spark.read.schema(MANIFEST).json(f"{self.root}/manifest/v{version}").collect()
        return {(r["table"], r["bucket"]): r["path"] for r in rows}

    def read(
        self, table: str, buckets: Iterable[int] | None = None, version: int | None = None
    ) -> DataFrame:
        """A table, or some of its buckets; others are not even listed."""
        wanted = None if buckets is None else set(buckets)
        paths = [
            path
            for (name, bucket), path in sorted(self.manifest(version).items())
            if name == table and (wanted is None or bucket in wanted)
        ]
        schema = self.schemas[table]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def write(
        self, tables: Mapping[str, DataFrame], touched: Iterable[int], base: int | None = None
    ) -> Written:
        """Commits the version after ``base`` (the last one), ``touched`` buckets replaced.

        ``tables`` hold all rows that these buckets shall have; what they hold of other
        buckets is an error. A table that is not named keeps its buckets.
        """
        touched = sorted(set(touched))
        base = max(self.versions(), default=0) if base is None else base
        manifest, rows = self.manifest(base), {}
        for name, frame in tables.items():
            path = f"{self.root}/data/{name}-{uuid.uuid4().hex}"
            bucket = self.bucket()
            known = F.when(bucket.isin(touched), bucket).otherwise(
                F.raise_error(F.lit("a row of a bucket that is not replaced"))
            )
            placed = frame.select(*self.schemas[name].names, known.cast("int").alias("bucket_no"))
            placed.hint("rebalance", "bucket_no").write.partitionBy("bucket_no").parquet(path)
            # From the files' footers.
            rows[name] = self.spark.read.schema(placed.schema).parquet(path).count()
            manifest = {k: p for k, p in manifest.items() if k[0] != name or k[1] not in touched}
            for found in self._listed(f"{path}/bucket_no=*"):
                manifest[name, int(found.rsplit("=", 1)[1])] = found
        version = base + 1
        # Left by a run of this version that was repeated.
        stale = set(self.manifest(version).values() if version in self.versions() else ())
        lines = [(name, bucket, path) for (name, bucket), path in sorted(manifest.items())]
        frame = self.spark.createDataFrame(lines, MANIFEST).coalesce(1)
        frame.write.mode("overwrite").json(f"{self.root}/manifest/v{version}")
        for path in stale - set(manifest.values()) - set(self.manifest(base).values()):
            remove_path(self.spark, path)
        self._expire(version)
        return Written(version, touched, rows)

    def _expire(self, version: int) -> None:
        """Removes what only versions before the last two refer to."""
        for old in [v for v in self.versions() if v < version - 1]:
            after = set(self.manifest(old + 1).values())
            for path in set(self.manifest(old).values()) - after:
                remove_path(self.spark, path)
            remove_path(self.spark, f"{self.root}/manifest/v{old}")
