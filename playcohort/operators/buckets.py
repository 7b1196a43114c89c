"""A current table in buckets: a merge reads and writes the buckets its keys fall into and no others.

Rows lie below ``data/version=<n>/bucket=<b>``. A manifest per version names, for every bucket, the version that holds it;
it is one file, so it appears at once, and readers take the newest. Version n starts from the newest manifest before n:
a batch that is replayed under its number finds the same table, writes the same rows over its first attempt, and
a batch that died before its manifest has changed nothing that anyone reads. Old versions of a bucket stay for readers that
still have them; ``unused`` lists what no manifest from a version on names.

The driver holds one number per bucket. A key's rows are one row after the merge, so no bucket is hot for long: choose as many buckets
as keep one in memory of a task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

BUCKETS = 64


@dataclass(frozen=True)
class BucketTable:
    """Rows with unique ``keys`` below ``path``; ``schema`` is DDL text."""

    spark: SparkSession
    path: str
    schema: str
    keys: Sequence[str]
    buckets: int = BUCKETS

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def manifest(self, before: int | None = None) -> dict[int, int]:
        """Bucket -> version that holds it, as of the newest version (below ``before``)."""
        try:
            rows = self.spark.read.schema("bucket int, holds bigint, version bigint").parquet(f"{self.path}/manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        if before is not None:
            rows = rows.filter(F.col("version") < before)
        newest = rows.agg(F.max("version")).first()[0]
        return {} if newest is None else {r["bucket"]: r["holds"] for r in rows.filter((F.col("version") == newest) & (F.col("bucket") >= 0)).collect()}

    def _read(self, held: dict[int, int]) -> DataFrame:
        schema = _parse_datatype_string(self.schema)
        if not held:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/data/version={version}/bucket={bucket}" for bucket, version in sorted(held.items())]
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self, version: int | None = None) -> DataFrame:
        """The newest table, or the one as of a version."""
        return self._read(self.manifest(None if version is None else version + 1))

    def merge(self, updates: DataFrame, version: int, how: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Write version ``version``: ``how(rows of the touched buckets, updates)`` replaces these rows. Returns the touched buckets."""
        updates = updates.persist()
        try:
            touched = sorted(r[0] for r in updates.select(self._bucket()).distinct().collect())  # at most one number per bucket
            held = self.manifest(before=version)
            if touched:
                merged = how(self._read({b: v for b, v in held.items() if b in set(touched)}), updates)
                rows = merged.select(*_parse_datatype_string(self.schema).fieldNames()).withColumn("bucket", self._bucket())
                rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/version={version}")
                kept = {r["bucket"] for r in self._files(version)}
                held = {b: v for b, v in held.items() if b not in set(touched)} | {b: version for b in touched if b in kept}
        finally:
            updates.unpersist()
        # a row beside the buckets', so that a table without rows has a manifest as well
        rows = self.spark.createDataFrame([(-1, version), *sorted(held.items())], "bucket int, holds bigint")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/version={version}")
        return touched

    def _files(self, version: int) -> list:
        """The buckets a version has written: those with rows."""
        schema = f"{self.schema}, bucket int"
        return self.spark.read.schema(schema).parquet(f"{self.path}/data/version={version}").select("bucket").distinct().collect()

    def unused(self, since: int) -> list[str]:
        """Folders of versions before ``since`` that no manifest from ``since`` on reads; they may be removed."""
        rows = self.spark.read.schema("bucket int, holds bigint, version bigint").parquet(f"{self.path}/manifest").filter("bucket >= 0")
        used = rows.filter(F.col("version") >= since).select("bucket", "holds").distinct()
        old = rows.filter(F.col("version") < since).select("bucket", "holds").distinct()
        return [f"{self.path}/data/version={r['holds']}/bucket={r['bucket']}" for r in old.join(used, ["bucket", "holds"], "left_anti").collect()]
