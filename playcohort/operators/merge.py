"""Keyed merges: a new snapshot of a report table from the old one and a batch of updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_replace(target: DataFrame, updates: DataFrame, keys: Sequence[str], update_cols: Sequence[str] | None = None,
                  greatest_cols: Sequence[str] = ()) -> DataFrame:
    """Insert new keys; for known keys overwrite ``update_cols`` (default: all the updates carry).

    Of ``greatest_cols`` the greater of the old and the new value stays. ``updates`` has one row per key.
    """
    keys = list(keys)
    cols = [c for c in target.columns if c not in keys]
    changed = set(updates.columns) & set(cols) if update_cols is None else set(update_cols)
    t = target.select(*keys, F.struct(*cols).alias("_t"))
    u = updates.select(*keys, F.struct(*[c for c in cols if c in updates.columns]).alias("_u"))
    both = t.join(u, keys, "full")
    out = []
    for c in cols:
        old = F.col(f"_t.{c}")
        if c not in updates.columns:
            out.append(old.alias(c))
            continue
        new = F.col(f"_u.{c}")
        fresh = F.col("_t").isNull() if c not in changed else F.col("_u").isNotNull()
        out.append((F.greatest(old, new) if c in greatest_cols else F.when(fresh, new).otherwise(old)).alias(c))
    return both.select(*keys, *out)


def merge_add(target: DataFrame, updates: DataFrame, keys: Sequence[str], add_cols: Sequence[str], latest_cols: Sequence[str] = ()) -> DataFrame:
    """Sum ``add_cols`` per key; ``latest_cols`` take the updates' value where there is one.

    Duplicate keys among the updates simply add up, before the shuffle.
    """
    def version(df: DataFrame, n: int) -> DataFrame:
        given = [F.col(c) if c in df.columns else F.lit(0).alias(c) for c in add_cols]
        named = [F.col(c) if c in df.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in latest_cols]
        return df.select(*keys, *given, *named, F.lit(n).alias("_v"))

    rows = version(target, 0).unionByName(version(updates, 1))
    latest = [F.max(F.when(F.col(c).isNotNull(), F.struct("_v", c))).getField(c).alias(c) for c in latest_cols]
    return rows.groupBy(*keys).agg(*[F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in add_cols], *latest)


def merge_greatest(target: DataFrame, updates: DataFrame, keys: Sequence[str], greatest_cols: Sequence[str],
                   replace_cols: Sequence[str] = ()) -> DataFrame:
    """Keep the greater of old and new for ``greatest_cols``; overwrite ``replace_cols``."""
    return merge_replace(target, updates, keys, [*greatest_cols, *replace_cols], greatest_cols)


def update_from(target: DataFrame, source: DataFrame, keys: Sequence[str], cols: Sequence[str], where: Column | None = None) -> DataFrame:
    """Overwrite attributes from a source with one row per key, where the source knows the key."""
    src = source.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in cols])
    joined = target.join(src, list(keys), "left")
    applies = F.lit(True) if where is None else where
    return joined.select(*[
        F.when(applies & F.col(f"_new_{c}").isNotNull(), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
        for c in target.columns])


def positive_difference(a: str, b: str) -> Column:
    """``a - b``, or 0 when that is negative."""
    return F.greatest(F.col(a) - F.col(b), F.lit(0))


def reset_where(target: DataFrame, where: Column, cols: Sequence[str]) -> DataFrame:
    """Zero metrics of a range before it is computed again."""
    return target.withColumns({c: F.when(where, F.lit(0).cast(target.schema[c].dataType)).otherwise(F.col(c)) for c in cols})


def delete_where(target: DataFrame, where: Column) -> DataFrame:
    return target.filter(~F.coalesce(where, F.lit(False)))


def append_new(details: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``updates`` whose key the detail table lacks, once per key."""
    return updates.dropDuplicates(list(keys)).join(details.select(*keys), list(keys), "left_anti")


def overwrite_days(df: DataFrame, path: str, day: str) -> None:
    """Replace only the day partitions the frame holds.

    ``rebalance`` gathers a day into few files, yet lets the adaptive planner split a day that holds
    much of the data.
    """
    df.hint("rebalance", day).write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(day).parquet(path)


def overwrite_parquet(df: DataFrame, path: str, files: int | None = None) -> None:
    """Write ``df``, in ``files`` files if given; a shuffle gathers them, so the work before it keeps its tasks."""
    (df.repartition(files) if files else df).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def upsert_jdbc(df: DataFrame, url: str, staging_table: str, batch_size: int = 5_000, **properties: str) -> None:
    """Hand the new snapshot to a database: batched inserts into a staging table it swaps in."""
    options = {"url": url, "dbtable": staging_table, "batchsize": str(batch_size), "truncate": "true", **properties}
    df.write.format("jdbc").options(**options).mode("overwrite").save()
