"""Current tables in buckets: what a merge reads, writes and leaves alone."""

import os
from functools import partial

import pytest

from playcohort.operators import merge
from playcohort.operators.buckets import BucketTable
from playcohort.session import shared_dir

SCHEMA = "k int, n bigint, name string"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


@pytest.fixture()
def table(spark):
    made = BucketTable(spark, shared_dir(spark, "bucket-test"), SCHEMA, ["k"], 8)
    made.merge(frame(spark, *[(k, k, f"v{k}") for k in range(200)]), 0, lambda old, new: new)
    return made


def add():
    return partial(merge.merge_add, keys=["k"], add_cols=["n"], latest_cols=["name"])


def state(table):
    return {r["k"]: (r["n"], r["name"]) for r in table.read().collect()}


def files(table, version=None):
    return {f for f in table.read(version).inputFiles()}


def test_only_touched_buckets_are_read_and_written(spark, table):
    assert sorted(table.manifest()) == list(range(8))
    before = files(table)
    asked = []

    def how(old, new):
        asked.extend(old.inputFiles())
        return add()(old, new)

    touched = table.merge(frame(spark, (3, 10, "a"), (500, 1, "b")), 1, how)
    assert 1 <= len(touched) <= 2
    buckets = {f"bucket={b}/" for b in touched}
    assert asked and all(any(b in f for b in buckets) for f in asked)
    written = os.listdir(table.path.removeprefix("file://") + "/data/version=1")
    assert {f"{f}/" for f in written if f.startswith("bucket=")} == buckets
    after = files(table)
    assert {f for f in before if not any(b in f for b in buckets)} == {f for f in after if "version=0" in f}
    want = {k: (k, f"v{k}") for k in range(200)} | {3: (13, "a"), 500: (1, "b")}
    assert state(table) == want


def test_a_replayed_version_changes_nothing(spark, table):
    updates = frame(spark, (1, 5, "x"), (2, 5, "y"))
    table.merge(updates, 1, add())
    once = state(table)
    table.merge(updates, 1, add())
    assert state(table) == once and once[1] == (6, "x")


def test_a_merge_that_dies_is_not_seen(spark, table):
    def dies(old, new):
        raise RuntimeError("lost")

    before = state(table)
    with pytest.raises(RuntimeError):
        table.merge(frame(spark, (1, 5, "x")), 1, dies)
    assert state(table) == before
    # rows written, manifest not: as after the loss of the driver between the two
    half = BucketTable(spark, table.path, SCHEMA, ["k"], 8)
    frame(spark, (1, 99, "lost")).selectExpr("*", "0 AS bucket").write.partitionBy("bucket").parquet(f"{table.path}/data/version=1")
    assert state(half) == before
    half.merge(frame(spark, (1, 5, "x")), 1, add())
    assert state(half) == before | {1: (6, "x")}


def test_empty_updates_old_versions_and_unused_folders(spark, table):
    first = state(table)
    table.merge(frame(spark, (1, 1, "x")), 1, add())
    table.merge(spark.createDataFrame([], SCHEMA), 2, add())
    assert state(table)[1] == (2, "x") and {r["k"]: (r["n"], r["name"]) for r in table.read(0).collect()} == first
    assert len(table.unused(2)) == 1 and table.unused(0) == []
    nothing = BucketTable(spark, shared_dir(spark, "bucket-none"), SCHEMA, ["k"], 4)
    assert nothing.read().count() == 0
    nothing.merge(spark.createDataFrame([], SCHEMA), 0, add())
    assert nothing.read().count() == 0


def test_rows_that_a_merge_drops_are_gone(spark, table):
    table.merge(frame(spark, *[(k, 0, "") for k in range(200)]), 1, lambda old, new: old.filter("k < 3"))
    assert sorted(state(table)) == [0, 1, 2]
    table.merge(frame(spark, *[(k, 0, "") for k in range(200)]), 2, lambda old, new: old.filter("k < 0"))
    assert state(table) == {}
