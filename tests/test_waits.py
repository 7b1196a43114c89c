"""Touch keys in bundles against the processors of one key, row by row; how a timely replay is dealt to files."""

import os
import random
import re

import pandas as pd
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

from playcohort.session import shared_dir
from playcohort.streaming import pipelines, touches, waits
from suite import streams
from tests.test_state_calls import Handle, Times

DAY = 86_400_000


def fields(**kinds):
    return [StructField(c, kind()) for c, kind in kinds.items()]


class Kept(Handle):
    def deleteTimer(self, at):  # noqa: N802
        self.calls += 1
        self.timers.discard(at)


class Store:
    """Keys with a processor each, batch by batch: rows first, then the timers the watermark has passed."""

    def __init__(self, make):
        self.make, self.keys = make, {}

    def batch(self, given, now):
        out = []
        for key, rows in given.items():
            if key not in self.keys:
                self.keys[key] = (self.make(), Kept())
                self.keys[key][0].init(self.keys[key][1])
            out += self.keys[key][0].handleInputRows(key, iter(rows), Times(now))
        for key, (processor, handle) in self.keys.items():
            for at in sorted(t for t in handle.timers if t <= now):
                handle.timers.discard(at)
                out += processor.handleExpiredTimer(key, Times(now), Times(at))
        return out


def frame(rows, columns, numbers):
    """As ``waits.for_frames`` gives them: null numbers are 0 and a bit."""
    table = {"nulls": [sum(1 << i for i, c in enumerate(numbers) if r[c] is None) for r in rows]}
    for c in columns:
        table[c] = [0 if c in numbers and r[c] is None else r[c] for r in rows]
    return pd.DataFrame(table)


def by_key(rows, on, made):
    out = {}
    for r in rows:
        out.setdefault(tuple(r[c] for c in on), []).append(made(r))
    return out


def plain(rows, columns):
    """Rows or frames as tuples, times as milliseconds."""
    found = [r for x in rows for r in (x.to_dict("records") if isinstance(x, pd.DataFrame) else [x.asDict()])]
    value = lambda v: None if v is None else round(v.timestamp() * 1000) if hasattr(v, "timestamp") else v
    return sorted((tuple(value(r[c]) for c in columns) for r in found), key=repr)


def batches(rng, one):
    """Rows of eight batches and the watermark each ends with; a row is never behind the watermark it meets."""
    now = 1_704_000_000_000
    for _ in range(8):
        until = now + rng.choice([3_600_000, DAY, 4 * DAY, 20 * DAY])
        # few seconds, so that rows meet in one
        yield [one(now + 1000 * (1 + rng.randrange((until - now) // 1000) // 1800 * 1800)) for _ in range(rng.randrange(150))], until - rng.choice([0, 1_800_000])
        now = until
    yield [], now + 100 * DAY


@pytest.mark.parametrize(("consume", "open_start"), [(True, False), (False, True), (False, False)])
@pytest.mark.parametrize("seed", range(4))
def test_a_bundle_of_touch_keys_finds_what_each_key_finds(seed, consume, open_start):
    rng = random.Random(seed)
    payload = fields(e_id=LongType, e_note=StringType, t_note=StringType, t_n=IntegerType)
    rows_of = StructType(fields(ms=LongType, oldest=LongType, close=LongType, is_event=BooleanType) + payload)
    out = StructType(fields(k=StringType, n=LongType, at=LongType, ms=LongType, touch_ms=LongType) + payload)
    rules = (["e_id", "e_note"], ["t_note", "t_n"], 7, consume, open_start)
    single = Store(lambda: touches.LatestTouch(rows_of, out, *rules))
    columns = StructType(fields(k=StringType, n=LongType, ms=LongType, oldest=LongType, is_event=BooleanType) + payload)
    kept = StructType(fields(k=StringType, n=LongType, used=LongType, ms=LongType, t_note=StringType, t_n=IntegerType))
    bundle = Store(lambda: waits.Touches(["k", "n"], columns, kept, *rules))

    def one(ms):
        is_event = rng.random() < 0.4
        some = lambda *values: rng.choice(values)
        return {"k": some("a", "b", "ü", None), "n": some(2**60 + 1, 7, None), "ms": ms, "oldest": (ms // DAY - 7) * DAY if is_event else None, "close": None if is_event else (ms // DAY + 1) * DAY,
                "is_event": is_event, "e_id": some(2**60 + 1, 2**60 + 2, 5, None) if is_event else None, "e_note": some("x", None) if is_event else None,
                "t_note": None if is_event else some("p", "q", "é", None), "t_n": None if is_event else some(-1, 2, None)}

    named, numbers, hits = [c for c in out.names if c != "at"], ["n", "ms", "oldest", "e_id", "t_n"], 0
    for rows, now in batches(rng, one):
        got = plain(bundle.batch({(0,): [frame(rows[:40], columns.names, numbers), frame(rows[40:], columns.names, numbers)]} if rows else {}, now), named)
        want = plain(single.batch(by_key(rows, ("k", "n"), lambda r: Row(**{c: r[c] for c in rows_of.names})), now), named)
        assert got == want
        hits += len(want)
    assert hits > 20
    # what no event can reach any more is gone
    processor, handle = bundle.keys[(0,)]
    assert processor.kept.held is None and not processor.waiting.held and not handle.timers


@pytest.mark.parametrize("seed", range(4))
def test_a_bundle_of_click_rows_shows_what_each_device_shows(seed):
    rng = random.Random(seed)
    payload = fields(callback=StringType, idea=StringType, n=IntegerType)
    rows_of, opened = StructType(fields(ms=LongType, used=BooleanType) + payload), StructType(fields(opened=LongType, ms=LongType) + payload)
    keys = fields(pkg_id=StringType, imei=StringType)
    out = StructType(keys + fields(opened=LongType, ts=LongType) + payload + fields(matched=IntegerType))
    single = Store(lambda: touches.ClickRows(rows_of, opened, out, ["idea", "n"]))
    columns, kept = StructType([*keys, *rows_of.fields]), StructType([*keys, *opened.fields])
    bundle = Store(lambda: waits.Clicks(["pkg_id", "imei"], columns, kept, ["idea", "n"]))

    def one(ms):
        used, some = rng.random() < 0.3, lambda *values: rng.choice(values)
        return {"pkg_id": some("1M1", "2M2"), "imei": some("a", "b", "c"), "ms": ms, "used": used, "callback": None if used else some("c1", "c2"),
                "idea": None if used else some("i", None), "n": None if used else some(1, 2, None)}

    shown = 0
    for rows, now in batches(rng, one):
        got = plain(bundle.batch({(0,): [frame(rows, columns.names, ["ms", "n"])]} if rows else {}, now), out.names)
        want = plain(single.batch(by_key(rows, ("pkg_id", "imei"), lambda r: Row(**{c: r[c] for c in rows_of.names})), now), out.names)
        assert got == want
        shown += len(want)
    assert shown > 20


def test_calls_of_a_bundle_do_not_grow_with_its_keys():
    columns = StructType(fields(k=StringType, ms=LongType, oldest=LongType, is_event=BooleanType, e_id=LongType, t_note=StringType))
    kept = StructType(fields(k=StringType, used=LongType, ms=LongType, t_note=StringType))
    store = Store(lambda: waits.Touches(["k"], columns, kept, ["e_id"], ["t_note"], 7, True, False))
    rows = [{"k": f"k{i // 2}", "ms": 1000 * i, "oldest": -7 * DAY, "is_event": i % 2 == 1, "e_id": i, "t_note": "n"} for i in range(4000)]
    found = store.batch({(0,): [frame(rows, columns.names, ["ms", "oldest", "e_id"])]}, DAY)
    assert sum(map(len, found)) == 2000 and store.keys[(0,)][1].calls <= 10


def test_null_numbers_and_far_times_are_ready_for_frames(spark):
    rows = spark.sql("SELECT 'a' AS k, cast(null AS bigint) AS n, 1152921504606846977 AS e, timestamp '9999-01-01 00:00:00' AS t UNION ALL SELECT 'b', 5, null, null")
    rows = waits.for_frames(rows.withColumn("at", waits.bounded(F.col("t"))), ["k"], ["k", "n", "e"]).orderBy("k").toPandas()
    assert rows["nulls"].tolist() == [1, 2] and rows["e"].tolist() == [2**60 + 1, 0] and str(rows["e"].dtype) == "int64"
    assert rows["at"][0].year == 2255 and pd.isna(rows["at"][1])


class Given:
    def __init__(self, spark):
        self.spark = spark


@pytest.mark.parametrize("n", [6000, 30])
def test_a_timely_replay_is_written_by_all_tasks_and_read_in_order(spark, n):
    """Thirty days of lines; with few of them a batch is one file, for each must have as many."""
    made = spark.range(0, n, 1, 4).selectExpr(
        f"'2024-01-01 10:00:00,001 [INFO] bi: bi_active|1|x|x|c|' || date_format(timestamp_seconds(1704067200 + id * 2592000 div {n}), 'yyyy-MM-dd HH:mm:ss') || '|' || id AS value")
    closing, seen, tasks = spark.sql("SELECT 'closing' AS value"), [], spark.sparkContext.defaultParallelism
    lines = streams.timely_replay(Given(spark), made, closing, "timely")
    base = shared_dir(spark, "timely-checkpoint")
    pipelines.start(lines, lambda rows, batch: seen.append([(r["value"], os.path.basename(r["f"])) for r in rows.withColumn("f", F.input_file_name()).collect()]), base).awaitTermination()
    assert [len({f for _, f in batch}) for batch in seen] == [tasks if n > 1000 else 1] * streams.TIMELY + [1]
    assert sorted(v for batch in seen for v, _ in batch) == sorted(r["value"] for r in made.union(closing).collect())
    days = [[int(re.search(r"2024-01-(\d\d) [^,]*\|", v)[1]) for v, _ in batch] for batch in seen[:-1]]
    assert all(5 * i <= min(d) and max(d) <= 5 * i + 5 for i, d in enumerate(days))
