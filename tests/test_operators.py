"""Operators against brute force, with one key that holds most rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from playcohort.operators import kpi, merge
from playcohort.operators.asof import latest_touch
from playcohort.operators.cohort import retention
from playcohort.operators.ltv import ltv, ltv_by_join
from playcohort.session import shared_dir

DAY0 = dt.date(2024, 1, 1)


def rows_of(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("consume", [False, True])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_latest_touch(spark, consume, seed):
    rng = random.Random(seed)
    at = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(24 * 20), seconds=rng.randrange(3))
    key = lambda: "hot" if rng.random() < 0.7 else f"k{rng.randrange(4)}"
    touches = [(key(), at(), i) for i in range(120)]
    events = [(key(), at(), i) for i in range(150)]
    want, last_event = [], {}
    for k, t, i in sorted(events, key=lambda e: (e[0], e[1], e[2])):
        oldest = dt.datetime.combine(t.date() - dt.timedelta(days=7), dt.time())
        seen = [(ts, p) for kk, ts, p in touches if kk == k and oldest <= ts <= t and (not consume or k not in last_event or ts > last_event[k])]
        last_event[k] = t
        if seen:
            ts = max(seen)[0]
            want.append((i, ts, max(p for s, p in seen if s == ts)))
    got = latest_touch(spark.createDataFrame(events, "k string, t timestamp, id int"), spark.createDataFrame(touches, "k string, ts timestamp, p int"),
                       ["k"], "t", "ts", "id", ["p"], 7, consume=consume)
    assert rows_of(got, "id", "touch_time", "touch_p") == sorted(want)


def test_retention_over_several_words(spark):
    """A window of 200 days needs four bit words; offsets cross their borders."""
    rng = random.Random(7)
    day = lambda: DAY0 + dt.timedelta(days=rng.randrange(200))
    member = sorted({(day(), "g", "hot" if rng.random() < 0.5 else f"a{rng.randrange(20)}") for _ in range(300)})
    active = [("hot" if rng.random() < 0.5 else f"a{rng.randrange(20)}", dt.datetime.combine(day(), dt.time(5))) for _ in range(900)]
    offsets = (1, 61, 62, 63, 130)
    seen = {(a, t.date()) for a, t in active}
    want = {}
    for d, g, a in member:
        for n in offsets:
            if (a, d + dt.timedelta(days=n)) in seen:
                want.setdefault((d, g), dict.fromkeys(offsets, 0))[n] += 1
    got = retention(spark.createDataFrame(member, "reg_date date, game_id string, acc string"), spark.createDataFrame(active, "acc string, t timestamp"),
                    ["acc"], ["reg_date", "game_id"], offsets, "t", DAY0, DAY0 + dt.timedelta(days=199))
    assert rows_of(got, "reg_date", "game_id", *[f"retained_{n}day" for n in offsets]) == sorted((*k, *v.values()) for k, v in want.items())


def test_both_ltv_forms_agree(spark):
    rng = random.Random(11)
    member = [(DAY0 + dt.timedelta(days=rng.randrange(5)), f"g{i % 3}", f"a{i}") for i in range(40)]
    spend = spark.createDataFrame([("a0" if rng.random() < 0.4 else f"a{rng.randrange(45)}", DAY0 + dt.timedelta(days=i % 60)) for i in range(300)], "acc string, order_date date")
    spend = spend.groupBy("acc", "order_date").agg(F.count("*").alias("amount"))
    cohort = spark.createDataFrame(member, "reg_date date, game_id string, acc string")
    horizons = (1, 2, 7, 30)
    one = ltv(cohort, spend, ["acc"], ["reg_date", "game_id"], horizons, account="acc")
    two = ltv_by_join(cohort, spend, ["acc"], ["reg_date", "game_id"], horizons)
    cols = ["reg_date", "game_id", "accounts", *[f"ltv_{n}day" for n in horizons]]
    assert rows_of(one, *cols) == rows_of(two, *cols)
    assert sum(r.accounts for r in one.collect()) == 40


def test_merges(spark):
    old = spark.createDataFrame([(1, 10, "a"), (2, 20, "b")], "k int, n int, s string")
    new = spark.createDataFrame([(2, 5, "c"), (3, 7, "d")], "k int, n int, s string")
    assert rows_of(merge.merge_replace(old, new, ["k"]), "k", "n", "s") == [(1, 10, "a"), (2, 5, "c"), (3, 7, "d")]
    assert rows_of(merge.merge_replace(old, new, ["k"], ["n"]), "k", "n", "s") == [(1, 10, "a"), (2, 5, "b"), (3, 7, "d")]
    assert rows_of(merge.merge_add(old, new, ["k"], ["n"], ["s"]), "k", "n", "s") == [(1, 10, "a"), (2, 25, "c"), (3, 7, "d")]
    assert rows_of(merge.merge_greatest(old, new, ["k"], ["n"], ["s"]), "k", "n", "s") == [(1, 10, "a"), (2, 20, "c"), (3, 7, "d")]
    assert rows_of(merge.append_new(old, new.union(new), ["k"]), "k", "n") == [(3, 7)]
    assert rows_of(merge.reset_where(old, F.col("k") == 1, ["n"]), "k", "n") == [(1, 0), (2, 20)]
    assert rows_of(merge.delete_where(old, F.col("s") == "a"), "k") == [(2,)]


def test_partition_overwrite_keeps_other_days(spark):
    path = shared_dir(spark, "days")
    merge.overwrite_days(spark.createDataFrame([("a", 1), ("b", 2)], "day string, n int"), path, "day")
    merge.overwrite_days(spark.createDataFrame([("b", 3)], "day string, n int"), path, "day")
    assert rows_of(spark.read.schema("n int, day string").parquet(path), "day", "n") == [("a", 1), ("b", 3)]


def test_device_registering_in_two_hours_of_its_first_day(spark):
    at = lambda text: dt.datetime.fromisoformat(text)
    regi = spark.createDataFrame([
        (1, "d", "a", at("2024-01-01 10:10:00")), (1, "d", "b", at("2024-01-01 11:10:00")), (1, "d", "c", at("2024-01-02 11:10:00")),
    ], "game_id int, imei string, game_account string, reg_time timestamp")
    cols = ["regi_accounts", "new_regi_accounts", "regi_devices", "new_regi_devices"]
    assert rows_of(kpi.registration_kpi(regi, kpi.OPERA), "day", *cols) == [("2024-01-01", 2, 2, 1, 1), ("2024-01-02", 1, 0, 1, 0)]
    hours = rows_of(kpi.registration_kpi(regi, kpi.OPERA, "hour"), "hour", "new_regi_devices")
    assert hours == [("2024-01-01 10", 1), ("2024-01-01 11", 1), ("2024-01-02 11", 0)]
