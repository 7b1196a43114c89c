"""What must not grow with the input: calls to state, files of a day, rows of one task."""

import os

from pyspark.sql import Row

from playcohort.streaming import state
from playcohort.streaming.details import DAY_FILES, DetailTable
from suite.adapter import Tables, forget_landed
from tests.test_state_calls import added_up, fed, hours

DEVICES = [("opera" if i % 2 else "market", i % 5, "", "", "", None if i == 7 else f'd"{i}') for i in range(200)]


def device_rows(times):
    return {d: [Row(**dict(zip(state.DEVICE, d, strict=True)), hour=at[:13]) for at in times[i % 3:]] for i, d in enumerate(DEVICES)}


def test_bundle_calls_do_not_grow_with_its_entities():
    """A bundle finds what its entities find by themselves, also over later batches that move first days."""
    batches = [device_rows(hours(20, 40)), device_rows(hours(3, 20))]
    for one in (state.Registrations, state.Activations):
        single = [r for d in DEVICES for r in fed(one(), d, *[b[d] for b in batches])[0]]
        out, calls = fed(state.Bundle(one(), state.DEVICE), (1,), *[[r for d in DEVICES for r in b[d]] for b in batches])
        assert added_up(out) == added_up(single) and max(calls) <= 6


def test_bundle_of_accounts_moves_what_was_paid_before_a_registration():
    place = {"parent_channel": None, "child_channel": None, "pkg_code": None}
    order = lambda a, i, at: Row(game_account=a, time=at, game_id=i % 3, **place, order_no=f"o{i}", money=3, price=2)
    regi = lambda a: Row(game_account=a, time="2024-01-02 10:00:00", game_id=7, parent_channel="m", child_channel="s", pkg_code="p", order_no=None, money=None, price=None)
    accounts = [f"a{i}" for i in range(100)]
    batches = [{a: [order(a, i, at) for i, at in enumerate(hours(25, 50))] for a in accounts}, {a: [regi(a)] if i % 2 else [] for i, a in enumerate(accounts)},
               {a: [order(a, 99, "2024-02-03 04:05:06")] for a in accounts}]
    single = [r for a in accounts for r in fed(state.Payments(), (a,), *[b[a] for b in batches if b[a]])[0]]
    out, calls = fed(state.Bundle(state.Payments(), ["game_account"]), (1,), *[[r for a in accounts for r in b[a]] for b in batches])
    assert added_up(out) == added_up(single) and max(calls) <= 7


def test_files_of_a_day_do_not_grow_with_the_tasks(spark):
    from playcohort.session import shared_dir

    table = DetailTable(spark, shared_dir(spark, "files-test"), "k bigint, t timestamp", "t")
    rows = spark.range(0, 4000, 1, 16).selectExpr("id AS k", "timestamp '2024-01-01 00:00:00' + make_interval(0, 0, 0, id % 3) AS t")
    assert table.write(rows, 0).count() == 4000
    files = table.read().inputFiles()
    assert {f.split("day=")[1][:10] for f in files} == {"2024-01-01", "2024-01-02", "2024-01-03"} and len(files) <= 3 * DAY_FILES


def test_events_of_one_file_are_landed_by_many_tasks(spark, tmp_path):
    kinds = ["signup", "view", "error", "click", "purchase"]
    rows = [(i, f"2024-01-{1 + i % 30:02d} 10:00:00", i % 70, kinds[i % 5], 1.5) for i in range(2000)]
    events = spark.createDataFrame(rows, "event_id bigint, ts string, user_id bigint, event_type string, value double")
    events.withColumn("ts", events.ts.cast("timestamp")).coalesce(1).write.parquet(os.path.join(tmp_path, "events.parquet"))
    forget_landed()
    try:
        landed = Tables(spark, str(tmp_path)).ev
        assert landed.count() == 2000 and landed.select("event_id").distinct().count() == 2000
        assert len(landed.filter("event_type = 'click'").inputFiles()) > len(kinds)
    finally:
        forget_landed()
