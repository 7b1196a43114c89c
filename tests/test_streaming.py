"""Micro-batches in any order, and replayed ones, give the batch result."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from playcohort.operators import kpi
from playcohort.plans import jobs
from playcohort.session import shared_dir
from playcohort.sources import records
from playcohort.sources.logs import parse_log
from playcohort.streaming.details import DetailTable, change, total
from playcohort.sources.tables import file_lines
from playcohort.streaming import pipelines, state
from playcohort.streaming.pipelines import AccountPipeline, KpiPipeline

HEAD = "2024-01-01 10:00:00,001 [INFO] bi: "


def active(imei, time):
    return f"{HEAD}bi_active|1|x|x|m_s_p|{time}|x|android|{imei}"


def order(number, time, account="a1"):
    return f"{HEAD}bi_order|x|{number}|x|x|{account}|{time}|12|x|x|30.00|x|x|5.00|x|x|x|x|x|4|x|x|6|x|dev-1"


def frame(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


BATCHES = [
    [active("d1", "2024-01-02 10:00:00"), active("d2", "2024-01-02 11:00:00")],
    [active("d1", "2024-01-01 09:00:00"), active("d3", "2024-01-02 11:30:00")],  # d1 was active earlier than known
    [active("d1", "2024-01-03 09:00:00")],
]


def regi(account, imei, time, channel="m_s_p"):
    return f"{HEAD}bi_regi|r|x|{account}|12|{time}|8|x|77|x|x|android|x|{channel}|{imei}"


def replayed(spark, path, batches, breaks_after=None, pipeline=None):
    """The pipeline after all batches, a file each; it may die once after a batch was written and start again."""
    pipeline = pipeline or KpiPipeline(spark, shared_dir(spark, "kpi-test"))
    if not os.path.exists(path):
        write_files(path, [(1_700_000_000 + 60 * i, batch) for i, batch in enumerate(batches)])
    if breaks_after is not None:
        write = pipeline.tables["registration_changes"].write

        def breaks(rows, batch):
            write(rows, batch)
            if batch == breaks_after:
                raise RuntimeError("lost after the batch was written")

        state.use_state_store(spark)
        query = pipelines.start(state.registration_changes(file_lines(spark, path, files_per_trigger=1)), breaks, f"{pipeline.base}-checkpoint/registration")
        with pytest.raises(Exception, match="lost after"):
            query.awaitTermination()
    pipeline.start(file_lines(spark, path, files_per_trigger=1), in_turn=True)
    return pipeline


def test_late_earlier_activation_is_moved_and_repeats_are_harmless(spark, tmp_path):
    pipeline = replayed(spark, str(tmp_path / "lines"), [BATCHES[0], BATCHES[1], BATCHES[1], BATCHES[2]])
    changes = pipeline.tables["activation_changes"].read().filter("name = 'activation'")
    assert rows_of(changes.filter("m[0] < 0").selectExpr("at")) == [("2024-01-02 10",)]
    got = rows_of(pipeline.report("activation").select("hour", "active_num"))
    every = parse_log(frame(spark, *sum(BATCHES, [])), "active")[0]
    want = rows_of(kpi.activation_kpi(jobs.ch.with_channel_parts(every, "expand_channel"), kpi.MARKET).select("hour", "active_num"))
    assert got == want == [("2024-01-01 09", 1), ("2024-01-02 11", 2)]


REGI_BATCHES = [
    [regi("a1", "d1", "2024-01-03 10:00:00"), regi("a2", "d1", "2024-01-03 10:30:00"), regi("a2", "d1", "2024-01-03 11:00:00"), order("o1", "2024-01-03 12:00:00")],
    [regi("a3", "d1", "2024-01-02 23:00:00"), regi("a1", "d1", "2024-01-03 10:59:59"), regi("a9", "d2", "2024-01-05 00:00:00")],  # an earlier first day; a repeat within its hour
    [regi("a1", "d1", "2024-01-01 08:00:00", "x_y_z"), order("o2", "2024-01-04 00:30:00"), order("o1", "2024-01-03 12:00:00")],  # other channel; the payer's first registration moves
]


def registered(spark, batches, grain, unit):
    every = parse_log(frame(spark, *sum(batches, [])), "regi")[0]
    return rows_of(kpi.registration_kpi(jobs.ch.with_channel_parts(every, "expand_channel"), grain, unit))


def test_registration_state_equals_the_whole_log_after_a_restart(spark, tmp_path):
    """In any order of batches, also with one that is replayed after the query has died behind its output."""
    for order_of, breaks in (((0, 1, 2), 1), ((2, 0, 1), None)):
        pipeline = replayed(spark, str(tmp_path / f"lines{order_of[0]}"), [REGI_BATCHES[i] for i in order_of], breaks)
        for name, grain, unit in (("registration", kpi.MARKET, "day"), ("registration_hour", kpi.MARKET, "hour"), ("registration_opera", kpi.OPERA, "day"), ("registration_opera_hour", kpi.OPERA, "hour")):
            assert rows_of(pipeline.report(name)) == registered(spark, REGI_BATCHES, grain, unit)
        assert rows_of(pipeline.report("first_payer")) == [(datetime.date(2024, 1, 1), 12, 1)]
        assert rows_of(pipeline.report("money").select("day", "parent_channel", "pay_money")) == [("2024-01-03", "x", 3500), ("2024-01-04", "x", 3500)]
        ltv = pipeline.report("ltv").select("reg_date", "recharge", "ltv_1day", "ltv_3day", "ltv_7day")
        assert rows_of(ltv) == [(datetime.date(2024, 1, 1), 6000, 0, 3000, 6000)]


def test_no_batch_of_entity_state_reads_history(spark, tmp_path):
    """The plan of a batch has one source, its own lines, and state beside it."""
    path = str(tmp_path / "lines")
    write_files(path, [(1_700_000_000, REGI_BATCHES[0])])
    for changes in pipelines.CHANGES.values():
        plan = changes(file_lines(spark, path))._jdf.queryExecution().analyzed().toString()
        assert "TransformWithState" in plan and "parquet" not in plan and "Join" not in plan


def test_account_master_keeps_the_greatest_times(spark):
    def regi(time):
        return f"{HEAD}bi_regi|r|x|A1|12|{time}|8|x|77"

    pipeline = AccountPipeline(spark, shared_dir(spark, "account-test"))
    pipeline.process(frame(spark, regi("2024-01-03 00:00:00"), f"{HEAD}bi_login|l|x|a1|2024-01-05 00:00:00|x|x|x|12"), 0)
    pipeline.process(frame(spark, regi("2024-01-02 00:00:00"), f"{HEAD}bi_order|x|o|x|x|a1|2024-01-05 00:00:00|12"), 1)
    (row,) = pipeline.master().select("game_account", "owner_id", "user_type", F.col("regi_time").cast("string"), F.col("last_login_time").cast("string"), "is_recharge").collect()
    assert tuple(row) == ("a1", "77", 1, "2024-01-03 00:00:00", "2024-01-05 00:00:00", 1)


def test_detail_table_keeps_each_key_once(spark):
    table = DetailTable(spark, shared_dir(spark, "detail-test"), "k int, v string")
    assert table.read().count() == 0
    table.append_new(spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string"), 0, ["k"])
    table.append_new(spark.createDataFrame([(2, "b"), (3, "c")], "k int, v string"), 1, ["k"])
    assert rows_of(table.read()) == [(1, "a"), (2, "b"), (3, "c")]
    assert rows_of(table.read(before=1)) == [(1, "a"), (2, "b")]


def test_changes_add_up(spark):
    rows = spark.createDataFrame([("e1", 1), ("e1", 2), ("e2", 1)], "e string, day int")
    firsts = lambda df: df.groupBy("e").agg(F.min("day").alias("day")).groupBy("day").agg(F.count("*").alias("n"))
    before, fresh = rows.filter("day = 2 OR e = 'e2'"), rows.filter("day = 1 AND e = 'e1'")
    touched = before.join(fresh.select("e").distinct(), "e", "left_semi")
    delta = change(firsts(touched), firsts(touched.unionByName(fresh)), ["day"])
    assert rows_of(total(firsts(before).unionByName(delta), ["day"])) == rows_of(firsts(rows)) == [(1, 2)]


def test_days_prune_the_check_and_an_empty_batch_is_fine(spark):
    table = DetailTable(spark, shared_dir(spark, "day-test"), "k int, t timestamp", time="t")
    rows = spark.sql("SELECT k, timestamp '2024-01-01 10:00:00' + make_dt_interval(k) AS t FROM (SELECT explode(sequence(0, 4)) AS k)")
    table.append_new(rows, 0, ["k", "t"])
    table.append_new(rows.filter("k < 2").union(rows.filter("k < 2").selectExpr("k + 10", "t")), 1, ["k", "t"])
    table.append_new(rows.filter("k > 99"), 2, ["k", "t"])
    assert sorted(r.k for r in table.read().collect()) == [0, 1, 2, 3, 4, 10, 11]


def write_files(path, files):
    """Text files with their times of arrival, in seconds."""
    os.makedirs(path)
    for i, (arrived, texts) in enumerate(files):
        name = f"{path}/{i}.txt"
        with open(name, "w") as out:
            out.write("\n".join(texts))
        os.utime(name, (arrived, arrived))


def streamed(spark, path, step):
    out = f"{path}-out"
    rows = step(file_lines(spark, path, files_per_trigger=1, arrival=True))
    rows.writeStream.format("parquet").option("checkpointLocation", f"{path}-checkpoint").trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


def test_late_orders_are_kept_and_repeats_dropped_across_batches(spark, tmp_path):
    now, path = 1_700_000_000, str(tmp_path / "orders")
    write_files(path, [
        (now, [order("o1", "2024-01-05 10:00:00"), order("o1", "2024-01-05 10:00:00")]),
        (now + 60, [order("o2", "2024-01-05 07:30:00"), order("o1", "2024-01-05 10:00:00")]),  # 2.5 hours late, and a repeat
        (now + 120, [order("o3", "2024-01-02 10:00:00"), order("o4", "2024-01-05 10:05:00")]),  # 3 days late
        (now + 180, [order("o5", "2024-01-05 10:06:00"), order("o2", "2024-01-05 07:30:00")]),
        (now + 9000, [order("o6", "2024-01-05 12:30:00")]),
        (now + 9060, [order("o7", "2023-12-01 00:00:00")]),  # behind every watermark on the time of the order
    ])
    got = streamed(spark, path, lambda lines: pipelines.dedup_orders(parse_log(lines, "order")[0]))
    assert sorted(r.order_no for r in got.collect()) == ["o1", "o2", "o3", "o4", "o5", "o6", "o7"]


def test_first_of_day_keeps_late_days(spark, tmp_path):
    def login(time, device):
        return f"{HEAD}bi_login|l1|x|a1|{time}|x|m_s_p|{device}|12"

    now, path = 1_700_000_000, str(tmp_path / "logins")
    write_files(path, [
        (now, [login("2024-01-05 10:00:00", "d1"), login("2024-01-05 11:00:00", "d1")]),
        (now + 60, [login("2024-01-02 10:00:00", "d1"), login("2024-01-05 09:00:00", "d1")]),
        (now + 120, [login("2024-01-02 12:00:00", "d1"), login("2024-01-05 10:00:00", "d2")]),
        (now + 180, [login("2024-01-01 12:00:00", "d2"), login("2024-01-05 23:00:00", "d2")]),
    ])
    got = streamed(spark, path, lambda lines: pipelines.first_of_day(parse_log(lines, "login")[0], ["game_id", "imei"], "login_time"))
    assert sorted((r.day, r.imei) for r in got.collect()) == [("2024-01-01", "d2"), ("2024-01-02", "d1"), ("2024-01-05", "d1"), ("2024-01-05", "d2")]


ACCOUNT_BATCHES = [
    [f"{HEAD}bi_regi|r|x|A1|12|2024-01-03 00:00:00|8|x|77"],
    [f"{HEAD}bi_login|l|x|a1|2024-01-05 00:00:00|x|x|x|12", f"{HEAD}bi_login|l|x|a2|2024-01-04 00:00:00|x|x|x|12"],
    [f"{HEAD}bi_order|x|o|x|x|a2|2024-01-05 00:00:00|12"],
]
ACCOUNTS = [("a1", "2024-01-05 00:00:00", 0), ("a2", "2024-01-04 00:00:00", 1)]


def accounts_of(pipeline):
    return rows_of(pipeline.master().select("game_account", F.col("last_login_time").cast("string"), F.coalesce("is_recharge", F.lit(0))))


def test_a_restart_continues_from_the_checkpoint(spark, tmp_path):
    """A query that dies in the middle of the stream goes on where it stopped, and replays the broken batch."""
    path, pipeline = str(tmp_path / "lines"), AccountPipeline(spark, shared_dir(spark, "restart-test"))
    write_files(path, [(1_700_000_000 + 60 * i, batch) for i, batch in enumerate(ACCOUNT_BATCHES)])

    def breaks(lines, batch):
        pipeline.process(lines, batch)
        if batch == 1:
            raise RuntimeError("lost after the batch was written")

    run = lambda process: pipelines.start(file_lines(spark, path, files_per_trigger=1), process, f"{path}-checkpoint")
    query = run(breaks)
    try:
        query.awaitTermination()
    except Exception as error:
        assert "lost after" in str(error)
    else:
        raise AssertionError("the query should have failed")
    seen = []
    run(lambda lines, batch: (seen.append(batch), pipeline.process(lines, batch))).awaitTermination()
    assert seen == [1, 2] and accounts_of(pipeline) == ACCOUNTS


def test_a_timed_trigger_runs_until_it_is_stopped(spark, tmp_path):
    path, pipeline = str(tmp_path / "lines"), AccountPipeline(spark, shared_dir(spark, "timed-test"))
    write_files(path, [(1_700_000_000 + 60 * i, batch) for i, batch in enumerate(ACCOUNT_BATCHES)])
    query = pipelines.start(file_lines(spark, path, files_per_trigger=1), pipeline.process, f"{path}-checkpoint", interval="1 second")
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert accounts_of(pipeline) == ACCOUNTS


def wall(kind, imei, time, game="12"):
    device = "" if imei is None else f'"imei":"{imei}",'
    return f'{{"adv_name":"bi_adv_money_{kind}",{device}"game_id":"{game}","ts":"{time}"}}'


def platform(imei, time, game="12"):
    return active(imei, time).replace("bi_active|1|", f"bi_active|{game}|")


WALL_BATCHES = [
    [wall("click", "d1", "2024-01-03 10:00:00"), wall("active", "d1", "2024-01-03 10:05:00"), wall("active", "d1", "2024-01-05 10:00:00"), platform("d1", "2024-01-05 09:00:00"),
     wall("active", None, "2024-01-03 08:00:00"), wall("click", None, "2024-01-03 08:00:00"), '{"adv_name":'],
    # an earlier first click and activation of a day, in another game; a registration between two activations; clicks that come again count again
    [wall("click", "d1", "2024-01-03 09:00:00", "13"), wall("click", "d1", "2024-01-03 10:00:00"), wall("active", "d1", "2024-01-03 01:00:00", "13"), regi("a1", "d1", "2024-01-04 10:00:00"),
     wall("active", None, "2024-01-04 08:00:00"), platform("", "2024-01-01 08:00:00")],
    # an own activation and a registration before all others
    [platform("d1", "2024-01-01 09:00:00"), regi("a1", "d1", "2024-01-03 00:00:00"), wall("active", "d2", "2024-01-03 01:00:00"), wall("active", "d1", "2024-01-02 23:00:00"), '{"adv_name":'],
]


def test_wall_state_equals_the_whole_log_in_any_order(spark, tmp_path):
    lines = frame(spark, *sum(WALL_BATCHES, []))
    events = records.parse_wall(lines).withColumn("game_id", F.col("game_id").cast("int"))
    clicks, actives = (events.filter(F.col("adv_name") == n) for n in (records.WALL_CLICK, records.WALL_ACTIVE))
    whole = kpi.wall_kpi(clicks, actives, parse_log(lines, "active")[0], parse_log(lines, "regi")[0])
    whole = whole.withColumn("day", F.col("day").cast("string"))
    for order_of in ((0, 1, 2), (2, 1, 0)):
        path = str(tmp_path / f"wall{order_of[0]}")
        write_files(path, [(1_700_000_000 + 60 * n, WALL_BATCHES[i]) for n, i in enumerate(order_of)])
        pipeline = pipelines.WallPipeline(spark, shared_dir(spark, "wall-test"))
        pipeline.start(file_lines(spark, path, files_per_trigger=1), in_turn=True)
        assert rows_of(pipeline.report().select(whole.columns)) == rows_of(whole)
        assert rows_of(pipeline.rejects()) == [('{"adv_name":', 2)]
        changes = pipeline.tables["changes"].read()
        # in the first order late lines prove earlier flags wrong, in the other none does
        assert (changes.filter("exists(m, x -> x < 0)").count() > 0) == (order_of[0] == 0)
    plan = state.wall_changes(file_lines(spark, path))._jdf.queryExecution().analyzed().toString()
    assert "TransformWithState" in plan and "parquet" not in plan and "Join" not in plan
