"""Streaming jobs replayed from files of shuffled lines; each must give what the batch job gives."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playcohort import constants as C
from playcohort.operators import attribution, kpi
from playcohort.session import materialize, shared_dir
from playcohort.sources.logs import parse_log
from playcohort.sources.tables import file_lines
from playcohort.streaming import pipelines, touches
from suite import lines
from suite.kpis import (ACTIVE, ACTS, CLICK_ROWS, HOUR, LATEST_CLICKS, LATEST_SPEC, LOGIN_OUT, LOGIN_SPLIT, ORDER_LOG, ORDER_STATS, REGI_OUT, REGS, STAT, STAT_SPEC, WALL, WALL_SPEC,
                        _login_kpi, _registration, first_per_day)
from suite.lines import GOOD
from suite.registry import query
from suite.reports import CH_SPEC, MARKET, parts

EMPTY = "coalesce(channel, '')"
# published: the given games and those announced by well-formed lines, which is every game but multiples of 45
PUBLISHED = "(SELECT n_nationkey FROM nation WHERE n_nationkey % 9 <> 0 UNION SELECT game_id FROM publish_game)"


def replay(t, made: DataFrame, purpose: str, batches: int = 5, arrival: bool = False) -> DataFrame:
    """The lines as a stream of text files, in an order unrelated to their times; some lines come again in another file.

    A batch takes as many files as let all tasks write at once: with a file per batch, five tasks would write all lines.
    """
    path, files = shared_dir(t.spark, purpose), -(-t.spark.sparkContext.defaultParallelism // batches)
    again = made.filter(F.pmod(F.xxhash64("value"), F.lit(5)) == 0) if arrival else made.limit(0)
    # round robin: copies of a line end up in different files
    made.union(again).repartition(batches * files).write.text(path)
    return file_lines(t.spark, path, files_per_trigger=files, arrival=arrival)


def run(t, made: DataFrame, make, purpose: str):
    pipeline = make(t.spark, shared_dir(t.spark, purpose))
    pipelines.start(replay(t, made, f"{purpose}-lines"), pipeline.process, f"{pipeline.base}-checkpoint").awaitTermination()
    return pipeline


_KPI: dict[tuple[str, str], pipelines.KpiPipeline] = {}


def kpi_pipeline(t) -> pipelines.KpiPipeline:
    """One replay per application and folder serves all reports of the pipeline."""
    key = (t.spark.sparkContext.applicationId, t.dir)
    if key not in _KPI:
        makers = (lines.regi_lines, lines.login_lines, lines.active_lines, lines.order_lines, lines.channel_lines, lines.request_lines)
        made = lines.pubgame_lines(t.nation)
        for make in makers:
            made = made.union(make(t.ev))
        pipeline = pipelines.KpiPipeline(t.spark, shared_dir(t.spark, "kpi"), landing=lines.LANDING)
        pipelines.finish(pipeline.start(replay(t, made, "kpi-lines")))
        _KPI[key] = pipeline
    return _KPI[key]


@query("job20_stream_kpi", f"day:s game_id:i {CH_SPEC} {REGI_OUT}", f"""
    WITH r AS (SELECT u AS acc, game_id, ts AS reg_time, {parts(EMPTY)}, imei FROM ev WHERE event_type = 'signup' AND {GOOD} AND game_id IN {PUBLISHED}),
    h AS (SELECT {HOUR.format('reg_time')} AS hour, {MARKET}, imei, count(DISTINCT acc) AS n FROM r GROUP BY ALL),
    f AS (SELECT *, hour[1:10] AS day, min(hour[1:10]) OVER (PARTITION BY {MARKET}, imei) AS fd FROM h)
    SELECT day, {MARKET}, sum(n) AS regi_accounts, sum(CASE WHEN day = fd THEN n ELSE 0 END) AS new_regi_accounts,
           count(DISTINCT imei) AS regi_devices, count(DISTINCT CASE WHEN day = fd THEN imei END) AS new_regi_devices FROM f GROUP BY day, {MARKET}""")
def stream_registration(t):
    return kpi_pipeline(t).report("registration", t.publish_game)


@query("job20_stream_activation", f"hour:s game_id:i {CH_SPEC} active_num:i", f"""
    WITH a AS (SELECT game_id, ts, {parts(EMPTY)}, imei FROM ev WHERE event_type = 'error' AND {GOOD} AND game_id IN {PUBLISHED}),
    m AS (SELECT {MARKET}, imei, min(ts) AS t FROM a GROUP BY ALL)
    SELECT {HOUR.format('t')} AS hour, {MARKET}, count(*) AS active_num FROM m GROUP BY ALL""")
def stream_activation(t):
    return kpi_pipeline(t).report("activation", t.publish_game)


STREAM_ORDERS = f"""o AS (SELECT DISTINCT event_id, 'u' || u AS acc, ts AS order_time, game_id, amount AS ori_price, CASE WHEN event_id % 4 = 0 THEN 0 ELSE event_id % 3 END AS total_amt, imei
        FROM ev WHERE event_type = 'purchase' AND event_id % 10 > 1 AND event_id % 7 <> 0 AND {GOOD}),
    r AS (SELECT 'u' || u AS acc, game_id, ts AS reg_time, {parts(EMPTY)}, imei FROM ev WHERE event_type = 'signup' AND {GOOD}),
    m AS (SELECT acc, cast(reg_time AS date) AS reg_date, game_id AS reg_game_id, parent_channel, child_channel, pkg_code FROM r
          QUALIFY row_number() OVER (PARTITION BY acc ORDER BY reg_time, game_id, parent_channel, child_channel, pkg_code) = 1),
    p AS (SELECT o.*, reg_date, coalesce(reg_game_id, 0) AS reg_game_id, coalesce(parent_channel, 'no_acc') AS parent_channel, coalesce(child_channel, '') AS child_channel,
                 coalesce(pkg_code, '') AS pkg_code FROM o LEFT JOIN m ON m.acc = o.acc)"""


@query("job20_stream_pay_money", f"day:s game_id:i {CH_SPEC} pay_money:i",
       f"WITH {STREAM_ORDERS} SELECT cast(order_time AS date) AS day, {MARKET}, sum(ori_price + total_amt) * 100 AS pay_money FROM p GROUP BY ALL")
def stream_money(t):
    return kpi_pipeline(t).report("money")


@query("job20_stream_pay_accounts", f"day:s game_id:i {CH_SPEC} pay_accounts:i",
       f"WITH {STREAM_ORDERS} SELECT cast(order_time AS date) AS day, {MARKET}, count(DISTINCT acc) AS pay_accounts FROM p GROUP BY ALL")
def stream_payers(t):
    return kpi_pipeline(t).report("payer")


_OFF = "date_diff('day', reg_date, cast(order_time AS date))"


@query("job20_stream_pay_ltv", "reg_date:s reg_game_id:i recharge:i " + " ".join(f"ltv_{n}day:i" for n in C.PAY_LTV),
       f"WITH {STREAM_ORDERS} SELECT reg_date, reg_game_id, sum(ori_price) * 100 AS recharge, sum(CASE WHEN {_OFF} = 0 THEN ori_price ELSE 0 END) * 100 AS ltv_1day, "
       + ", ".join(f"sum(CASE WHEN {_OFF} <= {n - 1} THEN ori_price ELSE 0 END) * 100 AS ltv_{n}day" for n in C.PAY_LTV[1:]) + " FROM p GROUP BY ALL")
def stream_ltv(t):
    return kpi_pipeline(t).report("ltv")


@query("job20_stream_click_uv", f"publish_time:s game_id:i {CH_SPEC} show_uv:i download_uv:i adpage_click_uv:i request_click_uv:i", f"""
    WITH c AS (SELECT cast(ts AS date) AS publish_time, game_id, channel, cast(event_id % 4 + 1 AS int) AS type, '10.0.0.' || (u % 50) AS ip FROM ev WHERE event_type = 'click' AND {GOOD}
               UNION ALL SELECT cast(ts AS date), game_id, 'm' || (u % 3) || '_s' || (u % 5) || '_p' || (u % 11), 4, '10.0.0.' || (u % 50)
               FROM ev WHERE event_type = 'click' AND event_id % 11 <> 0 AND event_id % 13 <> 0 AND event_id % 17 <> 0),
    d AS (SELECT DISTINCT publish_time, game_id, {parts(EMPTY)}, type, ip FROM c WHERE game_id IN {PUBLISHED})
    SELECT publish_time, {MARKET}, sum(CASE WHEN type = 1 THEN 1 ELSE 0 END) AS show_uv, sum(CASE WHEN type = 2 THEN 1 ELSE 0 END) AS download_uv,
           sum(CASE WHEN type = 3 THEN 1 ELSE 0 END) AS adpage_click_uv, sum(CASE WHEN type = 4 THEN 1 ELSE 0 END) AS request_click_uv FROM d GROUP BY ALL""")
def stream_clicks(t):
    return kpi_pipeline(t).report("click", t.publish_game)


def _streamed(sql: str) -> str:
    """A batch KPI's SQL over what the well-formed lines carry."""
    rows = {
        "login": f"SELECT 'u' || u AS game_account, ts AS login_time, game_id, {EMPTY} AS channel_expand, imei FROM ev WHERE event_type = 'view' AND {GOOD}",
        "regi": f"SELECT event_id, 'u' || u AS game_account, ts AS reg_time, game_id, {EMPTY} AS expand_channel, imei, os FROM ev WHERE event_type = 'signup' AND {GOOD}",
        "active": f"SELECT event_id, game_id, ts AS active_time, {EMPTY} AS expand_channel, imei, os FROM ev WHERE event_type = 'error' AND {GOOD}",
    }
    for table, body in rows.items():
        sql = sql.replace(f"FROM {table} WHERE game_id IN (SELECT game_id FROM publish_game)", f"FROM ({body}) {table} WHERE game_id IN {PUBLISHED}")
    return sql


@query("job20_stream_login", f"day:s game_id:i {CH_SPEC} {LOGIN_OUT}", _streamed(_login_kpi(MARKET, True)))
def stream_login(t):
    return kpi_pipeline(t).login_report(t.publish_game)


@query("job20_stream_login_opera", f"day:s game_id:i {LOGIN_OUT}", _streamed(_login_kpi("game_id", False)))
def stream_login_opera(t):
    return kpi_pipeline(t).login_report(t.publish_game, kpi.OPERA)


@query("job20_stream_login_split", f"day:s game_id:i {CH_SPEC} new_login_devices:i new_login_accounts:i dau_devices:i dau_accounts:i", _streamed(LOGIN_SPLIT))
def stream_login_split(t):
    return kpi_pipeline(t).login_split_report(t.publish_game)


@query("job20_stream_regi_hour", f"hour:s game_id:i {CH_SPEC} {REGI_OUT}", _streamed(_registration("hour", MARKET)))
def stream_registration_hour(t):
    return kpi_pipeline(t).report("registration_hour", t.publish_game)


@query("job20_stream_regi_opera", f"day:s game_id:i {REGI_OUT}", _streamed(_registration("day", "game_id")))
def stream_registration_opera(t):
    return kpi_pipeline(t).report("registration_opera", t.publish_game)


@query("job20_stream_regi_opera_hour", f"hour:s game_id:i {REGI_OUT}", _streamed(_registration("hour", "game_id")))
def stream_registration_opera_hour(t):
    return kpi_pipeline(t).report("registration_opera_hour", t.publish_game)


@query("job20_stream_activation_opera", "hour:s game_id:i active_num:i", _streamed(f"""
    WITH a AS ({ACTIVE} WHERE game_id IN (SELECT game_id FROM publish_game)), m AS (SELECT game_id, imei, min(active_time) AS t FROM a GROUP BY ALL)
    SELECT {HOUR.format('t')} AS hour, game_id, count(*) AS active_num FROM m GROUP BY ALL"""))
def stream_activation_opera(t):
    return kpi_pipeline(t).report("activation_opera", t.publish_game)


@query("job20_stream_pay_money_hour", f"hour:s game_id:i {CH_SPEC} pay_money:i",
       f"WITH {STREAM_ORDERS} SELECT {HOUR.format('order_time')} AS hour, {MARKET}, sum(ori_price + total_amt) * 100 AS pay_money FROM p GROUP BY ALL")
def stream_money_hour(t):
    return kpi_pipeline(t).report("money_hour")


@query("job20_stream_pay_accounts_hour", f"hour:s game_id:i {CH_SPEC} pay_accounts:i",
       f"WITH {STREAM_ORDERS} SELECT {HOUR.format('order_time')} AS hour, {MARKET}, count(DISTINCT acc) AS pay_accounts FROM p GROUP BY ALL")
def stream_payers_hour(t):
    return kpi_pipeline(t).report("payer_hour")


@query("job20_stream_first_payers", "reg_date:s reg_game_id:i recharge_accounts:i",
       f"WITH {STREAM_ORDERS} SELECT reg_date, reg_game_id, count(DISTINCT acc) AS recharge_accounts FROM p GROUP BY ALL")
def stream_first_payers(t):
    return kpi_pipeline(t).report("first_payer")


@query("job20_stream_pay_devices", "day:s game_id:i pay_devices:i",
       f"WITH {STREAM_ORDERS} SELECT cast(order_time AS date) AS day, game_id, count(DISTINCT imei) AS pay_devices FROM o GROUP BY ALL")
def stream_pay_devices(t):
    return kpi_pipeline(t).pay_device_report()


def _streamed_wall() -> str:
    own = f"(SELECT event_id, game_id, imei, ts AS {{0}} FROM ev WHERE event_type = '{{1}}' AND {GOOD}) {{2}}"
    sql = WALL
    for table, kind in (("wall_active", "view"), ("wall_click", "click")):
        sql = sql.replace(f"FROM {table}", f"FROM (SELECT game_id, imei, ts FROM ev WHERE event_type = '{kind}' AND event_id % 21 <> 0) {table}")
    sql = re.sub(r"\bFROM active\b", "FROM " + own.format("active_time", "error", "active"), sql)
    return re.sub(r"\bFROM regi\b", "FROM " + own.format("reg_time", "signup", "regi"), sql)


_WALL: dict[tuple[str, str], pipelines.WallPipeline] = {}


def wall_pipeline(t) -> pipelines.WallPipeline:
    """One replay per application and folder, as of ``kpi_pipeline``."""
    key = (t.spark.sparkContext.applicationId, t.dir)
    if key not in _WALL:
        made = lines.wall_lines(t.ev).union(lines.active_lines(t.ev)).union(lines.regi_lines(t.ev))
        pipeline = pipelines.WallPipeline(t.spark, shared_dir(t.spark, "wall"))
        pipelines.finish(pipeline.start(replay(t, made, "wall-lines")))
        _WALL[key] = pipeline
    return _WALL[key]


@query("job22_stream_wall", WALL_SPEC, f"WITH {_streamed_wall()} SELECT * FROM w")
def stream_wall(t):
    return wall_pipeline(t).report()


@query("job22_stream_wall_rejects", "value:s copies:i", """
    SELECT '{"game_id":' AS value, count(*) AS copies FROM ev WHERE event_type IN ('click', 'view') AND event_id % 21 = 0 HAVING count(*) > 0""")
def stream_wall_rejects(t):
    return wall_pipeline(t).rejects()


STREAM_CLICKS = """SELECT event_id, pkg_id, game_id, os, imei, ts, callback, adv_name, CASE WHEN adv_name = 1 THEN '' ELSE idea_id END AS idea_id,
    CASE WHEN adv_name = 2 THEN first_level ELSE '' END AS first_level, CASE WHEN adv_name = 1 THEN '' ELSE second_level END AS second_level
    FROM ad_click WHERE event_id % 19 <> 0"""
CLICK_COPY = "event_id % 5 = 0"


def _streamed_chain(sql: str) -> str:
    """The attribution SQL over what the lines carry: complete records only, each row once."""
    own = "min(event_id) AS event_id, game_id, coalesce(channel, '') AS expand_channel, imei, os"
    active = f"SELECT {own}, ts AS active_time FROM ev WHERE event_type = 'error' AND {GOOD} GROUP BY ALL"
    regi = f"SELECT {own}, 'u' || u AS game_account, ts AS reg_time FROM ev WHERE event_type = 'signup' AND {GOOD} GROUP BY ALL"
    for table, body in (("ad_click", STREAM_CLICKS), ("active", active), ("regi", regi)):
        sql = re.sub(rf"\bFROM {table}\b", f"FROM ({body}) {table}", sql)
    orders = STREAM_ORDERS[STREAM_ORDERS.index("(SELECT DISTINCT event_id"):STREAM_ORDERS.index("),\n") + 1].replace("DISTINCT event_id", "DISTINCT 'o' || event_id AS order_no")
    return sql.replace(ORDER_LOG[len("o AS "):], orders)


_CHAIN: dict[tuple[str, str], tuple[pipelines.AttributionPipeline, DataFrame, DataFrame]] = {}


def attribution_pipeline(t) -> tuple[pipelines.AttributionPipeline, DataFrame, DataFrame]:
    """The pipeline after one replay, its attributed activations and registrations; some clicks come twice."""
    key = (t.spark.sparkContext.applicationId, t.dir)
    if key not in _CHAIN:
        made = lines.ad_click_lines(t.ad_click).union(lines.ad_click_lines(t.ad_click.filter(CLICK_COPY)))
        for make in (lines.active_lines, lines.regi_lines, lines.order_lines):
            made = made.union(make(t.ev))
        pipeline = run(t, made, pipelines.AttributionPipeline, "attribution")
        acts = materialize(pipeline.activations(), "stream-activations")
        _CHAIN[key] = (pipeline, acts, materialize(pipeline.registrations(acts), "stream-registrations"))
    return _CHAIN[key]


@query("job21_stream_attribution", f"day:s {STAT_SPEC} regi_num:i",
       f"WITH {_streamed_chain(REGS)} SELECT cast(reg_time AS date) AS day, {STAT}, count(*) AS regi_num FROM regs GROUP BY ALL")
def stream_attribution(t):
    return attribution.registration_stats(attribution_pipeline(t)[2]).select("day", *STAT.split(", "), "regi_num")


@query("job21_stream_activations", f"day:s {STAT_SPEC} active_num:i",
       f"WITH {_streamed_chain(ACTS)} SELECT cast(active_time AS date) AS day, {STAT}, count(*) AS active_num FROM acts GROUP BY ALL")
def stream_activations(t):
    return attribution.activation_stats(attribution_pipeline(t)[1])


_ALL_CLICKS = f"SELECT * FROM ({STREAM_CLICKS}) UNION ALL SELECT * FROM ({STREAM_CLICKS} AND {CLICK_COPY})"


@query("job21_stream_clicks", f"day:s {STAT_SPEC} click_num:i click_dev_num:i",
       first_per_day(CLICK_ROWS.replace("FROM ad_click", f"FROM ({_ALL_CLICKS}) ad_click"), "cast(ts AS date)", "medium, pkg_code, imei", "ts, event_id", "click_num", "click_dev_num"))
def stream_click_stats(t):
    return attribution_pipeline(t)[0].click_stats()


@query("job21_stream_orders", f"day:s {STAT_SPEC} pay_price:i pay_accounts:i new_pay_price:i new_pay_accounts:i",
       f"WITH {_streamed_chain(ORDER_STATS)} SELECT * FROM ostat")
def stream_order_stats(t):
    pipeline, _, regs = attribution_pipeline(t)
    return pipeline.order_stats(regs)


TIMELY, LATE_HOURS, DELAY = 6, 12, "1 day"
#: The time of a line of any kind: the second in a media record, else the first after the log's own stamp.
LINE_TIME = """CASE WHEN value LIKE 'bi_thirddata%' THEN try_cast(regexp_extract(value, '"(ts|timestamp)":"([0-9]+)"', 2) AS bigint)
    ELSE unix_timestamp(try_to_timestamp(get(regexp_extract_all(value, '[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}', 0), 1))) END"""


def timely_replay(t, made: DataFrame, closing: DataFrame, purpose: str) -> DataFrame:
    """Lines in batches of five days each, one after the other; some of a batch's last hours come with the next one.

    ``closing`` are lines far in the future, which move the watermark past everything else. A batch is as many files as tasks write at
    once, and the same number for all; with too few lines to fill them all for certain, it is one file.
    """
    path, timed_path, span, tasks = shared_dir(t.spark, purpose), shared_dir(t.spark, f"{purpose}-timed"), 5 * 86_400, t.spark.sparkContext.defaultParallelism
    at, back = F.coalesce(F.expr(LINE_TIME), F.lit(0)).cast("bigint"), F.pmod(F.xxhash64("value"), F.lit(3)) == 0
    made.select("value", at.alias("at"), back.alias("back")).withColumn("part", F.floor(F.col("at") / span)).write.partitionBy("part").parquet(timed_path)
    timed = t.spark.read.schema("value string, at bigint, back boolean, part bigint").parquet(timed_path)
    start = timed.filter("at > 0").agg(F.min("at")).first()[0] or 0
    number = F.greatest(F.lit(0), F.floor((F.col("at") - start) / span))
    late = ((F.col("at") - start) % span >= span - LATE_HOURS * 3600) & F.col("back")
    timed = timed.withColumn("file", F.least(number + F.when(late, 1).otherwise(0), F.lit(TIMELY - 1)))
    sizes = {r["file"]: r["count"] for r in timed.groupBy("file").count().collect()}
    # of ``tasks`` readers one has ``tasks`` lines then, and deals them to all files
    files = tasks if min(sizes.get(i, 0) for i in range(TIMELY)) >= tasks * tasks else 1
    for i in range(TIMELY):
        lines = timed.filter(F.col("file") == i)
        if i > 0:  # only the parts its days lie in, and the hours before
            lines = lines.filter(F.col("part") >= (start + i * span - LATE_HOURS * 3600) // span)
        if i < TIMELY - 1:
            lines = lines.filter(F.col("part") <= (start + (i + 1) * span) // span)
        lines.select("value").coalesce(files).repartition(files).write.mode("append").text(path)
    closing.coalesce(1).write.mode("append").text(path)
    return file_lines(t.spark, path, files_per_trigger=files)


def touch_lines(t, purpose: str) -> DataFrame:
    """Clicks, some of them twice, activations and registrations in the order of ``timely_replay``."""
    made = lines.ad_click_lines(t.ad_click).union(lines.ad_click_lines(t.ad_click.filter(CLICK_COPY)))
    for make in (lines.active_lines, lines.regi_lines):
        made = made.union(make(t.ev))
    far = t.ev.limit(1).selectExpr("*", "timestamp '2025-01-01 00:00:00' AS _ts").drop("ts").withColumnRenamed("_ts", "ts").withColumn("event_id", F.lit(1).cast("bigint"))
    far = far.withColumns({"imei": F.lit("closing-line"), "game_id": F.lit(1)})
    click = t.ad_click.filter("event_id % 19 <> 0").limit(1).withColumns({"ts": F.lit("2025-01-01 00:00:00").cast("timestamp"), "imei": F.lit("closing-line")})
    closing = lines.ad_click_lines(click)
    for kind, make in (("error", lines.active_lines), ("signup", lines.regi_lines)):
        closing = closing.union(make(far.withColumn("event_type", F.lit(kind))))
    return timely_replay(t, made, closing, purpose)


_TOUCHES: dict[tuple[str, str, str], DataFrame] = {}


def touch_stream(t, kind: str) -> DataFrame:
    """What one replay attributes: ``activations`` by a stateful operator over the lines, ``registrations`` by a second one chained to it."""
    key = (t.spark.sparkContext.applicationId, t.dir, kind)
    if key not in _TOUCHES:
        stream = touch_lines(t, "touch-lines")
        found = touches.attributed_activations(stream, t.ad_click.select("game_id").distinct(), DELAY)
        if kind == "registrations":
            found = touches.attributed_registrations(stream, found, DELAY)
        _TOUCHES[key] = _to_table(t, found, f"touch-{kind}")
    return _TOUCHES[key]


@query("job21_touch_activations", f"day:s {STAT_SPEC} active_num:i",
       f"WITH {_streamed_chain(ACTS)} SELECT cast(active_time AS date) AS day, {STAT}, count(*) AS active_num FROM acts GROUP BY ALL")
def touch_activations(t):
    return attribution.activation_stats(touch_stream(t, "activations"))


@query("job21_touch_registrations", f"day:s {STAT_SPEC} regi_num:i",
       f"WITH {_streamed_chain(REGS)} SELECT cast(reg_time AS date) AS day, {STAT}, count(*) AS regi_num FROM regs GROUP BY ALL")
def touch_registrations(t):
    return attribution.registration_stats(touch_stream(t, "registrations")).select("day", *STAT.split(", "), "regi_num")


@query("job21_touch_click_table", LATEST_SPEC, _streamed_chain(LATEST_CLICKS))
def touch_click_table(t):
    """The click table kept in buckets by two chained stateful operators."""
    pipeline = pipelines.ClickPipeline(t.spark, shared_dir(t.spark, "click-table"), t.ad_click.select("game_id").distinct(), DELAY, 8)
    pipeline.start(touch_lines(t, "click-table-lines")).awaitTermination()
    return pipeline.read().drop("game_id", "os")


@query("str17_account_stream", "game_account:s owner_id:s user_type:i regi_time:s last_login_time:s is_recharge:i", f"""
    WITH r AS (SELECT 'u' || u AS acc, cast(u % 40 AS varchar) AS owner_id, max(ts) AS t FROM ev WHERE event_type = 'signup' AND event_id % 31 <> 0 AND event_id % 37 <> 0 GROUP BY 1, 2),
    l AS (SELECT 'u' || u AS acc, max(ts) AS t FROM ev WHERE event_type = 'view' AND event_id % 31 <> 0 AND event_id % 37 <> 0 GROUP BY 1),
    o AS (SELECT DISTINCT 'u' || u AS acc FROM ev WHERE event_type = 'purchase' AND event_id % 31 <> 0 AND event_id % 37 <> 0),
    k AS (SELECT acc FROM r UNION SELECT acc FROM l UNION SELECT acc FROM o)
    SELECT k.acc AS game_account, r.owner_id, CASE WHEN r.acc IS NOT NULL THEN 1 END AS user_type, r.t AS regi_time, l.t AS last_login_time, CASE WHEN o.acc IS NULL THEN 0 ELSE 1 END AS is_recharge
    FROM k LEFT JOIN r ON r.acc = k.acc LEFT JOIN l ON l.acc = k.acc LEFT JOIN o ON o.acc = k.acc""")
def account_stream(t):
    made = lines.regi_lines(t.ev).union(lines.login_lines(t.ev)).union(lines.order_lines(t.ev))
    return run(t, made, pipelines.AccountPipeline, "accounts").master()


def _to_table(t, rows: DataFrame, purpose: str) -> DataFrame:
    """Run a native streaming query to the end into a parquet table."""
    path = shared_dir(t.spark, purpose)
    done = rows.writeStream.format("parquet").option("checkpointLocation", f"{path}-checkpoint").trigger(availableNow=True).start(path)
    done.awaitTermination()
    return t.spark.read.schema(rows.schema).parquet(path)


@query("str13_order_dedup_stream", "order_no:s order_time:s game_account:s game_id:i", f"""
    SELECT DISTINCT 'o' || event_id AS order_no, ts AS order_time, 'u' || u AS game_account, game_id FROM ev
    WHERE event_type = 'purchase' AND event_id % 10 > 1 AND event_id % 7 <> 0 AND {GOOD}""")
def order_dedup_stream(t):
    orders = parse_log(replay(t, lines.order_lines(t.ev), "order-lines", arrival=True), "order")[0]
    return _to_table(t, pipelines.dedup_orders(orders), "orders-once").select("order_no", "order_time", "game_account", "game_id")


@query("str14_first_of_day_stream", "day:s game_id:i imei:s", f"SELECT DISTINCT cast(ts AS date) AS day, game_id, imei FROM ev WHERE event_type = 'view' AND {GOOD}")
def first_of_day_stream(t):
    logins = parse_log(replay(t, lines.login_lines(t.ev), "login-lines", arrival=True), "login")[0]
    return _to_table(t, pipelines.first_of_day(logins, ["game_id", "imei"], "login_time"), "logins-once").select("day", "game_id", "imei")


@query("str21_stream_enrich", "game_account:s game_id:i login_time:s parent_game_id:i os:i group_id:i", f"""
    SELECT 'u' || u AS game_account, e.game_id, ts AS login_time, coalesce(g.game_id, 0) AS parent_game_id, coalesce(g.system_type, 1) AS os, coalesce(g.group_id, 0) AS group_id
    FROM ev e LEFT JOIN game_sdk g ON g.old_game_id = e.game_id AND g.state = 0 WHERE event_type = 'view' AND {GOOD} AND e.game_id IN (SELECT game_id FROM publish_game)""")
def stream_enrich(t):
    logins = parse_log(replay(t, lines.login_lines(t.ev), "enrich-lines"), "login")[0]
    return _to_table(t, pipelines.enrich(logins, t.publish_game, t.game_sdk.filter("state = 0")), "logins-enriched")


