"""Scalar functions, predicates, dimensions lookups and merges over whole tables."""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import functions as F

from playcohort import constants as C
from playcohort.functions import channel as ch
from playcohort.functions import device, festival, ladder, money, sqlfuncs, times
from playcohort.operators import attribution, dims, kpi, merge, revenue
from playcohort.operators.buckets import BucketTable
from playcohort.operators.ltv import distinct_orders
from playcohort.plans import jobs
from playcohort.session import shared_dir
from suite.registry import query
from suite.reports import CH_SPEC, CLEAN, MARKET, PAID_ORDERS, PERF_SQL, RUN_DAY, _performance, parts

# --- channels and accounts ---------------------------------------------------------------


@query("prj02_channel_split", f"event_id:i channel:s {CH_SPEC}", f"SELECT event_id, {CLEAN.format('expand_channel')} AS channel, {parts('expand_channel')} FROM regi")
def channel_split(t):
    return ch.with_channel_parts(t.regi.withColumn("channel", ch.clean_channel("expand_channel")), "expand_channel")


UDF_SQL = f"SELECT event_id, {parts('expand_channel')} FROM regi"


@query("udf01_getchannel", f"event_id:i {CH_SPEC}", UDF_SQL)
def getchannel(t):
    sqlfuncs.register_sql_functions(t.spark)
    return t.regi.selectExpr("event_id", *[f"getchannel(expand_channel, '{i}') AS {n}" for i, n in enumerate(ch.CHANNEL_COLS)])


@query("prj03_norm_account", "event_id:i account:s", "SELECT event_id, lower(trim(game_account)) AS account FROM regi")
def norm_account(t):
    return t.regi.select("event_id", device.norm_account(F.col("game_account")).alias("account"))


@query("prj04_null_defaults", "game_account:s game_id:i platform:s bind_day:s", """
    SELECT game_account, coalesce(mainid, 0) AS game_id, coalesce(reg_os_type, 'UNKNOW') AS platform, coalesce(cast(cast(bind_uid_time AS date) AS varchar), '0000-00-00') AS bind_day
    FROM card_regi r JOIN gameinfo g ON g.id = r.game_id""")
def null_defaults(t):
    joined = t.card_regi.withColumnRenamed("game_id", "id").join(t.gameinfo, "id")
    named = joined.select("game_account", F.col("mainid").alias("game_id"), F.col("reg_os_type").alias("platform"),
                          times.day_key(F.col("bind_uid_time")).alias("bind_day"))
    return named.fillna({"game_id": 0, "platform": "UNKNOW", "bind_day": "0000-00-00"})


@query("prj05_signed_amount", "order_no:s amount:i pay_type:s", f"""
    SELECT order_no, (CASE WHEN order_status = 4 THEN 1 ELSE -1 END) * (coalesce(ori_price, 0) + coalesce(total_amt, 0)) * 100 AS amount,
           CASE payment_type WHEN 11 THEN 'a' WHEN 100 THEN 'b' ELSE cast(payment_type AS varchar) END AS pay_type
    FROM ({PAID_ORDERS} WHERE order_status IN (4, 8) AND prod_type = 6)""")
def signed_amount(t):
    rows = distinct_orders(t.orders_g, product=C.GAME_PRODUCT)
    amount = money.signed(money.gross_amount(F.col("ori_price"), F.col("total_amt")), F.col("order_status"))
    return rows.select("order_no", money.cents(amount).alias("amount"), money.pay_type_code(F.col("payment_type")).alias("pay_type"))


@query("prj12_user_type", "game_account:s user_type:i", "SELECT game_account, CASE WHEN reg_resource = 1 THEN 1 ELSE 2 END AS user_type FROM card_regi")
def user_type(t):
    return t.card_regi.select("game_account", F.when(F.col("reg_resource") == 1, 1).otherwise(2).alias("user_type"))


# --- predicates ------------------------------------------------------------------------------


@query("flt02_text_predicates", "number_like:i time_like:i parsed:i n:i", """
    SELECT 1 AS number_like, 0 AS time_like, 0 AS parsed, count(*) AS n FROM ev WHERE event_id % 4 = 0
    UNION ALL SELECT 0, 1, 1, count(*) FROM ev WHERE event_id % 4 = 1 UNION ALL SELECT 0, 1, 0, count(*) FROM ev WHERE event_id % 4 = 2
    UNION ALL SELECT 0, 0, 0, count(*) FROM ev WHERE event_id % 4 = 3""")
def text_predicates(t):
    text = F.expr("CASE event_id % 4 WHEN 0 THEN cast(event_id AS string) WHEN 1 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') "
                  "WHEN 2 THEN '2024-13-40 99:99:99' ELSE 'no time' END")
    rows = t.ev.select(text.alias("x")).select(
        times.is_number_text(F.col("x")).cast("int").alias("number_like"), times.is_time_text(F.col("x")).cast("int").alias("time_like"),
        times.parse_time(F.col("x")).isNotNull().cast("int").alias("parsed"))
    return rows.groupBy("number_like", "time_like", "parsed").agg(F.count("*").alias("n"))


@query("flt05_channel_guard_rejects", "fits:i n:i", f"""
    SELECT CASE WHEN length(parent_channel) <= 10 AND length(child_channel) <= 10 AND length(pkg_code) <= 4 THEN 1 ELSE 0 END AS fits, count(*) AS n
    FROM (SELECT {parts('expand_channel')} FROM regi) GROUP BY 1""")
def channel_guard(t):
    rows = ch.with_channel_parts(t.regi, "expand_channel").withColumn("fits", ch.channel_fits(max_pkg=4).cast("int"))
    return rows.groupBy("fits").agg(F.count("*").alias("n"))


@query("flt07_valid_devices", "event_id:i imei:s", """
    SELECT event_id, imei FROM ad_click WHERE replace(imei, '-', '') NOT IN (repeat('0', 32), repeat('0', 15), '')
      AND NOT (os = 'android' AND adv_name IN (1, 3) AND imei = '5284047f4ffb4e04824a2fd1d1f0cd62')""")
def valid_devices(t):
    return attribution.valid_clicks(t.ad_click)


@query("flt12_effective_on_day", "pkg_code:s promotion_channel:s", "SELECT pkg_code, promotion_channel FROM fxdim WHERE mstart_date <= date '2024-01-30' AND mend_date >= date '2024-01-30'")
def effective_on_day(t):
    return t.fxdim.filter(dims.in_bounds(F.lit(RUN_DAY), F.col("mstart_date"), F.col("mend_date")))


@query("flt13_member_filter", "member_id:i username:s", "SELECT member_id, username FROM promo_user WHERE member_grade = 1 AND status IN (0, 1)")
def member_filter(t):
    return t.promo_user.filter("member_grade = 1 AND status IN (0, 1)")


# --- dates -------------------------------------------------------------------------------------


@query("fun05_hour_month_keys", "event_id:i day:s hour:s month:s month_start:s week_ago:s age:i", """
    SELECT event_id, cast(ts AS date) AS day, strftime(ts, '%Y-%m-%d %H') AS hour, strftime(ts, '%Y-%m') AS month, cast(date_trunc('month', ts) AS date) AS month_start,
           cast(ts AS date) - 7 AS week_ago, date_diff('day', cast(ts AS date), date '2024-01-30') AS age FROM ev""")
def date_keys(t):
    ts = F.col("ts")
    return t.ev.select(
        "event_id", F.to_date(ts).alias("day"), times.hour_key(ts).alias("hour"), times.month_key(ts).alias("month"),
        times.month_start(F.to_date(ts)).alias("month_start"), F.date_add(F.to_date(ts), -7).alias("week_ago"),
        F.datediff(F.lit(RUN_DAY), F.to_date(ts)).alias("age"))


NOON = "timestamp '2024-01-15 12:30:00'"


@query("fun07_time_compare", "event_id:i before_second:i before_hour:i before_day:i after_day:i", f"""
    SELECT event_id, CASE WHEN ok AND ts < {NOON} THEN 1 ELSE 0 END AS before_second, CASE WHEN ok AND date_trunc('hour', ts) < date_trunc('hour', {NOON}) THEN 1 ELSE 0 END AS before_hour,
           CASE WHEN ok AND cast(ts AS date) < date '2024-01-15' THEN 1 ELSE 0 END AS before_day, CASE WHEN ok AND cast(ts AS date) > date '2024-01-15' THEN 1 ELSE 0 END AS after_day
    FROM (SELECT *, event_id % 9 <> 0 AS ok FROM ev)""")
def time_compare(t):
    text = F.expr("CASE WHEN event_id % 9 = 0 THEN 'bad' ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END")
    noon = F.lit("2024-01-15 12:30:00")
    return t.ev.select(
        "event_id", times.is_before(text, noon).cast("int").alias("before_second"), times.is_before(text, noon, "hour").cast("int").alias("before_hour"),
        times.is_before(text, noon, "day").cast("int").alias("before_day"), times.is_after(text, noon, "day").cast("int").alias("after_day"))


@query("fun09_epoch_text", "event_id:i stamp:s", "SELECT event_id, ts AS stamp FROM ev")
def epoch_text(t):
    return t.ev.select("event_id", times.epoch_text(F.unix_timestamp("ts")).alias("stamp"))


@query("fun11_run_day", "event_id:i run_day:s", "SELECT event_id, CASE WHEN hour(ts) < 1 THEN cast(ts AS date) - 1 ELSE cast(ts AS date) END AS run_day FROM ev")
def run_day(t):
    return t.ev.select("event_id", times.run_day(F.col("ts")).alias("run_day"))


# the days of 1995-2001 orders moved into the years the calendar covers
MOVED = "cast(o_orderdate AS date) + 6940"


def _festival_sql(body: str) -> str:
    names = ", ".join(f"('{line.split('=')[0]}', '{line.split('=')[1]}')" for line in festival.FESTIVAL_DAYS.split())
    return f"WITH cal(d, name) AS (VALUES {names}) {body}"


@query("fun21_festival", "festival:s is_festival:i n:i", _festival_sql(f"""
    SELECT coalesce(cal.name, 'null') AS festival, CASE WHEN cal.name IS NULL THEN 0 ELSE 1 END AS is_festival, count(*) AS n
    FROM (SELECT strftime({MOVED}, '%Y%m%d') AS d, o_orderkey FROM orders) o LEFT JOIN cal ON cal.d = o.d AND o.o_orderkey % 4 <> 3 GROUP BY 1, 2"""))
def festivals(t):
    day = "date_add(to_date(o_orderdate), 6940)"
    text = (f"CASE o_orderkey % 4 WHEN 0 THEN date_format({day}, 'yyyyMMdd') WHEN 1 THEN date_format({day}, 'yyyy-MM-dd') "
            f"WHEN 2 THEN date_format({day}, 'yyyy-MM-dd') || ' 10:35:46' ELSE 'no day' END")
    rows = festival.with_festival(t.orders.select(F.expr(text).alias("d")), F.col("d"))
    return rows.groupBy("festival", "is_festival").agg(F.count("*").alias("n"))


@query("udf06_festival_number", "is_festival:i n:i", _festival_sql(f"""
    SELECT CASE WHEN cal.name IS NULL THEN 0 ELSE 1 END AS is_festival, count(*) AS n
    FROM (SELECT strftime({MOVED}, '%Y%m%d') AS d FROM orders) o LEFT JOIN cal ON cal.d = o.d GROUP BY 1"""))
def festival_number(t):
    number = F.expr("cast(date_format(date_add(to_date(o_orderdate), 6940), 'yyyyMMdd') AS double)")
    rows = t.orders.select(festival.number_digits(number).alias("d"))
    return festival.with_festival(rows, F.col("d")).groupBy("is_festival").agg(F.count("*").alias("n"))


# --- devices -------------------------------------------------------------------------------------
DASHES = "substr({0}, 1, 8) || '-' || substr({0}, 9, 4) || '-' || substr({0}, 13, 4) || '-' || substr({0}, 17, 4) || '-' || substr({0}, 21, 12)"
MD5_SQL = f"SELECT event_id, upper(md5(CASE WHEN length(imei) = 32 THEN {DASHES.format('imei')} ELSE imei END)) AS hash FROM regi"


@query("fun16_device_md5", "event_id:i hash:s", MD5_SQL)
def device_md5(t):
    sent = t.regi.select("event_id", F.concat("imei", F.lit("&68:3e")).alias("sent"))
    return sent.select("event_id", device.device_md5("sent").alias("hash"))


@query("udf04_device_md5", "event_id:i hash:s", MD5_SQL)
def device_md5_sql(t):
    sqlfuncs.register_sql_functions(t.spark)
    return t.regi.selectExpr("event_id", "devicemd5(concat(imei, '&x')) AS hash")


@query("udf05_two_mode_md5", "event_id:i first:s cut:s", """
    SELECT event_id, md5(imei) AS first, md5(substr(imei, 1, 8) || '-' || substr(imei, 9, 4) || '-' || substr(imei, 13, 4) || '-' || substr(imei, 17)) AS cut FROM regi""")
def two_mode(t):
    return t.regi.select("event_id", device.two_mode_md5(F.concat("imei", F.lit("&x")), F.lit("1")).alias("first"),
                         device.two_mode_md5(F.col("imei"), F.lit("2")).alias("cut"))


@query("fun15_device_text", "event_id:i piped:s first:s canonical:s", f"""
    SELECT event_id, imei || '|a' AS piped, imei AS first, CASE WHEN length(imei) = 32 THEN {DASHES.format('imei')} ELSE imei END AS canonical FROM regi""")
def device_text(t):
    return t.regi.select("event_id", device.pipe_device(F.concat("imei", F.lit("$a"))).alias("piped"),
                         device.first_device(F.concat("imei", F.lit("&a&b"))).alias("first"), device.canonical_device(F.col("imei")).alias("canonical"))


BACKFILL = "CASE os WHEN 'ios' THEN upper(md5(imei)) ELSE upper(imei) END"


@query("snk15_device_hash_backfill", "event_id:i imei_md5_upper:s", f"SELECT event_id, {BACKFILL} AS imei_md5_upper FROM ad_click")
def hash_backfill(t):
    return jobs.device_hash_backfill(t.ad_click)


# --- ladders, money, text -----------------------------------------------------------------------------


LADDER_SQL = """SELECT event_id, CASE WHEN l.ladders IS NULL THEN '0' WHEN amount >= 5000 THEN cast(30 + l.game_id AS varchar)
    WHEN amount >= 1000 THEN cast(20 + l.game_id AS varchar) ELSE cast(10 + l.game_id AS varchar) END AS rate
    FROM (SELECT event_id, game_id, event_id % 7000 AS amount FROM ev) e LEFT JOIN ladders l ON l.game_id = e.game_id"""


@query("udf02_divide_ladder", "event_id:i rate:s", LADDER_SQL)
def divide_ladder(t):
    tiers = t.ladders.select("game_id", ladder.ladder_tiers("ladders").alias("tiers"))
    rows = t.ev.select("event_id", "game_id", (F.col("event_id") % 7000).alias("amount")).join(tiers, "game_id", "left")
    return rows.select("event_id", ladder.tier_rate("tiers", "amount").alias("rate"))


@query("udf02_divide_ladder_sql", "event_id:i rate:s", LADDER_SQL)
def divide_ladder_sql(t):
    sqlfuncs.register_sql_functions(t.spark)
    rows = t.ev.join(t.ladders, "game_id", "left")
    return rows.selectExpr("event_id", "getdivideladder(ladders, cast(event_id % 7000 AS string)) AS rate")


@query("srt04_ladder_sort", "game_id:i tiers:s", """
    SELECT game_id, '0=' || (10 + game_id) || ',1000=' || (20 + game_id) || ',5000=' || (30 + game_id) AS tiers FROM ladders""")
def ladder_sort(t):
    tiers = F.transform(ladder.ladder_tiers("ladders"), lambda x: F.concat_ws("=", x["threshold"], x["rate"]))
    return t.ladders.select("game_id", F.array_join(tiers, ",").alias("tiers"))


@query("udf03_concat_ladder", "game_id:i ladders:s", """
    SELECT game_id, string_agg(tier, '|' ORDER BY tier) AS ladders FROM (SELECT DISTINCT game_id, (u % 10) || '=' || (u % 7) AS tier FROM ev) GROUP BY 1""")
def concat_ladder(t):
    tiers = t.ev.select("game_id", F.expr("concat(u % 10, '=', u % 7)").alias("tier"))
    return ladder.concat_ladders(tiers, ["game_id"], "tier")


@query("agg26_games_per_os", "os:i games:s", "SELECT os, string_agg(game_id, ',' ORDER BY game_id) AS games FROM (SELECT DISTINCT os, game_id FROM medium_package WHERE feedbackurl <> '') GROUP BY 1")
def games_per_os(t):
    return jobs.games_per_os(t.medium_package)


@query("agg25_arpu", "day:s game_id:i amount:i accounts:i arpu:d", """
    WITH a AS (SELECT cast(reg_time AS date) AS day, game_id, count(DISTINCT lower(trim(game_account))) AS accounts FROM regi GROUP BY 1, 2),
    s AS (SELECT cast(order_time AS date) AS day, game_id, cast(sum(ori_price) * 100 AS bigint) AS amount FROM pays GROUP BY 1, 2)
    SELECT day, game_id, coalesce(amount, 0) AS amount, accounts, round(cast(coalesce(amount, 0) AS double) / accounts, 6) AS arpu FROM a LEFT JOIN s USING (day, game_id)""")
def arpu(t):
    accounts = kpi.count_distinct(t.regi.withColumn("day", F.to_date("reg_time")), ["day", "game_id"], ["game_account"], "accounts")
    spend = t.pays.groupBy(F.to_date("order_time").alias("day"), "game_id").agg(money.cents(F.sum("ori_price")).alias("amount"))
    return jobs.arpu_report(spend, accounts, ["day", "game_id"]).withColumn("arpu", F.round("arpu", 6))


@query("fun14_null_to_zero", "event_id:i amount:i", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN amount * 100 ELSE 0 END AS amount FROM ev")
def null_to_zero(t):
    text = F.expr("CASE event_id % 3 WHEN 0 THEN cast(amount AS string) WHEN 1 THEN '' END")
    return t.ev.select("event_id", money.cents(money.zero_if_null(text)).alias("amount"))


@query("fun22_rounding", "event_id:i rounded:i percent:i", "SELECT event_id, floor(amount + 0.5) AS rounded, floor((event_id % 10000) / 100) AS percent FROM ev")
def rounding(t):
    return t.ev.select("event_id", F.round("amount").alias("rounded"), money.percent_to_int(F.col("event_id") % 10000).alias("percent"))


@query("fun23_json_array", "game_id:i param:s", """
    SELECT game_id, 'param=[' || string_agg('{"game_id":' || game_id || ',"divide_date":"' || day || '","from":"bi"}', ',' ORDER BY day) || ']' AS param
    FROM (SELECT DISTINCT game_id, cast(ts AS date) AS day FROM ev WHERE event_type = 'purchase') GROUP BY 1""")
def json_array(t):
    # one entry per game and changed day
    days = t.ev.filter("event_type = 'purchase'").select("game_id", F.date_format("ts", "yyyy-MM-dd").alias("divide_date")).distinct()
    items = F.sort_array(F.collect_list(F.struct("divide_date")))
    return days.groupBy("game_id").agg(items.alias("x")).select(
        "game_id", F.concat(F.lit("param="), F.to_json(F.transform("x", lambda x: F.struct(
            F.col("game_id").alias("game_id"), x["divide_date"].alias("divide_date"), F.lit("bi").alias("from"))))).alias("param"))


# --- joins and first rows ---------------------------------------------------------------------------


@query("jon19_dim_lookup_defaults", f"day:s game_id:i pkg_code:s parent_game_id:s os:s group_id:s medium_account:s promotion_channel:s head_people:s promotion_mode:s", f"""
    WITH k AS (SELECT DISTINCT cast(reg_time AS date) AS day, game_id, {parts('expand_channel')} FROM regi),
    d AS (SELECT mp.subpackage_id AS pkg_code, max(m.merchant) AS medium_account FROM medium_package mp JOIN merchant m ON m.merchant_id = mp.merchant_id GROUP BY 1)
    SELECT DISTINCT k.day, k.game_id, k.pkg_code, cast(coalesce(g.game_id, 0) AS varchar) AS parent_game_id, cast(coalesce(g.system_type, 1) AS varchar) AS os,
           cast(coalesce(g.group_id, 0) AS varchar) AS group_id, coalesce(d.medium_account, '') AS medium_account, '' AS promotion_channel, '' AS head_people, '' AS promotion_mode
    FROM k LEFT JOIN game_sdk g ON g.old_game_id = k.game_id AND g.state = 0 LEFT JOIN d ON d.pkg_code = k.pkg_code""")
def dim_lookup(t):
    keys = ch.with_channel_parts(t.regi, "expand_channel").select(F.to_date("reg_time").alias("day"), "game_id", "pkg_code").distinct()
    accounts = t.medium_package.join(t.merchant, "merchant_id").groupBy(F.col("subpackage_id").alias("pkg_code")).agg(F.max("merchant").alias("medium_account"))
    empty = {c: F.lit(None).cast("string") for c in ("promotion_channel", "head_people", "promotion_mode")}
    return dims.lookup_dims(keys, t.game_sdk.filter("state = 0"), accounts.withColumns(empty))


@query("jon18_not_seen_before", "game_id:i imei:s reg_time:s", """
    SELECT game_id, imei, min(reg_time) AS reg_time FROM regi WHERE reg_time >= timestamp '2024-01-16 00:00:00'
      AND (game_id, imei) NOT IN (SELECT (game_id, imei) FROM regi WHERE reg_time < timestamp '2024-01-16 00:00:00') GROUP BY 1, 2""")
def not_seen(t):
    late, early = t.regi.filter("reg_time >= timestamp '2024-01-16'"), t.regi.filter("reg_time < timestamp '2024-01-16'")
    firsts = late.groupBy("game_id", "imei").agg(F.min("reg_time").alias("reg_time"))
    return merge.append_new(early.select("game_id", "imei").distinct(), firsts, ["game_id", "imei"])


@query("srt03_first_row_per_key", "game_account:s reg_time:s event_id:i game_id:i", """
    SELECT lower(trim(game_account)) AS game_account, reg_time, event_id, game_id FROM regi
    QUALIFY row_number() OVER (PARTITION BY lower(trim(game_account)) ORDER BY reg_time, event_id) = 1""")
def first_row(t):
    one = jobs.clean_accounts(t.regi).groupBy("game_account").agg(F.min(F.struct("reg_time", "event_id", "game_id")).alias("r"))
    return one.select("game_account", "r.*")


@query("jon05_owner_half_open", "pkg_code:s day:s main_man:s", """
    WITH pd AS (SELECT pkg_code, date '2024-01-16' AS day FROM pkgs),
    mm AS (SELECT pd.pkg_code, max(nullif(u.name, '')) AS name FROM pd JOIN channel_pkg c ON c.pkg_code = pd.pkg_code
           JOIN channel_manager m ON m.channel_id = c.channel_id AND pd.day >= cast(m.start_time AS date) AND pd.day < cast(m.end_time AS date) JOIN users u ON u.id = m.manager GROUP BY 1),
    cc AS (SELECT pd.pkg_code, max(nullif(u.name, '')) AS name FROM pd JOIN medium_package mp ON mp.subpackage_id = pd.pkg_code JOIN merchant me ON me.merchant_id = mp.merchant_id
           JOIN charge_log l ON l.source_id = me.id AND l.family = 3 AND pd.day >= cast(l.start_time AS date) AND pd.day < cast(l.end_time AS date) JOIN users u ON u.id = l.user_id GROUP BY 1)
    SELECT pd.pkg_code, pd.day, coalesce(mm.name, cc.name) AS main_man FROM pd LEFT JOIN mm USING (pkg_code) LEFT JOIN cc USING (pkg_code) WHERE coalesce(mm.name, cc.name) IS NOT NULL""")
def owner(t):
    pairs = t.pkgs.select("pkg_code", F.lit(dt.date(2024, 1, 16)).alias("day"))
    return dims.package_owner(pairs, t.channel_pkg, t.channel_manager, t.medium_package, t.merchant, t.charge_log, t.users)


# --- merges ---------------------------------------------------------------------------------------------
KPI_KEY, KPI_SCHEMA = ["day", "game_id"], "day date, game_id int, n bigint, last_id bigint"


def _half(t, late: bool):
    """Registrations per (day, game) of the early or the late half-month, which share the 15th to 17th."""
    window = "reg_time >= timestamp '2024-01-15'" if late else "reg_time < timestamp '2024-01-18'"
    return t.regi.filter(window).groupBy(F.to_date("reg_time").alias("day"), "game_id").agg(
        F.count("*").alias("n"), F.max(F.col("event_id")).alias("last_id"))


HALVES = """e AS (SELECT cast(reg_time AS date) AS day, game_id, count(*) AS n, max(event_id) AS last_id FROM regi WHERE reg_time < timestamp '2024-01-18 00:00:00' GROUP BY 1, 2),
    l AS (SELECT cast(reg_time AS date) AS day, game_id, count(*) * 2 AS n, max(event_id) + 1 AS last_id FROM regi WHERE reg_time >= timestamp '2024-01-15 00:00:00' GROUP BY 1, 2)"""


def _late(t):
    return _half(t, True).withColumns({"n": F.col("n") * 2, "last_id": F.col("last_id") + 1})


@query("snk01_merge_replace", "day:s game_id:i n:i last_id:i", f"""
    WITH {HALVES} SELECT coalesce(l.day, e.day) AS day, coalesce(l.game_id, e.game_id) AS game_id, coalesce(l.n, e.n) AS n, coalesce(l.last_id, e.last_id) AS last_id
    FROM e FULL JOIN l ON l.day = e.day AND l.game_id = e.game_id""")
def merge_replace(t):
    return merge.merge_replace(_half(t, False), _late(t), KPI_KEY)


@query("snk02_merge_listed_columns", "day:s game_id:i n:i last_id:i", f"""
    WITH {HALVES} SELECT coalesce(l.day, e.day) AS day, coalesce(l.game_id, e.game_id) AS game_id, coalesce(l.n, e.n) AS n, coalesce(e.last_id, l.last_id) AS last_id
    FROM e FULL JOIN l ON l.day = e.day AND l.game_id = e.game_id""")
def merge_listed(t):
    return merge.merge_replace(_half(t, False), _late(t), KPI_KEY, ["n"])


@query("snk03_merge_add", "day:s game_id:i n:i last_id:i", f"""
    WITH {HALVES} SELECT coalesce(l.day, e.day) AS day, coalesce(l.game_id, e.game_id) AS game_id, coalesce(l.n, 0) + coalesce(e.n, 0) AS n, coalesce(l.last_id, e.last_id) AS last_id
    FROM e FULL JOIN l ON l.day = e.day AND l.game_id = e.game_id""")
def merge_add(t):
    return merge.merge_add(_half(t, False), _late(t), KPI_KEY, ["n"], ["last_id"])


@query("snk04_merge_greatest", "game_account:s reg_time:s game_id:i", """
    WITH r AS (SELECT lower(trim(game_account)) AS game_account, reg_time, game_id, event_id FROM regi)
    SELECT game_account, max(reg_time) AS reg_time, coalesce(min(CASE WHEN event_id % 2 = 1 THEN game_id END), min(game_id)) AS game_id FROM r GROUP BY 1""")
def merge_greatest(t):
    rows = jobs.clean_accounts(t.regi)
    per = lambda df: df.groupBy("game_account").agg(F.max("reg_time").alias("reg_time"), F.min("game_id").alias("game_id"))
    return merge.merge_greatest(per(rows.filter("event_id % 2 = 0")), per(rows.filter("event_id % 2 = 1")), ["game_account"], ["reg_time"], ["game_id"])


def _bucketed(t, keys, schema, first, second, how):
    """Two merges into an empty table of buckets; the second meets only the buckets of its keys."""
    table = BucketTable(t.spark, shared_dir(t.spark, "buckets"), schema, keys, 16)
    table.merge(first, 0, lambda old, new: new)
    table.merge(second, 1, how)
    return table.read()


@query("snk01_bucketed_replace", "day:s game_id:i n:i last_id:i", f"""
    WITH {HALVES} SELECT coalesce(l.day, e.day) AS day, coalesce(l.game_id, e.game_id) AS game_id, coalesce(l.n, e.n) AS n, coalesce(l.last_id, e.last_id) AS last_id
    FROM e FULL JOIN l ON l.day = e.day AND l.game_id = e.game_id""")
def bucketed_replace(t):
    return _bucketed(t, KPI_KEY, KPI_SCHEMA, _half(t, False), _late(t), partial(merge.merge_replace, keys=KPI_KEY))


@query("snk02_bucketed_listed", "day:s game_id:i n:i last_id:i", f"""
    WITH {HALVES} SELECT coalesce(l.day, e.day) AS day, coalesce(l.game_id, e.game_id) AS game_id, coalesce(l.n, e.n) AS n, coalesce(e.last_id, l.last_id) AS last_id
    FROM e FULL JOIN l ON l.day = e.day AND l.game_id = e.game_id""")
def bucketed_listed(t):
    return _bucketed(t, KPI_KEY, KPI_SCHEMA, _half(t, False), _late(t), partial(merge.merge_replace, keys=KPI_KEY, update_cols=["n"]))


@query("snk03_bucketed_add", "day:s game_id:i n:i last_id:i", f"""
    WITH {HALVES} SELECT coalesce(l.day, e.day) AS day, coalesce(l.game_id, e.game_id) AS game_id, coalesce(l.n, 0) + coalesce(e.n, 0) AS n, coalesce(l.last_id, e.last_id) AS last_id
    FROM e FULL JOIN l ON l.day = e.day AND l.game_id = e.game_id""")
def bucketed_add(t):
    return _bucketed(t, KPI_KEY, KPI_SCHEMA, _half(t, False), _late(t), partial(merge.merge_add, keys=KPI_KEY, add_cols=["n"], latest_cols=["last_id"]))


@query("snk04_bucketed_greatest", "game_account:s reg_time:s game_id:i", """
    WITH r AS (SELECT lower(trim(game_account)) AS game_account, reg_time, game_id, event_id FROM regi)
    SELECT game_account, max(reg_time) AS reg_time, coalesce(min(CASE WHEN event_id % 2 = 1 THEN game_id END), min(game_id)) AS game_id FROM r GROUP BY 1""")
def bucketed_greatest(t):
    rows = jobs.clean_accounts(t.regi)
    per = lambda df: df.groupBy("game_account").agg(F.max("reg_time").alias("reg_time"), F.min("game_id").alias("game_id"))
    return _bucketed(t, ["game_account"], "game_account string, reg_time timestamp, game_id int", per(rows.filter("event_id % 2 = 0")), per(rows.filter("event_id % 2 = 1")),
                     partial(merge.merge_greatest, keys=["game_account"], greatest_cols=["reg_time"], replace_cols=["game_id"]))


@query("snk05_detail_append", "game_id:i imei:s", "SELECT DISTINCT game_id, imei FROM active")
def detail_append(t):
    early, late = t.active.filter("active_time < timestamp '2024-01-10'"), t.active.filter("active_time >= timestamp '2024-01-10'")
    details = early.select("game_id", "imei").distinct()
    return details.union(merge.append_new(details, late.select("game_id", "imei"), ["game_id", "imei"]))


@query("snk06_dim_update", f"day:s {MARKET.replace(', ', ':s ').replace('game_id:s', 'game_id:i')}:s medium_account:s", f"""
    WITH k AS (SELECT DISTINCT cast(reg_time AS date) AS day, game_id, {parts('expand_channel')} FROM regi)
    SELECT k.day, k.game_id, k.parent_channel, k.child_channel, k.pkg_code, CASE WHEN k.day = date '2024-01-30' AND f.medium_account IS NOT NULL THEN f.medium_account ELSE 'old' END AS medium_account
    FROM k LEFT JOIN fxdim f ON f.pkg_code = k.pkg_code AND date '2024-01-30' BETWEEN f.mstart_date AND f.mend_date""")
def dim_update(t):
    table = ch.with_channel_parts(t.regi, "expand_channel").select(F.to_date("reg_time").alias("day"), *kpi.MARKET).distinct()
    dim = t.fxdim.filter(dims.in_bounds(F.lit(RUN_DAY), F.col("mstart_date"), F.col("mend_date")))
    return merge.update_from(table.withColumn("medium_account", F.lit("old")), dim, ["pkg_code"], ["medium_account"], F.col("day") == F.lit(RUN_DAY))


@query("snk08_partition_overwrite", "day:s n:i", """
    SELECT cast(ts AS date) AS day, count(*) * CASE WHEN ts >= timestamp '2024-01-20 00:00:00' THEN 2 ELSE 1 END AS n FROM ev GROUP BY 1, ts >= timestamp '2024-01-20 00:00:00'""")
def partition_overwrite(t):
    path = shared_dir(t.spark, "performance")
    per_day = t.ev.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))
    merge.overwrite_days(per_day, path, "day")
    merge.overwrite_days(per_day.filter("day >= '2024-01-20'").withColumn("n", F.col("n") * 2), path, "day")
    return t.spark.read.schema("n bigint, day string").parquet(path)


@query("snk09_reset_range", "day:s game_id:i n:i", """
    SELECT cast(reg_time AS date) AS day, game_id, CASE WHEN cast(reg_time AS date) BETWEEN date '2024-01-05' AND date '2024-01-09' THEN 0 ELSE count(*) END AS n FROM regi GROUP BY 1, 2""")
def reset_range(t):
    table = t.regi.groupBy(F.to_date("reg_time").alias("day"), "game_id").agg(F.count("*").alias("n"))
    return merge.reset_where(table, F.col("day").between(dt.date(2024, 1, 5), dt.date(2024, 1, 9)), ["n"])


@query("snk10_insert_select", "day:s game_id:i acc_add_regi:i amount:i", """
    WITH a AS (SELECT cast(order_time AS date) AS day, game_id, cast(sum(ori_price) * 100 AS bigint) AS amount FROM pays GROUP BY 1, 2),
    b AS (SELECT cast(reg_time AS date) AS day, game_id, count(*) AS n FROM regi GROUP BY 1, 2)
    SELECT coalesce(a.day, b.day) AS day, coalesce(a.game_id, b.game_id) AS game_id, coalesce(n, 0) AS acc_add_regi, amount FROM a FULL JOIN b ON a.day = b.day AND a.game_id = b.game_id""")
def insert_select(t):
    actions = t.pays.groupBy(F.to_date("order_time").alias("day"), "game_id").agg(
        F.lit(0).cast("long").alias("acc_add_regi"), money.cents(F.sum("ori_price")).alias("amount"))
    base = t.regi.groupBy(F.to_date("reg_time").alias("day"), "game_id").agg(F.count("*").alias("acc_add_regi"))
    return merge.merge_replace(actions, base, KPI_KEY)


@query("snk11_delete", "member_id:i username:s", "SELECT member_id, username FROM member WHERE NOT (username = '' AND addtime IS NULL)")
def delete(t):
    return merge.delete_where(t.member, (F.col("username") == "") & F.col("addtime").isNull())


@query("snk12_parquet_overwrite", "pkg_code:s promotion_channel:s", "SELECT pkg_code, promotion_channel FROM fxdim")
def parquet_overwrite(t):
    path = shared_dir(t.spark, "fxdim")
    merge.overwrite_parquet(t.fxdim.filter("pkg_code = '1M1'"), path)
    merge.overwrite_parquet(t.fxdim, path, files=4)
    return t.spark.read.parquet(path)


@query("snk13_rebuilt_table", "day:s", "SELECT DISTINCT cast(ts AS date) AS day FROM ev")
def rebuilt_table(t):
    from playcohort.session import materialize

    return materialize(t.ev.select(F.to_date("ts").alias("day")).distinct(), "dim-day")


@query("snk14_csv", "order_no:s game_account:s amount:s", "SELECT order_no, game_account, ori_price AS amount FROM pays")
def csv(t):
    path = shared_dir(t.spark, "extract")
    merge.write_csv(t.pays.select("order_no", "game_account", F.col("ori_price").alias("amount")), path)
    return t.spark.read.option("header", True).schema("order_no string, game_account string, amount string").csv(path)


@query("jon22_proxy_by_game", "game_id:i proxy:i publish_cost:i", "SELECT game_id, sum(proxy) AS proxy, max(publish_cost) AS publish_cost FROM costs GROUP BY 1")
def proxy(t):
    return t.costs.groupBy("game_id").agg(F.sum("proxy").alias("proxy"), F.max("publish_cost").alias("publish_cost"))


@query("agg15_store_split", "game_id:i pay_water:i apple_water:i", f"""
    WITH {PERF_SQL} SELECT game_id, sum(pay_water) AS pay_water, sum(CASE WHEN pay_type = '5' THEN pay_water ELSE 0 END) AS apple_water FROM p GROUP BY 1""")
def store_split(t):
    return revenue.apple_water(_performance(t)).groupBy("game_id").agg(F.sum("pay_water").alias("pay_water"), F.sum("apple_water").alias("apple_water"))
