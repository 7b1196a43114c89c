"""KPIs over a whole log: the batch form of the stateful jobs, and attribution."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import functions as F

from playcohort import constants as C
from playcohort.functions import channel as ch
from playcohort.operators import attribution, kpi, merge
from playcohort.operators.firstseen import FirstSeen
from playcohort.plans import jobs
from playcohort.session import shared_dir
from suite.registry import query
from suite.reports import ATTRS, CH_SPEC, DAYS, MARKET, PAID_ORDERS, PERF_SQL, REGI_BASE, REGI_PUB, SIGNED_GROSS, in_run, parts

HOUR = "strftime({0}, '%Y-%m-%d %H')"


def _registration(unit: str, grain: str) -> str:
    """Registration KPI: accounts distinct per (key, hour); new on the key's first day."""
    group = f"{unit}, {grain}"
    count_devices = "count(DISTINCT imei)" if unit == "day" else "count(*)"
    new_devices = "count(DISTINCT CASE WHEN day = fd THEN imei END)" if unit == "day" else "sum(CASE WHEN day = fd THEN 1 ELSE 0 END)"
    return f"""
    WITH r AS ({REGI_PUB}),
    h AS (SELECT {HOUR.format('reg_time')} AS hour, {grain}, imei, count(DISTINCT acc) AS n FROM r GROUP BY ALL),
    f AS (SELECT *, hour[1:10] AS day, min(hour[1:10]) OVER (PARTITION BY {grain}, imei) AS fd FROM h)
    SELECT {group}, sum(n) AS regi_accounts, sum(CASE WHEN day = fd THEN n ELSE 0 END) AS new_regi_accounts,
           {count_devices} AS regi_devices, {new_devices} AS new_regi_devices FROM f GROUP BY {group}"""


REGI_OUT = "regi_accounts:i new_regi_accounts:i regi_devices:i new_regi_devices:i"


@query("str01_registration_kpi_market", f"day:s game_id:i {CH_SPEC} {REGI_OUT}", _registration("day", MARKET))
def registration_market(t):
    return kpi.registration_kpi(jobs.registration_base(t.regi, t.publish_game), kpi.MARKET)


@query("str01_registration_kpi_market_hour", f"hour:s game_id:i {CH_SPEC} {REGI_OUT}", _registration("hour", MARKET))
def registration_market_hour(t):
    return kpi.registration_kpi(jobs.registration_base(t.regi, t.publish_game), kpi.MARKET, "hour")


@query("str01_registration_kpi_opera", f"day:s game_id:i {REGI_OUT}", _registration("day", "game_id"))
def registration_opera(t):
    return kpi.registration_kpi(jobs.registration_base(t.regi, t.publish_game), kpi.OPERA)


@query("str01_registration_kpi_opera_hour", f"hour:s game_id:i {REGI_OUT}", _registration("hour", "game_id"))
def registration_opera_hour(t):
    return kpi.registration_kpi(jobs.registration_base(t.regi, t.publish_game), kpi.OPERA, "hour")


ACTIVE = f"SELECT event_id, game_id, active_time, {parts('expand_channel')}, imei, os FROM active"


@query("str02_activation_kpi", f"hour:s game_id:i {CH_SPEC} active_num:i", f"""
    WITH a AS ({ACTIVE} WHERE game_id IN (SELECT game_id FROM publish_game)),
    m AS (SELECT {MARKET}, imei, min(active_time) AS t FROM a GROUP BY ALL)
    SELECT {HOUR.format('t')} AS hour, {MARKET}, count(*) AS active_num FROM m GROUP BY ALL""")
def activation(t):
    rows = ch.with_channel_parts(jobs.published_only(t.active, t.publish_game), "expand_channel")
    return kpi.activation_kpi(rows, kpi.MARKET)


@query("str02_activation_kpi_opera_day", "day:s game_id:i active_num:i", f"""
    WITH a AS ({ACTIVE} WHERE game_id IN (SELECT game_id FROM publish_game)), m AS (SELECT game_id, imei, min(active_time) AS t FROM a GROUP BY ALL)
    SELECT cast(t AS date) AS day, game_id, count(*) AS active_num FROM m GROUP BY ALL""")
def activation_opera(t):
    return kpi.activation_kpi(jobs.published_only(t.active, t.publish_game), kpi.OPERA, "day")


LOGIN_BASE = f"SELECT lower(trim(game_account)) AS acc, login_time, game_id, {parts('channel_expand')}, channel_expand AS raw, imei FROM login"


def _login_kpi(grain: str, keep_channel: bool) -> str:
    same = " AND l.raw IS NOT DISTINCT FROM a.raw" if keep_channel else ""
    on = " AND ".join(f"f.{c} = l.{c}" for c in [*grain.split(", "), "imei"])
    lg = ", ".join(f"l.{c}" for c in grain.split(", "))
    return f"""
    WITH l0 AS ({LOGIN_BASE} WHERE game_id IN (SELECT game_id FROM publish_game)),
    l AS (SELECT * FROM l0 QUALIFY row_number() OVER (PARTITION BY acc, login_time ORDER BY raw NULLS FIRST, imei, game_id) = 1),
    r AS ({REGI_PUB}),
    f AS (SELECT {grain}, imei, min(cast(reg_time AS date)) AS fd FROM r GROUP BY ALL),
    a AS (SELECT acc, cast(reg_time AS date) AS rd, imei, CASE WHEN raw_channel = '~null' THEN NULL ELSE raw_channel END AS raw FROM r
          QUALIFY row_number() OVER (PARTITION BY acc ORDER BY reg_time, imei) = 1),
    x AS (SELECT cast(l.login_time AS date) AS day, {lg}, l.imei, l.acc, l.login_time,
                 CASE WHEN f.fd = cast(l.login_time AS date) AND a.rd = cast(l.login_time AS date) AND a.imei = l.imei{same} THEN 1 ELSE 0 END AS b
          FROM l LEFT JOIN f ON {on} LEFT JOIN a ON a.acc = l.acc),
    o AS (SELECT *, row_number() OVER (PARTITION BY day, {grain}, imei ORDER BY login_time, acc) AS dn,
                 row_number() OVER (PARTITION BY day, {grain}, acc ORDER BY login_time, imei) AS an FROM x),
    d AS (SELECT day, {grain}, imei, max(b) AS nl, CASE WHEN max(dn) > min(CASE WHEN b = 1 THEN dn END) THEN 1 ELSE 0 END AS na FROM o GROUP BY ALL),
    e AS (SELECT day, {grain}, acc, max(CASE WHEN an = 1 THEN b END) AS nl FROM o GROUP BY ALL),
    dd AS (SELECT day, {grain}, count(*) AS dau_devices, sum(nl) AS new_login_devices, sum(na) AS new_active_devices FROM d GROUP BY ALL),
    ee AS (SELECT day, {grain}, count(*) AS dau_accounts, sum(nl) AS new_login_accounts FROM e GROUP BY ALL)
    SELECT * FROM dd JOIN ee USING (day, {grain})"""


LOGIN_OUT = "dau_devices:i dau_accounts:i new_login_devices:i new_login_accounts:i new_active_devices:i"


def _published_logins(t):
    return jobs.clean_login(jobs.published_only(t.login, t.publish_game)).drop("event_id", "ip")


@query("str03_login_kpi", f"day:s game_id:i {CH_SPEC} {LOGIN_OUT}", _login_kpi(MARKET, True))
def login_kpi(t):
    return kpi.login_kpi(_published_logins(t), jobs.registration_base(t.regi, t.publish_game), kpi.MARKET)


@query("str03_login_kpi_opera", f"day:s game_id:i {LOGIN_OUT}", _login_kpi("game_id", False))
def login_kpi_opera(t):
    return kpi.login_kpi(_published_logins(t), jobs.registration_base(t.regi, t.publish_game), kpi.OPERA, channel=None)


LOGIN_SPLIT = f"""
    WITH l AS ({LOGIN_BASE} WHERE game_id IN (SELECT game_id FROM publish_game)), r AS ({REGI_PUB}),
    n AS (SELECT cast(login_time AS date) AS day, {MARKET}, imei, count(DISTINCT acc) AS n FROM l GROUP BY ALL),
    f AS (SELECT {MARKET}, imei, min(cast(reg_time AS date)) AS fd FROM r GROUP BY ALL)
    SELECT day, {MARKET}, sum(CASE WHEN fd = day THEN 1 ELSE 0 END) AS new_login_devices, sum(CASE WHEN fd = day THEN n ELSE 0 END) AS new_login_accounts,
           sum(CASE WHEN fd = day THEN 0 ELSE 1 END) AS dau_devices, sum(CASE WHEN fd = day THEN 0 ELSE n END) AS dau_accounts
    FROM n JOIN f USING ({MARKET}, imei) GROUP BY ALL"""


@query("str04_login_split", f"day:s game_id:i {CH_SPEC} new_login_devices:i new_login_accounts:i dau_devices:i dau_accounts:i", LOGIN_SPLIT)
def login_split(t):
    return kpi.login_split(_published_logins(t), jobs.registration_base(t.regi, t.publish_game))


@query("str22_login_accounts", f"hour:s game_id:i {CH_SPEC} accounts:i devices:i", f"""
    WITH l AS ({LOGIN_BASE})
    SELECT {HOUR.format('login_time')} AS hour, {MARKET}, count(DISTINCT acc) AS accounts, count(DISTINCT imei) AS devices FROM l GROUP BY ALL""")
def login_accounts(t):
    return kpi.login_accounts(jobs.clean_login(t.login), kpi.MARKET)


# paid game orders once each, and the payer's first registration
ORDER_LOG = "o AS (SELECT DISTINCT order_no, order_time, lower(trim(game_account)) AS acc, game_id, imei, coalesce(ori_price, 0) AS ori_price, coalesce(total_amt, 0) AS total_amt FROM orders_g WHERE order_status = 4 AND prod_type = 6)"
MASTER = f"""r AS ({REGI_BASE}), m AS (SELECT acc, cast(reg_time AS date) AS reg_date, game_id AS reg_game_id, parent_channel, child_channel, pkg_code FROM r
    QUALIFY row_number() OVER (PARTITION BY acc ORDER BY reg_time, game_id, parent_channel, child_channel, pkg_code) = 1)"""
PAID = f"""{ORDER_LOG}, {MASTER}, p AS (SELECT o.*, reg_date, coalesce(reg_game_id, 0) AS reg_game_id, coalesce(parent_channel, 'no_acc') AS parent_channel,
    coalesce(child_channel, '') AS child_channel, coalesce(pkg_code, '') AS pkg_code FROM o LEFT JOIN m ON m.acc = o.acc)"""


def _paid(t):
    return kpi.with_account(jobs.clean_order_log(t.orders_g), kpi.account_master(jobs.clean_regi(t.regi)))


@query("str05_pay_devices", f"day:s game_id:i {CH_SPEC} pay_devices:i",
       f"WITH {PAID} SELECT cast(order_time AS date) AS day, {MARKET}, count(DISTINCT imei) AS pay_devices FROM p GROUP BY ALL")
def pay_devices(t):
    return kpi.pay_devices(_paid(t), kpi.MARKET)


@query("str05_pay_devices_opera", "day:s game_id:i pay_devices:i",
       f"WITH {ORDER_LOG} SELECT cast(order_time AS date) AS day, game_id, count(DISTINCT imei) AS pay_devices FROM o GROUP BY ALL")
def pay_devices_opera(t):
    return kpi.pay_devices(jobs.clean_order_log(t.orders_g), kpi.OPERA)


@query("str06_pay_accounts", f"day:s game_id:i {CH_SPEC} pay_accounts:i",
       f"WITH {PAID} SELECT cast(order_time AS date) AS day, {MARKET}, count(DISTINCT acc) AS pay_accounts FROM p GROUP BY ALL")
def pay_accounts(t):
    return kpi.pay_accounts(_paid(t))


@query("str06_pay_accounts_hour", f"hour:s game_id:i {CH_SPEC} pay_accounts:i",
       f"WITH {PAID} SELECT {HOUR.format('order_time')} AS hour, {MARKET}, count(DISTINCT acc) AS pay_accounts FROM p GROUP BY ALL")
def pay_accounts_hour(t):
    return kpi.pay_accounts(_paid(t), "hour")


@query("str06_first_payers", "reg_date:s reg_game_id:i recharge_accounts:i",
       f"WITH {PAID} SELECT reg_date, reg_game_id, count(DISTINCT acc) AS recharge_accounts FROM p GROUP BY ALL")
def first_payers(t):
    return kpi.first_payers(_paid(t))


@query("str07_pay_money", f"day:s game_id:i {CH_SPEC} pay_money:i",
       f"WITH {PAID} SELECT cast(order_time AS date) AS day, {MARKET}, sum(ori_price + total_amt) * 100 AS pay_money FROM p GROUP BY ALL")
def pay_money(t):
    return kpi.pay_money(_paid(t))


@query("str07_pay_money_hour", f"hour:s game_id:i {CH_SPEC} pay_money:i",
       f"WITH {PAID} SELECT {HOUR.format('order_time')} AS hour, {MARKET}, sum(ori_price + total_amt) * 100 AS pay_money FROM p GROUP BY ALL")
def pay_money_hour(t):
    return kpi.pay_money(_paid(t), "hour")


_OFF = "date_diff('day', reg_date, cast(order_time AS date))"


@query("str07_pay_money_ltv", "reg_date:s reg_game_id:i recharge:i " + " ".join(f"ltv_{n}day:i" for n in C.PAY_LTV),
       f"WITH {PAID} SELECT reg_date, reg_game_id, sum(ori_price) * 100 AS recharge, sum(CASE WHEN {_OFF} = 0 THEN ori_price ELSE 0 END) * 100 AS ltv_1day, "
       + ", ".join(f"sum(CASE WHEN {_OFF} <= {n - 1} THEN ori_price ELSE 0 END) * 100 AS ltv_{n}day" for n in C.PAY_LTV[1:]) + " FROM p GROUP BY ALL")
def pay_ltv(t):
    return kpi.pay_ltv(_paid(t))


# --- attribution --------------------------------------------------------------------
LEVELS = "idea_id, first_level, second_level"
STAT = f"game_id, pkg_code, medium, {LEVELS}"
STAT_SPEC = "game_id:i pkg_code:s medium:i idea_id:s first_level:s second_level:s"
GOOD = "replace({0}, '-', '') NOT IN (repeat('0', 32), repeat('0', 15), '')"
DASH = "upper(substr({0}, 1, 8) || '-' || substr({0}, 9, 4) || '-' || substr({0}, 13, 4) || '-' || substr({0}, 17, 4) || '-' || substr({0}, 21))"
# every event against every touch of its key, then the latest: the plain reading of the rule
ACTS = f"""
    ck AS (SELECT event_id AS cid, ts, pkg_id, imei AS cimei, adv_name AS medium, {LEVELS}, CASE WHEN os = 'ios' THEN 2 ELSE 1 END AS os,
                  CASE WHEN os = 'ios' THEN cast(game_id AS varchar) ELSE pkg_id END AS place,
                  CASE WHEN os = 'ios' THEN upper(imei) WHEN adv_name IN (1, 3) THEN upper(imei) ELSE upper(md5(imei)) END AS dev
           FROM ad_click WHERE {GOOD.format('imei')} AND NOT (os = 'android' AND adv_name IN (1, 3) AND imei = '5284047f4ffb4e04824a2fd1d1f0cd62')),
    ak AS (SELECT event_id, active_time AS t, game_id, pkg_code, imei, CASE WHEN os = 'ios' THEN 2 ELSE 1 END AS os,
                  CASE WHEN os = 'ios' THEN cast(game_id AS varchar) ELSE pkg_code END AS place,
                  CASE WHEN os = 'ios' THEN {DASH.format('imei')} ELSE upper(md5(imei)) END AS dev
           FROM ({ACTIVE}) WHERE {GOOD.format('imei')} AND game_id IN (SELECT game_id FROM ad_click)),
    aq AS (SELECT *, lag(t) OVER (PARTITION BY os, place, dev ORDER BY t, event_id) AS prev FROM ak),
    aj AS (SELECT aq.*, ck.ts, ck.pkg_id, ck.cimei, ck.medium, ck.idea_id, ck.first_level, ck.second_level FROM aq JOIN ck USING (os, place, dev)
           WHERE ck.ts <= aq.t AND ck.ts >= cast(aq.t AS date) - INTERVAL 7 DAY AND (prev IS NULL OR ck.ts > prev)
           QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts DESC, medium DESC, pkg_id DESC, cimei DESC, idea_id DESC, first_level DESC, second_level DESC) = 1),
    acts AS (SELECT event_id, t AS active_time, game_id, os, CASE WHEN os = 2 THEN pkg_id ELSE pkg_code END AS pkg_code,
                    CASE WHEN os = 2 THEN cimei ELSE imei END AS imei, medium, {LEVELS} FROM aj)"""
REGS = f"""{ACTS},
    tk AS (SELECT active_time AS ts, medium, {LEVELS}, pkg_code, os, game_id, CASE WHEN os = 2 THEN '' ELSE pkg_code END AS place, upper(imei) AS dev FROM acts),
    rk AS (SELECT event_id, acc, reg_time AS t, game_id, CASE WHEN os = 'android' THEN 1 ELSE 2 END AS os, CASE WHEN os = 'android' THEN pkg_code ELSE '' END AS place,
                  CASE WHEN os = 'ios' AND length(imei) = 32 THEN {DASH.format('imei')} ELSE upper(imei) END AS dev FROM ({REGI_BASE}) WHERE {GOOD.format('imei')}),
    regs AS (SELECT rk.event_id, rk.acc, rk.t AS reg_time, rk.game_id, rk.os, rk.dev AS imei, tk.medium, tk.pkg_code, tk.idea_id, tk.first_level, tk.second_level
             FROM rk JOIN tk USING (os, game_id, place, dev) WHERE tk.ts <= rk.t AND tk.ts > cast(rk.t AS date) - INTERVAL 30 DAY
             QUALIFY row_number() OVER (PARTITION BY rk.event_id ORDER BY tk.ts DESC, tk.medium DESC, tk.idea_id DESC, tk.first_level DESC, tk.second_level DESC, tk.pkg_code DESC) = 1)"""


def first_per_day(rows: str, day: str, entity: str, order: str, count: str, devs: str) -> str:
    return f"""SELECT day, {STAT}, count(*) AS {count}, sum(CASE WHEN rn = 1 THEN 1 ELSE 0 END) AS {devs}
    FROM (SELECT *, {day} AS day, row_number() OVER (PARTITION BY {day}, {entity} ORDER BY {order}) AS rn FROM ({rows})) GROUP BY ALL"""


@query("str08_click_attribution", "event_id:i active_time:s game_id:i os:i pkg_code:s imei:s medium:i idea_id:s first_level:s second_level:s",
       f"WITH {ACTS} SELECT * FROM acts")
def click_attribution(t):
    return jobs.activation_detail(t.active, t.ad_click)


@query("str08_activation_stats", f"day:s {STAT_SPEC} active_num:i",
       f"WITH {ACTS} SELECT cast(active_time AS date) AS day, {STAT}, count(*) AS active_num FROM acts GROUP BY ALL")
def activation_stats(t):
    return attribution.activation_stats(jobs.activation_detail(t.active, t.ad_click))


@query("str09_regi_attribution", f"day:s {STAT_SPEC} regi_num:i regi_dev_num:i",
       f"WITH {REGS} " + first_per_day("SELECT * FROM regs", "cast(reg_time AS date)", "medium, pkg_code, imei", "reg_time, event_id", "regi_num", "regi_dev_num"))
def regi_attribution(t):
    return attribution.registration_stats(jobs.attribution_chain(t.active, t.ad_click, t.regi)[1])


#: The month in ranges of unequal length, as a daily run and its catching up would have them.
RANGES = ((1, 5), (6, 6), (7, 16), (17, 31))
_CHAIN_FOLDERS: dict[tuple[str, str], str] = {}


def daily_chain(t) -> str:
    """The folder of one run of the chain, range after range; each range reads its own days and what the range before has left."""
    key = (t.spark.sparkContext.applicationId, t.dir)
    if key not in _CHAIN_FOLDERS:
        base, games = shared_dir(t.spark, "daily-chain"), t.ad_click.select("game_id").distinct()
        for first, last in RANGES:
            days = (dt.date(2024, 1, first), dt.date(2024, 1, last))
            active, clicks, regi = (jobs.in_days(df, time, days) for df, time in ((t.active, "active_time"), (t.ad_click, "ts"), (t.regi, "reg_time")))
            jobs.daily_chain(t.spark, base, days, active, clicks, regi, games)
        _CHAIN_FOLDERS[key] = base
    return _CHAIN_FOLDERS[key]


@query("jon13_daily_activations", "event_id:i active_time:s game_id:i os:i pkg_code:s imei:s medium:i idea_id:s first_level:s second_level:s", f"WITH {ACTS} SELECT * FROM acts")
def daily_activations(t):
    return t.spark.read.parquet(f"{daily_chain(t)}/activations")


@query("jon15_daily_registrations", f"event_id:i reg_time:s {STAT_SPEC}", f"WITH {REGS} SELECT event_id, reg_time, {STAT} FROM regs")
def daily_registrations(t):
    return t.spark.read.parquet(f"{daily_chain(t)}/registrations")


ORDER_STATS = f"""{REGS}, {ORDER_LOG},
    own AS (SELECT acc, cast(reg_time AS date) AS reg_date, medium, pkg_code, {LEVELS} FROM regs WHERE medium >= 1 AND pkg_code <> ''
            QUALIFY row_number() OVER (PARTITION BY acc ORDER BY reg_time, event_id) = 1),
    os_ AS (SELECT cast(order_time AS date) AS day, o.game_id, o.acc, ori_price + total_amt AS amt,
                   row_number() OVER (PARTITION BY o.acc, cast(order_time AS date) ORDER BY order_time, order_no) AS rn
            FROM o WHERE {GOOD.format('imei')}),
    ostat AS (SELECT day, game_id, pkg_code, medium, {LEVELS}, sum(amt) * 100 AS pay_price, sum(CASE WHEN rn = 1 THEN 1 ELSE 0 END) AS pay_accounts,
                     sum(CASE WHEN reg_date = day THEN amt ELSE 0 END) * 100 AS new_pay_price, sum(CASE WHEN reg_date = day AND rn = 1 THEN 1 ELSE 0 END) AS new_pay_accounts
              FROM os_ JOIN own USING (acc) GROUP BY ALL)"""


@query("str10_order_attribution", f"day:s {STAT_SPEC} pay_price:i pay_accounts:i new_pay_price:i new_pay_accounts:i",
       f"WITH {ORDER_STATS} SELECT * FROM ostat")
def order_attribution(t):
    regs = jobs.attribution_chain(t.active, t.ad_click, t.regi)[1]
    return attribution.order_stats(jobs.clean_order_log(t.orders_g), regs)


CLICK_ROWS = f"SELECT event_id, ts, game_id, pkg_id AS pkg_code, adv_name AS medium, imei, {LEVELS} FROM ad_click WHERE {GOOD.format('imei')} AND NOT (os = 'android' AND adv_name IN (1, 3) AND imei = '5284047f4ffb4e04824a2fd1d1f0cd62')"


@query("str11_click_stats", f"day:s {STAT_SPEC} click_num:i click_dev_num:i",
       first_per_day(CLICK_ROWS, "cast(ts AS date)", "medium, pkg_code, imei", "ts, event_id", "click_num", "click_dev_num"))
def click_stats(t):
    return attribution.click_stats(t.ad_click)


LATEST_SPEC = "pkg_id:s imei:s ts:s callback:s adv_name:i idea_id:s first_level:s second_level:s matched:i"
LATEST_CLICKS = f"""
    WITH {ACTS}, v AS (SELECT * FROM ad_click WHERE {GOOD.format('imei')} AND NOT (os = 'android' AND adv_name IN (1, 3) AND imei = '5284047f4ffb4e04824a2fd1d1f0cd62')),
    w AS (SELECT v.*, (SELECT count(DISTINCT aj.t) FROM aj WHERE aj.pkg_id = v.pkg_id AND aj.cimei = v.imei AND aj.t < v.ts) AS before,
                 (SELECT count(DISTINCT aj.t) FROM aj WHERE aj.pkg_id = v.pkg_id AND aj.cimei = v.imei) AS uses FROM v)
    SELECT pkg_id, imei, max(ts) AS ts, max(callback) FILTER (last = 1) AS callback, max(adv_name) FILTER (first = 1) AS adv_name,
           max(idea_id) FILTER (first = 1) AS idea_id, max(first_level) FILTER (first = 1) AS first_level, max(second_level) FILTER (first = 1) AS second_level,
           CASE WHEN max(uses) > max(before) THEN 1 ELSE 0 END AS matched
    FROM (SELECT *, row_number() OVER (PARTITION BY pkg_id, imei, before ORDER BY ts, event_id) AS first,
                 row_number() OVER (PARTITION BY pkg_id, imei, before ORDER BY ts DESC, callback DESC) AS last FROM w)
    GROUP BY pkg_id, imei, before"""


@query("str11_latest_clicks", LATEST_SPEC, LATEST_CLICKS)
def latest_clicks(t):
    return attribution.click_table(t.ad_click, attribution.matched_clicks(ch.with_channel_parts(t.active, "expand_channel"), t.ad_click))


@query("str12_click_uv", f"publish_time:s game_id:i {CH_SPEC} show_uv:i download_uv:i adpage_click_uv:i request_click_uv:i", f"""
    WITH d AS (SELECT DISTINCT cast(ts AS date) AS publish_time, game_id, {parts('expand_channel')}, type, ip FROM landing WHERE game_id IN (SELECT game_id FROM publish_game))
    SELECT publish_time, {MARKET}, sum(CASE WHEN type = 1 THEN 1 ELSE 0 END) AS show_uv, sum(CASE WHEN type = 2 THEN 1 ELSE 0 END) AS download_uv,
           sum(CASE WHEN type = 3 THEN 1 ELSE 0 END) AS adpage_click_uv, sum(CASE WHEN type = 4 THEN 1 ELSE 0 END) AS request_click_uv FROM d GROUP BY ALL""")
def click_uv(t):
    rows = ch.with_channel_parts(t.landing, "expand_channel").withColumn("publish_time", F.date_format("ts", "yyyy-MM-dd"))
    return kpi.click_uv(rows, t.publish_game)


@query("str13_order_dedup", "order_no:s order_time:s game_account:s game_id:i amount:i",
       f"WITH {ORDER_LOG} SELECT order_no, order_time, acc AS game_account, game_id, (ori_price + total_amt) * 100 AS amount FROM o")
def order_dedup(t):
    return jobs.clean_order_log(t.orders_g).withColumn("amount", (F.col("ori_price") + F.col("total_amt")) * 100)


WALL = """
    a0 AS (SELECT cast(ts AS date) AS day, imei, game_id, ts FROM wall_active),
    a AS (SELECT day, imei, game_id FROM a0 QUALIFY row_number() OVER (PARTITION BY day, imei ORDER BY ts, game_id) = 1),
    c0 AS (SELECT cast(ts AS date) AS day, imei, game_id, ts FROM wall_click),
    c AS (SELECT day, imei, game_id FROM c0 QUALIFY row_number() OVER (PARTITION BY day, imei ORDER BY ts, game_id) = 1),
    pa AS (SELECT DISTINCT game_id, imei, cast(active_time AS date) AS day FROM active),
    re AS (SELECT DISTINCT game_id, imei, cast(reg_time AS date) AS day FROM regi),
    fl AS (SELECT day, game_id, 1 AS mu_active_num,
                  CASE WHEN EXISTS (SELECT 1 FROM pa WHERE pa.game_id = a.game_id AND pa.imei = a.imei AND pa.day < a.day) THEN 1 ELSE 0 END AS repeat_active_num,
                  CASE WHEN EXISTS (SELECT 1 FROM a b WHERE b.game_id = a.game_id AND b.imei = a.imei AND b.day < a.day) THEN 1 ELSE 0 END AS mu_repeat_active_num,
                  CASE WHEN EXISTS (SELECT 1 FROM pa WHERE pa.imei = a.imei AND pa.day = a.day) THEN 1 ELSE 0 END AS own_mu_active_num,
                  CASE WHEN EXISTS (SELECT 1 FROM pa WHERE pa.game_id = a.game_id AND pa.imei = a.imei AND pa.day <= a.day) THEN 0 ELSE 1 END AS own_un_active_num,
                  CASE WHEN EXISTS (SELECT 1 FROM re WHERE re.game_id = a.game_id AND re.imei = a.imei AND re.day = a.day) THEN 1 ELSE 0 END AS regi_active_num,
                  CASE WHEN EXISTS (SELECT 1 FROM re WHERE re.game_id = a.game_id AND re.imei = a.imei AND re.day < a.day) THEN 0 ELSE 1 END AS new_mu_regi_dev_num FROM a),
    u AS (SELECT day, game_id, 1 AS click_num, 0 AS click_dev_num, 0 AS mu_active_num, 0 AS repeat_active_num, 0 AS mu_repeat_active_num, 0 AS own_mu_active_num,
                 0 AS own_un_active_num, 0 AS regi_active_num, 0 AS new_mu_regi_dev_num FROM c0
          UNION ALL SELECT day, game_id, 0, 1, 0, 0, 0, 0, 0, 0, 0 FROM c
          UNION ALL SELECT day, game_id, 0, 0, mu_active_num, repeat_active_num, mu_repeat_active_num, own_mu_active_num, own_un_active_num, regi_active_num, new_mu_regi_dev_num FROM fl),
    w AS (SELECT day, game_id, sum(click_num) AS click_num, sum(click_dev_num) AS click_dev_num, sum(mu_active_num) AS mu_active_num, sum(repeat_active_num) AS repeat_active_num,
                 sum(mu_repeat_active_num) AS mu_repeat_active_num, sum(own_mu_active_num) AS own_mu_active_num, sum(own_un_active_num) AS own_un_active_num,
                 sum(regi_active_num) AS regi_active_num, sum(new_mu_regi_dev_num) AS new_mu_regi_dev_num FROM u GROUP BY ALL)"""
WALL_SPEC = "day:s game_id:i click_num:i click_dev_num:i " + " ".join(f"{f}:i" for f in kpi.WALL_FLAGS)


def _wall(t):
    return kpi.wall_kpi(t.wall_click, t.wall_active, t.active, t.regi)


@query("str15_wall_kpi", WALL_SPEC, f"WITH {WALL} SELECT * FROM w")
def wall_kpi(t):
    return _wall(t)


@query("job22_wall_reconciliation", "day:s game_id:i own_active_num:i own_regi_dev_num:i new_regi_dev_num:i own_repeat_active_num:i natural_regi_dev_num:i new_natural_regi_dev_num:i", f"""
    WITH {WALL}, ak AS (SELECT game_id, imei, min(cast(active_time AS date)) AS day FROM active GROUP BY ALL),
    an AS (SELECT day, game_id, count(*) AS active_num FROM ak GROUP BY ALL),
    rk AS (SELECT DISTINCT cast(reg_time AS date) AS day, game_id, imei, min(cast(reg_time AS date)) OVER (PARTITION BY game_id, imei) AS fd FROM regi),
    rn AS (SELECT day, game_id, count(*) AS regi, sum(CASE WHEN day = fd THEN 1 ELSE 0 END) AS new_regi FROM rk GROUP BY ALL)
    SELECT w.day, w.game_id, coalesce(active_num, 0) AS own_active_num, coalesce(regi, 0) AS own_regi_dev_num, coalesce(new_regi, 0) AS new_regi_dev_num,
           greatest(repeat_active_num - mu_repeat_active_num, 0) AS own_repeat_active_num, greatest(coalesce(regi, 0) - regi_active_num, 0) AS natural_regi_dev_num,
           greatest(coalesce(new_regi, 0) - new_mu_regi_dev_num, 0) AS new_natural_regi_dev_num
    FROM w LEFT JOIN an USING (day, game_id) LEFT JOIN rn USING (day, game_id)""")
def wall_reconciliation(t):
    return jobs.wall_reconciliation(_wall(t), t.active, t.regi)


_MARKET_HOURS = f"SELECT {HOUR.format('reg_time')} AS h, cast(reg_time AS date) AS day, {MARKET}, imei, count(DISTINCT acc) AS n FROM ({REGI_PUB}) GROUP BY ALL"
_NATURAL = ("regi_num", "regi_dev_num", "active_num", "pay_price", "pay_accounts", "new_pay_price", "new_pay_accounts")


def _branch(source: str, day: str = "day", **measures: str) -> str:
    return f"SELECT {day} AS day, game_id, {', '.join(f'{measures.get(m, 0)} AS {m}' for m in _NATURAL)} FROM {source} GROUP BY ALL"


NATURAL_SQL = f"""
    WITH {ORDER_STATS},
    watched AS (SELECT game_id FROM medium_package WHERE feedbackurl <> '' INTERSECT SELECT game_id FROM publish_game),
    rh AS ({_MARKET_HOURS}), rd AS (SELECT DISTINCT cast(reg_time AS date) AS day, game_id, imei FROM ({REGI_PUB})),
    am AS (SELECT game_id, imei, cast(min(active_time) AS date) AS day FROM active GROUP BY game_id, imei),
    fr AS (SELECT acc, min(cast(reg_time AS date)) AS reg_date FROM ({REGI_BASE}) GROUP BY acc),
    op AS (SELECT cast(order_time AS date) AS day, o.game_id, o.acc, (ori_price + total_amt) * 100 AS amt, CASE WHEN reg_date = cast(order_time AS date) THEN 1 ELSE 0 END AS new
           FROM o LEFT JOIN fr ON fr.acc = o.acc),
    tu AS ({_branch('rh', regi_num='sum(n)')} UNION ALL {_branch('rd', regi_dev_num='count(*)')} UNION ALL {_branch('am', active_num='count(*)')}
           UNION ALL {_branch('op', pay_price='sum(amt)', pay_accounts='count(DISTINCT acc)', new_pay_price='sum(amt * new)', new_pay_accounts='count(DISTINCT CASE WHEN new = 1 THEN acc END)')}),
    tot AS (SELECT day, game_id, {', '.join(f'sum({m}) AS {m}' for m in _NATURAL)} FROM tu WHERE game_id IN (SELECT game_id FROM watched) GROUP BY ALL),
    rs AS ({first_per_day("SELECT * FROM regs", "cast(reg_time AS date)", "medium, pkg_code, imei", "reg_time, event_id", "regi_num", "regi_dev_num")}),
    cu AS ({_branch("(SELECT * FROM rs WHERE pkg_code <> '')", regi_num='sum(regi_num)', regi_dev_num='sum(regi_dev_num)')}
           UNION ALL {_branch("(SELECT * FROM acts WHERE pkg_code <> '')", 'cast(active_time AS date)', active_num='count(*)')}
           UNION ALL {_branch("(SELECT * FROM ostat WHERE pkg_code <> '')", pay_price='sum(pay_price)', pay_accounts='sum(pay_accounts)', new_pay_price='sum(new_pay_price)', new_pay_accounts='sum(new_pay_accounts)')}),
    cl AS (SELECT day, game_id, {', '.join(f'sum({m}) AS {m}' for m in _NATURAL)} FROM cu GROUP BY ALL)
    SELECT tot.day, tot.game_id, g.group_id, {', '.join(f'tot.{m} - coalesce(cl.{m}, 0) AS {m}' for m in _NATURAL)}
    FROM tot JOIN game_sdk g ON g.old_game_id = tot.game_id LEFT JOIN cl ON cl.day = tot.day AND cl.game_id = tot.game_id WHERE {in_run('tot.day')}"""


@query("job13_natural_residual", "day:s game_id:i group_id:i " + " ".join(f"{m}:i" for m in _NATURAL), NATURAL_SQL)
def natural_residual(t):
    acts, regs = jobs.attribution_chain(t.active, t.ad_click, t.regi)
    return jobs.natural_traffic(t.regi, t.active, jobs.clean_order_log(t.orders_g), acts, regs, t.publish_game, t.game_sdk, t.medium_package, DAYS)


_SEEN: dict[tuple[str, str], FirstSeen] = {}


def first_seen(t) -> FirstSeen:
    """The dimensions after the month's ranges up to the reported days, each added once; the second comes twice, as after a rerun."""
    key = (t.spark.sparkContext.applicationId, t.dir)
    if key not in _SEEN:
        seen = FirstSeen(t.spark, shared_dir(t.spark, "first-seen"), 8)
        regs = t.spark.read.parquet(f"{daily_chain(t)}/registrations")
        for version, (first, last) in enumerate((*RANGES[:2], RANGES[1], *RANGES[2:])):
            days = (dt.date(2024, 1, first), dt.date(2024, 1, last))
            seen.add(jobs.clean_regi(jobs.in_days(t.regi, "reg_time", days)), jobs.in_days(t.active, "active_time", days), jobs.in_days(regs, "reg_time", days), version)
        _SEEN[key] = seen
    return _SEEN[key]


@query("job11_first_seen_performance", f"day:s game_id:i {CH_SPEC} pay_type:s pay_water:i box_water:i regi_num:i",
       f"WITH {PERF_SQL} SELECT day, game_id, parent_channel, child_channel, pkg_code, pay_type, pay_water, box_water, regi_num FROM p WHERE {in_run('day')}")
def first_seen_performance(t):
    # no registration before the reported days is there to be read
    regi = jobs.in_days(t.regi, "reg_time", DAYS)
    return jobs.performance(regi, t.orders_g, t.receipts, t.publish_game, t.game_sdk, DAYS, first_seen(t).accounts.read())


@query("job13_first_seen_natural", "day:s game_id:i group_id:i " + " ".join(f"{m}:i" for m in _NATURAL), NATURAL_SQL)
def first_seen_natural(t):
    acts, regs = (jobs.in_days(t.spark.read.parquet(f"{daily_chain(t)}/{name}"), time, DAYS) for name, time in (("activations", "active_time"), ("registrations", "reg_time")))
    regi, active = jobs.in_days(t.regi, "reg_time", DAYS), jobs.in_days(t.active, "active_time", DAYS)
    return jobs.natural_traffic(regi, active, jobs.clean_order_log(t.orders_g), acts, regs, t.publish_game, t.game_sdk, t.medium_package, DAYS, first_seen(t))


_DAY_METRICS = ("regi_accounts", "new_regi_accounts", "regi_devices", "new_regi_devices")


@query("job19_registration_rerun", f"day:s game_id:i {CH_SPEC} {REGI_OUT}", f"""
    SELECT day, {MARKET}, {', '.join(f"CASE WHEN {in_run('day')} THEN {m} ELSE -1 END AS {m}" for m in _DAY_METRICS)} FROM ({_registration("day", MARKET)})
    UNION ALL SELECT '{DAYS[0]}', 999, 'gone', 's', 'p', 0, 0, 0, 0""")
def registration_rerun(t):
    # a table full of wrong numbers, with a key the log does not have: the run mends its own days and leaves the others alone
    table = kpi.registration_kpi(jobs.registration_base(t.regi, t.publish_game), kpi.MARKET)
    wrong = table.withColumns({m: F.lit(-1).cast("long") for m in _DAY_METRICS})
    gone = t.spark.range(1).select(F.lit(str(DAYS[0])).alias("day"), F.lit(999).alias("game_id"), F.lit("gone").alias("parent_channel"), F.lit("s").alias("child_channel"),
                                   F.lit("p").alias("pkg_code"), *[F.lit(7).cast("long").alias(m) for m in _DAY_METRICS])
    path = shared_dir(t.spark, "registration-days")
    merge.overwrite_days(wrong.unionByName(gone), path, "day")
    jobs.registration_rerun(path, t.regi, t.publish_game, DAYS)
    return t.spark.read.parquet(path)


# --- the combined daily report: some packages hold a backslash and do not show up ------------------------------
SLASHED = "CASE WHEN event_id % 41 = 0 THEN 'm1_s1_p\\x' ELSE expand_channel END"
_KEY = f"day, {MARKET}"
_ON = " AND ".join(f"k.{c} = {{0}}.{c}" for c in ("day", *MARKET.split(", ")))
_TEXT_DAY = "cast(day AS varchar) AS day"
_UPTO = f"cast(reg_time AS date) <= date '{DAYS[1]}'"
REPORT = ("adpage_click_uv", "request_click_uv", "download_uv", "new_regi_device_num", "new_login_device_num", "new_active_device_num", "new_regi_account_num",
          "new_regi_device_login_num", "active_num", "order_num", "order_amount", "retained_1day", "retained_3day", "retained_7day", "order_amount_1day", "order_amount_3day", "order_amount_7day")
_DAILY = f"""
    WITH q1 AS (SELECT day, {MARKET}, new_regi_devices AS new_regi_device_num, new_regi_accounts AS new_regi_account_num FROM ({_registration("day", MARKET)})),
    q2 AS (SELECT {_TEXT_DAY}, {MARKET}, new_login_devices AS new_login_device_num, new_active_devices AS new_active_device_num FROM ({_login_kpi(MARKET, True)})),
    q3 AS (SELECT cast(cast(t AS date) AS varchar) AS day, {MARKET}, count(*) AS active_num
           FROM (SELECT {MARKET}, imei, min(active_time) AS t FROM ({ACTIVE}) WHERE game_id IN (SELECT game_id FROM publish_game) GROUP BY ALL) GROUP BY ALL),
    q4 AS (SELECT cast(day AS varchar) AS day, {MARKET}, sum(CASE WHEN type = 3 THEN 1 ELSE 0 END) AS adpage_click_uv, sum(CASE WHEN type = 4 THEN 1 ELSE 0 END) AS request_click_uv,
                  sum(CASE WHEN type = 2 THEN 1 ELSE 0 END) AS download_uv
           FROM (SELECT DISTINCT cast(ts AS date) AS day, game_id, {parts('expand_channel')}, type, ip FROM landing WHERE game_id IN (SELECT game_id FROM publish_game)) GROUP BY ALL),
    q5 AS (WITH {PAID.replace(f"r AS ({REGI_BASE})", f"r AS (SELECT * FROM ({REGI_BASE}) WHERE {_UPTO})")}
           SELECT cast(cast(order_time AS date) AS varchar) AS day, {MARKET}, count(DISTINCT imei) AS order_num, sum(ori_price + total_amt) * 100 AS order_amount
           FROM p WHERE game_id IN (SELECT game_id FROM publish_game) GROUP BY ALL),
    keys AS (SELECT {_KEY} FROM q1 UNION SELECT {_KEY} FROM q2 UNION SELECT {_KEY} FROM q3 UNION SELECT {_KEY} FROM q4 UNION SELECT {_KEY} FROM q5),
    k AS (SELECT * FROM keys WHERE {in_run('day')} AND NOT contains(pkg_code, '\\')),
    r AS ({REGI_PUB}),
    fd AS (SELECT {MARKET}, imei, cast(min(reg_time) AS date) AS fd FROM r GROUP BY ALL),
    a1 AS (SELECT cast(fd AS varchar) AS day, {MARKET}, sum(CASE WHEN dur = 1 THEN 1 ELSE 0 END) AS retained_1day, sum(CASE WHEN dur = 2 THEN 1 ELSE 0 END) AS retained_3day,
                  sum(CASE WHEN dur = 6 THEN 1 ELSE 0 END) AS retained_7day
           FROM (SELECT DISTINCT fd.*, date_diff('day', fd, cast(l.login_time AS date)) AS dur FROM fd JOIN login l ON l.imei = fd.imei) GROUP BY ALL),
    mem AS (SELECT acc, game_id, cast(reg_time AS date) AS md, parent_channel, child_channel, pkg_code FROM r
            QUALIFY row_number() OVER (PARTITION BY acc, game_id ORDER BY reg_time, parent_channel, child_channel, pkg_code) = 1),
    po AS ({PAID_ORDERS} WHERE order_status IN (4, 8)),
    a2 AS (SELECT cast(md AS varchar) AS day, mem.game_id, parent_channel, child_channel, pkg_code,
                  {', '.join(f"coalesce(sum(CASE WHEN date_diff('day', md, cast(order_time AS date)) BETWEEN 0 AND {n - 1} THEN {SIGNED_GROSS} END), 0) * 100 AS order_amount_{n}day" for n in (1, 3, 7))}
           FROM mem JOIN po ON po.acc = mem.acc AND po.game_id = mem.game_id GROUP BY ALL),
    a3 AS (SELECT cast(r.day AS varchar) AS day, r.game_id, r.parent_channel, r.child_channel, r.pkg_code, count(l.game_account) AS new_regi_device_login_num
           FROM (SELECT DISTINCT cast(reg_time AS date) AS day, {MARKET}, imei FROM r) r
           JOIN (SELECT cast(login_time AS date) AS day, {parts('channel_expand')}, imei, game_account FROM login WHERE game_id IN (SELECT game_id FROM publish_game)) l
             ON l.day = r.day AND l.imei = r.imei AND l.parent_channel = r.parent_channel AND l.child_channel = r.child_channel AND l.pkg_code = r.pkg_code GROUP BY ALL)
    SELECT k.*, {', '.join(f'coalesce({m}, 0) AS {m}' for m in REPORT)},
           coalesce(f.promotion_channel, '') AS promotion_channel, coalesce(f.medium_account, '') AS medium_account, coalesce(f.promotion_mode, '') AS promotion_mode,
           coalesce(f.head_people, '') AS head_people, coalesce(g.game_id, 0) AS parent_game_id, coalesce(g.system_type, 1) AS os, coalesce(g.group_id, 0) AS group_id
    FROM k {' '.join(f'LEFT JOIN {q} ON {_ON.format(q)}' for q in ('q1', 'q2', 'q3', 'q4', 'q5', 'a1', 'a2', 'a3'))}
    LEFT JOIN fxdim f ON f.pkg_code = k.pkg_code AND cast(k.day AS date) BETWEEN f.mstart_date AND f.mend_date AND cast(k.day AS date) BETWEEN f.astart_date AND f.aend_date
    LEFT JOIN game_sdk g ON g.old_game_id = k.game_id"""


@query("job12_daily_report", f"day:s game_id:i {CH_SPEC} " + " ".join(f"{m}:i" for m in REPORT) + f" {ATTRS}",
       re.sub(r"\bFROM regi\b", lambda _: f"FROM (SELECT * REPLACE ({SLASHED} AS expand_channel) FROM regi) regi", _DAILY))
def daily_report(t):
    regi = t.regi.withColumn("expand_channel", F.when(F.col("event_id") % 41 == 0, "m1_s1_p\\x").otherwise(F.col("expand_channel")))
    return jobs.daily_report(regi, t.login, t.active, t.orders_g, t.landing, t.publish_game, t.game_sdk, t.fxdim, DAYS)
