"""Report jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from playcohort import constants as C
from playcohort.functions import channel as ch
from playcohort.operators import attribution, dims, kpi, members, merge, revenue
from playcohort.operators.ltv import daily_spend, distinct_orders, ltv, ltv_by_join
from playcohort.operators.cohort import ActivityBits
from playcohort.plans import jobs
from playcohort.session import shared_dir
from suite.registry import query

RUN_DAY = dt.date(2024, 1, 30)

CLEAN = "CASE WHEN {0} IS NULL OR {0} IN ('', '0') THEN '21' ELSE {0} END"
PARENT = "CASE WHEN {0} IS NULL OR {0} IN ('', '0') THEN '21' WHEN split_part({0}, '_', 1) = '' THEN '21' ELSE split_part({0}, '_', 1) END"
CHILD = "CASE WHEN {0} IS NULL THEN '' ELSE split_part({0}, '_', 2) END"
PKG = "CASE WHEN {0} IS NULL THEN '' ELSE split_part({0}, '_', 3) END"


def parts(col: str) -> str:
    return f"{PARENT.format(col)} AS parent_channel, {CHILD.format(col)} AS child_channel, {PKG.format(col)} AS pkg_code"


RETAINED_SHORT = " ".join(f"retained_{n}day:i" for n in C.RETENTION_SHORT)
RETAINED_LONG = " ".join(f"retained_{n}day:i" for n in C.RETENTION_LONG)


def retained(offsets) -> str:
    return ", ".join(f"sum(CASE WHEN dur = {n} THEN 1 ELSE 0 END) AS retained_{n}day" for n in offsets)


def in_list(xs) -> str:
    return "(" + ", ".join(map(str, xs)) + ")"


JOB01 = f"""
    WITH r AS (SELECT cast(reg_time AS date) AS reg_date, game_id, {CLEAN.format('expand_channel')} AS channel, lower(trim(game_account)) AS acc
               FROM regi WHERE game_id IN (SELECT game_id FROM publish_game)
                 AND cast(reg_time AS date) BETWEEN date '2023-12-02' AND date '2024-01-30'),
    c AS (SELECT reg_date, game_id, channel, count(*) AS accounts FROM r GROUP BY 1, 2, 3),
    d AS (SELECT DISTINCT r.reg_date, r.game_id, r.channel, r.acc, date_diff('day', r.reg_date, cast(l.login_time AS date)) AS dur
          FROM r JOIN login l ON r.acc = lower(trim(l.game_account)) WHERE cast(l.login_time AS date) > r.reg_date
            AND cast(l.login_time AS date) <= date '2024-01-30')
    SELECT d.reg_date, d.game_id, d.channel, max(c.accounts) AS accounts, {retained(C.RETENTION_SHORT)}
    FROM d JOIN c ON d.reg_date = c.reg_date AND d.game_id = c.game_id AND d.channel = c.channel
    WHERE dur IN {in_list(C.RETENTION_SHORT)} GROUP BY 1, 2, 3"""


@query("job01_account_retention", f"reg_date:s game_id:i channel:s accounts:i {RETAINED_SHORT}", JOB01)
def account_retention(t):
    return jobs.account_retention(t.regi, t.login, t.publish_game, RUN_DAY)


def _kept_logins(t, entity: str, clean) -> ActivityBits:
    """Logins of the month kept as bits, range after range from that range's log alone; one range comes twice."""
    kept = ActivityBits(t.spark, shared_dir(t.spark, "login-bits"), entity, dt.date(2023, 12, 5), 8)
    for version, (first, last) in enumerate(((1, 9), (10, 10), (1, 9), (11, 31))):
        kept.add(clean(jobs.in_days(t.login, "login_time", (dt.date(2024, 1, first), dt.date(2024, 1, last)))), "login_time", version)
    return kept


@query("agg03_kept_bits_accounts", f"reg_date:s game_id:i channel:s accounts:i {RETAINED_SHORT}", JOB01)
def kept_account_retention(t):
    return jobs.account_retention(t.regi, _kept_logins(t, "game_account string", jobs.clean_accounts), t.publish_game, RUN_DAY)


ATTRS = "promotion_channel:s medium_account:s promotion_mode:s head_people:s parent_game_id:i os:i group_id:i"
WITH_ATTRS = """
    SELECT k.*, coalesce(f.promotion_channel, '') AS promotion_channel, coalesce(f.medium_account, '') AS medium_account,
           coalesce(f.promotion_mode, '') AS promotion_mode, coalesce(f.head_people, '') AS head_people,
           coalesce(g.game_id, 0) AS parent_game_id, coalesce(g.system_type, 1) AS os, coalesce(g.group_id, 0) AS group_id
    FROM k LEFT JOIN fxdim f ON split_part(k.channel, '_', 3) = f.pkg_code AND k.reg_date BETWEEN f.mstart_date AND f.mend_date
         AND k.reg_date BETWEEN f.astart_date AND f.aend_date
         LEFT JOIN game_sdk g ON g.old_game_id = k.game_id"""


JOB02 = f"""
    WITH r AS (SELECT game_id, {CLEAN.format('expand_channel')} AS channel, imei, cast(min(reg_time) AS date) AS reg_date FROM regi
               WHERE game_id IN (SELECT game_id FROM publish_game) AND cast(reg_time AS date) BETWEEN date '2024-01-01' AND date '2024-01-30'
               GROUP BY 1, 2, 3),
    d AS (SELECT DISTINCT r.*, date_diff('day', r.reg_date, cast(l.login_time AS date)) AS dur FROM r JOIN login l ON r.imei = l.imei
          WHERE cast(l.login_time AS date) BETWEEN date '2024-01-01' AND date '2024-01-30'),
    k AS (SELECT reg_date, game_id, channel, {retained(C.RETENTION_LONG)} FROM d WHERE dur IN {in_list(C.RETENTION_LONG)} GROUP BY 1, 2, 3)
    {WITH_ATTRS}"""


@query("job02_device_retention_effective_dim", f"reg_date:s game_id:i channel:s {RETAINED_LONG} {ATTRS}", JOB02)
def device_retention(t):
    return jobs.device_retention(t.regi, t.login, t.publish_game, t.game_sdk, t.fxdim, RUN_DAY)


@query("agg04_kept_bits_devices", f"reg_date:s game_id:i channel:s {RETAINED_LONG} {ATTRS}", JOB02)
def kept_device_retention(t):
    return jobs.device_retention(t.regi, _kept_logins(t, "imei string", lambda rows: rows), t.publish_game, t.game_sdk, t.fxdim, RUN_DAY)


@query("job02_account_retention_effective_dim", f"reg_date:s game_id:i channel:s {RETAINED_LONG} {ATTRS}", f"""
    WITH d AS (SELECT DISTINCT cast(r.reg_time AS date) AS reg_date, r.game_id, {CLEAN.format('r.expand_channel')} AS channel,
                      lower(trim(r.game_account)) AS acc, date_diff('day', cast(r.reg_time AS date), cast(l.login_time AS date)) AS dur
               FROM regi r JOIN login l ON lower(trim(r.game_account)) = lower(trim(l.game_account))
               WHERE r.game_id IN (SELECT old_game_id FROM game_sdk) AND cast(r.reg_time AS date) BETWEEN date '2024-01-01' AND date '2024-01-30'
                 AND cast(l.login_time AS date) <= date '2024-02-29'),
    k AS (SELECT reg_date, game_id, channel, {retained(C.RETENTION_LONG)} FROM d WHERE dur IN {in_list(C.RETENTION_LONG)} GROUP BY 1, 2, 3)
    {WITH_ATTRS}""")
def account_retention_long(t):
    return jobs.account_retention_long(t.regi, t.login, t.game_sdk, t.fxdim, RUN_DAY)


GAME = "parent_game_id:i os:i group_id:i"
GAME_SQL = "g.game_id AS parent_game_id, g.system_type AS os, g.group_id AS group_id"


@query("job03_opera_device_retention", f"reg_date:s game_id:i {RETAINED_LONG} {GAME}", f"""
    WITH d AS (SELECT DISTINCT cast(r.reg_time AS date) AS reg_date, r.game_id, r.imei,
                      date_diff('day', cast(r.reg_time AS date), cast(l.login_time AS date)) AS dur
               FROM regi r JOIN login l ON r.imei = l.imei AND r.game_id = l.game_id
               WHERE cast(r.reg_time AS date) BETWEEN date '2024-01-01' AND date '2024-01-30' AND cast(l.login_time AS date) < date '2024-01-30'),
    k AS (SELECT reg_date, game_id, {retained(C.RETENTION_LONG)} FROM d WHERE dur IN {in_list(C.RETENTION_LONG)} GROUP BY 1, 2)
    SELECT k.*, {GAME_SQL} FROM k JOIN game_sdk g ON g.old_game_id = k.game_id AND g.state = 0""")
def opera_device_retention(t):
    return jobs.opera_device_retention(t.regi, t.login, t.game_sdk, RUN_DAY)


def ltv_sums(horizons, shift=0) -> str:
    return ", ".join(f"coalesce(sum(CASE WHEN off BETWEEN 0 AND {n - 1} THEN amt END) * 100, 0) AS ltv_{n - shift}day" for n in horizons)


PAID_ORDERS = "SELECT DISTINCT order_no, order_time, lower(trim(game_account)) AS acc, game_id, ori_price, total_amt, payment_type, order_status, prod_type FROM orders_g"
SIGNED_GROSS = "(CASE WHEN order_status = 4 THEN 1 ELSE -1 END) * (coalesce(ori_price, 0) + coalesce(total_amt, 0))"


@query("job04_ltv_short", "reg_date:s game_id:i channel:s accounts:i " + " ".join(f"ltv_{n - 1}day:i" for n in C.LTV_SHORT), f"""
    WITH r AS (SELECT DISTINCT cast(reg_time AS date) AS reg_date, game_id, {CLEAN.format('expand_channel')} AS channel, lower(trim(game_account)) AS acc
               FROM regi WHERE game_id IN (SELECT game_id FROM publish_game) AND cast(reg_time AS date) BETWEEN date '2023-12-02' AND date '2024-01-30'),
    o AS ({PAID_ORDERS} WHERE order_status IN (4, 8)),
    j AS (SELECT r.*, date_diff('day', r.reg_date, cast(o.order_time AS date)) AS off,
                 (CASE WHEN order_status = 4 THEN 1 ELSE -1 END) * coalesce(ori_price, 0) AS amt FROM r LEFT JOIN o ON r.acc = o.acc)
    SELECT reg_date, game_id, channel, count(DISTINCT acc) AS accounts, {ltv_sums(C.LTV_SHORT, 1)} FROM j GROUP BY 1, 2, 3""")
def ltv_short(t):
    return jobs.ltv_short(t.regi, t.orders_g, t.publish_game, RUN_DAY)


LONG_SPEC = "reg_date:s game_id:i channel:s accounts:i " + " ".join(f"ltv_{n}day:i" for n in C.LTV_LONG)
LONG_SQL = f"""
    WITH r AS (SELECT cast(min(reg_time) AS date) AS reg_date, game_id, {CLEAN.format('max(expand_channel)')} AS channel, lower(trim(game_account)) AS acc
               FROM regi WHERE game_id IN (SELECT game_id FROM publish_game) GROUP BY game_id, lower(trim(game_account))),
    o AS ({PAID_ORDERS} WHERE order_status IN (4, 8)),
    j AS (SELECT r.*, date_diff('day', r.reg_date, cast(o.order_time AS date)) AS off, {SIGNED_GROSS} AS amt
          FROM r LEFT JOIN o ON r.acc = o.acc AND r.game_id = o.game_id
          WHERE r.reg_date BETWEEN date '2023-08-03' AND date '2024-01-30')
    SELECT reg_date, game_id, channel, count(DISTINCT acc) AS accounts, {ltv_sums(C.LTV_LONG)} FROM j GROUP BY 1, 2, 3"""


@query("job05_ltv_long", LONG_SPEC, LONG_SQL)
def ltv_long(t):
    return jobs.ltv_long(t.regi, t.orders_g, t.publish_game, RUN_DAY)


@query("job05_ltv_long_by_join", LONG_SPEC, LONG_SQL)
def ltv_long_by_join(t):
    return jobs.ltv_long(t.regi, t.orders_g, t.publish_game, RUN_DAY, by_join=True)


CUSTOMER_SPEC = "reg_date:s game_id:i accounts:i " + " ".join(f"ltv_{n}day:i" for n in C.LTV_LONG)
CUSTOMER_SQL = f"""
    WITH m AS (SELECT c_custkey, c_nationkey AS game_id, cast(first_date AS date) AS reg_date FROM customer JOIN long_first ON c_custkey = o_custkey),
    j AS (SELECT m.*, date_diff('day', m.reg_date, cast(o_orderdate AS date)) AS off,
                 (CASE WHEN o_orderstatus = 'P' THEN -1 ELSE 1 END) * cast(o_totalprice AS decimal(18,2)) AS amt
          FROM m JOIN orders ON c_custkey = orders.o_custkey)
    SELECT reg_date, game_id, count(DISTINCT c_custkey) AS accounts, {ltv_sums(C.LTV_LONG)} FROM j GROUP BY 1, 2"""


def _customer_ltv(t, build):
    first = t.orders.groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("reg_date"))
    cohort = first.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "reg_date", F.col("c_nationkey").alias("game_id"), F.col("c_custkey").alias("game_account"))
    rows = t.orders.select(
        F.col("o_custkey").alias("game_account"), F.col("o_orderdate").alias("order_time"), F.col("o_totalprice").alias("ori_price"),
        F.when(F.col("o_orderstatus") == "P", C.REFUNDED).otherwise(C.PAID).alias("order_status"))
    spend = daily_spend(rows, ["game_account"], gross=False)
    return build(cohort, spend, ["game_account"], ["reg_date", "game_id"], C.LTV_LONG)


@query("job05_customer_ltv", CUSTOMER_SPEC, CUSTOMER_SQL)
def customer_ltv(t):
    return _customer_ltv(t, ltv)


@query("job05_customer_ltv_by_join", CUSTOMER_SPEC, CUSTOMER_SQL)
def customer_ltv_by_join(t):
    return _customer_ltv(t, ltv_by_join)


def _opera(n):
    return (f"coalesce(sum(CASE WHEN off BETWEEN 0 AND {n - 1} THEN b END), 0) AS amountb{n}, "
            f"coalesce(sum(CASE WHEN off BETWEEN 0 AND {n - 1} THEN a END), 0) AS amounta{n}")


OPERA_SPEC = ("reg_date:s game_id:i game_count:i device_count:i behalf_water:i publish_cost:i amount_b:i amount_a:i "
              + " ".join(f"amountb{n}:i amounta{n}:i" for n in C.LTV_LONG) + " parent_game_id:i os:i group_id:i")


@query("job06_opera_ltv_share", OPERA_SPEC, f"""
    WITH r AS (SELECT game_id, imei, lower(trim(game_account)) AS acc, cast(min(reg_time) AS date) AS reg_date FROM regi
               WHERE game_id IN (SELECT game_id FROM publish_game) GROUP BY 1, 2, 3),
    c AS (SELECT game_id, reg_date, count(*) AS game_count, count(DISTINCT imei) AS device_count FROM r GROUP BY 1, 2),
    o AS (SELECT game_id, cast(order_time AS date) AS day, sum(coalesce(ori_price, 0) + coalesce(total_amt, 0)) AS price
          FROM ({PAID_ORDERS} WHERE order_status = 4 AND prod_type = 6) GROUP BY 1, 2),
    m AS (SELECT o.game_id, o.day, cast(price * 100 AS bigint) AS b, cast(price * coalesce(rate, 0) AS decimal(24,2)) AS a, NULL AS proxy, NULL AS publish_cost
          FROM o LEFT JOIN shares s ON s.game_id = o.game_id AND s.month = date_trunc('month', o.day)
          UNION ALL
          SELECT c.game_id, c.cost_date, -proxy, cast(-proxy * coalesce(rate, 0) / 100.0 AS decimal(24,2)), proxy, publish_cost
          FROM costs c LEFT JOIN shares s ON s.game_id = c.game_id AND s.month = date_trunc('month', c.cost_date)),
    j AS (SELECT c.*, m.a, m.b, m.proxy, m.publish_cost, date_diff('day', c.reg_date, m.day) AS off FROM c LEFT JOIN m ON m.game_id = c.game_id),
    k AS (SELECT reg_date, game_id, max(game_count) AS game_count, max(device_count) AS device_count, coalesce(sum(proxy), 0) AS behalf_water,
                 coalesce(max(CASE WHEN publish_cost IS NOT NULL THEN CASE WHEN off = 0 THEN 0 ELSE publish_cost END END), 0) AS publish_cost,
                 coalesce(sum(b), 0) AS amount_b, cast(trunc(coalesce(sum(a), 0)) AS bigint) AS amount_a,
                 {", ".join(_opera(n).replace(f"coalesce(sum(CASE WHEN off BETWEEN 0 AND {n - 1} THEN a END), 0)", f"trunc(coalesce(sum(CASE WHEN off BETWEEN 0 AND {n - 1} THEN a END), 0))") for n in C.LTV_LONG)}
          FROM j GROUP BY 1, 2)
    SELECT k.*, {GAME_SQL} FROM k JOIN game_sdk g ON g.old_game_id = k.game_id""")
def opera_ltv_share(t):
    return jobs.opera_ltv_share(t.regi, t.orders_g, t.publish_game, t.game_sdk, t.shares, t.costs, RUN_DAY)


@query("job07_pay_curve", "reg_date:s game_id:i channel:s date_diff:i pays:i pay_amount:i", f"""
    WITH r AS (SELECT DISTINCT cast(reg_time AS date) AS reg_date, game_id, {CLEAN.format('expand_channel')} AS channel, lower(trim(game_account)) AS acc
               FROM regi WHERE cast(reg_time AS date) > date '2024-01-15' AND cast(reg_time AS date) <= date '2024-01-30'),
    o AS ({PAID_ORDERS} WHERE order_status = 4 AND cast(order_time AS date) > date '2024-01-15' AND cast(order_time AS date) <= date '2024-01-30'
            AND game_id IN (SELECT game_id FROM publish_game WHERE status = 1)),
    d AS (SELECT r.*, cast(o.order_time AS date) AS od, cast(day AS date) AS day,
                 CASE WHEN cast(day AS date) = cast(o.order_time AS date) THEN coalesce(ori_price, 0) ELSE 0 END AS amt
          FROM r JOIN o ON r.acc = o.acc,
               LATERAL (SELECT unnest(generate_series(cast(o.order_time AS date), least(cast(o.order_time AS date) + 15, date '2024-01-30'), INTERVAL 1 DAY)) AS day)),
    n AS (SELECT *, row_number() OVER (PARTITION BY game_id, channel, acc, reg_date ORDER BY day) AS rw FROM d)
    SELECT DISTINCT reg_date, game_id, channel, date_diff('day', reg_date, day) + 1 AS date_diff,
           sum(CASE WHEN rw = 1 THEN 1 ELSE 0 END) OVER w AS pays, sum(amt) OVER w * 100 AS pay_amount
    FROM n WINDOW w AS (PARTITION BY game_id, channel, reg_date ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def pay_curve_report(t):
    return jobs.gamepay_curve(t.regi, t.orders_g, t.publish_game, RUN_DAY)


def band_sums(value, bands, prefix, half_open=False, extra="") -> str:
    from playcohort.operators.bands import band_name
    out = []
    for low, high in bands:
        test = " AND ".join(x for x in (f"{value} >= {low}" if low is not None else "",
                                        (f"{value} < {high}" if half_open else f"{value} <= {high}") if high is not None else "") if x)
        out.append(f"sum(CASE WHEN {test}{extra} THEN 1 ELSE 0 END) AS {band_name(prefix, (low, high))}")
    return ", ".join(out)


def band_spec(bands, prefix) -> str:
    from playcohort.operators.bands import band_name
    return " ".join(f"{band_name(prefix, b)}:i" for b in bands)


CH_SPEC = "parent_channel:s child_channel:s pkg_code:s"
DAYS = (dt.date(2024, 1, 5), dt.date(2024, 1, 25))


def in_run(time: str) -> str:
    return f"cast({time} AS date) BETWEEN date '{DAYS[0]}' AND date '{DAYS[1]}'"


@query("job08_login_histogram", f"day:s game_id:i {CH_SPEC} {band_spec(C.LOGINS_PER_DEVICE, 'dau_lg_')} dau_lg_times:i {GAME}", f"""
    WITH l AS (SELECT cast(login_time AS date) AS day, game_id, {parts('channel_expand')}, imei, count(game_account) AS cs FROM login
               WHERE game_id IN (SELECT game_id FROM publish_game) AND {in_run('login_time')} GROUP BY 1, 2, 3, 4, 5, 6),
    k AS (SELECT day, game_id, parent_channel, child_channel, pkg_code, {band_sums('cs', C.LOGINS_PER_DEVICE, 'dau_lg_')}, sum(cs) AS dau_lg_times
          FROM l GROUP BY 1, 2, 3, 4, 5)
    SELECT k.*, {GAME_SQL} FROM k JOIN game_sdk g ON g.old_game_id = k.game_id""")
def login_histogram(t):
    return jobs.login_histogram(t.login, t.publish_game, t.game_sdk, DAYS)


@query("job08_new_device_login_histogram", f"day:s game_id:i {CH_SPEC} {band_spec(C.LOGINS_PER_DEVICE, 'dev_add_lg_')} dev_add_lg_times:i {GAME}", f"""
    WITH l AS (SELECT cast(login_time AS date) AS day, {parts('channel_expand')}, imei, game_account FROM login WHERE game_id IN (SELECT game_id FROM publish_game)),
    r AS (SELECT DISTINCT cast(reg_time AS date) AS day, game_id, {parts('expand_channel')}, imei FROM regi WHERE game_id IN (SELECT game_id FROM publish_game) AND {in_run('reg_time')}),
    c AS (SELECT r.day, r.game_id, r.parent_channel, r.child_channel, r.pkg_code, r.imei, count(l.game_account) AS cs
          FROM r JOIN l ON r.day = l.day AND r.imei = l.imei AND r.pkg_code = l.pkg_code AND r.parent_channel = l.parent_channel AND r.child_channel = l.child_channel
          GROUP BY 1, 2, 3, 4, 5, 6),
    k AS (SELECT day, game_id, parent_channel, child_channel, pkg_code, {band_sums('cs', C.LOGINS_PER_DEVICE, 'dev_add_lg_')}, sum(cs) AS dev_add_lg_times
          FROM c GROUP BY 1, 2, 3, 4, 5)
    SELECT k.*, {GAME_SQL} FROM k JOIN game_sdk g ON g.old_game_id = k.game_id""")
def new_device_login_histogram(t):
    return jobs.new_device_login_histogram(t.regi, t.login, t.publish_game, t.game_sdk, DAYS)


@query("job09_spend_bands", f"reg_date:s game_id:i {CH_SPEC} {band_spec(C.SPEND_BANDS, 'recharge_accounts_')} payers:i {GAME}", f"""
    WITH o AS ({PAID_ORDERS} WHERE order_status IN (4, 8) AND prod_type = 6 AND game_id IN (SELECT game_id FROM publish_game)),
    r AS (SELECT lower(trim(game_account)) AS acc, arg_min(cast(reg_time AS date), event_id) AS reg_date, arg_min(coalesce(expand_channel, ''), event_id) AS ch
          FROM regi WHERE game_id IN (SELECT game_id FROM publish_game) GROUP BY 1),
    n AS (SELECT r.reg_date, o.game_id, {parts('r.ch')}, o.acc, sum({SIGNED_GROSS}) AS net FROM o JOIN r ON r.acc = o.acc GROUP BY 1, 2, 3, 4, 5, 6),
    k AS (SELECT reg_date, game_id, parent_channel, child_channel, pkg_code, {band_sums('net', C.SPEND_BANDS, 'recharge_accounts_', True)}, count(DISTINCT acc) AS payers
          FROM n GROUP BY 1, 2, 3, 4, 5)
    SELECT k.*, {GAME_SQL} FROM k JOIN game_sdk g ON g.old_game_id = k.game_id""")
def spend_bands(t):
    return jobs.spend_bands(t.regi, t.orders_g, t.publish_game, t.game_sdk)


REAL = " AND imei <> ''"


@query("job10_device_account_histogram", f"reg_date:s game_id:i amount_no_dev_num:i {band_spec(C.ACCOUNTS_PER_DEVICE, 'dev_acc_')} {GAME}", f"""
    WITH d AS (SELECT cast(reg_time AS date) AS reg_date, CASE WHEN imei = repeat('0', 32) THEN '' ELSE imei END AS imei, game_id,
                      count(DISTINCT lower(trim(game_account))) AS n FROM (SELECT * FROM regi WHERE {in_run('reg_time')}) GROUP BY 1, 2, 3),
    k AS (SELECT reg_date, game_id, sum(CASE WHEN imei = '' THEN n ELSE 0 END) AS amount_no_dev_num,
                 {band_sums('n', C.ACCOUNTS_PER_DEVICE, 'dev_acc_', extra=REAL)} FROM d GROUP BY 1, 2)
    SELECT k.*, {GAME_SQL} FROM k JOIN game_sdk g ON g.old_game_id = k.game_id AND g.state = 0""")
def device_account_histogram(t):
    return jobs.device_account_histogram(t.regi, t.game_sdk, DAYS)


@query("job10_coarse_device_histogram", f"reg_date:s game_id:i amount_no_dev_num:i {band_spec(C.ACCOUNTS_PER_DEVICE, 'dev_acc_')} {GAME}", f"""
    WITH d AS (SELECT cast(ts AS date) AS reg_date, 'd' || (u % 6) AS imei, u % 2 AS game_id, count(DISTINCT u) AS n
               FROM ev WHERE event_type = 'signup' GROUP BY 1, 2, 3),
    k AS (SELECT reg_date, game_id, 0 AS amount_no_dev_num, {band_sums('n', C.ACCOUNTS_PER_DEVICE, 'dev_acc_', extra=REAL)} FROM d GROUP BY 1, 2)
    SELECT k.*, {GAME_SQL} FROM k JOIN game_sdk g ON g.old_game_id = k.game_id AND g.state = 0""")
def coarse_device_histogram(t):
    coarse = t.ev.filter("event_type = 'signup'").select(
        F.concat(F.lit("U"), F.col("u")).alias("game_account"), (F.col("u") % 2).alias("game_id"), F.col("ts").alias("reg_time"),
        F.concat(F.lit("d"), F.col("u") % 6).alias("imei"), F.lit("").alias("expand_channel"))
    return jobs.device_account_histogram(coarse, t.game_sdk)


PAY_OFFSET_SPEC = " ".join(f"pay_account_num_{n + 1}day:i" for n in C.PAY_OFFSETS)


@query("job10_pay_accounts_by_offset", f"reg_date:s game_id:i game_account_num:i {PAY_OFFSET_SPEC} {GAME}", f"""
    WITH r AS (SELECT DISTINCT cast(reg_time AS date) AS reg_date, game_id, lower(trim(game_account)) AS acc FROM regi WHERE {in_run('reg_time')}),
    o AS (SELECT DISTINCT lower(trim(game_account)) AS acc, cast(order_time AS date) AS od FROM orders_g WHERE order_status = 4 AND prod_type = 6),
    k AS (SELECT reg_date, r.game_id, count(DISTINCT r.acc) AS game_account_num,
                 {", ".join(f"count(DISTINCT CASE WHEN date_diff('day', reg_date, od) = {n} THEN r.acc END) AS pay_account_num_{n + 1}day" for n in C.PAY_OFFSETS)}
          FROM r LEFT JOIN o ON r.acc = o.acc GROUP BY 1, 2)
    SELECT k.*, {GAME_SQL} FROM k JOIN game_sdk g ON g.old_game_id = k.game_id AND g.state = 0""")
def pay_accounts_by_offset(t):
    return jobs.pay_accounts_by_offset(t.regi, t.orders_g, t.game_sdk, DAYS)


PERF_SQL = f"""
    o AS (SELECT o.*, CASE WHEN v.order_sn IS NOT NULL THEN 1 ELSE 0 END AS box FROM ({PAID_ORDERS} WHERE order_status = 4 AND prod_type = 6) o
          LEFT JOIN (SELECT DISTINCT order_sn FROM receipts WHERE sandbox = 1 AND state = 3) v ON v.order_sn = o.order_no),
    h AS (SELECT lower(trim(game_account)) AS acc, arg_min(cast(reg_time AS date), event_id) AS reg_date, arg_min(coalesce(expand_channel, ''), event_id) AS ch FROM regi GROUP BY 1),
    d AS (SELECT DISTINCT * FROM (SELECT lower(trim(game_account)) AS acc, game_id, cast(reg_time AS date) AS day FROM regi
                                  UNION ALL SELECT acc, game_id, cast(order_time AS date) FROM o)),
    f AS (SELECT d.day, d.game_id, {parts('h.ch')}, o.payment_type,
                 coalesce(sum(coalesce(ori_price, 0) + coalesce(total_amt, 0)), 0) * 100 AS pay_water,
                 coalesce(sum(CASE WHEN box = 1 THEN coalesce(ori_price, 0) + coalesce(total_amt, 0) END), 0) * 100 AS box_water,
                 count(DISTINCT CASE WHEN h.reg_date = d.day THEN d.acc END) AS regi_num
          FROM d JOIN h ON h.acc = d.acc LEFT JOIN o ON o.acc = d.acc AND o.game_id = d.game_id AND cast(o.order_time AS date) = d.day
          WHERE d.game_id IN (SELECT game_id FROM publish_game) GROUP BY 1, 2, 3, 4, 5, 6),
    p AS (SELECT f.day, f.game_id, parent_channel, child_channel, pkg_code, pay_water, box_water, regi_num,
                 CASE payment_type WHEN 11 THEN 'a' WHEN 100 THEN 'b' ELSE cast(coalesce(payment_type, 0) AS varchar) END AS pay_type, {GAME_SQL}
          FROM f JOIN game_sdk g ON g.old_game_id = f.game_id AND g.state = 0)"""


def _performance(t, days=None):
    return jobs.performance(t.regi, t.orders_g, t.receipts, t.publish_game, t.game_sdk, days)


@query("job11_revenue_performance", f"day:s game_id:i {CH_SPEC} pay_type:s pay_water:i box_water:i regi_num:i main_man:s {GAME}", f"""
    WITH {PERF_SQL},
    pd AS (SELECT DISTINCT pkg_code, day FROM p),
    mm AS (SELECT pd.pkg_code, pd.day, max(nullif(u.name, '')) AS name FROM pd JOIN channel_pkg c ON c.pkg_code = pd.pkg_code
           JOIN channel_manager m ON m.channel_id = c.channel_id AND pd.day >= cast(m.start_time AS date) AND pd.day < cast(m.end_time AS date)
           JOIN users u ON u.id = m.manager GROUP BY 1, 2),
    cc AS (SELECT pd.pkg_code, pd.day, max(nullif(u.name, '')) AS name FROM pd JOIN medium_package mp ON mp.subpackage_id = pd.pkg_code
           JOIN merchant me ON me.merchant_id = mp.merchant_id
           JOIN charge_log l ON l.source_id = me.id AND l.family = 3 AND pd.day >= cast(l.start_time AS date) AND pd.day < cast(l.end_time AS date)
           JOIN users u ON u.id = l.user_id GROUP BY 1, 2)
    SELECT p.*, coalesce(mm.name, cc.name, '') AS main_man FROM p LEFT JOIN mm ON mm.pkg_code = p.pkg_code AND mm.day = p.day
    LEFT JOIN cc ON cc.pkg_code = p.pkg_code AND cc.day = p.day
    WHERE length(p.parent_channel) <= 10 AND length(p.child_channel) <= 10 AND length(p.pkg_code) <= 12 AND {in_run('p.day')}""")
def revenue_performance(t):
    return jobs.performance_with_owner(
        _performance(t, DAYS), channel_pkg=t.channel_pkg, channel_manager=t.channel_manager, medium_package=t.medium_package,
        merchant=t.merchant, charge_log=t.charge_log, user=t.users)[0]


@query("job11_daily_rerun", f"day:s game_id:i {CH_SPEC} pay_type:s pay_water:i regi_num:i", f"""
    WITH {PERF_SQL}
    SELECT day, game_id, parent_channel, child_channel, pkg_code, pay_type, CASE WHEN {in_run('day')} THEN pay_water ELSE -1 END AS pay_water,
           CASE WHEN {in_run('day')} THEN regi_num ELSE -1 END AS regi_num FROM p""")
def performance_rerun(t):
    # a table full of wrong numbers: the run replaces its own days and leaves the others alone
    path = shared_dir(t.spark, "performance-days")
    wrong = _performance(t).withColumns({"pay_water": F.lit(-1).cast("long"), "regi_num": F.lit(-1).cast("long")})
    merge.overwrite_days(wrong, path, "day")
    merge.overwrite_days(_performance(t, DAYS), path, "day")
    return t.spark.read.parquet(path)


@query("job11_cost_base", "day:s parent_game_id:i game_id:i os:i group_id:i bill_type:i corporation_id:i", f"""
    WITH {PERF_SQL}
    SELECT DISTINCT p.day, p.parent_game_id, p.game_id, p.os, p.group_id, coalesce(fi.bill_type, 0) AS bill_type, coalesce(b.corporation_id, 0) AS corporation_id
    FROM p LEFT JOIN game_base b ON b.id = p.parent_game_id LEFT JOIN finance fi ON fi.corporation_base_id = b.corporation_id""")
def cost_base(t):
    return revenue.cost_base(_performance(t), t.game_base, t.finance)


@query("job11_apple_water", "day:s parent_game_id:i game_id:i pay_water:i apple_water:i", f"""
    WITH {PERF_SQL}
    SELECT day, parent_game_id, game_id, sum(pay_water) AS pay_water, sum(CASE WHEN pay_type = '5' THEN pay_water ELSE 0 END) AS apple_water
    FROM p GROUP BY 1, 2, 3""")
def apple_water(t):
    return revenue.apple_water(_performance(t))


@query("job11_month_share", "game_id:i month:s pay_water:i share:s", f"""
    WITH {PERF_SQL}
    , m AS (SELECT game_id, cast(date_trunc('month', day) AS date) AS month, sum(pay_water) AS pay_water FROM p GROUP BY 1, 2)
    SELECT m.game_id, m.month, m.pay_water, CASE WHEN l.ladders IS NULL THEN '0' WHEN floor(pay_water / 100) >= 5000 THEN cast(30 + m.game_id AS varchar)
           WHEN floor(pay_water / 100) >= 1000 THEN cast(20 + m.game_id AS varchar) ELSE cast(10 + m.game_id AS varchar) END AS share
    FROM m LEFT JOIN ladders l ON l.game_id = m.game_id""")
def month_share(t):
    return revenue.month_share(_performance(t), t.ladders)


REGI_BASE = f"SELECT event_id, lower(trim(game_account)) AS acc, game_id, reg_time, {parts('expand_channel')}, coalesce(expand_channel, '~null') AS raw_channel, imei, os FROM regi"
REGI_PUB = f"{REGI_BASE} WHERE game_id IN (SELECT game_id FROM publish_game)"
MARKET = "game_id, parent_channel, child_channel, pkg_code"


@query("job14_card_accounts", "game_account:s uid:i game_id:i game_name:s user_type:i regi_time:s last_login_time:s is_recharge:i user_account:s platform:s", """
    SELECT r.game_account, r.owner_id AS uid, coalesce(mainid, 0) AS game_id, coalesce(maingname, '') AS game_name,
           CASE WHEN reg_resource = 1 THEN 1 ELSE 2 END AS user_type, relate_time AS regi_time, last_login_time,
           CASE WHEN bind_uid_time IS NULL THEN 0 ELSE 1 END AS is_recharge, coalesce(username, '') AS user_account, coalesce(reg_os_type, 'UNKNOW') AS platform
    FROM card_regi r JOIN promo_user p ON p.member_id = r.owner_id
    LEFT JOIN (SELECT game_account, max(login_time) AS last_login_time FROM card_login GROUP BY 1) l ON l.game_account = r.game_account
    JOIN gameinfo g ON g.id = r.game_id WHERE cast(relate_time AS date) = date '2024-01-30' AND r.owner_id <> 0""")
def card_accounts(t):
    return members.card_accounts(t.card_regi, t.promo_user, t.card_login, t.gameinfo, RUN_DAY)


@query("job14_card_extension", "day:s user_account:s game_id:i game_name:s os:s add_users:i regi_accounts:i", """
    SELECT rs.dt AS day, coalesce(username, '') AS user_account, coalesce(mainid, 0) AS game_id, coalesce(maingname, '') AS game_name,
           coalesce(reg_os_type, 'UNKNOW') AS os, sum(a) AS add_users, sum(b) AS regi_accounts
    FROM (SELECT owner_id, cast(bind_uid_time AS date) AS dt, game_id, reg_os_type, 1 AS a, 0 AS b FROM card_regi
          UNION ALL SELECT owner_id, cast(relate_time AS date), game_id, reg_os_type, 0, 1 FROM card_regi) rs
    JOIN gameinfo g ON g.id = rs.game_id JOIN promo_user p ON p.member_id = rs.owner_id
    WHERE dt = date '2024-01-30' AND member_grade = 1 AND status IN (0, 1) GROUP BY 1, 2, 3, 4, 5""")
def card_extension(t):
    return members.card_extension(t.card_regi, t.promo_user, t.gameinfo, RUN_DAY)


@query("job15_member_history", "member_id:i username:s addtime:s regtype:s accounts:i ordernum:i oriprice:i payprice:i last_pay_time:s", """
    WITH b AS (SELECT member_id, count(DISTINCT account) AS accounts FROM bind_member GROUP BY 1),
    o AS (SELECT userid, count(DISTINCT orderid) AS ordernum, sum(oriprice * productnum) AS oriprice, sum(payprice) AS payprice, max(erectime) AS t
          FROM member_orders WHERE state = 4 AND userid <> 0 GROUP BY 1),
    ids AS (SELECT member_id FROM member WHERE addtime IS NOT NULL)
    SELECT m.member_id, m.username, m.addtime, m.regtype, accounts, ordernum, oriprice * 100 AS oriprice, payprice * 100 AS payprice, t AS last_pay_time
    FROM member m JOIN ids USING (member_id) LEFT JOIN b USING (member_id) LEFT JOIN o ON o.userid = m.member_id""")
def member_history(t):
    out = members.member_history(t.member, t.bind_member, t.member_orders, RUN_DAY)
    return out.withColumns({c: F.col(c) * 100 for c in ("oriprice", "payprice")})


@query("job16_account_extract", "game_account:s reg_time:s amount:i first_channel:s last_ip:s last_login_time:s", """
    WITH w AS (SELECT DISTINCT account FROM bgameaccount WHERE cp_uid IN (SELECT split_part('x__cp' || (event_id % 10), '__', 2) FROM ev)),
    r AS (SELECT lower(trim(game_account)) AS acc, min(reg_time) AS reg_time FROM regi GROUP BY 1),
    o AS (SELECT acc, sum(coalesce(ori_price, 0) + coalesce(total_amt, 0)) AS amount
          FROM (SELECT DISTINCT order_no, order_time, lower(trim(game_account)) AS acc, game_id, ori_price, total_amt, payment_type, order_status FROM orders_g) GROUP BY 1),
    l AS (SELECT lower(trim(game_account)) AS acc, login_time, channel_expand, ip FROM login),
    f AS (SELECT acc, min(login_time) AS a, max(login_time) AS z FROM l GROUP BY 1),
    x AS (SELECT f.acc, f.z, min(CASE WHEN login_time = a THEN channel_expand END) AS first_channel, max(CASE WHEN login_time = z THEN ip END) AS last_ip
          FROM f JOIN l ON l.acc = f.acc GROUP BY 1, 2)
    SELECT r.acc AS game_account, r.reg_time, o.amount * 100 AS amount, first_channel, last_ip, z AS last_login_time
    FROM r JOIN w ON w.account = r.acc LEFT JOIN o ON o.acc = r.acc LEFT JOIN x ON x.acc = r.acc""")
def account_extract(t):
    from playcohort.sources.tables import read_delimited_list

    lines = t.ev.select(F.concat(F.lit("x__cp"), F.col("event_id") % 10).alias("value"))
    wanted = read_delimited_list(lines)
    # today and archive of the login table: two halves united again, as the extract reads them
    login = jobs.clean_accounts(t.login)
    today, archive = login.filter("login_time >= timestamp '2024-01-30'"), login.filter("login_time < timestamp '2024-01-30'")
    orders = jobs.clean_accounts(t.orders_g)
    out = members.account_extract(jobs.clean_accounts(t.regi), today.unionByName(archive), orders, t.bgameaccount, wanted)
    return out.withColumn("amount", F.col("amount") * 100)


PKG_DIM = "SELECT mpk.subpackage_id AS pkg_code"


@query("job17_pkg_dim", "pkg_code:s promotion_channel:s medium_account:s promotion_mode:s head_people:s mstart_date:s mend_date:s astart_date:s aend_date:s", """
    SELECT subpackage_id AS pkg_code, agent_name AS promotion_channel, merchant AS medium_account, '' AS promotion_mode, us.name AS head_people,
           date '2016-01-01' AS mstart_date, date '9999-01-01' AS mend_date, date '2016-01-01' AS astart_date, date '9999-01-01' AS aend_date
    FROM medium_package mpk LEFT JOIN merchant mc ON mc.merchant_id = mpk.merchant_id LEFT JOIN agent ag ON ag.id = mc.agent_id LEFT JOIN users us ON us.id = mpk.user_id
    UNION
    SELECT pkg.pkg_code, cm.main_name, '', cpc.promotion, us.name, cast(cpc.start_time AS date), cast(cpc.end_time AS date), date '2016-01-01', date '9999-01-01'
    FROM channel_pkg pkg LEFT JOIN channel_main cm ON cm.id = pkg.main_id LEFT JOIN channel_pkg_conf cpc ON cpc.pkg_id = pkg.id LEFT JOIN users us ON us.id = pkg.manager""")
def pkg_dim(t):
    return dims.build_pkg_dim(t.medium_package, t.merchant, t.agent, t.users, t.channel_pkg, t.channel_main, t.channel_pkg_conf)


@query("job18_pkg_dim_daily", "pkg_code:s day:s medium_account:s promotion_channel:s head_people:s promotion_mode:s", """
    WITH me AS (SELECT subpackage_id AS pkg_code, merchant, agent_name FROM medium_package mp JOIN merchant m ON m.merchant_id = mp.merchant_id LEFT JOIN agent a ON a.id = m.agent_id),
    mh AS (SELECT subpackage_id AS pkg_code, name FROM medium_package mp JOIN users u ON u.id = mp.user_id),
    c AS (SELECT pkg_code, main_name, name FROM channel_pkg p LEFT JOIN channel_main m ON m.id = p.main_id LEFT JOIN users u ON u.id = p.manager),
    k AS (SELECT pkg_code FROM me UNION SELECT pkg_code FROM mh UNION SELECT pkg_code FROM c),
    s AS (SELECT pkg_code, cast(unnest(generate_series(date '2024-01-29', date '2024-02-01', INTERVAL 1 DAY)) AS date) AS day FROM k),
    mo AS (SELECT pkg_code, cast(start_time AS date) AS s, cast(end_time AS date) AS e, promotion FROM channel_pkg p JOIN channel_pkg_conf f ON f.pkg_id = p.id)
    SELECT s.pkg_code, s.day, coalesce(me.merchant, '') AS medium_account, coalesce(me.agent_name, c.main_name, '') AS promotion_channel,
           coalesce(mh.name, c.name, '') AS head_people, CASE WHEN s.day <= date '2024-01-31' THEN coalesce(mo.promotion, '') ELSE '' END AS promotion_mode
    FROM s LEFT JOIN me ON me.pkg_code = s.pkg_code LEFT JOIN mh ON mh.pkg_code = s.pkg_code LEFT JOIN c ON c.pkg_code = s.pkg_code
    LEFT JOIN mo ON mo.pkg_code = s.pkg_code AND s.day BETWEEN mo.s AND mo.e""")
def pkg_dim_daily(t):
    return dims.build_pkg_dim_daily(t.medium_package, t.merchant, t.agent, t.users, t.channel_pkg, t.channel_main, t.channel_pkg_conf, RUN_DAY)


REPAIR = "repair AS (SELECT s.account AS game_account, a.game_id, a.addtime, a.imei, p.code, s.subordinate_code, p.code || '~' || s.subordinate_code AS pkg_code, a.uid, p.username, p.group_id, p.create_time, coalesce(m.username, '') AS bind_member FROM special_account s JOIN card_account a ON a.account = s.account JOIN promo_user p ON p.member_id = a.uid LEFT JOIN bound_member m ON m.id = a.bind_member_id WHERE s.account NOT IN (SELECT account FROM card_master))"


@query("job23_card_repair", "game_account:s game_id:i regi_time:s regi_date:s imei:s promo_code:s user_code:s pkg_code:s member_id:i member_name:s group_id:i member_regi_time:s bind_member:s", f"""
    WITH {REPAIR} SELECT game_account, game_id, addtime AS regi_time, cast(addtime AS date) AS regi_date, imei, code AS promo_code, subordinate_code AS user_code, pkg_code,
        uid AS member_id, username AS member_name, group_id, create_time AS member_regi_time, bind_member FROM repair""")
def card_repair(t):
    return members.repair_missing(t.card_master, t.special_account, t.card_account, t.promo_user, t.bound_member)


@query("job23_package_stats", "regi_date:s pkg_code:s member_id:i game_id:i regi_accounts:i regi_devs:i", f"""
    WITH {REPAIR} SELECT cast(addtime AS date) AS regi_date, pkg_code, uid AS member_id, game_id, count(*) AS regi_accounts, count(*) AS regi_devs FROM repair GROUP BY 1, 2, 3, 4""")
def package_stats(t):
    return members.package_stats(members.repair_missing(t.card_master, t.special_account, t.card_account, t.promo_user, t.bound_member))


MISSING = "mi AS (SELECT lower(a.account) AS game_account, game_id, addtime AS reg_time, uid AS owner_id, bind_member_id FROM card_account a WHERE account IN (SELECT game_account FROM card_login) AND account NOT IN (SELECT account FROM card_master))"


def _missing(t):
    return members.complete_accounts(t.card_login.withColumnRenamed("game_account", "account"), t.card_master, t.card_account)


@query("jon30_missing_accounts", "game_account:s game_id:i reg_time:s owner_id:i bind_member_id:i", f"WITH {MISSING} SELECT * FROM mi")
def missing_accounts(t):
    return _missing(t)


@query("jon30_missing_members", "member_id:i username:s grade:s promo_code:s", f"""
    WITH {MISSING} SELECT b.id AS member_id, b.username, coalesce(cast(p.member_grade AS varchar), '') AS grade, coalesce(p.code, '0') AS promo_code
    FROM bound_member b LEFT JOIN promo_user p ON p.member_id = b.id WHERE b.id IN (SELECT owner_id FROM mi WHERE owner_id <> 0)
      AND b.id NOT IN (SELECT member_id FROM member WHERE addtime IS NULL)""")
def missing_members(t):
    return members.complete_members(_missing(t), t.member.filter("addtime IS NULL"), t.bound_member, t.promo_user)
