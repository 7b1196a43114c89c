"""Day and hour KPIs over a log: registration, activation, login, payment, landing pages, wall.

Two grains recur: marketing (game, channel parts, device) and operations (game, device). Each function
takes the grain as key columns, and every "first time" test is a minimum per key, so no row-by-row
state is needed for a whole log. The streaming package keeps the same definitions incrementally.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playcohort import constants as C
from playcohort.functions.channel import CHANNEL_COLS
from playcohort.functions.money import cents
from playcohort.functions.times import hour_key
from playcohort.sources.logs import click_indicators

MARKET = ("game_id", *CHANNEL_COLS)
OPERA = ("game_id",)


def _flag(test: Column) -> Column:
    return F.coalesce(test.cast("long"), F.lit(0).cast("long"))


def count_distinct(rows: DataFrame, group: Sequence[str], entity: Sequence[str], name: str) -> DataFrame:
    """Exact distinct entities per group as two plain aggregates, which splits hot groups by entity."""
    keys = list(dict.fromkeys([*group, *entity]))
    return rows.select(*keys).distinct().groupBy(*group).agg(F.count(F.lit(1)).alias(name))


def first_day(regi: DataFrame, keys: Sequence[str], time: str = "reg_time", name: str = "first_day") -> DataFrame:
    return regi.groupBy(*keys).agg(F.min(F.to_date(time)).alias(name))


def registration_kpi(regi: DataFrame, grain: Sequence[str], unit: str = "day") -> DataFrame:
    """Registered and new accounts and devices per (unit, grain).

    Accounts are distinct per device key and hour. A device is new on its first day: once in the day
    table, once per hour of that day in the hour table.
    """
    key = [*grain, "imei"]
    valid = regi.filter((F.col("game_account") != "") & F.col("reg_time").isNotNull())
    hourly = count_distinct(valid.withColumn("hour", hour_key(F.col("reg_time"))), [*key, "hour"], ["game_account"], "n")
    hourly = hourly.withColumn("day", F.left("hour", F.lit(10)))
    units = hourly if unit == "hour" else hourly.groupBy(*key, "day").agg(F.sum("n").alias("n"))
    # at most one row per key and unit of time is ordered here
    new = F.col("day") == F.min("day").over(Window.partitionBy(*key))
    return units.withColumn("new", _flag(new)).groupBy(unit, *grain).agg(
        F.sum("n").alias("regi_accounts"), F.sum(F.col("n") * F.col("new")).alias("new_regi_accounts"),
        F.count(F.lit(1)).alias("regi_devices"), F.sum("new").alias("new_regi_devices"))


def activation_kpi(active: DataFrame, grain: Sequence[str], unit: str = "hour") -> DataFrame:
    """Each device key counts once, at its earliest hour, whatever order the lines came in."""
    earliest = active.groupBy(*grain, "imei").agg(F.min("active_time").alias("t"))
    label = hour_key(F.col("t")) if unit == "hour" else F.date_format("t", "yyyy-MM-dd")
    return earliest.groupBy(label.alias(unit), *grain).agg(F.count(F.lit(1)).alias("active_num"))


def distinct_logins(login: DataFrame) -> DataFrame:
    """One row per (account, time); a repeat in another game or device is the same login."""
    rest = [c for c in login.columns if c not in ("game_account", "login_time")]
    one = login.groupBy("game_account", "login_time").agg(F.min(F.struct(*rest)).alias("r"))
    return one.select("game_account", "login_time", "r.*")


def login_kpi(login: DataFrame, regi: DataFrame, grain: Sequence[str], channel: str | None = "expand_channel") -> DataFrame:
    """Active and new devices and accounts per (day, grain).

    A login is *new* when its device and its account both registered that day, the account on this
    device (and channel, at the marketing grain). New login devices have such a login, new login
    accounts open their day with one, and new active devices log in again after theirs.
    """
    device = [*grain, "imei"]
    firsts = first_day(regi, device)
    match = ["imei", *([channel] if channel else [])]
    accounts = regi.groupBy("game_account").agg(F.min(F.struct("reg_time", *match)).alias("a")).select(
        "game_account", F.to_date("a.reg_time").alias("_reg_day"), *[F.col(f"a.{c}").alias(f"_reg_{c}") for c in match])
    # what makes a login new is the same all day: only the first and last login of an account on a device are joined
    keys = list(dict.fromkeys(["day", *device, "game_account", *match]))
    slim = distinct_logins(login).withColumn("day", F.to_date("login_time")).groupBy(*keys).agg(F.min("login_time").alias("first"), F.max("login_time").alias("last"))
    rows = slim.join(firsts, device, "left").join(accounts, "game_account", "left")
    both = (F.col("first_day") == F.col("day")) & (F.col("_reg_day") == F.col("day"))
    for c in match:
        both = both & F.col(c).eqNullSafe(F.col(f"_reg_{c}"))
    rows = rows.select("day", *device, "game_account", "first", "last", _flag(both).alias("both"))

    devices = rows.groupBy("day", *device).agg(
        F.max("both").alias("new_login_devices"),
        _flag(F.max(F.struct("last", "game_account")) > F.min(F.when(F.col("both") == 1, F.struct("first", "game_account")))).alias("new_active_devices"))
    devices = devices.groupBy("day", *grain).agg(
        F.count(F.lit(1)).alias("dau_devices"), F.sum("new_login_devices").alias("new_login_devices"),
        F.sum("new_active_devices").alias("new_active_devices"))
    accounts_day = rows.groupBy("day", *grain, "game_account").agg(
        F.min_by("both", F.struct("first", "imei")).alias("new_login_accounts"))
    accounts_day = accounts_day.groupBy("day", *grain).agg(
        F.count(F.lit(1)).alias("dau_accounts"), F.sum("new_login_accounts").alias("new_login_accounts"))
    # the two measures add up side by side instead of being joined
    return sum_branches([devices, accounts_day], ["day", *grain])


def sum_branches(branches: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Union differently measured branches, missing measures as 0, and add them per key."""
    measures = list(dict.fromkeys(c for b in branches for c in b.columns if c not in keys))
    padded = [b.select(*keys, *[F.col(m) if m in b.columns else F.lit(0).cast("long").alias(m) for m in measures]) for b in branches]
    total = padded[0]
    for other in padded[1:]:
        total = total.unionByName(other)
    return total.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def login_accounts(login: DataFrame, grain: Sequence[str], unit: str = "hour") -> DataFrame:
    """Distinct accounts and devices per (unit, grain)."""
    label = hour_key(F.col("login_time")) if unit == "hour" else F.date_format("login_time", "yyyy-MM-dd")
    rows = login.withColumn(unit, label)
    return sum_branches([
        count_distinct(rows, [unit, *grain], ["game_account"], "accounts"),
        count_distinct(rows, [unit, *grain], ["imei"], "devices")], [unit, *grain])


def login_split(login: DataFrame, regi: DataFrame, grain: Sequence[str] = MARKET) -> DataFrame:
    """Devices and accounts per day split by whether the device first registered that day or before."""
    device = [*grain, "imei"]
    daily = count_distinct(login.filter("game_account <> ''").withColumn("day", F.to_date("login_time")),
                           ["day", *device], ["game_account"], "n")
    split = daily.join(first_day(regi, device), device).withColumn("new", _flag(F.col("first_day") == F.col("day")))
    old = 1 - F.col("new")
    return split.groupBy("day", *grain).agg(
        F.sum("new").alias("new_login_devices"), F.sum(F.col("n") * F.col("new")).alias("new_login_accounts"),
        F.sum(old).alias("dau_devices"), F.sum(F.col("n") * old).alias("dau_accounts"))


def account_master(regi: DataFrame) -> DataFrame:
    """Registration game, channel and day of each account, from its first registration."""
    one = regi.groupBy("game_account").agg(F.min(F.struct("reg_time", "game_id", *CHANNEL_COLS)).alias("r"))
    return one.select("game_account", F.to_date("r.reg_time").alias("reg_date"), F.col("r.game_id").alias("reg_game_id"),
                      *[F.col(f"r.{c}").alias(c) for c in CHANNEL_COLS])


def with_account(orders: DataFrame, accounts: DataFrame) -> DataFrame:
    """Money per (account, game, hour, device) with the payer's registration; unknown payers get channel ``no_acc`` and game 0.

    Orders shrink to hours before the join, so a payer with very many of them meets the accounts a few times only.
    ``order_time`` is the hour.
    """
    hours = orders.groupBy("game_account", "game_id", F.date_trunc("hour", "order_time").alias("order_time"), "imei").agg(
        F.sum("ori_price").alias("ori_price"), F.sum("total_amt").alias("total_amt"))
    joined = hours.join(accounts, "game_account", "left")
    return joined.fillna({"parent_channel": C.UNKNOWN_ACCOUNT_CHANNEL, "child_channel": "", "pkg_code": "", "reg_game_id": 0})


def pay_devices(orders: DataFrame, grain: Sequence[str]) -> DataFrame:
    return count_distinct(orders.withColumn("day", F.to_date("order_time")), ["day", *grain], ["imei"], "pay_devices")


def pay_accounts(orders: DataFrame, unit: str = "day") -> DataFrame:
    """Distinct payers per (unit, game, channel)."""
    label = hour_key(F.col("order_time")) if unit == "hour" else F.date_format("order_time", "yyyy-MM-dd")
    return count_distinct(orders.withColumn(unit, label), [unit, *MARKET], ["game_account"], "pay_accounts")


def first_payers(orders: DataFrame) -> DataFrame:
    """Accounts that ever paid, credited to their registration day and game."""
    return count_distinct(orders, ["reg_date", "reg_game_id"], ["game_account"], "recharge_accounts")


def pay_money(orders: DataFrame, unit: str = "day") -> DataFrame:
    """Gross cents per (unit, game, channel)."""
    label = hour_key(F.col("order_time")) if unit == "hour" else F.date_format("order_time", "yyyy-MM-dd")
    return orders.groupBy(label.alias(unit), *MARKET).agg(
        F.sum(cents(F.col("ori_price") + F.col("total_amt"))).alias("pay_money"))


def pay_ltv(orders: DataFrame) -> DataFrame:
    """Order price in cents credited to the registration day: in total and within 1, 2, 3, 7, 30 days."""
    offset, price = F.datediff(F.to_date("order_time"), "reg_date"), cents(F.col("ori_price"))

    def upto(n: int) -> Column:
        hit = (offset == 0) if n == 1 else (offset <= n - 1)
        return F.sum(F.when(hit, price).otherwise(F.lit(0))).alias(f"ltv_{n}day")
    return orders.groupBy("reg_date", "reg_game_id").agg(
        F.sum(price).alias("recharge"), *[upto(n) for n in C.PAY_LTV])


def click_uv(clicks: DataFrame, games: DataFrame) -> DataFrame:
    """Distinct addresses per (day, game, channel) and click type; ``clicks`` carries channel parts."""
    once = clicks.join(games.select("game_id").distinct(), "game_id", "left_semi").select(
        "publish_time", *MARKET, "type", "ip").distinct()
    flags = {n: c.cast("long") for n, c in click_indicators(F.col("type")).items()}
    return once.withColumns(flags).groupBy("publish_time", *MARKET).agg(*[F.sum(n).alias(n) for n in flags])


WALL_FLAGS = ("mu_active_num", "repeat_active_num", "mu_repeat_active_num", "own_mu_active_num", "own_un_active_num",
              "regi_active_num", "new_mu_regi_dev_num")


def wall_kpi(clicks: DataFrame, actives: DataFrame, platform: DataFrame, regi: DataFrame) -> DataFrame:
    """Incentive-wall KPIs per (day, game).

    ``clicks`` and ``actives`` are wall rows (game_id, imei, ts), of which one may stand for ``copies``; ``platform`` and ``regi`` the own
    activations and registrations (game_id, imei and a time). A device counts once a day; what it did
    before is a first day per (game, device).
    """
    def once_a_day(rows: DataFrame) -> DataFrame:
        one = rows.groupBy(F.to_date("ts").alias("day"), "imei").agg(F.min(F.struct("ts", "game_id")).alias("r"))
        return one.select("day", "imei", F.col("r.game_id").alias("game_id"))

    click_devs = once_a_day(clicks).groupBy("day", "game_id").agg(F.count(F.lit(1)).alias("click_dev_num"))
    number = F.sum("copies") if "copies" in clicks.columns else F.count(F.lit(1))
    click_all = clicks.groupBy(F.to_date("ts").alias("day"), "game_id").agg(number.alias("click_num"))

    act = once_a_day(actives)
    key = ["game_id", "imei"]
    wall_first = act.groupBy(*key).agg(F.min("day").alias("wall_day"))
    platform_first = first_day(platform, key, "active_time", "platform_day")
    platform_today = platform.select("imei", F.to_date("active_time").alias("day")).distinct().withColumn("platform_today", F.lit(1))
    regi_first = first_day(regi, key, "reg_time", "regi_day")
    regi_today = regi.select(*key, F.to_date("reg_time").alias("day")).distinct().withColumn("regi_today", F.lit(1))
    rows = (
        act.join(wall_first, key, "left").join(platform_first, key, "left").join(regi_first, key, "left")
        .join(platform_today, ["imei", "day"], "left").join(regi_today, [*key, "day"], "left")
    )
    flags = dict(zip(WALL_FLAGS, (
        F.lit(1).cast("long"), _flag(F.col("platform_day") < F.col("day")), _flag(F.col("wall_day") < F.col("day")),
        _flag(F.col("platform_today").isNotNull()),
        _flag(F.col("platform_day").isNull() | (F.col("platform_day") > F.col("day"))),
        _flag(F.col("regi_today").isNotNull()),
        _flag(F.col("regi_day").isNull() | (F.col("regi_day") >= F.col("day"))))))
    active = rows.select("day", "game_id", *[c.alias(n) for n, c in flags.items()]).groupBy("day", "game_id").agg(
        *[F.sum(n).alias(n) for n in flags])
    return sum_branches([click_all, click_devs, active], ["day", "game_id"])
