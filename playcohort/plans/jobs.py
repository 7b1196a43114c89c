"""The report jobs. Every job takes raw logical tables and a run day and returns its report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playcohort import constants as C
from playcohort.functions import channel as ch
from playcohort.functions.device import blank_zero_device, norm_account, stored_device_hash
from playcohort.functions.money import arpu, cents, gross_amount, signed
from playcohort.operators import attribution, bands, dims, firstseen, kpi, merge, revenue
from playcohort.operators.cohort import ActivityBits, day_range, first_registration, published_only, retention
from playcohort.operators.ltv import daily_spend, distinct_orders, ltv, ltv_by_join
from playcohort.operators.paycurve import pay_curve
from playcohort.session import materialize

COHORT = ("reg_date", "game_id", "channel")


def days_before(day: dt.date, n: int) -> dt.date:
    return day - dt.timedelta(days=n)


Days = tuple[dt.date, dt.date]


def in_days(df: DataFrame, time: str, days: Days | None, more: int = 0) -> DataFrame:
    """Rows from the first to the last day of a run, ``more`` days longer if asked for; all rows without a range."""
    return df if days is None else df.filter(day_range(time, days[0], days[1] + dt.timedelta(days=more)))


def clean_accounts(df: DataFrame) -> DataFrame:
    return df.withColumn("game_account", norm_account(F.col("game_account")))


def clean_regi(regi: DataFrame) -> DataFrame:
    """Registrations with a normalised account, a default channel and its parts."""
    rows = clean_accounts(regi.filter("game_id IS NOT NULL")).withColumn("channel", ch.clean_channel("expand_channel"))
    return ch.with_channel_parts(rows, "expand_channel")


def clean_login(login: DataFrame) -> DataFrame:
    rows = clean_accounts(login.withColumnRenamed("channel_expand", "expand_channel"))
    return ch.with_channel_parts(rows, "expand_channel")


def account_members(regi: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """One row per (day, game, channel, account) with its number of registrations."""
    rows = clean_accounts(regi.filter(day_range("reg_time", first, last)).filter("game_id IS NOT NULL"))
    return rows.groupBy(F.to_date("reg_time").alias("reg_date"), "game_id", ch.clean_channel("expand_channel").alias("channel"),
                        "game_account").agg(F.count("*").alias("accounts"))


def account_retention(regi: DataFrame, login: DataFrame | ActivityBits, games: DataFrame, run_day: dt.date,
                      offsets: Sequence[int] = C.RETENTION_SHORT) -> DataFrame:
    """Accounts of each (day, game, channel) that logged in again, in any game, n days later; ``login`` may be kept bits of accounts."""
    first = days_before(run_day, max(offsets))
    cohort = account_members(published_only(regi, games), first, run_day)
    activity = login if isinstance(login, ActivityBits) else clean_accounts(login)
    return retention(cohort, activity, ["game_account"], COHORT, offsets, "login_time", first, run_day, size="accounts")


def device_retention(regi: DataFrame, login: DataFrame | ActivityBits, games: DataFrame, sdk: DataFrame, packages: DataFrame, run_day: dt.date) -> DataFrame:
    """Devices that came back, by first registration in the window, with game and package attributes of the day."""
    first = days_before(run_day, max(C.RETENTION_LONG))
    rows = clean_regi(published_only(regi.filter(day_range("reg_time", first, run_day)), games))
    cohort = rows.groupBy("game_id", "channel", "imei").agg(F.to_date(F.min("reg_time")).alias("reg_date"))
    counts = retention(cohort, login, ["imei"], COHORT, C.RETENTION_LONG, "login_time", first, run_day)
    return _with_attributes(counts, sdk, packages)


def account_retention_long(regi: DataFrame, login: DataFrame, sdk: DataFrame, packages: DataFrame, run_day: dt.date) -> DataFrame:
    """Accounts that came back at the long offsets, with the same attributes."""
    first = days_before(run_day, max(C.RETENTION_LONG))
    known = regi.join(sdk.select(F.col("old_game_id").alias("game_id")).distinct(), "game_id", "left_semi")
    cohort = account_members(known, first, run_day).drop("accounts")
    last = run_day + dt.timedelta(days=30)
    counts = retention(cohort, clean_accounts(login), ["game_account"], COHORT, C.RETENTION_LONG, "login_time", first, last)
    return _with_attributes(counts, sdk, packages)


def _with_attributes(counts: DataFrame, sdk: DataFrame, packages: DataFrame) -> DataFrame:
    keyed = counts.withColumn("pkg_code", ch.channel_part("channel", 2))
    ranges = (("mstart_date", "mend_date"), ("astart_date", "aend_date"))
    attrs = ("promotion_channel", "medium_account", "promotion_mode", "head_people")
    return dims.with_game_dim(dims.with_effective_dim(keyed, packages, "pkg_code", "reg_date", ranges, attrs), sdk, keep_unknown=True)


def opera_device_retention(regi: DataFrame, login: DataFrame, sdk: DataFrame, run_day: dt.date) -> DataFrame:
    """Devices that came back to the same game before the run day."""
    first = days_before(run_day, max(C.RETENTION_LONG))
    rows = regi.filter(day_range("reg_time", first, run_day) & F.col("game_id").isNotNull() & F.col("game_account").isNotNull())
    cohort = rows.select(F.to_date("reg_time").alias("reg_date"), "game_id", "imei").distinct()
    counts = retention(cohort, login, ["imei", "game_id"], ["reg_date", "game_id"], C.RETENTION_LONG, "login_time", first,
                       days_before(run_day, 1))
    return dims.with_game_dim(counts, sdk.filter("state = 0"))


def ltv_short(regi: DataFrame, orders: DataFrame, games: DataFrame, run_day: dt.date) -> DataFrame:
    """Order price only, any game of the account; horizon n is column n-1. Only orders the horizons reach are read."""
    window = (days_before(run_day, 59), run_day)
    cohort = account_members(published_only(regi, games), *window).drop("accounts")
    reached = in_days(orders, "order_time", window, max(C.LTV_SHORT) - 1)
    spend = daily_spend(clean_accounts(distinct_orders(reached)), ["game_account"], gross=False)
    return ltv(cohort, spend, ["game_account"], COHORT, C.LTV_SHORT, shift=1)


def first_members(regi: DataFrame, games: DataFrame, run_day: dt.date, back_days: int = 180) -> DataFrame:
    """One row per (account, game): the first registration, if it lies in the window."""
    firsts = first_registration(clean_accounts(regi.filter(F.col("game_id").isNotNull())), ["game_account", "game_id"])
    firsts = published_only(firsts, games).filter(day_range("reg_time", days_before(run_day, back_days), run_day))
    return firsts.select(F.to_date("reg_time").alias("reg_date"), "game_id", ch.clean_channel("expand_channel").alias("channel"),
                         "game_account")


def ltv_long(regi: DataFrame, orders: DataFrame, games: DataFrame, run_day: dt.date, by_join: bool = False) -> DataFrame:
    """Gross cents in the registration game over the long horizons."""
    cohort = first_members(regi, games, run_day)
    reached = in_days(orders, "order_time", (days_before(run_day, 180), run_day), max(C.LTV_LONG) - 1)
    spend = daily_spend(clean_accounts(distinct_orders(reached)), ["game_account", "game_id"], gross=True)
    build = ltv_by_join if by_join else ltv
    return build(cohort, spend, ["game_account", "game_id"], COHORT, C.LTV_LONG)


def opera_ltv_share(regi: DataFrame, orders: DataFrame, games: DataFrame, sdk: DataFrame, shares: DataFrame, costs: DataFrame,
                    run_day: dt.date, back_days: int = 180) -> DataFrame:
    """Value of a game's revenue after each cohort day, gross and after share, less proxy recharge."""
    window = day_range("reg_time", days_before(run_day, back_days), run_day)
    rows = clean_accounts(published_only(regi, games).filter(window & F.col("game_account").isNotNull()))
    pairs = rows.groupBy("game_id", "imei", "game_account").agg(F.to_date(F.min("reg_time")).alias("reg_date"))
    # accounts per device first, so that distinct devices are a plain count
    per_device = pairs.groupBy("game_id", "reg_date", "imei").agg(F.count(F.lit(1)).alias("n"))
    cohorts = per_device.groupBy("game_id", "reg_date").agg(F.sum("n").alias("game_count"), F.count(F.lit(1)).alias("device_count"))
    paid = distinct_orders(orders.filter(day_range("order_time", days_before(run_day, back_days), run_day)), [C.PAID], C.GAME_PRODUCT)
    out = revenue.opera_ltv(cohorts, paid, shares, costs, C.LTV_LONG, run_day, back_days)
    return dims.with_game_dim(out, sdk)


def gamepay_curve(regi: DataFrame, orders: DataFrame, games: DataFrame, run_day: dt.date) -> DataFrame:
    """Cumulative payers and money over 15 days for the cohorts of the last 15 days."""
    first = days_before(run_day, C.PAY_CURVE_DAYS - 1)
    cohort = account_members(regi, first, run_day).drop("accounts")
    paid = distinct_orders(orders.filter(day_range("order_time", first, run_day)), [C.PAID])
    spend = daily_spend(clean_accounts(published_only(paid, games.filter("status = 1"))), ["game_account"], gross=False)
    return pay_curve(cohort, spend, COHORT, run_day)


LOGIN_GROUP = ("day", "game_id", *ch.CHANNEL_COLS)


def login_histogram(login: DataFrame, games: DataFrame, sdk: DataFrame, days: Days | None = None) -> DataFrame:
    """Devices per number of logins, and all logins, per (day, game, channel)."""
    rows = clean_login(published_only(in_days(login, "login_time", days), games)).withColumn("day", F.to_date("login_time"))
    out = bands.histogram(rows, ["imei"], LOGIN_GROUP, C.LOGINS_PER_DEVICE, "dau_lg_", F.count("game_account"),
                          extra=[F.sum("_value").alias("dau_lg_times")])
    return dims.with_game_dim(out, sdk)


def new_device_logins(regi: DataFrame, login: DataFrame, games: DataFrame, days: Days | None = None) -> DataFrame:
    """Logins ``n`` per day and device of the devices that registered that day, by the registration's game and channel."""
    regi, login = in_days(regi, "reg_time", days), in_days(login, "login_time", days)
    key = ["day", *ch.CHANNEL_COLS, "imei"]
    logins = clean_login(published_only(login, games)).groupBy(F.to_date("login_time").alias("day"), *key[1:]).agg(
        F.count("game_account").alias("n"))
    devices = clean_regi(published_only(regi, games)).select(F.to_date("reg_time").alias("day"), "game_id", *key[1:]).distinct()
    return devices.join(logins, key)


def new_device_login_histogram(regi: DataFrame, login: DataFrame, games: DataFrame, sdk: DataFrame, days: Days | None = None) -> DataFrame:
    """The same as :func:`login_histogram` for devices that registered that day."""
    rows = new_device_logins(regi, login, games, days)
    out = bands.banded(rows, LOGIN_GROUP, "n", C.LOGINS_PER_DEVICE, "dev_add_lg_", extra=[F.sum("n").alias("dev_add_lg_times")])
    return dims.with_game_dim(out, sdk)


def spend_bands(regi: DataFrame, orders: DataFrame, games: DataFrame, sdk: DataFrame) -> DataFrame:
    """Lifetime net spend of each account in bands, per registration day, game of the order and channel."""
    paid = published_only(distinct_orders(orders, product=C.GAME_PRODUCT), games)
    amount = signed(gross_amount(F.col("ori_price"), F.col("total_amt")), F.col("order_status"))
    per_game = clean_accounts(paid).groupBy("game_account", "game_id").agg(F.sum(amount).alias("net"))
    firsts = clean_regi(published_only(regi, games)).groupBy("game_account").agg(
        F.min(F.struct("reg_time", *ch.CHANNEL_COLS)).alias("r"))
    home = firsts.select("game_account", F.to_date("r.reg_time").alias("reg_date"), *[F.col(f"r.{c}").alias(c) for c in ch.CHANNEL_COLS])
    rows = per_game.join(home, "game_account")
    out = bands.banded(rows, ["reg_date", "game_id", *ch.CHANNEL_COLS], "net", C.SPEND_BANDS, "recharge_accounts_", half_open=True,
                       extra=[F.count(F.lit(1)).alias("payers")])
    return dims.with_game_dim(out, sdk)


def device_account_histogram(regi: DataFrame, sdk: DataFrame, days: Days | None = None) -> DataFrame:
    """Devices per number of accounts, and accounts without a device, per (day, game)."""
    rows = clean_regi(in_days(regi, "reg_time", days).filter(F.col("game_account").isNotNull())).select(
        F.to_date("reg_time").alias("reg_date"), "game_id", blank_zero_device(F.col("imei")).alias("imei"), "game_account").distinct()
    per_device = rows.groupBy("reg_date", "game_id", "imei").agg(F.count(F.lit(1)).alias("n"))
    out = bands.banded(per_device, ["reg_date", "game_id"], "n", C.ACCOUNTS_PER_DEVICE, "dev_acc_", where="imei <> ''",
                       extra=[F.expr("sum(CASE WHEN imei = '' THEN n ELSE 0 END) AS amount_no_dev_num")])
    return dims.with_game_dim(out, sdk.filter("state = 0"))


def pay_accounts_by_offset(regi: DataFrame, orders: DataFrame, sdk: DataFrame, days: Days | None = None) -> DataFrame:
    """Accounts of each (day, game) that paid exactly n days later; ``days`` are the days of registration."""
    orders = in_days(orders, "order_time", days, max(C.PAY_OFFSETS))
    cohort = clean_regi(in_days(regi, "reg_time", days).filter(F.col("game_account").isNotNull())).select(
        F.to_date("reg_time").alias("reg_date"), "game_id", "game_account").distinct()
    paid = clean_accounts(distinct_orders(orders, [C.PAID], C.GAME_PRODUCT)).select(
        "game_account", F.to_date("order_time").alias("order_date")).distinct()
    offset = F.datediff("order_date", "reg_date")
    # days are distinct per account, so every offset meets an account at most once
    out = cohort.join(paid, "game_account", "left").withColumn("_off", offset).groupBy("reg_date", "game_id", "game_account").agg(
        *[F.expr(f"count_if(_off = {n}) AS n{n}") for n in C.PAY_OFFSETS]).groupBy("reg_date", "game_id").agg(
        F.count("*").alias("game_account_num"), *[F.expr(f"sum(n{n}) AS pay_account_num_{n + 1}day") for n in C.PAY_OFFSETS])
    return dims.with_game_dim(out, sdk.filter("state = 0"))


def performance(regi: DataFrame, orders: DataFrame, receipts: DataFrame, games: DataFrame, sdk: DataFrame, days: Days | None = None,
                firsts: DataFrame | None = None) -> DataFrame:
    """Revenue performance of the days; an account's channel is that of its first registration ever.

    With the kept ``firsts`` (``firstseen.FirstSeen.accounts``) no registration outside the days is read.
    """
    paid = clean_accounts(distinct_orders(in_days(orders, "order_time", days), [C.PAID], C.GAME_PRODUCT))
    known = regi.filter(F.col("game_account").isNotNull())
    home = firstseen.first_registrations(clean_regi(known)) if firsts is None else firsts
    return revenue.revenue_performance(home, clean_regi(in_days(known, "reg_time", days)), paid, receipts, games, sdk)


def performance_with_owner(perf: DataFrame, **owner_tables: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(revenue performance that fits the report columns, with the package's owner of the day; rows that do not fit).

    The report is written once: the owners need its packages before they can be joined to it.
    """
    written, fits = materialize(perf, "performance"), F.coalesce(ch.channel_fits(max_pkg=12), F.lit(False))
    fitting = written.filter(fits)
    owners = dims.package_owner(fitting, **owner_tables)
    return fitting.join(owners, ["pkg_code", "day"], "left").fillna({"main_man": ""}), written.filter(~fits)


def registration_base(regi: DataFrame, games: DataFrame) -> DataFrame:
    return clean_regi(published_only(regi, games))


def attribution_chain(active: DataFrame, clicks: DataFrame, regi: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(attributed activations, attributed registrations), the two detail tables of the chain.

    Activations are read by the registration step and by every statistic, so they are written once to
    the shared folder, as are the registrations.
    """
    acts = activation_detail(active, clicks)
    return acts, materialize(attribution.attribute_registrations(clean_regi(regi), acts), "registration-detail")


def activation_detail(active: DataFrame, clicks: DataFrame) -> DataFrame:
    found = attribution.attribute_activations(ch.with_channel_parts(active, "expand_channel"), clicks)
    return materialize(found, "activation-detail")


def daily_chain(spark: SparkSession, base: str, days: Days, active: DataFrame, clicks: DataFrame, regi: DataFrame, games: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The attribution chain of a range of days, from the logs of these days and the carry the range before has left.

    Below ``base`` lie the attributed activations and registrations by day and, per last day of a range, what later days
    need of the touches before them. Ranges run in order; one that runs again starts from the same carry and replaces its
    days. ``games`` are the advertised games.
    """
    before = days[0] - dt.timedelta(days=1)
    held = lambda name: _read_carry(spark, f"{base}/{name}-carry/last={before}")
    logs = [in_days(active, "active_time", days), in_days(clicks, "ts", days), in_days(clean_regi(regi), "reg_time", days)]
    logs[0] = ch.with_channel_parts(logs[0], "expand_channel")
    clicked, acted = held("click"), held("activation")
    acts = materialize(attribution.credit_activations(attribution.matched_clicks(logs[0], logs[1], games, clicked)), "day-activations")
    regs = materialize(attribution.attribute_registrations(logs[2], acts, acted), "day-registrations")
    attribution.click_carry(logs[0], logs[1], games, days[1], clicked).write.mode("overwrite").parquet(f"{base}/click-carry/last={days[1]}")
    attribution.activation_carry(logs[2], acts, days[1], acted).write.mode("overwrite").parquet(f"{base}/activation-carry/last={days[1]}")
    merge.overwrite_days(acts.withColumn("day", F.to_date("active_time")), f"{base}/activations", "day")
    merge.overwrite_days(regs.withColumn("day", F.to_date("reg_time")), f"{base}/registrations", "day")
    return acts, regs


def _read_carry(spark: SparkSession, path: str) -> DataFrame | None:
    """The state a range has left, or None before the first one."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def clean_order_log(orders: DataFrame) -> DataFrame:
    """Paid game orders once each, as the order log parser delivers them: zero for missing amounts."""
    kept = orders.filter((F.col("order_status") == C.PAID) & (F.col("prod_type") == C.GAME_PRODUCT))
    rows = clean_accounts(kept).select("order_no", "order_time", "game_account", "game_id", "imei",
                                       F.coalesce("ori_price", F.lit(0).cast("decimal(18,2)")).alias("ori_price"),
                                       F.coalesce("total_amt", F.lit(0).cast("decimal(18,2)")).alias("total_amt"))
    return rows.dropDuplicates(["order_no", "order_time", "game_account"])


NATURAL = ("regi_num", "regi_dev_num", "active_num", "pay_price", "pay_accounts", "new_pay_price", "new_pay_accounts")


def monitored_games(packages: DataFrame) -> DataFrame:
    """``os, game_id`` of the games a medium reports back on: some package of theirs has a feedback address."""
    return packages.filter("feedbackurl <> ''").select("os", "game_id").distinct()


def games_per_os(packages: DataFrame) -> DataFrame:
    """The monitored games of each os as one text; a list as long as there are games."""
    return monitored_games(packages).groupBy("os").agg(F.expr("array_join(array_sort(collect_list(game_id)), ',')").alias("games"))


def natural_traffic(regi: DataFrame, active: DataFrame, orders: DataFrame, acts: DataFrame, regs: DataFrame, games: DataFrame,
                    sdk: DataFrame, packages: DataFrame, days: Days | None = None, seen: firstseen.FirstSeen | None = None) -> DataFrame:
    """Registrations, devices, activations, money and payers of monitored games that no package claims, per (day, game).

    Registered accounts are counted at the marketing grain, devices and activations at the operations grain. Money
    and payers are new when the account registered that day. ``orders`` are deduplicated; whether an account or
    device is seen first needs its earlier rows, so ``regi`` and ``active`` are read up to the last day, or not before the first
    one where the kept first-seen dimensions ``seen`` are given; ``acts`` and ``regs`` then are those of the days as well.
    """
    keys = ["day", "game_id"]
    watched = monitored_games(packages).select("game_id").distinct()
    only = lambda df: published_only(published_only(df, games), watched)
    upto = None if days is None else (dt.date(1970, 1, 1), days[1])
    day = F.to_date("day").alias("day")
    own, paid = clean_regi(only(in_days(regi, "reg_time", days))), only(in_days(orders, "order_time", days))
    accounts = kpi.registration_kpi(own, kpi.MARKET).groupBy(day, "game_id").agg(F.sum("regi_accounts").alias("regi_num"))
    devices = kpi.registration_kpi(own, kpi.OPERA).select(day, "game_id", F.col("regi_devices").alias("regi_dev_num"))
    devices_seen = in_days(active, "active_time", upto) if seen is None else in_days(seen.devices.read(), "active_time", days)
    acted = kpi.activation_kpi(only(devices_seen), kpi.OPERA, "day").select(day, "game_id", "active_num")
    # an account's day in a game first: hot payers shrink before they meet their registration
    per_account = paid.groupBy(F.to_date("order_time").alias("day"), "game_id", "game_account").agg(F.sum(cents(F.col("ori_price") + F.col("total_amt"))).alias("amount"))
    firsts = firstseen.first_registrations(clean_regi(in_days(regi, "reg_time", upto))) if seen is None else seen.accounts.read()
    first = firsts.select("game_account", F.to_date("reg_time").alias("reg_date"))
    new = F.coalesce((F.col("reg_date") == F.col("day")).cast("long"), F.lit(0).cast("long"))
    money = per_account.join(first, "game_account", "left").groupBy(*keys).agg(
        F.sum("amount").alias("pay_price"), F.count(F.lit(1)).alias("pay_accounts"), F.sum(F.col("amount") * new).alias("new_pay_price"), F.sum(new).alias("new_pay_accounts"))
    total = dims.with_game_dim(kpi.sum_branches([accounts, devices, acted, money], keys), sdk).drop("parent_game_id", "os")
    named = "pkg_code <> ''"
    stats = (attribution.registration_stats(regs), attribution.activation_stats(acts), attribution.order_stats(in_days(orders, "order_time", days), regs, None if seen is None else seen.owners.read()))
    claimed = kpi.sum_branches([s.filter(named).groupBy(*keys).agg(*[F.sum(m).alias(m) for m in NATURAL if m in s.columns]) for s in stats], keys)
    rest = revenue.natural_residual(total, claimed, keys, NATURAL)
    return rest if days is None else rest.filter(F.col("day").between(*days))


def wall_reconciliation(wall: DataFrame, active: DataFrame, regi: DataFrame) -> DataFrame:
    """The wall's KPIs next to the own activations and registrations of its (day, game), and what is left for natural traffic."""
    keys, day = ["day", "game_id"], F.to_date("day").alias("day")
    acted = kpi.activation_kpi(active, kpi.OPERA, "day").select(day, "game_id", F.col("active_num").alias("own_active_num"))
    own = kpi.registration_kpi(regi, kpi.OPERA).select(day, "game_id", F.col("regi_devices").alias("own_regi_dev_num"), F.col("new_regi_devices").alias("new_regi_dev_num"))
    cols = ["own_active_num", "own_regi_dev_num", "new_regi_dev_num"]
    empty = wall.withColumns({c: F.lit(0).cast("long") for c in cols})
    full = merge.update_from(empty, kpi.sum_branches([acted, own], keys), keys, cols)
    return full.withColumns({
        "own_repeat_active_num": merge.positive_difference("repeat_active_num", "mu_repeat_active_num"),
        "natural_regi_dev_num": merge.positive_difference("own_regi_dev_num", "regi_active_num"),
        "new_natural_regi_dev_num": merge.positive_difference("new_regi_dev_num", "new_mu_regi_dev_num")})


def device_hash_backfill(clicks: DataFrame) -> DataFrame:
    """The stored device hash, filled once per click row."""
    return clicks.withColumn("imei_md5_upper", stored_device_hash(F.col("imei"), F.col("os"), F.col("adv_name"), F.col("imei_md5_upper")))


def registration_rerun(path: str, regi: DataFrame, games: DataFrame, days: Days) -> None:
    """Compute a range of the day KPI table at ``path`` again and replace the range's partitions.

    Keys of the range that the log no longer has are reset to zero. Later registrations cannot change the range
    and are not read; other days' partitions are neither read nor written.
    """
    metrics = ["regi_accounts", "new_regi_accounts", "regi_devices", "new_regi_devices"]
    in_range = F.col("day").between(*map(str, days))
    target = regi.sparkSession.read.parquet(path).filter(in_range).withColumn("day", F.col("day").cast("string"))
    upto = in_days(regi, "reg_time", (dt.date(1970, 1, 1), days[1]))
    fresh = kpi.registration_kpi(registration_base(upto, games), kpi.MARKET).filter(in_range)
    rows = merge.merge_add(merge.reset_where(target, F.lit(True), metrics), fresh, ["day", *kpi.MARKET], metrics)
    merge.overwrite_days(materialize(rows, "rerun"), path, "day")


def daily_report(regi: DataFrame, login: DataFrame, active: DataFrame, orders: DataFrame, landing: DataFrame, games: DataFrame, sdk: DataFrame,
                 packages: DataFrame, days: Days) -> DataFrame:
    """The combined report of a range of days per (day, game, channel), with game and package attributes.

    Day KPIs of all sources side by side; next to them what came of the day's new devices and accounts: who was
    back on the second, third and seventh day, and the money of the first one, three and seven days.
    ``orders`` are raw order rows, ``landing`` rows carry ``ts``, ``type`` and ``ip``.
    """
    keys, upto = ["day", *kpi.MARKET], (dt.date(1970, 1, 1), days[1])
    base = registration_base(in_days(regi, "reg_time", upto), games)
    registered = kpi.registration_kpi(base, kpi.MARKET).select(*keys, F.col("new_regi_devices").alias("new_regi_device_num"), F.col("new_regi_accounts").alias("new_regi_account_num"))
    logins = clean_login(published_only(in_days(login, "login_time", days), games))
    logged = kpi.login_kpi(logins.select("game_account", "login_time", *kpi.MARKET, "expand_channel", "imei"), base, kpi.MARKET).select(
        F.col("day").cast("string").alias("day"), *kpi.MARKET, F.col("new_login_devices").alias("new_login_device_num"), F.col("new_active_devices").alias("new_active_device_num"))
    acts = ch.with_channel_parts(published_only(in_days(active, "active_time", upto), games), "expand_channel")
    acted = kpi.activation_kpi(acts, kpi.MARKET, "day")
    clicks = ch.with_channel_parts(in_days(landing, "ts", days), "expand_channel").withColumn("publish_time", F.date_format("ts", "yyyy-MM-dd"))
    shown = kpi.click_uv(clicks, games).withColumnRenamed("publish_time", "day").select(*keys, "adpage_click_uv", "request_click_uv", "download_uv")
    paid = published_only(kpi.with_account(clean_order_log(in_days(orders, "order_time", days)), kpi.account_master(clean_regi(in_days(regi, "reg_time", upto)))), games)
    money = kpi.pay_money(paid).withColumnRenamed("pay_money", "order_amount")
    payers = kpi.pay_devices(paid, kpi.MARKET).select(F.col("day").cast("string").alias("day"), *kpi.MARKET, F.col("pay_devices").alias("order_num"))
    report = kpi.sum_branches([registered, logged, acted, shown, money, payers], keys).filter(F.col("day").between(*map(str, days)))

    firsts = base.groupBy(*kpi.MARKET, "imei").agg(F.to_date(F.min("reg_time")).alias("reg_date")).filter(F.col("reg_date").between(*days))
    window = (days[0], days[1] + dt.timedelta(days=6))
    back = retention(firsts, login, ["imei"], ["reg_date", *kpi.MARKET], (1, 2, 6), "login_time", *window).withColumnsRenamed({"retained_2day": "retained_3day", "retained_6day": "retained_7day"})
    one = base.groupBy("game_account", "game_id").agg(F.min(F.struct("reg_time", *ch.CHANNEL_COLS)).alias("r"))
    cohort = one.select("game_account", "game_id", F.to_date("r.reg_time").alias("reg_date"), *[F.col(f"r.{c}") for c in ch.CHANNEL_COLS]).filter(F.col("reg_date").between(*days))
    spend = daily_spend(clean_accounts(distinct_orders(in_days(orders, "order_time", days, 6))), ["game_account", "game_id"], gross=True)
    value = ltv(cohort, spend, ["game_account", "game_id"], ["reg_date", *kpi.MARKET], (1, 3, 7)).drop("accounts").withColumnsRenamed({f"ltv_{n}day": f"order_amount_{n}day" for n in (1, 3, 7)})
    again = new_device_logins(regi, login, games, days).groupBy("day", *kpi.MARKET).agg(F.sum("n").alias("new_regi_device_login_num")).withColumn("day", F.col("day").cast("string"))
    as_day = lambda df: df.withColumn("day", F.col("reg_date").cast("string")).drop("reg_date")
    actions = kpi.sum_branches([as_day(back), as_day(value), again], keys)
    ranges, attrs = (("mstart_date", "mend_date"), ("astart_date", "aend_date")), ("promotion_channel", "medium_account", "promotion_mode", "head_people")
    combined = dims.with_effective_dim(revenue.daily_report(report, actions, keys), packages, "pkg_code", "day", ranges, attrs)
    return dims.with_game_dim(combined, sdk, keep_unknown=True)


def arpu_report(spend: DataFrame, accounts: DataFrame, keys: Sequence[str]) -> DataFrame:
    joined = accounts.join(spend, list(keys), "left").fillna(0, ["amount"])
    return joined.withColumn("arpu", arpu(F.col("amount"), F.col("accounts")))


