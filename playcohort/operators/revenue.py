"""Revenue performance, share-adjusted value, residual traffic and the combined daily report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playcohort import constants as C
from playcohort.functions.channel import CHANNEL_COLS
from playcohort.functions.ladder import ladder_tiers, tier_rate
from playcohort.functions.money import cents, gross_amount, pay_type_code
from playcohort.functions.times import month_start
from playcohort.operators.dims import child_games

PERFORMANCE_KEY = ("day", "parent_game_id", "game_id", "os", "group_id", *CHANNEL_COLS, "pay_type")


def revenue_performance(firsts: DataFrame, registered: DataFrame, orders: DataFrame, receipts: DataFrame, games: DataFrame, sdk: DataFrame) -> DataFrame:
    """Cents, sandbox cents and new accounts per (day, game, channel, payment type).

    An account shows up on days it registered or paid; type 0 stands for no payment. ``firsts`` are the accounts' first
    registrations ever (``firstseen.first_registrations``), ``registered`` the registrations of the reported days,
    ``orders`` deduplicated paid orders of these days.
    """
    flagged = orders.join(receipts.filter("sandbox = 1 AND state = 3").select(F.col("order_sn").alias("order_no")).distinct()
                          .withColumn("sandbox", F.lit(1)), "order_no", "left")
    amount = cents(gross_amount(F.col("ori_price"), F.col("total_amt")))
    paid = flagged.groupBy("game_account", "game_id", F.to_date("order_time").alias("day"), "payment_type").agg(
        F.sum(amount).alias("water"), F.sum(F.when(F.col("sandbox") == 1, amount).otherwise(F.lit(0))).alias("box"))
    days = account_days(registered, orders).join(games.select("game_id").distinct(), "game_id", "left_semi")
    home = firsts.select("game_account", F.to_date("reg_time").alias("reg_date"), *CHANNEL_COLS)
    # one row per (account, game, day, type): the new accounts below need no distinct
    rows = days.join(home, "game_account").join(paid, ["game_account", "game_id", "day"], "left")
    facts = rows.groupBy("day", "game_id", *CHANNEL_COLS, F.col("payment_type")).agg(
        F.coalesce(F.sum("water"), F.lit(0).cast("long")).alias("pay_water"),
        F.coalesce(F.sum("box"), F.lit(0).cast("long")).alias("box_water"),
        F.sum((F.col("reg_date") == F.col("day")).cast("long")).alias("regi_num"))
    dim = child_games(sdk.filter("state = 0")).withColumnRenamed("old_game_id", "game_id")
    out = facts.join(dim, "game_id").withColumn("pay_type", pay_type_code(F.col("payment_type")))
    return out.select(*PERFORMANCE_KEY, "pay_water", "box_water", "regi_num")


def account_days(regi: DataFrame, orders: DataFrame) -> DataFrame:
    """Distinct (account, game, day) of registrations and orders."""
    a = regi.select("game_account", "game_id", F.to_date("reg_time").alias("day"))
    b = orders.select("game_account", "game_id", F.to_date("order_time").alias("day"))
    return a.unionByName(b).distinct()


def cost_base(performance: DataFrame, game_base: DataFrame, finance: DataFrame) -> DataFrame:
    """Per (day, game) the corporation and its bill type, 0 when unknown."""
    games = performance.select("day", "parent_game_id", "game_id", "os", "group_id").distinct()
    base = game_base.select(F.col("id").alias("parent_game_id"), "corporation_id").distinct()
    bills = finance.select(F.col("corporation_base_id").alias("corporation_id"), "bill_type").distinct()
    return games.join(base, "parent_game_id", "left").join(bills, "corporation_id", "left").fillna({"bill_type": 0, "corporation_id": 0})


def apple_water(performance: DataFrame) -> DataFrame:
    """Cents per (day, game), in total and paid through the store type."""
    store = F.when(F.col("pay_type") == str(C.APPLE_PAY_TYPE), F.col("pay_water")).otherwise(F.lit(0))
    return performance.groupBy("day", "parent_game_id", "game_id").agg(
        F.sum("pay_water").alias("pay_water"), F.sum(store).alias("apple_water"))


def month_share(performance: DataFrame, ladders: DataFrame) -> DataFrame:
    """Share of each game and month: the ladder tier its month's revenue (yuan) reaches."""
    month = performance.groupBy("game_id", month_start(F.to_date("day")).alias("month")).agg(F.sum("pay_water").alias("pay_water"))
    # tiers are parsed on the dimension, one ladder per game
    tiers = ladders.select("game_id", ladder_tiers("ladders").alias("tiers"))
    rated = month.withColumn("yuan", F.floor(F.col("pay_water") / 100)).join(tiers, "game_id", "left")
    return rated.select("game_id", "month", "pay_water", F.coalesce(tier_rate("tiers", "yuan"), F.lit("0")).alias("share"))


def opera_ltv(cohorts: DataFrame, orders: DataFrame, shares: DataFrame, costs: DataFrame, horizons: Sequence[int],
              run_day: dt.date, back_days: int = 180) -> DataFrame:
    """Value of a game's revenue after each cohort day, gross (b) and after revenue share (a).

    ``cohorts`` (game_id, reg_date, ...), ``orders`` deduplicated paid orders, ``shares`` (game_id, month,
    rate in percent), ``costs`` (game_id, cost_date, proxy cents, publish_cost). Proxy recharge is
    subtracted day by day. Sums over "the n days from here" are range frames over one row per
    game and day, so a game never meets itself day by day.
    """
    day = F.to_date("order_time").alias("day")
    per_day = orders.groupBy("game_id", day).agg(F.sum(gross_amount(F.col("ori_price"), F.col("total_amt"))).alias("price"))
    rate = shares.select("game_id", "month", "rate").distinct()
    def shared(df: DataFrame) -> DataFrame:
        keyed = df.withColumn("month", month_start(F.col("day")))
        return keyed.join(rate, ["game_id", "month"], "left").withColumn("rate", F.coalesce("rate", F.lit(0)))
    revenue = shared(per_day).select("game_id", "day", cents(F.col("price")).alias("b"),
                                     (F.col("price") * F.col("rate")).cast("decimal(24,2)").alias("a"))
    cost_days = costs.groupBy("game_id", F.col("cost_date").alias("day")).agg(
        F.sum("proxy").alias("proxy"), F.sum("publish_cost").alias("publish_cost"))
    spent = shared(cost_days).select(
        "game_id", "day", (-F.col("proxy")).alias("b"), (-F.col("proxy") * F.col("rate") / 100).cast("decimal(24,2)").alias("a"),
        "proxy", "publish_cost")
    spine = cohorts.select("game_id", F.col("reg_date").alias("day"))
    rows = revenue.unionByName(spent, allowMissingColumns=True).unionByName(spine, allowMissingColumns=True)
    per_game = rows.groupBy("game_id", "day").agg(*[F.sum(c).alias(c) for c in ("a", "b", "proxy", "publish_cost")])
    index = F.datediff("day", F.lit(run_day - dt.timedelta(days=back_days)))
    by_day = "PARTITION BY game_id ORDER BY _i"
    whole = f"{by_day} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"

    def total(column: str, frame: str, name: str) -> str:
        return f"cast(coalesce(sum({column}) OVER ({frame}), 0) AS bigint) AS {name}"

    ahead = [total(c, f"{by_day} RANGE BETWEEN CURRENT ROW AND {n - 1} FOLLOWING", f"amount{c}{n}") for n in horizons for c in "ba"]
    # the greatest cost of any other day; the cohort's own day counts as 0
    elsewhere = (f"greatest(max(publish_cost) OVER ({by_day} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), "
                 f"max(publish_cost) OVER ({by_day} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0)")
    windowed = per_game.withColumn("_i", index).selectExpr(
        "game_id", "day AS reg_date", *ahead, f"cast({elsewhere} AS bigint) AS publish_cost",
        total("proxy", whole, "behalf_water"), total("b", whole, "amount_b"), total("a", whole, "amount_a"))
    return cohorts.join(windowed, ["game_id", "reg_date"])


def natural_residual(total: DataFrame, attributed: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Total minus attributed, per key; a key nothing was attributed to keeps its total."""
    done = attributed.groupBy(*keys).agg(*[F.sum(m).alias(f"_{m}") for m in metrics])
    extra = [c for c in total.columns if c not in metrics and c not in keys]
    sums = total.groupBy(*keys, *extra).agg(*[F.sum(m).alias(m) for m in metrics])
    return sums.join(done, list(keys), "left").select(
        *keys, *extra, *[(F.col(m) - F.coalesce(f"_{m}", F.lit(0))).alias(m) for m in metrics])


def daily_report(base: DataFrame, actions: DataFrame, keys: Sequence[str], pkg: str = "pkg_code") -> DataFrame:
    """Base KPIs with the cohort actions of the same key, 0 where there are none; no backslash packages."""
    metrics = [c for c in actions.columns if c not in keys]
    joined = base.filter(~F.col(pkg).contains("\\")).join(actions, list(keys), "left")
    return joined.fillna(0, metrics)
