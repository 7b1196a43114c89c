"""Revenue of a cohort up to a number of days after registration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playcohort import constants as C
from playcohort.functions.money import cents, gross_amount, signed, zero_if_null


def distinct_orders(orders: DataFrame, statuses: Sequence[int] = (C.PAID, C.REFUNDED), product: int | None = None) -> DataFrame:
    """Orders once each (the log repeats them), with a known account and one of the statuses.

    ``distinct`` drops copies on the map side first, however many there are of one order.
    """
    kept = orders.filter(F.col("order_status").isin(*statuses) & F.col("game_account").isNotNull() & F.col("order_time").isNotNull())
    if product is not None:
        kept = kept.filter(F.col("prod_type") == product)
    return kept.select("order_no", "order_time", "game_account", "game_id", "ori_price", "total_amt", "payment_type",
                       "order_status", "prod_type").distinct()


def daily_spend(orders: DataFrame, keys: Sequence[str], gross: bool) -> DataFrame:
    """Signed cents per key and day: at most one row per key and day reaches the cohort join.

    Whole cents are 64-bit integers, which add far faster than wide decimals and as exactly.
    """
    amount = gross_amount(F.col("ori_price"), F.col("total_amt")) if gross else zero_if_null(F.col("ori_price"))
    return orders.groupBy(*keys, F.to_date("order_time").alias("order_date")).agg(
        F.sum(cents(signed(amount, F.col("order_status")))).alias("amount"))


def ltv(members: DataFrame, spend: DataFrame, on: Sequence[str], report: Sequence[str], horizons: Sequence[int],
        account: str = "game_account", shift: int = 0) -> DataFrame:
    """Cohort size and cumulative cents per horizon ``n``: days 0 to n-1. No orders give 0.

    One join and one conditional aggregate for all horizons. ``members`` has one row per (report keys,
    account); ``shift`` renames horizon ``n`` to ``n - shift``.
    """
    # the account level first, which the join has clustered already: the cohort size then is a plain count
    joined = members.join(spend, list(on), "left").withColumn("_off", F.datediff("order_date", "reg_date"))
    per_member = joined.groupBy(*report, account).agg(
        *[F.expr(f"sum(CASE WHEN _off BETWEEN 0 AND {n - 1} THEN amount END) AS h{n}") for n in horizons])
    return per_member.groupBy(*report).agg(F.count("*").alias("accounts"), *[
        F.expr(f"coalesce(sum(h{n}), 0L) AS ltv_{n - shift}day") for n in horizons])


def ltv_by_join(members: DataFrame, spend: DataFrame, on: Sequence[str], report: Sequence[str], horizons: Sequence[int]) -> DataFrame:
    """The same numbers by cohort, day offset and a running total; kept as a cross-check.

    Revenue is first reduced to (cohort, offset), a table as long as the horizon; horizons then
    accumulate over it.
    """
    days = F.datediff("order_date", "reg_date")
    by_offset = members.join(spend, list(on)).withColumn("offset", days).filter(F.col("offset").between(0, max(horizons) - 1))
    by_offset = by_offset.groupBy(*report, "offset").agg(F.sum("amount").alias("amount"))
    steps = F.explode(F.filter(F.array(*map(F.lit, horizons)), lambda n: n > F.col("offset")))
    wide = by_offset.withColumn("horizon", steps).groupBy(*report).pivot("horizon", list(horizons)).agg(F.sum("amount"))
    sizes = members.groupBy(*report).agg(F.count(F.lit(1)).alias("accounts"))
    return sizes.join(wide, list(report), "left").selectExpr(
        *report, "accounts", *[f"coalesce(`{n}`, 0L) AS ltv_{n}day" for n in horizons])
