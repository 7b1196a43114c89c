"""Cumulative payers and revenue by day for each registration cohort."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playcohort import constants as C


def pay_curve(members: DataFrame, spend: DataFrame, report: Sequence[str], run_day: dt.date, days: int = C.PAY_CURVE_DAYS) -> DataFrame:
    """Running payers and cents over the days an order of the cohort stays visible.

    ``members`` has one row per (report keys with ``reg_date``, account), ``spend`` one per (account,
    day) in cents. A payer counts from the first day on. Everything is summed to (cohort, day) before the
    window, which then orders as many rows per cohort as the run has days.
    """
    spend = spend.filter(F.col("order_date") <= F.lit(run_day))
    paid = members.join(spend, "game_account").select(*report, "game_account", "order_date", "amount")
    by_account = paid.groupBy(*report, "game_account", "order_date").agg(F.sum("amount").alias("amount"))
    per_day = by_account.groupBy(*report, F.col("order_date").alias("day")).agg(F.sum("amount").alias("amount"))
    first = by_account.groupBy(*report, "game_account").agg(F.min("order_date").alias("day"))
    payers = first.groupBy(*report, "day").agg(F.count(F.lit(1)).alias("payers"))
    until = F.least(F.date_add("day", days), F.lit(run_day))
    spine = per_day.select(*report, F.explode(F.sequence("day", until)).alias("day"))
    facts = (
        spine.withColumns({"amount": F.lit(0).cast("long"), "payers": F.lit(0).cast("long")})
        .unionByName(per_day.withColumn("payers", F.lit(0).cast("long")))
        .unionByName(payers.withColumn("amount", F.lit(0).cast("long")))
        .groupBy(*report, "day").agg(F.sum("amount").alias("amount"), F.sum("payers").alias("payers"))
    )
    running = Window.partitionBy(*report).orderBy("day").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return facts.select(
        *report, (F.datediff("day", "reg_date") + 1).alias("date_diff"), F.sum("payers").over(running).alias("pays"),
        F.sum("amount").over(running).alias("pay_amount"))
