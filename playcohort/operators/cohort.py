"""Cohorts and who of them came back."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playcohort.operators.buckets import BUCKETS, BucketTable

BITS = 62


def day_range(column: str, first: dt.date, last: dt.date) -> Column:
    """``first <= day <= last`` on the raw timestamp, so that the scan can skip row groups."""
    end = last + dt.timedelta(days=1)
    return (F.col(column) >= F.lit(str(first)).cast("timestamp")) & (F.col(column) < F.lit(str(end)).cast("timestamp"))


def first_registration(regi: DataFrame, keys: Sequence[str], time: str = "reg_time", channel: str = "expand_channel") -> DataFrame:
    """One row per key: first time, greatest channel. Partially aggregated before the shuffle."""
    return regi.groupBy(*keys).agg(F.min(time).alias(time), F.max(channel).alias(channel))


def published_only(facts: DataFrame, games: DataFrame) -> DataFrame:
    """Facts of published games; the game list is distinct, the join never multiplies."""
    return facts.join(games.select("game_id").distinct(), "game_id", "left_semi")


def active_days(activity: DataFrame, entity: Sequence[str], time: str, origin: dt.date, n_days: int) -> DataFrame:
    """One row per entity: the days it was active, as bits counted from ``origin``.

    ``bit_or`` combines on the map side, so an entity with a third of all rows shuffles as one small
    row per task, and the join that follows meets exactly one row per entity.
    """
    day = F.datediff(F.to_date(time), F.lit(origin))
    words = [
        f"bit_or(CASE WHEN _day BETWEEN {low} AND {low + BITS - 1} THEN shiftleft(1L, _day - {low}) ELSE 0L END)"
        for low in range(0, n_days, BITS)
    ]
    last = origin + dt.timedelta(days=n_days - 1)
    days = activity.filter(day_range(time, origin, last)).withColumn("_day", day)
    return days.groupBy(*entity).agg(F.expr(f"array({', '.join(words)})").alias("days"))


def day_bits(activity: DataFrame, entity: Sequence[str], time: str, origin: dt.date) -> DataFrame:
    """``entity, word, bits``: the days an entity was active, ``BITS`` to a word, counted from ``origin``.

    Rows of different days merge by ``bit_or``, in any order and more than once, see :class:`ActivityBits`.
    """
    day = F.datediff(F.to_date(time), F.lit(origin))
    rows = activity.filter(F.col(time) >= F.lit(str(origin)).cast("timestamp")).withColumn("_day", day)
    return rows.groupBy(*entity, F.expr(f"cast(_day div {BITS} AS int)").alias("word")).agg(F.expr(f"bit_or(shiftleft(1L, _day % {BITS}))").alias("bits"))


def days_of_bits(bits: DataFrame, entity: Sequence[str], origin: dt.date, first: dt.date, last: dt.date) -> tuple[DataFrame, dt.date]:
    """(one row per entity as :func:`active_days` gives it, the day its bits count from) out of kept words; nothing after ``last``."""
    low, high = (first - origin).days // BITS, (last - origin).days // BITS
    within = (1 << ((last - origin).days % BITS + 1)) - 1
    word = lambda w: f"bit_or(CASE WHEN word = {w} THEN bits{f' & {within}L' if w == high else ''} ELSE 0L END)"
    rows = bits.filter(F.col("word").between(low, high)).groupBy(*entity).agg(F.expr(f"array({', '.join(word(w) for w in range(low, high + 1))})").alias("days"))
    return rows, origin + dt.timedelta(days=low * BITS)


@dataclass(frozen=True)
class ActivityBits:
    """Activity of entities kept from day to day: a row per entity and ``BITS`` days, in buckets.

    A new day reads that day's log and the buckets of its entities.
    """

    spark: SparkSession
    path: str
    entity: str
    origin: dt.date
    buckets: int = BUCKETS

    @property
    def table(self) -> BucketTable:
        return BucketTable(self.spark, self.path, f"{self.entity}, word int, bits bigint", [*self.keys, "word"], self.buckets)

    @property
    def keys(self) -> list[str]:
        return [c.split()[0] for c in self.entity.split(",")]

    def add(self, activity: DataFrame, time: str, version: int) -> None:
        """The activity of some days as the next version; days may come again."""
        both = lambda old, new: old.unionByName(new).groupBy(*self.keys, "word").agg(F.expr("bit_or(bits)").alias("bits"))
        self.table.merge(day_bits(activity, self.keys, time, self.origin), version, both)

    def days(self, first: dt.date, last: dt.date) -> tuple[DataFrame, dt.date]:
        return days_of_bits(self.table.read(), self.keys, self.origin, first, last)


def was_active(index: str) -> str:
    """SQL text: 1 when the bit of that day is set; days outside the window were not active."""
    word = f"get(days, cast(({index}) div {BITS} AS int))"
    return f"coalesce(CASE WHEN {index} >= 0 THEN cast(getbit({word}, ({index}) % {BITS}) AS bigint) END, 0L)"


def retention(members: DataFrame, activity: DataFrame | ActivityBits, entity: Sequence[str], report: Sequence[str], offsets: Sequence[int],
              time: str, first: dt.date, last: dt.date, size: str | None = None) -> DataFrame:
    """Entities of each cohort seen again exactly ``n`` days after their day.

    ``members`` holds one row per (report keys, entity) with ``reg_date`` among the report keys;
    activity counts from ``first`` to ``last``. ``size`` names a member column to sum as cohort size.
    Cohorts nobody of whom came back do not appear. Where activity is kept as :class:`ActivityBits`, no log is read.
    """
    if isinstance(activity, ActivityBits):
        days, first = activity.days(first, last)
    else:
        days = active_days(activity, entity, time, first, (last - first).days + 1)
    seen = members.join(days, list(entity), "left" if size else "inner")
    seen = seen.withColumn("_i", F.datediff("reg_date", F.lit(first)))
    names = [f"retained_{n}day" for n in offsets]
    sums = [f"sum({was_active(f'_i + {n}')}) AS {name}" for n, name in zip(offsets, names)]
    if size:
        sums.insert(0, f"sum({size}) AS {size}")
    return seen.groupBy(*report).agg(*map(F.expr, sums)).filter(" OR ".join(f"{n} > 0" for n in names))
