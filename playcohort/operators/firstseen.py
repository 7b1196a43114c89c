"""First-seen dimensions: what reports need of all days before theirs, as one row per entity.

An account's first registration, a device's first activation in a game, an account's first attributed registration. Each is a
minimum, so days may be added in any order, more than once and in parts; a report that is given the dimension reads no log
before its range. The tables lie in buckets: adding a day touches the buckets of its entities only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playcohort.functions.channel import CHANNEL_COLS
from playcohort.operators import attribution
from playcohort.operators.buckets import BUCKETS, BucketTable

CHANNELS = ", ".join(f"{c} string" for c in CHANNEL_COLS)


def least(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the least in the order of the other columns."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def first_registrations(regi: DataFrame) -> DataFrame:
    """``game_account, reg_time`` and channel parts of each account's first registration; ``regi`` carries channel parts."""
    return least(regi.filter("game_account IS NOT NULL").select("game_account", "reg_time", *CHANNEL_COLS), ["game_account"])


def first_activations(active: DataFrame) -> DataFrame:
    """``game_id, imei, active_time`` of each device's first activation in a game."""
    return least(active.select("game_id", "imei", "active_time"), ["game_id", "imei"])


@dataclass(frozen=True)
class FirstSeen:
    """The three dimensions below ``base``."""

    spark: SparkSession
    base: str
    buckets: int = BUCKETS

    @property
    def accounts(self) -> BucketTable:
        return BucketTable(self.spark, f"{self.base}/accounts", f"game_account string, reg_time timestamp, {CHANNELS}", ["game_account"], self.buckets)

    @property
    def devices(self) -> BucketTable:
        return BucketTable(self.spark, f"{self.base}/devices", "game_id int, imei string, active_time timestamp", ["game_id", "imei"], self.buckets)

    @property
    def owners(self) -> BucketTable:
        levels = ", ".join(f"{c} string" for c in attribution.LEVELS)
        schema = f"game_account string, reg_time timestamp, event_id bigint, medium int, pkg_code string, {levels}"
        return BucketTable(self.spark, f"{self.base}/owners", schema, ["game_account"], self.buckets)

    def add(self, regi: DataFrame, active: DataFrame, attributed: DataFrame, version: int) -> None:
        """Registrations (with channel parts), activations and attributed registrations of some days, as the next version."""
        for table, rows in ((self.accounts, first_registrations(regi)), (self.devices, first_activations(active)), (self.owners, attribution.first_attributed(attributed))):
            table.merge(rows, version, lambda old, new, keys=table.keys: least(old.unionByName(new), keys))
