"""Promotion channels: ``parent_child_pkg`` strings and their defaults.

The expressions are SQL text, as they are used in bulk: one text costs one call into the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playcohort import constants as C

CHANNEL_COLS = ("parent_channel", "child_channel", "pkg_code")


def clean_channel_sql(channel: str) -> str:
    return (f"CASE WHEN {channel} IS NULL OR {channel} IN ('', '0') THEN '{C.DEFAULT_CHANNEL}' "
            f"WHEN {channel} = r'\\N' THEN '{C.NULL_TEXT_CHANNEL}' ELSE {channel} END")


def clean_channel(channel: str) -> Column:
    """Empty, null and ``0`` become the default channel; the text ``\\N`` its own marker."""
    return F.expr(clean_channel_sql(channel))


def channel_part_sql(channel: str, index: int) -> str:
    cleaned, whole = clean_channel_sql(channel), f"{channel} = '{C.UNKNOWN_ACCOUNT_CHANNEL}'"
    part = f"split_part({cleaned}, '_', {index + 1})"
    if index == 0:
        return f"CASE WHEN {whole} THEN {channel} ELSE coalesce(nullif({part}, ''), '{C.DEFAULT_CHANNEL}') END"
    return f"CASE WHEN {whole} THEN '' ELSE {part} END"


def channel_part(channel: str, index: int) -> Column:
    """Part ``index`` (0 parent, 1 child, 2 package) or an empty string; an empty parent is the default."""
    return F.expr(channel_part_sql(channel, index))


def with_channel_parts(df: DataFrame, channel: str) -> DataFrame:
    """Add ``parent_channel``, ``child_channel`` and ``pkg_code``."""
    kept = [c for c in df.columns if c not in CHANNEL_COLS]
    return df.selectExpr(*kept, *[f"{channel_part_sql(channel, i)} AS {name}" for i, name in enumerate(CHANNEL_COLS)])


def channel_fits(max_pkg: int = C.MAX_PKG_LEN) -> Column:
    """True when the three parts fit the report columns."""
    return F.expr(f"length(parent_channel) <= {C.MAX_PARENT_LEN} AND length(child_channel) <= {C.MAX_CHILD_LEN} "
                  f"AND length(pkg_code) <= {max_pkg}")


def game_of_pkg(pkg: Column) -> Column:
    """Game id from a package code: the digits before ``M``; null when there are none."""
    return F.when(pkg.contains("M"), F.split_part(pkg, F.lit("M"), F.lit(1)).try_cast("int"))
