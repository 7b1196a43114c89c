"""Histograms: how many entities fall into each band of a measure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Band = tuple[float | None, float | None]


def band_name(prefix: str, band: Band) -> str:
    low, high = band
    if low == high:
        return f"{prefix}{low}"
    return prefix + "_".join(str(x) for x in (low, high) if x is not None)


def in_band(value: str, band: Band, half_open: bool) -> str:
    """SQL text of the band's test; an open side has none."""
    low, high = band
    tests = [f"{value} >= {low}"] if low is not None else []
    if high is not None:
        tests.append(f"{value} {'<' if half_open else '<='} {high}")
    return " AND ".join(tests)


def banded(df: DataFrame, group: Sequence[str], value: str, bands: Sequence[Band], prefix: str, half_open: bool = False,
           where: str = "true", extra: Sequence[Column] = ()) -> DataFrame:
    """Rows of ``df`` (one per entity) counted per band in a single aggregate."""
    counts = [F.expr(f"count_if({in_band(value, b, half_open)} AND {where}) AS {band_name(prefix, b)}") for b in bands]
    return df.groupBy(*group).agg(*counts, *extra)


def histogram(rows: DataFrame, entity: Sequence[str], group: Sequence[str], bands: Sequence[Band], prefix: str,
              measure: Column | None = None, half_open: bool = False, where: str = "true",
              extra: Sequence[Column] = ()) -> DataFrame:
    """Measure per entity (rows by default), then bands per group.

    The first aggregate groups by group and entity, so its result is already clustered for neither a
    hot group nor a hot entity: both levels combine on the map side.
    """
    keys = list(dict.fromkeys([*group, *entity]))
    per_entity = rows.groupBy(*keys).agg((F.count(F.lit(1)) if measure is None else measure).alias("_value"))
    return banded(per_entity, group, "_value", bands, prefix, half_open, where, extra)
