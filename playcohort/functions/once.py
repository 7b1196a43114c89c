"""Evaluate an expensive expression exactly once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add ``value`` as a column that later filters and projections only refer to.

    A projection would be merged into them, and a split or a JSON parse then runs once per use. The
    optimizer does not copy the result of a generator, so a generator of one element keeps it whole.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
