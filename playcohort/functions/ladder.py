"""Revenue-share ladders written ``threshold=rate|threshold=rate``.

The rules exist once, as SQL text, and serve the DataFrame jobs and the named SQL function alike. Jobs parse
the ladders of a dimension before they join it to facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALID_TIER = "^[0-9]+=[^=]+$"


def tiers_sql(ladder: str) -> str:
    """Tiers as an array of (threshold, rate) sorted by threshold; malformed and overlong tiers are dropped."""
    parsed = (f"transform(filter(split({ladder}, '[|]'), p -> p RLIKE '{VALID_TIER}'), "
              "p -> named_struct('threshold', try_cast(split_part(p, '=', 1) AS BIGINT), 'rate', split_part(p, '=', 2)))")
    return f"array_sort(filter({parsed}, t -> t.threshold IS NOT NULL))"


def rate_sql(tiers: str, amount: str) -> str:
    """Rate of the highest threshold not above ``amount``; below all, the lowest; no tiers known, '0'."""
    best = f"coalesce(try_element_at(filter({tiers}, t -> t.threshold <= {amount}), -1), get({tiers}, 0)).rate"
    return f"CASE WHEN {tiers} IS NULL THEN '0' ELSE {best} END"


def once_sql(value: str, name: str, body: str) -> str:
    """``body`` with ``value`` evaluated once and bound to ``name``."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def ladder_tiers(ladder: str) -> Column:
    """The tiers of a ladder column, null for no ladder."""
    return F.expr(tiers_sql(ladder))


def tier_rate(tiers: str, amount: str) -> Column:
    """The rate an amount column reaches on a column of parsed tiers."""
    return F.expr(rate_sql(tiers, amount))


def concat_ladders(df: DataFrame, keys: list[str], ladder: str, out: str = "ladders") -> DataFrame:
    """Distinct ladder texts of a group, ordered and joined by ``|``.

    Distinct pairs are formed first, so only the different texts of a group reach one task: they are
    contract tiers, a handful per game.
    """
    return df.select(*keys, ladder).distinct().groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_list(ladder)), "|").alias(out))
