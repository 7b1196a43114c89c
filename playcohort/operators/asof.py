"""As-of attribution: the latest earlier touch of the same key within a lookback.

A key may hold a third of all rows, so nothing here sorts a whole key in one task. Rows first shrink
to one per key and second; the window orders one key's *day* (at most 86,400 seconds), and the state
at the start of a day comes from a second window over one row per key and day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playcohort.functions.once import compute_once


def _points(events: DataFrame, touches: DataFrame, on: list[str], event_time: str, touch_time: str, event_id: str, rest: list[str], touch_cols: Sequence[str]) -> DataFrame:
    """One row per key and second with its greatest touch and its least event."""
    event = F.struct(event_id, *rest)
    touch = F.struct(*touch_cols)
    no_touch = F.lit(None).cast(touches.select(touch.alias("x")).schema["x"].dataType)
    rows = touches.select(*on, F.date_trunc("second", touch_time).alias("_t"), touch.alias("_touch"),
                          F.lit(None).cast(events.select(event.alias("x")).schema["x"].dataType).alias("_event"))
    rows = rows.unionByName(events.select(*on, F.date_trunc("second", event_time).alias("_t"), no_touch.alias("_touch"),
                                          event.alias("_event")))
    return rows.groupBy(*on, "_t").agg(F.max("_touch").alias("_touch"), F.min("_event").alias("_event")).withColumn("_day", F.to_date("_t"))


def next_carry(events: DataFrame, touches: DataFrame, on: Sequence[str], event_time: str, touch_time: str, event_id: str, touch_cols: Sequence[str],
               lookback_days: int, last_day: dt.date, carry: DataFrame | None = None) -> DataFrame:
    """What the days after ``last_day`` need of all days up to it: per key the latest touch (``_s``) and the last event (``_a``).

    ``events`` and ``touches`` are those of the days since ``carry``, the state before them. A key goes when its touch is too old
    for any event to come, so the state is as large as the lookback, not as the history.
    """
    on = list(on)
    points = _points(events, touches, on, event_time, touch_time, event_id, [], touch_cols)
    seen, at = F.when(F.col("_touch").isNotNull(), F.struct("_t", "_touch")), F.when(F.col("_event").isNotNull(), F.col("_t"))
    state = points.groupBy(*on).agg(F.max(seen).alias("_s"), F.max(at).alias("_a"))
    if carry is not None:
        state = state.unionByName(carry.select(*on, "_s", "_a")).groupBy(*on).agg(F.max("_s").alias("_s"), F.max("_a").alias("_a"))
    return state.filter(F.col("_s._t") >= F.date_sub(F.lit(last_day), lookback_days - 1).cast("timestamp"))


def latest_touch(events: DataFrame, touches: DataFrame, on: Sequence[str], event_time: str, touch_time: str, event_id: str,
                 touch_cols: Sequence[str], lookback_days: int, consume: bool = False, open_start: bool = False, carry: DataFrame | None = None) -> DataFrame:
    """Events that have a touch at or before them, with the columns of the latest one.

    The touch must not be older than midnight ``lookback_days`` before the event's day (strictly later
    with ``open_start``). With ``consume`` an event uses up every touch it could see, so a later event
    needs a newer one, and of events in the same second only the one with the least id gets it.

    ``carry`` is the state of earlier days by :func:`next_carry`: with it, ``events`` and ``touches`` are those of the days
    in question and nothing before is read.
    """
    on = list(on)
    rest = [c for c in events.columns if c not in (*on, event_id)] if consume else []
    points = _points(events, touches, on, event_time, touch_time, event_id, rest, touch_cols)
    seen = F.when(F.col("_touch").isNotNull(), F.struct("_t", "_touch"))
    at = F.when(F.col("_event").isNotNull(), F.col("_t"))

    in_day = Window.partitionBy(*on, "_day").orderBy("_t")
    upto, before = in_day.rowsBetween(Window.unboundedPreceding, 0), in_day.rowsBetween(Window.unboundedPreceding, -1)
    local = points.withColumns({"_hit": F.last(seen, ignorenulls=True).over(upto), "_prev": F.last(at, ignorenulls=True).over(before)})

    earlier = Window.partitionBy(*on).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    # the windowed rows are dealt by key and day already
    states = local.groupBy(*on, "_day").agg(F.max("_hit").alias("_s"), F.max(at).alias("_a"))
    if carry is not None:  # as a day before all others
        states = states.unionByName(carry.select(*on, F.lit("0001-01-01").cast("date").alias("_day"), "_s", "_a"))
    before_day = states.select(
        *on, "_day", F.last("_s", ignorenulls=True).over(earlier).alias("_day_hit"),
        F.last("_a", ignorenulls=True).over(earlier).alias("_day_prev"))

    joined = local.filter(F.col("_event").isNotNull()).join(before_day, [*on, "_day"]).select(
        *on, "_t", "_event", F.coalesce("_prev", "_day_prev").alias("_prev"), "_hit", "_day_hit")
    hits = compute_once(joined, "_best", F.coalesce("_hit", "_day_hit")).select(*on, "_t", "_event", "_prev", F.col("_best").alias("_hit"))
    oldest = F.date_sub(F.to_date("_t"), lookback_days).cast("timestamp")
    recent = (F.col("_hit._t") > oldest) if open_start else (F.col("_hit._t") >= oldest)
    hits = hits.filter(recent)
    if consume:
        hits = hits.filter(F.col("_prev").isNull() | (F.col("_hit._t") > F.col("_prev")))
    touched = [F.col("_hit._t").alias("touch_time"), *[F.col(f"_hit._touch.{c}").alias(f"touch_{c}") for c in touch_cols]]
    if consume:
        # one event of a second is left, and the point has carried its columns
        return hits.select(*on, F.col(f"_event.{event_id}").alias(event_id), *[F.col(f"_event.{c}").alias(c) for c in rest], *touched)
    timed = events.withColumn("_t", F.date_trunc("second", event_time))
    return timed.join(hits.select(*on, "_t", *touched), [*on, "_t"]).drop("_t")
