"""Dates and times. Malformed text gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = "yyyy-MM-dd HH:mm:ss"
ACCESS_LOG = "dd/MMM/yyyy:HH:mm:ss Z"
ACCESS_LOG_STAMP = r"\[(\d{2}/[A-Z][a-z]{2}/\d{4}:\d{2}:\d{2}:\d{2} [+-]\d{4})\]"
ACCESS_LOG_DATE = r"\[(\d{2}/[A-Z][a-z]{2}/\d{4}):(\d{2})"


def is_time_text(text: Column) -> Column:
    """19 characters, each a digit, blank, dash or colon."""
    return F.coalesce(text.rlike(r"^[0-9 :\-]{19}$"), F.lit(False))


def is_number_text(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^[0-9]+$"), F.lit(False))


def parse_time(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(SECOND))


def hour_key(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd HH")


def month_key(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM")


def day_key(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def epoch_text(seconds: Column) -> Column:
    return F.from_unixtime(seconds.cast("long"), SECOND)


def is_before(left: Column, right: Column, grain: str = "second") -> Column:
    """``left < right`` at second, hour or day grain; false when either side is malformed."""
    a, b = (F.date_trunc(grain, parse_time(c)) for c in (left, right))
    return F.coalesce(a < b, F.lit(False))


def is_after(left: Column, right: Column, grain: str = "second") -> Column:
    return is_before(right, left, grain)


def access_log_day(line: Column) -> Column:
    """Local date of an access-log line, as written (its own zone), ``yyyy-MM-dd``."""
    day = F.regexp_extract(line, ACCESS_LOG_DATE, 1)
    return F.date_format(F.try_to_timestamp(day, F.lit("dd/MMM/yyyy")), "yyyy-MM-dd")


def access_log_hour(line: Column) -> Column:
    return F.concat_ws(" ", access_log_day(line), F.regexp_extract(line, ACCESS_LOG_DATE, 2))


def access_log_instant(line: Column) -> Column:
    """The instant of an access-log line, honouring the zone it states."""
    return F.try_to_timestamp(F.regexp_extract(line, ACCESS_LOG_STAMP, 1), F.lit(ACCESS_LOG))


def run_day(now: Column, latest_hour: int = 1) -> Column:
    """Yesterday until ``latest_hour`` o'clock, today afterwards."""
    return F.when(F.hour(now) < latest_hour, F.date_sub(F.to_date(now), 1)).otherwise(F.to_date(now))
