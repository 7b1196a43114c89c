"""Accounts and device ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playcohort import constants as C


def norm_account(account: Column) -> Column:
    return F.lower(F.trim(account))


def pipe_device(imei: Column) -> Column:
    """Undo the ``$`` that stands for ``|`` inside pipe-delimited logs."""
    return F.replace(imei, F.lit("$"), F.lit("|"))


def first_device(imei: Column) -> Column:
    """The id before the first ``&`` (android logs append further ids)."""
    return F.split_part(imei, F.lit("&"), F.lit(1))


def dashed(device: Column) -> Column:
    """32 characters as 8-4-4-4-12, anything else as it is."""
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.when(F.length(device) == 32, F.concat_ws("-", *[F.substring(device, a, n) for a, n in cuts])).otherwise(device)


def canonical_device(device: Column) -> Column:
    """Upper-case id, dashed when it is a 32-digit id with or without dashes."""
    upper = F.upper(device)
    return dashed(F.when(F.length(upper) == 36, F.replace(upper, F.lit("-"), F.lit(""))).otherwise(upper))


def upper_md5(text: Column) -> Column:
    return F.upper(F.md5(text.cast("binary")))


def device_md5_sql(imei: str) -> str:
    """Upper md5 of the canonical id; ids that are neither 15 nor 32 long hash as empty text. ``imei`` is SQL text."""
    first = f"upper(split_part({imei}, '&', 1))"
    dashes = f"regexp_replace({first}, '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '$1-$2-$3-$4-$5')"
    return f"upper(md5(CASE length({first}) WHEN 15 THEN {first} WHEN 32 THEN {dashes} ELSE '' END))"


def device_md5(imei: str) -> Column:
    """The hash of :func:`device_md5_sql` for a column given by name; null stays null."""
    return F.when(F.col(imei).isNotNull(), F.expr(device_md5_sql(imei)))


def two_mode_md5(imei: Column, mode: Column) -> Column:
    """Mode 1 hashes the part before ``&``; any other mode the id cut after 8, 12 and 16 characters."""
    cut = F.concat_ws("-", F.substring(imei, 1, 8), F.substring(imei, 9, 4), F.substring(imei, 13, 4),
                      F.substr(imei, F.lit(17)))
    return F.when(imei.isNotNull(), F.md5(F.when(mode == "1", first_device(imei)).otherwise(cut).cast("binary")))


def stored_device_hash(imei: Column, os: Column, medium: Column, current: Column) -> Column:
    """Hash column of the click table: ios ids are hashed unless the medium (5, 6) sends them hashed."""
    ios = F.when(medium.isin(5, 6), F.upper(imei)).otherwise(upper_md5(imei))
    return F.when(os == "ios", ios).when(os == "android", F.upper(imei)).otherwise(current)


def valid_device(imei: Column) -> Column:
    """False for empty and all-zero ids, with or without dashes."""
    return F.coalesce(~F.replace(imei, F.lit("-"), F.lit("")).isin(*C.NULL_DEVICES), F.lit(False))


def valid_click_device(imei: Column, os: Column, medium: Column) -> Column:
    """As :func:`valid_device`, and not the hash of the null id that two android media send."""
    hashed_null = (os == "android") & medium.isin(*C.HASHED_MEDIA) & (imei == C.HASHED_NULL_DEVICE)
    return valid_device(imei) & ~F.coalesce(hashed_null, F.lit(False))


def blank_zero_device(imei: Column) -> Column:
    """The all-zero id counts as no device."""
    return F.when(imei.isNull() | (imei == C.ZERO_DEVICE), F.lit("")).otherwise(imei)
