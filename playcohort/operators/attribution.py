"""Advertising attribution: click to activation to registration to order."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playcohort import constants as C
from playcohort.functions.device import canonical_device, first_device, upper_md5, valid_click_device, valid_device
from playcohort.functions.money import cents
from playcohort.functions.once import compute_once
from playcohort.operators.asof import latest_touch, next_carry

LEVELS = ("idea_id", "first_level", "second_level")
STAT_KEY = ("game_id", "pkg_code", "medium", *LEVELS)


def media_name(code):
    return F.create_map(*[F.lit(x) for pair in C.MEDIA.items() for x in pair])[code]


def valid_clicks(clicks: DataFrame) -> DataFrame:
    return clicks.filter(valid_click_device(F.col("imei"), F.col("os"), F.col("adv_name")))


def _click_keys(clicks: DataFrame) -> DataFrame:
    """Match key of a click: ios by game, android by package; android ids compare as hashes.

    Two media send android ids already hashed, so hashing the others makes one comparison serve all.
    """
    ios = F.col("os") == "ios"
    hashed = F.when(F.col("adv_name").isin(*C.HASHED_MEDIA), F.upper("imei")).otherwise(upper_md5(F.col("imei")))
    key = F.struct(F.when(ios, C.OS_IOS).otherwise(C.OS_ANDROID).alias("os"),
                   F.when(ios, F.col("game_id").cast("string")).otherwise(F.col("pkg_id")).alias("place"),
                   F.when(ios, canonical_device(F.col("imei"))).otherwise(hashed).alias("device"))
    return compute_once(clicks, "_k", key).select("_k.*", "ts", "pkg_id", "imei", F.col("adv_name").alias("medium"), *LEVELS)


CLICK_KEY = ("os", "place", "device")
CLICK_COLS = ("medium", "pkg_id", "imei", *LEVELS)


def click_touches(clicks: DataFrame) -> DataFrame:
    """Valid clicks with the key an activation finds them by."""
    return _click_keys(valid_clicks(clicks))


def activation_events(active: DataFrame, games: DataFrame) -> DataFrame:
    """Activations of advertised games with the key of their clicks."""
    ios = F.col("os") == "ios"
    imei = first_device(F.col("imei"))
    key = F.struct(imei.alias("own_imei"), F.when(ios, C.OS_IOS).otherwise(C.OS_ANDROID).alias("os"),
                   F.when(ios, F.col("game_id").cast("string")).otherwise(F.col("pkg_code")).alias("place"),
                   F.when(ios, canonical_device(imei)).otherwise(upper_md5(imei)).alias("device"))
    return compute_once(active.join(games, "game_id", "left_semi").filter(valid_device(imei)), "_k", key).select(
        "event_id", "game_id", F.col("pkg_code").alias("own_pkg"), "active_time", "_k.*")


def matched_clicks(active: DataFrame, clicks: DataFrame, games: DataFrame | None = None, carry: DataFrame | None = None) -> DataFrame:
    """Activations with the latest click of the last seven days in ``touch_`` columns; a click serves one activation.

    ``active`` needs event_id, game_id, pkg_code, active_time, os ('android'/'ios') and imei. ``games`` are the advertised
    games, else those of the clicks. With ``carry`` both logs are those of some days only.
    """
    events = activation_events(active, clicks.select("game_id").distinct() if games is None else games)
    return latest_touch(events, click_touches(clicks), CLICK_KEY, "active_time", "ts", "event_id", CLICK_COLS, C.CLICK_LOOKBACK_DAYS, consume=True, carry=carry)


def click_carry(active: DataFrame, clicks: DataFrame, games: DataFrame, last_day: dt.date, carry: DataFrame | None = None) -> DataFrame:
    """What the activations after ``last_day`` need of the clicks and activations up to it."""
    return next_carry(activation_events(active, games), click_touches(clicks), CLICK_KEY, "active_time", "ts", "event_id", CLICK_COLS, C.CLICK_LOOKBACK_DAYS, last_day, carry)


def credit_activations(hits: DataFrame, *more: str) -> DataFrame:
    ios = F.col("os") == C.OS_IOS
    return hits.select(
        *more, "event_id", "active_time", "game_id", "os", F.when(ios, F.col("touch_pkg_id")).otherwise(F.col("own_pkg")).alias("pkg_code"),
        F.when(ios, F.col("touch_imei")).otherwise(F.col("own_imei")).alias("imei"), F.col("touch_medium").alias("medium"),
        *[F.col(f"touch_{c}").alias(c) for c in LEVELS])


def attribute_activations(active: DataFrame, clicks: DataFrame) -> DataFrame:
    """Activations credited to their latest click, see :func:`matched_clicks`."""
    return credit_activations(matched_clicks(active, clicks))


def activation_stats(attributed: DataFrame) -> DataFrame:
    return attributed.groupBy(F.to_date("active_time").alias("day"), *STAT_KEY).agg(F.count(F.lit(1)).alias("active_num"))


ACTIVATION_KEY = ("os", "game_id", "place", "device")
ACTIVATION_COLS = ("medium", *LEVELS, "pkg_code")


def _own_keys(rows: DataFrame, imei) -> DataFrame:
    """Android matches on device, game and package, ios on device and game."""
    place = F.when(F.col("os") == C.OS_IOS, F.lit("")).otherwise(F.col("pkg_code"))
    return compute_once(rows, "_k", F.struct(place.alias("place"), canonical_device(imei).alias("device")))


def activation_touches(attributed: DataFrame, *more: str) -> DataFrame:
    """Attributed activations with the key a registration finds them by."""
    return _own_keys(attributed, F.col("imei")).select(*more, "os", "game_id", "_k.*", "active_time", "medium", *LEVELS, "pkg_code")


def registration_events(regi: DataFrame) -> DataFrame:
    """Registrations of valid devices with the key of their activation."""
    imei = first_device(F.col("imei"))
    events = regi.filter(valid_device(imei)).withColumn("os", F.when(F.col("os") == "android", C.OS_ANDROID).otherwise(C.OS_IOS))
    return _own_keys(events, imei).select("event_id", "game_account", "game_id", "reg_time", "os", "_k.*")


def credit_registrations(hits: DataFrame, *more: str) -> DataFrame:
    return hits.select(*more, "event_id", "game_account", "reg_time", "game_id", "os", F.col("device").alias("imei"),
                       F.col("touch_medium").alias("medium"), F.col("touch_pkg_code").alias("pkg_code"),
                       *[F.col(f"touch_{c}").alias(c) for c in LEVELS])


def activation_carry(regi: DataFrame, attributed: DataFrame, last_day: dt.date, carry: DataFrame | None = None) -> DataFrame:
    """What the registrations after ``last_day`` need of the attributed activations up to it."""
    return next_carry(registration_events(regi), activation_touches(attributed), ACTIVATION_KEY, "reg_time", "active_time", "event_id", ACTIVATION_COLS,
                      C.ACTIVATION_LOOKBACK_DAYS, last_day, carry)


def attribute_registrations(regi: DataFrame, attributed: DataFrame, carry: DataFrame | None = None) -> DataFrame:
    """Registrations credited to the latest attributed activation of the last 30 days.

    Android matches on device, game and package, ios on device and game. Unmatched ones are natural
    traffic and left out. ``regi`` needs event_id, game_account, game_id, pkg_code, reg_time, os, imei.
    """
    hits = latest_touch(registration_events(regi), activation_touches(attributed), ACTIVATION_KEY, "reg_time", "active_time", "event_id",
                        ACTIVATION_COLS, C.ACTIVATION_LOOKBACK_DAYS, open_start=True, carry=carry)
    return credit_registrations(hits)


def _first_per_day(rows: DataFrame, day, entity: list[str], time: str, row_id: str, count: str, devs: str) -> DataFrame:
    """Rows per (day, stat key) and, at its first row of the day, one per entity.

    Rows shrink to one per (day, entity, stat key) before the window, which then orders the few stat
    keys of one entity's day.
    """
    keys = list(dict.fromkeys([*entity, *STAT_KEY]))
    number = F.sum("copies") if "copies" in rows.columns else F.count(F.lit(1))
    per = rows.withColumn("day", day).groupBy("day", *keys).agg(
        number.alias(count), F.min(F.struct(time, row_id)).alias("_first"))
    first = F.min("_first").over(Window.partitionBy("day", *entity))
    return per.withColumn(devs, (F.col("_first") == first).cast("long")).groupBy("day", *STAT_KEY).agg(
        F.sum(count).alias(count), F.sum(devs).alias(devs))


def registration_stats(attributed: DataFrame) -> DataFrame:
    """Registrations, and devices once per (day, medium, package)."""
    return _first_per_day(attributed, F.to_date("reg_time"), ["medium", "pkg_code", "imei"], "reg_time", "event_id",
                          "regi_num", "regi_dev_num")


def click_stats(clicks: DataFrame) -> DataFrame:
    """Valid clicks, and devices once per (day, medium, package). ``clicks`` needs event_id; a row may stand for ``copies``."""
    rows = valid_clicks(clicks).withColumnsRenamed({"pkg_id": "pkg_code", "adv_name": "medium"})
    return _first_per_day(rows, F.to_date("ts"), ["medium", "pkg_code", "imei"], "ts", "event_id", "click_num", "click_dev_num")


def click_table(clicks: DataFrame, matched: DataFrame) -> DataFrame:
    """The click table: per (package, device) a row for each stretch of clicks up to the activation that used them up.

    A click that finds an open row refreshes its time and callback and nothing else; after an activation has matched
    the row, the next click opens a new one. ``matched`` are the activations of :func:`matched_clicks`.
    """
    key = ["pkg_id", "imei"]
    rest = [c for c in clicks.columns if c not in (*key, "ts", "callback")]
    # a row per second of a device first: only its seconds are ever ordered
    seconds = valid_clicks(clicks).groupBy(*key, "ts").agg(F.min(F.struct(*rest)).alias("opened"), F.max("callback").alias("callback"))
    used = matched.select(F.col("touch_pkg_id").alias("pkg_id"), F.col("touch_imei").alias("imei"), F.col("active_time").alias("ts")).distinct()
    points = seconds.withColumn("used", F.lit(0)).unionByName(used.withColumn("used", F.lit(1)), allowMissingColumns=True)
    by_time = Window.partitionBy(*key).orderBy("ts", "used")  # a click of the activation's second comes before it
    stretch = F.sum("used").over(by_time.rowsBetween(Window.unboundedPreceding, -1))
    rows = points.withColumn("stretch", F.coalesce(stretch, F.lit(0))).groupBy(*key, "stretch").agg(
        F.min(F.when(F.col("used") == 0, F.struct("ts", "opened"))).alias("first"), F.max(F.when(F.col("used") == 0, F.struct("ts", "callback"))).alias("last"),
        F.max("used").alias("matched"))
    return rows.filter("first IS NOT NULL").select(*key, "last.ts", "last.callback", "first.opened.*", "matched")


def first_attributed(attributed: DataFrame) -> DataFrame:
    """Each account's first registration that a medium and a package own."""
    cols = ("reg_time", "event_id", "medium", "pkg_code", *LEVELS)
    one = attributed.filter("medium >= 1 AND pkg_code <> ''").groupBy("game_account").agg(F.min(F.struct(*cols)).alias("r"))
    return one.select("game_account", *[F.col(f"r.{c}").alias(c) for c in cols])


def order_stats(orders: DataFrame, attributed: DataFrame | None, owners: DataFrame | None = None) -> DataFrame:
    """Money and payers per (day, stat key) from the payer's attributed registration.

    A payer counts once a day, at the first order; money and payer are new when the account
    registered that day. ``orders`` are deduplicated rows with order_no, order_time, game_account,
    game_id, ori_price, total_amt and imei. ``owners`` are the rows of :func:`first_attributed` where they are kept.
    """
    one = first_attributed(attributed) if owners is None else owners
    owner = one.select("game_account", F.to_date("reg_time").alias("reg_date"), "medium", "pkg_code", *LEVELS)
    paid = orders.filter(valid_device(first_device(F.col("imei")))).withColumn("day", F.to_date("order_time"))
    # an account's day in one game first: hot payers shrink before they meet their registration
    per_game = paid.groupBy("game_account", "day", "game_id").agg(
        F.sum(cents(F.col("ori_price") + F.col("total_amt"))).alias("amount"), F.min(F.struct("order_time", "order_no")).alias("first"))
    first = F.min("first").over(Window.partitionBy("game_account", "day"))
    rows = per_game.withColumn("payer", (F.col("first") == first).cast("long")).join(owner, "game_account")
    new = (F.col("reg_date") == F.col("day")).cast("long")
    return rows.groupBy("day", *STAT_KEY).agg(
        F.sum("amount").alias("pay_price"), F.sum("payer").alias("pay_accounts"),
        F.sum(F.col("amount") * new).alias("new_pay_price"), F.sum(F.col("payer") * new).alias("new_pay_accounts"))
