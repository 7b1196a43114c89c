"""Dimensions: games, packages, owners.

No join here is forced to broadcast: Spark broadcasts a dimension when its statistics prove it small
and shuffles otherwise, which is right for either size.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playcohort import constants as C

GAME_COLS = ("parent_game_id", "os", "group_id")


def child_games(sdk: DataFrame) -> DataFrame:
    """One row per child game; a child listed twice keeps its smallest parent."""
    rows = sdk.groupBy("old_game_id").agg(F.min(F.struct("game_id", "system_type", "group_id")).alias("g"))
    return rows.select(F.col("old_game_id"), F.col("g.game_id").alias("parent_game_id"), F.col("g.system_type").alias("os"),
                       F.col("g.group_id").alias("group_id"))


def with_game_dim(df: DataFrame, sdk: DataFrame, game: str = "game_id", keep_unknown: bool = False) -> DataFrame:
    """Add parent game, os and group. Unknown games are dropped, or kept with 0, 1 and 0."""
    dim = child_games(sdk).withColumnRenamed("old_game_id", game)
    if not keep_unknown:
        return df.join(dim, game)
    return df.join(dim, game, "left").fillna({"parent_game_id": 0, "os": 1, "group_id": 0})


def lookup_dims(df: DataFrame, sdk: DataFrame, packages: DataFrame, game: str = "game_id", pkg: str = "pkg_code") -> DataFrame:
    """Text attributes of game and package: '0', '1' and '0' for an unknown game, empty text otherwise.

    ``packages`` has one row per package.
    """
    games = child_games(sdk).select(F.col("old_game_id").alias(game), *[F.col(c).cast("string").alias(c) for c in GAME_COLS])
    attrs = [c for c in packages.columns if c != "pkg_code"]
    pkgs = packages.withColumnRenamed("pkg_code", pkg)
    joined = df.join(games, game, "left").join(pkgs, pkg, "left")
    return joined.fillna({"parent_game_id": "0", "os": "1", "group_id": "0", **{a: "" for a in attrs}})


def in_bounds(day: Column, start: Column, end: Column, bounds: str = "[]") -> Column:
    return (day >= start) & ((day <= end) if bounds == "[]" else (day < end))


def with_effective_dim(df: DataFrame, dim: DataFrame, key: str, day: str, ranges: Sequence[tuple[str, str]],
                       attrs: Sequence[str], dim_key: str = "pkg_code", bounds: str = "[]") -> DataFrame:
    """Attributes valid on the row's day; empty text when none is.

    Only the distinct (key, day) pairs meet the dimension, and overlapping versions resolve to the
    greatest, so the facts never multiply.
    """
    pairs = df.select(F.col(key).alias("_k"), F.col(day).cast("date").alias("_d")).distinct()
    valid = reduce(lambda a, b: a & b, [in_bounds(F.col("_d"), F.col(s), F.col(e), bounds) for s, e in ranges])
    hits = pairs.join(dim, (F.col("_k") == F.col(dim_key)) & valid)
    best = hits.groupBy("_k", "_d").agg(F.max(F.struct(*attrs)).alias("_a"))
    joined = df.join(best, (F.col(key) == F.col("_k")) & (F.col(day).cast("date") == F.col("_d")), "left")
    return joined.select(*[df[c] for c in df.columns], *[F.coalesce(F.col(f"_a.{a}"), F.lit("")).alias(a) for a in attrs])


def build_pkg_dim(medium_package: DataFrame, merchant: DataFrame, agent: DataFrame, user: DataFrame, channel_pkg: DataFrame,
                  channel_main: DataFrame, channel_pkg_conf: DataFrame) -> DataFrame:
    """The package dimension with its two validity ranges: media packages and channel packages."""
    open_start, open_end = F.lit(C.OPEN_START_DATE).cast("date"), F.lit(C.OPEN_END_DATE).cast("date")
    people = user.select(F.col("id").alias("person_id"), F.col("name").alias("head_people"))
    media = (
        medium_package.join(merchant.select("merchant_id", "merchant", "agent_id"), "merchant_id", "left")
        .join(agent.select(F.col("id").alias("agent_id"), "agent_name"), "agent_id", "left")
        .join(people, F.col("user_id") == F.col("person_id"), "left")
        .select(F.col("subpackage_id").alias("pkg_code"), F.col("agent_name").alias("promotion_channel"),
                F.col("merchant").alias("medium_account"), F.lit("").alias("promotion_mode"), "head_people",
                open_start.alias("mstart_date"), open_end.alias("mend_date"),
                open_start.alias("astart_date"), open_end.alias("aend_date"))
    )
    channels = (
        channel_pkg.join(channel_main.select(F.col("id").alias("main_id"), "main_name"), "main_id", "left")
        .join(channel_pkg_conf.select("pkg_id", "promotion", "start_time", "end_time"), F.col("id") == F.col("pkg_id"), "left")
        .join(people, F.col("manager") == F.col("person_id"), "left")
        .select("pkg_code", F.col("main_name").alias("promotion_channel"), F.lit("").alias("medium_account"),
                F.col("promotion").alias("promotion_mode"), "head_people",
                F.to_date("start_time").alias("mstart_date"), F.to_date("end_time").alias("mend_date"),
                open_start.alias("astart_date"), open_end.alias("aend_date"))
    )
    return media.unionByName(channels).distinct().orderBy("pkg_code")


def build_pkg_dim_daily(medium_package: DataFrame, merchant: DataFrame, agent: DataFrame, user: DataFrame, channel_pkg: DataFrame,
                        channel_main: DataFrame, channel_pkg_conf: DataFrame, run_day: dt.date) -> DataFrame:
    """One row per package and day around the run day.

    Owners cover days -1 to 2, the promotion mode days -1 to 1. Where media and channel sources both
    name a value, the media source wins.
    """
    media = medium_package.join(merchant.select("merchant_id", "merchant", "agent_id"), "merchant_id")
    people = user.select(F.col("id").alias("person_id"), "name")
    accounts = media.select(F.col("subpackage_id").alias("pkg_code"), F.col("merchant").alias("medium_account"))
    from_agents = media.join(agent.select(F.col("id").alias("agent_id"), "agent_name"), "agent_id").select(
        F.col("subpackage_id").alias("pkg_code"), F.col("agent_name").alias("agent_channel"))
    from_channels = channel_pkg.join(channel_main.select(F.col("id").alias("main_id"), "main_name"), "main_id").select(
        "pkg_code", F.col("main_name").alias("main_channel"))
    channel_heads = channel_pkg.join(people, F.col("manager") == F.col("person_id")).select("pkg_code", F.col("name").alias("channel_head"))
    media_heads = medium_package.join(people, F.col("user_id") == F.col("person_id")).select(
        F.col("subpackage_id").alias("pkg_code"), F.col("name").alias("media_head"))
    sources = [accounts, from_agents, from_channels, channel_heads, media_heads]
    attrs = ["medium_account", "agent_channel", "main_channel", "channel_head", "media_head"]
    # one aggregate over the union instead of a chain of full outer joins
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
    per_pkg = every.groupBy("pkg_code").agg(*[F.max(a).alias(a) for a in attrs])
    modes = channel_pkg.join(channel_pkg_conf, F.col("id") == F.col("pkg_id")).select(
        "pkg_code", "promotion", F.to_date("start_time").alias("s"), F.to_date("end_time").alias("e"))
    mode_days = modes.withColumn("day", F.explode(F.array(*[F.lit(run_day + dt.timedelta(days=i)) for i in range(-1, 2)])))
    mode_days = mode_days.filter(in_bounds(F.col("day"), F.col("s"), F.col("e"))).groupBy("pkg_code", "day").agg(
        F.max("promotion").alias("promotion_mode"))
    days = F.explode(F.sequence(F.lit(run_day - dt.timedelta(days=1)), F.lit(run_day + dt.timedelta(days=2))))
    spine = per_pkg.withColumn("day", days)
    return spine.join(mode_days, ["pkg_code", "day"], "left").select(
        "pkg_code", "day", F.coalesce("medium_account", F.lit("")).alias("medium_account"),
        F.coalesce("agent_channel", "main_channel", F.lit("")).alias("promotion_channel"),
        F.coalesce("media_head", "channel_head", F.lit("")).alias("head_people"),
        F.coalesce("promotion_mode", F.lit("")).alias("promotion_mode"))


def package_owner(pairs: DataFrame, channel_pkg: DataFrame, channel_manager: DataFrame, medium_package: DataFrame,
                  merchant: DataFrame, charge_log: DataFrame, user: DataFrame, pkg: str = "pkg_code", day: str = "day") -> DataFrame:
    """Owner per (package, day) over two effective-dated chains; the channel manager goes first."""
    on_day = lambda s, e: in_bounds(F.col("_d"), F.to_date(s), F.to_date(e), "[)")
    p = pairs.select(F.col(pkg).alias("_p"), F.col(day).cast("date").alias("_d")).distinct()
    people = user.select(F.col("id").alias("person_id"), "name")
    managers = (
        p.join(channel_pkg.select("pkg_code", "channel_id"), F.col("_p") == F.col("pkg_code"))
        .join(channel_manager.select("channel_id", "manager", "start_time", "end_time"), "channel_id")
        .filter(on_day("start_time", "end_time")).join(people, F.col("manager") == F.col("person_id"))
        .select("_p", "_d", F.lit(1).alias("rank"), "name")
    )
    chargers = (
        p.join(medium_package.select("subpackage_id", "merchant_id"), F.col("_p") == F.col("subpackage_id"))
        .join(merchant.select("merchant_id", F.col("id").alias("source_id")), "merchant_id")
        .join(charge_log.filter("family = 3").select("source_id", F.col("user_id").alias("charger"), "start_time", "end_time"), "source_id")
        .filter(on_day("start_time", "end_time")).join(people, F.col("charger") == F.col("person_id"))
        .select("_p", "_d", F.lit(2).alias("rank"), "name")
    )
    names = managers.unionByName(chargers).filter("name <> ''").groupBy("_p", "_d").agg(
        F.max(F.when(F.col("rank") == 1, F.col("name"))).alias("m"), F.max(F.when(F.col("rank") == 2, F.col("name"))).alias("c"))
    return names.select(F.col("_p").alias(pkg), F.col("_d").alias(day), F.coalesce("m", "c").alias("main_man"))
