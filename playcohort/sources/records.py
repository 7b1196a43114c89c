"""JSON records: ad clicks of four media, incentive-wall events, role logs, crash reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playcohort.functions.channel import game_of_pkg
from playcohort.functions.once import compute_once

# --- fixed values: per medium the marker, os codes and JSON field names -------------------


@dataclass(frozen=True)
class Medium:
    code: int
    marker: str
    android: str
    ios: str
    time: str
    callback: str
    idea: str | None = None
    first_level: str | None = None
    second_level: str | None = None
    idfa_fallback: bool = False


MEDIA_RECORDS = (
    Medium(1, "bi_adv_momo_click", "2", "1", "ts", "callback", idfa_fallback=True),
    Medium(2, "bi_adv_baidu_click", "1", "2", "ts", "callback_url", "aid", "uid", "pid"),
    Medium(3, "bi_adv_jinretoutiao_click", "0", "1", "timestamp", "callback", "adid", None, "cid"),
    Medium(4, "bi_adv_aiqiyi_click", "0", "1", "timestamp", "callback", "adid", None, "cid"),
)
CLICK_FIELDS = ("pkg_id", "os", "imei", "idfa", "ts", "timestamp", "callback", "callback_url",
                "aid", "uid", "pid", "adid", "cid")
THIRD_PARTY = "bi_thirddata"
WALL_FIELDS = ("ip", "imei", "pkg_id", "adv_name", "app_id", "game_id", "ts")
WALL_CLICK, WALL_ACTIVE = "bi_adv_money_click", "bi_adv_money_active"
ROLE_TITLE = ("gameid", "ver", "os", "lid", "roleid", "ip", "usertype", "servareaname", "userid", "gamelevel", "tid",
              "logclass", "network", "servarea", "userlevel", "imei", "rolelevel", "model", "exectime")
ROLE_CONTENT = ("roleid", "rolename", "rolelevel", "operatime", "roletype", "rolechgype", "status")
CRASH_FIELDS = ("app_versioncode", "app_versionname", "channel_number", "device_id", "imei", "model", "platform",
                "sdk_version", "signed_md_five")
CRASH_ITEM = "device_id string, _id int, isThrowable boolean, msg string, time bigint"


def _strings(names: tuple[str, ...]) -> str:
    return ", ".join(f"`{n}` string" for n in names)


def json_tail(line: Column) -> Column:
    """The text from the first brace; null when there is none."""
    at = F.instr(line, "{")
    return F.when(at > 0, F.substr(line, at))


def _read_json(lines: DataFrame, schema: str) -> DataFrame:
    """``value`` with its JSON as struct ``j``, parsed once; unreadable text gives null fields."""
    return compute_once(lines.select("value"), "j", F.from_json(json_tail(F.col("value")), schema))


def route(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(third-party lines reduced to their JSON, own lines)."""
    third = F.col("value").contains(THIRD_PARTY)
    return (lines.filter(third).select(json_tail(F.col("value")).alias("value")), lines.filter(~third))


def _medium_click(m: Medium) -> str:
    """SQL text of one medium's record as the common struct; a field it does not send is empty."""
    def field(name: str | None) -> str:
        return f"j.{name}" if name else "''"

    imei = "CASE WHEN j.imei = '' THEN j.idfa ELSE j.imei END" if m.idfa_fallback else "j.imei"
    os = f"CASE j.os WHEN '{m.android}' THEN 'android' WHEN '{m.ios}' THEN 'ios' ELSE nvl2(j.os, 'wp', NULL) END"
    return (f"named_struct('adv_name', {m.code}, 'os', {os}, 'imei', {imei}, 'seconds', {field(m.time)}, 'callback', {field(m.callback)}, "
            f"'idea_id', {field(m.idea)}, 'first_level', {field(m.first_level)}, 'second_level', {field(m.second_level)})")


def parse_ad_clicks(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clicks of the four media in one shape, rejects): a record that lacks a field its medium must send is a reject.

    The JSON is read once with the union of all fields and the medium picks its own.
    """
    read = _read_json(lines, _strings(CLICK_FIELDS))
    branches = " ".join(f"WHEN contains(value, '{m.marker}') THEN {_medium_click(m)}" for m in MEDIA_RECORDS)
    picked = read.selectExpr("value", "j.pkg_id AS pkg_id", f"CASE {branches} END AS c").selectExpr("value", "pkg_id", "c.*")
    typed = picked.withColumns({
        "game_id": game_of_pkg(F.col("pkg_id")), "ts": F.timestamp_seconds(F.col("seconds").try_cast("double").cast("long"))})
    out = ["pkg_id", "game_id", "os", "imei", "ts", "callback", "adv_name", "idea_id", "first_level", "second_level"]
    complete = " AND ".join(f"{c} IS NOT NULL" for c in out)
    return typed.filter(complete).select(*out), typed.filter(f"NOT ({complete})").select("value")


def _wall(lines: DataFrame) -> DataFrame:
    """Wall events with ``_ok``: readable JSON of a known kind with a valid time."""
    read = _read_json(lines, _strings(WALL_FIELDS)).select("value", "j.*").withColumn("ts", F.try_to_timestamp("ts", F.lit("yyyy-MM-dd HH:mm:ss")))
    return read.withColumn("_ok", F.coalesce(F.col("adv_name").isin(WALL_CLICK, WALL_ACTIVE) & F.col("ts").isNotNull(), F.lit(False)))


def parse_wall(lines: DataFrame) -> DataFrame:
    """Incentive-wall clicks and activations; see ``wall_rejects`` for the rest."""
    return _wall(lines).filter("_ok").drop("_ok", "value")


def wall_rejects(lines: DataFrame) -> DataFrame:
    """Lines that begin as JSON and give no wall event; log lines are none of the wall's."""
    return _wall(lines.filter(F.ltrim("value").startswith("{"))).filter("NOT _ok").select("value")


def parse_role(lines: DataFrame) -> DataFrame:
    """Role log: title and content side by side; the content's own ids are prefixed."""
    schema = f"title struct<{_strings(ROLE_TITLE).replace(' string', ': string')}>, content struct<{_strings(ROLE_CONTENT).replace(' string', ': string')}>"
    read = _read_json(lines, schema)
    return read.filter("j.title IS NOT NULL").select(
        "j.title.*", *[F.col(f"j.content.{n}").alias(f"content_{n}") for n in ROLE_CONTENT])


def parse_crash(lines: DataFrame) -> DataFrame:
    """Crash report: one row per message of the report."""
    schema = f"{_strings(CRASH_FIELDS)}, data array<struct<{CRASH_ITEM.replace(' ', ': ').replace(',: ', ', ')}>>"
    read = _read_json(lines, schema).filter("j.data IS NOT NULL")
    return read.select("j.*").withColumn("item", F.explode("data")).select(
        *CRASH_FIELDS, F.col("item.device_id").alias("item_device_id"), F.col("item._id").alias("item_id"),
        F.col("item.isThrowable").alias("is_throwable"), F.col("item.msg").alias("msg"),
        F.timestamp_millis("item.time").alias("time"))
