"""Raw log lines made by Spark from every event, with broken ones mixed in for the parsers to reject."""

from __future__ import annotations

from pyspark.sql import DataFrame

from playcohort.sources.logs import landing_line

LANDING = landing_line("/landing/loaded", "0800")
STAMP = "'2024-01-01 10:00:00,001 [INFO] bi: '"
TIME = "CASE WHEN event_id % 31 = 0 THEN 'bad time' ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END"
GAME = "CASE WHEN event_id % 23 = 0 THEN 'x' ELSE cast(game_id AS string) END"
CHANNEL = "coalesce(channel, '')"
# the same conditions for the SQL side
BAD_GAME, BAD_TIME, CUT = "event_id % 23 = 0", "event_id % 31 = 0", "event_id % 37 = 0"
GOOD = "event_id % 23 <> 0 AND event_id % 31 <> 0 AND event_id % 37 <> 0"


def _line(*fields: str) -> str:
    """Fields joined by pipes; every 37th line is cut after its second field."""
    return f"CASE WHEN event_id % 37 = 0 THEN concat_ws('|', {fields[0]}, {fields[1]}) ELSE concat_ws('|', {', '.join(fields)}) END AS value"


def regi_lines(ev: DataFrame) -> DataFrame:
    return ev.filter("event_type = 'signup'").selectExpr(_line(
        f"{STAMP} || 'bi_regi'", "'r' || event_id", "'-'", "' U' || u || ' '", GAME, TIME, "'8'", "'-'", "cast(u % 40 AS string)", "'-'", "'-'",
        "upper(os)", "'-'", CHANNEL, "imei"))


def login_lines(ev: DataFrame) -> DataFrame:
    return ev.filter("event_type = 'view'").selectExpr(_line(
        f"{STAMP} || 'bi_login'", "'l' || event_id", "'-'", "'U' || u", TIME, "'-'", CHANNEL, "imei", GAME))


def active_lines(ev: DataFrame) -> DataFrame:
    return ev.filter("event_type = 'error'").selectExpr(_line(
        f"{STAMP} || 'bi_active'", GAME, "'-'", "'-'", CHANNEL, TIME, "'-'", "upper(os)", "imei"))


def order_lines(ev: DataFrame) -> DataFrame:
    """Every sixth order twice; statuses 4 and 8, product types 5 and 6, some totals missing."""
    filler = ["'-'"] * 25
    filler[0], filler[1], filler[2] = f"{STAMP} || 'bi_order'", "'-'", "'o' || event_id"
    filler[5], filler[6], filler[7], filler[10] = "'U' || u", TIME, GAME, "cast(amount AS string)"
    filler[13] = "CASE WHEN event_id % 4 = 0 THEN '' ELSE cast(event_id % 3 AS string) END"
    filler[19] = "CASE WHEN event_id % 10 = 0 THEN '8' WHEN event_id % 10 = 1 THEN '45' ELSE '4' END"
    filler[22], filler[24] = "CASE WHEN event_id % 7 = 0 THEN '5' ELSE '6' END", "imei"
    lines = ev.filter("event_type = 'purchase'").selectExpr("event_id", _line(*filler))
    return lines.unionByName(lines.filter("event_id % 6 = 0")).select("value")


def pubgame_lines(nation: DataFrame) -> DataFrame:
    return nation.selectExpr(f"concat_ws('|', {STAMP} || 'bi_pubgame', CASE WHEN n_nationkey % 9 = 0 THEN 'x' ELSE cast(n_nationkey AS string) END, '-') AS value")


def channel_lines(ev: DataFrame) -> DataFrame:
    return ev.filter("event_type = 'click'").selectExpr(_line(
        f"{STAMP} || 'bi_channel'", "cast(event_id % 4 + 1 AS string)", CHANNEL, "'10.0.0.' || (u % 50)", TIME, GAME, "'-'"))


def request_lines(ev: DataFrame) -> DataFrame:
    """Web access lines; every 11th is a 404, every 13th another page, every 17th lacks its game."""
    return ev.filter("event_type = 'click'").selectExpr(
        "'10.9.9.9 - - [' || date_format(ts, 'dd/MMM/yyyy:HH:mm:ss') || ' +0800] \"GET ' || "
        "CASE WHEN event_id % 13 = 0 THEN '/other' ELSE '/landing/loaded?p=m' || (u % 3) || '_s' || (u % 5) || '_p' || (u % 11) || '&g=' || "
        "CASE WHEN event_id % 17 = 0 THEN '' ELSE cast(game_id AS string) END END || "
        "CASE WHEN event_id % 11 = 0 THEN ' HTTP/1.0\" 404' ELSE ' HTTP/1.1\" 200' END || ' 5 \"-\" \"agent\" 10.0.0.' || (u % 50) || ', 10.9.9.9' AS value")


def ad_click_lines(clicks: DataFrame) -> DataFrame:
    """JSON clicks of four media, each with its own names and os codes; every 19th lacks its callback."""
    seconds = "cast(unix_timestamp(ts) AS string)"
    pick = "element_at(map({0}), adv_name)"
    marker = pick.format("1, 'bi_adv_momo_click', 2, 'bi_adv_baidu_click', 3, 'bi_adv_jinretoutiao_click', 4, 'bi_adv_aiqiyi_click'")
    android = pick.format("1, '2', 2, '1', 3, '0', 4, '0'")
    ios = pick.format("1, '1', 2, '2', 3, '1', 4, '1'")
    only = lambda media, text: f"CASE WHEN adv_name IN {media} THEN {text} END"
    fields = {
        "pkg_id": "pkg_id", "os": f"CASE WHEN os = 'android' THEN {android} ELSE {ios} END",
        "imei": "CASE WHEN adv_name = 1 AND os = 'ios' THEN '' ELSE imei END", "idfa": only("(1)", "CASE WHEN os = 'ios' THEN imei ELSE '' END"),
        "ts": only("(1, 2)", seconds), "timestamp": only("(3, 4)", seconds),
        "callback": "CASE WHEN adv_name <> 2 AND event_id % 19 <> 0 THEN callback END",
        "callback_url": "CASE WHEN adv_name = 2 AND event_id % 19 <> 0 THEN callback END",
        "aid": only("(2)", "idea_id"), "uid": only("(2)", "first_level"), "pid": only("(2)", "second_level"),
        "adid": only("(3, 4)", "idea_id"), "cid": only("(3, 4)", "second_level"), "adv_name": marker,
    }
    struct = ", ".join(f"'{k}', {v}" for k, v in fields.items())
    return clicks.selectExpr(f"'bi_thirddata ' || to_json(named_struct({struct})) AS value")


def wall_lines(ev: DataFrame) -> DataFrame:
    """Incentive-wall JSON; every 21st line is cut short."""
    struct = ("named_struct('game_id', cast(game_id AS string), 'app_id', '9', 'pkg_id', pkg, 'imei', imei, 'ip', '10.0.0.' || (u % 50), "
              "'ts', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), 'adv_name', CASE WHEN event_type = 'click' THEN 'bi_adv_money_click' ELSE 'bi_adv_money_active' END)")
    return ev.filter("event_type IN ('click', 'view')").selectExpr(
        f"CASE WHEN event_id % 21 = 0 THEN '{{\"game_id\":' ELSE to_json({struct}) END AS value")


def role_lines(ev: DataFrame) -> DataFrame:
    return ev.filter("event_type = 'view'").selectExpr(
        "to_json(named_struct('title', named_struct('gameid', cast(game_id AS string), 'userid', 'u' || u, 'imei', imei, 'exectime', date_format(ts, 'yyyy-MM-dd HH:mm:ss')), "
        "'content', named_struct('roleid', cast(event_id AS string), 'rolename', 'role' || u, 'rolelevel', cast(event_id % 60 AS string)))) AS value")


def crash_lines(ev: DataFrame) -> DataFrame:
    """One report per error with one to three messages."""
    item = "named_struct('device_id', imei, '_id', cast(i AS int), 'isThrowable', i % 2 = 0, 'msg', 'm' || i, 'time', unix_millis(ts))"
    return ev.filter("event_type = 'error'").selectExpr(
        f"to_json(named_struct('device_id', imei, 'platform', os, 'app_versioncode', cast(game_id AS string), 'data', transform(sequence(1L, event_id % 3 + 1), i -> {item}))) AS value")
