"""Pipe-delimited log lines to typed rows.

Every parser takes a frame with a string column ``value`` and works alike on a batch and on a stream.
A line that carries the marker but breaks the layout is a reject: it is never guessed at and never
raises.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playcohort import constants as C
from playcohort.functions import channel as ch
from playcohort.functions.device import norm_account, pipe_device
from playcohort.functions.money import zero_if_null
from playcohort.functions.once import compute_once
from playcohort.functions.times import access_log_day, day_key, is_number_text, is_time_text, parse_time

Fields = Callable[[int], Column]

# --- fixed values: line markers, arguments of a landing-page hit ------------------------
REGI, LOGIN, ACTIVE, ORDER, PUBGAME, CHANNEL = (
    "bi_regi", "bi_login", "bi_active", "bi_order", "bi_pubgame", "bi_channel")
LANDING_ARGS = r"[?]p=([^&\s\"]*)&g=([0-9]+)"
NOT_FOUND = 'HTTP/1.0" 404'


@dataclass(frozen=True)
class LogKind:
    """Layout of one kind of line: marker, least number of fields, further test, output columns."""

    marker: str
    min_fields: int
    keep: Callable[[Fields], Column]
    columns: Callable[[Fields], dict[str, Column]]
    required: tuple[str, ...] = field(default=())


def _game(f: Fields, i: int) -> Column:
    return f(i).try_cast("int")


def _regi(f: Fields) -> dict[str, Column]:
    return {
        "game_account": norm_account(f(3)), "game_id": _game(f, 4), "reg_time": parse_time(f(5)),
        "os": F.lower(f(11)), "expand_channel": f(13), "imei": pipe_device(f(14)),
    }


def _login(f: Fields) -> dict[str, Column]:
    return {
        "game_account": norm_account(f(3)), "login_time": parse_time(f(4)), "channel_expand": f(6),
        "imei": pipe_device(f(7)), "game_id": _game(f, 8),
    }


def _active(f: Fields) -> dict[str, Column]:
    return {
        "game_id": _game(f, 1), "expand_channel": f(4), "active_time": parse_time(f(5)),
        "os": F.lower(f(7)), "imei": pipe_device(f(8)),
    }


def _order(f: Fields) -> dict[str, Column]:
    return {
        "order_no": F.trim(f(2)), "game_account": norm_account(f(5)), "order_time": parse_time(f(6)),
        "game_id": _game(f, 7), "ori_price": zero_if_null(f(10)), "total_amt": zero_if_null(f(13)),
        "imei": pipe_device(f(24)),
    }


def _channel_click(f: Fields) -> dict[str, Column]:
    return {
        "expand_channel": ch.clean_channel("get(_f, 2)"), "game_id": _game(f, 5),
        "publish_time": day_key(parse_time(f(4))), "type": f(1).try_cast("int"), "ip": f(3),
    }


def _login_as_regi(f: Fields) -> dict[str, Column]:
    return {
        "game_account": norm_account(f(3)), "game_id": _game(f, 4), "reg_time": parse_time(f(5)),
        "expand_channel": F.coalesce(f(13), F.lit("")), "imei": F.coalesce(f(14), F.lit("")),
    }


KINDS: dict[str, LogKind] = {
    "regi": LogKind(REGI, 15, lambda f: is_number_text(f(4)), _regi, ("game_id", "reg_time")),
    "login": LogKind(LOGIN, 9, lambda f: is_number_text(f(8)), _login, ("game_id", "login_time")),
    "active": LogKind(ACTIVE, 9, lambda f: F.length(f(5)) >= 13, _active, ("game_id", "active_time")),
    "order": LogKind(
        ORDER, 25,
        lambda f: (F.length(F.trim(f(2))) > 0) & f(22).contains(str(C.GAME_PRODUCT)) & (f(19).try_cast("int") == C.PAID),
        _order, ("game_id", "order_time")),
    "pubgame": LogKind(PUBGAME, 2, lambda f: is_number_text(f(1)), lambda f: {"game_id": _game(f, 1)}, ("game_id",)),
    "channel": LogKind(CHANNEL, 6, lambda f: is_number_text(f(1)) & is_number_text(f(5)), _channel_click,
                       ("game_id", "type", "publish_time")),
    "login_as_regi": LogKind(LOGIN, 14, lambda f: is_number_text(f(4)), _login_as_regi, ("game_id", "reg_time")),
}


def _parsed(lines: DataFrame, kind: LogKind) -> DataFrame:
    """All marked lines with the typed columns, what else the lines carry, and ``_ok``; null-safe throughout."""
    split = compute_once(lines.filter(F.col("value").contains(kind.marker)), "_f", F.split("value", r"\|", -1))
    f = lambda i: F.get("_f", F.lit(i))
    carried = [c for c in lines.columns if c != "value"]
    typed = split.select("value", *carried, (F.size("_f") >= kind.min_fields).alias("_size"), kind.keep(f).alias("_keep"),
                         *[c.alias(n) for n, c in kind.columns(f).items()])
    ok = F.col("_size") & F.coalesce("_keep", F.lit(False))
    for name in kind.required:
        ok = ok & F.col(name).isNotNull()
    return typed.withColumn("_ok", ok).drop("_size", "_keep")


def landing_line(path: str, zone: str) -> str:
    """Pattern of an access-log line that is a hit of the landing page at ``path``, logged in the given zone."""
    return rf'^.*{re.escape(zone)}\] "GET {re.escape(path)}[?]p=[\d|_|a-z|A-Z]+&g=[\d]+.*$'


def parse_log(lines: DataFrame, kind: str, landing: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of one kind: see ``KINDS``, plus ``account`` and ``request``, which needs a ``landing`` pattern."""
    if kind == "request":
        if landing is None:
            raise ValueError("request lines are recognised by a landing pattern, see landing_line")
        return _parse_request(lines, landing)
    if kind == "account":
        return _parse_account(lines)
    parsed = _parsed(lines, KINDS[kind])
    return parsed.filter("_ok").drop("_ok", "value"), parsed.filter("NOT _ok").select("value")


def _parse_request(lines: DataFrame, landing: str) -> tuple[DataFrame, DataFrame]:
    """Landing-page hits of a web access log; the client is the first forwarded address."""
    hits = lines.filter(~F.col("value").contains(NOT_FOUND) & F.col("value").rlike(landing))
    quoted = F.split("value", '"', -1)
    hits = compute_once(hits, "_h", F.struct(
        F.regexp_extract("value", LANDING_ARGS, 1).alias("p"), F.regexp_extract("value", LANDING_ARGS, 2).alias("g"),
        access_log_day(F.col("value")).alias("day")))
    typed = hits.select(
        "value",
        ch.clean_channel("_h.p").alias("expand_channel"),
        F.col("_h.g").try_cast("int").alias("game_id"),
        F.col("_h.day").alias("publish_time"),
        F.lit(4).alias("type"),
        F.trim(F.split_part(F.get(quoted, F.lit(6)), F.lit(","), F.lit(1))).alias("ip"),
    )
    ok = F.col("game_id").isNotNull() & F.col("publish_time").isNotNull() & (F.length("ip") > 0)
    typed = typed.withColumn("_ok", F.coalesce(ok, F.lit(False)))
    return typed.filter("_ok").drop("_ok", "value"), typed.filter("NOT _ok").select("value")


# --- fixed values: field positions (account, game, time, user type, owner) of account lines -----
ACCOUNT_FIELDS = {REGI: (9, 3, 4, 5, 6, 8), LOGIN: (9, 3, 8, 4, None, None), ORDER: (8, 5, 7, 6, None, None)}


def _parse_account(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Registration, login and order lines in one shape for the account master."""
    split = compute_once(lines, "_f", F.split("value", r"\|", -1)).withColumn("_head", F.get("_f", F.lit(0)))
    f = lambda i: F.lit("") if i is None else F.get("_f", F.lit(i))
    kind = F.lit(None).cast("string")
    picks = [F.lit(None).cast("string")] * 5
    enough = F.lit(False)
    for marker, (least, *positions) in ACCOUNT_FIELDS.items():
        here = F.col("_head").contains(marker)
        kind = F.when(here, F.lit(marker)).otherwise(kind)
        enough = F.when(here, F.size("_f") >= least).otherwise(enough)
        picks = [F.when(here, f(p)).otherwise(old) for p, old in zip(positions, picks)]
    typed = split.select("value", kind.alias("kind"), enough.alias("_enough"), *[
        c.alias(n) for n, c in zip(("game_account", "game_id", "event_time", "user_type", "owner_id"), picks)])
    typed = typed.filter(F.col("kind").isNotNull())
    ok = F.col("_enough") & (F.col("game_account") != "") & (F.col("game_id") != "") & is_time_text(F.col("event_time"))
    typed = typed.withColumn("_ok", F.coalesce(ok, F.lit(False))).withColumn("game_account", norm_account(F.col("game_account")))
    return typed.filter("_ok").drop("_ok", "_enough", "value"), typed.filter("NOT _ok").select("value")


def click_indicators(click_type: Column) -> dict[str, Column]:
    """One 0/1 column per landing-page click type."""
    return {name: (click_type == code).cast("int") for code, name in C.CLICK_TYPES.items()}

