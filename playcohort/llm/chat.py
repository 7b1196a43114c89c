"""Chat formatting with loss masks (operator 10), in SQL functions only.

A declarative template says how the turns of a role are marked and whether their text is trained on. A
finite-state machine over the roles, folded over the turns, validates their order. The output is a list of text
segments, each with its loss flag; joined, they are the formatted conversation, which ``read_back`` parses into
the same turns again: control strings contain ``#`` or ``<``, and texts have every ``\\``, ``#`` and ``<`` replaced
by a two-character code, so no text can end its turn or begin another.

Edge cases: a null text is empty and a null role is the empty role; a role the template does not know is
marked by its own name (or, if that is the shown name of a key, by the key, which is never shown itself),
carries no loss and makes the conversation invalid; turns are ordered by number, null
first, then role and text, and repeated rows are turns each; rows with a null ``conv_id`` are one
conversation; an empty table gives an empty result; further columns are ignored. A conversation is one row of
the output, so its turns meet in one task, as the digest of its whole text needs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """How turns are written. ``after`` gives, per state, the roles that may come next; ``""`` is the start."""

    names: tuple[tuple[str, str], ...] = (("system", "System"), ("user", "User"), ("assistant", "Assistant"))
    opening: str = "### "
    after_name: str = ": "
    closing: str = "</turn>\n"
    trained: tuple[str, ...] = ("assistant",)
    after: tuple[tuple[str, tuple[str, ...]], ...] = (("", ("system", "user")), ("system", ("user",)), ("user", ("assistant",)), ("assistant", ("user",)))


#: Code of each character that a control string may contain, the escape character first.
CODES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))
#: In names the separator's colon is coded as well.
NAME_CODES = (*CODES, (":", "\\c"))


def escape(text: Column, codes: tuple[tuple[str, str], ...] = CODES) -> Column:
    for plain, code in codes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, codes: tuple[tuple[str, str], ...] = CODES) -> Column:
    for plain, code in reversed(codes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _swaps(template: Template) -> list[tuple[str, str]]:
    """Unknown roles that equal a shown name, each with the key, shown by another name, that is written for it."""
    keys = {name: key for key, name in template.names}
    swaps = []
    for role in keys.keys() - dict(template.names).keys():
        free = keys[role]
        while free in keys:
            free = keys[free]
        swaps.append((role, free))
    return swaps


def _name(role: Column, template: Template) -> Column:
    named = escape(role, NAME_CODES)
    for unknown, free in _swaps(template):
        named = F.when(role == unknown, escape(F.lit(free), NAME_CODES)).otherwise(named)
    for key, name in template.names:
        named = F.when(role == key, F.lit(name)).otherwise(named)
    return named


def _role(name: Column, template: Template) -> Column:
    role = unescape(name, NAME_CODES)
    for unknown, free in _swaps(template):
        role = F.when(name == escape(F.lit(free), NAME_CODES), F.lit(unknown)).otherwise(role)
    for key, shown in template.names:
        role = F.when(name == shown, F.lit(key)).otherwise(role)
    return role


def _first_error(turns: Column, template: Template) -> Column:
    """The number, from 0, of the first turn the state machine does not allow; null if it accepts all."""
    none = F.lit(None).cast("int")

    def step(s: Column, turn: Column) -> Column:
        allowed = F.lit(False)
        for state, roles in template.after:
            allowed = F.when(s["state"] == state, turn["role"].isin(*roles)).otherwise(allowed)
        return F.struct(turn["role"].alias("state"), (s["at"] + 1).alias("at"), F.coalesce(s["error"], F.when(~allowed, s["at"])).alias("error"))

    return F.aggregate(turns, F.struct(F.lit("").alias("state"), F.lit(0).alias("at"), none.alias("error")), step)["error"]


def format_conversations(rows: DataFrame, template: Template = Template()) -> DataFrame:
    """``conv_id, segments, formatted, valid, first_error`` from ``conv_id, turn, role, text``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    turns = rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.array_sort(F.collect_list(F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")))).alias("turns"))
    opening = lambda t: F.concat(F.lit(template.opening), _name(t["role"], template), F.lit(template.after_name))
    segment = lambda value, loss: F.struct(value.alias("text"), loss.alias("loss"))
    segments = F.flatten(
        F.transform(
            "turns",
            lambda t: F.array(
                segment(opening(t), F.lit(False)), segment(escape(t["text"]), t["role"].isin(*template.trained)), segment(F.lit(template.closing), F.lit(False))
            ),
        )
    )
    error = _first_error(F.col("turns"), template)
    out = turns.select("conv_id", segments.alias("segments"), error.alias("first_error"))
    return out.select("conv_id", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), F.col("first_error").isNull().alias("valid"), "first_error")


def read_back(formatted: Column, template: Template = Template()) -> Column:
    """The turns, ``array<struct<role, text>>``, of a formatted conversation."""
    parts = F.filter(F.split(formatted, r"\Q" + template.closing + r"\E"), lambda p: p != "")

    def turn(part: Column) -> Column:
        body = F.substring(part, F.lit(len(template.opening) + 1), F.length(part))
        cut = F.instr(body, template.after_name)
        name = F.substring(body, F.lit(1), cut - 1)
        text = F.substring(body, cut + len(template.after_name), F.length(body))
        return F.struct(_role(name, template).alias("role"), unescape(text).alias("text"))

    return F.transform(parts, turn)


def loss_text(segments: Column) -> Column:
    """The texts under the loss mask, unescaped and joined."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
