"""Entity state of the KPI streams: what an entity has done so far lives in the state store, keyed and versioned.

Each processor keeps one entity (a device key, an account) and turns its new lines into signed changes of the KPI
tables, so a micro-batch reads the state of the entities it touches and no history. A line that comes late and moves a first day
takes the old credit back and gives the new one in the same batch; a line that comes again changes nothing, because the state
knows it. Lines of any age are taken: there is no watermark, and the state of an entity stays. Device keys and accounts that
share a hash lie together under one key of the store, where ``bundles`` does in columns what the processor of one entity says (``in_columns``).

A change is ``name, at, game_id, channel parts, m``: the table, its unit of time (or registration day), the keys and the
measures in the order of ``MEASURES``.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import MapState

from playcohort import constants as C
from playcohort.functions import channel as ch
from playcohort.functions.money import cents
from playcohort.functions.times import SECOND, hour_key
from playcohort.operators.kpi import WALL_FLAGS
from playcohort.sources import records
from playcohort.sources.logs import parse_log
from playcohort.streaming import bundles
from playcohort.streaming.bundles import Bundle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGE = "name string, at string, game_id int, parent_channel string, child_channel string, pkg_code string, m array<bigint>"
REGISTERED = ("regi_accounts", "new_regi_accounts", "regi_devices", "new_regi_devices")
#: Measures of each table; ``_opera`` tables have no channels.
MEASURES = {
    "registration": REGISTERED, "registration_hour": REGISTERED, "registration_opera": REGISTERED, "registration_opera_hour": REGISTERED,
    "activation": ("active_num",), "activation_opera": ("active_num",),
    "money": ("pay_money",), "money_hour": ("pay_money",), "payer": ("pay_accounts",), "payer_hour": ("pay_accounts",),
    "first_payer": ("recharge_accounts",), "ltv": ("recharge", *[f"ltv_{n}day" for n in C.PAY_LTV]),
    "wall_opera": ("click_num", "click_dev_num", *WALL_FLAGS),
}
#: Columns that name ``at`` in a report: the unit of time, or the payer's registration day and game.
AT = {name: "hour" if name.endswith("_hour") or name.startswith("activation") else "reg_date" if name in ("first_payer", "ltv") else "day" for name in MEASURES}
#: The query of ``pipelines.KpiPipeline`` that writes a table's changes.
QUERY_OF = {name: name.split("_")[0] if name.startswith(("regi", "activ", "wall")) else "payment" for name in MEASURES}
Place = tuple  # name, at, game_id, parent_channel, child_channel, pkg_code


def use_state_store(spark: SparkSession) -> None:
    """Keep state outside the heap, as the processors of this module need it."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


def _changes(before: dict[Place, list[int]], after: dict[Place, list[int]]) -> Iterator[Row]:
    for place in before.keys() | after.keys():
        old, new = before.get(place), after.get(place)
        size = len(new or old)
        moved = [(new or [0] * size)[i] - (old or [0] * size)[i] for i in range(size)]
        if any(moved):
            yield Row(name=place[0], at=place[1], game_id=place[2], parent_channel=place[3], child_channel=place[4], pkg_code=place[5], m=moved)


def _month(kept: MapState, month: str) -> dict:
    """What an entity's state holds of a month; every read or write of state is a call to the JVM, so a month is one value."""
    value = kept.getValue((month,))
    return json.loads(value[0]) if value is not None else {}


#: Bundles of a query's entities. A batch makes a few calls per bundle at most, and reads and writes the bundles it touches; few bundles make long columns.
BUNDLES = 256


class Registrations(StatefulProcessor):
    """A device key: its first day, its accounts per day and hour. An account of an hour arrives once."""

    in_columns = staticmethod(bundles.registrations)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", "day string")
        self.months = handle.getMapState("months", "month string", "hours string")

    def _month(self, month: str) -> dict[str, list[int]]:
        """Accounts per hour of the month's days; kept as day, hour and number where there are any."""
        kept = self.months.getValue((month,))
        days: dict[str, list[int]] = {}
        for day, hour, n in json.loads(kept[0]) if kept is not None else []:
            days.setdefault(f"{month}-{day:02d}", [0] * 24)[hour] = n
        return days

    def _facts(self, key: tuple, days: dict[str, list[int]], first: str | None) -> dict[Place, list[int]]:
        name, place = ("registration_opera" if key[0] == "opera" else "registration"), key[1:5]
        out = {}
        for day, hours in days.items():
            new = int(day == first)
            if any(hours):
                out[(name, day, *place)] = [sum(hours), new * sum(hours), 1, new]
            for hour, n in enumerate(hours):
                if n:
                    out[(f"{name}_hour", f"{day} {hour:02d}", *place)] = [n, new * n, 1, new]
        return out

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        added: dict[str, list[int]] = {}
        for r in rows:
            added.setdefault(r.hour[:10], [0] * 24)[int(r.hour[11:])] += 1
        held = self.first.get()
        old = held[0] if held is not None else None
        first = min([*added, *([old] if old else [])])
        days = {*added, first, *([old] if old else [])} if first != old else {*added}
        months = {month: self._month(month) for month in {day[:7] for day in days}}
        touched = {day: months[day[:7]].get(day, [0] * 24) for day in days}
        now = {day: [a + b for a, b in zip(hours, added.get(day, [0] * 24), strict=True)] for day, hours in touched.items()}
        yield from _changes(self._facts(key, touched, old), self._facts(key, now, first))
        for month in {day[:7] for day in added}:
            kept = months[month] | {day: now[day] for day in added if day[:7] == month}
            hours = [(int(day[8:]), hour, n) for day, of in kept.items() for hour, n in enumerate(of) if n]
            self.months.updateValue((month,), (json.dumps(hours, separators=(",", ":")),))
        if first != old:
            self.first.update((first,))

    def close(self) -> None:
        pass


class Activations(StatefulProcessor):
    """A device key: the hour of its earliest activation."""

    in_columns = staticmethod(bundles.activations)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", "hour string")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        hour = min(r.hour for r in rows)
        held = self.first.get()
        old = held[0] if held is not None else None
        if old is None or hour < old:
            place = ("activation_opera" if key[0] == "opera" else "activation", key[1:5])
            yield from _changes({(place[0], old, *place[1]): [1]} if old else {}, {(place[0], hour, *place[1]): [1]})
            self.first.update((hour,))

    def close(self) -> None:
        pass


class Payments(StatefulProcessor):
    """An account: its first registration, whether it has paid, and what it paid per game and hour. An order arrives once.

    Before a registration is known the money stands under the channel of unknown accounts; the registration, or an
    earlier one, moves all of it.
    """

    in_columns = staticmethod(bundles.payments)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.account = handle.getValueState("account", "reg_time string, game_id int, parent_channel string, child_channel string, pkg_code string, paid int")
        self.months = handle.getMapState("months", "month string", "games string")

    @staticmethod
    def _facts(owner: tuple | None, days: dict[tuple[int, str], dict[int, list[int]]], payer: bool) -> dict[Place, list[int]]:
        """``days`` hold money, price and number of orders per hour of a game's day."""
        channel = tuple(owner[2:5]) if owner else (C.UNKNOWN_ACCOUNT_CHANNEL, "", "")
        start, game = (date.fromisoformat(owner[0][:10]), owner[1]) if owner else (None, 0)
        home = (start.isoformat() if start else None, game, None, None, None)
        out: dict[Place, list[int]] = defaultdict(lambda: [0] * (1 + len(C.PAY_LTV)))
        if payer:
            out[("first_payer", *home)] = [1]
        for (paid_in, day), hours in days.items():
            if not hours:
                continue
            out[("money", day, paid_in, *channel)] = [sum(money for money, _, _ in hours.values())]
            out[("payer", day, paid_in, *channel)] = [1]
            for hour, (money, _, _) in hours.items():
                out[("money_hour", f"{day} {hour:02d}", paid_in, *channel)] = [money]
                out[("payer_hour", f"{day} {hour:02d}", paid_in, *channel)] = [1]
            offset = (date.fromisoformat(day) - start).days if start else None
            total = sum(price for _, price, _ in hours.values())
            value = [total, *[total if offset is not None and (offset == 0 if n == 1 else offset <= n - 1) else 0 for n in C.PAY_LTV]]
            out[("ltv", *home)] = [a + b for a, b in zip(out[("ltv", *home)], value, strict=True)]
        return out

    @staticmethod
    def _packed(days: dict[tuple[int, str], dict[int, list[int]]]) -> str:
        """Game, day of the month, hour and sums of what was paid in a month."""
        return json.dumps([[game, int(day[8:]), hour, *sums] for (game, day), hours in days.items() for hour, sums in hours.items()], separators=(",", ":"))

    @staticmethod
    def _unpacked(month: str, games: str) -> dict[tuple[int, str], dict[int, list[int]]]:
        out: dict[tuple[int, str], dict[int, list[int]]] = defaultdict(dict)
        for game, day, hour, *sums in json.loads(games):
            out[game, f"{month}-{day:02d}"][hour] = sums
        return out

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.account.get()
        old = tuple(held[:5]) if held is not None and held[0] is not None else None
        paid = held is not None and bool(held[5])
        owner, added = old, {}
        for r in rows:
            if r.order_no is None:
                mine = (r.time, r.game_id, r.parent_channel, r.child_channel, r.pkg_code)
                owner = mine if owner is None else min(owner, mine)
            else:
                sums = added.setdefault((r.game_id, r.time[:10]), {}).setdefault(int(r.time[11:13]), [0, 0, 0])
                for i, n in enumerate((r.money, r.price, 1)):
                    sums[i] += n
        if not added and owner == old:
            return
        if owner == old:
            months = {month: self.months.getValue((month,)) for month in {day[:7] for _, day in added}}
        else:
            months = {tuple(month)[0]: games for month, games in self.months.iterator()} if paid else {}
        touched = {place: hours for month, games in months.items() if games is not None for place, hours in self._unpacked(month, games[0]).items()}
        now = dict(touched)
        for place, more in added.items():
            before = touched.get(place, {})
            now[place] = before | {hour: [a + b for a, b in zip(before.get(hour, [0, 0, 0]), sums, strict=True)] for hour, sums in more.items()}
        for month in {day[:7] for _, day in added}:
            self.months.updateValue((month,), (self._packed({place: hours for place, hours in now.items() if place[1][:7] == month}),))
        yield from _changes(self._facts(old, touched, paid), self._facts(owner, now, paid or bool(added)))
        if owner != old or not paid:
            self.account.update((*(owner or [None] * 5), int(paid or bool(added))))

    def close(self) -> None:
        pass


class WallDevices(StatefulProcessor):
    """A device of the incentive wall: its first click and first activation of each day, and the days of its own activations and registrations.

    What a wall activation counts for follows from days alone, so a device holds an entry per day and game and kind, however many lines it sends.
    A line that makes a day earlier, or an earlier first event of a day, changes the flags of the activations it bears on only.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.clicks = handle.getMapState("clicks", "month string", "days string")
        self.acts = handle.getMapState("acts", "month string", "days string")

    @staticmethod
    def _facts(named: bool, clicks: dict[str, tuple], actives: dict[str, tuple], own: set[tuple[str, str, int | None]]) -> dict[Place, list[int]]:
        """Flags of a device's days; a device without a name meets no history, as in a join on its name."""
        first: dict[tuple[str, int], str] = {}
        for day, kind, game in [*own, *((day, "wall", game) for day, (_, game) in actives.items())] if named else []:
            first[kind, game] = min(day, first.get((kind, game), day))
        active_days = {day for day, kind, _ in own if kind == "active"} if named else set()
        out: dict[Place, list[int]] = defaultdict(lambda: [0] * len(MEASURES["wall_opera"]))
        for day, (_, game) in clicks.items():
            out["wall_opera", day, game, None, None, None][1] = 1
        for day, (_, game) in actives.items():
            platform, wall, registered = (first.get((kind, game)) for kind in ("active", "wall", "regi"))
            out["wall_opera", day, game, None, None, None][2:] = map(int, (
                True, platform is not None and platform < day, wall is not None and wall < day, day in active_days, platform is None or platform > day,
                named and (day, "regi", game) in own, registered is None or registered >= day))
        return out

    @staticmethod
    def _first(rows: Iterator[Row]) -> tuple[dict[str, dict[str, tuple]], set, dict[tuple, int]]:
        """First click and wall activation of each day, the days of the own log, the number of clicks."""
        first: dict[str, dict[str, tuple]] = {"click": {}, "wall": {}}
        own, number = set(), defaultdict(int)
        for r in rows:
            at, kind, game = r.at, r.kind, r.game_id
            day = at[:10]
            if kind in first:
                mine, of = (at, game), first[kind]
                if day not in of or mine < of[day]:
                    of[day] = mine
                if kind == "click":
                    number[day, game] += 1
            else:
                own.add((day, kind, game))
        return first, own, number

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first, added, number = self._first(rows)
        for (day, game), n in number.items():
            yield Row(name="wall_opera", at=day, game_id=game, parent_channel=None, child_channel=None, pkg_code=None, m=[n, *[0] * (len(MEASURES["wall_opera"]) - 1)])
        held = {month: _month(self.clicks, month) for month in {day[:7] for day in first["click"]}}
        earlier = {day: tuple(mine) for days in held.values() for day, mine in days.items()}
        new = {day: mine for day, mine in first["click"].items() if day not in earlier or mine < earlier[day]}
        clicks = {day: earlier[day] for day in new if day in earlier}, new
        for month in {day[:7] for day in new}:
            self.clicks.updateValue((month,), (json.dumps(held[month] | {day: mine for day, mine in new.items() if day[:7] == month}),))
        actives, own = ({}, {}), (set(), set())
        if first["wall"] or added:
            months = {tuple(month)[0]: json.loads(days[0]) for month, days in self.acts.iterator()}
            before = {day: tuple(mine) for month in months.values() for day, mine in month["wall"].items()}
            known = {tuple(d) for month in months.values() for d in month["own"]}
            new, fresh = {day: mine for day, mine in first["wall"].items() if day not in before or mine < before[day]}, added - known
            if new or fresh:
                actives, own = (before, before | new), (known, known | fresh)
                for month in {day[:7] for day in new} | {d[0][:7] for d in fresh}:
                    of = lambda day, month=month: day[:7] == month
                    kept = {"wall": {day: mine for day, mine in actives[1].items() if of(day)}, "own": [d for d in own[1] if of(d[0])]}
                    self.acts.updateValue((month,), (json.dumps(kept),))
        yield from _changes(*(self._facts(key[0] is not None, *state) for state in zip(clicks, actives, own, strict=True)))

    def close(self) -> None:
        pass


def _grains(rows: DataFrame) -> DataFrame:
    """Each row at the marketing grain and, without channels, at that of operations."""
    opera = [F.lit("").alias(c) for c in ch.CHANNEL_COLS]
    rest = [c for c in rows.columns if c not in ch.CHANNEL_COLS]
    both = F.array(*[F.struct(F.lit(name).alias("grain"), *cols) for name, cols in (("market", [F.col(c) for c in ch.CHANNEL_COLS]), ("opera", opera))])
    return rows.select(*rest, F.explode(both).alias("_g")).select(*rest, "_g.*")


DEVICE = ("grain", "game_id", *ch.CHANNEL_COLS, "imei")


def _bundled(rows: DataFrame, keys: Sequence[str], one: StatefulProcessor) -> DataFrame:
    """The changes ``one`` finds for the entities of ``rows``, in bundles."""
    bundle = F.pmod(F.xxhash64(*keys), F.lit(BUNDLES)).cast("int")
    return rows.withColumn("bundle", bundle).groupBy("bundle").transformWithStateInPandas(Bundle(one, keys), CHANGE, "Append", "None")


def registration_changes(lines: DataFrame) -> DataFrame:
    """Signed changes of the registration tables from a stream of log lines."""
    rows = ch.with_channel_parts(parse_log(lines, "regi")[0], "expand_channel").filter("game_account <> ''")
    rows = _grains(rows.select("game_id", *ch.CHANNEL_COLS, "imei", "game_account", hour_key(F.col("reg_time")).alias("hour")))
    return _bundled(rows.dropDuplicates(), DEVICE, Registrations())


def activation_changes(lines: DataFrame) -> DataFrame:
    """Signed changes of the activation tables from a stream of log lines."""
    rows = ch.with_channel_parts(parse_log(lines, "active")[0], "expand_channel")
    rows = _grains(rows.select("game_id", *ch.CHANNEL_COLS, "imei", hour_key(F.col("active_time")).alias("hour")))
    return _bundled(rows, DEVICE, Activations())


def payment_changes(lines: DataFrame) -> DataFrame:
    """Signed changes of the payment tables from a stream of log lines."""
    regi = ch.with_channel_parts(parse_log(lines, "regi")[0], "expand_channel")
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    regi = regi.select("game_account", F.date_format("reg_time", SECOND).alias("time"), "game_id", *ch.CHANNEL_COLS, none("string", "order_no"), *[F.lit(0).cast("bigint").alias(c) for c in ("money", "price")])
    orders = parse_log(lines, "order")[0]
    orders = orders.select("game_account", F.date_format("order_time", SECOND).alias("time"), "game_id", *[none("string", c) for c in ch.CHANNEL_COLS], "order_no",
                           cents(F.col("ori_price") + F.col("total_amt")).alias("money"), cents(F.col("ori_price")).alias("price")).dropDuplicates(["game_account", "order_no", "time"])
    return _bundled(regi.unionByName(orders), ["game_account"], Payments())


def wall_changes(lines: DataFrame) -> DataFrame:
    """Signed changes of the incentive-wall table from a stream of wall events and log lines."""
    def rows(df: DataFrame, kind: Column, time: str) -> DataFrame:
        return df.select("imei", F.col("game_id").try_cast("int").alias("game_id"), kind.alias("kind"), F.date_format(time, SECOND).alias("at"))

    wall = rows(records.parse_wall(lines), F.when(F.col("adv_name") == records.WALL_CLICK, "click").otherwise("wall"), "ts").filter("game_id IS NOT NULL")
    own = [rows(parse_log(lines, kind)[0], F.lit(kind), time) for kind, time in (("active", "active_time"), ("regi", "reg_time"))]
    return wall.unionByName(own[0]).unionByName(own[1]).groupBy("imei").transformWithState(WallDevices(), CHANGE, "Append", "None")


def report(changes: DataFrame, name: str) -> DataFrame:
    """The current table ``name``: all its changes added up; keys everything was taken back from are gone."""
    at, measures = AT[name], MEASURES[name]
    when: Column = F.to_date("at").alias(at) if at == "reg_date" else F.col("at").alias(at)
    game = F.col("game_id").alias("reg_game_id" if at == "reg_date" else "game_id")
    channels = [] if at == "reg_date" or "_opera" in name else [F.col(c) for c in ch.CHANNEL_COLS]
    sums = changes.filter(F.col("name") == name).groupBy(when, game, *channels).agg(*[F.sum(F.get("m", F.lit(i))).alias(c) for i, c in enumerate(measures)])
    return sums.filter(" OR ".join(f"{c} <> 0" for c in measures))
