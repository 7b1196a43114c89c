"""Calls a stateful operator makes to the state of one key: their number must not grow with the key's rows."""

import datetime as dt

from pyspark.sql import Row
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from playcohort.streaming import state, touches

DAY = 86_400_000


class Handle:
    """State of one key in memory; counts what would go to the JVM and back."""

    def __init__(self):
        self.calls, self.timers = 0, set()

    def getValueState(self, name, schema):  # noqa: N802
        return Value(self)

    def getMapState(self, name, key, value):  # noqa: N802
        return Map(self)

    def getListState(self, name, schema):  # noqa: N802
        return List(self)

    def registerTimer(self, at):  # noqa: N802
        self.calls += 1
        self.timers.add(at)


class Value:
    def __init__(self, handle):
        self.handle, self.held = handle, None

    def get(self):
        self.handle.calls += 1
        return self.held

    def exists(self):
        self.handle.calls += 1
        return self.held is not None

    def update(self, held):
        self.handle.calls += 1
        self.held = held

    def clear(self):
        self.update(None)


class List(Value):
    def get(self):
        return iter(super().get() or [])

    def put(self, rows):
        self.update(list(rows))

    def appendValue(self, row):  # noqa: N802
        self.update([*(self.held or []), row])

    def appendList(self, rows):  # noqa: N802
        self.update([*(self.held or []), *rows])


class Map(Value):
    def __init__(self, handle):
        super().__init__(handle)
        self.held = {}

    def getValue(self, key):  # noqa: N802
        return self.get().get(key)

    def containsKey(self, key):  # noqa: N802
        return key in self.get()

    def updateValue(self, key, value):  # noqa: N802
        self.update(self.held | {key: value})

    def exists(self):
        return bool(self.get())

    def iterator(self):
        return iter(list(self.get().items()))

    def keys(self):
        return iter(list(self.get()))


class Times:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.at

    def getExpiryTimeInMs(self):  # noqa: N802
        return self.at


def fed(processor, key, *batches):
    """The rows that come out and the calls of each batch."""
    handle = Handle()
    processor.init(handle)
    out, calls = [], []
    for rows in batches:
        before = handle.calls
        out += processor.handleInputRows(key, iter(rows), None)
        calls.append(handle.calls - before)
    return out, calls


def added_up(changes):
    sums = {}
    for r in changes:
        place = tuple(r)[:-1]
        sums[place] = [a + b for a, b in zip(sums.get(place, [0] * len(r.m)), r.m, strict=True)]
    return {place: m for place, m in sums.items() if any(m)}


def hours(first, n):
    start = dt.datetime(2024, 1, first)
    return [(start + dt.timedelta(hours=5 * i)).strftime("%Y-%m-%d %H:%M:%S") for i in range(n)]


def test_registrations_call_once_per_month():
    rows = [Row(hour=at[:13], game_account=f"a{i}") for i, at in enumerate(hours(3, 100))]
    out, calls = fed(state.Registrations(), ("opera", 1, "", "", "", "d"), rows[50:], rows[:50])
    assert max(calls) <= 4
    got = added_up(out)
    assert got["registration_opera", "2024-01-03", 1, "", "", ""] == [5, 5, 1, 1]
    assert sum(m[0] for place, m in got.items() if place[0] == "registration_opera") == 100
    # the second batch takes the first day back from the first one's
    assert sum(m[3] for place, m in got.items() if place[0] == "registration_opera") == 1


def test_payments_call_once_per_month():
    order = lambda i, at: Row(time=at, game_id=i % 3, parent_channel=None, child_channel=None, pkg_code=None, order_no=f"o{i}", money=3, price=2)
    rows = [order(i, at) for i, at in enumerate(hours(3, 100))]
    regi = Row(time="2024-01-02 10:00:00", game_id=7, parent_channel="m", child_channel="s", pkg_code="p", order_no=None, money=None, price=None)
    out, calls = fed(state.Payments(), ("acc",), rows[:60], [*rows[60:], regi])
    assert max(calls) <= 4
    got = added_up(out)
    assert {place[3] for place in got if place[0] == "money"} == {"m"}
    assert sum(m[0] for place, m in got.items() if place[0] == "money") == 300 == sum(m[0] for place, m in got.items() if place[0] == "money_hour")
    assert got["ltv", "2024-01-02", 7, None, None, None][0] == 200 and got["first_payer", "2024-01-02", 7, None, None, None] == [1]


def test_wall_devices_call_once_per_month():
    rows = [Row(kind=kind, at=at, game_id=i % 3) for i, at in enumerate(hours(3, 60)) for kind in ("click", "wall", "active", "regi")]
    out, calls = fed(state.WallDevices(), ("d",), rows[120:], rows[:120])
    assert max(calls) <= 4
    got = added_up(out)
    assert sum(m[0] for m in got.values()) == 60  # clicks
    assert sum(m[1] for m in got.values()) == 13 == sum(m[2] for m in got.values())  # days with a click, with a wall activation


def test_touches_settle_all_rows_the_watermark_has_passed_at_once():
    kept = StructType([StructField("ms", LongType()), StructField("oldest", LongType()), StructField("close", LongType()), StructField("is_event", BooleanType()),
                       StructField("e_id", LongType()), StructField("t_note", StringType())])
    out = StructType([StructField(c, LongType()) for c in ("k", "at", "ms", "touch_ms", "e_id", "t_note")])
    row = Row(*kept.names)
    rows = []
    for i in range(100):
        rows += [row(i * 1000, None, DAY, False, None, f"n{i}"), row(i * 1000, -7 * DAY, None, True, i, None)]
    processor, handle = touches.LatestTouch(kept, out, ["e_id"], ["t_note"], 7, False, False), Handle()
    processor.init(handle)
    assert list(processor.handleInputRows((1,), iter(rows), None)) == []
    assert handle.timers == {0} and handle.calls <= 2
    found = list(processor.handleExpiredTimer((1,), Times(60_000), Times(0)))
    assert [(r.e_id, r.t_note) for r in found] == [(i, f"n{i}") for i in range(61)]
    assert 61_000 in handle.timers and handle.calls <= 8
    found = list(processor.handleExpiredTimer((1,), Times(DAY), Times(61_000)))
    assert [r.e_id for r in found] == list(range(61, 100)) and handle.calls <= 13
