"""Bundles of touch keys, in columns: what the processors of ``touches`` decide for one key, decided for all keys of a bundle at once.

A key costs Python far more than its rows do, and most keys have a row or two in a batch. So keys of one hash share a key of the state
store, their rows are Arrow tables there as they are here, and settling is sorting and searching whole columns. A bundle has one timer,
at its first waiting row, which settles all rows the watermark has passed; without such rows, when the last touch it keeps is too old
for any event. The rows of a bundle's batch, those that wait and what it keeps are in memory of a task at once.

Rows come as frames, which would turn a whole number into a float where its column has nulls: :func:`for_frames` says by a bit which
numbers are null. Frames hold times from 1677 to 2262: the watermark takes times outside as those bounds (:func:`bounded`).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DecimalType, NumericType, StructType, TimestampType

#: Bundles of a query's keys, see ``state.BUNDLES``.
BUNDLES = 256
DAY = 86_400_000
#: Key and second in one number that sorts like both.
SECONDS = 40
_FIRST, _LAST = -9_000_000_000_000, 9_000_000_000_000  # 1684 and 2255 in milliseconds


def _is_number(kind) -> bool:
    return isinstance(kind, NumericType) and not isinstance(kind, DecimalType)


def bounded(time: Column) -> Column:
    """A time that fits into a frame."""
    return F.when(time.isNotNull(), F.least(F.greatest(time, F.timestamp_millis(F.lit(_FIRST))), F.timestamp_millis(F.lit(_LAST))))


def for_frames(rows: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``bundle, at, nulls`` and the columns: times as numbers, null numbers as 0 with their bit in ``nulls``."""
    rows = rows.withColumns({c: F.unix_micros(c) for c in columns if isinstance(rows.schema[c].dataType, TimestampType)})
    numbers = [c for c in columns if _is_number(rows.schema[c].dataType)]
    bits = F.lit(0).cast("bigint")
    for i, c in enumerate(numbers):
        bits = bits.bitwiseOR(F.when(F.col(c).isNull(), F.lit(1 << i)).otherwise(0).cast("bigint"))
    filled = [F.coalesce(F.col(c), F.lit(0).cast(rows.schema[c].dataType)).alias(c) if c in numbers else F.col(c) for c in columns]
    return rows.select(F.pmod(F.xxhash64(*on), F.lit(BUNDLES)).cast("int").alias("bundle"), "at", bits.alias("nulls"), *filled)


class Waiting(StatefulProcessor):
    """The keys of one hash under one key of the store: rows that wait for the watermark, and what is kept of those behind it.

    ``rows`` are the columns of a row (see :func:`for_frames`), ``kept`` those of what is kept; ``ms`` is in both.
    """

    def __init__(self, on: Sequence[str], rows: StructType, kept: StructType):
        self.on = list(on)
        self.numbers = [f.name for f in rows if _is_number(f.dataType)]
        self.rows, self.kept_rows = (pa.schema([(f.name, to_arrow_type(f.dataType)) for f in s]) for s in (rows, kept))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "held binary")
        self.kept = handle.getValueState("kept", "held binary")
        self.timer = handle.getValueState("timer", "at bigint")

    def settle(self, due: pa.Table, kept: pa.Table, now: int) -> tuple[pd.DataFrame | None, pa.Table]:
        """What comes of rows the watermark has passed, and what is kept from now on."""
        raise NotImplementedError

    def forgotten(self, kept: pa.Table) -> int | None:
        """When nothing of what is kept is needed any more."""
        return None

    def _table(self, frame: pd.DataFrame) -> pa.Table:
        nulls = frame["nulls"].to_numpy(np.int64)
        columns = []
        for f in self.rows:
            if f.name in self.numbers:
                columns.append(pa.array(frame[f.name].to_numpy(), f.type, mask=(nulls >> self.numbers.index(f.name)) & 1 == 1))
            else:
                columns.append(pa.array(frame[f.name], f.type, from_pandas=True))
        return pa.table(columns, schema=self.rows)

    def _wake(self, at: int | None, before: int | None) -> None:
        if at is not None:
            self.handle.registerTimer(at)
            self.timer.update((at,))
        elif before is not None:
            self.timer.clear()

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        table = pa.concat_tables([self._table(frame) for frame in rows])
        self.waiting.appendList([(_bytes(table),)])
        at, before = pc.min(table["ms"]).as_py(), self.timer.get()
        if before is None or at < before[0]:
            if before is not None:
                self.handle.deleteTimer(before[0])
            self._wake(at, None)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        held = self.kept.get()
        kept = _read(held[0]) if held is not None else self.kept_rows.empty_table()
        rows = pa.concat_tables([self.rows.empty_table(), *[_read(r[0]) for r in self.waiting.get()]]).combine_chunks()
        passed = pc.less_equal(rows["ms"], now)
        due, later = rows.filter(passed), rows.filter(pc.invert(passed))
        out, after = self.settle(due, kept, now)
        if len(later):
            self.waiting.put([(_bytes(later),)])
        elif len(rows):
            self.waiting.clear()
        if len(after):
            self.kept.update((_bytes(after),))
        elif held is not None:
            self.kept.clear()
        self._wake(pc.min(later["ms"]).as_py() if len(later) else self.forgotten(after) if len(after) else None, expiredTimerInfo.getExpiryTimeInMs())
        if out is not None and len(out):
            yield out

    def close(self) -> None:
        pass


def _bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _read(held: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(bytes(held))).read_all()


def _numbers(column: pa.ChunkedArray, null: int = 0) -> np.ndarray:
    return column.fill_null(null).to_numpy().astype(np.int64)


def _codes(table: pa.Table) -> np.ndarray:
    """A number for each different row."""
    code = np.zeros(len(table), np.int64)
    for column in table.columns:
        part = pc.dictionary_encode(column.combine_chunks(), null_encoding="encode")
        code = pd.factorize(code * (len(part.dictionary) + 1) + part.indices.to_numpy())[0].astype(np.int64)
    return code


def _ends(groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs of equal numbers."""
    if not len(groups):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = groups[1:] != groups[:-1]
    return np.flatnonzero(np.r_[True, new]), np.flatnonzero(np.r_[new, True])


def _one_each(place: np.ndarray, rows: pa.Table, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """The different places in order, and the number of the least (``last``: greatest) row of each; nulls first, as Spark orders them."""
    order = np.argsort(place, kind="stable")
    ordered = place[order]
    first, end = _ends(ordered)
    tied = np.repeat(end > first, end - first + 1)
    if tied.any():
        among = order[tied]
        by = pc.sort_indices(rows.take(among), sort_keys=[(c, "ascending") for c in rows.column_names], null_placement="at_start").to_numpy()
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by))
        order[tied] = among[np.lexsort((rank, ordered[tied]))]
    return ordered[first], order[end if last else first]


def _different(place: np.ndarray, rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Places in order and numbers of rows, each different row of a place once."""
    _, once = np.unique(_codes(rows.append_column("_place", pa.array(place))), return_index=True)
    once = once[np.argsort(place[once], kind="stable")]
    return place[once], once


def _some(rows: pa.Table, at: np.ndarray) -> pa.Table:
    """Rows by number, of nulls where the number is negative."""
    return rows.take(pa.array(at, mask=at < 0))


def _times(ms: np.ndarray) -> pd.Series:
    return pd.Series(ms.astype("datetime64[ms]")).dt.tz_localize("UTC")


def _frame(table: pa.Table) -> pd.DataFrame:
    return table.to_pandas(integer_object_nulls=True)


class Touches(Waiting):
    """As ``touches.LatestTouch`` for each key: ``events`` and ``touches`` are the columns of either, kept are the last event and the latest touch."""

    def __init__(self, on: Sequence[str], rows: StructType, kept: StructType, events: list[str], touches: list[str], lookback_days: int, consume: bool, open_start: bool):
        super().__init__(on, rows, kept)
        self.events, self.touches = events, touches
        self.lookback, self.consume, self.open_start = lookback_days * DAY, consume, open_start

    def forgotten(self, kept: pa.Table) -> int:
        last = pc.max(kept["ms"]).as_py()
        used = pc.max(kept["used"]).as_py()
        return max(0 if last is None else last + self.lookback + DAY, 0 if used is None else used + 1000)

    def settle(self, due: pa.Table, kept: pa.Table, now: int) -> tuple[pd.DataFrame | None, pa.Table]:
        names = pa.concat_tables([due.select(self.on), kept.select(self.on)])
        code = _codes(names)
        n, keys = len(due), int(code.max(initial=-1)) + 1
        ms, is_event = _numbers(due["ms"]), due["is_event"].to_numpy()
        was_touched, was_used = kept["ms"].is_valid().to_numpy(), kept["used"].is_valid().to_numpy()
        kept_ms, kept_used = _numbers(kept["ms"]), _numbers(kept["used"])
        base = min((int(x.min()) for x in (ms, kept_ms[was_touched], kept_used[was_used]) if len(x)), default=0) // 1000
        place = lambda code, ms: (code << SECONDS) + (ms // 1000 - base)
        columns = ["ms", *self.touches]
        touches = pa.concat_tables([due.filter(~is_event).select(columns), kept.filter(was_touched).select(columns)])
        touched, touch = _one_each(np.r_[place(code[:n], ms)[~is_event], place(code[n:], kept_ms)[was_touched]], touches.select(self.touches), last=True)
        events, of = due.filter(is_event), place(code[:n], ms)[is_event]
        at, event = (_one_each(of, events.select(self.events), last=False) if self.consume else _different(of, events.select(self.events)))
        # the last event of a key that used its touches
        used = np.full(keys, -1, np.int64)
        if self.consume:
            used[code[n:][was_used]] = place(code[n:], kept_used)[was_used]
        found = np.searchsorted(touched, at, "right") - 1
        hit = found >= 0
        hit[hit] = touched[found[hit]] >> SECONDS == at[hit] >> SECONDS
        touch_ms = _numbers(touches["ms"])[touch]
        oldest = _numbers(events["oldest"])[event]
        hit[hit] = touch_ms[found[hit]] > oldest[hit] if self.open_start else touch_ms[found[hit]] >= oldest[hit]
        if self.consume:
            before = used[at >> SECONDS]
            before[1:] = np.where(at[1:] >> SECONDS == at[:-1] >> SECONDS, at[:-1], before[1:])
            hit[hit] = touched[found[hit]] > before[hit]
            np.maximum.at(used, at >> SECONDS, at)
        out = None
        if hit.any():
            of_event, of_touch = events.take(event[hit]), touches.take(touch[found[hit]])
            out = _frame(of_event.select([*self.on, "ms"]))
            out.insert(len(self.on), "at", _times(np.clip(out["ms"].to_numpy(np.int64), _FIRST, _LAST)))
            out["touch_ms"] = of_touch["ms"].to_numpy()
            out = pd.concat([out, _frame(of_event.select(self.events)), _frame(of_touch.select(self.touches))], axis=1)
        # the latest touch of each key, unless it is used or too old for any event to come
        _, end = _ends(touched >> SECONDS)
        last = np.full(keys, -1, np.int64)
        last[touched[end] >> SECONDS] = end
        mine = np.flatnonzero(last >= 0)
        mine = mine[(touched[last[mine]] > used[mine]) & (touch_ms[last[mine]] + self.lookback + DAY > now)]
        latest = np.full(keys, -1, np.int64)
        latest[mine] = touch[last[mine]]
        # an event is to be known as long as a touch of its second may come
        used_ms = ((used & (1 << SECONDS) - 1) + base) * 1000
        known = (used >= 0) & (used_ms > now - 1000)
        some = np.flatnonzero((latest >= 0) | known)
        one = np.zeros(keys, np.int64)
        one[code] = np.arange(len(code))
        after = names.take(one[some]).append_column("used", pa.array(used_ms[some], mask=~known[some]))
        for c, column in zip(columns, _some(touches, latest[some]).columns, strict=True):
            after = after.append_column(c, column)
        return out, after.cast(self.kept_rows)


class Clicks(Waiting):
    """As ``touches.ClickRows`` for each device in a package: kept are the open rows of the click table."""

    def __init__(self, on: Sequence[str], rows: StructType, kept: StructType, first: list[str]):
        super().__init__(on, rows, kept)
        self.first = first

    def settle(self, due: pa.Table, kept: pa.Table, now: int) -> tuple[pd.DataFrame | None, pa.Table]:
        code = _codes(pa.concat_tables([due.select(self.on), kept.select(self.on)]))
        n, ms, is_use = len(due), _numbers(due["ms"]), due["used"].to_numpy()
        base = int(ms.min(initial=0 if not n else ms[0])) // 1000
        place = (code[:n] << SECONDS) + (ms // 1000 - base)
        uses = np.unique(place[is_use])
        clicks = due.filter(~is_use)
        at, callback = _one_each(place[~is_use], clicks.select(["callback"]), last=True)
        _, first = _one_each(place[~is_use], clicks.select(self.first), last=False)
        # a key's stretch of clicks up to a use: by the number of uses before it; a click of the use's second comes before that
        stretches = len(uses) + 1
        stretch = (at >> SECONDS) * stretches + np.searchsorted(uses, at, "left")
        held = code[n:] * stretches + np.searchsorted(uses, code[n:] << SECONDS, "left")
        begin, end = _ends(stretch)
        every = np.union1d(stretch, held)
        opened, begun, ended = (np.full(len(every), -1, np.int64) for _ in range(3))
        opened[np.searchsorted(every, held)] = np.arange(len(held))
        begun[np.searchsorted(every, stretch[begin])], ended[np.searchsorted(every, stretch[end])] = begin, end
        heads = pa.concat_tables([clicks.take(first).select([*self.on, "ms", *self.first]).rename_columns([*self.on, "opened", *self.first]), kept.select([*self.on, "opened", *self.first])])
        tails = pa.concat_tables([clicks.take(callback).select(["ms", "callback"]), kept.select(["ms", "callback"])])
        heads = heads.take(np.where(opened >= 0, len(at) + opened, begun))
        tails = tails.take(np.where(ended >= 0, ended, len(at) + opened))
        rows = pa.table({c: (tails if c in ("ms", "callback") else heads)[c] for c in self.kept_rows.names})
        by = every % stretches  # the use that ends the stretch, if it is the key's
        used = by < len(uses)
        used[used] = uses[by[used]] >> SECONDS == every[used] // stretches
        shown, out = used | (ended >= 0), None
        if shown.any():
            out = _frame(rows.filter(shown))
            out["opened"], out["ms"] = (_times(out[c].to_numpy(np.int64)) for c in ("opened", "ms"))
            out = out.rename(columns={"ms": "ts"}).assign(matched=used[shown].astype(np.int32))
        return out, rows.filter(~used).cast(self.kept_rows)
