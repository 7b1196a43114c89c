"""As-of attribution over streams: each event gets the latest earlier touch of its key, when the watermark has passed it.

The streaming form of ``operators.asof.latest_touch``, with the same rules. State is kept per key: what lies after the watermark
waits, of what lies before it only the latest touch is needed, and with ``consume`` not even that once an event has used
it. One event-time timer of a key, at its first undecided event or the end of its first waiting touch's day, settles all rows the
watermark has passed: events are decided, touches fold into one. A last timer drops a touch that no event can reach any more. So a key
holds the rows of the watermark's delay and of one day, and one touch, however often it is touched; a key without recent touches
holds nothing. Every call to the state goes to the JVM and back, so a key makes a fixed number of them per batch. Lines
later than the delay are dropped.

Operators chain: the output carries its event time in ``at``, and a second attribution may read it in the same query.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime, timezone
from itertools import groupby

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, LongType, StructField, StructType, TimestampType

from playcohort import constants as C
from playcohort.functions import channel as ch
from playcohort.operators import attribution
from playcohort.sources import records
from playcohort.sources.logs import parse_log
from playcohort.streaming.state import use_state_store
from playcohort.streaming.waits import Clicks, Touches, bounded, for_frames

_DAY = 86_400_000


def _ordered(values: tuple) -> tuple:
    """Nulls first, as Spark orders them."""
    return tuple((v is not None, v) for v in values)


class LatestTouch(StatefulProcessor):
    """One key: rows that wait for the watermark, the latest touch before it, the last event that used touches."""

    def __init__(self, waiting: StructType, out: StructType, events: list[str], touches: list[str], lookback_days: int, consume: bool, open_start: bool):
        self.row = Row(*out.names)
        self.schema, self.events, self.touches = waiting, events, touches
        self.lookback, self.consume, self.open_start = lookback_days * _DAY, consume, open_start

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.schema)
        # the last event that used touches, the latest touch
        self.kept = handle.getValueState("kept", StructType([StructField("used", LongType()), self.schema["ms"], *[self.schema[c] for c in self.touches]]))

    @staticmethod
    def _timer(rows: list) -> int:
        """When the first of the rows is to be looked at: an event at its second, a touch when its day is over."""
        return min(r.ms if r.is_event else r.close for r in rows)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        rows = list(rows)
        self.waiting.appendList([tuple(r[c] for c in self.schema.names) for r in rows])
        self.handle.registerTimer(self._timer(rows))
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        waiting = Row(*self.schema.names)
        rows = [waiting(*r) for r in self.waiting.get()]
        due, later = [r for r in rows if r.ms <= now], [r for r in rows if r.ms > now]
        before = self.kept.get() or (None,) * (2 + len(self.touches))
        used, last = before[0], tuple(before[1:]) if before[1] is not None else None
        out = []
        for ms, second in groupby(sorted(due, key=lambda r: r.ms), key=lambda r: r.ms):
            second = list(second)
            touches = [tuple(r[c] for c in self.touches) for r in second if not r.is_event]
            if touches:
                last = (ms, *max(touches, key=_ordered))
            events = sorted({tuple(r[c] for c in (*self.events, "oldest")) for r in second if r.is_event}, key=_ordered)
            for *event, oldest in events[:1] if self.consume else events:
                recent = last is not None and (last[0] > oldest if self.open_start else last[0] >= oldest)
                if recent and (not self.consume or used is None or last[0] > used):
                    at = datetime.fromtimestamp(ms / 1000, timezone.utc)
                    out.append(self.row(*key, at, ms, last[0], *event, *last[1:]))
            if events and self.consume:
                used, last = ms, None
        if last is not None and last[0] + self.lookback + _DAY <= now:
            last = None
        if used is not None and not later and last is None:
            used = None  # a touch that comes now is later than it
        if due:
            if later:
                self.waiting.put([tuple(r) for r in later])
                self.handle.registerTimer(self._timer(later))
            else:
                self.waiting.clear()
        after = (used, *(last or (None,) * (1 + len(self.touches))))
        if after != tuple(before):
            if last is None and used is None:
                self.kept.clear()
            else:
                self.kept.update(after)
            if last is not None and last[0] != before[1]:
                self.handle.registerTimer(last[0] + self.lookback + _DAY)
        return iter(out)

    def close(self) -> None:
        pass


def _rows(df: DataFrame, on: Sequence[str], time: str, named: dict[str, str], is_event: bool, lookback_days: int, delay: str | None) -> DataFrame:
    """Events or touches in one shape; ``delay`` sets the watermark, None leaves that of the input's ``at``."""
    df = df.withColumn("at", bounded(F.col(time))).withWatermark("at", delay) if delay else df
    second = F.date_trunc("second", time)
    oldest = F.unix_millis(F.date_sub(F.to_date(time), lookback_days).cast("timestamp")) if is_event else F.lit(None).cast("bigint")
    return df.select(*on, "at", F.unix_millis(second).alias("ms"), oldest.alias("oldest"), F.lit(is_event).alias("is_event"), *[F.col(c).alias(n) for c, n in named.items()])


def latest_touch(events: DataFrame, touches: DataFrame, on: Sequence[str], event_time: str, touch_time: str, event_id: str, touch_cols: Sequence[str],
                 lookback_days: int, delay: str, consume: bool = False, open_start: bool = False, chained: bool = False) -> DataFrame:
    """Streaming form of ``operators.asof.latest_touch``: same columns, and ``at`` as event time.

    ``chained`` says that ``touches`` come from another attribution and have their watermark.
    """
    use_state_store(events.sparkSession)
    rest = [c for c in events.columns if c not in (*on, event_id, event_time, "at")]
    event_cols, touch_cols = {c: f"e_{c}" for c in (event_id, *rest)}, {c: f"t_{c}" for c in touch_cols}
    left = _rows(touches, on, touch_time, touch_cols, False, lookback_days, None if chained else delay)
    right = _rows(events, on, event_time, event_cols, True, lookback_days, delay)
    rows = left.unionByName(right, allowMissingColumns=True)
    of_event, of_touch = list(event_cols.values()), list(touch_cols.values())
    kinds = {f.name: f.dataType for f in rows.schema}
    rows = for_frames(rows, on, [*on, "ms", "oldest", "is_event", *of_event, *of_touch])
    some = lambda *columns: [StructField(c, rows.schema[c].dataType) for c in columns]
    waiting = StructType(some(*rows.columns[3:]))
    kept = StructType([*some(*on), StructField("used", LongType()), *some("ms", *of_touch)])
    out = StructType([*some(*on), StructField("at", TimestampType()), *some("ms"), StructField("touch_ms", LongType()), *some(*of_event, *of_touch)])
    processor = Touches(on, waiting, kept, of_event, of_touch, lookback_days, consume, open_start)
    found = rows.groupBy("bundle").transformWithStateInPandas(processor, out, "Append", "EventTime", eventTimeColumnName="at")
    found = found.withColumns({c: F.timestamp_micros(c) for c in (*on, *of_event, *of_touch) if isinstance(kinds[c], TimestampType)})
    return found.select(*on, "at", F.timestamp_millis("ms").alias(event_time), *[F.col(n).alias(c) for c, n in event_cols.items()], F.timestamp_millis("touch_ms").alias("touch_time"),
                        *[F.col(n).alias(f"touch_{c}") for c, n in touch_cols.items()])


def _used_clicks(lines: DataFrame, games: DataFrame, delay: str) -> DataFrame:
    """A stream of activations with the click each has used, in ``touch_`` columns."""
    third, own = records.route(lines)
    clicks = attribution.click_touches(records.parse_ad_clicks(third)[0])
    active = ch.with_channel_parts(parse_log(own, "active")[0], "expand_channel")
    active = active.withColumn("event_id", F.xxhash64(*sorted(c for c in active.columns if c != "expand_channel")))
    events = attribution.activation_events(active, games)
    return latest_touch(events, clicks, attribution.CLICK_KEY, "active_time", "ts", "event_id", attribution.CLICK_COLS, C.CLICK_LOOKBACK_DAYS, delay, consume=True)


def attributed_activations(lines: DataFrame, games: DataFrame, delay: str) -> DataFrame:
    """A stream of activations credited to their latest click of seven days; a click serves one activation.

    ``lines`` carry the media's JSON clicks and the own log; ``games`` are the advertised games (static).
    """
    return attribution.credit_activations(_used_clicks(lines, games, delay), "at")


def attributed_registrations(lines: DataFrame, activations: DataFrame, delay: str) -> DataFrame:
    """A stream of registrations credited to the latest attributed activation of thirty days; ``activations`` as above."""
    regi = ch.with_channel_parts(parse_log(records.route(lines)[1], "regi")[0], "expand_channel")
    regi = regi.withColumn("event_id", F.xxhash64(*sorted(c for c in regi.columns if c != "expand_channel")))
    hits = latest_touch(attribution.registration_events(regi), attribution.activation_touches(activations, "at"), attribution.ACTIVATION_KEY, "reg_time", "active_time", "event_id",
                        attribution.ACTIVATION_COLS, C.ACTIVATION_LOOKBACK_DAYS, delay, open_start=True, chained=True)
    return attribution.credit_registrations(hits, "at")


#: A row of the click table as it stands: ``opened`` is the second of its first click and, with the key, names the row.
CLICK_ROW_KEY = ("pkg_id", "imei", "opened")


class ClickRows(StatefulProcessor):
    """A device in a package: clicks and uses that wait for the watermark, and the open row of the click table.

    Rows come out when the watermark has passed a change, each time as a whole: open, refreshed, used; of several changes in between only
    the last one shows. One timer of a key, at its first waiting row, settles all rows the watermark has passed.
    """

    def __init__(self, waiting: StructType, opened: StructType, out: StructType, first: list[str]):
        self.waiting_schema, self.open_schema, self.row, self.first = waiting, opened, Row(*out.names), first

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.waiting_schema)
        self.open = handle.getValueState("open", self.open_schema)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        rows = list(rows)
        self.waiting.appendList([tuple(r[c] for c in self.waiting_schema.names) for r in rows])
        self.handle.registerTimer(min(r.ms for r in rows))
        return iter(())

    def _shown(self, key: tuple, row: tuple, used: int) -> Row:
        opened, ms = (datetime.fromtimestamp(at / 1000, timezone.utc) for at in row[:2])
        return self.row(*key, opened, ms, *row[2:], used)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        waiting = Row(*self.waiting_schema.names)
        rows = [waiting(*r) for r in self.waiting.get()]
        due, later = [r for r in rows if r.ms <= now], [r for r in rows if r.ms > now]
        if not due:
            return iter(())
        held = self.open.get()
        row, changed, out = tuple(held) if held is not None else None, False, []
        for ms, second in groupby(sorted(due, key=lambda r: r.ms), key=lambda r: r.ms):
            second = list(second)
            clicks = [r for r in second if not r.used]
            if clicks:  # a click of the second in which the row is used comes before that
                callback, changed = max(r.callback for r in clicks), True
                head = (row[0], *row[3:]) if row else (ms, *min((tuple(r[c] for c in self.first) for r in clicks), key=_ordered))
                row = (head[0], ms, callback, *head[1:])
            if row and len(clicks) < len(second):
                out.append(self._shown(key, row, 1))
                row, changed = None, False
        if row:
            self.open.update(row)
            out += [self._shown(key, row, 0)] if changed else []
        elif held is not None:
            self.open.clear()
        if later:
            self.waiting.put([tuple(r) for r in later])
            self.handle.registerTimer(min(r.ms for r in later))
        else:
            self.waiting.clear()
        return iter(out)

    def close(self) -> None:
        pass


def click_rows(lines: DataFrame, games: DataFrame, delay: str) -> DataFrame:
    """A stream of changed rows of the click table, the streaming form of ``attribution.click_table``.

    Two stateful operators in one query: the first finds the clicks that activations use, the second keeps per package and device
    the open row. Of a row's versions the one with the greatest ``ts, matched`` holds, see ``newest_rows``.
    """
    used = _used_clicks(lines, games, delay)
    clicks = attribution.valid_clicks(records.parse_ad_clicks(records.route(lines)[0])[0])
    first = [c for c in clicks.columns if c not in ("pkg_id", "imei", "ts", "callback")]
    clicks = clicks.withColumn("at", bounded(F.col("ts"))).withWatermark("at", delay).select(
        "pkg_id", "imei", "at", F.unix_millis(F.date_trunc("second", "ts")).alias("ms"), F.lit(False).alias("used"), "callback", *first)
    used = used.select(F.col("touch_pkg_id").alias("pkg_id"), F.col("touch_imei").alias("imei"), "at", F.unix_millis("active_time").alias("ms"), F.lit(True).alias("used"))
    on = ["pkg_id", "imei"]
    rows = for_frames(clicks.unionByName(used, allowMissingColumns=True), on, [*on, "ms", "used", "callback", *first])
    fields = {f.name: StructField(f.name, f.dataType) for f in rows.schema.fields}
    keys, rest = [fields[c] for c in on], [fields[c] for c in ("callback", *first)]
    out = StructType([*keys, StructField("opened", TimestampType()), StructField("ts", TimestampType()), *rest, StructField("matched", IntegerType())])
    processor = Clicks(on, StructType([*keys, fields["ms"], fields["used"], *rest]), StructType([*keys, StructField("opened", LongType()), fields["ms"], *rest]), first)
    return rows.groupBy("bundle").transformWithStateInPandas(processor, out, "Append", "EventTime")


def newest_rows(versions: DataFrame) -> DataFrame:
    """Each row of the click table once, as its last version says."""
    rest = [c for c in versions.columns if c not in (*CLICK_ROW_KEY, "ts", "matched")]
    last = versions.groupBy(*CLICK_ROW_KEY).agg(F.max(F.struct("ts", "matched", *rest)).alias("_r"))
    return last.select(*CLICK_ROW_KEY, "_r.*").select(versions.columns)
