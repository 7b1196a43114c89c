"""Attribution range by range with a carry against the whole history."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from playcohort.operators import asof

START = dt.datetime(2024, 1, 1)


def logs(spark, seed):
    rng, events, touches = random.Random(seed), [], []
    for i in range(500):
        at, key = START + dt.timedelta(seconds=rng.randrange(50 * 86_400) // 1800 * 1800), f"k{rng.choice([0, 0, rng.randrange(15)])}"
        (events if i % 3 == 0 else touches).append((key, at, i))
    frame = lambda rows, time, name: spark.createDataFrame(rows, f"k string, {time} timestamp, {name} bigint").cache()
    return frame(events, "e_time", "event_id"), frame(touches, "t_time", "touch_id")


def rows_of(df):
    return sorted(map(tuple, df.select("k", "event_id", "touch_time", "touch_touch_id").collect()))


@pytest.mark.parametrize("rules", [{"consume": True}, {"open_start": True}])
@pytest.mark.parametrize("cuts", [(1, 9, 10, 30), (25,)])
def test_any_split_into_days_gives_the_whole_result(spark, rules, cuts):
    events, touches = logs(spark, 7)
    args = (["k"], "e_time", "t_time", "event_id", ["touch_id"], 7)
    got, carry, begin = [], None, START.date()
    for cut in (*cuts, 60):
        end = START.date() + dt.timedelta(days=cut)
        within = lambda df, c: df.filter((F.col(c) >= F.lit(begin)) & (F.col(c) < F.lit(end)))  # noqa: B023, E731
        e, t = within(events, "e_time"), within(touches, "t_time")
        got += rows_of(asof.latest_touch(e, t, *args, carry=carry, **rules))
        rows = asof.next_carry(e, t, *args, end - dt.timedelta(days=1), carry)
        carry = spark.createDataFrame(rows.collect(), rows.schema)
        begin = end
        # a key has one row, and none once its touch is out of reach
        assert carry.count() == carry.select("k").distinct().count()
        assert carry.filter(F.col("_s._t") < F.lit(end - dt.timedelta(days=7))).isEmpty()
    assert sorted(got) == rows_of(asof.latest_touch(events, touches, *args, **rules)) and len(got) > 40
