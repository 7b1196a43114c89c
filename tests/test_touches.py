"""As-of attribution over streams against the batch form, and how much state it keeps."""

import os
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from playcohort.functions import channel
from playcohort.operators import asof, attribution
from playcohort.session import shared_dir
from playcohort.sources import records
from playcohort.sources.logs import parse_log
from playcohort.sources.tables import file_lines
from playcohort.streaming import pipelines, touches

START = 1_704_067_200  # 2024-01-01
COLUMNS = "kind string, k string, at bigint, id bigint, note string"


def rows_of_lines(lines):
    parts = F.from_csv("value", COLUMNS)
    return lines.select(parts.alias("r")).select("r.kind", "r.k", F.timestamp_seconds("r.at").alias("t"), "r.id", "r.note")


def split(rows):
    events = rows.filter("kind = 'event'").select("k", F.col("t").alias("e_time"), F.col("id").alias("event_id"), "note")
    return events, rows.filter("kind = 'touch'").select("k", F.col("t").alias("t_time"), "id", "note")


def made(seed, days=40, keys=12):
    """Touches and events of some keys, one of them very frequent; equal seconds and repeated lines."""
    rng, lines = random.Random(seed), []
    for i in range(700):
        at = START + rng.randrange(days * 86_400) // 600 * 600
        line = f"{rng.choice(['touch', 'touch', 'event'])},k{rng.choice([0, 0, 0, rng.randrange(keys)])},{at},{i},n{i % 5}"
        lines += [line] * rng.choice([1, 1, 1, 2])
    return lines


def write(path, lines, late_hours=6, span=8 * 86_400):
    """Files of eight days each, some of the last hours late; at the end a line far in the future for each kind."""
    os.makedirs(path)
    files = {}
    for i, line in enumerate(lines):
        number, rest = divmod(int(line.split(",")[2]) - START, span)
        files.setdefault(number + (rest > span - late_hours * 3600 and i % 2), []).append(line)
    files[99] = [f"{kind},far,{START + 400 * 86_400},-1,x" for kind in ("touch", "event")]
    for order, number in enumerate(sorted(files)):
        with open(f"{path}/{number}.txt", "w") as out:
            out.write("\n".join(files[number]))
        os.utime(f"{path}/{number}.txt", (START + order, START + order))


def streamed(spark, path, breaks_at=None, **rules):
    events, clicks = split(rows_of_lines(file_lines(spark, path, files_per_trigger=1)))
    found = touches.latest_touch(events, clicks, ["k"], "e_time", "t_time", "event_id", ["id", "note"], 7, "1 day", **rules)
    writer = found.writeStream.option("checkpointLocation", f"{path}-checkpoint").trigger(availableNow=True)
    if breaks_at is not None:
        def process(rows, batch):
            rows.write.mode("overwrite").parquet(f"{path}-out/batch={batch}")
            if batch == breaks_at and not os.path.exists(f"{path}-broken"):
                open(f"{path}-broken", "w").close()
                raise RuntimeError("lost after the batch was written")

        with pytest.raises(Exception, match="lost after"):
            writer.foreachBatch(process).start().awaitTermination()
        writer.foreachBatch(process).start().awaitTermination()
        return spark.read.parquet(f"{path}-out").drop("batch"), None
    query = writer.format("parquet").start(f"{path}-out")
    query.awaitTermination()
    return spark.read.parquet(f"{path}-out"), query


def plain(spark, path, **rules):
    events, clicks = split(rows_of_lines(spark.read.text(path)).filter("id >= 0"))
    return asof.latest_touch(events.distinct(), clicks.distinct(), ["k"], "e_time", "t_time", "event_id", ["id", "note"], 7, **rules)


def same(got, want):
    columns = ["k", "event_id", "touch_time", "touch_id", "touch_note"]
    return sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))


@pytest.mark.parametrize("rules", [{"consume": True}, {"open_start": True}])
def test_the_stream_gives_what_the_whole_log_gives(spark, tmp_path, rules):
    path = str(tmp_path / "lines")
    write(path, made(3))
    got, query = streamed(spark, path, **rules)
    want = plain(spark, path, **rules)
    assert want.count() > 50 and same(got, want)
    # what no event can reach any more is gone: at the end only the closing lines are left
    progress = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert max(progress) < 700 and progress[-1] <= 20


def test_a_broken_batch_is_replayed_from_its_state(spark, tmp_path):
    path = str(tmp_path / "lines")
    write(path, made(4))
    got, _ = streamed(spark, path, breaks_at=3, consume=True)
    assert same(got, plain(spark, path, consume=True))


def test_a_frequent_key_keeps_a_day_and_one_touch(spark, tmp_path):
    """Forty days of a touch an hour for one key, no event: the state holds the last days' only."""
    path = str(tmp_path / "lines")
    write(path, [f"touch,hot,{START + 3600 * i},{i},n" for i in range(40 * 24)], late_hours=0, span=2 * 86_400)
    _, query = streamed(spark, path, consume=True)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert max(held[2:-2]) < 5 * 24 * 2


def click(device, at, pkg="12M77", callback="cb"):
    return ('bi_thirddata {"adv_name":"bi_adv_baidu_click","pkg_id":"%s","os":"1","imei":"%s","ts":"%d","callback_url":"%s","aid":"i%d","uid":"f","pid":"s"}'
            % (pkg, device, START + at, callback, at % 3))


def activation(device, at, pkg="12M77", game=12):
    time = datetime.fromtimestamp(START + at, timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    return f"2024-01-01 10:00:00,001 [INFO] bi: bi_active|{game}|x|x|m_s_{pkg}|{time}|x|android|{device}"


def test_the_click_table_of_the_stream_is_that_of_the_whole_log(spark, tmp_path):
    """Rows are opened, refreshed, used and opened again; clicks in one second, also that of an activation; a device too far from its clicks."""
    rng, path, hour = random.Random(5), str(tmp_path / "lines"), 3600
    timed = [(0, click("seen-1", 0)), (0, click("seen-1", 0, callback="dd")), (hour, activation("seen-1", hour)), (hour, click("seen-1", hour)), (9 * 24 * hour, click("seen-1", 9 * 24 * hour)),
             (5 * hour, click("far-2", 5 * hour)), (20 * 24 * hour, activation("far-2", 20 * 24 * hour))]
    for i in range(300):
        at, device = rng.randrange(30 * 24) * hour // 2, f"device-{rng.randrange(6)}"
        timed.append((at, (activation if rng.random() < 0.3 else click)(device, at)))
    os.makedirs(path)
    for number in range(6):
        lines = [line for at, line in timed if min(at // (5 * 24 * hour), 5) == number]
        if number == 5:
            lines += [click("closing", 400 * 24 * hour), activation("closing", 400 * 24 * hour)]
        with open(f"{path}/{number}.txt", "w") as out:
            out.write("\n".join(lines))
        os.utime(f"{path}/{number}.txt", (START + number, START + number))
    games = spark.createDataFrame([(12,)], "game_id int")
    pipeline = pipelines.ClickPipeline(spark, shared_dir(spark, "clicks-test"), games, "1 day", 4)
    pipeline.start(file_lines(spark, path, files_per_trigger=1)).awaitTermination()
    got = pipeline.read()

    third, own = records.route(spark.createDataFrame([(line,) for _, line in timed], "value string"))
    clicks = records.parse_ad_clicks(third)[0]
    active = channel.with_channel_parts(parse_log(own, "active")[0], "expand_channel")
    matched = attribution.matched_clicks(active.withColumn("event_id", F.xxhash64(*active.columns)), clicks, games)
    want = attribution.click_table(clicks, matched).select(got.columns)
    assert want.filter("matched = 1").count() > 10 and want.filter("matched = 0").count() > 3
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
