from playcohort.sources import records, tables
from playcohort.sources.logs import landing_line, parse_log

HEAD = "2024-01-01 10:00:00,001 [INFO] bi: "


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def regi(account="Acc001 ", game="12", time="2024-01-01 10:00:00", channel="m1_s2_p3"):
    return f"{HEAD}bi_regi|r1|x|{account}|{game}|{time}|x|x|x|x|x|ANDROID|x|{channel}|dev$1"


def test_registration(spark):
    rows, rejects = parse_log(lines(spark, regi(), regi(game="x"), regi(time="soon"), f"{HEAD}bi_regi|r1|x", "unrelated"), "regi")
    (row,) = rows.collect()
    assert (row.game_account, row.game_id, row.os, row.expand_channel, row.imei) == ("acc001", 12, "android", "m1_s2_p3", "dev|1")
    assert rejects.count() == 3


def test_login_and_activation(spark):
    login = f"{HEAD}bi_login|l1|x|acc001|2024-01-01 11:00:00|x||dev-1|12"
    (row,) = parse_log(lines(spark, login), "login")[0].collect()
    assert (row.channel_expand, row.imei, row.game_id) == ("", "dev-1", 12)
    active = f"{HEAD}bi_active|12|x|x|m1|2024-01-01 09:59:00|x|android|dev-1"
    short = f"{HEAD}bi_active|12|x|x|m1|2024-01-01|x|android|dev-1"
    rows, rejects = parse_log(lines(spark, active, short), "active")
    assert rows.count() == 1 and rejects.count() == 1


def order(no="ord-1", total="", status="4", prod="6"):
    return f"{HEAD}bi_order|x|{no}|x|x|acc001|2024-01-02 12:00:00|12|x|x|30.00|x|x|{total}|x|x|x|x|x|{status}|x|x|{prod}|x|dev-1"


def test_orders(spark):
    rows, rejects = parse_log(lines(spark, order(), order(status="8"), order(status="45"), order(prod="5"), order(no=" "), order(total="2.5")), "order")
    got = sorted((float(r.ori_price), float(r.total_amt)) for r in rows.collect())
    assert got == [(30.0, 0.0), (30.0, 2.5)] and rejects.count() == 4


def test_clicks(spark):
    channel = f"{HEAD}bi_channel|3|0|10.0.0.1|2024-01-01 09:00:00|12||"
    (row,) = parse_log(lines(spark, channel), "channel")[0].collect()
    assert (row.expand_channel, row.game_id, row.publish_time, row.type, row.ip) == ("21", 12, "2024-01-01", 3, "10.0.0.1")
    hit = '10.0.0.9 - - [08/Jan/2024:17:38:01 +0800] "GET /landing/loaded?p=m1_s2_p3&g=12&x=1 HTTP/1.1" 200 5 "-" "agent" 10.0.0.1, 10.0.0.9'
    missing = hit.replace('HTTP/1.1" 200', 'HTTP/1.0" 404')
    (row,) = parse_log(lines(spark, hit, missing, hit.replace("g=12", "g=")), "request", landing_line("/landing/loaded", "0800"))[0].collect()
    assert (row.expand_channel, row.game_id, row.publish_time, row.type, row.ip) == ("m1_s2_p3", 12, "2024-01-08", 4, "10.0.0.1")


def test_ad_clicks(spark):
    momo = 'bi_thirddata {"pkg_id":"12M001","os":"2","imei":"","idfa":"dev-1","ts":"1704096000","callback":"http://cb/1","adv_name":"bi_adv_momo_click"}'
    iqiyi = '{"pkg_id":"12M002","os":1,"imei":"dev-2","timestamp":1704096000.0,"callback":"c","adid":"i","cid":"s","adv_name":"bi_adv_aiqiyi_click"}'
    bad = [momo.replace("12M001", "12"), momo.replace('"ts":"1704096000",', ""), momo[:40], iqiyi.replace('"callback":"c",', "")]
    clicks, rejects = records.parse_ad_clicks(lines(spark, momo, iqiyi, *bad))
    rows = {r.adv_name: r for r in clicks.collect()}
    assert sorted(r.value for r in rejects.collect()) == sorted(bad)
    assert set(rows) == {1, 4}
    assert (rows[1].game_id, rows[1].os, rows[1].imei) == (12, "android", "dev-1")
    assert (rows[4].os, rows[4].idea_id, rows[4].first_level, rows[4].second_level) == ("ios", "i", "", "s")


def test_wall_drops_bad_json(spark):
    good = '{"game_id":"12","app_id":"9","pkg_id":"12M002","imei":"d","ip":"1","ts":"2024-01-01 13:53:15","adv_name":"bi_adv_money_click"}'
    assert records.parse_wall(lines(spark, good, good[:30], good.replace("13:53", "99:99"))).count() == 1


def test_source_options(spark):
    kafka = tables.kafka_options("host:1", "topic", "smallest", 1000)
    assert kafka["startingOffsets"] == "earliest" and kafka["maxOffsetsPerTrigger"] == "1000" and kafka["failOnDataLoss"] == "false"
    assert tables.kafka_options("host:1", "topic")["startingOffsets"] == "latest"
    jdbc = tables.jdbc_options("jdbc:x", "t", "id", 0, 100, 8)
    assert (jdbc["partitionColumn"], jdbc["numPartitions"], jdbc["upperBound"]) == ("id", "8", "100")
