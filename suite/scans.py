"""Scans: every parser reads lines Spark makes from the events; the SQL side never sees a line."""

from __future__ import annotations

from pyspark.sql import functions as F

from playcohort.functions import channel as ch
from playcohort.functions.times import access_log_hour, access_log_instant
from playcohort.session import shared_dir
from playcohort.sources import records, tables
from playcohort.sources.logs import parse_log
from suite import lines
from suite.lines import GOOD
from suite.registry import query
from suite.reports import CH_SPEC, parts

EMPTY = "coalesce(channel, '')"


@query("src08_parse_regi", f"game_account:s game_id:i reg_time:s os:s {CH_SPEC} imei:s",
       f"SELECT 'u' || u AS game_account, game_id, ts AS reg_time, os, {parts(EMPTY)}, imei FROM ev WHERE event_type = 'signup' AND {GOOD}")
def parse_regi(t):
    return ch.with_channel_parts(parse_log(lines.regi_lines(t.ev), "regi")[0], "expand_channel")


@query("src09_parse_login", f"game_account:s game_id:i login_time:s {CH_SPEC} imei:s",
       f"SELECT 'u' || u AS game_account, game_id, ts AS login_time, {parts(EMPTY)}, imei FROM ev WHERE event_type = 'view' AND {GOOD}")
def parse_login(t):
    return ch.with_channel_parts(parse_log(lines.login_lines(t.ev), "login")[0], "channel_expand")


@query("src10_parse_active", f"game_id:i active_time:s os:s {CH_SPEC} imei:s",
       f"SELECT game_id, ts AS active_time, os, {parts(EMPTY)}, imei FROM ev WHERE event_type = 'error' AND {GOOD}")
def parse_active(t):
    return ch.with_channel_parts(parse_log(lines.active_lines(t.ev), "active")[0], "expand_channel")


ORDER_LINES = f"""SELECT event_id, 'o' || event_id AS order_no, 'u' || u AS game_account, ts AS order_time, game_id, amount AS ori_price,
    CASE WHEN event_id % 4 = 0 THEN 0 ELSE event_id % 3 END AS total_amt, imei FROM ev
    WHERE event_type = 'purchase' AND event_id % 10 > 1 AND event_id % 7 <> 0 AND {GOOD}"""


@query("src11_parse_order", "order_no:s game_account:s order_time:s game_id:i ori_price:i total_amt:i imei:s", f"""
    SELECT order_no, game_account, order_time, game_id, ori_price * 100 AS ori_price, total_amt * 100 AS total_amt, imei
    FROM ({ORDER_LINES} UNION ALL SELECT * FROM ({ORDER_LINES}) WHERE event_id % 6 = 0)""")
def parse_order(t):
    rows = parse_log(lines.order_lines(t.ev), "order")[0]
    return rows.withColumns({c: F.col(c) * 100 for c in ("ori_price", "total_amt")})


@query("src12_parse_pubgame", "game_id:i", "SELECT n_nationkey AS game_id FROM nation WHERE n_nationkey % 9 <> 0")
def parse_pubgame(t):
    return parse_log(lines.pubgame_lines(t.nation), "pubgame")[0]


@query("set01_game_union", "game_id:i", "SELECT n_nationkey AS game_id FROM nation WHERE n_nationkey % 9 <> 0 UNION SELECT game_id FROM publish_game")
def game_union(t):
    return parse_log(lines.pubgame_lines(t.nation), "pubgame")[0].union(t.publish_game.select("game_id")).distinct()


CLEAN_CHANNEL = "CASE WHEN coalesce(channel, '') = '' THEN '21' ELSE channel END"


@query("src13_parse_channel_click", "type:i expand_channel:s ip:s publish_time:s game_id:i", f"""
    SELECT event_id % 4 + 1 AS type, {CLEAN_CHANNEL} AS expand_channel, '10.0.0.' || (u % 50) AS ip, cast(ts AS date) AS publish_time, game_id
    FROM ev WHERE event_type = 'click' AND {GOOD}""")
def parse_channel(t):
    return parse_log(lines.channel_lines(t.ev), "channel")[0]


REQUEST = "event_type = 'click' AND event_id % 11 <> 0 AND event_id % 13 <> 0 AND event_id % 17 <> 0"


@query("src14_parse_request", "type:i expand_channel:s ip:s publish_time:s game_id:i", f"""
    SELECT 4 AS type, 'm' || (u % 3) || '_s' || (u % 5) || '_p' || (u % 11) AS expand_channel, '10.0.0.' || (u % 50) AS ip, cast(ts AS date) AS publish_time, game_id
    FROM ev WHERE {REQUEST}""")
def parse_request(t):
    return parse_log(lines.request_lines(t.ev), "request", lines.LANDING)[0]


@query("set02_click_union", "type:i expand_channel:s ip:s publish_time:s game_id:i", f"""
    SELECT 4 AS type, 'm' || (u % 3) || '_s' || (u % 5) || '_p' || (u % 11) AS expand_channel, '10.0.0.' || (u % 50) AS ip, cast(ts AS date) AS publish_time, game_id FROM ev WHERE {REQUEST}
    UNION SELECT event_id % 4 + 1, {CLEAN_CHANNEL}, '10.0.0.' || (u % 50), cast(ts AS date), game_id FROM ev WHERE event_type = 'click' AND {GOOD}""")
def click_union(t):
    request, channel = (parse_log(make(t.ev), kind, lines.LANDING)[0] for make, kind in ((lines.request_lines, "request"), (lines.channel_lines, "channel")))
    return request.unionByName(channel).distinct()


@query("src15_parse_account", "kind:s game_account:s game_id:s event_time:s user_type:s owner_id:s", """
    SELECT 'bi_regi' AS kind, 'u' || u AS game_account, CASE WHEN event_id % 23 = 0 THEN 'x' ELSE cast(game_id AS varchar) END AS game_id, ts AS event_time, '8' AS user_type, cast(u % 40 AS varchar) AS owner_id
    FROM ev WHERE event_type = 'signup' AND event_id % 31 <> 0 AND event_id % 37 <> 0
    UNION ALL SELECT 'bi_login', 'u' || u, CASE WHEN event_id % 23 = 0 THEN 'x' ELSE cast(game_id AS varchar) END, ts, '', '' FROM ev WHERE event_type = 'view' AND event_id % 31 <> 0 AND event_id % 37 <> 0
    UNION ALL SELECT 'bi_order', 'u' || u, CASE WHEN event_id % 23 = 0 THEN 'x' ELSE cast(game_id AS varchar) END, ts, '', '' FROM
      (SELECT * FROM ev UNION ALL SELECT * FROM ev WHERE event_id % 6 = 0) WHERE event_type = 'purchase' AND event_id % 31 <> 0 AND event_id % 37 <> 0""")
def parse_account(t):
    every = lines.regi_lines(t.ev).union(lines.login_lines(t.ev)).union(lines.order_lines(t.ev))
    return parse_log(every, "account")[0]


@query("flt01_rejects", "kind:s rejects:i", f"""
    SELECT CASE event_type WHEN 'signup' THEN 'regi' WHEN 'view' THEN 'login' WHEN 'error' THEN 'active' END AS kind, count(*) AS rejects
    FROM ev WHERE event_type IN ('signup', 'view', 'error') AND NOT ({GOOD}) GROUP BY 1""")
def rejects(t):
    made = {"regi": lines.regi_lines, "login": lines.login_lines, "active": lines.active_lines}
    parts_ = [parse_log(make(t.ev), kind)[1].select(F.lit(kind).alias("kind")) for kind, make in made.items()]
    return parts_[0].union(parts_[1]).union(parts_[2]).groupBy("kind").agg(F.count("*").alias("rejects"))


@query("src22_login_as_regi", "game_account:s game_id:i reg_time:s expand_channel:s imei:s", f"""
    SELECT 'u' || u AS game_account, game_id, ts AS reg_time, coalesce(channel, '') AS expand_channel, CASE WHEN event_id % 2 = 0 THEN imei ELSE '' END AS imei
    FROM ev WHERE event_type = 'view' AND event_id % 23 <> 0 AND event_id % 31 <> 0""")
def login_as_regi(t):
    fields = ["'bi_login'", "'-'", "'-'", "'U' || u", lines.GAME, lines.TIME, *["'-'"] * 7, lines.CHANNEL]
    made = t.ev.filter("event_type = 'view'").selectExpr(
        f"concat_ws('|', {', '.join(fields)}, CASE WHEN event_id % 2 = 0 THEN imei END) AS value")
    return parse_log(made, "login_as_regi")[0]


AD = "event_id % 19 <> 0"


@query("src16_ad_clicks_json", "pkg_id:s game_id:i os:s imei:s ts:s callback:s adv_name:i idea_id:s first_level:s second_level:s", f"""
    SELECT pkg_id, game_id, os, imei, ts, callback, adv_name, CASE WHEN adv_name = 1 THEN '' ELSE idea_id END AS idea_id,
           CASE WHEN adv_name = 2 THEN first_level ELSE '' END AS first_level, CASE WHEN adv_name = 1 THEN '' ELSE second_level END AS second_level
    FROM ad_click WHERE {AD}""")
def ad_clicks(t):
    return records.parse_ad_clicks(lines.ad_click_lines(t.ad_click))[0]


@query("set07_media_union", "media:s os:s clicks:i games:i", f"""
    SELECT CASE adv_name WHEN 1 THEN 'momo' WHEN 2 THEN 'baidu' WHEN 3 THEN 'jinritoutiao' ELSE 'aiqiyi' END AS media, os, count(*) AS clicks, count(DISTINCT split_part(pkg_id, 'M', 1)) AS games
    FROM ad_click WHERE {AD} GROUP BY 1, 2""")
def media_union(t):
    from playcohort.operators.attribution import media_name

    third, _ = records.route(lines.ad_click_lines(t.ad_click).union(lines.login_lines(t.ev)))
    clicks = records.parse_ad_clicks(third)[0].select(media_name(F.col("adv_name")).alias("media"), "os", "game_id")
    per_game = clicks.groupBy("media", "os", "game_id").agg(F.count("*").alias("n"))
    return per_game.groupBy("media", "os").agg(F.sum("n").alias("clicks"), F.count("*").alias("games"))


@query("src17_wall_json", "game_id:s app_id:s pkg_id:s imei:s ip:s ts:s adv_name:s", """
    SELECT game_id, '9' AS app_id, pkg AS pkg_id, imei, '10.0.0.' || (u % 50) AS ip, ts, CASE WHEN event_type = 'click' THEN 'bi_adv_money_click' ELSE 'bi_adv_money_active' END AS adv_name
    FROM ev WHERE event_type IN ('click', 'view') AND event_id % 21 <> 0""")
def wall(t):
    return records.parse_wall(lines.wall_lines(t.ev))


@query("src18_role_json", "gameid:s userid:s imei:s exectime:s content_roleid:s content_rolename:s content_rolelevel:s", """
    SELECT game_id AS gameid, 'u' || u AS userid, imei, ts AS exectime, event_id AS content_roleid, 'role' || u AS content_rolename, event_id % 60 AS content_rolelevel FROM ev WHERE event_type = 'view'""")
def role(t):
    return records.parse_role(lines.role_lines(t.ev))


@query("src19_crash_json", "device_id:s platform:s app_versioncode:s item_device_id:s item_id:i is_throwable:s msg:s time:s", """
    SELECT imei AS device_id, os AS platform, game_id AS app_versioncode, imei AS item_device_id, i AS item_id, i % 2 = 0 AS is_throwable, 'm' || i AS msg, ts AS time
    FROM ev, LATERAL (SELECT unnest(generate_series(1, event_id % 3 + 1)) AS i) WHERE event_type = 'error'""")
def crash(t):
    return records.parse_crash(lines.crash_lines(t.ev))


@query("src20_route", "route:s lines:i", """
    SELECT 'third' AS route, count(*) AS lines FROM ad_click UNION ALL SELECT 'own', count(*) FROM ev WHERE event_type = 'view'""")
def route(t):
    third, own = records.route(lines.ad_click_lines(t.ad_click).union(lines.login_lines(t.ev)))
    count = lambda df, name: df.filter("value IS NOT NULL").groupBy().agg(F.count("*").alias("lines")).select(F.lit(name).alias("route"), "lines")
    return count(third, "third").union(count(own, "own"))


@query("fun08_access_log_date", "day_hour:s instant:i hits:i", """
    SELECT strftime(ts, '%Y-%m-%d %H') AS day_hour, min(epoch(ts)) - 8 * 3600 AS instant, count(*) AS hits FROM ev WHERE event_type = 'click' GROUP BY 1""")
def access_log(t):
    value = F.col("value")
    return lines.request_lines(t.ev).groupBy(access_log_hour(value).alias("day_hour")).agg(
        F.min(F.unix_timestamp(access_log_instant(value))).alias("instant"), F.count("*").alias("hits"))


# --- tables: written to a fresh folder and read back ------------------------------------
@query("src05_parquet_dim", "pkg_code:s promotion_channel:s head_people:s", "SELECT pkg_code, promotion_channel, head_people FROM fxdim WHERE date '2024-01-20' BETWEEN mstart_date AND mend_date")
def parquet_dim(t):
    from playcohort.operators.merge import overwrite_parquet

    path = shared_dir(t.spark, "dim")
    overwrite_parquet(t.fxdim, path, files=2)
    return tables.read_table(t.spark, path).filter("date '2024-01-20' BETWEEN mstart_date AND mend_date")


@query("src06_partitioned_merge_schema", "key:s order_no:s amount:i channel:s", """
    SELECT cast(order_time AS date) AS key, order_no, ori_price * 100 AS amount, CASE WHEN order_time >= timestamp '2024-01-20 00:00:00' THEN 'late' END AS channel
    FROM pays WHERE order_time >= timestamp '2024-01-10 00:00:00'""")
def merged_days(t):
    path = shared_dir(t.spark, "order-days")
    rows = t.pays.select(F.date_format("order_time", "yyyy-MM-dd").alias("key"), "order_no", (F.col("ori_price") * 100).cast("long").alias("amount"))
    rows.filter("key < '2024-01-20'").write.partitionBy("key").parquet(path)
    rows.filter("key >= '2024-01-20'").withColumn("channel", F.lit("late")).write.mode("append").partitionBy("key").parquet(path)
    return tables.read_days(t.spark, path, first="2024-01-10")


@query("src07_delimited_list", "cp_uid:s n:i", "SELECT 'cp' || (event_id % 10) AS cp_uid, count(*) AS n FROM ev WHERE event_id % 3 <> 0 GROUP BY 1")
def delimited(t):
    made = t.ev.selectExpr("CASE WHEN event_id % 3 = 0 THEN 'broken' ELSE 'a' || event_id || '__cp' || (event_id % 10) END AS value")
    return tables.read_delimited_list(made).groupBy("cp_uid").agg(F.count("*").alias("n"))


@query("src21_views", "game_id:i n:i", "SELECT game_id, count(*) AS n FROM regi GROUP BY 1")
def views(t):
    tables.as_view(t.regi, "registered_accounts")
    return t.spark.sql("SELECT game_id, count(*) AS n FROM registered_accounts GROUP BY game_id")


@query("src03_hive_scan", "game_id:i n:i", "SELECT game_id, count(*) AS n FROM login WHERE login_time >= timestamp '2024-01-20 00:00:00' GROUP BY 1")
def scan(t):
    return tables.as_view(t.login, "login_log").filter("login_time >= timestamp '2024-01-20 00:00:00'").groupBy("game_id").agg(F.count("*").alias("n"))


