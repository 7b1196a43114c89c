"""Logical tables over the test tables.

Each is one SQL text that Spark and DuckDB both run: game logs come from ``events``, dimensions from
``nation``, ``region``, ``part`` and ``supplier``, members from ``customer``, ``orders`` and ``lineitem``.
Whole tables are used throughout; the modulo arithmetic only shapes values.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from playcohort.session import shared_dir

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

VIEWS: dict[str, str] = {
    # one row per event with the shared derivations; all times at the log's resolution of a second
    "ev": """
        SELECT event_id, u, event_type, amount, ts, game_id, imei, os, pkg,
               CASE WHEN u % 13 = 0 THEN '' WHEN u % 17 = 0 THEN NULL WHEN u % 19 = 0 THEN 'm' || (u % 3)
                    ELSE 'm' || (u % 3) || '_s' || (u % 5) || '_' || pkg END AS channel
        FROM (SELECT event_id, u, event_type, amount, ts, game_id,
                     CASE WHEN u % 29 = 0 THEN '00000000000000000000000000000000'
                          WHEN u % 2 = 0 THEN lpad(cast(u3 AS varchar(20)), 15, '0')
                          ELSE upper(md5('d' || u3)) END AS imei,
                     CASE WHEN u % 2 = 0 THEN 'android' ELSE 'ios' END AS os,
                     game_id || 'M' || (u % 11) AS pkg
              FROM (SELECT event_id, user_id AS u, event_type, cast(value AS decimal(18,2)) AS amount,
                           cast(date_trunc('second', ts) AS timestamp) AS ts,
                           cast((user_id + event_id % 2) % 25 AS int) AS game_id,
                           cast((user_id - user_id % 3) / 3 AS bigint) AS u3
                    FROM events) a) b""",
    "regi": "SELECT event_id, ' U' || u || ' ' AS game_account, game_id, ts AS reg_time, channel AS expand_channel, imei, os FROM ev WHERE event_type = 'signup'",
    "login": "SELECT event_id, 'u' || u AS game_account, game_id, ts AS login_time, channel AS channel_expand, imei, '10.0.0.' || (u % 50) AS ip FROM ev WHERE event_type = 'view'",
    "active": "SELECT event_id, game_id, channel AS expand_channel, ts AS active_time, os, imei FROM ev WHERE event_type = 'error'",
    "landing": "SELECT event_id, channel AS expand_channel, game_id, ts, cast(event_id % 4 + 1 AS int) AS type, '10.0.0.' || (u % 50) AS ip FROM ev WHERE event_type = 'click'",
    "pays": """
        SELECT event_id, 'o' || event_id AS order_no, ts AS order_time, 'U' || u AS game_account, game_id, amount AS ori_price,
               CASE WHEN event_id % 4 <> 0 THEN cast(event_id % 3 AS decimal(18,2)) END AS total_amt,
               cast(CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 5 WHEN 2 THEN 11 ELSE 100 END AS int) AS payment_type,
               cast(CASE WHEN event_id % 10 = 0 THEN 8 ELSE 4 END AS int) AS order_status,
               cast(CASE WHEN event_id % 7 = 0 THEN 5 ELSE 6 END AS int) AS prod_type, imei
        FROM ev WHERE event_type = 'purchase'""",
    # the order log repeats lines
    "orders_g": "SELECT * FROM pays UNION ALL SELECT * FROM pays WHERE event_id % 6 = 0",
    "ad_click": """
        SELECT event_id, pkg AS pkg_id, game_id, os,
               CASE WHEN os = 'android' AND u % 4 + 1 IN (1, 3) THEN upper(md5(imei))
                    WHEN os = 'ios' THEN lower(substr(imei, 1, 8) || '-' || substr(imei, 9, 4) || '-' || substr(imei, 13, 4) || '-' || substr(imei, 17, 4) || '-' || substr(imei, 21, 12))
                    ELSE imei END AS imei,
               ts, 'http://cb.example/' || event_id AS callback, cast(u % 4 + 1 AS int) AS adv_name,
               'idea' || (event_id % 3) AS idea_id, 'a' || (u % 2) AS first_level, 'b' || (u % 3) AS second_level,
               cast(NULL AS varchar(64)) AS imei_md5_upper
        FROM ev WHERE event_type = 'click'""",
    "wall_click": "SELECT event_id, game_id, imei, ts FROM ev WHERE event_type = 'click'",
    "wall_active": "SELECT event_id, game_id, imei, ts FROM ev WHERE event_type = 'view'",
    "receipts": "SELECT order_no AS order_sn, cast(event_id % 2 AS int) AS sandbox, cast(CASE WHEN event_id % 3 = 0 THEN 3 ELSE 1 END AS int) AS state FROM pays",
    "costs": """
        SELECT game_id, cast(ts AS date) AS cost_date, cast(sum(event_id % 50) AS bigint) AS proxy, cast(count(*) * 100 AS bigint) AS publish_cost
        FROM ev WHERE event_type = 'error' AND u % 3 = 0 GROUP BY game_id, cast(ts AS date)""",
    "game_sdk": "SELECT n_regionkey AS game_id, n_nationkey AS old_game_id, n_nationkey % 2 + 1 AS system_type, n_regionkey AS group_id, CASE WHEN n_nationkey % 11 = 0 THEN 1 ELSE 0 END AS state FROM nation",
    "publish_game": "SELECT n_nationkey AS game_id, CASE WHEN n_nationkey % 7 = 0 THEN 0 ELSE 1 END AS status FROM nation WHERE n_nationkey % 5 <> 0",
    "shares": "SELECT n_nationkey AS game_id, date '2024-01-01' AS month, 30 + n_nationkey AS rate FROM nation WHERE n_nationkey % 4 <> 0",
    "ladders": "SELECT n_nationkey AS game_id, '1000=' || (20 + n_nationkey) || '|0=' || (10 + n_nationkey) || '|bad|5000=' || (30 + n_nationkey) AS ladders FROM nation WHERE n_nationkey % 6 <> 0",
    # packages and their owners
    "pkgs": "SELECT p_partkey AS p, (p_partkey % 25) || 'M' || cast((p_partkey - p_partkey % 25) / 25 AS bigint) AS pkg_code FROM part",
    "medium_package": "SELECT pkg_code AS subpackage_id, p % 97 AS merchant_id, p % 25 AS user_id, cast(p % 25 AS int) AS game_id, CASE WHEN p % 5 = 0 THEN '' ELSE 'http://fb.example' END AS feedbackurl, cast(p % 2 + 1 AS int) AS os FROM pkgs WHERE p % 3 <> 0",
    "channel_pkg": "SELECT p AS id, pkg_code, p % 5 AS main_id, (p + 1) % 25 AS manager, p % 5 AS channel_id FROM pkgs WHERE p % 2 = 0",
    "channel_pkg_conf": "SELECT p AS pkg_id, 'mode' || (p % 4) AS promotion, CASE WHEN p % 3 = 0 THEN timestamp '2024-01-10 00:00:00' ELSE timestamp '2024-01-30 00:00:00' END AS start_time, timestamp '2024-02-10 00:00:00' AS end_time FROM pkgs",
    "merchant": "SELECT s_suppkey AS merchant_id, s_suppkey AS id, s_name AS merchant, s_nationkey AS agent_id FROM supplier",
    "agent": "SELECT n_nationkey AS id, 'agent_' || n_name AS agent_name FROM nation",
    "users": "SELECT n_nationkey AS id, CASE WHEN n_nationkey = 3 THEN '' ELSE n_name END AS name FROM nation",
    "channel_main": "SELECT r_regionkey AS id, r_name AS main_name FROM region",
    "channel_manager": """
        SELECT r_regionkey AS channel_id, r_regionkey * 2 AS manager, timestamp '2024-01-01 00:00:00' AS start_time, timestamp '2024-01-16 00:00:00' AS end_time FROM region
        UNION ALL SELECT r_regionkey, r_regionkey * 2 + 1, timestamp '2024-01-16 00:00:00', timestamp '2024-01-25 00:00:00' FROM region""",
    "charge_log": "SELECT s_suppkey AS source_id, s_suppkey % 25 AS user_id, CASE WHEN s_suppkey % 4 = 0 THEN 2 ELSE 3 END AS family, timestamp '2024-01-05 00:00:00' AS start_time, timestamp '2024-02-01 00:00:00' AS end_time FROM supplier",
    "fxdim": """
        SELECT pkg_code, 'pc' || (p % 5) AS promotion_channel, 'ma' || (p % 7) AS medium_account, 'mode1' AS promotion_mode, 'hp' || (p % 3) AS head_people,
               date '2016-01-01' AS mstart_date, date '2024-01-15' AS mend_date, date '2016-01-01' AS astart_date, date '9999-01-01' AS aend_date FROM pkgs
        UNION ALL
        SELECT pkg_code, 'pd' || (p % 5), 'mb' || (p % 7), 'mode2', 'hq' || (p % 3),
               date '2024-01-16', date '9999-01-01', date '2016-01-01', date '9999-01-01' FROM pkgs""",
    "game_base": "SELECT r_regionkey AS id, r_name AS game_name, r_regionkey + 100 AS corporation_id FROM region WHERE r_regionkey <> 4",
    "finance": "SELECT r_regionkey + 100 AS corporation_base_id, r_regionkey % 2 + 1 AS bill_type FROM region WHERE r_regionkey <> 2",
    # members and cards
    "card_regi": """
        SELECT 'c' || c_custkey AS game_account, cast(c_custkey % 40 AS bigint) AS owner_id, c_nationkey AS game_id,
               timestamp '2024-01-29 00:00:00' + (c_custkey % 3) * interval '1' day AS relate_time,
               CASE WHEN c_custkey % 4 <> 0 THEN timestamp '2024-01-30 12:00:00' END AS bind_uid_time,
               cast(c_custkey % 2 AS int) AS reg_resource, CASE WHEN c_custkey % 6 <> 0 THEN c_mktsegment END AS reg_os_type FROM customer""",
    "card_login": "SELECT 'c' || u AS game_account, ts AS login_time FROM ev WHERE event_type = 'view'",
    "promo_user": "SELECT cast(s_suppkey % 45 AS bigint) AS member_id, min('code' || s_suppkey) AS code, min(s_name) AS username, cast(min(s_suppkey % 45) % 2 AS int) AS member_grade, cast(min(s_suppkey % 45) % 3 AS int) AS status, cast(min(s_nationkey) AS int) AS group_id, timestamp '2023-01-01 00:00:00' AS create_time FROM supplier GROUP BY s_suppkey % 45",
    "gameinfo": "SELECT n_nationkey AS id, CASE WHEN n_nationkey % 8 <> 0 THEN n_regionkey END AS mainid, CASE WHEN n_nationkey % 8 <> 0 THEN n_name END AS maingname FROM nation",
    "member": "SELECT c_custkey AS member_id, CASE WHEN c_custkey % 9 = 0 THEN '' ELSE c_name END AS username, CASE WHEN c_custkey % 9 <> 0 THEN timestamp '2020-01-01 00:00:00' END AS addtime, c_mktsegment AS regtype FROM customer",
    "bind_member": "SELECT o_custkey AS member_id, 'acc' || (o_orderkey % 97) AS account, cast(o_orderdate AS timestamp) AS bind_time FROM orders",
    "member_orders": """
        SELECT o_custkey AS userid, o_orderkey AS orderid, cast(l_extendedprice AS decimal(18,2)) AS oriprice, cast(l_quantity AS bigint) AS productnum,
               cast(l_extendedprice AS decimal(18,2)) AS payprice, cast(o_orderdate AS timestamp) AS erectime,
               CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 4 END AS state
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "bgameaccount": "SELECT lower(trim(game_account)) AS account, 'cp' || (event_id % 30) AS cp_uid FROM regi",
    "special_account": "SELECT 'c' || c_custkey AS account, 'user' || (c_custkey % 10) AS subordinate_code FROM customer",
    "card_master": "SELECT 'c' || c_custkey AS account FROM customer WHERE c_mktsegment = 'BUILDING'",
    "card_account": "SELECT 'c' || c_custkey AS account, timestamp '2024-01-29 10:00:00' AS addtime, 'dev' || (c_custkey % 50) AS imei, c_nationkey AS game_id, cast(c_custkey % 40 AS bigint) AS uid, c_custkey + 5 AS bind_member_id FROM customer",
    "bound_member": "SELECT c_custkey AS id, c_name AS username FROM customer",
    # long payments
    "long_first": "SELECT o_custkey, min(o_orderdate) AS first_date FROM orders GROUP BY o_custkey",
}


def needed(name: str, stop: tuple[str, ...] = ()) -> list[str]:
    """The views a view depends on, itself included, in definition order; not looking below ``stop``."""
    found, todo = set(), [name]
    while todo:
        view = todo.pop()
        if view in found:
            continue
        found.add(view)
        if view in stop:
            continue
        todo += [v for v in VIEWS if v not in found and re.search(rf"\b(FROM|JOIN) {v}\b", VIEWS[view])]
    return [v for v in VIEWS if v in found]


def prelude(names: list[str]) -> str:
    """``name AS (sql), ...`` of the views and all they depend on."""
    wanted = {v for n in names for v in needed(n)}
    return ",\n".join(f"{v} AS ({VIEWS[v]})" for v in VIEWS if v in wanted)


_LANDED: dict[tuple[str, str], tuple[str, StructType]] = {}


def forget_landed() -> None:
    """Land the derived events anew at their next use."""
    _LANDED.clear()


class Tables:
    """The logical tables of one folder as Spark frames: ``Tables(spark, dir).regi``.

    The shared event derivations (``ev``) are landed once per application as a typed table partitioned
    by event type, the way the log parsers land their rows; the log tables are projections of one
    partition each.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or (name not in VIEWS and name not in BASE):
            raise AttributeError(name)
        frame = self.spark.read.parquet(f"{self.dir}/{name}.parquet") if name in BASE else self.landed() if name == "ev" else self.view(name)
        self.__dict__[name] = frame
        return frame

    def landed(self) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.dir)
        if key not in _LANDED:
            path = shared_dir(self.spark, "event-log")
            # dealt first: a table of one file would be derived, and later read, by one task
            dealt = Tables(self.spark, self.dir)
            dealt.events = self.events.repartition(self.spark.sparkContext.defaultParallelism)
            events = dealt.view("ev")
            events.write.partitionBy("event_type").parquet(path)
            _LANDED[key] = (path, events.schema)
        path, schema = _LANDED[key]
        return self.spark.read.schema(schema).parquet(path)

    def view(self, name: str) -> DataFrame:
        """The view's SQL over the given tables and, below the log tables, the landed events."""
        parts = [v for v in needed(name, stop=() if name == "ev" else ("ev",))]
        ctes = ", ".join(f"{v} AS ({VIEWS[v]})" for v in parts if v != "ev" or name == "ev")
        sql, used = f"WITH {ctes} SELECT * FROM {name}", {}
        for table in (*BASE, *(() if name == "ev" else ("ev",))):
            replaced = re.sub(rf"\b(FROM|JOIN) {table}\b", rf"\1 {{{table}}}", sql)
            if replaced != sql:
                sql, used[table] = replaced, getattr(self, table)
        return self.spark.sql(sql, **used)
