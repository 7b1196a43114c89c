"""Plans of the operators themselves, before anything is written for later steps."""

import os
import re

import pytest

from playcohort.functions import channel as ch
from playcohort.operators import attribution, kpi
from playcohort.plans import jobs
from suite.adapter import Tables
from suite.reports import DAYS, RUN_DAY

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, FOLDER)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    """The pushed filters of each scan of the event log."""
    return [m for m in re.findall(r"FileScan parquet \[[^\]]*\bts#[^\n]*", plan(df))]


@pytest.mark.parametrize("job", [
    lambda t: jobs.login_histogram(t.login, t.publish_game, t.game_sdk, DAYS),
    lambda t: jobs.new_device_login_histogram(t.regi, t.login, t.publish_game, t.game_sdk, DAYS),
    lambda t: jobs.device_account_histogram(t.regi, t.game_sdk, DAYS),
    lambda t: jobs.pay_accounts_by_offset(t.regi, t.orders_g, t.game_sdk, DAYS),
    lambda t: jobs.ltv_short(t.regi, t.orders_g, t.publish_game, RUN_DAY),
])
def test_a_run_reads_its_days_only(t, job):
    found = scans(job(t))
    assert found and all("GreaterThanOrEqual(ts" in scan and "LessThan(ts" in scan for scan in found)


def test_value_reads_the_orders_it_can_count(t):
    orders = [s for s in scans(jobs.ltv_long(t.regi, t.orders_g, t.publish_game, RUN_DAY)) if "purchase" in s]
    assert orders and all("GreaterThanOrEqual(ts" in s and "LessThan(ts" in s for s in orders)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def shuffles(df):
    return len(re.findall(r"(?<!Reused)Exchange hashpartitioning", plan(df)))


def test_attribution_plan(t, no_broadcast):
    active = ch.with_channel_parts(t.active, "expand_channel")
    df = attribution.attribute_activations(active, t.ad_click)
    # a guard, not the goal: the state at a day's start still reads the points a second time
    assert shuffles(df) <= 10
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|Python", plan(df))


def test_login_plan_joins_reduced_rows(t, no_broadcast):
    logins = jobs.clean_login(jobs.published_only(t.login, t.publish_game)).drop("event_id", "ip")
    df = kpi.login_kpi(logins, jobs.registration_base(t.regi, t.publish_game), kpi.MARKET)
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|Python", plan(df))
