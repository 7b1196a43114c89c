"""Every registered query against its SQL on the smallest tables, and the shape of its plan."""

import os

import pytest

from suite import load_all
from suite.compare import compare, duck

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
REGISTRY = load_all()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def is_stream(name: str) -> bool:
    """Streaming jobs run while they are built; their plans are those of the batch operators."""
    return "_stream" in name


@pytest.mark.parametrize("name", sorted(REGISTRY.QUERIES))
def test_query(spark, con, name):
    """Same rows as the SQL, without a quadratic or a Python step in the plan."""
    plans = []

    def keep_plan(session, folder):
        df = REGISTRY.QUERIES[name](session, folder)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    ok, note = compare(spark, con, FOLDER, name, keep_plan, REGISTRY.ORACLES.get(name))
    assert ok, note
    for step in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas", "CollectLimit"):
        assert is_stream(name) or step not in plans[0]


def test_every_query_has_sql():
    assert set(REGISTRY.QUERIES) == set(REGISTRY.ORACLES)


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert "retained_1day" in df.columns and df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
