"""Every named query against its SQL, and the shape of some plans."""

import os
import re

import pytest

from compare import connect, difference
from assetloom.registry import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_equals_sql(spark, con, name):
    assert difference(spark, con, QUERIES[name], FOLDER) is None


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if not q.sql))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def plan_of(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_python_in_batch_plans(spark, name):
    assert not re.search("ArrowEvalPython|BatchEvalPython|InPandas|InArrow|CartesianProduct", plan_of(spark, name))


def test_plan_shapes(spark):
    assert "LeftAnti" in plan_of(spark, "pending_docs")
    assert "WindowGroupLimit" in plan_of(spark, "topk_per_group")
    assert "TakeOrderedAndProject" in plan_of(spark, "first_pending")
    assert "Exchange" not in plan_of(spark, "segment_plan")
    assert "Exchange" not in plan_of(spark, "playlist_segments")
    assert "text" not in re.search(r"ReadSchema: (.*)", plan_of(spark, "pending_docs")).group(1)


def test_entry(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).count() == 20
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_all_operators_are_covered():
    ids = {i for q in QUERIES.values() for i in q.covers}
    expected = {f"{k}-{n}" for k, last in {
        "SRC": 11, "FLT": 19, "JN": 6, "LED": 9, "AGG": 14, "WIN": 9, "ORD": 8, "SET": 4, "STR": 13,
        "DT": 5, "MTH": 5, "JSN": 3, "JOB": 15, "STM": 7}.items() for n in range(1, last + 1)}
    assert expected - ids == set()
