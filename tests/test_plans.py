"""Plans are what they should be at scale: equi-joins only, narrow scans, group limits before full sorts."""

import os

import pytest

from folioforge.plans import demo

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
#: These run jobs while they're built.
EAGER = {"resolve_ladder", "ordered_ids"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(demo.queries()) - EAGER))
def test_no_pairs_without_a_key(spark, name):
    text = plan(demo.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_latest_uses_a_group_limit(spark):
    assert "WindowGroupLimit" in plan(demo.latest_per_key(spark, FOLDER))


def test_scans_read_what_they_need(spark):
    schemas = [x.split("ReadSchema: ")[1] for x in plan(demo.history_gaps(spark, FOLDER)).splitlines() if "ReadSchema: " in x]
    assert schemas and all("o_totalprice" not in s and "o_orderpriority" not in s for s in schemas)
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,O)" in plan(demo.anti_pending(spark, FOLDER))
