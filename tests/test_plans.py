"""Plan guards for every catalogue query: no all-pairs joins, no Python UDFs."""

import contextlib
import io
import os

import pytest

import __spark_entry__ as entry
from ferrum.plans import catalogue

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_plan_has_no_all_pairs_join_or_python(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    bad = [op for op in FORBIDDEN if op in plan]
    assert not bad, f"{name}: {bad}"


def test_scan_prunes_columns_and_pushes_filters(spark):
    plan = _plan(entry.queries()["consent_three_way"](spark, SF))
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_nationkey:int,c_mktsegment:string>" in plan
    plan = _plan(entry.queries()["retention_delete"](spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
