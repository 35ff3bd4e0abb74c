"""Every registered query against its SQL, and the shape of the plans."""

import re

import oracle
import pytest

import __spark_entry__ as entry
from keyloom.plans.star import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SMALL)


def test_every_query_has_an_oracle(spark):
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(entry.queries()) and len(QUERIES) > 100


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


# Row counts and other one-row frames may meet in one task; nothing else may.
ONE_TASK = re.compile(r"Exchange SinglePartition")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


def depth(line):
    return line.index("+- ") if "+- " in line else 0


def check_plan(name, plan):
    """No cross join, no Python operator, and nothing but aggregates in one task beyond the ordinal's offsets."""
    assert not [f for f in FORBIDDEN if f in plan]
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if ONE_TASK.search(line):
            reader = next(above for above in reversed(lines[:i]) if depth(above) < depth(line))
            assert "Aggregate(" in reader or name == "W4_row_number", f"one task runs {reader}"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    check_plan(name, df._jdf.queryExecution().executedPlan().toString())
    ok, message = oracle.compare(con, df, ORACLE[name])
    assert ok, message


def test_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = QUERIES["S1_scan"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "EqualTo(o_orderstatus,F)" in plan and "GreaterThanOrEqual(o_orderdate" in plan
        narrow = QUERIES["J10_exists_flags"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in narrow
        settled = QUERIES["F1_settlement"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThan(o_totalprice,20000.0)" in settled
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.mark.parametrize("name", ["A1_usage_rollup", "A1_closed_periods", "J2_snowflake", "J12_new_keys", "L4_inserted", "J6_latest_per_key", "J8_enrich", "F1_settlement", "V1_issues"])
def test_large_side_plans_give_the_same(spark, con, name):
    """Without broadcasts: equal rows and equal types."""
    small = QUERIES[name](spark, SMALL).schema
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES[name](spark, SMALL)
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in small]
        ok, message = oracle.compare(con, df, ORACLE[name])
        assert ok, message
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.parametrize("name", ["A1_usage_rollup", "J2_snowflake"])
def test_large_side_plans_look_for_no_hot_keys(spark, name):
    """Without broadcasts, building the query reads at most a schema per table: no sketch over rows."""
    tracker, limit = spark.sparkContext.statusTracker(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.sparkContext.setJobGroup(f"planning {name}", name)
    try:
        QUERIES[name](spark, SMALL)
        assert len(tracker.getJobIdsForGroup(f"planning {name}")) <= 5
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
