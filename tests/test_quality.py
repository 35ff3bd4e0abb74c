"""Checks, profiles, readiness and audit events."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from keyloom.operators import audit, quality
from keyloom.operators.quality import CheckFailed, Expectations


def found(df, expected):
    return {(r["issue"], r["column"]): r["found"] for r in quality.issues(df, expected).collect()}


def test_issues(spark):
    rows = [("1", Decimal("1"), "a"), ("1", Decimal("0"), None), (None, None, " "), (None, Decimal("-2"), None)]
    df = spark.createDataFrame(rows, "id string, amount decimal(18,2), name string")
    expected = Expectations(
        required=["id", "amount", "absent"],
        not_null=["id", "absent"],
        not_blank=["name"],
        unique="id",
        positive=["amount"],
        max_null_ratio={"name": 0.4, "amount": 0.3, "absent": 0.1},
        min_rows=5,
    )
    assert found(df, expected) == {
        ("missing_column", "absent"): "0",
        ("too_few_rows", None): "4",
        ("null", "id"): "2",
        ("blank", "name"): "3",
        ("non_positive", "amount"): "3",
        ("null_ratio", "name"): "0.5",
        ("duplicate", "id"): "2",
    }
    with pytest.raises(CheckFailed, match="null id 2"):
        quality.require(df, expected)


def test_clean_table_has_no_issues(spark):
    df = spark.createDataFrame([("1", 1), ("2", 2)], "id string, n int")
    expected = Expectations(required=["id"], not_null=["id"], unique="id", positive=["n"], max_null_ratio={"n": 0.0})
    assert found(df, expected) == {}
    quality.require(df, expected)


def test_empty_table(spark):
    df = spark.createDataFrame([], "id string")
    assert found(df, Expectations(not_null=["id"], unique="id", max_null_ratio={"id": 0.1})) == {("empty", None): "0"}


def test_profiles(spark):
    df = spark.createDataFrame([("a", 1), (" ", None), (None, 3)], "s string, n int")
    assert [tuple(r) for r in quality.fill_profile(df).collect()] == [("s", 3, 1, 2, 33.3), ("n", 3, 2, 1, 66.7)]
    assert [tuple(r) for r in quality.null_ratios(df, ["s", "n"]).collect()] == [("s", 1, 3, 0.3333), ("n", 1, 3, 0.3333)]
    nothing = df.limit(0)
    assert [tuple(r) for r in quality.fill_profile(nothing, ["s"]).collect()] == [("s", 0, 0, 0, 0.0)]
    assert [r["n"] for r in quality.empty_samples(df, "s", "n", 5).collect()] == [None, "3"]


@pytest.mark.parametrize("codes, want", [(["x", "y"], (2, 2, 1.0, True)), (["x", " "], (2, 1, 0.5, False)), ([], (0, 0, 0.0, False))])
def test_readiness(spark, codes, want):
    rows = [(f"s{i}", c) for i, c in enumerate(codes)] + ([("s0", None), (None, "x")] if codes else [])
    df = spark.createDataFrame(rows, "student string, code string")
    assert tuple(quality.readiness(df, "student", F.trim("code") != "").first()) == want


def test_audit_edits_compare_values_of_one_row(spark):
    df = spark.createDataFrame([("1", "A", "a"), ("2", "b", "b"), ("3", None, ""), ("4", None, "x")], "k string, old string, new string")
    got = audit.edits(df, "k", [("FIX", "f", F.col("old"), F.col("new"))], "run", "ts").collect()
    assert [tuple(r) for r in got] == [("ts", "run", "FIX", "1", "f", "A", "a"), ("ts", "run", "FIX", "4", "f", None, "x")]


@pytest.mark.parametrize("rows, status, batches", [(0, "no_data", 0), (1001, "success", 2), (1000, "success", 1)])
def test_run_summary(spark, rows, status, batches):
    counts = spark.createDataFrame([(rows, 3, 4)], "rows_total long, inserted long, updated long")
    row = audit.run_summary(counts, "subject", "target", "2024-03-01", 1.5, batch_size=1000).first()
    assert (row["status"], row["batches_total"], row["inserted"], row["updated"]) == (status, batches, 3, 4)
    unbatched = audit.run_summary(counts, "subject", "target", "2024-03-01").first()
    assert unbatched["batches_total"] == min(rows, 1)
