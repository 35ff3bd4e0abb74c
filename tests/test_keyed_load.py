"""Keyed loads against a plain-Python model of each contract."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keyloom.operators import keyed_load as load

VALUES = st.sampled_from([None, "", "  ", "\u00a0\t", "Ab", " ab\t", "AB\u00a0", "x", "other"])
SIDE = st.dictionaries(st.sampled_from("123456"), st.tuples(VALUES, VALUES), max_size=6)
RELAXED = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def clean(v):
    return None if v is None else v.replace("\u00a0", " ").replace("\t", " ").strip(" ") or None


def norm(v):
    return (clean(v) or "").lower()


def model_guarded(target, source):
    merged, inserted, changed = dict(target), 0, {}
    for key, row in source.items():
        if key not in target:
            merged[key] = tuple(clean(v) for v in row)
            inserted += 1
            continue
        new = tuple(t if clean(s) is None or norm(s) == norm(t) else clean(s) for s, t in zip(row, target[key], strict=True))
        merged[key] = new
        if new != target[key]:
            changed[key] = {c: (o, n) for c, o, n in zip("ab", target[key], new, strict=True) if norm(o) != norm(n)}
    return merged, inserted, changed


def frame(spark, rows):
    return spark.createDataFrame([(k, *v) for k, v in rows.items()], "k string, a string, b string")


def collect_rows(df):
    return {r["k"]: (r["a"], r["b"]) for r in df.collect()}


@RELAXED
@given(target=SIDE, source=SIDE)
def test_guarded_upsert_equals_the_model(spark, target, source):
    t = frame(spark, target)
    s = frame(spark, {f" {k} ": v for k, v in source.items()})
    rule = load.guarded("k")
    merged, inserted, changed = model_guarded(target, source)
    got = {k.strip(): v for k, v in collect_rows(load.upsert(t, s, rule)).items()}
    assert got == merged
    delta = load.change_set(t, s, rule)
    assert {k.strip(): v for k, v in collect_rows(load.apply_changes(t, delta, rule)).items()} == merged
    assert tuple(load.load_counts(delta, rule).first()) == (inserted, len(changed))
    maps = {r["k"]: {c: tuple(p) for c, p in r["changes"].items()} for r in delta.filter("_op = 'UPDATE'").collect()}
    assert maps == changed


@RELAXED
@given(target=SIDE, source=SIDE)
def test_guarded_upsert_twice_changes_nothing(spark, target, source):
    t, s, rule = frame(spark, target), frame(spark, source), load.guarded("k")
    once = load.upsert(t, s, rule)
    assert load.change_set(once, s, rule).count() == 0


@RELAXED
@given(target=SIDE, source=SIDE)
def test_exact_upsert_equals_the_model(spark, target, source):
    t, s, rule = frame(spark, target), frame(spark, source), load.exact("k")
    assert collect_rows(load.upsert(t, s, rule)) == {**target, **source}
    assert load.change_set(load.upsert(t, s, rule), s, rule).count() == 0


def test_guarded_ignores_columns_and_keeps_the_rest(spark):
    t = spark.createDataFrame([("1", "a", "b", "keep")], "Key string, A string, B string, own string")
    s = spark.createDataFrame(
        [("1", "new", "new", "9", "u"), ("2", " in ", "x", "9", "u"), (" ", "no key", "x", "9", "u"), (None, "n", "x", "9", "u")],
        "key string, a string, b string, _row_order string, unknown string",
    )
    got = {tuple(r) for r in load.upsert(t, s, load.guarded("Key", ignore=["b"])).collect()}
    assert got == {("1", "new", "b", "keep"), ("2", "in", None, None)}


def test_case_and_blank_edits_are_not_written(spark):
    t = spark.createDataFrame([("1", "Mixed Case", None)], "k string, a string, b string")
    s = spark.createDataFrame([("1", " mixed case\t", "  ")], "k string, a string, b string")
    assert load.change_set(t, s, load.guarded("k")).count() == 0


OVERWRITE = "id string, amount decimal(18,2), day timestamp, note string, n int"
EPOCH = dt.datetime(1900, 1, 1)


def test_overwrite_treats_null_as_zero_blank_and_epoch(spark):
    t = spark.createDataFrame(
        [("1", Decimal("0.00"), EPOCH, "", 0), ("2", Decimal("5.00"), EPOCH, "x", 1), ("3", None, None, None, None)], OVERWRITE
    )
    s = spark.createDataFrame(
        [("1", None, None, None, None), ("2", None, None, "x", 1), ("4", None, None, "new", 7), (None, None, None, "null key", 1)],
        OVERWRITE,
    )
    rule = load.overwrite("id", ["amount", "day"])
    merged = {r["id"]: tuple(r)[1:] for r in load.upsert(t, s, rule).collect()}
    assert merged == {
        "1": (Decimal("0.00"), EPOCH, "", 0),
        "2": (None, None, "x", 1),
        "3": (None, None, None, None),
        "4": (None, None, "new", 7),
        None: (None, None, "null key", 1),
    }
    delta = load.change_set(t, s, rule)
    assert tuple(load.load_counts(delta, rule).first()) == (2, 1)
    changes = delta.filter("_op = 'UPDATE'").first()["changes"]
    assert {c: tuple(v) for c, v in changes.items()} == {"amount": ("5.00", None), "day": ("1900-01-01 00:00:00", None)}
    rows = load.change_rows(delta, "id").orderBy("field").collect()
    assert [tuple(r) for r in rows] == [("2", "amount", "5.00", None), ("2", "day", "1900-01-01 00:00:00", None)]


def test_overwrite_counts_updates_outside_the_audited_columns(spark):
    t = spark.createDataFrame([("1", "a", "b")], "id string, audited string, other string")
    s = spark.createDataFrame([("1", "a", "c")], "id string, audited string, other string")
    delta = load.change_set(t, s, load.overwrite("id", ["audited"]))
    assert tuple(load.load_counts(delta, load.overwrite("id")).first()) == (0, 1)
    assert delta.first()["changes"] == {}


def test_exact_stamps_changed_rows_only(spark):
    columns = "student_id string, a string, ingestion_date string"
    t = spark.createDataFrame([("1", "a", "d0"), ("2", None, "d0")], columns)
    s = spark.createDataFrame([("1", "a", "d1"), ("2", "", "d1"), ("3", "c", "d1")], columns)
    got = {tuple(r) for r in load.upsert(t, s, load.exact("student_id")).collect()}
    assert got == {("1", "a", "d0"), ("2", "", "d1"), ("3", "c", "d1")}


def test_exact_with_several_keys(spark):
    t = spark.createDataFrame([(1, "x", 10), (1, "y", 20)], "a int, b string, v int")
    s = spark.createDataFrame([(1, "y", 21), (2, "x", 30)], "a int, b string, v int")
    got = {tuple(r) for r in load.upsert(t, s, load.exact("a", "b")).collect()}
    assert got == {(1, "x", 10), (1, "y", 21), (2, "x", 30)}


def test_missing_key_columns_raise(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="key columns not found"):
        load.upsert(df, df, load.exact("k"))
    with pytest.raises(ValueError, match="key columns not found"):
        load.insert_only(df, df, ["k"])


def test_insert_only(spark):
    columns = "u string, m int, pages int"
    t = spark.createDataFrame([("a", 1, 10), (None, 1, 5)], columns)
    s = spark.createDataFrame([("a", 1, 99), (None, 1, 6), ("a", 2, 7), ("a", 2, 8), (None, 2, 1)], columns)
    fresh = load.insert_only(t, s, ["u", "m"])
    assert {tuple(r) for r in fresh.collect()} == {("a", 2, 8), (None, 2, 1)}
    assert load.insert_only(t.union(fresh), s, ["u", "m"]).count() == 0
    by_all = load.insert_only(t, s.union(s))
    assert by_all.count() == 5
    first = load.insert_only(t, s, ["u", "m"], [F.col("pages").asc()])
    assert {tuple(r) for r in first.collect()} == {("a", 2, 7), (None, 2, 1)}


def test_update_samples_are_bounded_by_key(spark):
    t = spark.createDataFrame([(f"{i:02}", "a", "b") for i in range(30)], "k string, a string, b string")
    s = t.withColumn("a", F.lit("x")).withColumn("b", F.lit("y"))
    rows = load.update_samples(load.change_set(t, s, load.guarded("k")), "k", 10).collect()
    assert len(rows) == 20 and {r["key"] for r in rows} == {f"{i:02}" for i in range(10)}


def test_a_repeated_source_key_raises_when_the_load_runs(spark):
    t = spark.createDataFrame([("3", "a")], "k string, v string")
    s = spark.createDataFrame([("3", "b"), (" 3", "c"), ("4", "d")], "k string, v string")
    for merged in (load.upsert(t, s, load.guarded("k")), load.change_set(t, s, load.guarded("k"))):
        with pytest.raises(Exception, match="the source repeats the key 3"):
            merged.collect()
    assert load.change_set(t, s, load.exact("k")).count() == 3  # untrimmed, they are three keys
    missing = spark.createDataFrame([(None, "x"), (None, "x"), ("3", "b")], "k string, v string")
    assert load.upsert(t, missing, load.exact("k")).count() == 3


def test_the_check_of_source_keys_adds_no_shuffle(spark):
    t = spark.range(50).select(F.col("id").cast("string").alias("k"), F.lit("v").alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [load.change_set(t, t, load.exact("k"), checked=c)._jdf.queryExecution().executedPlan().toString() for c in (False, True)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [p.count("Exchange hashpartitioning") for p in plans] == [2, 2]
