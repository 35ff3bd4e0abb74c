"""Matches and joins against brute force, with hot keys and NULLs."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keyloom.operators import dedupe, matching


def brute_next(rows):
    """rows: (key, order, qualifies, payload)."""
    found = {}
    for key, order, _, _ in rows:
        later = [r for r in rows if r[2] and key is not None and r[0] == key and order is not None
                 and r[1] is not None and r[1] > order]
        found[(key, order)] = min(later, key=lambda r: r[1])[3] if later else None
    return found


def spark_next(spark, rows, blocks, hot=None):
    df = spark.createDataFrame(rows, "k string, o long, q boolean, p string")
    out = matching.next_match(df, "k", "o", F.col("q"), ["p"], hot=hot, blocks=blocks)
    return {(r["k"], r["o"]): r["nxt"]["p"] if r["nxt"] else None for r in out.collect()}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    orders=st.lists(st.integers(-50, 200), unique=True, min_size=1, max_size=40),
    seed=st.integers(0, 10_000),
    blocks=st.sampled_from([1, 3, 7]),
    hot=st.sampled_from([None, [], ["hot"], ["hot", "a"]]),
)
def test_next_match_equals_brute_force(spark, orders, seed, blocks, hot):
    rng = random.Random(seed)
    rows = [(rng.choice(["hot", "hot", "a", None]), o, rng.choice([True, False, None]), f"p{o}") for o in orders]
    assert spark_next(spark, rows, blocks, hot) == brute_next(rows)


def test_next_match_with_a_hot_key_and_null_orders(spark):
    rows = [("hot", o, o % 97 == 0, f"p{o}") for o in range(1500)]
    rows += [(f"k{o}", o, o % 2 == 0, f"p{o}") for o in range(1500, 1600)] + [("hot", None, True, "never")]
    want = brute_next(rows)
    assert spark_next(spark, rows, 16) == want
    assert spark_next(spark, rows, 16, ["hot", "k1502"]) == want
    found, _ = matching.hot_keys(spark.createDataFrame(rows, "k string, o long, q boolean, p string"), "k")
    assert found == ["hot"]


def test_order_blocks_split_a_hot_key(spark):
    hot = spark.range(10_000).select(F.lit("hot").alias("k"), (F.col("id") * F.col("id")).alias("o"))
    rest = spark.range(2000).select(F.when(F.col("id") % 2 == 0, "small").alias("k"), F.col("id").alias("o"))
    blocks = matching.order_blocks(hot.union(rest), "k", "o", ["hot"], 20).groupBy("k", "_block").count().collect()
    sizes = {name: [r["count"] for r in blocks if r["k"] == name] for name in ("hot", "small", None)}
    assert len(sizes["hot"]) == 20 and max(sizes["hot"]) < 2 * 10_000 / 20
    assert sizes["small"] == [1000]
    assert len(sizes[None]) == 20 and max(sizes[None]) < 150


def test_order_blocks_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k string, o long, q boolean, p string")
    assert matching.next_match(df, "k", "o", F.col("q"), ["p"]).count() == 0


@pytest.fixture
def skewed(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id")).alias("k"), F.col("id").alias("row")
    )
    keys = spark.range(0, 3000, 2).union(spark.range(1, 2))
    return left, keys.select(F.col("id").alias("k"), F.concat(F.lit("r"), "id").alias("v"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(skewed, how):
    left, right = skewed
    plain = left.join(right, "k", how)
    salted = matching.skew_join(left, right, "k", how, salts=5)
    assert sorted(map(str, plain.collect())) == sorted(map(str, salted.collect()))


def test_hot_keys_find_the_hot_key_and_null(skewed):
    hot, null_is_hot = matching.hot_keys(skewed[0], "k", share=0.25)
    assert hot == [1] and null_is_hot


def test_skew_join_salts_only_beyond_the_broadcast_limit(spark, skewed):
    left, right = skewed
    assert "_salt" not in matching.skew_join(left, right, "k")._jdf.queryExecution().optimizedPlan().toString()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salted = matching.skew_join(left, right, "k")
        assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
        assert salted.count() == 3000
        even = spark.range(1000).select(F.col("id").alias("k"))
        assert "_salt" not in matching.skew_join(even, right, "k")._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_skew_join_refuses_other_kinds(skewed):
    with pytest.raises(ValueError, match="salted side"):
        matching.skew_join(*skewed, "k", "full")


def test_null_safe_join_and_new_keys(spark):
    a = spark.createDataFrame([(1, None, "x"), (None, None, "y"), (2, "b", "z")], "k int, m string, v string")
    b = spark.createDataFrame([(1, None, 10), (None, None, 20)], "k int, m string, w int")
    got = {(r["v"], r["w"]) for r in matching.null_safe_join(a, b, ["k", "m"]).collect()}
    assert got == {("x", 10), ("y", 20)}
    assert [r["v"] for r in matching.new_keys(a, b, ["k", "m"], null_safe=True).collect()] == ["z"]
    assert sorted(r["v"] for r in matching.new_keys(a, b, ["k", "m"]).collect()) == ["x", "y", "z"]


def test_latest_match_keeps_unmatched_rows(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "code string")
    right = spark.createDataFrame([(1, "a", "old"), (2, "a", "new"), (3, None, "no")], "id int, major string, name string")
    out = matching.latest_match(left, right, "code", "major", "id", {"name": "major_name"})
    assert {r["code"]: r["major_name"] for r in out.collect()} == {"a": "new", "b": None, None: None}


def test_existence_flags_treat_null_as_false(spark):
    child = spark.createDataFrame([(1, "Lump sum A"), (1, None), (2, "Lump sum B")], "id int, item string")
    is_lump = F.col("item").startswith("Lump sum")
    got = {r["id"]: r["lump"] for r in matching.existence_flags(child, "id", {"lump": is_lump}).collect()}
    assert got == {1: True, 2: True}


def test_key_overlap(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("b",), ("c",), (None,)], "j string")
    assert tuple(matching.key_overlap(left, right, "k", "j").first()) == (2, 2, 1)
    assert matching.overlap_samples(left, right, "k", "j", 1).collect() == [("left", "a"), ("right", "b")]


def test_keep_one_is_total_and_groups_null(spark):
    rows = [(None, 1, "a"), (None, 1, "b"), ("k", 2, "c"), ("k", 3, None)]
    df = spark.createDataFrame(rows, "k string, n int, v string")
    got = {r["k"]: (r["n"], r["v"]) for r in dedupe.keep_one(df, ["k"], [F.col("n").desc()]).collect()}
    assert got == {None: (1, "b"), "k": (3, None)}


def test_keep_one_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = dedupe.keep_one(df, ["k"], [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    below_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in below_shuffle and "Partial" in below_shuffle


def test_duplicate_report(spark):
    rows = [(1, "a", None), (1, "a", "x"), (2, "b", "x"), (3, "c", "y"), (3, "d", "y"), (4, "e", None), (4, "e", None)]
    df = spark.createDataFrame(rows, "k int, a string, b string")
    got = {r["k"]: (r["rows"], r["differing"]) for r in dedupe.duplicate_report(df, "k").collect()}
    assert got == {1: (2, ["b"]), 3: (2, ["a"]), 4: (2, [])}
    assert dedupe.duplicate_count(df, ["k"]).first()[0] == 3
    with pytest.raises(ValueError, match="duplicate keys"):
        dedupe.require_unique(df, ["k"])
    dedupe.require_unique(df.filter("k = 2"), ["k"])


def test_ordinal_is_gapless_over_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"), (F.col("id") % 2).alias("y")).repartition(7)
    got = [(r["y"], r["x"], r["row_order"]) for r in dedupe.ordinal(df, [F.desc("y"), F.col("x")]).collect()]
    assert [g[:2] for g in sorted(got, key=lambda g: g[2])] == sorted([g[:2] for g in got], key=lambda g: (-g[0], g[1]))
    assert sorted(g[2] for g in got) == list(range(1, 1001))


def test_split_by_key(spark):
    df = spark.createDataFrame([("1 2",), ("x",), (None,)], "k string")
    good, bad = dedupe.split_by_key(df, "k", F.when(F.col("k") != "x", F.replace("k", F.lit(" "), F.lit(""))))
    assert [r["k"] for r in good.collect()] == ["12"]
    assert [r["k"] for r in bad.collect()] == ["x", None]
