"""Joins and matches over the star tables."""

from pyspark.sql import functions as F

from keyloom.functions.rules import fill_if_blank, fingerprint, money, resolve_option
from keyloom.functions.text import collated, strip_unicode
from keyloom.operators.dedupe import differing_rows
from keyloom.operators.matching import (
    existence_flags,
    key_overlap,
    latest_match,
    new_keys,
    next_match,
    null_safe_join,
    overlap_samples,
    skew_join,
)
from keyloom.plans.star.registry import query


@query(
    "J1_inner_join",
    """
    SELECT c_mktsegment, o_orderstatus, count(*) AS orders, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
    """,
)
def inner_join(t):
    # Orders are summed per customer first: a customer with a third of the orders joins as three rows.
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey"), "o_orderstatus").agg(
        F.count("*").alias("n"), F.sum(money("o_totalprice")).alias("s")
    )
    joined = skew_join(per_customer, t.customer.select("c_custkey", "c_mktsegment"), "c_custkey", "inner")
    return joined.groupBy("c_mktsegment", "o_orderstatus").agg(F.sum("n").alias("orders"), F.sum("s").alias("total"))


@query(
    "J2_snowflake",
    """
    SELECT DISTINCT l_returnflag, o_orderstatus, c_mktsegment, n_name, r_name FROM lineitem
    LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey
    LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
    """,
)
def snowflake(t):
    """Left chain from the fact outwards.

    The result is distinct, so the rows shrink to distinct attributes before each further join: only
    the first join sees every line, and a customer with a third of the orders is a few rows. A key of distinct
    rows has as many rows as its few attributes have values, so there is no hot key to look for.
    """
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag").distinct()
    orders = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderstatus")
    customers = t.customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment")
    nations = t.nation.select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey"))
    df = lines
    for right, key in (
        (orders, "o_orderkey"),
        (customers, "c_custkey"),
        (nations, "n_nationkey"),
        (t.region, "r_regionkey"),
    ):
        df = df.join(right, key, "left").drop(key).distinct()
    return df


@query(
    "J3_filtered_outer",
    """
    SELECT c_custkey, count(o_orderkey) AS finished, coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS total
    FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') o ON o_custkey = c_custkey GROUP BY 1
    """,
)
def filtered_outer(t):
    finished = t.orders.filter("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey"))
    sums = finished.agg(F.count("*").alias("n"), F.sum(money("o_totalprice")).alias("s"))
    return t.customer.select("c_custkey").join(sums, "c_custkey", "left").select(
        "c_custkey", F.coalesce("n", F.lit(0)).alias("finished"), F.coalesce("s", F.lit(0)).alias("total")
    )


@query(
    "J4_outer_to_inner",
    """
    SELECT o_orderkey, c_mktsegment FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0
    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
    """,
)
def outer_to_inner(t):
    solvent = t.customer.filter("c_acctbal > 0").select("c_custkey", "c_mktsegment")
    orders = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    kept = skew_join(orders, solvent, "c_custkey").filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    return kept.select("o_orderkey", "c_mktsegment")


@query(
    "J5_next_match",
    """
    SELECT o.o_orderkey, o.o_custkey, n.o_orderkey AS next_key, CAST(n.o_totalprice AS DECIMAL(18,2)) AS next_price
    FROM orders o LEFT JOIN LATERAL (
      SELECT i.o_orderkey, i.o_totalprice FROM orders i
      WHERE i.o_custkey = o.o_custkey AND i.o_orderkey > o.o_orderkey AND i.o_orderstatus = 'F'
      ORDER BY i.o_orderkey LIMIT 1) n ON true
    """,
)
def next_finished(t):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    finished = F.col("o_orderstatus") == "F"
    df = next_match(orders, "o_custkey", "o_orderkey", finished, ["o_orderkey", "o_totalprice"])
    return df.select(
        "o_orderkey",
        "o_custkey",
        F.col("nxt.o_orderkey").alias("next_key"),
        money("nxt.o_totalprice").alias("next_price"),
    )


@query(
    "J6_latest_per_key",
    """
    SELECT c_custkey, o.o_orderkey AS last_key, o.o_orderstatus AS last_status FROM customer LEFT JOIN (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) o
    ON o.o_custkey = c_custkey AND rn = 1
    """,
)
def latest_order(t):
    payload = {"o_orderkey": "last_key", "o_orderstatus": "last_status"}
    return latest_match(t.customer.select("c_custkey"), t.orders, "c_custkey", "o_custkey", "o_orderkey", payload)


@query(
    "J7_derived_key",
    """
    SELECT p_partkey, substr(p_brand, 7, 2) AS nation_code, s.s_name AS supplier FROM part LEFT JOIN (
      SELECT CAST(s_nationkey AS VARCHAR) AS code, s_name,
             row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey DESC) AS rn FROM supplier) s
    ON s.code = substr(p_brand, 7, 2) AND rn = 1
    """,
)
def derived_key(t):
    parts = t.part.select("p_partkey", F.substring("p_brand", 7, 2).alias("nation_code"))
    suppliers = t.supplier.withColumn("code", F.col("s_nationkey").cast("string"))
    return latest_match(parts, suppliers, "nation_code", "code", "s_suppkey", {"s_name": "supplier"})


@query(
    "J8_enrich",
    """
    SELECT c.k, c.c_mktsegment, s.s_name FROM (SELECT trim(' ' || c_custkey || ' ') AS k, c_mktsegment FROM customer) c
    LEFT JOIN (SELECT CAST(s_suppkey AS VARCHAR) AS k, s_name FROM supplier) s ON s.k = c.k
    """,
)
def enrich(t):
    key = strip_unicode(F.concat(F.lit("  "), F.col("c_custkey").cast("string"), F.lit("\t")))
    customers = t.customer.select(key.alias("k"), "c_mktsegment")
    suppliers = t.supplier.select(F.col("s_suppkey").cast("string").alias("k"), "s_name")
    return skew_join(customers, suppliers, "k")


@query(
    "J9_overlap",
    """
    SELECT (SELECT count(DISTINCT l_partkey) FROM lineitem) AS left_keys,
           (SELECT count(DISTINCT o_custkey) FROM orders) AS right_keys,
           (SELECT count(*) FROM (SELECT l_partkey FROM lineitem INTERSECT SELECT o_custkey FROM orders)) AS common_keys
    """,
)
def overlap(t):
    return key_overlap(t.lineitem, t.orders, "l_partkey", "o_custkey")


@query(
    "J9_overlap_samples",
    """
    (SELECT DISTINCT 'left' AS side, CAST(l_partkey AS VARCHAR) AS key FROM lineitem ORDER BY key LIMIT 5)
    UNION ALL (SELECT DISTINCT 'right', CAST(o_custkey AS VARCHAR) AS key FROM orders ORDER BY key LIMIT 5)
    """,
)
def samples(t):
    return overlap_samples(t.lineitem, t.orders, "l_partkey", "o_custkey")


@query(
    "J10_exists_flags",
    """
    SELECT o_orderkey, coalesce(max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END), 0) AS has_returned,
           coalesce(max(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END), 0) AS has_other,
           CASE WHEN count(l_orderkey) > 0 THEN 1 ELSE 0 END AS has_lines
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1
    """,
)
def exists_flags(t):
    returned = F.col("l_returnflag") == "R"
    flags = {"has_returned": returned, "has_other": ~returned, "has_lines": F.lit(True)}
    per_order = existence_flags(t.lineitem, "l_orderkey", flags).withColumnRenamed("l_orderkey", "o_orderkey")
    joined = t.orders.select("o_orderkey").join(per_order, "o_orderkey", "left")
    return joined.select("o_orderkey", *[F.coalesce(F.col(f).cast("int"), F.lit(0)).alias(f) for f in flags])


def _monthly(df, flags):
    return df.filter(F.col("l_linestatus") == flags).groupBy(
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag"),
        F.year("l_shipdate").alias("y"),
        F.nullif(F.month("l_shipdate"), F.lit(12)).alias("m"),
    )


@query(
    "J11_null_safe_join",
    """
    WITH a AS (SELECT nullif(l_returnflag, 'N') AS flag, year(l_shipdate) AS y, nullif(month(l_shipdate), 12) AS m,
                      count(*) AS finished FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2, 3),
         b AS (SELECT nullif(l_returnflag, 'N') AS flag, year(l_shipdate) AS y, nullif(month(l_shipdate), 12) AS m,
                      count(*) AS open FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1, 2, 3)
    SELECT a.flag, a.y, a.m, finished, open FROM a JOIN b ON a.flag IS NOT DISTINCT FROM b.flag AND a.y = b.y
           AND a.m IS NOT DISTINCT FROM b.m
    """,
)
def null_safe(t):
    finished = _monthly(t.lineitem, "F").agg(F.count("*").alias("finished"))
    open_lines = _monthly(t.lineitem, "O").agg(F.count("*").alias("open"))
    return null_safe_join(finished, open_lines, ["flag", "y", "m"])


@query(
    "J12_new_keys",
    """
    SELECT o_orderkey, o_orderstatus FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
    """,
)
def orders_without_lines(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return new_keys(t.orders.select("o_orderkey", "o_orderstatus"), lines, ["o_orderkey"])


@query(
    "J12_new_keys_null_safe",
    """
    WITH s AS (SELECT DISTINCT o_custkey AS k, nullif(o_orderpriority, '5-LOW') AS p FROM orders
               WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
         b AS (SELECT DISTINCT o_custkey AS k, nullif(o_orderpriority, '5-LOW') AS p FROM orders
               WHERE o_orderdate < TIMESTAMP '1998-01-01')
    SELECT k, p FROM s WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.k = s.k AND b.p IS NOT DISTINCT FROM s.p)
    """,
)
def new_pairs(t):
    later = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    pair = [F.col("o_custkey").alias("k"), F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("p")]
    source = t.orders.filter(later).select(*pair).distinct()
    target = t.orders.filter(~later).select(*pair).distinct()
    return new_keys(source, target, ["k", "p"], null_safe=True)


def _customer_states(t):
    """Newest order per customer before 1998 and overall."""
    before = t.orders.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    payload = {"o_orderstatus": "status", "o_orderpriority": "priority"}
    customers = t.customer.select("c_custkey")
    old = latest_match(customers, before, "c_custkey", "o_custkey", "o_orderkey", payload)
    new = latest_match(customers, t.orders, "c_custkey", "o_custkey", "o_orderkey", payload)
    return old, new


STATES_SQL = """
    WITH a AS (SELECT o_custkey AS k, o_orderstatus AS status, o_orderpriority AS priority, row_number() OVER
                 (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
         b AS (SELECT o_custkey AS k, o_orderstatus AS status, o_orderpriority AS priority, row_number() OVER
                 (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders),
         pair AS (SELECT c_custkey, a.status AS s0, a.priority AS p0, b.status AS s1, b.priority AS p1 FROM customer
                  LEFT JOIN a ON a.k = c_custkey AND a.rn = 1 LEFT JOIN b ON b.k = c_custkey AND b.rn = 1)
"""


@query(
    "J13_matched_changed",
    STATES_SQL
    + """
    SELECT c_custkey, s0 AS old_status, s1 AS new_status, p0 AS old_priority, p1 AS new_priority FROM pair
    WHERE s0 IS DISTINCT FROM s1 OR p0 IS DISTINCT FROM p1
    """,
)
def matched_changed(t):
    old, new = _customer_states(t)
    old = old.withColumnsRenamed({"status": "old_status", "priority": "old_priority"})
    new = new.withColumnsRenamed({"status": "new_status", "priority": "new_priority"})
    pairs = [[F.col(f"{age}_{c}") for c in ("status", "priority")] for age in ("old", "new")]
    return old.join(new, "c_custkey").filter(differing_rows(*pairs))


@query(
    "X22_fingerprint",
    STATES_SQL + "SELECT count(*) AS changed FROM pair WHERE s0 IS DISTINCT FROM s1 OR p0 IS DISTINCT FROM p1",
)
def fingerprints(t):
    marked = [
        df.select("c_custkey", fingerprint(["status", "priority"]).alias(f"f{i}"))
        for i, df in enumerate(_customer_states(t))
    ]
    return marked[0].join(marked[1], "c_custkey").agg(F.count_if(F.col("f0") != F.col("f1")).alias("changed"))


@query(
    "J14_trim_join",
    """
    SELECT a.o_orderkey, b.lines FROM (SELECT o_orderkey, '  ' || o_orderkey || ' ' AS k FROM orders) a
    JOIN (SELECT l_orderkey || '   ' AS k, count(*) AS lines FROM lineitem GROUP BY 1) b ON trim(a.k) = trim(b.k)
    """,
)
def trim_join(t):
    orders = t.orders.select("o_orderkey", F.concat(F.lit("  "), "o_orderkey", F.lit(" ")).alias("k"))
    lines = t.lineitem.groupBy(F.concat("l_orderkey", F.lit("   ")).alias("k")).agg(F.count("*").alias("lines"))
    trimmed = [df.withColumn("k", F.trim("k")) for df in (orders, lines)]
    return trimmed[0].join(trimmed[1], "k").select("o_orderkey", "lines")


ANSWERS_SQL = """
    (SELECT CAST(s_suppkey AS VARCHAR) AS k, CASE WHEN s_nationkey < 8 THEN 'Other' WHEN s_nationkey < 12 THEN '  '
            WHEN s_nationkey < 16 THEN ' oTHER' ELSE s_name END AS base,
            CASE WHEN s_acctbal > 5000 THEN 'opt ' || s_suppkey WHEN s_acctbal > 2000 THEN ' ' END AS option FROM supplier)
"""


def _answers(t):
    nation, balance = F.col("s_nationkey"), F.col("s_acctbal")
    base = F.when(nation < 8, "Other").when(nation < 12, "  ").when(nation < 16, " oTHER").otherwise(F.col("s_name"))
    option = F.when(balance > 5000, F.concat(F.lit("opt "), "s_suppkey")).when(balance > 2000, " ")
    return t.supplier.select(F.col("s_suppkey").cast("string").alias("k"), base.alias("base"), option.alias("option"))


@query(
    "X20_resolve_option",
    f"""
    SELECT k, CASE WHEN (base IS NULL OR trim(base) = '' OR lower(trim(base)) = 'other')
                    AND option IS NOT NULL AND trim(option) <> '' THEN option ELSE base END AS answer
    FROM {ANSWERS_SQL}
    """,
)
def options(t):
    return _answers(t).select("k", resolve_option("base", "option").alias("answer"))


@query(
    "X19_fill_blank",
    f"""
    SELECT c.k, CASE WHEN c.v IS NULL OR trim(c.v) = '' THEN a.base ELSE c.v END AS v, a.option AS extra
    FROM (SELECT CAST(c_custkey AS VARCHAR) AS k, CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN ' '
                 ELSE c_mktsegment END AS v FROM customer) c
    LEFT JOIN {ANSWERS_SQL} a ON a.k = c.k
    """,
)
def fill_blank(t):
    segment = F.col("c_mktsegment")
    v = F.when(segment == "MACHINERY", " ").when(segment != "BUILDING", segment)
    customers = t.customer.select(F.col("c_custkey").cast("string").alias("k"), v.alias("v"))
    joined = skew_join(customers, _answers(t), "k")
    filled = fill_if_blank(fill_if_blank(joined, "v", "base"), "extra", "option")
    return filled.select("k", "v", "extra")


@query(
    "J14_collated_join",
    "SELECT o_orderkey, c_custkey FROM orders JOIN customer ON lower(rtrim('Customer ' || o_custkey || '  ')) = lower('CUSTOMER ' || c_custkey)",
)
def collated_join(t):
    """Keys compared without regard to case and trailing blanks, by the join itself."""
    orders = t.orders.select("o_orderkey", collated(F.concat(F.lit("Customer "), "o_custkey", F.lit("  "))).alias("k"))
    customers = t.customer.select("c_custkey", collated(F.concat(F.lit("CUSTOMER "), "c_custkey")).alias("k"))
    return orders.join(customers, "k").select("o_orderkey", "c_custkey")
