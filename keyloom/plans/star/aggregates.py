"""Rollups, distinct counts, profiles, duplicates, ranks and limits."""

from pyspark.sql import functions as F

from keyloom.functions.rules import money, percent_text
from keyloom.operators.dedupe import (
    repeated_keys,
    duplicate_count,
    duplicate_report,
    keep_one,
    ordinal,
    split_by_key,
    whole_row_distinct,
)
from keyloom.functions.text import clean_digits, collated, collation_key
from keyloom.operators.matching import existence_flags, skew_join
from keyloom.operators.quality import fill_profile, null_ratios, readiness
from keyloom.operators.usage import closed_periods, monthly_usage
from keyloom.plans.star.registry import query
from keyloom.sources.snapshots import refresh_counts

USAGE_SQL = """
    SELECT o_custkey AS user_name, l_returnflag AS job_type, sum(c) AS total_color_pages, sum(t - c) AS total_grayscale_pages,
           sum(c + (t - c)) AS total_pages, CAST(sum(c) * 4.82 AS DOUBLE) AS total_cost_color_pages,
           CAST(sum(t - c) * 0.48 AS DOUBLE) AS total_cost_grayscale_pages,
           CAST(sum(c) * 4.82 + sum(t - c) * 0.48 AS DOUBLE) AS total_cost_pages,
           year(d) AS usage_calendar_year, month(d) AS usage_calendar_month,
           year(d + INTERVAL 3 MONTH) AS usage_budget_year, month(d + INTERVAL 3 MONTH) AS usage_budget_month_order
    FROM (SELECT l_orderkey, l_returnflag, CAST(nullif(l_quantity, 13) AS DECIMAL(18,2)) AS c,
                 CAST(l_quantity + l_linenumber AS DECIMAL(18,2)) AS t, l_shipdate AS d FROM lineitem)
    JOIN orders ON o_orderkey = l_orderkey
    GROUP BY user_name, job_type, usage_calendar_year, usage_calendar_month, usage_budget_year, usage_budget_month_order
"""


def usage(t):
    """Lines as usage log, orders as users: pages by customer, flag and month."""
    log = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_returnflag").alias("job_type"),
        money(F.nullif("l_quantity", F.lit(13.0))).alias("c"),
        money(F.col("l_quantity") + F.col("l_linenumber")).alias("t"),
        F.col("l_shipdate").alias("d"),
    )
    users = t.orders.select("o_orderkey", F.col("o_custkey").alias("user_name"))
    df = monthly_usage(log, users, "o_orderkey", ["job_type"], ["user_name"], "c", "t", "d")
    costs = ("total_cost_color_pages", "total_cost_grayscale_pages", "total_cost_pages")
    return df.withColumns({c: F.col(c).cast("double") for c in costs})


@query("A1_usage_rollup", USAGE_SQL)
def usage_rollup(t):
    return usage(t)


@query(
    "A1_closed_periods",
    f"SELECT * FROM ({USAGE_SQL}) WHERE usage_calendar_year * 12 + usage_calendar_month < 1999 * 12 + 4",
)
def usage_closed(t):
    return closed_periods(usage(t), 1999, 4)


READY_SQL = """
    (SELECT count(DISTINCT c_custkey) AS total,
            count(DISTINCT CASE WHEN nullif(trim(code), '') IS NOT NULL THEN c_custkey END) AS matched
     FROM customer LEFT JOIN (SELECT o_custkey, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 300000 THEN o_orderpriority
                                                     WHEN o_orderstatus = 'F' THEN '  ' END AS code FROM orders) o
     ON o_custkey = c_custkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE'))
"""


@query(
    "A2_readiness",
    f"""
    SELECT total, matched, round(CAST(matched AS DOUBLE) / total, 4) AS ratio,
           CASE WHEN total > 0 AND CAST(matched AS DOUBLE) / total >= 0.9 THEN 1 ELSE 0 END AS ready FROM {READY_SQL}
    """,
)
def ready(t):
    finished = F.col("o_orderstatus") == "F"
    code = F.when(finished & (F.col("o_totalprice") > 300000), F.col("o_orderpriority")).when(finished, "  ")
    codes = existence_flags(
        t.orders.select(F.col("o_custkey").alias("c_custkey"), code.alias("code")),
        "c_custkey",
        {"has_code": F.trim("code") != ""},
    )
    customers = t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "FURNITURE"))
    joined = customers.select("c_custkey").join(codes, "c_custkey", "left")
    return readiness(joined, "c_custkey", F.col("has_code"), 0.9).withColumn("ready", F.col("ready").cast("int"))


@query(
    "A3_ratio_text",
    f"SELECT printf('%.1f%%', 100.0 * matched / total) AS share FROM {READY_SQL}",
)
def ratio_text(t):
    return ready(t).select(percent_text(F.col("matched") / F.col("total")).alias("share"))


@query("A4_distinct_count", "SELECT count(*) AS rows FROM (SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem)")
def distinct_rows(t):
    return t.lineitem.select("l_partkey", "l_suppkey", "l_returnflag").distinct().agg(F.count("*").alias("rows"))


@query(
    "A5_dup_report",
    """
    SELECT k, count(*) AS rows, concat_ws(',',
        CASE WHEN count(DISTINCT coalesce(o_orderstatus, '~NULL~')) > 1 THEN 'o_orderstatus' END,
        CASE WHEN count(DISTINCT coalesce(p, '~NULL~')) > 1 THEN 'p' END,
        CASE WHEN count(DISTINCT y) > 1 THEN 'y' END) AS differing
    FROM (SELECT o_custkey AS k, o_orderstatus, nullif(o_orderpriority, '5-LOW') AS p, year(o_orderdate) AS y FROM orders)
    GROUP BY k HAVING count(*) > 1
    """,
)
def duplicates(t):
    df = t.orders.select(
        F.col("o_custkey").alias("k"),
        "o_orderstatus",
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("p"),
        F.year("o_orderdate").alias("y"),
    )
    return duplicate_report(df, "k").withColumn("differing", F.array_join("differing", ","))


def _profiled(t):
    """Orders with NULL and blank values."""
    return t.orders.select(
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.replace("o_orderpriority", F.lit("2-HIGH"), F.lit(" "))).alias("priority"),
        F.when(F.year("o_orderdate") > 1996, F.col("o_totalprice")).alias("price"),
        F.col("o_custkey").alias("customer"),
    )


PROFILED_SQL = """
    (SELECT nullif(o_orderstatus, 'P') AS status,
            CASE WHEN o_orderpriority <> '5-LOW' THEN replace(o_orderpriority, '2-HIGH', ' ') END AS priority,
            CASE WHEN year(o_orderdate) > 1996 THEN o_totalprice END AS price, o_custkey AS customer FROM orders)
"""


def _per_column(sql):
    return " UNION ALL ".join(sql.format(c=c, source=PROFILED_SQL) for c in ("status", "priority", "price", "customer"))


@query(
    "A6_fill_profile",
    _per_column(
        """
    SELECT '{c}' AS "column", count(*) AS rows, count_if({c} IS NOT NULL AND trim(CAST({c} AS VARCHAR)) <> '') AS filled,
           count_if({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '') AS empty,
           round(100.0 * count_if({c} IS NOT NULL AND trim(CAST({c} AS VARCHAR)) <> '') / count(*), 1) AS percent FROM {source}
    """
    ),
)
def profile(t):
    return fill_profile(_profiled(t))


@query(
    "A7_null_ratio",
    _per_column(
        """
    SELECT '{c}' AS "column", count(*) - count({c}) AS nulls, count(*) AS rows,
           round((count(*) - count({c})) / CAST(count(*) AS DOUBLE), 4) AS ratio FROM {source}
    """
    ),
)
def ratios(t):
    return null_ratios(_profiled(t), ["status", "priority", "price", "customer"])


@query("A8_counts", "SELECT count(*) AS rows, count(DISTINCT user_id) AS distinct_keys FROM events")
def counts(t):
    return refresh_counts(t.events, "user_id").select("rows", "distinct_keys")


@query(
    "A10_duplicate_count",
    "SELECT sum(n - 1) AS duplicates FROM (SELECT nullif(l_partkey, 5) AS k, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)",
)
def repeats(t):
    df = t.lineitem.select(F.nullif(F.col("l_partkey"), F.lit(5)).alias("k"), "l_linenumber")
    return duplicate_count(df, ["k", "l_linenumber"])


PRIORITY_SQL = """
    SELECT o_orderkey, kind FROM (
      SELECT o_orderkey, CASE WHEN l_returnflag = 'R' THEN 'lump' ELSE 'credit' END AS kind, row_number() OVER (
        PARTITION BY o_orderkey ORDER BY CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS rn
      FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey) WHERE rn = 1
"""


@query("W1_priority_pick", PRIORITY_SQL)
def priority_pick(t):
    """Rank form: the credit line of an order before its lump-sum lines."""
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag")
    joined = t.orders.select("o_orderkey").join(lines, "o_orderkey", "left")
    is_lump = F.coalesce(F.col("l_returnflag") == "R", F.lit(False))
    tagged = joined.select("o_orderkey", F.when(is_lump, "lump").otherwise("credit").alias("kind"))
    return keep_one(tagged, ["o_orderkey"], [F.col("kind").asc()], total=False)


@query("W1_priority_flags", PRIORITY_SQL)
def priority_flags(t):
    """Flag form: the same rows without fanning out."""
    returned = F.col("l_returnflag") == "R"
    flags = existence_flags(t.lineitem, "l_orderkey", {"lump": returned, "other": ~returned})
    joined = t.orders.select("o_orderkey").join(flags.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left")
    only_lump = F.coalesce(F.col("lump") & ~F.col("other"), F.lit(False))
    return joined.select("o_orderkey", F.when(only_lump, "lump").otherwise("credit").alias("kind"))


@query(
    "W2_dedupe",
    """
    SELECT o_custkey, o_orderstatus, o_orderkey, price FROM (
      SELECT o_custkey, o_orderstatus, o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price, row_number() OVER (
        PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1
    """,
)
def dedupe(t):
    df = t.orders.select("o_custkey", "o_orderstatus", "o_orderkey", money("o_totalprice").alias("price"))
    return keep_one(df, ["o_custkey", "o_orderstatus"], [])


@query(
    "W4_row_number",
    """
    SELECT o_orderkey, row_number() OVER (ORDER BY o_custkey, o_orderstatus, o_orderpriority DESC, o_orderkey) AS row_order
    FROM orders
    """,
)
def row_numbers(t):
    df = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    order = [F.col("o_custkey"), F.col("o_orderstatus"), F.col("o_orderpriority").desc(), F.col("o_orderkey")]
    return ordinal(df, order).select("o_orderkey", "row_order")


@query("O1_final_order", "SELECT c_custkey, c_mktsegment, c_nationkey FROM customer ORDER BY c_mktsegment, c_nationkey DESC, c_custkey")
def final_order(t):
    return t.customer.select("c_custkey", "c_mktsegment", "c_nationkey").orderBy(
        "c_mktsegment", F.desc("c_nationkey"), "c_custkey"
    )


LATEST_EVENT_SQL = """
    SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {order}) AS rn
    FROM (SELECT *, CASE WHEN event_type <> 'error' THEN value END AS v FROM events)) WHERE rn = 1
"""


@query("O2_null_last_order", LATEST_EVENT_SQL.format(order="v DESC NULLS LAST, event_id DESC"))
def null_last(t):
    df = t.events.withColumn("v", F.when(F.col("event_type") != "error", F.col("value")))
    kept = keep_one(df, ["user_id"], [F.col("v").desc_nulls_last(), F.col("event_id").desc()], total=False)
    return kept.select("user_id", "event_id", "event_type")


@query(
    "O4_topk",
    "SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
)
def top_orders(t):
    top = t.orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)
    return top.select("o_orderkey", money("o_totalprice").alias("price"))


@query("D1_keep_last", LATEST_EVENT_SQL.format(order="event_id DESC"))
def keep_last(t):
    df = t.events.select("user_id", "event_id", "event_type")
    return keep_one(df, ["user_id"], [F.col("event_id").desc()])


@query(
    "D2_keep_last_sorted",
    """
    SELECT o_custkey, o_orderkey, y FROM (
      SELECT o_custkey, o_orderkey, y, row_number() OVER (PARTITION BY o_custkey ORDER BY y DESC NULLS FIRST, p DESC, o_orderkey DESC) AS rn
      FROM (SELECT o_custkey, o_orderkey, nullif(year(o_orderdate), 1997) AS y, o_orderpriority AS p FROM orders)) WHERE rn = 1
    """,
)
def keep_last_sorted(t):
    """Last after an ascending sort with NULL at the end."""
    df = t.orders.select(
        "o_custkey", "o_orderkey", F.nullif(F.year("o_orderdate"), F.lit(1997)).alias("y"), "o_orderpriority"
    )
    order = [F.col("y").desc_nulls_first(), F.col("o_orderpriority").desc(), F.col("o_orderkey").desc()]
    return keep_one(df, ["o_custkey"], order, total=False).select("o_custkey", "o_orderkey", "y")


@query(
    "D3_keep_latest",
    """
    SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (
      PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderpriority DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1
    """,
)
def keep_latest(t):
    order = [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderpriority").desc(), F.col("o_orderkey").desc()]
    df = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority")
    return keep_one(df, ["o_custkey"], order, total=False).drop("o_orderpriority")


@query("D4_distinct", "SELECT DISTINCT o_custkey, o_orderstatus, nullif(o_orderpriority, '5-LOW') AS p FROM orders")
def distinct(t):
    p = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("p")
    return whole_row_distinct(t.orders.select("o_custkey", "o_orderstatus", p))


KEY_TEXT_SQL = """
    (SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN ' ' || p_partkey WHEN 'SMALL' THEN p_name WHEN 'PROMO' THEN NULL
            ELSE p_partkey || chr(8203) END AS k FROM part)
"""


def _key_text(t):
    kind, key = F.col("p_type"), F.col("p_partkey").cast("string")
    k = (
        F.when(kind == "ECONOMY", F.concat(F.lit(" "), key))
        .when(kind == "SMALL", F.col("p_name"))
        .when(kind != "PROMO", F.concat(key, F.lit("\u200b")))
    )
    return t.part.select("p_partkey", k.alias("k"))


@query(
    "D6_drop_bad_keys",
    f"SELECT p_partkey, regexp_replace(k, '[\\s\\x{{200B}}]', '', 'g') AS k FROM {KEY_TEXT_SQL} "
    "WHERE regexp_full_match(regexp_replace(k, '[\\s\\x{200B}]', '', 'g'), '[0-9]+')",
)
def good_keys(t):
    return split_by_key(_key_text(t), "k", clean_digits("k"))[0]


@query(
    "D6_rejected_keys",
    f"SELECT p_partkey, k FROM {KEY_TEXT_SQL} "
    "WHERE k IS NULL OR NOT regexp_full_match(regexp_replace(k, '[\\s\\x{200B}]', '', 'g'), '[0-9]+')",
)
def bad_keys(t):
    return split_by_key(_key_text(t), "k", clean_digits("k"))[1]


@query(
    "D5_duplicate_keys",
    "SELECT o_custkey, count(*) AS rows FROM orders GROUP BY 1 HAVING count(*) > 1 ORDER BY rows DESC, o_custkey",
)
def duplicate_keys(t):
    """All offenders of a failing uniqueness check, most repeated first."""
    return repeated_keys(t.orders, ["o_custkey"]).orderBy(F.desc("rows"), "o_custkey")


@query(
    "L5_repeated_source_keys",
    "SELECT trim(k) AS k, count(*) AS rows FROM (SELECT CASE WHEN o_orderkey % 2 = 0 THEN ' ' || o_custkey ELSE o_custkey || '  ' END AS k "
    "FROM orders) GROUP BY 1 HAVING count(*) > 1",
)
def repeated_source_keys(t):
    """Keys that a guarded load refuses: they repeat once blanks around them are gone."""
    text = F.col("o_custkey").cast("string")
    padded = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit(" "), text)).otherwise(F.concat(text, F.lit("  ")))
    return repeated_keys(t.orders.select(padded.alias("k")), ["k"], trim=True)


@query(
    "J1_rollup_by_nation",
    """
    SELECT n_name, year(l_shipdate) AS y, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total FROM lineitem
    JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY 1, 2
    """,
)
def by_nation(t):
    per_supplier = t.lineitem.groupBy(F.col("l_suppkey").alias("s_suppkey"), F.year("l_shipdate").alias("y")).agg(
        F.sum(money("l_extendedprice")).alias("s")
    )
    suppliers = t.supplier.select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    placed = skew_join(per_supplier, suppliers, "s_suppkey", "inner")
    sums = placed.groupBy("n_nationkey", "y").agg(F.sum("s").alias("total"))
    return skew_join(sums, t.nation.select("n_nationkey", "n_name"), "n_nationkey", "inner").select("n_name", "y", "total")


@query(
    "D1_collated_keep_last",
    """
    SELECT lower(rtrim(k)) AS k, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY lower(rtrim(k)) ORDER BY o_orderkey DESC) AS rn FROM (
      SELECT CASE o_orderstatus WHEN 'F' THEN 'Clerk-' WHEN 'O' THEN 'CLERK-' ELSE 'clerk-' END || o_custkey
             || CASE WHEN o_orderkey % 2 = 0 THEN '  ' ELSE '' END AS k, o_orderkey FROM orders)) WHERE rn = 1
    """,
)
def collated_keep_last(t):
    """One row per key where case and trailing blanks make no key of their own."""
    status = F.col("o_orderstatus")
    head = F.when(status == "F", "Clerk-").when(status == "O", "CLERK-").otherwise("clerk-")
    key = F.concat(head, F.col("o_custkey").cast("string"), F.when(F.col("o_orderkey") % 2 == 0, "  ").otherwise(""))
    one = keep_one(t.orders.select(collated(key).alias("k"), "o_orderkey"), ["k"], [F.col("o_orderkey").desc()], total=False)
    return one.select(collation_key("k").cast("string").alias("k"), "o_orderkey")
