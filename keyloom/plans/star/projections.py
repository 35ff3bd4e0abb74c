"""Scans, projections, predicates and column alignment."""

from pyspark.sql import functions as F

from keyloom.functions.dates import ingestion_date
from keyloom.functions.rules import band, code_map, money
from keyloom.functions.schema import align_columns, normalize_columns, wanted_columns, widen
from keyloom.functions.text import blank_to_null, clean_id, scrub_missing
from keyloom.plans.star.registry import query
from keyloom.sources.keyed_table import usable_key

STATUS_LABELS = {"F": "finished", "O": "open"}
PRIORITY_LABELS = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium"}
TYPE_LABELS = {"ECONOMY": "Basic", "SMALL": "Basic", "PROMO": "Not Specified"}
OVERRIDE_CUSTOMERS = (1, 7, 42)


@query(
    "S1_scan",
    """
    SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price
    FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1997-01-01'
    """,
)
def scan(t):
    df = t.orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")))
    return df.select("o_orderkey", "o_custkey", money("o_totalprice").alias("price"))


@query(
    "S3_wanted_columns",
    "SELECT p_partkey, p_brand, p_size FROM part",
)
def wanted(t):
    return wanted_columns(t.part, "p_partkey", ["p_partkey", "p_brand", "p_size", "p_container"])[0]


@query(
    "S7_widen_target",
    """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
           CAST(NULL AS VARCHAR) AS s_suppkey, CAST(NULL AS VARCHAR) AS s_name FROM customer
    """,
)
def widen_target(t):
    source = t.supplier.select("s_suppkey", "s_name", F.col("s_nationkey").alias("C_NATIONKEY"))
    return widen(t.customer, source)


@query(
    "S8_purge_keys",
    """
    SELECT k, p_brand FROM (
      SELECT CASE p_type WHEN 'ECONOMY' THEN '  ' WHEN 'SMALL' THEN p_name WHEN 'PROMO' THEN NULL
                         ELSE CAST(p_partkey AS VARCHAR) END AS k, p_brand FROM part)
    WHERE k IS NOT NULL AND trim(k) <> '' AND regexp_full_match(k, '[0-9]+')
    """,
)
def purge(t):
    key = (
        F.when(F.col("p_type") == "ECONOMY", "  ")
        .when(F.col("p_type") == "SMALL", F.col("p_name"))
        .when(F.col("p_type") != "PROMO", F.col("p_partkey").cast("string"))
    )
    return t.part.select(key.alias("k"), "p_brand").filter(usable_key("k", digits_only=True))


@query(
    "P1_code_map",
    """
    SELECT CASE WHEN o_orderstatus = 'F' THEN 'finished' WHEN o_orderstatus = 'O' THEN 'open' ELSE 'other' END AS status,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent' WHEN o_orderpriority = '2-HIGH' THEN 'high'
                WHEN o_orderpriority = '3-MEDIUM' THEN 'medium' END AS priority,
           count(*) AS orders, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
    FROM orders GROUP BY 1, 2
    """,
)
def code_maps(t):
    status = code_map("o_orderstatus", STATUS_LABELS, "other").alias("status")
    priority = code_map("o_orderpriority", PRIORITY_LABELS).alias("priority")
    return t.orders.groupBy(status, priority).agg(F.count("*").alias("orders"), F.sum(money("o_totalprice")).alias("total"))


@query(
    "P2_relabel",
    """
    SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN 'Basic' WHEN p_type = 'PROMO' THEN 'Not Specified'
                           ELSE p_type END AS label FROM part
    """,
)
def relabel(t):
    label = F.coalesce(code_map("p_type", TYPE_LABELS).cast("string"), F.col("p_type"))
    return t.part.select("p_partkey", label.alias("label"))


@query(
    "P3_key_override",
    """
    SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'M'
                           WHEN c_mktsegment = 'BUILDING' OR c_custkey IN (1, 7, 42) THEN 'B' ELSE '-' END AS label
    FROM customer
    """,
)
def key_override(t):
    by_hand = F.col("c_custkey").isin(*OVERRIDE_CUSTOMERS)
    segment = F.col("c_mktsegment")
    label = F.when(segment == "MACHINERY", "M").when((segment == "BUILDING") | by_hand, "B").otherwise("-")
    return t.customer.select("c_custkey", label.alias("label"))


@query(
    "P4_case_priority",
    """
    SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'rush' WHEN o_orderstatus = 'F' THEN 'finished'
                WHEN o_orderstatus = 'O' THEN 'open' ELSE 'other' END AS label, count(*) AS orders
    FROM orders GROUP BY 1
    """,
)
def case_priority(t):
    rush = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "rush")
    return t.orders.groupBy(code_map("o_orderstatus", STATUS_LABELS, "other", rush).alias("label")).agg(
        F.count("*").alias("orders")
    )


@query(
    "P5_banding",
    """
    SELECT l_linestatus, CASE WHEN c <= 36 THEN 1 WHEN c BETWEEN 37 AND 70 THEN 2 WHEN c BETWEEN 71 AND 105 THEN 3
                              WHEN c > 105 THEN 4 ELSE 1 END AS class, count(*) AS lines, min(c) AS lowest, max(c) AS highest
    FROM (SELECT l_linestatus, l_extendedprice / 1000.0 AS c FROM lineitem) GROUP BY 1, 2
    """,
)
def banding(t):
    df = t.lineitem.select("l_linestatus", (F.col("l_extendedprice") / F.lit(1000.0)).alias("c"))
    label = band("c", [(None, 36, 1), (37, 70, 2), (71, 105, 3)], (105, 4), 1)
    return df.groupBy("l_linestatus", label.alias("class")).agg(
        F.count("*").alias("lines"), F.min("c").alias("lowest"), F.max("c").alias("highest")
    )


@query(
    "P6_blank_to_null",
    """
    SELECT c_custkey, CASE WHEN v IS NULL OR trim(v) = '' THEN NULL ELSE v END AS v FROM (
      SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN '   ' WHEN 'MACHINERY' THEN ' ' || c_name
                        WHEN 'FURNITURE' THEN '' ELSE c_mktsegment END AS v FROM customer)
    """,
)
def blanks(t):
    segment = F.col("c_mktsegment")
    v = (
        F.when(segment == "BUILDING", "   ")
        .when(segment == "MACHINERY", F.concat(F.lit(" "), "c_name"))
        .when(segment == "FURNITURE", "")
        .otherwise(segment)
    )
    return t.customer.select("c_custkey", blank_to_null(v).alias("v"))


@query(
    "P7_constants",
    "SELECT o_orderkey, 'IC' AS faculty, CAST(NULL AS VARCHAR) AS remark, 1 AS class FROM orders",
)
def constants(t):
    return t.orders.select(
        "o_orderkey",
        F.lit("IC").alias("faculty"),
        F.lit(None).cast("string").alias("remark"),
        F.lit(1).alias("class"),
    )


@query(
    "P8_string_range",
    "SELECT o_orderkey FROM orders WHERE CAST(o_orderkey AS VARCHAR) >= '50%' AND CAST(o_orderkey AS VARCHAR) < '90%'",
)
def string_range(t):
    code = F.col("o_orderkey").cast("string")
    return t.orders.filter((code >= "50%") & (code < "90%")).select("o_orderkey")


@query(
    "P9_in_list",
    """
    SELECT o_orderkey, o_orderpriority FROM orders
    WHERE o_orderstatus IN ('F', 'P') AND year(o_orderdate) >= 1998 AND o_orderpriority IN ('1-URGENT', '3-MEDIUM')
    """,
)
def in_list(t):
    # The year test as a bound on the date, so that it reaches the scan.
    recent = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    wanted_rows = F.col("o_orderstatus").isin("F", "P") & F.col("o_orderpriority").isin("1-URGENT", "3-MEDIUM")
    return t.orders.filter(recent & wanted_rows).select("o_orderkey", "o_orderpriority")


@query(
    "P10_three_valued",
    """
    SELECT o_orderkey FROM (
      SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'F' THEN 1 END AS a,
             CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '4-NOT SPECIFIED' THEN NULL ELSE 1 END AS b,
             nullif(o_custkey, 7) AS k FROM orders)
    WHERE NOT (a = 0 AND b = 0) AND NOT k = 11
    """,
)
def three_valued(t):
    priority = F.col("o_orderpriority")
    df = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", 0).when(F.col("o_orderstatus") == "F", 1).alias("a"),
        F.when(priority == "5-LOW", 0).when(priority != "4-NOT SPECIFIED", 1).alias("b"),
        F.nullif(F.col("o_custkey"), F.lit(7)).alias("k"),
    )
    return df.filter(~((F.col("a") == 0) & (F.col("b") == 0)) & ~(F.col("k") == 11)).select("o_orderkey")


@query(
    "P11_prefix_like",
    """
    SELECT CASE WHEN n LIKE 'small%' THEN 'lump' ELSE 'credit' END AS kind, count(*) AS parts
    FROM (SELECT CASE WHEN p_type <> 'PROMO' THEN p_name END AS n FROM part) GROUP BY 1
    """,
)
def prefix_like(t):
    name = F.when(F.col("p_type") != "PROMO", F.col("p_name"))
    kind = F.when(name.startswith("small"), "lump").otherwise("credit")
    return t.part.groupBy(kind.alias("kind")).agg(F.count("*").alias("parts"))


@query("P12_column_subset", "SELECT s_name, s_suppkey FROM supplier")
def column_subset(t):
    return t.supplier.select("s_name", "s_suppkey")


@query(
    "P13_align_columns",
    'SELECT c_custkey AS "C CustKey", c_mktsegment AS "C MktSegment", c_name AS "C_NAME" FROM customer',
)
def align(t):
    target = ["C CustKey", "C MktSegment", "C_NAME", "C Phone"]
    return align_columns(t.customer.withColumnRenamed("c_custkey", "c custkey"), target).frame


@query(
    "P14_key_filter",
    """
    SELECT c_custkey, k FROM (
      SELECT c_custkey, regexp_replace(trim(CASE c_mktsegment WHEN 'BUILDING' THEN 'nan' WHEN 'MACHINERY' THEN NULL
             WHEN 'FURNITURE' THEN c_custkey || '.0 ' ELSE ' ' || c_custkey END), '\\.0$', '') AS k FROM customer)
    WHERE k IS NOT NULL AND k <> 'nan'
    """,
)
def key_filter(t):
    segment, key = F.col("c_mktsegment"), F.col("c_custkey").cast("string")
    raw = (
        F.when(segment == "BUILDING", "nan")
        .when(segment == "FURNITURE", F.concat(key, F.lit(".0 ")))
        .when(segment != "MACHINERY", F.concat(F.lit(" "), key))
    )
    return t.customer.select("c_custkey", clean_id(raw).alias("k")).filter("k is not null")


@query(
    "P16_null_markers",
    """
    SELECT e.event_id, CASE WHEN m IN ('None', 'nan', 'NaT') THEN NULL ELSE m END AS m FROM (
      SELECT event_id, CASE event_type WHEN 'error' THEN 'None' WHEN 'view' THEN 'nan' WHEN 'click' THEN 'NaT'
                       ELSE event_type END AS m FROM events) e
    """,
)
def null_markers(t):
    kind = F.col("event_type")
    marked = F.when(kind == "error", "None").when(kind == "view", "nan").when(kind == "click", "NaT").otherwise(kind)
    return t.events.select("event_id", scrub_missing(marked).alias("m"))


@query(
    "P17_load_columns",
    "SELECT s_suppkey AS student_id, s_suppkey AS code, '2024-03-02' AS ingestion_date FROM supplier",
)
def load_columns(t):
    run_ts = F.lit("2024-03-01 18:30:00").cast("timestamp_ntz")
    # 18:30 UTC is the next day in local time.
    day = F.date_format(ingestion_date(run_ts), "yyyy-MM-dd")
    return t.supplier.select(F.col("s_suppkey").alias("student_id"), F.col("s_suppkey").alias("code"), day.alias("ingestion_date"))


@query(
    "S6_normalized_names",
    'SELECT n_nationkey AS nation_key, n_name AS nation_name, n_regionkey AS region_key FROM nation',
)
def normalized_names(t):
    return normalize_columns(t.nation.toDF(" Nation Key", "NATION-NAME ", "Region_Key"))


