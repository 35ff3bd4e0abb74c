"""Keyed loads, change records, run summaries, checks and invoice settlement over the star tables."""

from pyspark.sql import functions as F

from keyloom.functions.rules import code_map, money
from keyloom.functions.text import clean_digits, clean_email
from keyloom.operators import audit
from keyloom.operators.dedupe import keep_one, split_by_key
from keyloom.operators.keyed_load import (
    apply_changes,
    change_rows,
    change_set,
    exact,
    guarded,
    insert_only,
    load_counts,
    overwrite,
    update_samples,
    upsert,
)
from keyloom.operators.matching import skew_join
from keyloom.operators.quality import Expectations, empty_samples, fill_profile, issues
from keyloom.operators.settlement import CREDIT_TYPE, LUMP_SUM_TYPE, settle
from keyloom.plans import printer_usage
from keyloom.plans.fixed_values import REGISTRATION_TYPES
from keyloom.plans.runs import report_row, run_job
from keyloom.plans.star.aggregates import PROFILED_SQL, READY_SQL, USAGE_SQL, _profiled, usage
from keyloom.plans.star.aggregates import ready as readiness_row
from keyloom.plans.star.registry import ORACLE, query
from keyloom.session import materialize, new_run_folder
from keyloom.sources.audit_log import read_events
from keyloom.sources.keyed_table import KeyedTable
from keyloom.sources.ledger import RunLedger
from keyloom.sources.quoted import read_quoted_export
from keyloom.sources.snapshots import REPLACED, SnapshotTable, blank_values_to_null, refresh_counts

CUTOFF = "1996-01-01"


def _cutoff():
    return F.lit(CUTOFF).cast("timestamp_ntz")


# --- guarded upsert: the customers' state before the cut-off, updated from the orders after it ---

NEWEST_SQL = """
    (SELECT o_custkey, o_orderstatus, o_orderpriority, o_totalprice FROM (SELECT *, row_number() OVER (
       PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders WHERE o_orderdate {op} TIMESTAMP '1996-01-01') WHERE rn = 1)
"""
GUARDED_SQL = f"""
    WITH t AS (SELECT CAST(o_custkey AS VARCHAR) AS k, o_orderstatus AS status, o_orderpriority AS note,
                      CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END AS extra,
                      CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM {NEWEST_SQL.format(op="<")}),
         s AS (SELECT ' ' || o_custkey || ' ' AS k, o_orderstatus AS status,
                      CASE o_orderpriority WHEN '1-URGENT' THEN '  ' WHEN '2-HIGH' THEN chr(160) || lower(o_orderpriority) || chr(9)
                           ELSE o_orderpriority END AS note,
                      CASE WHEN o_orderstatus = 'P' THEN '' ELSE lower(o_orderpriority) END AS extra FROM {NEWEST_SQL.format(op=">=")}),
         j AS (SELECT t.k AS tk, s.k AS sk, t.status AS t1, t.note AS t2, t.extra AS t3, t.price,
                      nullif(trim(translate(s.status, chr(160) || chr(9), '  ')), '') AS s1,
                      nullif(trim(translate(s.note, chr(160) || chr(9), '  ')), '') AS s2,
                      nullif(trim(translate(s.extra, chr(160) || chr(9), '  ')), '') AS s3
               FROM t FULL JOIN s ON trim(t.k) = trim(s.k)),
         m AS (SELECT *, tk IS NULL AS ins,
                      CASE WHEN s1 IS NULL OR lower(s1) = lower(coalesce(trim(t1), '')) THEN t1 ELSE s1 END AS n1,
                      CASE WHEN s2 IS NULL OR lower(s2) = lower(coalesce(trim(t2), '')) THEN t2 ELSE s2 END AS n2,
                      CASE WHEN s3 IS NULL OR lower(s3) = lower(coalesce(trim(t3), '')) THEN t3 ELSE s3 END AS n3 FROM j)
"""


def _newest(t, later: bool):
    side = F.col("o_orderdate") >= _cutoff() if later else F.col("o_orderdate") < _cutoff()
    columns = ["o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"]
    return keep_one(t.orders.filter(side).select(*columns), ["o_custkey"], [F.col("o_orderkey").desc()], total=False)


def _guarded_sides(t):
    key, status, priority = F.col("o_custkey").cast("string"), F.col("o_orderstatus"), F.col("o_orderpriority")
    target = _newest(t, later=False).select(
        key.alias("k"),
        status.alias("status"),
        priority.alias("note"),
        F.when(status != "F", status).alias("extra"),
        money("o_totalprice").alias("price"),
    )
    note = (
        F.when(priority == "1-URGENT", "  ")
        .when(priority == "2-HIGH", F.concat(F.lit(" "), F.lower(priority), F.lit("\t")))
        .otherwise(priority)
    )
    source = _newest(t, later=True).select(
        F.concat(F.lit(" "), key, F.lit(" ")).alias("K"),
        status.alias("Status"),
        note.alias("NOTE"),
        F.when(status == "P", "").otherwise(F.lower(priority)).alias("extra"),
        F.lit("not in the target").alias("unknown"),
        F.lit("1").alias("_row_order"),
    )
    return target, source, guarded("k")


@query(
    "L1_guarded_upsert",
    GUARDED_SQL
    + "SELECT coalesce(tk, sk) AS k, CASE WHEN ins THEN s1 ELSE n1 END AS status, CASE WHEN ins THEN s2 ELSE n2 END AS note, "
    "CASE WHEN ins THEN s3 ELSE n3 END AS extra, price FROM m",
)
def guarded_upsert(t):
    return upsert(*_guarded_sides(t))


@query(
    "L1_guarded_from_changes",
    GUARDED_SQL
    + "SELECT coalesce(tk, sk) AS k, CASE WHEN ins THEN s1 ELSE n1 END AS status, CASE WHEN ins THEN s2 ELSE n2 END AS note, "
    "CASE WHEN ins THEN s3 ELSE n3 END AS extra, price FROM m",
)
def guarded_from_changes(t):
    """The same table from the change set, the form large tables are loaded with."""
    target, source, rule = _guarded_sides(t)
    return apply_changes(target, change_set(target, source, rule), rule)


@query(
    "L6_changes",
    GUARDED_SQL
    + """
    SELECT tk AS key, field, old, new FROM (
      SELECT tk, 'status' AS field, t1 AS old, n1 AS new FROM m WHERE NOT ins UNION ALL
      SELECT tk, 'note', t2, n2 FROM m WHERE NOT ins UNION ALL SELECT tk, 'extra', t3, n3 FROM m WHERE NOT ins)
    WHERE old IS DISTINCT FROM new
    """,
)
def changes(t):
    return change_rows(change_set(*_guarded_sides(t)), "k")


GUARDED_COUNTS_SQL = """
    (SELECT count_if(ins) AS inserted,
            count_if(NOT ins AND (t1 IS DISTINCT FROM n1 OR t2 IS DISTINCT FROM n2 OR t3 IS DISTINCT FROM n3)) AS updated FROM m)
"""


@query("L7_guarded_counts", GUARDED_SQL + f"SELECT * FROM {GUARDED_COUNTS_SQL}")
def guarded_counts(t):
    target, source, rule = _guarded_sides(t)
    return load_counts(change_set(target, source, rule), rule)


@query(
    "L9_update_samples",
    GUARDED_SQL
    + """
    , d AS (SELECT tk AS key, field, old, new FROM (
      SELECT tk, 'status' AS field, t1 AS old, n1 AS new FROM m WHERE NOT ins UNION ALL
      SELECT tk, 'note', t2, n2 FROM m WHERE NOT ins UNION ALL SELECT tk, 'extra', t3, n3 FROM m WHERE NOT ins)
    WHERE old IS DISTINCT FROM new)
    SELECT * FROM d WHERE key IN (SELECT DISTINCT key FROM d ORDER BY key LIMIT 10)
    """,
)
def samples(t):
    return update_samples(change_set(*_guarded_sides(t)), "k", 10)


@query(
    "V8_run_summary",
    GUARDED_SQL
    + f"""
    SELECT 'success' AS status, 'customer state' AS subject, (SELECT count(*) FROM s) AS rows_total, inserted, updated,
           CAST(ceil((SELECT count(*) FROM s) / 1000.0) AS BIGINT) AS batches_total, 'customers' AS target_table,
           '2024-03-01 08:00:00' AS run_date FROM {GUARDED_COUNTS_SQL}
    """,
)
def summary(t):
    target, source, rule = _guarded_sides(t)
    counted = load_counts(change_set(target, source, rule), rule).withColumn(
        "rows_total", source.agg(F.count("*")).scalar()
    )
    row = audit.run_summary(counted, "customer state", "customers", "2024-03-01 08:00:00", batch_size=1000)
    return row.drop("duration_sec")


# --- overwrite upsert: order facts from the lines, updated from the orders ---

OVERWRITE_SQL = """
    WITH t AS (SELECT l_orderkey AS id, min(l_linestatus) AS status, min(l_linenumber) AS prio,
                      CASE WHEN max(l_returnflag) = 'R' THEN TIMESTAMP '1900-01-01' END AS shipped,
                      CASE WHEN min(l_linestatus) = 'F' THEN CAST(0 AS DECIMAL(18,2)) END AS amount FROM lineitem GROUP BY 1),
         s AS (SELECT o_orderkey AS id, nullif(o_orderstatus, 'P') AS status, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS prio,
                      CAST(NULL AS TIMESTAMP) AS shipped, CAST(NULL AS DECIMAL(18,2)) AS amount FROM orders),
         j AS (SELECT t.id AS tid, s.id AS sid, t.status AS t1, t.prio AS t2, t.shipped AS t3, t.amount AS t4,
                      s.status AS s1, s.prio AS s2, s.shipped AS s3, s.amount AS s4 FROM t FULL JOIN s ON t.id = s.id),
         m AS (SELECT *, tid IS NULL AS ins, tid IS NOT NULL AND sid IS NOT NULL AND
                      (coalesce(t1, '') <> coalesce(s1, '') OR coalesce(t2, 0) <> coalesce(s2, 0)) AS upd FROM j)
"""


def _overwrite_sides(t):
    no_time, no_amount = F.lit(None).cast("timestamp_ntz"), F.lit(None).cast("decimal(18,2)")
    epoch = F.lit("1900-01-01").cast("timestamp_ntz")
    per_order = t.lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.min("l_linestatus").alias("status"), F.min("l_linenumber").alias("prio"), F.max("l_returnflag").alias("flag")
    )
    target = per_order.select(
        "id",
        "status",
        "prio",
        F.when(F.col("flag") == "R", epoch).alias("shipped"),
        F.when(F.col("status") == "F", F.lit(0).cast("decimal(18,2)")).alias("amount"),
    )
    source = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("prio"),
        no_time.alias("shipped"),
        no_amount.alias("amount"),
    )
    return target, source, overwrite("id", ["status", "amount"])


@query(
    "L2_overwrite_upsert",
    OVERWRITE_SQL
    + """
    SELECT coalesce(tid, sid) AS id, CASE WHEN ins OR upd THEN s1 ELSE t1 END AS status,
           CASE WHEN ins OR upd THEN s2 ELSE t2 END AS prio,
           strftime(CASE WHEN ins OR upd THEN s3 ELSE t3 END, '%Y-%m-%d') AS shipped,
           CASE WHEN ins OR upd THEN s4 ELSE t4 END AS amount FROM m
    """,
)
def overwrite_upsert(t):
    merged = upsert(*_overwrite_sides(t))
    return merged.withColumn("shipped", F.date_format("shipped", "yyyy-MM-dd"))


@query(
    "L6_audited_columns",
    OVERWRITE_SQL
    + """
    SELECT CAST(tid AS VARCHAR) AS key, field, old, new FROM (
      SELECT tid, 'status' AS field, t1 AS old, s1 AS new FROM m WHERE upd UNION ALL
      SELECT tid, 'amount', CAST(t4 AS VARCHAR), CAST(s4 AS VARCHAR) FROM m WHERE upd) WHERE old IS DISTINCT FROM new
    """,
)
def audited_columns(t):
    return change_rows(change_set(*_overwrite_sides(t)), "id")


@query("A9_run_metrics", OVERWRITE_SQL + "SELECT count_if(ins) AS inserted, count_if(upd) AS updated FROM m")
def overwrite_counts(t):
    target, source, rule = _overwrite_sides(t)
    return load_counts(change_set(target, source, rule), rule)


# --- exact upsert: labelled documents, updated from all documents ---

EXACT_SQL = """
    WITH t AS (SELECT d.doc_id, CASE WHEN toxic = 1 THEN NULL ELSE lang END AS lang, source, n_chars AS size, 'old' AS ingestion_date
               FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
         s AS (SELECT doc_id, lang, source, length(text) AS size, 'new' AS ingestion_date FROM documents),
         m AS (SELECT t.doc_id AS tid, s.doc_id AS sid, t.lang AS t1, t.source AS t2, t.size AS t3, t.ingestion_date AS t4,
                      s.lang AS s1, s.source AS s2, s.size AS s3, s.ingestion_date AS s4,
                      t.doc_id IS NULL OR (s.doc_id IS NOT NULL AND (t.lang IS DISTINCT FROM s.lang OR t.source IS DISTINCT FROM s.source
                        OR t.size IS DISTINCT FROM s.size)) AS w FROM t FULL JOIN s ON t.doc_id = s.doc_id)
"""


def _exact_sides(t):
    documents = t.documents.select("doc_id", "lang", "source", "n_chars", "text")
    labelled = documents.drop("text").join(t.labels.select("doc_id", "toxic"), "doc_id")
    target = labelled.select(
        "doc_id",
        F.when(F.col("toxic") != 1, F.col("lang")).alias("lang"),
        "source",
        F.col("n_chars").alias("size"),
        F.lit("old").alias("ingestion_date"),
    )
    source = documents.select(
        "doc_id", "lang", "source", F.length("text").alias("size"), F.lit("new").alias("ingestion_date")
    )
    return target, source, exact("doc_id")


@query(
    "L3_exact_upsert",
    EXACT_SQL
    + """
    SELECT coalesce(tid, sid) AS doc_id, CASE WHEN w THEN s1 ELSE t1 END AS lang, CASE WHEN w THEN s2 ELSE t2 END AS source,
           CASE WHEN w THEN s3 ELSE t3 END AS size, CASE WHEN w THEN s4 ELSE t4 END AS ingestion_date FROM m
    """,
)
def exact_upsert(t):
    return upsert(*_exact_sides(t))


@query("L3_exact_counts", EXACT_SQL + "SELECT count_if(tid IS NULL) AS inserted, count_if(w AND tid IS NOT NULL) AS updated FROM m")
def exact_counts(t):
    target, source, rule = _exact_sides(t)
    return load_counts(change_set(target, source, rule), rule)


# --- insert-only: months the usage fact lacks ---

INSERT_KEYS_SQL = """
    WITH u AS (SELECT user_name, nullif(job_type, 'N') AS job_type, usage_calendar_year AS y,
                      usage_calendar_month AS m, usage_budget_year AS fy, usage_budget_month_order AS fm, total_pages AS pages
               FROM (""" + USAGE_SQL + """)),
         one AS (SELECT user_name, job_type, y, m, fy, fm, pages FROM (SELECT *, row_number() OVER (
                   PARTITION BY user_name, job_type, y, m, fy, fm ORDER BY pages DESC) AS rn FROM u) WHERE rn = 1),
         t AS (SELECT user_name, job_type, y, m, fy, fm, CAST(0 AS DECIMAL(38,2)) AS pages FROM one WHERE y * 12 + m < 1999 * 12 + 4),
         fresh AS (SELECT * FROM one o WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.user_name = o.user_name
                   AND t.job_type IS NOT DISTINCT FROM o.job_type AND t.y = o.y AND t.m = o.m AND t.fy = o.fy AND t.fm = o.fm))
"""


def _insert_sides(t):
    rows = usage(t).select(
        "user_name",
        F.nullif(F.col("job_type"), F.lit("N")).alias("job_type"),
        F.col("usage_calendar_year").alias("y"),
        F.col("usage_calendar_month").alias("m"),
        F.col("usage_budget_year").alias("fy"),
        F.col("usage_budget_month_order").alias("fm"),
        F.col("total_pages").alias("pages"),
    )
    # Both sides read the rollup: it is written once instead of being computed for each.
    source = materialize(rows, "usage")
    keys = ["user_name", "job_type", "y", "m", "fy", "fm"]
    loaded = source.filter(F.col("y") * 12 + F.col("m") < 1999 * 12 + 4)
    target = loaded.select(*keys).distinct().withColumn("pages", F.lit(0).cast("decimal(38,2)"))
    return target, source, keys


@query("L4_insert_only", INSERT_KEYS_SQL + "SELECT * FROM t UNION ALL SELECT * FROM fresh")
def insert_only_load(t):
    target, source, keys = _insert_sides(t)
    return target.unionByName(insert_only(target, source, keys))


@query("L4_inserted", INSERT_KEYS_SQL + "SELECT count(*) AS inserted FROM fresh")
def inserted(t):
    return insert_only(*_insert_sides(t)).agg(F.count("*").alias("inserted"))


# --- the same loads through a table: fill, load, load again, read back ---


def _loaded(t, target, source, rule, **options):
    table = KeyedTable(t.spark, new_run_folder(t.spark, "table"), list(rule.keys), buckets=8, **options)
    table.fill(target)
    table.load(source, rule)
    again = table.load(source, rule)  # changes nothing
    if again.inserted or again.updated:
        raise AssertionError(f"a repeated load wrote {again.inserted} and {again.updated} rows")
    return table.read()


@query("L1_table_load", ORACLE["L1_guarded_upsert"])
def guarded_table_load(t):
    target, source, rule = _guarded_sides(t)
    return _loaded(t, target, source.drop("unknown"), rule, text_keys=True)


@query("L2_table_load", ORACLE["L2_overwrite_upsert"])
def overwrite_table_load(t):
    return _loaded(t, *_overwrite_sides(t)).withColumn("shipped", F.date_format("shipped", "yyyy-MM-dd"))


@query("L3_table_load", ORACLE["L3_exact_upsert"])
def exact_table_load(t):
    return _loaded(t, *_exact_sides(t))


@query("L3_fingerprint_load", ORACLE["L3_exact_upsert"])
def fingerprint_table_load(t):
    """Wide rows are read only of buckets where keys are new or stored hashes differ."""
    return _loaded(t, *_exact_sides(t), fingerprint=["lang", "source", "size"])


@query("L4_table_append", INSERT_KEYS_SQL + "SELECT * FROM t UNION ALL SELECT * FROM fresh")
def table_append(t):
    """Month after month; a load asks only segments whose months its rows reach."""
    target, source, keys = _insert_sides(t)
    table = KeyedTable(t.spark, new_run_folder(t.spark, "table"), ["user_name"], buckets=4, ranged=["y", "m"])
    table.fill(target)
    for part in (F.col("y") < 1998, F.col("y") == 1998, F.col("y") > 1998):
        table.append_new(source.filter(part), keys)
    return table.read()


@query("S8_table_purge", "SELECT o_orderkey AS k, o_orderstatus AS status FROM orders WHERE o_orderpriority <> '5-LOW'")
def table_purge(t):
    """Rows with blank keys go, then small files are written anew; equal rows before and after."""
    key = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(" ")).otherwise(F.col("o_orderkey").cast("string"))
    rows = t.orders.select(key.alias("k"), F.col("o_orderstatus").alias("status"))
    table = KeyedTable(t.spark, new_run_folder(t.spark, "table"), ["k"], buckets=4)
    table.fill(rows)
    table.purge_bad_keys(digits_only=True)
    table.compact(files=1)
    return table.read().select(F.col("k").cast("long").alias("k"), "status")


@query(
    "L1_caseless_load",
    """
    WITH t AS (SELECT 'Key-' || c_custkey || '  ' AS k, c_mktsegment AS segment FROM customer WHERE c_custkey % 3 <> 0),
         s AS (SELECT lower(c_name) AS name, ' KEY-' || c_custkey AS k FROM customer)
    SELECT coalesce(t.k, s.k) AS k, coalesce(s.name, t.segment) AS segment FROM t FULL JOIN s ON lower(trim(t.k)) = lower(trim(s.k))
    """,
)
def caseless_table_load(t):
    """Keys that differ in case and in blanks around them meet in one bucket and are one key."""
    key = F.col("c_custkey").cast("string")
    target = t.customer.filter("c_custkey % 3 <> 0").select(F.concat(F.lit("Key-"), key, F.lit("  ")).alias("k"), F.col("c_mktsegment").alias("segment"))
    source = t.customer.select(F.concat(F.lit(" KEY-"), key).alias("k"), F.lower("c_name").alias("segment"))
    return _loaded(t, target, source, guarded("k", caseless=True), caseless=True)


# --- refresh, checks, audit ---


# --- a whole run: customers with untidy keys and mails, loaded over those known before ---

RUN_TS = "2024-03-01T08:00:00"
RUN_SQL = """
    WITH raw AS (SELECT c_custkey, CASE WHEN c_custkey % 10 = 7 THEN 'no number' ELSE ' ' || c_custkey % 1000 END AS code,
                   CASE WHEN c_custkey % 2 = 0 THEN '<c' || c_custkey || '@mail.example>' ELSE 'c' || c_custkey || '@mail.example' END AS mail FROM customer),
         good AS (SELECT *, trim(code) AS k, 'c' || c_custkey || '@mail.example' AS clean FROM raw WHERE code <> 'no number'),
         one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY c_custkey DESC) AS rn FROM good) WHERE rn = 1),
         known AS (SELECT k, CASE WHEN CAST(k AS INTEGER) % 3 = 0 THEN 'old' ELSE clean END AS mail FROM one WHERE CAST(k AS INTEGER) % 4 <> 0)
"""


def _run(t, rows=None):
    """A run over the customers; gives its ledger, its report and the path of its audit lines."""
    folder = new_run_folder(t.spark, "run")
    key = F.col("c_custkey")
    code = F.when(key % 10 == 7, "no number").otherwise(F.concat(F.lit(" "), (key % 1000).cast("string")))
    mail = F.concat(F.lit("c"), key.cast("string"), F.lit("@mail.example"))
    raw = t.customer.select(code.alias("code"), F.when(key % 2 == 0, F.concat(F.lit("<"), mail, F.lit(">"))).otherwise(mail).alias("mail"), key.alias("n"))

    def clean(df):
        good, bad = split_by_key(df, "code", clean_digits("code"))
        events = audit.events(bad, audit.DROP_BAD_KEY, "code", "r1", RUN_TS)
        fields = [(audit.FIX_EMAIL, "mail", F.col("mail"), clean_email("mail"))]
        events = events.unionByName(audit.edits(good, "code", fields, "r1", RUN_TS))
        one = keep_one(good.withColumn("mail", clean_email("mail")), ["code"], [F.col("n").desc()], total=False)
        return one.select("code", "mail"), events

    table = KeyedTable(t.spark, f"{folder}/table", ["code"], buckets=4, text_keys=True)
    known = clean(raw)[0].filter("cast(code as int) % 4 <> 0")
    table.fill(known.withColumn("mail", F.when(F.col("code").cast("int") % 3 == 0, "old").otherwise(F.col("mail"))))
    ledger = RunLedger(t.spark, folder, "r1")
    report = run_job(ledger, lambda: raw if rows is None else raw.limit(rows), clean, None, lambda df: table.load(df, guarded("code")), "code", f"{folder}/audit", RUN_TS)
    return ledger, report, f"{folder}/audit"


@query(
    "A9_run_report",
    RUN_SQL
    + """
    SELECT 'success' AS status, (SELECT count(*) FROM one) AS rows_total, (SELECT count(*) FROM one WHERE CAST(k AS INTEGER) % 4 = 0) AS inserted,
           (SELECT count(*) FROM known WHERE mail = 'old') AS updated, (SELECT count(*) FROM good WHERE mail <> clean) AS fixed,
           (SELECT count(*) FROM raw) - (SELECT count(*) FROM one) AS dropped, 'customers' AS target_table
    """,
)
def run_report(t):
    """All counts of a run, taken by the writes of its stages."""
    ledger, report, _ = _run(t)
    return report_row(ledger, report, "customers", "customers", RUN_TS).select(
        "status", "rows_total", "inserted", "updated", "fixed", "dropped", "target_table"
    )


@query(
    "V10_no_data",
    "SELECT 'no_data' AS status, 'customers' AS subject, 0 AS rows_total, 0 AS inserted, 0 AS updated, count(*) - count(*) AS dropped FROM customer",
)
def no_data(t):
    """A run whose source is empty ends early and loads nothing."""
    ledger, report, _ = _run(t, rows=0)
    row = report_row(ledger, report, "customers", "customers", RUN_TS)
    return row.select("status", "subject", *[F.col(c).cast("int").alias(c) for c in ("rows_total", "inserted", "updated")], "dropped")


@query(
    "V7_run_events",
    RUN_SQL
    + """
    SELECT 'DROP_ROW_BAD_KEY' AS action, code AS key, CAST(NULL AS VARCHAR) AS field, CAST(NULL AS VARCHAR) AS old, CAST(NULL AS VARCHAR) AS new FROM raw WHERE code = 'no number'
    UNION ALL SELECT 'FIX_EMAIL', k, 'mail', mail, clean FROM good WHERE mail <> clean
    UNION ALL SELECT 'UPDATE', known.k, 'mail', 'old', one.clean FROM known JOIN one USING (k) WHERE known.mail = 'old'
    UNION ALL SELECT 'SUMMARY', 'code', NULL, NULL, '{"inserted": ' || (SELECT count(*) FROM one WHERE CAST(k AS INTEGER) % 4 = 0)
      || ', "updated": ' || (SELECT count(*) FROM known WHERE mail = 'old') || '}'
    """,
)
def run_events(t):
    """The audit lines of a run, but those per bucket, whose numbers are hashes."""
    _, _, path = _run(t)
    schema = ", ".join(f"{c} string" for c in audit.EVENT_COLUMNS)
    return read_events(t.spark, path, schema).filter(F.col("action") != audit.BATCH_SUMMARY).select(*audit.EVENT_COLUMNS[2:])


@query(
    "S10_append",
    "SELECT 'NEW' AS action, count(*) AS lines, count(DISTINCT o_orderkey) AS keys FROM orders WHERE o_orderstatus = 'P'",
)
def appended_events(t):
    """Events of a stage that is started twice are there once."""
    folder = new_run_folder(t.spark, "run")
    rows = audit.events(t.orders.filter("o_orderstatus = 'P'"), "NEW", "o_orderkey", "r1", RUN_TS)
    for _ in range(2):
        RunLedger(t.spark, folder, "r1").append_events("new", rows, f"{folder}/audit")
    lines = read_events(t.spark, f"{folder}/audit", "action string, key string")
    keys = lines.groupBy("action", "key").agg(F.count("*").alias("n"))
    return keys.groupBy("action").agg(F.sum("n").alias("lines"), F.count("*").alias("keys"))


@query(
    "S5_hand_over",
    "SELECT o_orderstatus AS status, count(*) AS orders, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders GROUP BY 1",
)
def handed_over(t):
    """A stage's rows, read back by a run that goes on where it broke off."""
    folder = new_run_folder(t.spark, "run")
    RunLedger(t.spark, folder, "r1").stage("extract", lambda: t.orders.select(F.col("o_orderstatus").alias("status"), money("o_totalprice").alias("price")))

    def never():
        raise AssertionError("a recorded stage is built again")

    rows = RunLedger(t.spark, folder, "r1").stage("extract", never).rows
    return rows.groupBy("status").agg(F.count("*").alias("orders"), F.sum("price").alias("total"))


@query(
    "S9_refresh_report",
    """
    SELECT (SELECT count(*) FROM customer) AS before, count(*) AS rows, count(DISTINCT o_custkey) AS distinct_keys FROM (
      SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1
    """,
)
def refresh_report(t):
    orders = t.orders.select("o_custkey", "o_orderkey")
    newest = keep_one(orders, ["o_custkey"], [F.col("o_orderkey").desc()], total=False)
    before = t.customer.agg(F.count("*")).scalar()
    return refresh_counts(newest, "o_custkey").select(before.alias("before"), "rows", "distinct_keys")


NEWEST_ORDER_SQL = """
    SELECT o_custkey AS custkey, CAST(o_orderkey AS VARCHAR) AS last_order, nullif(o_orderstatus, 'P') AS status FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1
"""


def _refreshed(t, apply: bool):
    """Customers with their first order, refreshed by their newest, whose columns are named otherwise and hold blanks."""
    table = SnapshotTable(t.spark, new_run_folder(t.spark, "snapshot"))
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus")
    first = keep_one(orders, ["o_custkey"], [F.col("o_orderkey")], total=False)
    table.create(first.select(F.col("o_custkey").alias("custkey"), F.col("o_orderkey").cast("string").alias("last_order"), F.col("o_orderstatus").alias("status")))
    newest = keep_one(orders, ["o_custkey"], [F.col("o_orderkey").desc()], total=False)
    status = F.replace("o_orderstatus", F.lit("P"), F.lit(" "))
    newest = newest.select(status.alias("STATUS"), F.col("o_custkey").alias("CustKey"), F.col("o_orderkey").cast("string").alias("Last Order"))
    return table, table.refresh(newest.withColumnRenamed("Last Order", "last_order"), "custkey", apply=apply)


@query("S9_replace", NEWEST_ORDER_SQL)
def replaced_snapshot(t):
    """The table after a refresh that verified the content written."""
    table, report = _refreshed(t, apply=True)
    if report.status != REPLACED:
        raise AssertionError(f"the refresh ended with {report.status}")
    return table.read()


@query(
    "V11_dry_run",
    """
    SELECT 'dry_run' AS status, count(DISTINCT o_custkey) AS before, count(DISTINCT o_custkey) AS incoming,
           (SELECT sum(k) FROM (SELECT min(o_orderkey) AS k FROM orders GROUP BY o_custkey)) AS untouched FROM orders
    """,
)
def dry_run(t):
    """What a refresh would do; the table keeps its rows."""
    table, report = _refreshed(t, apply=False)
    kept = table.read().agg(F.sum(F.col("last_order").cast("long")).alias("untouched"))
    return kept.select(F.lit(report.status).alias("status"), F.lit(report.before).alias("before"), F.lit(report.incoming).alias("incoming"), "untouched")


@query(
    "S4_text_export",
    """
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(lang, '') AS lang,
           nullif(replace(text, chr(13), ' '), '') AS note FROM documents
    """,
)
def text_export(t):
    """Whole texts, line breaks and quotes included, written as an export and read back in ranges."""
    folder = new_run_folder(t.spark, "export")
    note = F.replace("text", F.lit("\r"), F.lit(" ")).alias("note")
    rows = t.documents.select(F.col("doc_id").cast("string").alias("doc_id"), "lang", note)
    rows.write.options(header=True, quoteAll=True, escape='"', emptyValue="").csv(folder)
    return read_quoted_export(t.spark, folder)


@query(
    "S9_blank_to_null",
    """
    SELECT o_orderkey, CASE WHEN trim(note) = '' THEN NULL ELSE note END AS note FROM (
      SELECT o_orderkey, replace(replace(o_orderpriority, '5-LOW', ' '), '1-URGENT', '') AS note FROM orders)
    """,
)
def refresh_rows(t):
    note = F.replace(F.replace("o_orderpriority", F.lit("5-LOW"), F.lit(" ")), F.lit("1-URGENT"), F.lit(""))
    return blank_values_to_null(t.orders.select("o_orderkey", note.alias("note")))


@query(
    "V1_issues",
    """
    SELECT * FROM (
      SELECT 'duplicate' AS issue, 'l_orderkey' AS "column", CAST(count(*) - count(DISTINCT l_orderkey) AS VARCHAR) AS found FROM lineitem
      UNION ALL SELECT 'null', 'flag', CAST(count_if(l_returnflag = 'N') AS VARCHAR) FROM lineitem
      UNION ALL SELECT 'non_positive', 'l_discount', CAST(count_if(l_discount <= 0) AS VARCHAR) FROM lineitem
      UNION ALL SELECT 'non_positive', 'l_quantity', CAST(count_if(l_quantity <= 0) AS VARCHAR) FROM lineitem
      UNION ALL SELECT 'missing_column', 'l_comment', '0') WHERE found <> '0' OR issue = 'missing_column'
    """,
)
def line_issues(t):
    df = t.lineitem.select(
        "l_orderkey", F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag"), "l_discount", "l_quantity"
    )
    return issues(
        df,
        Expectations(
            required=["l_orderkey", "l_comment"],
            not_null=["l_orderkey", "flag"],
            unique="l_orderkey",
            positive=["l_discount", "l_quantity"],
        ),
    )


@query(
    "V3_issues",
    f"""
    SELECT 'null' AS issue, 'user_name' AS "column", CAST(count_if(user_name IS NULL) AS VARCHAR) AS found FROM (
      SELECT nullif(user_name, (SELECT min(user_name) FROM ({USAGE_SQL}))) AS user_name FROM ({USAGE_SQL}))
    UNION ALL SELECT 'missing_column', unnest(['department', 'full_name', 'office']), '0'
    """,
)
def usage_issues(t):
    """The usage fact's checks, with one user's name missing; the star's rollup has no such personal columns."""
    rows = usage(t)
    least = rows.agg(F.min("user_name")).scalar()
    return issues(rows.withColumn("user_name", F.nullif(F.col("user_name"), least)), printer_usage.EXPECTED)


@query(
    "V2_issues",
    f"""
    SELECT issue, "column", found FROM (
      SELECT 'too_few_rows' AS issue, CAST(NULL AS VARCHAR) AS "column", CAST(count(*) AS VARCHAR) AS found, count(*) < 1000000000 AS hit
      FROM {PROFILED_SQL}
      UNION ALL SELECT 'null_ratio', 'status', CAST(round((count(*) - count(status)) / CAST(count(*) AS DOUBLE), 4) AS VARCHAR),
        (count(*) - count(status)) / CAST(count(*) AS DOUBLE) > 0.3 FROM {PROFILED_SQL}
      UNION ALL SELECT 'null_ratio', 'priority', '', (count(*) - count(priority)) / CAST(count(*) AS DOUBLE) > 0.3 FROM {PROFILED_SQL}
      UNION ALL SELECT 'duplicate', 'customer', CAST(count(*) - count(DISTINCT customer) AS VARCHAR), true FROM {PROFILED_SQL})
    WHERE hit
    """,
)
def order_issues(t):
    return issues(
        _profiled(t),
        Expectations(
            not_null=["customer"],
            unique="customer",
            max_null_ratio={"status": 0.3, "priority": 0.3},
            min_rows=1_000_000_000,
        ),
    )


@query(
    "V4_blank_keys",
    """
    SELECT 'blank' AS issue, 'priority' AS "column",
           CAST(count_if(o_orderpriority IN ('5-LOW', '2-HIGH')) AS VARCHAR) AS found FROM orders
    """,
)
def blank_keys(t):
    return issues(_profiled(t).select(F.replace("priority", F.lit("2-HIGH"), F.lit(" ")).alias("priority")),
                  Expectations(not_blank=["priority"]))


@query(
    "V5_readiness_gate",
    f"SELECT CASE WHEN total > 0 AND CAST(matched AS DOUBLE) / total >= 0.9 THEN 'run' ELSE 'wait' END AS decision FROM {READY_SQL}",
)
def gate(t):
    return readiness_row(t).select(F.when(F.col("ready") == 1, "run").otherwise("wait").alias("decision"))


@query(
    "V6_fill_trace",
    f"""
    SELECT 'raw' AS stage, count(*) AS rows, count(status) AS filled FROM {PROFILED_SQL}
    UNION ALL SELECT 'final', count(*), count(coalesce(status, 'other')) FROM (
      SELECT customer, max(status) AS status FROM {PROFILED_SQL} GROUP BY 1)
    """,
)
def fill_trace(t):
    """The fill state of one column before and after a step."""
    raw = _profiled(t).select("customer", "status")
    final = raw.groupBy("customer").agg(F.max("status").alias("status")).na.fill({"status": "other"})
    stages = [fill_profile(df, ["status"]).withColumn("stage", F.lit(s)) for s, df in (("raw", raw), ("final", final))]
    return stages[0].unionByName(stages[1]).select("stage", "rows", "filled")


@query(
    "V6_empty_samples",
    f"SELECT DISTINCT CAST(customer AS VARCHAR) AS customer FROM {PROFILED_SQL} WHERE status IS NULL ORDER BY customer LIMIT 10",
)
def empty_keys(t):
    return empty_samples(_profiled(t).select("customer", "status").distinct(), "status", "customer", 10)


@query(
    "V7_audit_events",
    """
    SELECT '2024-03-01T08:00:00' AS ts, 'r1' AS run_id, action, CAST(c_custkey AS VARCHAR) AS key, field, old, new FROM (
      SELECT c_custkey, 'FIX_EMAIL' AS action, 'email' AS field, '<c' || c_custkey || '@mail.example>' AS old,
             'c' || c_custkey || '@mail.example' AS new FROM customer WHERE c_mktsegment = 'BUILDING'
      UNION ALL SELECT c_custkey, 'FIX_EMAIL', 'email', c_name, NULL FROM customer WHERE c_mktsegment <> 'BUILDING'
      UNION ALL SELECT c_custkey, 'FILL_STATUS_FROM_STATUSNAME', 'segment', NULL, 'none' FROM customer WHERE c_mktsegment = 'MACHINERY')
    """,
)
def audit_events(t):
    segment = F.col("c_mktsegment")
    mail = F.when(segment == "BUILDING", F.concat(F.lit("<c"), "c_custkey", F.lit("@mail.example>"))).otherwise(F.col("c_name"))
    known = F.nullif(segment, F.lit("MACHINERY"))
    fields = [
        (audit.FIX_EMAIL, "email", mail, clean_email(mail)),
        (audit.FILL_STATUS, "segment", known, F.coalesce(known, F.lit("none"))),
    ]
    return audit.edits(t.customer, "c_custkey", fields, "r1", "2024-03-01T08:00:00")


@query(
    "V9_change_table",
    EXACT_SQL
    + """
    SELECT CAST(tid AS VARCHAR) AS key, field, old, new FROM (
      SELECT tid, 'lang' AS field, t1 AS old, s1 AS new FROM m WHERE w AND tid IS NOT NULL UNION ALL
      SELECT tid, 'size', CAST(t3 AS VARCHAR), CAST(s3 AS VARCHAR) FROM m WHERE w AND tid IS NOT NULL) WHERE old IS DISTINCT FROM new
    """,
)
def change_table(t):
    target, source, rule = _exact_sides(t)
    reported = type(rule)(rule.keys, rule.compare, rule.assign, stamp=rule.stamp, audit=None)
    return change_rows(change_set(target, source, reported), "doc_id")


# --- settlement: orders as invoices, lines as items and receipts, customers as students ---

SETTLEMENT_SQL = f"""
    WITH inv AS (SELECT o_orderkey AS id, CAST(o_orderkey AS VARCHAR) AS number, o_custkey AS student,
                   CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'r' WHEN '2' THEN 'a' WHEN '3' THEN 'cr' WHEN '4' THEN 'au' ELSE 'x' END AS type,
                   year(o_orderdate) * 10 + CASE WHEN month(o_orderdate) > 6 THEN 2 ELSE 1 END AS term,
                   CAST(CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END AS DECIMAL(18,2)) AS amount,
                   CAST(CASE o_orderstatus WHEN 'F' THEN -o_totalprice WHEN 'P' THEN 0 ELSE o_totalprice END AS DECIMAL(18,2)) AS total,
                   o_orderdate AS updated, o_orderpriority <> '5-LOW' AS paid, o_totalprice > 20000 AS active, o_totalprice > 480000 AS cancelled
                 FROM orders),
         term AS (SELECT DISTINCT year(o_orderdate) * 10 + CASE WHEN month(o_orderdate) > 6 THEN 2 ELSE 1 END AS id,
                    year(o_orderdate) AS y, CASE WHEN month(o_orderdate) > 6 THEN 2 ELSE 1 END AS n FROM orders),
         item AS (SELECT l_orderkey AS id, CASE l_returnflag WHEN 'R' THEN 'Lump sum fee' WHEN 'N' THEN 'Tuition' END AS name FROM lineitem),
         receipt AS (SELECT l_orderkey AS id FROM lineitem WHERE l_linestatus = 'F' AND l_quantity >= 40),
         kinds AS (SELECT id, bool_and(coalesce(starts_with(name, 'Lump sum'), false)) AS all_lump FROM item GROUP BY 1),
         live AS (SELECT * FROM inv WHERE active AND NOT cancelled),
         credit AS (SELECT a.id, min(b.id) AS credit_id FROM live a JOIN live b ON b.student = a.student AND b.id > a.id
                    WHERE b.total < 0 AND b.amount < 0 GROUP BY 1),
         facts AS (
           SELECT a.id, a.number, a.type, a.amount, a.total, a.updated, a.paid, term.y, term.n, c_name AS code,
                  coalesce(k.all_lump, false) AS lump, b.updated AS credit_updated,
                  EXISTS (SELECT 1 FROM receipt WHERE receipt.id = a.id) AS received,
                  coalesce(a.total = 0 AND abs(a.amount) > abs(b.total), false) AS settled
           FROM live a JOIN term ON term.id = a.term JOIN customer ON c_custkey = a.student
           LEFT JOIN kinds k ON k.id = a.id LEFT JOIN credit ON credit.id = a.id LEFT JOIN live b ON b.id = credit.credit_id
           WHERE (a.total <> 0 OR a.paid) AND a.number <> '77'),
         ways AS (SELECT *, (lump AND y = 1997 AND n = 1) OR number = '42' AS waived FROM facts)
    SELECT CAST(id AS VARCHAR) AS "invoiceId", CAST(y AS VARCHAR) AS "acaYear", n AS semester, number AS "invoiceNo",
           map_extract(map {{'r': 'N', 'a': 'A', 'cr': 'A', 'au': 'E'}}, type)[1] AS "regisType",
           if(settled, amount, total) AS "invoiceAmount",
           strftime(if(settled, credit_updated, if((received AND paid) OR waived, updated, NULL)), '%Y-%m-%d %H:%M:%S') AS "paidDate",
           if(settled OR received, if(total = 0, amount, total), if(waived, total, 0.00)) AS "paidAmount",
           if(settled OR received OR waived, 'Y', 'N') AS "paidStatus",
           if(lump, '{LUMP_SUM_TYPE}', '{CREDIT_TYPE}') AS "invoiceType",
           CAST(NULL AS VARCHAR) AS "schNameTh", CAST(NULL AS VARCHAR) AS remark, code AS "studentCode"
    FROM ways WHERE if(settled, amount, total) > 0
"""


@query("F1_settlement", SETTLEMENT_SQL)
def settlement(t):
    status, price = F.col("o_orderstatus"), money("o_totalprice")
    half = F.when(F.month("o_orderdate") > 6, 2).otherwise(1)
    term_id = F.year("o_orderdate") * 10 + half
    types = {"1": "r", "2": "a", "3": "cr", "4": "au"}
    invoices = t.orders.select(
        F.col("o_orderkey").alias("Id"),
        F.col("o_orderkey").cast("string").alias("Number"),
        F.col("o_custkey").alias("StudentId"),
        code_map(F.substring("o_orderpriority", 1, 1), types, "x").alias("Type"),
        term_id.alias("TermId"),
        F.when(status == "F", -price).otherwise(price).alias("Amount"),
        F.when(status == "F", -price).when(status == "P", money(F.lit(0))).otherwise(price).alias("TotalAmount"),
        F.col("o_orderdate").alias("UpdatedAt"),
        (F.col("o_orderpriority") != "5-LOW").alias("IsPaid"),
        (F.col("o_totalprice") > 20000).alias("IsActive"),
        (F.col("o_totalprice") > 480000).alias("IsCancel"),
    )
    terms = t.orders.select(
        term_id.alias("Id"), F.year("o_orderdate").alias("AcademicYear"), half.alias("AcademicTerm")
    ).distinct()
    students = t.customer.select(F.col("c_custkey").alias("Id"), F.col("c_name").alias("Code"))
    flag = F.col("l_returnflag")
    items = t.lineitem.select(
        F.col("l_orderkey").alias("InvoiceId"),
        F.when(flag == "R", "Lump sum fee").when(flag == "N", "Tuition").alias("FeeItemName"),
    )
    receipts = t.lineitem.filter("l_linestatus = 'F' and l_quantity >= 40").select(F.col("l_orderkey").alias("InvoiceId"))
    regis = code_map("Type", REGISTRATION_TYPES).cast("string")
    df = settle(invoices, terms, students, items, receipts, regis, ["42"], ["77"], lump_sum_term=(1997, 1))
    return df.withColumn("paidDate", F.date_format("paidDate", "yyyy-MM-dd HH:mm:ss"))


@query(
    "F1_settlement_totals",
    f"""
    SELECT "acaYear", "paidStatus", "invoiceType", count(*) AS invoices, sum("invoiceAmount") AS billed, sum("paidAmount") AS paid
    FROM ({SETTLEMENT_SQL}) GROUP BY 1, 2, 3
    """,
)
def settlement_totals(t):
    return settlement(t).groupBy("acaYear", "paidStatus", "invoiceType").agg(
        F.count("*").alias("invoices"), F.sum("invoiceAmount").alias("billed"), F.sum("paidAmount").alias("paid")
    )


@query(
    "J8_order_customer",
    "SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON c_custkey = o_custkey",
)
def order_customer(t):
    orders = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    joined = skew_join(orders, t.customer.select("c_custkey", "c_name", "c_mktsegment"), "c_custkey")
    return joined.select("o_orderkey", "c_name", "c_mktsegment")
