"""Invoices: settle, clean, check, and load with an overwrite upsert."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyloom.functions.dates import lenient_timestamp
from keyloom.functions.rules import code_map
from keyloom.functions.text import clean_digits, scrub_missing
from keyloom.operators.dedupe import keep_one, ordinal
from keyloom.operators.keyed_load import overwrite
from keyloom.operators.quality import Expectations, require
from keyloom.operators.settlement import settle
from keyloom.plans import fixed_values as V
from keyloom.plans.runs import RunReport, run_job
from keyloom.sources.keyed_table import KeyedTable, LoadResult
from keyloom.sources.ledger import RunLedger

EXPECTED = Expectations(
    required=V.INVOICE_SCHEMA.fieldNames(),
    not_null=["invoiceId"],
    unique="invoiceId",
    positive=["invoiceAmount"],
)


def build(tables: Mapping[str, DataFrame], manual_paid: Sequence[str] = (), excluded: Sequence[str] = ()) -> DataFrame:
    return settle(
        tables["invoices"],
        tables["terms"],
        tables["students"],
        tables["invoice_items"],
        tables["receipts"],
        code_map("Type", V.REGISTRATION_TYPES).cast("string"),
        manual_paid,
        excluded,
    )


def transform(df: DataFrame) -> DataFrame:
    """Clean the key, parse the date, scrub missing-value texts, keep the last row per invoice.

    "Last" is by student, year, term and id, with NULL after everything else.
    """
    df = df.toDF(*[c.strip() for c in df.columns])
    df = df.withColumn("invoiceId", clean_digits("invoiceId")).filter(F.col("invoiceId").isNotNull())
    if not isinstance(df.schema["paidDate"].dataType, T.TimestampType):
        df = df.withColumn("paidDate", lenient_timestamp(F.col("paidDate").cast("string")))
    texts = [f.name for f in V.INVOICE_SCHEMA if isinstance(f.dataType, T.StringType) and f.name != "invoiceId"]
    df = df.withColumns({c: scrub_missing(F.col(c).cast("string")) for c in texts})
    df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in V.INVOICE_SCHEMA])
    last = [F.col(c).desc_nulls_first() for c in ("studentCode", "acaYear", "semester")]
    return keep_one(df, ["invoiceId"], last)


def with_row_order(df: DataFrame) -> DataFrame:
    """The optional ordinal by student, year, term and id."""
    order = [F.col(c).asc_nulls_last() for c in ("studentCode", "acaYear", "semester", "invoiceId")]
    return ordinal(df, order, "_row_order")


def check(df: DataFrame, allow_empty: bool = False) -> None:
    if allow_empty and df.isEmpty():
        return
    require(df, EXPECTED)


def load(df: DataFrame, table: KeyedTable) -> LoadResult:
    return table.load(df, overwrite("invoiceId", V.INVOICE_AUDITED))


def run(
    tables: Mapping[str, DataFrame],
    table: KeyedTable,
    ledger: RunLedger,
    audit_path: str,
    run_ts: str,
    manual_paid: Sequence[str] = (),
    excluded: Sequence[str] = (),
) -> RunReport:
    """Settle, clean, check and load as one run with a ledger."""
    return run_job(
        ledger, lambda: build(tables, manual_paid, excluded), transform, check, lambda rows: load(rows, table), "invoiceId", audit_path, run_ts
    )
