"""Printer usage: a monthly fact, loaded insert-only."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.functions.dates import ingestion_date
from keyloom.functions.schema import cast_to
from keyloom.operators.quality import Expectations, require
from keyloom.operators.usage import closed_periods, monthly_usage
from keyloom.plans import fixed_values as V
from keyloom.plans.runs import RunReport, run_job
from keyloom.sources.keyed_table import KeyedTable, LoadResult
from keyloom.sources.ledger import RunLedger

EXPECTED = Expectations(required=V.USAGE_SCHEMA.fieldNames(), not_null=["user_name"])


def build(tables: Mapping[str, DataFrame], after: str = V.USAGE_AFTER) -> DataFrame:
    """Usage of users still present, from printed and not cancelled jobs after the given day."""
    users = tables["users"].filter("deleted = 'N'").withColumnRenamed("user_id", "_user")
    # "After the day" as a bound on the timestamp itself, so that it is pushed to the scan.
    first = F.lit(after).cast("date") + F.expr("interval 1 day")
    log = (
        tables["usage_log"]
        .filter("printed = 'Y' and cancelled = 'N'")
        .filter(F.col("usage_day") >= first)
        .withColumnRenamed("used_by_user_id", "_user")
    )
    attributes = ["user_name", "full_name", "department", "office"]
    return monthly_usage(
        log, users, "_user", ["job_type"], attributes, "total_color_pages", "total_pages", "usage_day"
    )


def transform(df: DataFrame) -> DataFrame:
    """Strict casts to the fact's schema: a value that does not fit raises."""
    return cast_to(df, V.USAGE_SCHEMA)


def check(df: DataFrame) -> None:
    require(df, EXPECTED)


def stamped(df: DataFrame, run_ts: str) -> DataFrame:
    if "ingestion_date" not in df.columns:
        df = df.withColumn("ingestion_date", ingestion_date(F.lit(run_ts).cast("timestamp")))
    return df if "code" in df.columns else df.withColumn("code", F.col("user_name"))


def load(df: DataFrame, table: KeyedTable, closed_before: tuple[int, int] | None = None) -> LoadResult:
    """Append months the table lacks; ``closed_before`` (year, month) leaves unfinished months for later."""
    rows = closed_periods(df, *closed_before) if closed_before else df
    return table.append_new(rows, list(V.USAGE_KEYS))


def run(
    tables: Mapping[str, DataFrame],
    table: KeyedTable,
    ledger: RunLedger,
    audit_path: str,
    run_ts: str,
    closed_before: tuple[int, int] | None = None,
) -> RunReport:
    """Roll up, check and append as one run with a ledger."""

    def clean(rows: DataFrame) -> DataFrame:
        return stamped(transform(rows), run_ts)

    return run_job(
        ledger, lambda: build(tables), clean, check, lambda rows: load(rows, table, closed_before), "user_name", audit_path, run_ts
    )
