"""A job as a run: its stages are written once and recorded, its audit events appended once, its counts kept."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.operators import audit
from keyloom.operators.keyed_load import change_rows
from keyloom.operators.quality import FillTrace
from keyloom.sources.keyed_table import LoadResult
from keyloom.sources.ledger import RunLedger

NO_DATA, SUCCESS = "no_data", "success"


@dataclass(frozen=True)
class RunReport:
    """``fixed`` counts edited fields, ``dropped`` rows with unusable keys and rows that repeat a key."""

    status: str
    rows_total: int
    inserted: int = 0
    updated: int = 0
    fixed: int = 0
    dropped: int = 0
    batches: int = 0
    trace: dict[str, dict[str, int]] = field(default_factory=dict)


def run_job(
    ledger: RunLedger,
    build: Callable[[], DataFrame],
    clean: Callable[[DataFrame], DataFrame | tuple[DataFrame, DataFrame]],
    check: Callable[[DataFrame], None] | None,
    load: Callable[[DataFrame], LoadResult],
    key: str,
    audit_path: str,
    run_ts: str,
    trace: FillTrace | None = None,
) -> RunReport:
    """Extract, clean, check and load. ``clean`` gives the rows, or the rows and their audit events.

    A run that broke off is started again with the same run id: recorded stages are read back. A load that was
    committed but not recorded is repeated and then finds nothing to change, so only its counts are lost.
    """
    extracted = ledger.stage("extract", build)
    if not extracted.counts["rows"]:
        return RunReport(NO_DATA, 0)
    out = clean(extracted.rows)
    rows, events = out if isinstance(out, tuple) else (out, None)
    counted = trace.counts if trace else dict
    cleaned = ledger.stage("clean", lambda: rows, more=lambda: {"trace": counted()})
    found = ledger.append_events("clean_audit", events, audit_path) if events is not None else {}
    if not cleaned.counts["rows"]:
        return RunReport(NO_DATA, 0, dropped=extracted.counts["rows"], trace=cleaned.counts["trace"])
    if check:
        check(cleaned.rows)

    def loaded() -> dict:
        done = load(cleaned.rows)
        fields = change_rows(done.changes, key) if "_op" in done.changes.columns else None
        if fields is None:  # an insert-only load changes no field
            fields = cleaned.rows.sparkSession.createDataFrame([], "key string, field string, old string, new string")
        events = audit.load_events(fields, done.inserted, done.updated, done.per_bucket, key, ledger.run_id, run_ts)
        ledger.append_events("load_audit", events, audit_path)
        return {"inserted": done.inserted, "updated": done.updated, "batches": len(done.per_bucket)}

    counts = ledger.value("load", loaded)
    fixed = sum(found.get(a, 0) for a in audit.FIXES)
    dropped = extracted.counts["rows"] - cleaned.counts["rows"]
    return RunReport(SUCCESS, cleaned.counts["rows"], counts["inserted"], counts["updated"], fixed, dropped, counts["batches"], cleaned.counts["trace"])


def report_row(ledger: RunLedger, report: RunReport, subject: str, target: str, run_date: str) -> DataFrame:
    """The run's summary as one row."""
    spark = ledger.spark
    numbers = [(report.rows_total, report.inserted, report.updated, report.fixed, report.dropped, report.batches)]
    counts = spark.createDataFrame(numbers, "rows_total long, inserted long, updated long, fixed long, dropped long, batches long")
    row = counts.select(F.lit(report.status).alias("status"), F.lit(subject).alias("subject"), "*")
    return row.withColumns({"target_table": F.lit(target), "run_date": F.lit(run_date)})
