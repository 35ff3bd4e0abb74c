"""Audit events and run summaries as DataFrames."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The event names.
DROP_BAD_KEY = "DROP_ROW_BAD_KEY"
FIX_EMAIL = "FIX_EMAIL"
FILL_STATUS = "FILL_STATUS_FROM_STATUSNAME"
FALLBACK_NAME = "FALLBACK_THAI_NAME"
UPDATE = "UPDATE"
SUMMARY = "SUMMARY"
BATCH_SUMMARY = "BATCH_SUMMARY"
FIXES = (FIX_EMAIL, FILL_STATUS, FALLBACK_NAME)

EVENT_COLUMNS = ("ts", "run_id", "action", "key", "field", "old", "new")


def events(
    df: DataFrame, action: str, key: str, run_id: str, run_ts: str, field=None, old=None, new=None
) -> DataFrame:
    """One audit event per row of ``df``; field, old and new are columns or absent."""

    def text(value) -> Column:
        return (F.lit(None) if value is None else value).cast("string")

    return df.select(
        F.lit(run_ts).alias("ts"),
        F.lit(run_id).alias("run_id"),
        F.lit(action).alias("action"),
        F.col(key).cast("string").alias("key"),
        text(field).alias("field"),
        text(old).alias("old"),
        text(new).alias("new"),
    )


def edits(
    df: DataFrame, key: str, fields: Sequence[tuple[str, str, Column, Column]], run_id: str, run_ts: str
) -> DataFrame:
    """Events for fields whose new value differs from the old one, both computed on the same row.

    ``fields`` holds (action, field, old, new). One pass: the pairs become an array that is filtered
    and exploded.
    """
    pairs = F.array(
        *[
            F.struct(
                F.lit(action).alias("action"),
                F.lit(name).alias("field"),
                old.cast("string").alias("old"),
                new.cast("string").alias("new"),
            )
            for action, name, old, new in fields
        ]
    )
    blank = F.lit("")
    changed = F.filter(pairs, lambda p: F.coalesce(p["old"], blank) != F.coalesce(p["new"], blank))
    flat = df.select(F.col(key).cast("string").alias("key"), F.inline(changed))
    return flat.select(F.lit(run_ts).alias("ts"), F.lit(run_id).alias("run_id"), *EVENT_COLUMNS[2:])


def load_events(
    changes: DataFrame, inserted: int, updated: int, per_bucket: Sequence[tuple[int, int, int]], target: str, run_id: str, run_ts: str
) -> DataFrame:
    """Events of a load: UPDATE per changed field, BATCH_SUMMARY per bucket it wrote, one SUMMARY.

    ``changes`` holds key, field, old and new. A summary's ``new`` is JSON with the counts.
    """
    spark = changes.sparkSession
    updates = changes.select(
        F.lit(run_ts).alias("ts"), F.lit(run_id).alias("run_id"), F.lit(UPDATE).alias("action"), "key", "field", "old", "new"
    )
    counts = [(BATCH_SUMMARY, str(b), i, u) for b, i, u in per_bucket] + [(SUMMARY, target, inserted, updated)]
    rows = [(run_ts, run_id, a, k, None, None, json.dumps({"inserted": i, "updated": u})) for a, k, i, u in counts]
    return updates.unionAll(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in EVENT_COLUMNS)))


def run_summary(
    counts: DataFrame, subject: str, target: str, run_date: str, duration_sec: float = 0.0, batch_size: int | None = None
) -> DataFrame:
    """One row from (rows_total, inserted, updated): the status is "no_data" for an empty run."""
    rows = F.col("rows_total")
    batches = F.ceil(rows / F.lit(batch_size)) if batch_size else (rows > 0).cast("long")
    return counts.select(
        F.when(rows == 0, F.lit("no_data")).otherwise(F.lit("success")).alias("status"),
        F.lit(subject).alias("subject"),
        rows.alias("rows_total"),
        F.col("inserted"),
        F.col("updated"),
        F.lit(duration_sec).alias("duration_sec"),
        batches.cast("long").alias("batches_total"),
        F.lit(target).alias("target_table"),
        F.lit(run_date).alias("run_date"),
    )
