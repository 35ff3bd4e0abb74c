"""Full-refresh replace with verification: every refresh is a new folder, the log names the current one."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from keyloom.functions.schema import align_columns
from keyloom.functions.text import is_blank
from keyloom.sources.commits import CommitLog

# How a refresh ends.
REPLACED, DRY_RUN = "replaced", "dry_run"
COLUMN_MISMATCH, ROWS_DIFFER, KEY_REPEATS = "column_mismatch", "rows_differ", "key_repeats"
CONTENT_DIFFERS = "content_differs"


@dataclass(frozen=True)
class RefreshReport:
    status: str
    before: int
    incoming: int
    after: int
    distinct_keys: int
    missing_in_source: list[str]
    missing_in_target: list[str]
    sample: DataFrame


class SnapshotTable:
    """``<path>/data/<version>`` holds a refresh, ``<path>/log`` one numbered entry per completed switch.

    Readers follow the newest entry, so they see the old or the new rows, never a mix; earlier
    folders stay as backups.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = CommitLog(spark, f"{self.path}/log")

    def versions(self) -> DataFrame:
        """seq and version, oldest first; one small entry per refresh."""
        rows = [(n, self.log.read(n)["version"]) for n in self.log.numbers()]
        return self.spark.createDataFrame(rows, "seq long, version string")

    def read(self, version: str | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/data/{version or self.log.newest()[1]['version']}")

    def commit(self, version: str) -> None:
        newest = self.log.newest()
        self.log.put(newest[0] + 1 if newest else 0, {"version": version})

    def create(self, df: DataFrame) -> None:
        version = uuid.uuid4().hex
        df.write.parquet(f"{self.path}/data/{version}")
        self.commit(version)

    def refresh(
        self, source: DataFrame, key: str, apply: bool = False, allow_mismatch: bool = False
    ) -> RefreshReport:
        """Replace the rows by ``source``; without ``apply`` only report what would happen.

        Columns are matched by name without regard to case and spaces; columns the source lacks
        become NULL if a mismatch is allowed. Blank text becomes NULL. The new rows are verified
        before the switch.
        """
        target = self.read()
        before = target.count()
        aligned = align_columns(source, target.columns)
        rows = blank_values_to_null(aligned.frame)
        found = (aligned.missing_in_source, aligned.missing_in_target, rows.limit(3))
        if not aligned.exact and not allow_mismatch:
            return RefreshReport(COLUMN_MISMATCH, before, 0, before, 0, *found)
        if not apply:
            incoming = rows.count()
            return RefreshReport(DRY_RUN, before, incoming, incoming, 0, *found)
        version, given = uuid.uuid4().hex, Observation()
        cast = rows.select(*[F.col(f"`{c}`").cast(target.schema[c].dataType).alias(c) for c in rows.columns])
        fresh = target.limit(0).unionByName(cast, allowMissingColumns=True)
        # What is written is counted and summed up on the way, so the source is computed once.
        fresh.observe(given, F.count(F.lit(1)).alias("rows"), *content_sums(fresh)).write.parquet(f"{self.path}/data/{version}")
        check = refresh_counts(self.read(version), key).first()
        status = REPLACED
        if check["rows"] != given.get["rows"]:
            status = ROWS_DIFFER
        elif any(check[c] != given.get[c] for c in ("sum_a", "sum_b")):
            status = CONTENT_DIFFERS
        elif check["distinct_keys"] != check["rows"]:
            status = KEY_REPEATS
        if status == REPLACED:
            self.commit(version)
        return RefreshReport(status, before, given.get["rows"], check["rows"], check["distinct_keys"], *found)


def blank_values_to_null(df: DataFrame) -> DataFrame:
    """Blank text to NULL in every text column, other values untouched."""
    return df.select(
        *[
            F.when(~is_blank(f"`{name}`"), F.col(f"`{name}`")).alias(name) if kind == "string" else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )


def content_sums(df: DataFrame) -> list[Column]:
    """Aggregates that are equal for equal rows in any order and any split, repeated rows included: sums of row hashes."""
    row = [F.col(f"`{c}`") for c in df.columns]
    # NULLs leave a hash unchanged, so a value's place goes into it.
    placed = [F.struct(F.lit(i), F.coalesce(c.isNull(), F.lit(True)), c) for i, c in enumerate(row)]
    sums = {"sum_a": F.xxhash64(F.lit("a"), *placed), "sum_b": F.xxhash64(F.lit("b"), *placed)}
    return [F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias(n) for n, h in sums.items()]


def refresh_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys and content sums, with one grouping by the key instead of a distinct count."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"), *content_sums(df))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(F.col(key)).alias("distinct_keys"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("decimal(38,0)").alias(c) for c in ("sum_a", "sum_b")],
    )
