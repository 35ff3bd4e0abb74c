"""The audit trail and run summaries as JSON lines, and run-scoped hand-over tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def append_events(events: DataFrame, path: str) -> None:
    """Append events, one JSON object per line; text beyond ASCII is kept as it is."""
    events.write.mode("append").option("ignoreNullFields", "false").json(path)


def read_events(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", True).json(path)


def hand_over(df: DataFrame, folder: str, run_id: str, stage: str) -> DataFrame:
    """Write a stage's result under its run and read it back, so that runs never share a file."""
    path = f"{folder.rstrip('/')}/run_id={run_id}/{stage}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
