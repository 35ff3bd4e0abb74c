"""Incremental loads: files that arrived since the last run go through the same keyed loads.

A scheduled run drains what is there and ends (``availableNow``). The stream's checkpoint remembers
which files were loaded; a batch that is replayed after a failure changes nothing, because the loads
are idempotent. Rows of one batch shrink to one per key before the load.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from keyloom.operators.dedupe import keep_one
from keyloom.operators.keyed_load import LoadRule
from keyloom.session import shared_folder
from keyloom.sources.keyed_table import KeyedTable

Transform = Callable[[DataFrame], DataFrame]


def drain(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    name: str,
    load_batch: Callable[[DataFrame], None],
    file_format: str = "parquet",
    files_per_batch: int = 1000,
) -> None:
    """Load every new file of ``folder``, batch by batch, and return when none is left."""
    arrived = spark.readStream.format(file_format).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    query = (
        arrived.load(folder)
        .writeStream.queryName(name)
        .option("checkpointLocation", f"{shared_folder(spark)}/streams/{name}")
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, _: load_batch(batch))
        .start()
    )
    query.awaitTermination()


def drain_upserts(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    name: str,
    table: KeyedTable,
    rule: LoadRule,
    newest: Sequence[Column],
    transform: Transform = lambda df: df,
) -> None:
    """Upsert new files; of several rows with one key the first by ``newest`` counts."""

    def load_batch(batch: DataFrame) -> None:
        table.load(keep_one(transform(batch), rule.keys, newest), rule)

    drain(spark, folder, schema, name, load_batch)


def drain_inserts(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    name: str,
    table: KeyedTable,
    keys: Sequence[str],
    transform: Transform = lambda df: df,
) -> None:
    """Append rows of new files whose key the table lacks."""
    drain(spark, folder, schema, name, lambda batch: table.append_new(transform(batch), list(keys)))
