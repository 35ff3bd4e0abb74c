"""Delimited exports with line breaks inside quotes, read by many tasks.

A byte range of such a file does not say by itself whether its first line begins a record: that depends on whether the
quotes before it are even. So the lines are read as Spark splits the files, the quotes of each range are counted, and the
parity before a range is the sum over the ranges before it (one row per range). With it every task joins its own lines to
records; only the lines at the borders of ranges, at most two pieces each, are put together afterwards. No file is read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyloom.functions.schema import normalize_columns
from keyloom.session import materialize

PIECE = "file string, block long, at long, kind string, text string"
WHOLE, HEAD, TAIL = "whole", "head", "tail"


def joined(batches: Iterator[pa.RecordBatch], quote: str = '"') -> Iterator[pa.RecordBatch]:
    """Lines of ranges as records: whole ones, and what a range has of a record that began before or ends after it."""
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("at", pa.int64()), ("kind", pa.string()), ("text", pa.string())])
    now, lines, inside, began, at, out = None, [], False, True, 0, []

    def close(kind: str) -> None:
        nonlocal at
        if lines:
            out.append((*now, at, kind, "\n".join(lines)))
            at += 1
        lines.clear()

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("file", "block", "odd", "value"))
        for file, block, odd, value in zip(*columns, strict=True):
            if (file, block) != now:
                close(TAIL if began else HEAD)  # open at the end of its range
                now, inside, began, at = (file, block), odd, not odd, 0
            lines.append(value)
            inside ^= value.count(quote) % 2 == 1
            if not inside:
                close(WHOLE if began else HEAD)
                began = True
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * 5, schema, strict=True)], schema=schema)
        out.clear()
    close(TAIL if began else HEAD)
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * 5, schema, strict=True)], schema=schema)


def records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """One row per record: file, block and place of its beginning, and its text with the line breaks inside quotes."""
    # Ranges are cut as spark.sql.files.maxPartitionBytes says; both passes must cut alike, so the setting must not change in between.
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    ranges = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("odd"))
    ranges = materialize(ranges, "ranges")  # one row per range
    known = {(r["file"], r["block"]): r["odd"] for r in ranges.filter("odd").collect()}
    # Only ranges that begin inside quotes are named: one short row per spark.sql.files.maxPartitionBytes at most.
    held = spark.sparkContext.broadcast(set(known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def with_parity() -> Iterator[pa.RecordBatch]:
            for b in batches:
                keys = zip(b.column("file").to_pylist(), b.column("block").to_pylist(), strict=True)
                yield b.append_column("odd", pa.array([k in held.value for k in keys], pa.bool_()))

        return joined(with_parity(), quote)

    pieces = materialize(lines.mapInArrow(run, PIECE), "pieces")
    # A record over a border: the tail that opens it and the heads up to its end, in file order.
    broken = pieces.filter(F.col("kind") != WHOLE)
    order = Window.partitionBy("file").orderBy("block", "at")
    opened = F.when(F.col("kind") == TAIL, F.struct("block", "at"))
    broken = broken.withColumn("start", F.last(opened, ignorenulls=True).over(order))
    whole = broken.groupBy("file", "start").agg(F.array_sort(F.collect_list(F.struct("block", "at", "text"))).alias("parts"))
    whole = whole.select("file", "start.block", "start.at", F.array_join("parts.text", "\n").alias("text"))
    return pieces.filter(F.col("kind") == WHOLE).select("file", "block", "at", "text").unionByName(whole)


def read_quoted_export(spark: SparkSession, path: str, separator: str = ",", quote: str = '"') -> DataFrame:
    """The rows of exports with a header record, every column text, names normalized; empty cells are NULL."""
    rows = records(spark, path, quote)
    first = rows.filter("block = 0 and at = 0")
    options = {"sep": separator, "quote": quote, "escape": quote, "multiLine": "true", "lineSep": "\u0000"}
    head = first.orderBy("file").limit(1)
    names = head.select(F.from_csv("text", F.lit(", ".join(f"c{i} string" for i in range(1000))), options).alias("c")).first()
    if names is None:
        return spark.createDataFrame([], T.StructType())
    columns = [str(n).rstrip("\r") for n in names["c"] if n is not None]
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    text = F.regexp_replace("text", "\r\\z", "")
    body = rows.filter("not (block = 0 and at = 0)").filter(F.trim(text) != "")
    parsed = body.select(F.from_csv(text, F.lit(schema), options).alias("row")).select("row.*")
    return normalize_columns(parsed, dashes=False)
