"""Helpers the operators share: table access, free column names, written and bucketed intermediates."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyloom.session import new_run_folder, shuffle_width

ROW = "_row"
#: Rows of an Arrow batch that holds whole texts; the JVM and a Python worker each hold a batch several times over.
TEXT_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def utf8(name: str = "text") -> Column:
    """The UTF-8 bytes of a text column, none for null."""
    return F.coalesce(quoted(name), F.lit("")).cast("binary")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: stable rows that outlive executors."""
    path = new_run_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches have at most ``TEXT_ROWS`` rows: for texts on their way to Python."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= TEXT_ROWS:
        conf.set(name, TEXT_ROWS)
    return df


def numbered(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` written with a unique row number, and that column's name.

    Numbers are fixed by the write, so rows that agree in every column can still be told apart.
    """
    name = free_name(df, ROW)
    return written(df.withColumn(name, F.monotonically_increasing_id()), label), name


def bucketed(df: DataFrame, key: str, label: str) -> tuple[DataFrame, str]:
    """``df`` as a table bucketed by ``key`` in the shared folder: later joins on the key move only the other side.

    Returns the table and its folder.
   """
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    writer = df.write.bucketBy(shuffle_width(spark), key).option("compression", "zstd")
    path = new_run_folder(spark, label)
    writer.option("path", path).saveAsTable(name)
    return spark.table(name), path


def distinct_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Each different text once: ``t_key`` (SHA-256 of the bytes), ``bytes``, ``copies``, ``tid`` (unique long).

    Copies collapse before the shuffle, so a text that a third of all rows repeat is one row per map task.
    """
    rows = docs.select(utf8(text).alias("bytes")).withColumn("t_key", text_key("bytes"))
    one = rows.groupBy("t_key").agg(F.first("bytes").alias("bytes"), F.count("*").alias("copies"))
    return bucketed(one.withColumn("tid", F.monotonically_increasing_id()), "t_key", "texts")[0]


def text_key(name: str) -> Column:
    return F.unhex(F.sha2(F.col(name), 256))


def byte_blocks(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of a binary Arrow column with about ``limit`` bytes: first row, end row, bytes, offsets.

    One row is never split: a text larger than the limit makes a block of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit words."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def changes(batch: pa.RecordBatch, names: list[str], before: pa.RecordBatch | None) -> np.ndarray:
    """For each row, whether it differs from the row before it in any of the columns (null equals null)."""
    n = len(batch)
    out = np.zeros(n, bool)
    for name in names:
        column = batch.column(name)
        for rows, a, b in ((out[1:], column[1:], column[:-1]), (out[:1], column[:1], before and before.column(name)[-1:])):
            if b is None:
                rows[:] = True
            elif len(a):
                same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
                rows |= ~same.to_numpy(zero_copy_only=False)
    return out


def placed(df: DataFrame, group: list[str], order: list[Column], label: str) -> DataFrame:
    """``df`` written with ``pos``, a row's place in its group from 0, and ``run``, a number of the group.

    Groups ascend by ``group`` (null first), and ``run`` ascends with them: it is the place of the group's first row among
    all rows. Rows are range-partitioned, so that a hot group is spread over many tasks; each task numbers what it has, and
    one row per range says where its groups began. ``order`` should tell all rows apart. Columns named ``part``, ``at`` and
    ``lead`` must not be there.
    """
    keys = [*map(quoted, group), *order]
    ranged = df.repartitionByRange(shuffle_width(df.sparkSession), *keys).sortWithinPartitions(*keys)
    ranged = ranged.withColumn("part", F.spark_partition_id())
    schema = T.StructType([*ranged.schema.fields, T.StructField("at", T.LongType()), T.StructField("lead", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, lead, before = 0, 0, None
        for batch in batches:
            if len(batch):
                place = np.arange(at, at + len(batch))
                leads = np.maximum.accumulate(np.where(changes(batch, group, before), place, lead))
                at, lead, before = at + len(batch), int(leads[-1]), batch.slice(len(batch) - 1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place), pa.array(leads)], [*batch.schema.names, "at", "lead"])

    stored = written(ranged.mapInArrow(run, schema), label)
    who = F.struct(*map(quoted, group))
    parts = stored.groupBy("part").agg(
        F.count("*").alias("n"), F.min_by(who, "at").alias("head"), F.max_by(who, "at").alias("tail"), F.max("lead").alias("lead")
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    parts = parts.withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    parts = parts.withColumn("goes_on", F.coalesce(F.col("head").eqNullSafe(F.lag("tail").over(Window.orderBy("part"))), F.lit(False)))
    began = F.when(~F.col("goes_on") | (F.col("lead") > 0), F.col("offset") + F.col("lead"))
    parts = parts.withColumn("began", began).withColumn("base", F.last("began", ignorenulls=True).over(earlier))
    parts = parts.select("part", "offset", F.when(F.col("goes_on"), F.col("base")).otherwise(F.col("offset")).alias("base"))
    # One row per range, which is at most spark.sql.shuffle.partitions.
    joined = stored.join(F.broadcast(parts), "part")
    first = F.when(F.col("lead") == 0, F.col("base")).otherwise(F.col("offset") + F.col("lead"))
    joined = joined.withColumn("run", first).withColumn("pos", F.col("offset") + F.col("at") - F.col("run"))
    return joined.select(*map(quoted, df.columns), "run", "pos")


def whole_groups(batches: Iterator[pa.RecordBatch], names: list[str], least: int) -> Iterator[pa.Table]:
    """Sorted batches as tables of whole groups, each of about ``least`` rows or of the group that is larger."""
    held, rows = [], 0
    for batch in batches:
        if not len(batch):
            continue
        starts = np.flatnonzero(changes(batch, names, held[-1] if held else None))
        if held and len(starts) and rows + starts[-1] >= least:
            yield pa.Table.from_batches([*held, batch.slice(0, int(starts[-1]))])
            held, rows, batch = [], 0, batch.slice(int(starts[-1]))
        held.append(batch)
        rows += len(batch)
    if held:
        yield pa.Table.from_batches(held)
