"""One row per key, duplicate reports, global ordinals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyloom.functions.rules import any_of
from keyloom.functions.text import collated
from keyloom.session import materialize


def tie_break(df: DataFrame, used: Sequence[str]) -> list[Column]:
    """All other orderable columns, so that equal sort keys still give one definite row."""
    unordered = (T.MapType, T.VariantType)
    return [
        F.col(f.name).desc_nulls_last()
        for f in df.schema
        if f.name not in used and not isinstance(f.dataType, unordered)
    ]


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column], total: bool = True) -> DataFrame:
    """The first row of each key in the given order; NULL keys count as equal.

    The rank filter is pushed into both sides of the shuffle, so a map task sends one row per key
    and a key that owns a third of the table costs its reducer no more than one row per map task.
    ``total`` breaks ties by all remaining columns.
    """
    ranks = [*order, *(tie_break(df, list(keys)) if total else [])] or [F.lit(1)]
    window = Window.partitionBy(*keys).orderBy(*ranks)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def duplicate_report(df: DataFrame, key: str, fields: Sequence[str] | None = None) -> DataFrame:
    """Keys with more than one row: the row count and the fields whose values differ.

    NULL counts as a value. A field differs if its minimum and maximum do, or if it is NULL in some
    rows only; that needs no distinct aggregate and combines on the map side.
    """
    fields = [c for c in df.columns if c != key] if fields is None else list(fields)
    measures = [F.count("*").alias("rows")]
    for i, c in enumerate(fields):
        measures += [F.min(c).alias(f"_lo{i}"), F.max(c).alias(f"_hi{i}"), F.count(c).alias(f"_n{i}")]
    grouped = df.groupBy(key).agg(*measures).filter("rows > 1")
    differing = [
        F.when(
            (F.col(f"_lo{i}") != F.col(f"_hi{i}")) | ((F.col(f"_n{i}") > 0) & (F.col(f"_n{i}") < F.col("rows"))),
            F.lit(c),
        )
        for i, c in enumerate(fields)
    ]
    names = F.array_compact(F.array(*differing)) if fields else F.array().cast("array<string>")
    return grouped.select(key, "rows", names.alias("differing"))


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows repeat an earlier row's key (NULL is one key)."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def repeated_keys(df: DataFrame, keys: Sequence[str], trim: bool = False, caseless: bool = False) -> DataFrame:
    """Every key that occurs more than once, and how often; with ``trim``, without the blanks around it."""
    group = [F.trim(F.col(k).cast("string")).alias(k) if trim else F.col(k) for k in keys]
    group = [collated(g).alias(k) for g, k in zip(group, keys, strict=True)] if caseless else group
    return df.groupBy(*group).agg(F.count("*").alias("rows")).filter("rows > 1")


def require_unique(df: DataFrame, keys: Sequence[str], trim: bool = False, caseless: bool = False) -> None:
    """Raise if a key repeats; the first offenders go into the message, ``repeated_keys`` has all."""
    sample = repeated_keys(df, keys, trim, caseless).orderBy(*keys).limit(20).collect()
    if sample:
        raise ValueError(f"duplicate keys {list(keys)}: {[tuple(r) for r in sample]}")


def require_single_rows(df: DataFrame, key: str, n: int = 20) -> None:
    """Raise if a key repeats, naming the first offenders, their rows and the fields they differ in."""
    found = duplicate_report(df, key).orderBy(key).limit(n).collect()
    if found:
        told = [f"{r[0]}: {r['rows']} rows, {'differing in ' + ', '.join(r['differing']) if r['differing'] else 'equal in all fields'}" for r in found]
        raise ValueError(f"duplicate keys {[key]}: {'; '.join(told)}")


def split_by_key(df: DataFrame, key: str, cleaned: Column) -> tuple[DataFrame, DataFrame]:
    """Rows whose cleaned key is usable (with the clean key) and the rejected rows as they came."""
    tagged = df.withColumn("_clean", cleaned)
    good = tagged.filter(F.col("_clean").isNotNull()).withColumn(key, F.col("_clean")).drop("_clean")
    return good, tagged.filter(F.col("_clean").isNull()).drop("_clean")


def ordinal(df: DataFrame, order: Sequence[Column], name: str = "row_order") -> DataFrame:
    """1..n in the given order, without a single-partition window.

    The sorted rows are written once; a row's number is its position in its partition plus the rows
    of the partitions before it. Only those per-partition counts meet in one task.
    """
    tagged = df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id())
    stored = materialize(tagged, "ordinal")
    stored = stored.withColumn("_part", F.shiftright("_id", 33))
    counts = stored.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    position = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    # One offset per partition of the sort: at most spark.sql.shuffle.partitions rows to broadcast.
    return stored.join(F.broadcast(offsets), "_part").select(
        *df.columns, (position + F.col("_offset") + 1).cast("long").alias(name)
    )


def whole_row_distinct(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def differing_rows(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """True if any pair differs, NULL being equal to NULL only."""
    return any_of([~a.eqNullSafe(b) for a, b in zip(left, right, strict=True)])
