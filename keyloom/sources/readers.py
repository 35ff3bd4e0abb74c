"""Table readers: Parquet and text exports, JDBC with partitioned reads."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from keyloom.functions.schema import all_text, normalize_columns

STAR_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


class Tables:
    """Lazy access to the Parquet tables of a folder: ``tables.orders``, ``tables["orders"]``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]


def jdbc_options(
    url: str,
    table: str,
    partition: tuple[str, int, int, int] | None = None,
    fetch_size: int = 10_000,
    properties: Mapping[str, str] | None = None,
    one_task: bool = False,
) -> dict[str, str]:
    """Options of a JDBC read; ``partition`` is (column, lowest, highest, number of partitions).

    Without a partition column one task reads the whole table, so that has to be asked for (``one_task``).
    """
    if not partition and not one_task:
        raise ValueError("name a partition column, or ask for one_task")
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    if partition:
        column, low, high, count = partition
        options |= {
            "partitionColumn": column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(count),
        }
    return options


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    """A base table over JDBC. Filters and column pruning are pushed down; joins run in Spark."""
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def read_tables(read: Callable[[str], DataFrame], names: Mapping[str, str]) -> dict[str, DataFrame]:
    """Logical name → DataFrame, reading each physical table with ``read``."""
    return {logical: read(physical) for logical, physical in names.items()}


def read_text_export(spark: SparkSession, path: str, separator: str = ",", multi_line: bool = False) -> DataFrame:
    """A spreadsheet export (delimited text with a header), every column text, names normalized.

    ``multi_line`` reads quoted cells with line breaks, at the price of one task per file.
    """
    options = {"header": True, "inferSchema": False, "multiLine": multi_line, "escape": '"', "sep": separator}
    return normalize_columns(spark.read.options(**options).csv(path), dashes=False)


def read_json_export(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A JSON-lines export, the given columns as text, names normalized."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return normalize_columns(spark.read.schema(schema).json(path), dashes=False)


def read_parquet_export(spark: SparkSession, path: str) -> DataFrame:
    return normalize_columns(all_text(spark.read.parquet(path)), dashes=False)
