"""Data-quality checks, profiles and the readiness gate, each in a fixed number of aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyloom.functions.text import is_blank


class CheckFailed(ValueError):
    """A raising check found issues; ``issues`` holds (issue, column, found) tuples, ``samples`` some offending rows."""

    def __init__(self, issues: Sequence[tuple], samples: Mapping[str, Sequence] | None = None):
        self.issues, self.samples = list(issues), dict(samples or {})
        told = [f"{i} {c or ''} {n}".replace("  ", " ") for i, c, n in self.issues]
        super().__init__("; ".join([*told, *(f"{what}: {rows}" for what, rows in self.samples.items())]))


@dataclass(frozen=True)
class Expectations:
    """What a table must satisfy before it is loaded."""

    required: Sequence[str] = ()
    not_null: Sequence[str] = ()
    not_blank: Sequence[str] = ()
    unique: str | None = None
    positive: Sequence[str] = ()
    max_null_ratio: Mapping[str, float] = field(default_factory=dict)
    min_rows: int = 1


def issues(df: DataFrame, expected: Expectations) -> DataFrame:
    """One row per violated expectation: issue, column, found (a count or a ratio as text).

    All checks share one pass and one shuffle: with a unique column the rows are first counted per key,
    on the map side too, together with what the other checks count. Missing columns are known from the schema.
    """
    spark = df.sparkSession
    have = set(df.columns)
    missing = [("missing_column", c, "0") for c in sorted(set(expected.required) - have)]
    measures: list[Column] = [F.count("*").alias("rows")]
    findings: list[tuple[str, str | None, Column, Column]] = []
    if expected.min_rows > 0:
        findings.append(("empty", None, F.col("rows") == 0, F.col("rows")))
    if expected.min_rows > 1:
        findings.append(("too_few_rows", None, F.col("rows") < expected.min_rows, F.col("rows")))

    def counted(issue: str, column: str, test: Column) -> None:
        name = f"_{issue}_{column}"
        measures.append(F.count_if(test).alias(name))
        findings.append((issue, column, F.col(name) > 0, F.col(name)))

    for c in expected.not_null:
        if c in have:
            counted("null", c, F.col(c).isNull())
    for c in expected.not_blank:
        if c in have:
            counted("blank", c, is_blank(c))
    for c in expected.positive:
        if c in have:
            counted("non_positive", c, F.coalesce(F.col(c), F.lit(0)) <= 0)
    for c, limit in expected.max_null_ratio.items():
        if c in have:
            measures.append(F.count_if(F.col(c).isNull()).alias(f"_ratio_{c}"))
            ratio = F.col(f"_ratio_{c}") / F.nullif(F.col("rows"), F.lit(0))
            findings.append(("null_ratio", c, ratio > limit, F.round(ratio, 4)))

    if expected.unique in have:
        findings.append(("duplicate", expected.unique, F.col("_repeated") > 0, F.col("_repeated")))
    rows = F.array(
        *[
            F.struct(
                F.lit(issue).alias("issue"),
                F.lit(column).cast("string").alias("column"),
                found.cast("string").alias("found"),
                F.coalesce(test, F.lit(False)).alias("hit"),
            )
            for issue, column, test, found in findings
        ]
    )
    if expected.unique in have:
        per_key = df.groupBy(F.col(expected.unique).alias("_key")).agg(*measures)
        totals = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in per_key.columns if c != "_key"]
        counted_rows = per_key.agg(*totals, F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("_repeated"))
    else:
        counted_rows = df.agg(*measures)
    report = counted_rows.select(F.inline(rows)).filter("hit").drop("hit")
    if missing:
        report = report.unionAll(spark.createDataFrame(missing, report.schema))
    return report


def require(df: DataFrame, expected: Expectations) -> None:
    """Raise ``CheckFailed`` if any expectation is violated (one small row per issue is collected)."""
    found = issues(df, expected).collect()
    if found:
        raise CheckFailed([tuple(r) for r in found])


def _filled(df: DataFrame, column: str) -> Column:
    """Only text can be blank; any other value fills its field."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return ~is_blank(column)
    return F.col(column).isNotNull()


def fill_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: rows, filled (neither NULL nor blank), empty and the filled percentage."""
    columns = list(df.columns if columns is None else columns)
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(_filled(df, c)).alias(f"_{i}") for i, c in enumerate(columns)]
    )
    per_column = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("filled")) for i, c in enumerate(columns)]
    )
    flat = counts.select("_rows", F.inline(per_column))
    percent = F.round(F.lit(100.0) * F.col("filled") / F.nullif(F.col("_rows"), F.lit(0)), 1)
    return flat.select(
        "column",
        F.col("_rows").alias("rows"),
        "filled",
        (F.col("_rows") - F.col("filled")).alias("empty"),
        F.coalesce(percent, F.lit(0.0)).alias("percent"),
    )


class FillTrace:
    """How many rows pass named points of a plan, and how many have ``column`` filled, counted by the run of the plan itself."""

    def __init__(self, column: str):
        self.column = column
        self.points: dict[str, Observation] = {}

    def at(self, df: DataFrame, point: str) -> DataFrame:
        """``df``, counted when it is first run. Use a point once."""
        self.points[point] = Observation()
        filled = _filled(df, self.column) if self.column in df.columns else F.lit(False)
        return df.observe(self.points[point], F.count(F.lit(1)).alias("rows"), F.count_if(filled).alias("filled"))

    def counts(self) -> dict[str, dict[str, int]]:
        """Rows and filled per point; ask after the plan has run."""
        return {name: {"rows": 0, "filled": 0, **seen.get} for name, seen in self.points.items()}


def empty_samples(df: DataFrame, column: str, key: str, n: int = 10) -> DataFrame:
    """The first ``n`` keys whose column is blank."""
    return df.filter(is_blank(column)).select(F.col(key).cast("string").alias(key)).orderBy(key).limit(n)


def null_ratios(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: NULL count, rows and their ratio rounded to four places."""
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(columns)]
    )
    per_column = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("nulls")) for i, c in enumerate(columns)]
    )
    flat = counts.select("_rows", F.inline(per_column))
    ratio = F.round(F.col("nulls") / F.nullif(F.col("_rows"), F.lit(0)), 4)
    return flat.select("column", "nulls", F.col("_rows").alias("rows"), F.coalesce(ratio, F.lit(0.0)).alias("ratio"))


def readiness(df: DataFrame, key: str, matched: Column, min_ratio: float = 0.90) -> DataFrame:
    """One row: distinct keys, distinct keys with a matched row, their ratio, and whether it is enough.

    One flag per key replaces two distinct counts, so each key is shuffled once.
    """
    per_key = df.filter(F.col(key).isNotNull()).groupBy(key)
    flags = per_key.agg(F.bool_or(F.coalesce(matched, F.lit(False))).alias("hit"))
    totals = flags.agg(F.count("*").alias("total"), F.count_if("hit").alias("matched"))
    ratio = F.coalesce(F.col("matched") / F.nullif(F.col("total"), F.lit(0)), F.lit(0.0))
    return totals.select(
        "total",
        "matched",
        F.round(ratio, 4).alias("ratio"),
        ((F.col("total") > 0) & (ratio >= min_ratio)).alias("ready"),
    )
