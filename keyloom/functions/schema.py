"""Column names, column sets and typed casts. Driver-side metadata only: no data is read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalize_name(name: str, dashes: bool = True) -> str:
    """Lower case, outer blanks removed, spaces (and dashes) to underscores."""
    plain = name.strip().replace(" ", "_").lower()
    return plain.replace("-", "_") if dashes else plain


def normalize_columns(df: DataFrame, dashes: bool = True) -> DataFrame:
    return df.toDF(*[normalize_name(c, dashes) for c in df.columns])


def wanted_columns(df: DataFrame, key: str, wanted: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The wanted columns the frame has, and the names of those it lacks; the key must be there."""
    if key not in df.columns:
        raise ValueError(f"key column {key!r} not found in {df.columns}")
    present = [c for c in wanted if c in df.columns]
    return df.select(*present), [c for c in wanted if c not in df.columns]


class Alignment(NamedTuple):
    """``frame`` has the matched columns under their target names, in target order."""

    frame: DataFrame
    missing_in_source: list[str]
    missing_in_target: list[str]

    @property
    def exact(self) -> bool:
        return not (self.missing_in_source or self.missing_in_target)


def align_columns(source: DataFrame, target_columns: Sequence[str]) -> Alignment:
    """Match columns regardless of case and of spaces against underscores."""
    by_name = {normalize_name(c, dashes=False): c for c in source.columns}
    targets = {normalize_name(c, dashes=False): c for c in target_columns}
    matched = [F.col(f"`{by_name[n]}`").alias(c) for n, c in targets.items() if n in by_name]
    return Alignment(
        source.select(*matched),
        sorted(c for n, c in targets.items() if n not in by_name),
        sorted(c for n, c in by_name.items() if n not in targets),
    )


def shared_columns(source: DataFrame, target: DataFrame, skip: Sequence[str] = ()) -> Mapping[str, str]:
    """Target column → source column for names that agree without regard to case."""
    skipped = {c.lower() for c in skip}
    by_name = {c.lower(): c for c in source.columns}
    return {c: by_name[c.lower()] for c in target.columns if c.lower() in by_name and c.lower() not in skipped}


def cast_to(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Select the schema's columns in its order and cast them.

    Strict casts raise on a bad value (ANSI); lenient casts give NULL.
    """
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    as_type = "cast" if strict else "try_cast"
    return df.select(*[getattr(F.col(f.name), as_type)(f.dataType).alias(f.name) for f in schema])


def all_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def widen(target: DataFrame, source: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """Add to ``target`` the columns only ``source`` has, as NULL text; names compare without case."""
    known = {c.lower() for c in target.columns} | {c.lower() for c in skip}
    extra = [c for c in source.columns if c.lower() not in known]
    return target.select("*", *[F.lit(None).cast("string").alias(c) for c in extra])
