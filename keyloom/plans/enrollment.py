"""Enrollment answers: reading them, merging them into the student master, refreshing their table."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.functions.rules import fill_if_blank, resolve_option
from keyloom.functions.schema import normalize_columns, normalize_name, wanted_columns
from keyloom.functions.text import bullets, clean_id, strip_unicode
from keyloom.operators.dedupe import duplicate_report, require_single_rows
from keyloom.operators.matching import skew_join
from keyloom.operators.quality import CheckFailed, Expectations, issues
from keyloom.plans import fixed_values as V
from keyloom.sources.snapshots import RefreshReport, SnapshotTable

log = logging.getLogger(__name__)

WANTED = [
    V.ENROLLMENT_KEY,
    *V.TALENT_COLUMNS,
    *V.SIBLING_COLUMNS,
    *(c for base in V.OPTION_COLUMNS for c in (base, base + V.OPTION_SUFFIX)),
]


def enrollment_answers(raw: DataFrame, check: bool = True) -> DataFrame:
    """The wanted columns with a clean key; raises if the key is absent or repeats."""
    df, missing = wanted_columns(normalize_columns(raw, dashes=False), V.ENROLLMENT_KEY, WANTED)
    if missing:
        log.warning("enrollment columns not found: %s", missing)
    df = df.withColumn(V.ENROLLMENT_KEY, clean_id(V.ENROLLMENT_KEY)).filter(F.col(V.ENROLLMENT_KEY).isNotNull())
    if check:
        require_single_rows(df, V.ENROLLMENT_KEY)
    return df


def merge_enrollment(master: DataFrame, answers: DataFrame) -> DataFrame:
    """Fill blank master fields from the enrollment answers of the same student; the master wins.

    The key is matched as trimmed text, before it is cleaned. No answer column stays in the result.
    """
    prefixed = answers.withColumnsRenamed({c: f"_enr_{c}" for c in answers.columns})
    prefixed = prefixed.withColumnRenamed(f"_enr_{V.ENROLLMENT_KEY}", V.MASTER_KEY)
    df = master.withColumn(V.MASTER_KEY, strip_unicode(F.col(V.MASTER_KEY).cast("string")))
    df = skew_join(df, prefixed, V.MASTER_KEY, "left")

    def answer(c: str):
        return F.col(f"_enr_{c}") if c in answers.columns else F.lit(None).cast("string")

    talents = [f"_enr_{c}" for c in V.TALENT_COLUMNS if c in answers.columns]
    df = fill_if_blank(df, V.TALENT_TARGET, bullets(talents, limit=V.TALENT_WIDTH) if talents else F.lit(None).cast("string"))
    for column, target in V.SIBLING_COLUMNS.items():
        if column in answers.columns:
            df = fill_if_blank(df, target, answer(column))
    for column, target in V.OPTION_COLUMNS.items():
        df = fill_if_blank(df, target, resolve_option(answer(column), answer(column + V.OPTION_SUFFIX)))
    return df.drop(*[c for c in df.columns if c.startswith("_enr_")])


def check_enrollment_file(df: DataFrame, samples: int = 10) -> None:
    """Raise unless the file has the key column, no blank key and no repeated key; the error shows some offending rows."""
    key = next((c for c in df.columns if normalize_name(c, dashes=False) == V.ENROLLMENT_KEY), None)
    if key is None:
        raise ValueError(f"column {V.ENROLLMENT_KEY!r} not found in {df.columns[:10]}")
    keys = df.select(clean_id(F.col(f"`{key}`")).alias(V.ENROLLMENT_KEY))
    found = issues(keys, Expectations(not_null=[V.ENROLLMENT_KEY], unique=V.ENROLLMENT_KEY, min_rows=0)).collect()
    if found:  # only then are rows fetched, a few of each kind
        tagged = df.withColumn("_clean", clean_id(F.col(f"`{key}`")))
        blank = tagged.filter(F.col("_clean").isNull()).drop("_clean").limit(samples)
        repeated = duplicate_report(tagged.filter(F.col("_clean").isNotNull()), "_clean", [c for c in df.columns if c != key])
        shown = {
            "blank keys": [r.asDict() for r in blank.collect()],
            "repeated keys": [(r["_clean"], r["rows"], r["differing"]) for r in repeated.orderBy("_clean").limit(samples).collect()],
        }
        raise CheckFailed([tuple(r) for r in found], {k: v for k, v in shown.items() if v})


def refresh_enrollment(
    source: DataFrame, table: SnapshotTable, apply: bool = False, allow_mismatch: bool = False
) -> RefreshReport:
    """Check the file, then replace the table's rows; a dry run unless ``apply``."""
    check_enrollment_file(source)
    return table.refresh(source, V.ENROLLMENT_KEY, apply, allow_mismatch)
