"""Student dimension: analytics attributes per student, loaded with an exact-change upsert."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.functions.dates import ingestion_date, lenient_timestamp
from keyloom.functions.rules import code_map
from keyloom.functions.schema import normalize_columns
from keyloom.functions.text import capitalize
from keyloom.operators.dedupe import keep_one
from keyloom.operators.keyed_load import exact
from keyloom.operators.matching import latest_match, skew_join
from keyloom.operators.quality import Expectations, readiness, require
from keyloom.plans import fixed_values as V
from keyloom.plans.runs import RunReport, run_job
from keyloom.sources.keyed_table import KeyedTable, LoadResult
from keyloom.sources.ledger import RunLedger

Inputs = Mapping[str, DataFrame]


def eligible() -> Column:
    """The students both the extract and the readiness gate look at."""
    return F.col("StudentStatus").isin(*V.ELIGIBLE_STATUSES) & (F.col("_year") >= V.FIRST_ACADEMIC_YEAR)


def _placed(tables: Inputs, students: DataFrame) -> DataFrame:
    """Students with their admission term and type."""
    admission = tables["admission_infos"].select(
        F.col("StudentId").alias("Id"), F.col("AdmissionTermId").alias("_term"), F.col("AdmissionTypeId").alias("_type")
    )
    return students.join(admission, "Id", "left")


def _admitted(tables: Inputs) -> DataFrame:
    """Eligible students with their admission term and their master rows' programme codes."""
    terms = tables["terms"].select(
        F.col("Id").alias("_term"), F.col("AcademicYear").alias("_year"), F.col("AcademicTerm").alias("_number")
    )
    # The result is distinct, so copies of one master row may go before the join.
    master = tables["student_master"].select(
        F.col("studentCode").alias("Code"), F.col("programCode").alias("_programme")
    ).distinct()
    # Hot keys are looked for in the tables the key comes from, not in what has been joined so far.
    probe = _placed(tables, tables["students"].select("Id"))
    df = skew_join(_placed(tables, tables["students"]), terms, "_term", probe=probe)
    return df.filter(eligible()).join(master, "Code", "left")


def build(tables: Inputs) -> DataFrame:
    """Distinct attribute rows; a student repeats if the master repeats the code."""

    def named(table: str, key: str, column: str, name: str) -> DataFrame:
        return tables[table].select(F.col("Id").alias(key), F.col(column).alias(name))

    df = _admitted(tables)
    lookups = (
        (named("titles", "TitleId", "NameEn", "_title"), "TitleId"),
        (named("nationalities", "NationalityId", "NameEn", "_nation"), "NationalityId"),
        (named("resident_types", "ResidentTypeId", "NameEn", "_resident"), "ResidentTypeId"),
        (named("student_fee_types", "StudentFeeTypeId", "NameEn", "_fee_type"), "StudentFeeTypeId"),
        # A student type needs an admission type the master table knows.
        (named("admission_types", "_type", "NameTh", "_admission").withColumn("_known", F.lit(True)), "_type"),
    )
    for right, key in lookups:
        probe = _placed(tables, tables["students"].select("Id")) if key == "_type" else tables["students"]
        df = skew_join(df, right, key, probe=probe)
    df = df.withColumn("_major", F.substring("_programme", 1, V.MAJOR_CODE_LENGTH))
    codes = tables["student_master"].select(F.substring("programCode", 1, V.MAJOR_CODE_LENGTH).alias("_major"))
    majors = {"NameEn": "_major_name", "Division": "_division", "DivisionName": "_division_name"}
    df = latest_match(df, tables["majors"], "_major", "Major", "Id", majors, probe=codes)
    student_type = F.when(F.col("_known"), F.col("_type"))
    return df.select(
        F.col("Code").alias("code"),
        F.col("_title").alias("title"),
        capitalize("FirstNameEn").alias("first_name_en"),
        capitalize("MidNameEn").alias("middle_name_en"),
        capitalize("LastNameEn").alias("last_name_en"),
        code_map("Gender", V.DIM_GENDERS, V.DIM_GENDER_DEFAULT).alias("gender"),
        F.coalesce(code_map("_nation", V.NATIONALITY_NAMES).cast("string"), F.col("_nation")).alias("nationality"),
        F.col("_resident").alias("resident_type"),
        F.col("_fee_type").alias("student_fee_type"),
        F.col("_year").alias("academic_year"),
        F.col("_number").alias("academic_term"),
        F.col("_admission").alias("admission_type"),
        code_map(student_type, V.ADMISSION_STUDENT_TYPES, V.ADMISSION_DEFAULT).alias("student_type"),
        code_map("StudentStatus", V.DIM_STATUSES, V.DIM_STATUS_DEFAULT).alias("student_status"),
        F.col("_major").alias("major_code"),
        F.col("_major_name").alias("major_name"),
        F.col("_division").alias("division"),
        F.col("_division_name").alias("division_name"),
        F.when(F.col("IsActive"), "1").otherwise("0").alias("is_active"),
    ).distinct()


def ready(tables: Inputs, min_ratio: float = V.READY_RATIO) -> DataFrame:
    """Is the student master filled far enough for this run? One row."""
    return readiness(_admitted(tables), "Code", F.trim("_programme") != "", min_ratio)


def transform(df: DataFrame) -> DataFrame:
    """Key column, lenient dates, default grade, distinct rows, newest row per student."""
    df = normalize_columns(df)
    if "student_id" not in df.columns:
        df = df.withColumn("student_id", F.col("code") if "code" in df.columns else F.lit(None).cast("string"))
    dates = {c: lenient_timestamp(F.col(c).cast("string")) for c in df.columns if c.endswith("_date")}
    df = df.withColumns(dates) if dates else df
    if "grade" in df.columns:
        df = df.fillna({"grade": V.MISSING_GRADE})
    newest = [F.col(c).desc_nulls_last() for c in ("academic_year", "academic_term") if c in df.columns]
    # Whole-row copies share the key, so keeping one row per key removes them too.
    return keep_one(df, ["student_id"], newest)


def check(df: DataFrame, min_rows: int = V.DIM_MIN_ROWS, max_null_ratio: Mapping[str, float] | None = None) -> None:
    ratios = V.DIM_NULL_RATIOS if max_null_ratio is None else max_null_ratio
    require(
        df,
        Expectations(
            required=V.DIM_REQUIRED,
            not_null=["student_id"],
            unique="student_id",
            max_null_ratio=ratios,
            min_rows=min_rows,
        ),
    )


def stamped(df: DataFrame, run_ts: str) -> DataFrame:
    """Add the load-time columns: the local day of the run, and the key under its second name."""
    if "ingestion_date" not in df.columns:
        df = df.withColumn("ingestion_date", ingestion_date(F.lit(run_ts).cast("timestamp")))
    return df if "code" in df.columns else df.withColumn("code", F.col("student_id"))


def load(df: DataFrame, table: KeyedTable) -> LoadResult:
    return table.load(df, exact("student_id"))


def run(
    tables: Inputs, table: KeyedTable, ledger: RunLedger, audit_path: str, run_ts: str, min_rows: int = V.DIM_MIN_ROWS
) -> RunReport:
    """Build, check and load as one run with a ledger; ``ready`` says beforehand whether it should."""

    def clean(rows: DataFrame) -> DataFrame:
        return stamped(transform(rows), run_ts)

    return run_job(
        ledger, lambda: build(tables), clean, lambda df: check(df, min_rows), lambda df: load(df, table), "student_id", audit_path, run_ts
    )
