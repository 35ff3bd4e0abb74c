"""Student master: one wide text row per student, loaded with a guarded upsert."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.functions.dates import local_date_text
from keyloom.functions.rules import band, code_map, fill_null_from_sibling
from keyloom.functions.schema import all_text, normalize_columns
from keyloom.functions.text import blank_to_null, clean_digits, clean_email, script_or, upper_or
from keyloom.operators import audit
from keyloom.operators.dedupe import keep_one, split_by_key
from keyloom.operators.keyed_load import guarded
from keyloom.operators.matching import skew_join
from keyloom.plans import fixed_values as V
from keyloom.plans.enrollment import merge_enrollment
from keyloom.operators.quality import FillTrace
from keyloom.plans.runs import RunReport, run_job
from keyloom.sources.keyed_table import KeyedTable, LoadResult
from keyloom.sources.ledger import RunLedger

Inputs = Mapping[str, DataFrame]


def _lookup(table: DataFrame, key: str, columns: Mapping[str, str], id_column: str = "Id") -> DataFrame:
    return table.select(F.col(id_column).alias(key), *[F.col(c).alias(n) for c, n in columns.items()])


def _null(name: str) -> Column:
    return F.lit(None).cast("string").alias(name)


def _joined(tables: Inputs) -> DataFrame:
    students = tables["students"].filter((F.col("Code") >= V.CODE_RANGE[0]) & (F.col("Code") < V.CODE_RANGE[1]))
    programme = tables["curriculum_infos"].filter("IsActive").select(
        F.col("StudentId").alias("Id"), F.col("CurriculumVersionId").alias("_version")
    )
    versions = _lookup(tables["curriculum_versions"], "_version", {"CurriculumId": "_curriculum", "NameEn": "_programme"})
    curricula = _lookup(tables["curricula"], "_curriculum", {"AbbreviationEn": "_abbreviation"})
    academic = _lookup(tables["academic_infos"], "Id", {"CreditEarned": "_credits"}, "StudentId")
    admission = _lookup(tables["admission_infos"], "Id", {"AdmissionTermId": "_term"}, "StudentId")
    terms = _lookup(tables["terms"], "_term", {"AcademicYear": "_year", "AcademicTerm": "_number"})
    graduation = _lookup(
        tables["graduation_infos"].filter("IsActive"), "Id", {"GraduatedAt": "_graduated"}, "StudentId"
    )
    nations = _lookup(tables["nationalities"], "NationalityId", {"NameEn": "_nation"})
    fee_types = _lookup(tables["student_fee_types"], "StudentFeeTypeId", {"NameEn": "_fee_type"})
    df = students.join(programme, "Id")
    # Hot keys are looked for in the table a key comes from.
    df = skew_join(df, versions, "_version", probe=programme)
    df = skew_join(df, curricula, "_curriculum", probe=versions)
    for right in (academic, admission, graduation):
        df = df.join(right, "Id", "left")
    df = skew_join(df, terms, "_term", probe=admission)
    df = skew_join(df, nations, "NationalityId", probe=students)
    return skew_join(df, fee_types, "StudentFeeTypeId", probe=students)


def build(tables: Inputs, override_codes: Sequence[str] = ()) -> DataFrame:
    """Distinct master rows of all students with an active programme.

    ``override_codes`` are student codes whose title and gender are set by hand.
    """
    df = _joined(tables)
    by_hand = F.col("Code").isin(*override_codes) if override_codes else F.lit(False)
    title_id, status = F.col("TitleId").cast("string"), F.col("StudentStatus")
    hand_title = (title_id == V.OVERRIDE_TITLE_ID) & by_hand
    inbound = F.col("_fee_type") == V.INBOUND_FEE_TYPE
    graduated = F.to_date("_graduated")

    def some(codes: Sequence[str]) -> Column:
        return code_map(status, {c: V.STATUS_NAMES[c] for c in codes})

    placeholders_1 = ("religionName", "bloodTypeName", "maritalStatusName", "numberOfSiblings", "sequenceChild")
    placeholders_2 = ("passportStartDate", "passportEndDate", "passportStatusName", "raceName")
    placeholders_3 = ("deformName", "deformCardId", "deformCardStartdate", "deformCardEnddate")
    return df.select(
        F.col("Code").alias("studentCode"),
        code_map(title_id, V.TITLE_CODES, V.NOT_SPECIFIED, F.when(hand_title, V.OVERRIDE_TITLE_CODE)).alias("prefixCode"),
        code_map(title_id, V.TITLES, V.NOT_SPECIFIED, F.when(hand_title, V.OVERRIDE_TITLE)).alias("prefix"),
        upper_or("FirstNameTh", "FirstNameEn").alias("firstNameTh"),
        upper_or("MidNameTh", "MidNameEn").alias("middleNameTh"),
        upper_or("LastNameTh", "LastNameEn").alias("lastNameTh"),
        F.upper(F.trim("FirstNameEn")).alias("firstNameEn"),
        F.upper(F.trim("MidNameEn")).alias("middleNameEn"),
        F.upper(F.trim("LastNameEn")).alias("lastNameEn"),
        F.when(F.col("Gender") == 1, V.GENDERS[1])
        .when((F.col("Gender") == 2) | by_hand, V.OVERRIDE_GENDER)
        .otherwise(V.NOT_SPECIFIED)
        .alias("genderName"),
        F.col("_year").alias("admitYear"),
        F.col("_number").alias("intakeTermNumber"),
        F.lit(V.FACULTY_NAME).alias("facultyName"),
        F.concat("_abbreviation", F.lit(V.PROGRAMME_SUFFIX)).alias("programCode"),
        F.col("_programme").alias("programName"),
        F.lit(V.PROGRAMME_TYPE).alias("programType"),
        F.lit(V.ENTRANCE_TYPE).alias("entranceTypeName"),
        F.when(F.col("NationalityId") == V.RESIDENT_NATIONALITY_ID, V.RESIDENT)
        .otherwise(V.NON_RESIDENT)
        .alias("residentType"),
        F.when(inbound, V.INBOUND_STUDENT_TYPE).otherwise(V.REGULAR_STUDENT_TYPE).alias("studentType"),
        code_map(
            status,
            V.STATUS_NAMES,
            V.OTHER_STATUS,
            F.when(F.col("_abbreviation").isin(*V.PROGRAMMES_TAKEN_AS_GUEST), V.GUEST_STATUS),
        ).alias("studentStatusName"),
        local_date_text("BirthDate").alias("birthdate"),
        F.col("Email").alias("email"),
        F.col("_nation").alias("NationalityName"),
        *[_null(c) for c in placeholders_1],
        _null("numberOfSiblingsStillStudying"),
        blank_to_null("CitizenNumber").alias("citizenId"),
        blank_to_null("Passport").alias("passportId"),
        *[_null(c) for c in placeholders_2],
        graduated.alias("graduateYear"),
        *[_null(c) for c in placeholders_3],
        some(V.TERMINATE_STATUSES).alias("terminateStudyCause"),
        F.when(inbound, V.SPECIAL_STUDY_TYPE).otherwise(V.REGULAR_STUDY_TYPE).alias("studyTypeName"),
        F.lit(V.STUDY_TIME).alias("studyTimeName"),
        band("_credits", V.CREDIT_BANDS, V.TOP_CREDIT_BAND, V.DEFAULT_BAND).alias("class"),
        _null("programRegistName"),
        some(V.GRADUATE_STATUSES).alias("gradStatusName"),
        graduated.alias("dateGraduation"),
        _null("talentName"),
        _null("systemId"),
    ).distinct()


class Cleaned(NamedTuple):
    """``rows`` are ready to load; ``audit`` holds one event per edit and per rejected row."""

    rows: DataFrame
    audit: DataFrame


TRACED = "studentstatus"


def transform(
    master: DataFrame, answers: DataFrame | None = None, run_id: str = "", run_ts: str = "", trace: FillTrace | None = None
) -> Cleaned:
    """Enrich, reject unusable keys, clean mail and names, keep one row per student.

    Old and new values of an audit event come from the same row. Of several rows with one code the
    greatest by all columns is kept, so that reruns agree. ``trace`` counts the rows at five points.
    """

    def point(df: DataFrame, name: str) -> DataFrame:
        return df if trace is None else trace.at(df, name)

    df = point(normalize_columns(master), "after_normalize")
    if V.MASTER_KEY not in df.columns:
        return Cleaned(df, audit.events(df.limit(0), audit.DROP_BAD_KEY, df.columns[0], run_id, run_ts))
    if answers is not None:
        df = point(merge_enrollment(df, answers), "after_enrollment")
    good, bad = split_by_key(df, V.MASTER_KEY, clean_digits(V.MASTER_KEY))
    good = point(good, "after_drop_keys")
    rejected = audit.events(bad, audit.DROP_BAD_KEY, V.MASTER_KEY, run_id, run_ts)

    fields, new = [], {}
    if "email" in good.columns:
        new["email"] = clean_email("email")
        fields.append((audit.FIX_EMAIL, "email", F.col("email"), new["email"]))
    if {"studentstatus", "studentstatusname"} <= set(good.columns):
        filled = F.coalesce("studentstatus", "studentstatusname")
        fields.append((audit.FILL_STATUS, "studentstatus", F.col("studentstatus"), filled))
    for local, english in V.NAME_PAIRS:
        if {local, english} <= set(good.columns):
            new[local] = script_or(local, english)
            fields.append((audit.FALLBACK_NAME, local, F.col(local), new[local]))
    trail = rejected
    if fields:
        trail = rejected.unionByName(audit.edits(good, V.MASTER_KEY, fields, run_id, run_ts))
    edited = fill_null_from_sibling(good.withColumns(new) if new else good, "studentstatus", "studentstatusname")
    edited = point(edited, "after_fill_status")
    return Cleaned(point(keep_one(edited, [V.MASTER_KEY], []), "final"), trail)


def run(
    tables: Mapping[str, DataFrame], answers: DataFrame | None, table: KeyedTable, ledger: RunLedger, audit_path: str, run_ts: str
) -> RunReport:
    """Extract, clean, load, each written once; the summary counts fixed and dropped rows and traces the status."""
    trace = FillTrace(TRACED)

    def clean(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        return transform(rows, answers, ledger.run_id, run_ts, trace)

    return run_job(ledger, lambda: build(tables), clean, None, lambda rows: load(rows, table), V.MASTER_KEY, audit_path, run_ts, trace)


def load(rows: DataFrame, table: KeyedTable, ignore: Sequence[str] = ()) -> LoadResult:
    """Guarded upsert of the cleaned rows, all as text."""
    return table.load(all_text(rows), guarded(V.MASTER_KEY, ignore))
