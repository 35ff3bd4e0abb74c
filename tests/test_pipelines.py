"""The pipelines end to end on the invented tables."""

import datetime as dt
from decimal import Decimal

import fixtures
import pytest
from pyspark.sql import functions as F

from keyloom.operators.quality import CheckFailed
from keyloom.plans import enrollment, invoices, printer_usage, student_dim, student_master
from keyloom.sources.keyed_table import KeyedTable
from keyloom.sources.snapshots import DRY_RUN, REPLACED, SnapshotTable


def by(df, key):
    return {r[key]: r for r in df.collect()}


def stored(tables, tmp_path_factory):
    """Write the tables once, so that Spark knows their sizes as it does those of real tables."""
    folder = str(tmp_path_factory.mktemp("tables"))
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{folder}/{name}")
    return {name: df.sparkSession.read.parquet(f"{folder}/{name}") for name, df in tables.items()}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    return stored(fixtures.student_tables(spark), tmp_path_factory)


def test_student_master_rows(spark, tables):
    rows = by(student_master.build(tables, override_codes=["6380002"]), "studentCode")
    assert set(rows) == {"6380001", "6380002", "6480003", "638 0004", "63A0006"}
    a, b, c, d = (rows[k] for k in ("6380001", "6380002", "6480003", "638 0004"))
    assert (a["prefixCode"], a["prefix"], a["genderName"], a["residentType"]) == ("002", "Mrs.", "female", "resident")
    assert (a["firstNameTh"], a["firstNameEn"], a["programCode"], a["studentStatusName"]) == ("สมหญิง", "SOMYING", "ABCD-001-B", "studying")
    assert (a["birthdate"], a["class"], a["citizenId"], a["passportId"], a["graduateYear"]) == ("01/02/2543", 1, "110", None, None)
    assert (b["prefixCode"], b["prefix"], b["genderName"]) == ("003", "Ms.", "female")
    assert (b["firstNameTh"], b["middleNameTh"], b["lastNameTh"]) == ("MARY ANN", "", "O'HARA")
    assert (b["studentStatusName"], b["gradStatusName"], b["terminateStudyCause"]) == (
        "take a course with IC",
        "graduated_with_first_class_honors",
        None,
    )
    assert (b["studentType"], b["studyTypeName"], b["class"], b["dateGraduation"]) == ("2", "โครงการพิเศษ", 4, dt.date(2024, 7, 1))
    assert (c["prefix"], c["genderName"], c["residentType"], c["class"]) == ("Not Specified", "male", "non-resident", 2)
    assert (c["terminateStudyCause"], c["gradStatusName"], c["birthdate"]) == ("resigned", None, None)
    assert (d["programCode"], d["studentStatusName"], d["class"], d["admitYear"]) == (None, "Others", 1, 2015)
    without = by(student_master.build(tables), "studentCode")["6380002"]
    assert (without["prefix"], without["genderName"]) == ("Not Specified", "Not Specified")


def test_student_master_transform_and_load(spark, tables, folder):
    answers = enrollment.enrollment_answers(fixtures.enrollment_answers(spark))
    assert "father_name" not in answers.columns and answers.count() == 2
    cleaned = student_master.transform(student_master.build(tables), answers, "r1", "t1")
    rows = by(cleaned.rows, "studentcode")
    assert set(rows) == {"6380001", "6380002", "6480003", "6380004"}
    assert not [c for c in cleaned.rows.columns if c.startswith("_") or "father" in c]
    a, b = rows["6380001"], rows["6380002"]
    assert (a["talentname"], a["religionname"], a["numberofsiblings"], a["email"]) == ("Thai, English", "Jain", "2", "a@x.example")
    assert (b["talentname"], b["religionname"], b["numberofsiblings"], b["email"]) == ("football", "Buddhist", " ", None)
    assert (b["firstnameth"], rows["6480003"]["firstnameth"]) == ("MARY ANN", "JOHN")
    events = {(r["action"], r["key"], r["field"]): (r["old"], r["new"]) for r in cleaned.audit.collect()}
    assert events == {
        ("DROP_ROW_BAD_KEY", "63A0006", None): (None, None),
        ("FIX_EMAIL", "6380001", "email"): ("<a@x.example>, b@x.example", "a@x.example"),
        ("FIX_EMAIL", "6380002", "email"): ("null", None),
    }
    table = KeyedTable(spark, f"{folder}/master", ["studentcode"], buckets=4, text_keys=True)
    first = student_master.load(cleaned.rows, table)
    assert (first.inserted, first.updated, first.rows_total) == (4, 0, 4)
    edited = cleaned.rows.withColumn("email", F.when(F.col("studentcode") == "6380001", "new@x.example").otherwise(F.upper("email")))
    second = student_master.load(edited, table)
    assert (second.inserted, second.updated) == (0, 1)
    assert by(table.read(), "studentcode")["6480003"]["email"] == "c@x.example"


def test_student_master_without_a_key_or_answers(spark, tables):
    keyless = spark.createDataFrame([("x",)], "Other string")
    assert student_master.transform(keyless).rows.collect() == [("x",)]
    assert student_master.transform(student_master.build(tables)).rows.count() == 4


def test_status_is_filled_from_its_sibling(spark):
    df = spark.createDataFrame([("1", None, "a"), ("2", " ", "b")], "studentCode string, studentStatus string, studentStatusName string")
    out = student_master.transform(df, run_id="r", run_ts="t")
    assert out.rows.columns == ["studentcode", "studentstatus"]
    assert {r[0]: r[1] for r in out.rows.collect()} == {"1": "a", "2": " "}
    assert [(r["action"], r["key"], r["new"]) for r in out.audit.collect()] == [("FILL_STATUS_FROM_STATUSNAME", "1", "a")]


def test_repeated_answers_fail(spark):
    twice = spark.createDataFrame([("1", "a"), ("1.0", "b")], "student_id string, religion string")
    with pytest.raises(ValueError, match="duplicate keys"):
        enrollment.enrollment_answers(twice)


def test_failures_name_the_rows(spark):
    twice = spark.createDataFrame([("1", "a", "x"), ("1.0", "b", "x"), ("2", "a", "y")], "student_id string, religion string, race string")
    with pytest.raises(ValueError, match="1: 2 rows, differing in religion"):
        enrollment.enrollment_answers(twice)
    file = spark.createDataFrame([("1", "a"), ("1.0", "b"), (" ", "c"), (None, "d"), ("3", "e")], "`Student ID` string, Note string")
    with pytest.raises(CheckFailed) as failed:
        enrollment.check_enrollment_file(file)
    assert sorted(i[0] for i in failed.value.issues) == ["duplicate", "null"]
    assert failed.value.samples["repeated keys"] == [("1", 2, ["Note"])]
    assert sorted(r["Note"] for r in failed.value.samples["blank keys"]) == ["c", "d"]


def test_invoices(spark, folder, tmp_path_factory):
    tables = stored(fixtures.invoice_tables(spark), tmp_path_factory)
    built = invoices.build(tables, manual_paid=["hand"], excluded=["out"])
    rows = by(invoices.transform(built), "invoiceId")
    day, d = dt.datetime(2024, 1, 2, 3, 4, 5), Decimal

    def facts(i):
        r = rows[i]
        return r["regisType"], r["invoiceAmount"], r["paidDate"], r["paidAmount"], r["paidStatus"], r["invoiceType"]

    assert set(rows) == {"1", "4", "5", "6", "7", "8", "15"}
    assert facts("1") == ("N", d("100.00"), dt.datetime(2024, 6, 1), d("100.00"), "Y", "หน่วยกิต")
    assert facts("4") == ("A", d("70.00"), day, d("70.00"), "Y", "หน่วยกิต")
    assert facts("5") == ("E", d("80.00"), None, d("80.00"), "Y", "หน่วยกิต")
    assert facts("6") == (None, d("90.00"), day, d("90.00"), "Y", "เหมาจ่าย")
    assert facts("7") == ("N", d("90.00"), None, d("0.00"), "N", "หน่วยกิต")
    assert facts("8") == ("N", d("10.00"), day, d("10.00"), "Y", "หน่วยกิต")
    assert facts("15") == ("N", d("20.00"), None, d("0.00"), "N", "หน่วยกิต")
    assert (rows["1"]["acaYear"], rows["1"]["semester"], rows["1"]["studentCode"]) == ("2020", 2, "6380001")

    clean = invoices.transform(built)
    invoices.check(clean)
    ordered = {r["invoiceId"]: r["_row_order"] for r in invoices.with_row_order(clean).collect()}
    assert ordered == {"1": 1, "4": 2, "5": 3, "8": 4, "6": 5, "7": 6, "15": 7}
    table = KeyedTable(spark, f"{folder}/invoice", ["invoiceId"], buckets=4)
    assert invoices.load(clean, table).inserted == 7
    assert (lambda r: (r.inserted, r.updated))(invoices.load(clean, table)) == (0, 0)
    paid = clean.withColumn("paidStatus", F.lit("Y"))
    result = invoices.load(paid, table)
    assert result.updated == 2
    assert {tuple(r["changes"]) for r in result.changes.collect()} == {("paidStatus",)}


def test_invoice_cleaning_and_checks(spark):
    columns = "invoiceId string, acaYear string, semester int, invoiceNo string, regisType string, invoiceAmount decimal(18,2), " \
        "paidDate string, paidAmount decimal(18,2), paidStatus string, invoiceType string, schNameTh string, remark string, " \
        "studentCode string, extra string"
    rest = (Decimal("1"), "Y", "t", "None", "nan", "s1", "x")
    rows = [
        (" 1 ", "2020", 1, "n", "N", Decimal("5"), "2024-01-02 03:04:05", *rest),
        ("1", "2021", 1, "n", "N", Decimal("6"), "no date", *rest),
        ("1", None, 1, "n", "N", Decimal("7"), None, *rest),
        ("x", "2020", 1, "n", "N", Decimal("5"), None, *rest),
    ]
    clean = invoices.transform(spark.createDataFrame(rows, columns))
    row = clean.first()
    assert clean.count() == 1 and "extra" not in clean.columns
    # A missing year sorts after every year, so its row is the last.
    assert (row["invoiceId"], row["invoiceAmount"], row["paidDate"], row["schNameTh"], row["remark"]) == ("1", Decimal("7.00"), None, None, None)
    with pytest.raises(CheckFailed, match="empty"):
        invoices.check(clean.limit(0))
    invoices.check(clean.limit(0), allow_empty=True)
    with pytest.raises(CheckFailed, match="non_positive invoiceAmount 1"):
        invoices.check(clean.withColumn("invoiceAmount", F.lit(None).cast("decimal(18,2)")))


def test_student_dimension(spark, tables, folder):
    master = spark.createDataFrame(
        [("6380001", "ABCD-001-B"), ("6380002", None), ("6380002", " "), ("6480003", "XXXX-001-B")], "studentCode string, programCode string"
    )
    tables = {**tables, "student_master": master}
    built = student_dim.build(tables)
    rows = by(student_dim.transform(built), "student_id")
    # Code 5 has no admission, 4 an early term, 7 and 5 no term: only these are eligible.
    assert set(rows) == {"6380001", "6480003", "63A0006"}
    a, c = rows["6380001"], rows["6480003"]
    assert (a["title"], a["first_name_en"], a["middle_name_en"], a["gender"], a["nationality"]) == ("Mrs.", "Somying", None, "female", "Thai")
    assert (a["major_code"], a["major_name"], a["division"], a["student_type"], a["admission_type"]) == (
        "ABCD",
        "Computer Science",
        "D2",
        "Full-time",
        "ปกติ",
    )
    assert (c["student_type"], c["student_status"], c["major_code"], c["major_name"], c["is_active"]) == ("External", "Resign", "XXXX", None, "0")
    gate = student_dim.ready(tables, 0.5).first()
    assert tuple(gate) == (3, 2, 0.6667, True)
    assert not student_dim.ready(tables).first()["ready"]

    ready = student_dim.transform(built)
    student_dim.check(ready, min_rows=1, max_null_ratio={"major_name": 0.9})
    with pytest.raises(CheckFailed, match="too_few_rows"):
        student_dim.check(ready)
    with pytest.raises(CheckFailed, match="null_ratio major_name"):
        student_dim.check(ready, min_rows=1)
    table = KeyedTable(spark, f"{folder}/dim", ["student_id"], buckets=2)
    assert student_dim.load(student_dim.stamped(ready, "2024-03-01 18:30:00"), table).inserted == 3
    same = student_dim.load(student_dim.stamped(ready, "2024-03-02 18:30:00"), table)
    assert (same.inserted, same.updated) == (0, 0)
    moved = student_dim.stamped(ready.withColumn("title", F.lit("Dr.")), "2024-03-03 18:30:00")
    assert student_dim.load(moved, table).updated == 3
    assert {r["ingestion_date"] for r in table.read().collect()} == {dt.datetime(2024, 3, 4)}


def test_student_dimension_cleaning(spark):
    rows = [("1", "2020", "1", "2020-05-01", None), ("1", "2021", None, "bad", "A"), ("1", "2021", "2", None, "B"), ("2", None, "1", None, None)]
    df = spark.createDataFrame(rows, "Code string, `Academic-Year` string, `academic term` string, start_date string, Grade string")
    got = by(student_dim.transform(df), "student_id")
    assert (got["1"]["grade"], got["1"]["start_date"], got["2"]["grade"], got["2"]["code"]) == ("B", None, "N/A", "2")
    with pytest.raises(CheckFailed, match="missing_column first_name_en"):
        student_dim.check(student_dim.transform(df), min_rows=1)
    keyless = student_dim.transform(spark.createDataFrame([("x",)], "name string"))
    assert keyless.first()["student_id"] is None


def test_printer_usage(spark, folder, tmp_path_factory):
    built = printer_usage.build(stored(fixtures.printer_tables(spark), tmp_path_factory))
    rows = {(r["job_type"], r["usage_calendar_year"], r["usage_calendar_month"]): r for r in printer_usage.transform(built).collect()}
    assert set(rows) == {("print", 2023, 10), ("copy", 2024, 9)}
    october, september = rows["print", 2023, 10], rows["copy", 2024, 9]
    assert (october["total_color_pages"], october["total_grayscale_pages"], october["total_pages"]) == (9, 6, 15)
    assert october["total_cost_color_pages"] == pytest.approx(43.38) and october["total_cost_pages"] == pytest.approx(46.26)
    assert (october["usage_budget_year"], october["usage_budget_month_order"]) == (2024, 1)
    assert (september["usage_budget_year"], september["usage_budget_month_order"]) == (2024, 12)
    fact = printer_usage.stamped(printer_usage.transform(built), "2024-09-02 00:00:00")
    printer_usage.check(fact)
    with pytest.raises(CheckFailed, match="null user_name"):
        printer_usage.check(fact.withColumn("user_name", F.lit(None).cast("string")))
    table = KeyedTable(spark, f"{folder}/usage", list(("user_name", "usage_calendar_year")), buckets=2)
    assert printer_usage.load(fact, table, closed_before=(2024, 9)).inserted == 1
    assert printer_usage.load(fact, table).inserted == 1
    assert printer_usage.load(fact, table).inserted == 0


def test_enrollment_refresh(spark, folder):
    table = SnapshotTable(spark, f"{folder}/e")
    table.create(spark.createDataFrame([("1", "x")], "student_id string, religion string"))
    good = spark.createDataFrame([("1", "a"), ("2.0", " ")], "`Student ID` string, Religion string")
    assert enrollment.refresh_enrollment(good, table).status == DRY_RUN
    assert enrollment.refresh_enrollment(good, table, apply=True).status == REPLACED
    for bad, message in (
        ([("1", "a"), ("1.0", "b")], "duplicate student_id"),
        ([("1", "a"), (" ", "b"), ("None", "c")], "null student_id 2"),
    ):
        with pytest.raises(CheckFailed, match=message):
            enrollment.refresh_enrollment(spark.createDataFrame(bad, good.schema), table)
    with pytest.raises(ValueError, match="not found"):
        enrollment.refresh_enrollment(good.withColumnRenamed("Student ID", "x"), table)
