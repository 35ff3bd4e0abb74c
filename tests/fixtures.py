"""Small invented source tables that hold the edge rows of the pipelines."""

import datetime as dt
from decimal import Decimal



def student_tables(spark):
    frame = spark.createDataFrame
    ts = dt.datetime
    students = [
        # Id, Code, TitleId, names Th (first, mid, last), names En, Gender, status, birth, email, nation, citizen, passport, fee, resident, active
        (1, "6380001", "17", "สมหญิง", None, "ใจดี", "Somying", None, "Jaidee", 2, "s", ts(2000, 1, 31, 18), "<a@x.example>, b@x.example", 93, "110", " ", 1, 1, True),
        (2, "6380002", "44", " ", "", None, "mary ANN", "", "o'HARA", None, "g1", ts(2001, 5, 2, 1), "null", 7, "", "P2", 2, 2, True),
        (3, "6480003", "99", "John", "X", "Doe", "John", "X", "Doe", 1, "rs", None, "c@x.example", None, None, None, None, None, False),
        (4, "638 0004", "14", "ชาย", None, "ดี", "Chai", None, "Dee", 1, "zz", ts(1999, 12, 31, 23), None, 93, "1", "1", 1, 1, True),
        (5, "9080005", "14", "นอก", None, "ช่วง", "Out", None, "Range", 1, "s", None, None, 93, "1", "1", 1, 1, True),
        (6, "63A0006", "18", "ไม่", None, "ดี", "Bad", None, "Key", 1, "s", None, None, 93, "1", "1", 1, 1, True),
        (7, "6380007", "12", "พัก", None, "อยู่", "No", None, "Programme", 1, "s", None, None, 93, "1", "1", 1, 1, True),
    ]
    return {
        "students": frame(
            students,
            "Id long, Code string, TitleId string, FirstNameTh string, MidNameTh string, LastNameTh string, FirstNameEn string, "
            "MidNameEn string, LastNameEn string, Gender int, StudentStatus string, BirthDate timestamp, Email string, "
            "NationalityId int, CitizenNumber string, Passport string, StudentFeeTypeId int, ResidentTypeId int, IsActive boolean",
        ),
        "curriculum_infos": frame(
            [(1, 10, True), (2, 20, True), (3, 10, True), (4, 99, True), (5, 10, True), (6, 10, True), (7, 10, False)],
            "StudentId long, CurriculumVersionId long, IsActive boolean",
        ),
        "curriculum_versions": frame([(10, 100, "Computer Science"), (20, 200, "Guest")], "Id long, CurriculumId long, NameEn string"),
        "curricula": frame([(100, "ABCD"), (200, "DTDS")], "Id long, AbbreviationEn string"),
        "academic_infos": frame(
            [(1, Decimal("36.5")), (2, Decimal("106")), (3, Decimal("70"))], "StudentId long, CreditEarned decimal(6,2)"
        ),
        "admission_infos": frame(
            [(1, 1, 1), (2, 2, 3), (3, 1, 9), (4, 3, 7), (6, 1, 1)], "StudentId long, AdmissionTermId long, AdmissionTypeId int"
        ),
        "terms": frame([(1, 2020, 1), (2, 2021, 1), (3, 2015, 2)], "Id long, AcademicYear int, AcademicTerm int"),
        "graduation_infos": frame(
            [(2, True, ts(2024, 7, 1, 9)), (1, False, ts(2020, 1, 1))], "StudentId long, IsActive boolean, GraduatedAt timestamp"
        ),
        "nationalities": frame([(93, "Thai"), (7, "Myanmar")], "Id int, NameEn string"),
        "student_fee_types": frame([(1, "regular"), (2, "inbound")], "Id int, NameEn string"),
        "titles": frame([("17", "Mrs."), ("44", "Dr.")], "Id string, NameEn string"),
        "resident_types": frame([(1, "Resident"), (2, "Non")], "Id int, NameEn string"),
        "admission_types": frame([(1, "ปกติ"), (3, "แลกเปลี่ยน"), (7, "ฤดูร้อน")], "Id int, NameTh string"),
        "majors": frame(
            [(1, "ABCD", "Old name", "D1", "Old"), (2, "ABCD", "Computer Science", "D2", "Science"), (3, None, "x", "x", "x")],
            "Id long, Major string, NameEn string, Division string, DivisionName string",
        ),
    }


def enrollment_answers(spark):
    columns = (
        "`Student ID` string, Talent_Foreign_Language string, `Talent Sports` string, number_of_siblings string, "
        "religion string, religion_option string, marital_status string, father_name string"
    )
    rows = [
        ("6380001.0", "- Thai\r\n- English", "-", "2", "Other", "Jain", "single", "private"),
        ("6380002", None, "football", " ", "Buddhist", "x", None, "private"),
        ("nan", "x", "x", "1", "x", "x", "x", "private"),
        (None, "x", "x", "1", "x", "x", "x", "private"),
    ]
    return spark.createDataFrame(rows, columns)


def invoice_tables(spark):
    frame, ts, d = spark.createDataFrame, dt.datetime, Decimal
    day = ts(2024, 1, 2, 3, 4, 5, 678_000)
    later = ts(2024, 6, 1)
    invoices = [
        # Id, Number, Type, TermId, StudentId, Amount, Total, UpdatedAt, paid, active, cancelled
        (1, "n1", "r", 1, 1, d("100"), d("0"), day, True, True, False),  # settled by credit note 3
        (2, "n2", "a", 1, 1, d("50"), d("0"), day, False, True, False),  # zero and unpaid: not billable
        (3, "n3", "cr", 1, 1, d("-40"), d("-40"), later, True, True, False),  # the credit note
        (4, "n4", "cr", 1, 1, d("70"), d("70"), day, True, True, False),  # receipt and paid
        (5, "n5", "au", 1, 2, d("80"), d("80"), day, False, True, False),  # receipt, not paid: Y without date
        (6, "n6", "zz", 2, 2, d("90"), d("90"), day, False, True, False),  # all lump-sum in the paid term
        (7, "n7", "r", 2, 2, d("90"), d("90"), day, False, True, False),  # mixed items: credit
        (8, "hand", "r", 1, 2, d("10"), d("10"), day, False, True, False),  # paid by hand
        (9, "out", "r", 1, 2, d("10"), d("10"), day, True, True, False),  # left out
        (10, None, "r", 1, 2, d("10"), d("10"), day, True, True, False),  # no number
        (11, "n11", "r", 1, 2, d("10"), d("10"), day, True, False, False),  # inactive
        (12, "n12", "r", 1, 2, d("10"), d("10"), day, True, True, True),  # cancelled
        (13, "n13", "r", 1, 3, d("30"), d("0"), day, True, True, False),  # no later credit note: amount 0
        (14, "n14", "r", 1, 3, d("-20"), d("-20"), day, True, False, False),  # inactive credit note
        (15, "n15", "r", 1, 3, d("20"), d("20"), day, False, True, False),  # no items, no receipt
        (16, "n16", "r", 1, 99, d("20"), d("20"), day, False, True, False),  # unknown student
    ]
    return {
        "invoices": frame(
            invoices,
            "Id long, Number string, Type string, TermId long, StudentId long, Amount decimal(18,2), TotalAmount decimal(18,2), "
            "UpdatedAt timestamp, IsPaid boolean, IsActive boolean, IsCancel boolean",
        ),
        "terms": frame([(1, 2020, 2), (2, 2021, 1)], "Id long, AcademicYear int, AcademicTerm int"),
        "students": frame([(1, "6380001"), (2, "6380002"), (3, "6380003")], "Id long, Code string"),
        "invoice_items": frame(
            [(4, "Tuition"), (4, "Lump sum A"), (6, "Lump sum A"), (6, "Lump sum B"), (7, "Lump sum A"), (7, None)],
            "InvoiceId long, FeeItemName string",
        ),
        "receipts": frame([(1, 4), (2, 4), (3, 5)], "Id long, InvoiceId long"),
    }


def printer_tables(spark):
    ts = dt.datetime
    return {
        "users": spark.createDataFrame(
            [("u1", "ann", "Ann A", "Dep", None, "N"), ("u2", "ann", "Ann A", "Dep", None, "N"), ("u3", "bob", "Bob", "Dep", "O", "Y")],
            "user_id string, user_name string, full_name string, department string, office string, deleted string",
        ),
        "usage_log": spark.createDataFrame(
            [
                ("u1", "print", 10, 4, ts(2023, 9, 30, 23), "Y", "N"),  # on the cut-off day
                ("u1", "print", 10, 4, ts(2023, 10, 1, 0), "Y", "N"),
                ("u2", "print", 5, 5, ts(2023, 10, 31, 23), "Y", "N"),  # other id, same attributes
                ("u1", "print", 7, None, ts(2023, 10, 2), "Y", "N"),
                ("u1", "copy", 3, 0, ts(2024, 9, 1), "Y", "N"),
                ("u1", "copy", 3, 0, ts(2024, 9, 1), "N", "N"),
                ("u1", "copy", 3, 0, ts(2024, 9, 1), "Y", "Y"),
                ("u3", "copy", 3, 0, ts(2024, 9, 1), "Y", "N"),
            ],
            "used_by_user_id string, job_type string, total_pages long, total_color_pages long, usage_day timestamp, "
            "printed string, cancelled string",
        ),
    }
