"""Fixed values of the pipelines: labels, code lists, column lists and limits.

They must equal what the tables' readers expect, so they are stated as they are.
"""

from pyspark.sql import types as T

# --- student master -----------------------------------------------------------------------------

TITLE_CODES = {"17": "002", "12": "003", "26": "003", "30": "003", "14": "001", "18": "001"}
TITLES = {"17": "Mrs.", "12": "Ms.", "26": "Ms.", "30": "Ms.", "14": "Mr.", "18": "Mr."}
OVERRIDE_TITLE_ID = "44"
OVERRIDE_TITLE_CODE, OVERRIDE_TITLE, OVERRIDE_GENDER = "003", "Ms.", "female"
GENDERS = {1: "male", 2: "female"}
NOT_SPECIFIED = "Not Specified"

PROGRAMMES_TAKEN_AS_GUEST = ("DTDS", "PYPY")
GUEST_STATUS = "take a course with IC"
STATUS_NAMES = {
    "prc": "passed_all_required_courses",
    "pa": "passed_away",
    "rs": "resigned",
    "dm": "dismissed",
    "s": "studying",
    "la": "leave_of_absence",
    "ex": "exchange",
    "g": "graduated",
    "g1": "graduated_with_first_class_honors",
    "g2": "graduated_with_second_class_honors",
    "np": "no_report",
    "d": "deleted",
    "b": "blacklist",
    "tr": "transferred_to_other_university",
    "re": "reenter",
    "ra": "re_admission",
}
OTHER_STATUS = "Others"
TERMINATE_STATUSES = ("pa", "rs", "dm", "np", "d", "b", "tr", "re", "ra")
GRADUATE_STATUSES = ("g", "g1", "g2")

FACULTY_NAME = "IC"
PROGRAMME_SUFFIX = "-001-B"
PROGRAMME_TYPE = "major"
ENTRANCE_TYPE = "FAC_01"
RESIDENT_NATIONALITY_ID = 93
RESIDENT, NON_RESIDENT = "resident", "non-resident"
INBOUND_FEE_TYPE = "inbound"
INBOUND_STUDENT_TYPE, REGULAR_STUDENT_TYPE = "2", "1"
SPECIAL_STUDY_TYPE, REGULAR_STUDY_TYPE = "โครงการพิเศษ", "โครงการปกติ"
STUDY_TIME = "วันธรรมดา (เช้า)"
CREDIT_BANDS = [(None, 36, 1), (37, 70, 2), (71, 105, 3)]
TOP_CREDIT_BAND = (105, 4)
DEFAULT_BAND = 1
CODE_RANGE = ("50%", "90%")

# --- enrollment answers -------------------------------------------------------------------------

ENROLLMENT_KEY = "student_id"
TALENT_COLUMNS = (
    "talent_foreign_language",
    "talent_computer",
    "talent_visual_art",
    "talent_performing_arts",
    "talent_sports",
    "talent_academic",
    "talent_other",
)
TALENT_WIDTH = 255  # of the column it goes to
TALENT_TARGET = "talentname"
SIBLING_COLUMNS = {
    "number_of_siblings": "numberofsiblings",
    "number_of_siblings_still_studying": "numberofsiblingsstillstudying",
    "you_are_child_number": "sequencechild",
}
OPTION_COLUMNS = {"religion": "religionname", "race": "racename", "marital_status": "maritalstatusname"}
OPTION_SUFFIX = "_option"
NAME_PAIRS = (
    ("firstnameth", "firstnameen"),
    ("middlenameth", "middlenameen"),
    ("lastnameth", "lastnameen"),
)
MASTER_KEY = "studentcode"

# --- invoices -----------------------------------------------------------------------------------

REGISTRATION_TYPES = {"r": "N", "a": "A", "cr": "A", "au": "E"}
INVOICE_SCHEMA = T.StructType(
    [
        T.StructField("invoiceId", T.StringType(), nullable=False),
        T.StructField("acaYear", T.StringType()),
        T.StructField("semester", T.IntegerType()),
        T.StructField("invoiceNo", T.StringType()),
        T.StructField("regisType", T.StringType()),
        T.StructField("invoiceAmount", T.DecimalType(18, 2)),
        T.StructField("paidDate", T.TimestampType()),
        T.StructField("paidAmount", T.DecimalType(18, 2)),
        T.StructField("paidStatus", T.StringType()),
        T.StructField("invoiceType", T.StringType()),
        T.StructField("schNameTh", T.StringType()),
        T.StructField("remark", T.StringType()),
        T.StructField("studentCode", T.StringType()),
    ]
)
INVOICE_AUDITED = ("paidDate", "paidAmount", "paidStatus")

# --- student dimension --------------------------------------------------------------------------

DIM_GENDERS = {1: "male", 2: "female"}
DIM_GENDER_DEFAULT = "not specified"
NATIONALITY_NAMES = {
    "Myanmar": "Burmese",
    "Myanmarian": "Burmese",
    "Other": "Not Specified",
    "TO_CONFIRM": "Not Specified",
    "passed_all_required_courses": "Not Specified",
}
ADMISSION_STUDENT_TYPES = {
    1: "Full-time",
    2: "Exchange",
    3: "Exchange",
    4: "Exchange",
    5: "Full-time",
    6: "Full-time",
    7: "Summer",
}
ADMISSION_DEFAULT = "External"
DIM_STATUSES = {
    "prc": "Passed all required course",
    "pa": "Passed away",
    "rs": "Resign",
    "dm": "Dismissed",
    "s": "Studying",
    "la": "Leave of absence",
    "ex": "Exchange",
    "g": "Graduated",
    "np": "No report",
    "d": "Deleted",
    "b": "Blacklist",
    "tr": "Transferred to other university",
    "re": "Reenter",
    "ra": "Re admission",
}
DIM_STATUS_DEFAULT = "Unknown"
ELIGIBLE_STATUSES = ("dm", "ex", "g", "la", "np", "prc", "pa", "rs", "s")
FIRST_ACADEMIC_YEAR = 2016
MAJOR_CODE_LENGTH = 4
MISSING_GRADE = "N/A"
DIM_REQUIRED = ("student_id", "first_name_en", "last_name_en")
DIM_NULL_RATIOS = {"major_code": 0.30, "major_name": 0.30}
DIM_MIN_ROWS = 10_000
READY_RATIO = 0.90

# --- printer usage ------------------------------------------------------------------------------

USAGE_AFTER = "2023-09-30"
USAGE_SCHEMA = T.StructType(
    [
        T.StructField("user_name", T.StringType()),
        T.StructField("full_name", T.StringType()),
        T.StructField("department", T.StringType()),
        T.StructField("office", T.StringType()),
        T.StructField("job_type", T.StringType()),
        T.StructField("total_color_pages", T.LongType()),
        T.StructField("total_grayscale_pages", T.LongType()),
        T.StructField("total_pages", T.LongType()),
        T.StructField("total_cost_color_pages", T.DoubleType()),
        T.StructField("total_cost_grayscale_pages", T.DoubleType()),
        T.StructField("total_cost_pages", T.DoubleType()),
        T.StructField("usage_calendar_year", T.LongType()),
        T.StructField("usage_calendar_month", T.LongType()),
        T.StructField("usage_budget_year", T.LongType()),
        T.StructField("usage_budget_month_order", T.LongType()),
    ]
)
USAGE_KEYS = (
    "user_name",
    "full_name",
    "department",
    "office",
    "job_type",
    "usage_calendar_year",
    "usage_calendar_month",
    "usage_budget_year",
    "usage_budget_month_order",
)
