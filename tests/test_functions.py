"""Scalar functions on the edge values their sources hold."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyloom.functions import dates, rules, schema, text

NBSP, ZWSP, EM = "\u00a0", "\u200b", "\u2003"


@pytest.mark.parametrize(
    "value, want",
    [
        (" 6380001 ", "6380001"),
        (f"63 80{ZWSP}001", "6380001"),
        (f"{NBSP}12{EM}3\t", "123"),
        ("63A", None),
        ("6380001.0", None),
        ("12\n", "12"),
        ("", None),
        (None, None),
    ],
)
def test_clean_digits(one, value, want):
    assert one(text.clean_digits("v"), value) == want


@pytest.mark.parametrize(
    "value, want",
    [("6380001.0", "6380001"), (" a.0 ", "a"), ("5.05", "5.05"), ("nan", None), ("None", None), (" ", None), (None, None)],
)
def test_clean_id(one, value, want):
    assert one(text.clean_id("v"), value) == want


@pytest.mark.parametrize(
    "value, want",
    [
        ("a.b+c@x.example", "a.b+c@x.example"),
        ("<a@x.example>, b@x.example", "a@x.example"),
        (" a@x.example ; b@x.example", "a@x.example"),
        ("a@x.example b@x.example", "a@x.example"),
        ("('a@x.example')", "a@x.example"),
        ("[a@x.example]", "a@x.example"),
        ("NULL", None),
        ("nan", None),
        ("none, a@x.example", None),
        ("a@x", None),
        ("a b@x.example", None),
        (f"{NBSP}a@x.example\n", "a@x.example"),
        ("", None),
        (None, None),
    ],
)
def test_clean_email(one, value, want):
    assert one(text.clean_email("v"), value) == want


@pytest.mark.parametrize(
    "value, want_clean, want_norm",
    [
        (f"{NBSP}Ab c\t", "Ab c", "ab c"),
        ("  ", None, ""),
        (f"{NBSP}\t", None, ""),
        (None, None, ""),
        ("a\nB ", "a\nB", "a\nb"),
    ],
)
def test_clean_value_and_norm(one, value, want_clean, want_norm):
    assert one(text.clean_value("v"), value) == want_clean
    assert one(text.norm("v"), value) == want_norm


@pytest.mark.parametrize("value, want", [(None, True), ("", True), (f" {NBSP}\t\n{EM}", True), (" a ", False), (ZWSP, False)])
def test_is_blank(one, value, want):
    assert one(text.is_blank("v"), value) is want


def test_strip_unicode_matches_python(spark):
    codes = [c for c in range(0x3001) if chr(c).isspace() or c in (0x200B, 0x30)]
    wrapped = [f"{chr(c)}x{chr(c)}" for c in codes]
    df = spark.createDataFrame([(w,) for w in wrapped], "v string")
    assert {r["v"]: r["s"] for r in df.select("v", text.strip_unicode("v").alias("s")).collect()} == {
        w: w.strip() for w in wrapped
    }


@pytest.mark.parametrize("value, want", [("mary ANN", "Mary ann"), ("é", "É"), ("", ""), (None, None), ("x", "X")])
def test_capitalize(one, value, want):
    assert one(text.capitalize("v"), value) == want


def test_blank_to_null_keeps_the_value(one):
    assert one(text.blank_to_null("v"), " 12 ") == " 12 "
    assert one(text.blank_to_null("v"), "  ") is None


def test_script_fallback(spark):
    df = spark.createDataFrame([("สมชาย", "Somchai"), ("Somchai", "S"), (None, "N"), ("x", None)], "th string, en string")
    got = [r[0] for r in df.select(text.script_or("th", "en")).collect()]
    assert got == ["สมชาย", "S", "N", None]


def test_upper_or(spark):
    df = spark.createDataFrame([(" a ", "b"), ("  ", " b"), (None, "c "), (None, None)], "th string, en string")
    assert [r[0] for r in df.select(text.upper_or("th", "en")).collect()] == ["A", "B", "C", None]


def python_bullets(values, limit):
    """The rule, said in plain Python."""
    items = []
    for line in "\n".join(v or "" for v in values).replace("\r\n", "\n").split("\n"):
        line = line.strip()
        if line.startswith("- "):
            line = line[2:].strip()
        if line not in ("", "-"):
            items.append(line)
    return ", ".join(items)[:limit] or None


@pytest.mark.parametrize(
    "a, b",
    [
        ("- Thai\r\n- English", "piano"),
        ("-", " - "),
        (None, None),
        ("- - nested\n-no blank", f"{NBSP}- x{EM}"),
        ("x" * 300, "y"),
        ("a" * 254, "b"),
        ("\n\n-  \n ok", ""),
    ],
)
def test_bullets(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(text.bullets(["a", "b"], limit=255)).first()[0] == python_bullets([a, b], 255)
    assert df.select(text.bullets(["a", "b"])).first()[0] == python_bullets([a, b], None)


def test_scrub_missing(one):
    assert [one(text.scrub_missing("v"), v) for v in ("None", "nan", "NaT", "none", None)] == [None, None, None, "none", None]


@pytest.mark.parametrize("month, year, order", [(9, 2024, 12), (10, 2025, 1), (12, 2025, 3), (1, 2024, 4)])
def test_fiscal(one, month, year, order):
    day = dt.date(2024, month, 15)
    assert one(dates.fiscal_year("v"), day, "date") == year
    assert one(dates.fiscal_month_order("v"), day, "date") == order


def test_local_date_text(one):
    ts = dt.datetime(2000, 12, 31, 18, 0)
    assert one(dates.local_date_text("v"), ts, "timestamp") == "01/01/2544"
    assert one(dates.local_date_text("v", "iso"), ts, "timestamp") == "01/01/2001"


def test_lenient_timestamp(one):
    assert one(dates.lenient_timestamp("v"), "2024-03-01 10:00:00") == dt.datetime(2024, 3, 1, 10)
    assert one(dates.lenient_timestamp("v"), "no date") is None
    assert one(dates.lenient_timestamp("v", ["dd/MM/yyyy"]), "01/03/2024") == dt.datetime(2024, 3, 1)


def test_band_has_gaps(spark):
    values = [36, 36.5, 37, 70, 70.5, 71, 105, 105.5, 106, None]
    df = spark.createDataFrame([(v if v is None else Decimal(str(v)),) for v in values], "v decimal(6,1)")
    got = [r[0] for r in df.select(rules.band("v", [(None, 36, 1), (37, 70, 2), (71, 105, 3)], (105, 4))).collect()]
    assert got == [1, 1, 2, 2, 1, 3, 3, 4, 4, 1]


def test_code_map_priority(one):
    chain = F.when(F.col("v").isin("x", "b"), "first")
    mapped = rules.code_map("v", {"a": "A", "b": "B"}, "other", chain)
    assert [one(mapped, v) for v in ("a", "b", "x", "y", None)] == ["A", "first", "first", "other", "other"]


def test_resolve_option(spark):
    rows = [("Other", "free"), (" oTHER ", "free"), ("", "free"), (None, "free"), ("Other", " "), ("Buddhist", "free"), (None, None)]
    df = spark.createDataFrame(rows, "b string, o string")
    got = [r[0] for r in df.select(rules.resolve_option("b", "o")).collect()]
    assert got == ["free", "free", "free", "free", "Other", "Buddhist", None]


def test_fill_rules(spark):
    df = spark.createDataFrame([(None, "x"), (" ", "y"), ("keep", "z")], "t string, v string")
    assert [r["t"] for r in rules.fill_if_blank(df, "t", "v").collect()] == ["x", "y", "keep"]
    assert [r["n"] for r in rules.fill_if_blank(df, "n", "v").collect()] == ["x", "y", "z"]
    sibling = rules.fill_null_from_sibling(df, "t", "v")
    assert sibling.columns == ["t"] and [r["t"] for r in sibling.collect()] == ["x", " ", "keep"]
    assert rules.fill_null_from_sibling(df, "absent", "v").columns == ["t", "v"]


def test_fingerprint_separates_null_from_text(spark):
    df = spark.createDataFrame([(None, "a"), ("null", "a"), ("", "a"), (None, "a")], "x string, y string")
    f = [r[0] for r in df.select(rules.fingerprint(["x", "y"])).collect()]
    assert f[0] == f[3] and len(set(f)) == 3


def test_names_and_alignment(spark):
    df = spark.createDataFrame([("1", "b", "x")], "`Student ID` string, `Blood-Type` string, extra string")
    assert schema.normalize_columns(df).columns == ["student_id", "blood_type", "extra"]
    assert schema.normalize_columns(df, dashes=False).columns == ["student_id", "blood-type", "extra"]
    aligned = schema.align_columns(df, ["student_id", "BLOOD-TYPE", "phone"])
    assert aligned.frame.columns == ["student_id", "BLOOD-TYPE"]
    assert (aligned.missing_in_source, aligned.missing_in_target) == (["phone"], ["extra"])
    assert not aligned.exact


def test_wanted_columns(spark):
    df = spark.createDataFrame([(1, 2)], "k int, a int")
    kept, missing = schema.wanted_columns(df, "k", ["k", "b", "a"])
    assert kept.columns == ["k", "a"] and missing == ["b"]
    with pytest.raises(ValueError, match="key column"):
        schema.wanted_columns(df, "id", ["a"])


def test_casts(spark):
    target = T.StructType([T.StructField("n", T.LongType())])
    df = spark.createDataFrame([("1",), ("x",)], "n string")
    assert [r[0] for r in schema.cast_to(df, target, strict=False).collect()] == [1, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        schema.cast_to(df, target).collect()
    with pytest.raises(ValueError, match="missing columns"):
        schema.cast_to(df.withColumnRenamed("n", "m"), target)


def test_widen(spark):
    left = spark.createDataFrame([(1,)], "K int")
    right = spark.createDataFrame([(1, 2, 3)], "k int, a int, skipped int")
    assert schema.widen(left, right, skip=["skipped"]).dtypes == [("K", "int"), ("a", "string")]
