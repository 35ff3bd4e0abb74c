"""Exports with line breaks inside quotes, read in many ranges, against the reader that takes a file in one task."""

import random

import pytest
from pyspark.sql import functions as F

from keyloom.sources import quoted, readers


@pytest.fixture
def many_ranges(spark):
    limit, cost = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    kept = {k: spark.conf.get(k) for k in (limit, cost)}

    def cut(size):
        spark.conf.set(limit, str(size))
        spark.conf.set(cost, "0")

    yield cut
    for k, v in kept.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", [40, 97, 1000])
def test_ranges_give_the_same_records(spark, folder, many_ranges, size):
    pick = random.Random(size)
    words = ["a", 'say "x"', "two\nlines", "\n\n", "", "ก,ข", "- one\n- two\n- three, four", "long " * 30, '"', '""\n""']
    rows = [(str(i), pick.choice(words), pick.choice(words) + str(i)) for i in range(120)]
    df = spark.createDataFrame(rows, "`Student ID` string, Note string, other string").coalesce(2)
    df.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(f"{folder}/csv")
    many_ranges(size)
    got = quoted.read_quoted_export(spark, f"{folder}/csv")
    assert got.columns == ["student_id", "note", "other"]
    want = readers.read_text_export(spark, f"{folder}/csv", multi_line=True)
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, (tuple(r) for r in want.collect())))
    text = spark.read.text(f"{folder}/csv").select(F.col("_metadata.file_block_start").alias("b"), F.col("_metadata.file_path").alias("f"))
    assert text.distinct().count() > 5


def test_windows_line_ends_and_blank_lines(spark, folder):
    with open(f"{folder}/t.csv", "wb") as out:
        out.write(b'id,note\r\n1,"a\r\nb"\r\n\r\n2,c\r\n')
    got = quoted.read_quoted_export(spark, f"{folder}/t.csv")
    assert sorted(tuple(r) for r in got.collect()) == [("1", "a\r\nb"), ("2", "c")]


def test_an_empty_export(spark, folder):
    spark.createDataFrame([], "value string").write.text(f"{folder}/t")
    assert quoted.read_quoted_export(spark, f"{folder}/t").columns == []
