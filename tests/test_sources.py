"""Readers, the keyed table, snapshots, the audit log, hand-over tables and streams."""

import uuid

import pytest
from pyspark.sql import functions as F

from keyloom.operators.keyed_load import exact, guarded
from keyloom.session import materialize, new_run_folder, shared_folder
from keyloom.sources import readers
from keyloom.sources.audit_log import append_events, hand_over, read_events
from keyloom.sources.keyed_table import KeyedTable
from keyloom.sources.snapshots import (
    COLUMN_MISMATCH,
    CONTENT_DIFFERS,
    DRY_RUN,
    KEY_REPEATS,
    REPLACED,
    SnapshotTable,
    content_sums,
)
from keyloom.streaming.incremental import drain_inserts, drain_upserts


def test_jdbc_options():
    whole = readers.jdbc_options("jdbc:x", "fee.Invoices", one_task=True)
    assert "partitionColumn" not in whole and whole["dbtable"] == "fee.Invoices"
    split = readers.jdbc_options("jdbc:x", "fee.Invoices", ("Id", 1, 10**9, 200), properties={"user": "u"})
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"], split["user"]) == (
        "Id",
        "1",
        "1000000000",
        "200",
        "u",
    )


def test_text_exports(spark, folder):
    df = spark.createDataFrame([("001", "- a\n- b", None), ("2.0", "", "x")], "`Student ID` string, `Talent Other` string, c string")
    df.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(f"{folder}/csv")
    got = readers.read_text_export(spark, f"{folder}/csv", multi_line=True)
    assert got.dtypes == [("student_id", "string"), ("talent_other", "string"), ("c", "string")]
    assert {r["student_id"]: r["talent_other"] for r in got.collect()}["001"] == "- a\n- b"
    df.write.json(f"{folder}/json")
    assert readers.read_json_export(spark, f"{folder}/json", df.columns).columns == ["student_id", "talent_other", "c"]
    spark.range(3).write.parquet(f"{folder}/parquet")
    assert readers.read_parquet_export(spark, f"{folder}/parquet").dtypes == [("id", "string")]


def test_tables_are_read_by_name(spark):
    tables = readers.Tables(spark, "/root/testdata/sf0.001/")
    assert tables.nation.columns == tables["nation"].columns
    assert readers.read_tables(lambda n: tables[n], {"dim": "region"})["dim"].count() == 5


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert new_run_folder(spark, "x") != new_run_folder(spark, "x")
    df = spark.range(5).select(F.col("id").alias("a"))
    assert sorted(r["a"] for r in materialize(df, "copy").collect()) == list(range(5))


def source(spark, rows, columns="k string, a string"):
    return spark.createDataFrame(rows, columns)


def content(table):
    return sorted((tuple(r) for r in table.read().collect()), key=str)


def test_keyed_table_guarded_load(spark, folder):
    table = KeyedTable(spark, f"{folder}/t", ["k"], buckets=4, text_keys=True)
    assert not table.exists()
    first = table.load(source(spark, [(f"{i}", f" v{i}") for i in range(20)]), guarded("k"))
    assert (first.inserted, first.updated, first.rows_total) == (20, 0, 20)
    again = table.load(source(spark, [(f"{i}", f"V{i} ") for i in range(20)]), guarded("k"))
    assert (again.inserted, again.updated) == (0, 0)
    more = source(spark, [(" 3 ", "new", "e"), ("99", "x", None), ("4", " ", None)], "k string, a string, extra string")
    third = table.load(more, guarded("k"))
    assert (third.inserted, third.updated) == (1, 1)
    rows = {r["k"]: (r["a"], r["extra"]) for r in table.read().collect()}
    assert len(rows) == 21 and rows["3"] == ("new", "e") and rows["4"] == ("v4", None) and rows["99"] == ("x", None)


def test_keyed_table_rewrites_changed_buckets_only(spark, folder):
    table = KeyedTable(spark, f"{folder}/t", ["k"], buckets=8)
    table.fill(source(spark, [(f"{i}", "a") for i in range(100)]))

    def files():
        rows = spark.read.parquet(table.rows_path).select("bucket", F.input_file_name().alias("f")).distinct().collect()
        return {(r["bucket"], r["f"]) for r in rows}

    before = files()
    table.load(source(spark, [(f"{i}", "b" if i == 5 else "a") for i in range(100)]), exact("k"))
    assert len({b for b, _ in before ^ files()}) == 1
    assert dict(content(table))["5"] == "b" and len(content(table)) == 100


def test_keyed_table_refuses_repeated_keys(spark, folder):
    table = KeyedTable(spark, f"{folder}/t", ["k"])
    with pytest.raises(ValueError, match="duplicate keys"):
        table.load(source(spark, [("1", "a"), ("1", "b")]), exact("k"))


def test_keyed_table_guards_its_buckets(spark, folder):
    table = KeyedTable(spark, f"{folder}/t", ["k"], buckets=4)
    with pytest.raises(ValueError, match="text_keys"):
        table.load(source(spark, [("1", "a")]), guarded("k"))
    with pytest.raises(ValueError, match="bucketed by"):
        table.load(source(spark, [("1", "a")]), exact("a"))
    with pytest.raises(ValueError, match="bucketed by"):
        table.append_new(source(spark, [("1", "a")]), ["a"])
    table.fill(source(spark, [("1", "a"), ("2", "b")]))
    with pytest.raises(ValueError, match="has been filled"):
        table.fill(source(spark, [("3", "c")]))
    # A key of another type finds the row of the table's type.
    numbers = source(spark, [(1, "x"), (3, "z")], "k int, a string")
    result = table.load(numbers, exact("k"))
    assert (result.inserted, result.updated) == (1, 1)
    assert content(table) == [("1", "x"), ("2", "b"), ("3", "z")]
    nothing = table.load(source(spark, []), exact("k"))
    assert (nothing.inserted, nothing.updated, nothing.rows_total) == (0, 0, 0)


def test_keyed_table_purges_bad_keys(spark, folder):
    table = KeyedTable(spark, f"{folder}/t", ["k"], buckets=3)
    table.fill(source(spark, [("1", "a"), ("2", "b"), (" ", "c"), (None, "d"), ("x7", "e")]))
    table.purge_bad_keys()
    assert content(table) == [("1", "a"), ("2", "b"), ("x7", "e")]
    table.purge_bad_keys(digits_only=True)
    assert content(table) == [("1", "a"), ("2", "b")]


def test_keyed_table_append_new(spark, folder):
    table = KeyedTable(spark, f"{folder}/t", ["u", "m"], buckets=4)
    columns = "u string, m int, pages int"
    first = table.append_new(source(spark, [("a", 1, 5), (None, 1, 6), ("a", 1, 4)], columns), ["u", "m"])
    assert first.inserted == 2
    second = table.append_new(source(spark, [("a", 1, 99), (None, 1, 99), (None, 2, 7)], columns), ["u", "m"])
    assert second.inserted == 1
    assert content(table) == [("a", 1, 5), (None, 1, 6), (None, 2, 7)]


@pytest.fixture
def snapshot(spark, folder):
    table = SnapshotTable(spark, f"{folder}/enrollment")
    table.create(source(spark, [("1", "a")], "student_id string, `Blood Type` string"))
    return table


def test_snapshot_refresh(spark, snapshot):
    new = source(spark, [("1", " "), ("2", "AB")], "`Student ID` string, blood_type string")
    dry = snapshot.refresh(new, "student_id")
    assert (dry.status, dry.before, dry.incoming) == (DRY_RUN, 1, 2) and dry.sample.count() == 2
    assert snapshot.read().count() == 1
    done = snapshot.refresh(new, "student_id", apply=True)
    assert (done.status, done.before, done.after, done.distinct_keys) == (REPLACED, 1, 2, 2)
    assert sorted(tuple(r) for r in snapshot.read().collect()) == [("1", None), ("2", "AB")]
    backups = [r["version"] for r in snapshot.versions().collect()]
    assert len(backups) == 2 and snapshot.read(backups[0]).count() == 1


def test_snapshot_refuses_bad_refreshes(spark, snapshot):
    other = source(spark, [("1", "x")], "student_id string, phone string")
    report = snapshot.refresh(other, "student_id", apply=True)
    assert (report.status, report.missing_in_source, report.missing_in_target) == (COLUMN_MISMATCH, ["Blood Type"], ["phone"])
    allowed = snapshot.refresh(other, "student_id", apply=True, allow_mismatch=True)
    assert allowed.status == REPLACED and [tuple(r) for r in snapshot.read().collect()] == [("1", None)]
    twice = source(spark, [("1", "x"), ("1", "y")], "student_id string, `blood type` string")
    assert snapshot.refresh(twice, "student_id", apply=True).status == KEY_REPEATS
    assert snapshot.read().count() == 1


@pytest.mark.parametrize("swapped", [False, True])
def test_snapshot_notices_swapped_cells(spark, folder, monkeypatch, swapped):
    table = SnapshotTable(spark, f"{folder}/s")
    table.create(source(spark, [("1", "x", None)], "k string, a string, b string"))
    new = source(spark, [("1", "p", None), ("2", "q", "r"), ("3", "t", "t")], "k string, a string, b string")
    kept = SnapshotTable.read

    def read(self, version=None):
        df = kept(self, version)
        return df if version is None or not swapped else df.select("k", F.col("b").alias("a"), F.col("a").alias("b"))

    monkeypatch.setattr(SnapshotTable, "read", read)
    assert table.refresh(new, "k", apply=True).status == (CONTENT_DIFFERS if swapped else REPLACED)
    monkeypatch.undo()
    assert table.read().count() == (1 if swapped else 3)


def test_content_sums_see_rows_not_their_order(spark):
    def sums(rows):
        return tuple(source(spark, rows).repartition(3).agg(*content_sums(source(spark, rows))).first())

    rows = [("1", "a"), ("2", None), (None, "2"), ("1", "a")]
    assert sums(rows) == sums(rows[::-1]) != sums(rows[:3])
    assert sums([("2", None)]) != sums([(None, "2")]) and sums([]) == (0, 0)


def test_audit_log_and_hand_over(spark, folder):
    schema = "action string, old string, new string"
    append_events(source(spark, [("FIX", "ก", None)], schema), f"{folder}/audit")
    append_events(source(spark, [("DROP", "x", "y")], schema), f"{folder}/audit")
    assert {tuple(r) for r in read_events(spark, f"{folder}/audit", schema).collect()} == {("FIX", "ก", None), ("DROP", "x", "y")}
    lines = {r["value"] for r in spark.read.text(f"{folder}/audit").collect()}
    assert '{"action":"FIX","old":"ก","new":null}' in lines
    one = hand_over(spark.range(3), folder, "r1", "extract")
    two = hand_over(spark.range(5), folder, "r2", "extract")
    assert (one.count(), two.count()) == (3, 5)


def test_streams_load_new_files_once(spark, folder):
    schema = spark.createDataFrame([], "k string, a string, at int").schema
    run = uuid.uuid4().hex  # a stream's name stands for its progress
    table = KeyedTable(spark, f"{folder}/t", ["k"], buckets=2)
    facts = KeyedTable(spark, f"{folder}/f", ["k"], buckets=2)

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        drain_upserts(spark, f"{folder}/in", schema, f"u-{run}", table, exact("k"), [F.col("at").desc()])
        drain_inserts(spark, f"{folder}/in", schema, f"i-{run}", facts, ["k"])

    arrive([("1", "old", 1), ("1", "new", 2), ("2", "x", 1)])
    arrive([("2", "y", 3), ("3", "z", 3)])
    assert content(table) == [("1", "new", 2), ("2", "y", 3), ("3", "z", 3)]
    assert [r[0] for r in content(facts)] == ["1", "2", "3"] and dict((r[0], r[1]) for r in content(facts))["2"] == "x"


def test_guarded_load_refuses_keys_that_trim_to_the_same(spark, folder):
    from keyloom.operators.keyed_load import guarded
    from keyloom.sources.keyed_table import KeyedTable

    table = KeyedTable(spark, f"{folder}/t", ["k"], buckets=4, text_keys=True)
    table.load(spark.createDataFrame([("3", "a")], "k string, v string"), guarded("k"))
    twice = spark.createDataFrame([("3", "b"), (" 3", "c"), ("7", "x"), ("7 ", "y")], "k string, v string")
    with pytest.raises(ValueError, match="duplicate keys"):
        table.load(twice, guarded("k"))
    assert [tuple(r) for r in table.read().select("k", "v").collect()] == [("3", "a")]
