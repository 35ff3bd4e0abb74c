"""Loads that become visible at once: broken and competing loads, versions, prints, ranges, compaction."""

import re

import pytest
from pyspark.sql import functions as F

from keyloom.operators.keyed_load import exact, guarded
from keyloom.sources.commits import CommitConflict, CommitLog
from keyloom.sources.keyed_table import KeyedTable


def rows(spark, pairs, schema="k string, a string"):
    return spark.createDataFrame(pairs, schema)


def content(table, number=None):
    return sorted((tuple(r) for r in table.read(number).collect()), key=str)


def test_log_numbers_are_taken_once(spark, folder):
    log = CommitLog(spark, f"{folder}/log")
    assert log.newest() is None
    log.put(0, {"a": 1})
    with pytest.raises(CommitConflict):
        log.put(0, {"a": 2})
    log.put(1, {"a": "é"})
    assert log.numbers() == [0, 1] and log.newest() == (1, {"a": "é"}) and log.read(0) == {"a": 1}
    assert sorted(n for n in log.folders(f"{folder}/log") if not n.endswith(".crc")) == [f"{n:020}.json" for n in (0, 1)]


@pytest.mark.parametrize("broken", ["_write", "_commit"])
def test_a_load_that_breaks_changes_nothing(spark, folder, monkeypatch, broken):
    table = KeyedTable(spark, f"{folder}/t", ["k"], buckets=4)
    before = [(f"{i}", "a") for i in range(30)]
    table.fill(rows(spark, before))
    new = rows(spark, [(f"{i}", "b", "x") for i in range(20, 40)], "k string, a string, more string")
    kept = getattr(KeyedTable, broken)

    def breaks(self, *args):
        if broken == "_write":
            kept(self, *args)  # files are there, the switch is not
        raise RuntimeError("lost")

    monkeypatch.setattr(KeyedTable, broken, breaks)
    with pytest.raises(RuntimeError, match="lost"):
        table.load(new, exact("k"))
    assert content(KeyedTable(spark, f"{folder}/t", ["k"], buckets=4)) == sorted(before)
    monkeypatch.undo()
    result = table.load(new, exact("k"))
    assert (result.inserted, result.updated) == (10, 10) and len(content(table)) == 40
    assert table.expire(keep=1) >= 2  # what the broken run left, and what was replaced
    assert len(content(table)) == 40


def test_the_later_of_two_loads_fails(spark, folder, monkeypatch):
    table = KeyedTable(spark, f"{folder}/t", ["k"], buckets=2)
    table.fill(rows(spark, [("1", "a"), ("2", "b")]))
    kept = KeyedTable._write

    def meanwhile(self, *args):
        out = kept(self, *args)
        monkeypatch.undo()
        KeyedTable(spark, f"{folder}/t", ["k"], buckets=2).load(rows(spark, [("1", "first")]), exact("k"))
        return out

    monkeypatch.setattr(KeyedTable, "_write", meanwhile)
    with pytest.raises(CommitConflict):
        table.load(rows(spark, [("1", "second"), ("3", "c")]), exact("k"))
    assert content(table) == [("1", "first"), ("2", "b")]
    table.load(rows(spark, [("1", "second"), ("3", "c")]), exact("k"))
    assert content(table) == [("1", "second"), ("2", "b"), ("3", "c")]


def test_versions_stay_readable(spark, folder):
    table = KeyedTable(spark, f"{folder}/t", ["k"], buckets=2, text_keys=True)
    table.load(rows(spark, [("1", "a")]), guarded("k"))
    second = table.load(rows(spark, [(" 1", "b", "n"), ("2", "c", None)], "k string, a string, more string"), guarded("k")).version
    assert content(table, 0) == [("1", "a")] and content(table, second) == [("1", "b", "n"), ("2", "c", None)]
    nothing = table.load(rows(spark, [("1", "B")]), guarded("k"))
    assert nothing.version == second  # no change, no new version


def test_appends_skip_segments_out_of_range(spark, folder):
    table = KeyedTable(spark, f"{folder}/t", ["u"], buckets=2, ranged=["m"])
    schema = "u string, m int, pages int"

    def month(m, pages=1):
        return rows(spark, [*((f"u{i}", m, pages) for i in range(20)), (None, m, pages)], schema)

    for m in range(1, 6):
        result = table.append_new(month(m), ["u", "m"])
        assert result.inserted == 21 and result.segments_read == 0 and result.segments_total == 2 * (m - 1)
    again = table.append_new(month(3, 9), ["u", "m"])
    assert again.inserted == 0 and again.segments_read == 2
    late = table.append_new(rows(spark, [("u1", None, 5), ("u1", 2, 5)], schema), ["u", "m"])
    assert late.inserted == 1
    assert table.append_new(rows(spark, [("u1", None, 6)], schema), ["u", "m"]).inserted == 0  # NULL equals NULL
    files = table.segments().agg(F.sum("files")).first()[0]
    before = content(table)
    assert table.compact() == 2
    assert content(table) == before and table.segments().agg(F.sum("files")).first()[0] == 2 < files


def test_inserts_append_and_updates_rewrite(spark, folder):
    table = KeyedTable(spark, f"{folder}/t", ["k"], buckets=1)
    table.fill(rows(spark, [("a", "1"), ("m", "2")]))
    table.load(rows(spark, [("x", "3")]), exact("k"))
    assert table.segments().count() == 2
    # Its range is that of the first segment only, but a changed bucket is written anew as a whole.
    result = table.load(rows(spark, [("m", "9")]), exact("k"))
    assert (result.segments_read, result.segments_total) == (1, 2) and table.segments().count() == 1
    assert content(table) == [("a", "1"), ("m", "9"), ("x", "3")]


def test_prints_spare_wide_reads(spark, folder, monkeypatch):
    table = KeyedTable(spark, f"{folder}/t", ["k"], buckets=8, fingerprint=["a", "b"])
    schema = "k int, a string, b string, ingestion_date string"
    table.fill(rows(spark, [(i, f"a{i}", None, "old") for i in range(200)], schema))
    scans = []
    kept = KeyedTable._stored

    def seen(self, version, segments, path=None):
        df = kept(self, version, segments, path)
        scans.append((path == self.prints_path, {r[0] for r in segments.select("bucket").collect()}, df))
        return df

    monkeypatch.setattr(KeyedTable, "_stored", seen)
    new = rows(spark, [(i, "changed" if i == 7 else f"a{i}", None, "new") for i in range(200)], schema)
    result = table.load(new, exact("k"))
    assert (result.inserted, result.updated) == (0, 1)
    prints = [df for narrow, _, df in scans if narrow]
    assert len(prints) == 1 and set(prints[0].columns) == {"k", "_print", "bucket"}
    plan = prints[0]._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ReadSchema: struct<k:int,_print:binary>", plan)
    assert all(len(buckets) == 1 for narrow, buckets, _ in scans if not narrow)  # wide rows of one bucket in eight
    monkeypatch.undo()
    got = {r["k"]: tuple(r)[1:] for r in table.read().collect()}
    assert len(got) == 200 and got[7] == ("changed", None, "new") and got[8] == ("a8", None, "old")
    # Prints of rewritten and of appended rows are kept as well.
    assert table.load(new.unionByName(rows(spark, [(500, "n", "n", "new")], schema)), exact("k")).inserted == 1
    last = table.load(rows(spark, [(500, "n", "n", "x"), (7, "a7", None, "x")], schema), exact("k"))
    assert (last.inserted, last.updated) == (0, 1)
