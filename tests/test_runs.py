"""Jobs as runs: stages once, counts from the writes, audit lines once, a broken run goes on."""

import fixtures
import pytest

from keyloom.operators import audit
from keyloom.operators.quality import FillTrace
from keyloom.plans import enrollment, invoices, printer_usage, student_master
from keyloom.plans.runs import NO_DATA, SUCCESS
from keyloom.sources.audit_log import read_events
from keyloom.sources.keyed_table import KeyedTable
from keyloom.sources.ledger import RunLedger

SCHEMA = ", ".join(f"{c} string" for c in audit.EVENT_COLUMNS)


def lines(spark, path):
    return sorted((r["action"], r["key"] or "", r["field"] or "", r["new"] or "") for r in read_events(spark, path, SCHEMA).collect())


def test_a_broken_run_goes_on_where_it_stopped(spark, folder, monkeypatch):
    tables = fixtures.student_tables(spark)
    answers = enrollment.enrollment_answers(fixtures.enrollment_answers(spark))
    table = KeyedTable(spark, f"{folder}/master", ["studentcode"], buckets=4, text_keys=True)

    def go():
        return student_master.run(tables, answers, table, RunLedger(spark, folder, "r1"), f"{folder}/audit", "t1")

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(KeyedTable, "load", lost)
    with pytest.raises(RuntimeError, match="lost"):
        go()
    assert not table.exists() and set(RunLedger(spark, folder, "r1").finished()) == {"extract", "clean", "clean_audit"}
    monkeypatch.undo()
    monkeypatch.setattr(student_master, "build", lost)  # the extract is not built again
    report = go()
    assert (report.status, report.rows_total, report.inserted, report.updated) == (SUCCESS, 4, 4, 0)
    assert (report.fixed, report.dropped) == (2, 1)
    points = ("after_normalize", "after_enrollment", "after_drop_keys", "after_fill_status", "final")
    assert [report.trace[p]["rows"] for p in points] == [5, 5, 4, 4, 4]
    first = lines(spark, f"{folder}/audit")
    assert [x[0] for x in first].count("DROP_ROW_BAD_KEY") == 1 and [x[0] for x in first].count("FIX_EMAIL") == 2
    assert ("SUMMARY", "studentcode", "", '{"inserted": 4, "updated": 0}') in first
    assert sum(x[0] == "BATCH_SUMMARY" for x in first) == report.batches > 0
    assert go() == report and lines(spark, f"{folder}/audit") == first


def test_an_update_is_audited(spark, folder):
    table = KeyedTable(spark, f"{folder}/t", ["studentcode"], buckets=2, text_keys=True)
    tables = fixtures.student_tables(spark)
    student_master.run(tables, None, table, RunLedger(spark, folder, "r1"), f"{folder}/audit", "t1")
    tables["students"] = tables["students"].replace("c@x.example", "new@x.example", "Email")
    report = student_master.run(tables, None, table, RunLedger(spark, folder, "r2"), f"{folder}/audit2", "t2")
    assert (report.inserted, report.updated) == (0, 1)
    assert ("UPDATE", "6480003", "email", "new@x.example") in lines(spark, f"{folder}/audit2")


def test_empty_runs(spark, folder):
    tables = fixtures.student_tables(spark)
    tables["students"] = tables["students"].filter("Id < 0")
    table = KeyedTable(spark, f"{folder}/t", ["studentcode"], text_keys=True)
    report = student_master.run(tables, None, table, RunLedger(spark, folder, "r1"), f"{folder}/audit", "t1")
    assert (report.status, report.rows_total, report.inserted) == (NO_DATA, 0, 0) and not table.exists()


def test_invoices_and_usage_run(spark, folder):
    table = KeyedTable(spark, f"{folder}/invoice", ["invoiceId"], buckets=2)
    tables = fixtures.invoice_tables(spark)
    one = invoices.run(tables, table, RunLedger(spark, folder, "a"), f"{folder}/audit", "t", manual_paid=["hand"], excluded=["out"])
    two = invoices.run(tables, table, RunLedger(spark, folder, "b"), f"{folder}/audit", "t", manual_paid=["hand"], excluded=["out"])
    assert (one.inserted, one.updated, two.inserted, two.updated) == (7, 0, 0, 0)
    usage = KeyedTable(spark, f"{folder}/usage", ["user_name"], buckets=2)
    printed = fixtures.printer_tables(spark)
    one = printer_usage.run(printed, usage, RunLedger(spark, folder, "c"), f"{folder}/audit", "2024-03-01 08:00:00")
    two = printer_usage.run(printed, usage, RunLedger(spark, folder, "d"), f"{folder}/audit", "2024-03-01 08:00:00")
    assert one.inserted == one.rows_total > 0 and two.inserted == 0


def test_points_count_empty_frames(spark, folder):
    trace = FillTrace("a")
    trace.at(spark.createDataFrame([], "a string"), "none").write.parquet(f"{folder}/none")
    trace.at(spark.createDataFrame([("x",), (" ",), (None,)], "a string"), "some").write.parquet(f"{folder}/some")
    trace.at(spark.createDataFrame([("x",)], "b string"), "absent").write.parquet(f"{folder}/absent")
    assert trace.counts() == {"none": {"rows": 0, "filled": 0}, "some": {"rows": 3, "filled": 1}, "absent": {"rows": 1, "filled": 0}}
