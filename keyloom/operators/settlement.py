"""Invoice settlement: what an invoice amounts to, and whether, when and how much of it was paid."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.operators.matching import existence_flags, next_match, skew_join

# The prefix of lump-sum fee items, the term in which they count as paid, and the two
# invoice types.
LUMP_SUM_PREFIX = "Lump sum"
LUMP_SUM_PAID_TERM = (2021, 1)
LUMP_SUM_TYPE = "เหมาจ่าย"
CREDIT_TYPE = "หน่วยกิต"


@dataclass(frozen=True)
class Settlement:
    """Columns over one row per invoice that has ``nxt``, ``has_receipt`` and ``all_lump_sum``."""

    total: Column
    amount: Column
    updated_at: Column
    is_paid: Column
    manual: Column
    lump_term: Column

    @property
    def by_credit(self) -> Column:
        """Total is zero because a later, smaller credit note took it over."""
        nxt_total = F.col("nxt.TotalAmount")
        return (
            (self.total == 0)
            & (F.col("nxt.Amount") < 0)
            & (nxt_total < 0)
            & (F.abs(self.amount) > F.abs(nxt_total))
        )

    @property
    def as_lump_sum(self) -> Column:
        return self.lump_term & F.col("all_lump_sum")

    def invoice_amount(self) -> Column:
        return F.when(self.by_credit, self.amount).otherwise(self.total)

    def paid_date(self) -> Column:
        by_receipt = F.col("has_receipt") & self.is_paid
        own = F.when(by_receipt | self.as_lump_sum | self.manual, self.updated_at)
        return F.when(self.by_credit, F.col("nxt.UpdatedAt")).otherwise(own)

    def paid_amount(self) -> Column:
        gross = F.when(self.total == 0, self.amount).otherwise(self.total)
        return (
            F.when(self.by_credit | F.col("has_receipt"), gross)
            .when(self.as_lump_sum | self.manual, self.total)
            .otherwise(F.lit(0).cast("decimal(18,2)"))
        )

    def paid_status(self) -> Column:
        paid = self.by_credit | F.col("has_receipt") | self.as_lump_sum | self.manual
        return F.when(paid, "Y").otherwise("N")

    def invoice_type(self) -> Column:
        return F.when(F.col("all_lump_sum"), LUMP_SUM_TYPE).otherwise(CREDIT_TYPE)


def with_settlement_inputs(invoices: DataFrame, items: DataFrame, receipts: DataFrame) -> DataFrame:
    """One row per live invoice with its next credit note and the facts its items and receipts settle.

    ``invoices`` are the active ones that are not cancelled. Items and receipts shrink to one row per invoice before they are joined, so nothing fans out. An
    invoice counts as lump-sum only if it has items and all of them are lump-sum.
    """
    is_credit_note = (F.col("TotalAmount") < 0) & (F.col("Amount") < 0)
    matched = next_match(invoices, "StudentId", "Id", is_credit_note, ["Amount", "TotalAmount", "UpdatedAt"])
    is_lump = F.coalesce(F.col("FeeItemName").startswith(LUMP_SUM_PREFIX), F.lit(False))
    item_flags = existence_flags(items, "InvoiceId", {"_lump": is_lump, "_other": ~is_lump})
    receipt_flags = existence_flags(receipts, "InvoiceId", {"_receipt": F.lit(True)})
    joined = matched.join(item_flags.withColumnRenamed("InvoiceId", "Id"), "Id", "left").join(
        receipt_flags.withColumnRenamed("InvoiceId", "Id"), "Id", "left"
    )
    no = F.lit(False)
    return joined.select(
        *matched.columns,
        F.coalesce(F.col("_lump") & ~F.col("_other"), no).alias("all_lump_sum"),
        F.coalesce("_receipt", no).alias("has_receipt"),
    )


def settle(
    invoices: DataFrame,
    terms: DataFrame,
    students: DataFrame,
    items: DataFrame,
    receipts: DataFrame,
    regis_type: Column,
    manual_paid: Sequence[str] = (),
    excluded: Sequence[str] = (),
    lump_sum_term: tuple[int, int] = LUMP_SUM_PAID_TERM,
) -> DataFrame:
    """One row per billable invoice with a positive amount.

    ``manual_paid`` and ``excluded`` are invoice numbers that count as paid and that are left out;
    an invoice without a number is left out with or without them, as it cannot be told from those. Lump-sum
    invoices of ``lump_sum_term`` (year, term) count as paid. The next credit note is looked
    up among all invoices, before any is left out.
    """
    # Neither a billable invoice nor a credit note may be inactive or cancelled, so that test comes
    # first and reaches the scan. The other tests hold for billable invoices only.
    live = invoices.filter(F.col("IsActive") & ~F.col("IsCancel"))
    billable = with_settlement_inputs(live, items, receipts).filter(
        ~((F.col("TotalAmount") == 0) & ~F.col("IsPaid"))
        & ((~F.col("Number").isin(*excluded)) if excluded else F.col("Number").isNotNull())
    )
    term = terms.select(F.col("Id").alias("TermId"), "AcademicYear", "AcademicTerm")
    student = students.select(F.col("Id").alias("StudentId"), F.col("Code").alias("_code"))
    placed = skew_join(billable, term, "TermId", "inner", probe=live)
    placed = skew_join(placed, student, "StudentId", "inner", probe=live)
    year, number = lump_sum_term
    s = Settlement(
        total=F.col("TotalAmount"),
        amount=F.col("Amount"),
        updated_at=F.col("UpdatedAt"),
        is_paid=F.col("IsPaid"),
        manual=F.col("Number").isin(*manual_paid) if manual_paid else F.lit(False),
        lump_term=(F.col("AcademicYear") == year) & (F.col("AcademicTerm") == number),
    )
    null_text = F.lit(None).cast("string")
    return placed.select(
        F.col("Id").cast("string").alias("invoiceId"),
        F.col("AcademicYear").cast("string").alias("acaYear"),
        F.col("AcademicTerm").cast("int").alias("semester"),
        F.col("Number").alias("invoiceNo"),
        regis_type.alias("regisType"),
        s.invoice_amount().cast("decimal(18,2)").alias("invoiceAmount"),
        F.date_trunc("second", s.paid_date()).alias("paidDate"),
        s.paid_amount().cast("decimal(18,2)").alias("paidAmount"),
        s.paid_status().alias("paidStatus"),
        s.invoice_type().alias("invoiceType"),
        null_text.alias("schNameTh"),
        null_text.alias("remark"),
        F.col("_code").alias("studentCode"),
    ).filter("invoiceAmount > 0")
