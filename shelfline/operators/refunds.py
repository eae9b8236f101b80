"""Refund rows and sale totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

PAYMENT_COLUMNS = ["payment_id", "transaction_id", "method", "amount", "created_at"]


def refund_id(payment_id: Column) -> Column:
    """Id of the refund of a payment; the same on every run, so a repeated run adds nothing."""
    return F.md5(F.concat(F.lit("refund-"), payment_id))


def _mirror(tenders: DataFrame, at: Column) -> DataFrame:
    return tenders.select(
        refund_id(F.col("payment_id")).alias("payment_id"), "transaction_id", "method",
        (-F.col("amount")).alias("amount"), at.alias("created_at"),
    )


def refunds_for(payments: DataFrame, ids: DataFrame, at: Column) -> DataFrame:
    """One negative payment per original tender of the given sales, dated `at`."""
    tenders = payments.where(F.col("amount") > 0).select(*PAYMENT_COLUMNS)
    return _mirror(tenders.join(ids, "transaction_id", "left_semi"), at)


def backfill_refunds(payments: DataFrame, transactions: DataFrame) -> DataFrame:
    """Missing refunds of voided and returned sales, dated at the header's last change.

    A sale that already has any refund is left alone.
    """
    reversed_sales = transactions.where(F.col("status").isin("voided", "returned")).select(
        "transaction_id", F.col("updated_at").alias("_at"))
    refunded = payments.where(F.col("amount") < 0).select("transaction_id")
    tenders = (
        payments.where(F.col("amount") > 0).select(*PAYMENT_COLUMNS)
        .join(reversed_sales, "transaction_id")
        .join(refunded, "transaction_id", "left_anti")
    )
    return _mirror(tenders, F.col("_at"))


def sale_total(lines: DataFrame) -> DataFrame:
    """What a sale's header should say: the sum of its lines' net amounts."""
    net = F.col("quantity") * F.col("unit_price") - F.col("discount_amount")
    return lines.groupBy("transaction_id").agg(F.sum(net).cast("decimal(12,2)").alias("total_amount"))
