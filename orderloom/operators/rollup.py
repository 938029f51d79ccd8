"""Grouped summaries. All are partial-then-final aggregates: a hot key is summed up in its tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.metrics import MONEY


def payment_totals(payments: DataFrame, *, exclude_flagged: bool = False) -> DataFrame:
    """Paid amount, number of payments and last payment per invoice.

    Payments flagged as duplicates count by default; ``exclude_flagged`` leaves them out.
    """
    counted = payments.filter(~F.col("is_duplicate_flag")) if exclude_flagged else payments
    return counted.groupBy("invoice_id").agg(
        F.sum("amount").try_cast(MONEY).alias("amount_paid"),
        F.count("*").alias("payment_count"),
        F.max("payment_date").alias("last_payment_date"),
    )


def first_orders(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_id").agg(F.min("order_date").alias("first_order_date"))


def order_rollup(lines: DataFrame) -> DataFrame:
    """Line amounts and counts per order. The distinct count runs on (order, product) pairs first,
    so an order with very many lines is not gathered in one task."""
    total = [
        F.sum(name).try_cast(MONEY).alias(name)
        for name in ("gross_revenue", "discount_amount", "revenue", "cost", "gross_profit")
    ]
    return lines.groupBy("order_id").agg(
        F.count("*").alias("line_count"),
        F.countDistinct("product_id").alias("product_count"),
        *total,
    )
