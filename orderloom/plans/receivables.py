"""Receivables reports: aging and days sales outstanding, from the invoice fact or from totals kept up to date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions import mapping, metrics
from orderloom.functions.metrics import AGING_BUCKETS, MONEY, AsOf
from orderloom.plans.o2c import invoice_balances
from orderloom.sources.tables import upsert_table
from orderloom.sources.totals import Totals

NO_DUE_DATE = "No due date"
PERIOD = "period"


def invoice_aging(invoices: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Unpaid invoices with days past due and bucket; invoices without due date keep a name of their
    own, so that the buckets add up to what is outstanding."""
    due = F.col("due_date")
    return invoices.filter(metrics.is_open(F.col("invoice_status"))).select(
        "*",
        metrics.days_between(due, metrics.as_of_date(as_of)).alias("days_past_due"),
        F.coalesce(metrics.aging_bucket(due, as_of), F.lit(NO_DUE_DATE)).alias("aging_bucket"),
    )


def aging_summary(invoices: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Number and open amount of unpaid invoices per bucket; buckets without invoices show zero."""
    summed = invoice_aging(invoices, as_of).groupBy("aging_bucket").agg(
        F.count("*").alias("invoice_count"), F.sum("outstanding_amount").try_cast(MONEY).alias("total_outstanding")
    )
    return _every_bucket(summed)


def _every_bucket(summed: DataFrame) -> DataFrame:
    """Counts and amounts added up by bucket, those without invoices too."""
    names = F.array(*[F.lit(name) for name in AGING_BUCKETS])
    empty = summed.sparkSession.range(1).select(
        F.explode(names).alias("aging_bucket"),
        F.lit(0).cast("bigint").alias("invoice_count"),
        F.lit(0).cast(MONEY).alias("total_outstanding"),
    )
    return summed.unionByName(empty).groupBy("aging_bucket").agg(
        F.sum("invoice_count").alias("invoice_count"),
        F.sum("total_outstanding").try_cast(MONEY).alias("total_outstanding"),
    )


def dso(invoices: DataFrame, by: Sequence[str], days: int) -> DataFrame:
    """Open amount over invoiced amount times ``days``, per group: customer, region, sales rep.

    ``region`` is derived from the customer's state where it is asked for.
    """
    if "region" in by and "region" not in invoices.columns:
        invoices = invoices.withColumn("region", mapping.region_of(F.col("customer_state")))
    unpaid = F.when(metrics.is_open(F.col("invoice_status")), F.col("outstanding_amount"))
    summed = invoices.groupBy(*by).agg(
        F.coalesce(F.sum(unpaid), F.lit(0)).try_cast(MONEY).alias("total_outstanding"),
        F.sum("invoice_amount").try_cast(MONEY).alias("credit_sales"),
    )
    return _with_dso(summed, days)


def _with_dso(summed: DataFrame, days: int) -> DataFrame:
    ratio = metrics.days_sales_outstanding(F.col("total_outstanding"), F.col("credit_sales"), days)
    return summed.withColumn("dso", ratio)


# --- kept up to date ------------------------------------------------------------------------------
def changed_balances(
    invoices: DataFrame, payments: DataFrame, changed: DataFrame, *, exclude_flagged: bool = False
) -> DataFrame:
    """Balances of the invoices whose ids are in ``changed``: new or changed invoices and those with new or changed payments.

    All payments of such an invoice count, so staged invoices and payments are handed in whole; what does not belong to a
    changed invoice is dropped before payments are compared and summed up.
    """
    ids = changed.select("invoice_id").filter("invoice_id IS NOT NULL").distinct()
    ours, paid = (df.join(ids, "invoice_id", "left_semi") for df in (invoices, payments))
    return invoice_balances(ours, paid, exclude_flagged=exclude_flagged)


def load_balances(balances: DataFrame, out: str) -> dict[str, list[str]]:
    """Upsert balances, one an invoice, into ``out/balances``, by month of the invoice, and bring the totals of the reports up to date.

    Returns the partitions that each of the totals has read: those the load has changed.
    """
    spark = balances.sparkSession
    by_month = balances.withColumn(PERIOD, F.date_format("invoice_date", "yyyy-MM"))
    upsert_table(by_month, f"{out}/balances", ["invoice_id"], [PERIOD])
    return {
        "aging": open_by_due_date(out).refresh(spark, f"{out}/balances"),
        "dso": sales_by_customer(out).refresh(spark, f"{out}/balances"),
    }


def open_by_due_date(out: str) -> Totals:
    """Number and open amount of unpaid invoices per due date, from which aging follows for any day."""
    return Totals(
        f"{out}/open_by_due_date",
        [PERIOD],
        {"due_date": F.col("due_date")},
        {"invoice_count": F.lit(1), "outstanding": F.col("outstanding_amount")},
        where=metrics.is_open(F.col("invoice_status")),
    )


def sales_by_customer(out: str) -> Totals:
    """Open and invoiced amounts per customer."""
    unpaid = F.when(metrics.is_open(F.col("invoice_status")), F.col("outstanding_amount"))
    return Totals(
        f"{out}/sales_by_customer",
        [PERIOD],
        {"customer_id": F.col("customer_id")},
        {"outstanding": unpaid, "invoiced": F.col("invoice_amount")},
    )


def kept_aging_summary(totals: DataFrame, as_of: AsOf = None) -> DataFrame:
    """``aging_summary`` from the totals by due date."""
    bucket = F.coalesce(metrics.aging_bucket(F.col("due_date"), as_of), F.lit(NO_DUE_DATE))
    summed = totals.groupBy(bucket.alias("aging_bucket")).agg(
        F.sum("invoice_count").alias("invoice_count"), F.sum("outstanding").try_cast(MONEY).alias("total_outstanding")
    )
    return _every_bucket(summed)


def kept_dso(totals: DataFrame, days: int) -> DataFrame:
    """``dso`` by customer from the totals by customer."""
    summed = totals.select(
        "customer_id",
        F.coalesce("outstanding", F.lit(0)).try_cast(MONEY).alias("total_outstanding"),
        F.col("invoiced").try_cast(MONEY).alias("credit_sales"),
    )
    return _with_dso(summed, days)
