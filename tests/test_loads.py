"""Queries that load tables, over tables made here."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from driver import queries
from driver.datasets import O2C
from orderloom.plans import receivables


@pytest.fixture
def tables(spark, folder):
    """Orders in four files, and their lines."""
    day = F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval((F.col("id") % 900).cast("int"))
    orders = spark.range(120).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 9).alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        (F.col("id") * 1.5).alias("o_totalprice"), day.alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"),
    )
    orders.repartition(4).write.parquet(f"{folder}/orders.parquet")
    lines = spark.range(300).select(
        (F.col("id") % 120).alias("l_orderkey"), (F.col("id") % 7).alias("l_partkey"), (F.col("id") % 5).alias("l_suppkey"),
        (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"), F.lit(3.0).alias("l_quantity"), (F.col("id") % 40 * 2.5).alias("l_extendedprice"),
        F.lit(0.0).alias("l_discount"), F.lit(0.0).alias("l_tax"), F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), day.alias("l_shipdate"),
    )
    lines.repartition(4).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def test_raw_orders_arrive_in_as_many_shares_as_the_input_has_splits(spark, tables):
    before = set(glob.glob(f"{queries.work_dir(spark)}/landing-*"))
    got = queries.QUERIES["stream_upsert"](spark, tables)
    assert got.count() == 120 and got.filter("order_date = '2002-01-15'").count() == 18
    (landing,) = set(glob.glob(f"{queries.work_dir(spark)}/landing-*")) - before
    splits = O2C(spark, tables).raw("raw_sales_orders").rdd.getNumPartitions()
    assert splits > 1 and len(glob.glob(f"{landing}/part-*")) > 4  # one file and three before


def test_kept_receivables_compare_payments_once(spark, tables, monkeypatch):
    real, plans = receivables.changed_balances, []

    def seen(invoices, payments, changed):
        plans.extend(df._jdf.queryExecution().optimizedPlan().toString() for df in (payments, changed))
        return real(invoices, payments, changed)

    monkeypatch.setattr(receivables, "changed_balances", seen)
    kept = {tuple(r) for r in queries.QUERIES["dso_kept"](spark, tables).collect()}
    assert len(plans) == 2 and not any("Window" in plan for plan in plans)
    assert kept == {tuple(r) for r in queries.QUERIES["dso_customer"](spark, tables).collect()} and len(kept) == 9
