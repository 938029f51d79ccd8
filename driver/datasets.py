"""The two families of datasets, built lazily from the given tables."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from driver import inputs
from orderloom.plans import o2c, receivables, retail

AS_OF = dt.date(2001, 12, 31)
LOADED_AT = dt.datetime(2002, 1, 1)


class Retail:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return inputs.derive(self.spark, self.sf_dir, inputs.RETAIL[name])

    @cached_property
    def stg_orders(self) -> DataFrame:
        return retail.stg_orders(self.raw("raw_orders"))

    @cached_property
    def stg_customers(self) -> DataFrame:
        return retail.stg_customers(self.raw("raw_customers"))

    @cached_property
    def stg_products(self) -> DataFrame:
        return retail.stg_products(self.raw("raw_products"))

    @cached_property
    def int_orders_enriched(self) -> DataFrame:
        return retail.int_orders_enriched(self.stg_orders, self.stg_products)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return retail.dim_customers(self.stg_customers, AS_OF)

    @cached_property
    def dim_products(self) -> DataFrame:
        return retail.dim_products(self.stg_products)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return retail.fct_orders(self.int_orders_enriched, self.dim_customers, LOADED_AT)


class O2C:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return inputs.derive(self.spark, self.sf_dir, inputs.O2C[name])

    @cached_property
    def stg_customers(self) -> DataFrame:
        return o2c.stg_customers(self.raw("raw_customers"))

    @cached_property
    def stg_products(self) -> DataFrame:
        return o2c.stg_products(self.raw("raw_products"))

    @cached_property
    def stg_sales_orders(self) -> DataFrame:
        return o2c.stg_sales_orders(self.raw("raw_sales_orders"))

    @cached_property
    def stg_order_lines(self) -> DataFrame:
        return o2c.stg_order_lines(self.raw("raw_order_lines"))

    @cached_property
    def stg_shipments(self) -> DataFrame:
        return o2c.stg_shipments(self.raw("raw_shipments"))

    @cached_property
    def stg_invoices(self) -> DataFrame:
        return o2c.stg_invoices(self.raw("raw_invoices"))

    @cached_property
    def stg_payments(self) -> DataFrame:
        return o2c.stg_payments(self.raw("raw_payments"))

    @cached_property
    def int_order_lines_enriched(self) -> DataFrame:
        return o2c.int_order_lines_enriched(
            self.stg_order_lines, self.stg_sales_orders, self.stg_shipments, self.stg_products
        )

    @cached_property
    def int_invoices_enriched(self) -> DataFrame:
        return o2c.int_invoices_enriched(self.stg_invoices, self.stg_sales_orders, self.stg_payments, AS_OF)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return o2c.dim_customers(self.stg_customers, self.stg_sales_orders, AS_OF)

    @cached_property
    def dim_products(self) -> DataFrame:
        return o2c.dim_products(self.stg_products)

    @cached_property
    def fct_order_lines(self) -> DataFrame:
        return o2c.build_fct_order_lines(
            self.stg_order_lines, self.stg_sales_orders, self.stg_shipments, self.dim_customers, self.dim_products
        )

    @cached_property
    def fct_invoices(self) -> DataFrame:
        return o2c.fct_invoices(self.int_invoices_enriched, self.dim_customers)

    @cached_property
    def invoice_aging(self) -> DataFrame:
        return receivables.invoice_aging(self.fct_invoices, AS_OF)

    @cached_property
    def orders_with_lines(self) -> DataFrame:
        return o2c.build_orders_with_lines(
            self.stg_sales_orders, self.stg_order_lines, self.stg_shipments, self.stg_products
        )

    @cached_property
    def invoice_balances(self) -> DataFrame:
        return o2c.invoice_balances(self.stg_invoices, self.stg_payments)

    @cached_property
    def orders_with_shipments(self) -> DataFrame:
        return o2c.orders_with_shipments(self.stg_sales_orders, self.stg_shipments)
