"""Whole builds: raw inputs to stored marts, checked.

Staged tables and dimensions are stored first and facts read the stored ones, so raw inputs are parsed once.
Enriched datasets are views: they are part of the plans of what is stored. Row-level checks are counted by the tasks
that write a table; what is read again for checks are the columns of keys, and whole rows only where a check fails.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.metrics import AsOf
from orderloom.operators import quality
from orderloom.operators.staging import Staging
from orderloom.plans import checks, o2c, receivables, retail
from orderloom.sources.readers import parse_raw, read_raw
from orderloom.sources.tables import Layout, range_sort, write_table

Suites = Mapping[str, list[quality.Check]]


@dataclass
class Marts:
    """The tables a build stores under one folder, and the failures of row-level checks counted in their writes."""

    out: str
    suites: Suites
    data: dict[str, DataFrame] = field(default_factory=dict)
    counted: dict[str, dict[str, int]] = field(default_factory=dict)

    def store(self, name: str, rows: DataFrame, layout: Layout | None = None) -> None:
        counts = quality.RowCounts(self.suites.get(name, ()))
        self.data[name] = write_table(rows, f"{self.out}/{name}", layout=layout, counts=counts)
        self.counted[name] = counts.failures()

    def __getitem__(self, name: str) -> DataFrame:
        return self.data[name]

    def report(self, failures: str | None = None) -> DataFrame:
        return check_all(self.data, self.suites, failures, self.counted)


def read_all(spark: SparkSession, folder: str, schemas: Mapping, out: str | None = None) -> dict[str, DataFrame]:
    """All raw files of a family, ``<folder>/<name>.csv``.

    With ``out``, where the build goes, every file is parsed once and kept there under ``raw``, and lines with too many or too few
    fields are stored under ``rejected/<name>``: together with the rejected rows of the staged tables no line is lost.
    """
    root = folder.rstrip("/")
    if out is None:
        return {name: read_raw(spark, f"{root}/{name}.csv", schema) for name, schema in schemas.items()}
    found = {}
    for name, schema in schemas.items():
        found[name], malformed = parse_raw(spark, f"{root}/{name}.csv", schema, f"{out}/raw/{name}")
        malformed.write.mode("overwrite").parquet(f"{out}/rejected/{name}")
    return found


def build_o2c(
    raw: Mapping[str, DataFrame], out: str, as_of: AsOf = None, store_failures: bool = True
) -> DataFrame:
    """Store staged tables, order-to-cash marts and the aging of open invoices under ``out``; returns the report of all
    declared checks. Raw rows with unreadable text or without a key go to ``out/rejected``."""
    marts = stage_all(O2C_STAGING, raw, Marts(out, checks.O2C))
    marts.store("stg_payments", o2c.stg_payments(raw["raw_payments"]))
    store_rejected("stg_payments", o2c.payments_staging(), raw["raw_payments"], out)
    orders = marts["stg_sales_orders"]
    marts.store("dim_customers", o2c.dim_customers(marts["stg_customers"], orders, as_of))
    marts.store("dim_products", o2c.dim_products(marts["stg_products"]))
    marts.store(
        "fct_order_lines",
        o2c.build_fct_order_lines(
            marts["stg_order_lines"], orders, marts["stg_shipments"], marts["dim_customers"], marts["dim_products"]
        ),
    )
    invoices = o2c.int_invoices_enriched(marts["stg_invoices"], orders, marts["stg_payments"], as_of)
    by_date = range_sort("invoice_date")
    marts.store("fct_invoices", o2c.fct_invoices(invoices, marts["dim_customers"]), by_date)
    marts.store("fct_invoice_aging", receivables.invoice_aging(marts["fct_invoices"], as_of), by_date)
    return marts.report(f"{out}/test_failures" if store_failures else None)


O2C_STAGING = {
    "stg_customers": ("raw_customers", o2c.customers_staging),
    "stg_products": ("raw_products", o2c.products_staging),
    "stg_sales_orders": ("raw_sales_orders", o2c.sales_orders_staging),
    "stg_order_lines": ("raw_order_lines", o2c.order_lines_staging),
    "stg_shipments": ("raw_shipments", o2c.shipments_staging),
    "stg_invoices": ("raw_invoices", o2c.invoices_staging),
}
RETAIL_STAGING = {
    "stg_orders": ("raw_orders", retail.orders_staging),
    "stg_customers": ("raw_customers", retail.customers_staging),
    "stg_products": ("raw_products", retail.products_staging),
}


def stage_all(stagings: Mapping, raw: Mapping[str, DataFrame], marts: Marts) -> Marts:
    """Store every staged table, and beside it the raw rows with unreadable text or without a key."""
    for name, (source, make) in stagings.items():
        staging = make()
        marts.store(name, staging.rows(raw[source]))
        store_rejected(name, staging, raw[source], marts.out)
    return marts


def store_rejected(name: str, staging: Staging, raw: DataFrame, out: str) -> None:
    staging.rejected(raw).write.mode("overwrite").parquet(f"{out}/rejected/{name}")


def build_retail(
    raw: Mapping[str, DataFrame],
    out: str,
    now: dt.datetime,
    as_of: AsOf = None,
    store_failures: bool = True,
    **load_options,
) -> DataFrame:
    """Store staged tables and the retail marts under ``out``: dimensions anew, the order fact incrementally, customer
    history with a snapshot at ``now``. Returns the report of all declared checks."""
    marts = stage_all(RETAIL_STAGING, raw, Marts(out, checks.RETAIL))
    marts.data["int_orders_enriched"] = retail.int_orders_enriched(marts["stg_orders"], marts["stg_products"])
    marts.store("dim_customers", retail.dim_customers(marts["stg_customers"], as_of))
    marts.store("dim_products", retail.dim_products(marts["stg_products"]))
    marts.data["fct_orders"] = retail.load_fct_orders(
        marts["stg_orders"], marts["dim_customers"], f"{out}/fct_orders", loaded_at=now, products=marts["stg_products"], **load_options
    )
    retail.snapshot_customers(marts["stg_customers"], f"{out}/customer_history", now)
    return marts.report(f"{out}/test_failures" if store_failures else None)


def check_all(
    data: Mapping[str, DataFrame],
    suites: Suites,
    failures: str | None = None,
    counted: Mapping[str, dict[str, int]] | None = None,
) -> DataFrame:
    """One report over all suites, with a ``dataset`` column. Failing rows go under ``failures``.

    Of datasets in ``counted`` the row-level failures are known from their write: keys are compared in one scan of their
    columns, and rows are read only for checks that fail. Of others the report is counted from the failing rows; keys are compared first,
    in one scan of their columns, so that whole rows move only for key checks that fail.
    """
    report = None
    for dataset, suite in suites.items():
        rows, at, known = data[dataset], f"{failures}/{dataset}", (counted or {}).get(dataset)
        part = quality.run_checks(rows, suite, data) if known is None else quality.report_written(rows, suite, known, data)
        if failures is not None and known is not None:
            found = part.collect()  # a row per check
            quality.store_failures(rows, suite, at, data, [r["check"] for r in found if r["passed"]])
            part = rows.sparkSession.createDataFrame(found, part.schema)
        elif failures is not None:
            by_key = [c for c in suite if c.kind not in quality.ROW_KINDS]
            found = quality.run_checks(rows, by_key, data).collect() if by_key else []  # a row per check
            quality.store_failures(rows, suite, at, data, [r["check"] for r in found if r["passed"]])
            part = quality.stored_report(rows.sparkSession, suite, at)
        part = part.select(F.lit(dataset).alias("dataset"), "*")
        report = part if report is None else report.unionByName(part)
    return report
