"""Retail: one product per order, priced from the product table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions import mapping, metrics, parsing, text
from orderloom.functions.metrics import AsOf
from orderloom.operators.dedupe import dedupe_first
from orderloom.operators.incremental import high_water_mark, newer_than
from orderloom.operators.lookup import left_lookup
from orderloom.operators.staging import Staging
from orderloom.sources.tables import newest_partition, snapshot_table, upsert_table, with_loaded_at

PRICE = "decimal(14,4)"
SHARE = "decimal(9,6)"
PERIOD = "order_period"
PERIOD_FORMATS = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}
DESCRIBED = ["product_name", "category", "brand"]
PRODUCT_COLUMNS = ["list_price", "cost_price", *DESCRIBED]
HISTORY_CHECK = ("tier", "country_code", "is_marketing_opted_in")


# --- staging --------------------------------------------------------------------------------------
def orders_staging(mode: str = "try") -> Staging:
    return Staging(
        columns={
            "order_id": F.col("id"),
            "customer_id": F.col("cust_id"),
            "product_id": F.col("prod_id"),
            "order_date": parsing.cast_text(F.col("order_dt"), "date", mode),
            "status": mapping.map_values(F.col("stat"), mapping.STAGED_STATUS),
            "quantity": parsing.parse_int(F.col("qty"), mode),
            "discount_pct": parsing.cast_text(F.col("disc_pct"), SHARE, mode),
            "channel": text.upper_clean(F.col("channel")),
            "promo_code": F.col("promo_cd"),
        },
        typed={"order_date": "order_dt", "quantity": "qty", "discount_pct": "disc_pct"},
        key="id",
    )


def customers_staging(mode: str = "try") -> Staging:
    return Staging(
        columns={
            "customer_id": F.col("id"),
            "first_name": text.capitalize_first(F.col("first_nm")),
            "last_name": text.capitalize_first(F.col("last_nm")),
            "email": text.lower_clean(F.col("email_addr")),
            "country_code": text.upper_clean(F.col("cntry_cd")),
            "registered_date": parsing.cast_text(F.col("reg_dt"), "date", mode),
            "tier": text.upper_clean(F.col("tier")),
            "is_marketing_opted_in": parsing.parse_boolean(F.col("mrktng_opt_in"), mode),
        },
        typed={"registered_date": "reg_dt", "is_marketing_opted_in": "mrktng_opt_in"},
        key="id",
    )


def products_staging(mode: str = "try") -> Staging:
    return Staging(
        columns={
            "product_id": F.col("id"),
            "product_name": text.trimmed(F.col("prod_nm")),
            "category": text.upper_clean(F.col("ctgry")),
            "brand": text.upper_clean(F.col("brnd")),
            "list_price": parsing.cast_text(F.col("lst_price"), PRICE, mode),
            "cost_price": parsing.cast_text(F.col("cst_price"), PRICE, mode),
            "is_active": parsing.parse_boolean(F.col("is_active"), mode),
            "launch_date": parsing.cast_text(F.col("launch_dt"), "date", mode),
        },
        typed={
            "list_price": "lst_price",
            "cost_price": "cst_price",
            "is_active": "is_active",
            "launch_date": "launch_dt",
        },
        key="id",
    )


def stg_orders(raw: DataFrame, mode: str = "try") -> DataFrame:
    return orders_staging(mode).rows(raw)


def stg_customers(raw: DataFrame, mode: str = "try") -> DataFrame:
    return customers_staging(mode).rows(raw)


def stg_products(raw: DataFrame, mode: str = "try") -> DataFrame:
    return products_staging(mode).rows(raw)


# --- marts ----------------------------------------------------------------------------------------
def int_orders_enriched(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Orders priced with the current list price of their product."""
    return _enriched(left_lookup(orders, products, "product_id", PRODUCT_COLUMNS))


def _enriched(priced: DataFrame, *others: str) -> DataFrame:
    """Enriched orders from staged ones that have the columns of their product; ``others`` stay as they are."""
    line = _of_line()
    discount = line["discount_pct"]
    amounts = metrics.line_amounts(F.col("quantity"), F.col("list_price"), F.col("cost_price"), discount)
    return priced.select(
        "order_id",
        "customer_id",
        "product_id",
        "order_date",
        line["status"].alias("status"),
        "quantity",
        F.col("list_price").alias("unit_price"),
        discount.alias("discount_pct"),
        line["channel"].alias("channel"),
        "promo_code",
        *[value.alias(name) for name, value in amounts.items()],
        *DESCRIBED,
        *others,
    )


def _of_line() -> dict[str, Column]:
    """What an enriched order has of its staged order alone, the order date first, then in column order."""
    return {
        "order_date": F.col("order_date"),
        "customer_id": F.col("customer_id"),
        "product_id": F.col("product_id"),
        "status": mapping.map_values(F.col("status"), mapping.ORDER_STATUS, mapping.ORDER_STATUS_DEFAULT),
        "quantity": F.col("quantity"),
        "discount_pct": parsing.or_zero(F.col("discount_pct"), SHARE),
        "channel": mapping.map_values(F.col("channel"), mapping.SALES_CHANNEL, mapping.SALES_CHANNEL_DEFAULT),
        "promo_code": F.col("promo_code"),
    }


def dim_customers(customers: DataFrame, as_of: AsOf = None) -> DataFrame:
    registered = F.col("registered_date")
    return customers.select(
        "customer_id",
        text.full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        "first_name",
        "last_name",
        "email",
        "country_code",
        registered.alias("registration_date"),
        "tier",
        "is_marketing_opted_in",
        metrics.days_between(registered, metrics.as_of_date(as_of)).alias("days_since_signup"),
        metrics.is_new_customer(registered, as_of).alias("is_new_customer"),
    )


def dim_products(products: DataFrame) -> DataFrame:
    price, cost = F.col("list_price"), F.col("cost_price")
    return products.select(
        "*",
        metrics.unit_margin(price, cost).alias("gross_margin"),
        metrics.margin_pct(price, cost).alias("margin_pct"),
    )


def fct_orders(enriched: DataFrame, customers: DataFrame, loaded_at: dt.datetime | None = None) -> DataFrame:
    """Orders with the tier of their customer; ``customers`` is the dimension."""
    tiered = left_lookup(enriched, _tiers(customers), "customer_id")
    return _order_fact(tiered.select(*enriched.columns, "customer_tier"), loaded_at)


def _tiers(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", F.col("tier").alias("customer_tier"))


def _order_fact(tiered: DataFrame, loaded_at: dt.datetime | None, *others: str) -> DataFrame:
    """The columns of the fact, and ``others``, of enriched orders that have the tier of their customer."""
    own = [c for c in tiered.columns if c not in ("customer_tier", *DESCRIBED, *others)]
    return with_loaded_at(tiered.select(*own, "customer_tier", *DESCRIBED, *others), loaded_at)


def priced_once(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Staged orders, one row per order id, with the tier of their customer and the columns of their product: what the stored fact
    is computed from.

    Of several rows with one id the one stays whose enriched row comes first by order date, then by the remaining columns, the
    larger value first. What a row has of its product comes after its product id in that order, and all rows of one product id meet
    the same products. So the first by its own columns is found while rows are narrow, and a second look, where the rows lie by
    product, is only for products and customers that are there more than once.
    """
    first = dedupe_first(orders, ["order_id"], [c.desc() for c in _of_line().values()])
    tiered = left_lookup(first, _tiers(customers), "customer_id")
    priced = left_lookup(tiered, products, "product_id", PRODUCT_COLUMNS)
    amounts = metrics.line_amounts(F.col("quantity"), F.col("list_price"), F.col("cost_price"), _of_line()["discount_pct"])
    order = [F.col("list_price"), amounts["cost"], amounts["gross_profit"], *map(F.col, DESCRIBED), F.col("customer_tier")]
    return dedupe_first(priced, ["product_id", "order_id"], [c.desc() for c in order])


# --- loads ----------------------------------------------------------------------------------------
def loaded_until(spark: SparkSession, path: str) -> dt.date | None:
    """Latest order date in the stored fact, null before the first load. Only the newest period is
    read, and that one is found by folder name."""
    newest = newest_partition(spark, path, PERIOD)
    return None if newest is None else high_water_mark(newest, "order_date")


def load_fct_orders(
    enriched: DataFrame,
    customers: DataFrame,
    path: str,
    *,
    period: str = "day",
    full_refresh: bool = False,
    inclusive: bool = False,
    lookback_days: int = 0,
    loaded_at: dt.datetime | None = None,
    old_rows_in: Column | str | None = None,
    products: DataFrame | None = None,
) -> DataFrame:
    """Incremental load of the order fact, stored in one partition per ``period`` of order dates:
    days for volumes of gigabytes a day, months or years below that.

    Orders without a date are part of every load: no mark can tell whether they are new. ``old_rows_in`` is a
    condition on the stored fact, usually on its period, that says where earlier rows of the same
    orders may be; without it the index of order ids tells. Orders that are as they were stay untouched and
    keep the time of the load that wrote them.

    Of several rows with one order id in a batch the latest order date wins, then the larger of the
    remaining values in column order.

    With ``products`` staged orders are given in place of enriched ones: they are cut to one per id and get their tier while they are
    narrow, and amounts are computed by the tasks that write them. The same rows are stored.
    """
    mark = None if full_refresh else loaded_until(enriched.sparkSession, path)
    new = newer_than(
        enriched, "order_date", mark, inclusive=inclusive, lookback_days=lookback_days, undated=True
    )
    period_of = F.date_format("order_date", PERIOD_FORMATS[period])
    if products is None:
        facts, order, derive = fct_orders(new, customers, loaded_at).withColumn(PERIOD, period_of), _latest(enriched.columns), None
    else:
        facts, order, derive = priced_once(new, customers, products).withColumn(PERIOD, period_of), None, lambda rows: (
            _order_fact(_enriched(rows, "customer_tier", PERIOD), loaded_at, PERIOD)
        )
    stored = upsert_table(
        facts,
        path,
        ["order_id"],
        [PERIOD],
        order_by=order,
        old_rows_in=old_rows_in,
        full_refresh=full_refresh,
        ignore=["loaded_at"],
        derive=derive,
    )
    return stored.drop(PERIOD)


def _latest(columns: Sequence[str]) -> list[Column]:
    """Order date first, then the remaining columns, the larger value first."""
    return [F.col("order_date").desc(), *[F.col(c).desc() for c in columns if c != "order_date"]]


def snapshot_customers(customers: DataFrame, path: str, now: dt.datetime) -> DataFrame:
    """Stored type-2 history of staged customers."""
    order = [F.col(c) for c in customers.columns]
    return snapshot_table(customers, path, ["customer_id"], HISTORY_CHECK, now, order_by=order)
