"""Order-to-cash: sales orders with lines, shipments, invoices and payments."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import mapping, metrics, parsing, text
from orderloom.functions.metrics import AsOf
from orderloom.operators.dedupe import dedupe_first
from orderloom.operators.lookup import left_lookup, lookups_in_place
from orderloom.operators.rollup import first_orders, order_rollup, payment_totals
from orderloom.operators.staging import Staging
from orderloom.sources import schemas

PRICE = "decimal(12,2)"
AMOUNT = "decimal(14,2)"
PCT = "decimal(5,2)"
WEIGHT = "decimal(8,2)"


def _same(*names: str) -> dict:
    return {name: F.col(name) for name in names}


# --- staging --------------------------------------------------------------------------------------
def customers_staging(mode: str = "try") -> Staging:
    titled = lambda name: text.title_case(F.col(name))
    coded = lambda name: text.upper_clean(F.col(name))
    return Staging(
        columns={
            **_same("customer_id"),
            "company_name": titled("company_name"),
            "industry": titled("industry"),
            "contact_name": titled("contact_name"),
            "email": text.lower_clean(F.col("email")),
            "phone": text.blank_to_null(F.col("phone")),
            "billing_address": text.trimmed(F.col("billing_address")),
            "city": titled("city"),
            "state": coded("state"),
            "country": mapping.map_values(F.col("country"), mapping.COUNTRY),
            "payment_terms": coded("payment_terms"),
            "credit_limit": parsing.cast_text(F.col("credit_limit"), PRICE, mode),
            "status": coded("status"),
            "created_date": parsing.parse_date(F.col("created_date")),
        },
        typed={"credit_limit": "credit_limit", "created_date": "created_date"},
    )


def products_staging(mode: str = "try") -> Staging:
    return Staging(
        columns={
            **_same("product_id"),
            "product_name": text.title_case(F.col("product_name")),
            "category": text.title_case(F.col("category")),
            "sku": text.upper_clean(F.col("sku")),
            "unit_price": parsing.cast_text(F.col("unit_price"), PRICE, mode),
            "cost_price": parsing.cast_text(F.col("cost_price"), PRICE, mode),
            "unit_of_measure": text.upper_clean(F.col("unit_of_measure")),
            "status": text.upper_clean(F.col("status")),
            "lead_time_days": parsing.parse_int(F.col("lead_time_days"), mode),
            "created_date": parsing.cast_text(F.col("created_date"), "date", mode),
        },
        typed={n: n for n in ("unit_price", "cost_price", "lead_time_days", "created_date")},
    )


def sales_orders_staging(mode: str = "try") -> Staging:
    discount = parsing.cast_text(F.col("discount_pct"), PCT, mode)
    return Staging(
        columns={
            **_same("order_id", "customer_id"),
            "order_date": parsing.parse_date(F.col("order_date")),
            "requested_ship_date": parsing.parse_date(F.col("requested_ship_date")),
            "order_status": mapping.map_values(F.col("order_status"), mapping.SALES_ORDER_STATUS),
            "sales_rep": text.trimmed(F.col("sales_rep")),
            "channel": text.title_case(F.col("channel")),
            "currency": text.upper_clean(F.col("currency")),
            "order_discount_pct": parsing.or_zero(discount, PCT),
            "po_number": text.blank_to_null(F.col("po_number")),
            "notes": text.blank_to_null(F.col("notes")),
        },
        typed={n: n for n in ("order_date", "requested_ship_date")} | {"order_discount_pct": "discount_pct"},
        parsed={"order_discount_pct": discount},
    )


def order_lines_staging(mode: str = "try") -> Staging:
    quantity = parsing.word_number(F.col("quantity"))
    price = parsing.cast_text(F.col("unit_price"), PRICE, mode)
    stated_discount = parsing.cast_text(F.col("line_discount_pct"), PCT, mode)
    discount = parsing.or_zero(stated_discount, PCT)
    stated = parsing.cast_text(F.col("line_total"), AMOUNT, mode)
    return Staging(
        columns={
            **_same("line_id", "order_id", "product_id"),
            "quantity": quantity,
            "unit_price": price,
            "line_discount_pct": discount,
            "line_total": metrics.line_total(stated, quantity, price, discount),
            "has_unparseable_quantity": quantity.isNull(),
            "notes": text.blank_to_null(F.col("notes")),
        },
        typed={n: n for n in ("quantity", "unit_price", "line_discount_pct", "line_total")},
        parsed={"line_discount_pct": stated_discount, "line_total": stated},
    )


def shipments_staging(mode: str = "try") -> Staging:
    weight = parsing.cast_text(F.col("weight_lbs"), WEIGHT, mode)
    return Staging(
        columns={
            **_same("shipment_id", "order_id"),
            "ship_date": parsing.cast_text(F.col("ship_date"), "date", mode),
            "carrier": mapping.carrier_of(F.col("carrier")),
            "carrier_raw": text.trimmed(F.col("carrier")),
            "tracking_number": text.blank_to_null(F.col("tracking_number")),
            "ship_to_name": text.title_case(F.col("ship_to_name")),
            "ship_to_address": text.trimmed(F.col("ship_to_address")),
            "ship_to_city": text.title_case(F.col("ship_to_city")),
            "ship_to_state": text.upper_clean(F.col("ship_to_state")),
            "ship_to_zip": text.trimmed(F.col("ship_to_zip")),
            "status": text.upper_clean(F.col("status")),
            "weight_lbs": parsing.zero_to_null(weight),
            "notes": text.blank_to_null(F.col("notes")),
        },
        typed={"ship_date": "ship_date", "weight_lbs": "weight_lbs"},
        parsed={"weight_lbs": weight},
    )


def invoices_staging(mode: str = "try") -> Staging:
    amounts = ("invoice_amount", "tax_amount", "total_amount")
    overdue = parsing.parse_int(F.col("days_overdue"), mode)
    return Staging(
        columns={
            **_same("invoice_id", "order_id", "customer_id"),
            "invoice_date": parsing.parse_date(F.col("invoice_date")),
            "due_date": parsing.parse_date(F.col("due_date")),
            **{name: parsing.cast_text(F.col(name), AMOUNT, mode) for name in amounts},
            "payment_terms": text.upper_clean(F.col("payment_terms")),
            "payment_status": text.upper_clean(F.col("payment_status")),
            "days_overdue": parsing.or_zero(overdue, "int"),
            "notes": text.blank_to_null(F.col("notes")),
        },
        typed={n: n for n in ("invoice_date", "due_date", *amounts, "days_overdue")},
        parsed={"days_overdue": overdue},
    )


def payments_staging(mode: str = "try") -> Staging:
    return Staging(
        columns={
            **_same("payment_id", "invoice_id", "customer_id"),
            "payment_date": parsing.parse_date(F.col("payment_date")),
            "amount": parsing.cast_text(F.col("amount"), AMOUNT, mode),
            "payment_method": mapping.payment_method_of(F.col("payment_method")),
            "reference_number": text.blank_to_null(F.col("reference_number")),
            "bank_ref": text.blank_to_null(F.col("bank_ref")),
            "notes": text.blank_to_null(F.col("notes")),
            "is_duplicate_flag": text.contains_ci(F.col("notes"), "DUPLICATE"),
        },
        typed={n: n for n in ("payment_date", "amount")},
    )


def stg_customers(raw: DataFrame, mode: str = "try") -> DataFrame:
    return customers_staging(mode).rows(raw)


def stg_products(raw: DataFrame, mode: str = "try") -> DataFrame:
    return products_staging(mode).rows(raw)


def stg_sales_orders(raw: DataFrame, mode: str = "try") -> DataFrame:
    return sales_orders_staging(mode).rows(raw)


def stg_order_lines(raw: DataFrame, mode: str = "try") -> DataFrame:
    return order_lines_staging(mode).rows(raw)


def stg_shipments(raw: DataFrame, mode: str = "try") -> DataFrame:
    return shipments_staging(mode).rows(raw)


def stg_invoices(raw: DataFrame, mode: str = "try") -> DataFrame:
    return invoices_staging(mode).rows(raw)


def stg_payments(raw: DataFrame, mode: str = "try") -> DataFrame:
    """Staged payments, one per invoice and amount: the one with the lowest id stays.

    Missing amounts of an invoice count as equal. Unreadable ones are told apart by their text, so
    that no payment disappears because two of them could not be read.
    """
    staging = payments_staging(mode)
    unread = F.when(staging.columns["amount"].isNull(), text.blank_to_null(F.col("amount")))
    rows = replace(staging, columns={**staging.columns, "_unread": unread}).rows(raw)
    return dedupe_first(rows, ["invoice_id", "amount", "_unread"], ["payment_id"]).drop("_unread")


# --- enriched lines and invoices ------------------------------------------------------------------
def _shipment_side(shipments: DataFrame) -> DataFrame:
    return shipments.select(
        "order_id",
        "shipment_id",
        "ship_date",
        "carrier",
        F.col("status").alias("shipment_status"),
        "tracking_number",
        "ship_to_city",
        "ship_to_state",
        "ship_to_zip",
        "weight_lbs",
    )


def _line_metrics() -> dict[str, Column]:
    """Amounts and delivery metrics of a line joined with order, shipment and product."""
    amounts = metrics.line_amounts(
        F.col("quantity"), F.col("unit_price"), F.col("cost_price"), metrics.percent(F.col("line_discount_pct"))
    )
    return amounts | {
        "is_on_time_delivery": metrics.is_on_time(F.col("ship_date"), F.col("requested_ship_date")),
        "days_to_ship": metrics.days_between(F.col("order_date"), F.col("ship_date")),
    }


def int_order_lines_enriched(
    lines: DataFrame,
    orders: DataFrame,
    shipments: DataFrame,
    products: DataFrame,
    *,
    unique_shipments: bool | str = False,
) -> DataFrame:
    """Lines with order, shipment and cost. The product comes first, while lines are narrow; orders
    and shipments join on the same key, so the lines are shuffled once for both and come out
    partitioned by order, as the order rollup needs them. An order with several shipments repeats its lines, as a left join
    does; ``unique_shipments`` checks that there is none (see ``left_lookup``)."""
    joined = left_lookup(lines.drop("notes"), products, "product_id", ["cost_price"])
    joined = left_lookup(joined, orders.drop("notes"), "order_id")
    joined = left_lookup(joined, _shipment_side(shipments), "order_id", unique=unique_shipments)
    computed = _line_metrics()
    return joined.select(*[computed[c].alias(c) if c in computed else c for c in schemas.O2C["int_order_lines_enriched"]])


def int_invoices_enriched(
    invoices: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    as_of: AsOf = None,
    *,
    exclude_flagged: bool = False,
) -> DataFrame:
    """Invoices with order context and what has been paid. Payments are summed up before the join,
    so an invoice stays one row. They come first, while invoices are narrow."""
    order_context = ["order_date", "sales_rep", "channel", "currency", "order_status", "po_number"]
    own = [
        *("invoice_date", "due_date", "invoice_amount", "tax_amount", "total_amount"),
        *("payment_terms", "payment_status", "notes"),
    ]
    joined = left_lookup(invoices, payment_totals(payments, exclude_flagged=exclude_flagged), "invoice_id")
    joined = left_lookup(joined, orders, "order_id", order_context)
    paid = parsing.or_zero(F.col("amount_paid"), metrics.MONEY)
    status = F.col("payment_status")
    return joined.select(
        *("invoice_id", "order_id", "customer_id"),
        *order_context,
        *own,
        paid.alias("amount_paid"),
        parsing.or_zero(F.col("payment_count"), "bigint").alias("payment_count"),
        "last_payment_date",
        metrics.outstanding(F.col("invoice_amount"), paid).alias("outstanding_amount"),
        metrics.days_between(F.col("invoice_date"), F.col("due_date")).alias("days_to_due"),
        metrics.days_outstanding(F.col("invoice_date"), status, as_of).alias("days_outstanding"),
        metrics.is_overdue(F.col("due_date"), status, as_of).alias("is_overdue"),
    )


def invoice_balances(invoices: DataFrame, payments: DataFrame, *, exclude_flagged: bool = False) -> DataFrame:
    """What receivables reports need of an invoice, from invoices and payments alone: status, dates, amount and what is open."""
    joined = left_lookup(invoices, payment_totals(payments, exclude_flagged=exclude_flagged), "invoice_id")
    paid = parsing.or_zero(F.col("amount_paid"), metrics.MONEY)
    return joined.select(
        *("invoice_id", "customer_id", "invoice_date", "due_date"),
        F.col("payment_status").alias("invoice_status"),
        "invoice_amount",
        metrics.outstanding(F.col("invoice_amount"), paid).alias("outstanding_amount"),
    )


# --- dimensions -----------------------------------------------------------------------------------
def dim_customers(customers: DataFrame, orders: DataFrame, as_of: AsOf = None) -> DataFrame:
    tenure = metrics.days_between(F.col("first_order_date"), metrics.as_of_date(as_of))
    return left_lookup(customers, first_orders(orders), "customer_id").select(
        *customers.columns, "first_order_date", tenure.alias("days_since_first_order")
    )


def dim_products(products: DataFrame) -> DataFrame:
    margin = metrics.margin_pct(F.col("unit_price"), F.col("cost_price"))
    return products.select("*", margin.alias("gross_margin_pct"))


# --- facts ----------------------------------------------------------------------------------------
def _customer_side(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        "company_name",
        "industry",
        F.col("city").alias("customer_city"),
        F.col("state").alias("customer_state"),
        F.col("country").alias("customer_country"),
    )


PRODUCT_ATTRIBUTES = ("product_name", "category", "sku", "unit_of_measure", "gross_margin_pct")


def fct_order_lines(lines: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Enriched lines with customer and product attributes; both sides are the dimensions.

    Enriched lines are wide and lie together by order, where they stay: the keys of an order's lines travel to the dimensions and
    bring the attributes back. ``build_fct_order_lines`` moves less still, if the enriched lines themselves are not needed."""
    sides = {"product_id": products.select("product_id", *PRODUCT_ATTRIBUTES), "customer_id": _customer_side(customers)}
    return _order_line_fact(lookups_in_place(lines, sides, within="order_id"))


def build_fct_order_lines(
    lines: DataFrame, orders: DataFrame, shipments: DataFrame, customers: DataFrame, products: DataFrame
) -> DataFrame:
    """The order-line fact straight from staged lines, orders and shipments and the two dimensions.

    Same rows as ``fct_order_lines`` over ``int_order_lines_enriched``, with less movement of the
    largest input: customers are attached to orders, which are several times fewer than lines, and
    products are joined once for both cost and attributes. Lines are shuffled by product while they
    are narrow (only if products are too large to broadcast), then once by order for both orders and
    shipments.
    """
    known_orders = left_lookup(orders.drop("notes"), _customer_side(customers), "customer_id")
    joined = left_lookup(lines.drop("notes"), products, "product_id", ["cost_price", *PRODUCT_ATTRIBUTES])
    joined = left_lookup(joined, known_orders, "order_id")
    joined = left_lookup(joined, _shipment_side(shipments), "order_id")
    return _order_line_fact(joined.select("*", *[v.alias(n) for n, v in _line_metrics().items()]))


def _order_line_fact(joined: DataFrame) -> DataFrame:
    region = mapping.region_of(F.col("customer_state")).alias("region")
    return joined.select(*[region if c == "region" else c for c in schemas.O2C["fct_order_lines"]])


def fct_invoices(invoices: DataFrame, customers: DataFrame) -> DataFrame:
    customer_side = _customer_side(customers).drop("customer_city")
    return left_lookup(invoices, customer_side, "customer_id").select(
        *("invoice_id", "order_id", "customer_id"),
        *[c for c in customer_side.columns if c != "customer_id"],
        *("order_date", "sales_rep", "channel", "currency", "order_status", "po_number"),
        *("invoice_date", "due_date", "payment_terms"),
        F.col("payment_status").alias("invoice_status"),
        *("tax_amount", "total_amount", "last_payment_date", "payment_count"),
        *("invoice_amount", "amount_paid", "outstanding_amount"),
        *("days_to_due", "days_outstanding", "is_overdue"),
    )


# --- order grain ----------------------------------------------------------------------------------
def orders_with_lines(orders: DataFrame, enriched_lines: DataFrame) -> DataFrame:
    """Sales orders with the totals of their lines; orders without lines show zero lines."""
    return _with_totals(orders, order_rollup(enriched_lines))


def _with_totals(orders: DataFrame, totals: DataFrame) -> DataFrame:
    joined = left_lookup(orders, totals, "order_id")
    counts = ("line_count", "product_count")
    return joined.select(
        *[parsing.or_zero(F.col(c), "bigint").alias(c) if c in counts else F.col(c) for c in joined.columns]
    )


def build_orders_with_lines(orders: DataFrame, lines: DataFrame, shipments: DataFrame, products: DataFrame) -> DataFrame:
    """The same from staged tables, without the enriched lines: sums need no order or shipment column, and an order with
    several shipments, which repeats its lines there, only multiplies them. Lines move by product and order, once each, as five
    narrow columns. Order ids are unique in ``orders``."""
    narrow = lines.select("order_id", "product_id", "quantity", "unit_price", "line_discount_pct")
    priced = left_lookup(narrow, products, "product_id", ["cost_price"])
    amounts = metrics.line_amounts(
        F.col("quantity"), F.col("unit_price"), F.col("cost_price"), metrics.percent(F.col("line_discount_pct"))
    )
    summed = order_rollup(priced.select("order_id", "product_id", *[c.alias(name) for name, c in amounts.items()]))
    repeats = shipments.filter(F.col("order_id").isNotNull()).groupBy("order_id").agg(F.count("*").alias("_shipments"))
    times = F.coalesce("_shipments", F.lit(1))
    rolled = left_lookup(summed, repeats, "order_id").select(
        "order_id",
        (F.col("line_count") * times).alias("line_count"),
        "product_count",
        *[(F.col(c) * times.cast("decimal(10,0)")).try_cast(metrics.MONEY).alias(c) for c in summed.columns if c in amounts],
    )
    return _with_totals(orders, rolled)


def orders_with_shipments(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """Sales orders with shipment status and delivery metrics."""
    shipment_side = shipments.select(
        "order_id", "shipment_id", "ship_date", "carrier", F.col("status").alias("shipment_status")
    )
    return left_lookup(orders, shipment_side, "order_id").select(
        *orders.columns,
        *[c for c in shipment_side.columns if c != "order_id"],
        metrics.is_on_time(F.col("ship_date"), F.col("requested_ship_date")).alias("is_on_time_delivery"),
        metrics.days_between(F.col("order_date"), F.col("ship_date")).alias("days_to_ship"),
    )


def on_time_rate(order_shipments: DataFrame, by: str | None = None) -> DataFrame:
    """Share of shipped orders that left on time. An order with several shipments counts once, and
    only if all of them were on time."""
    shipped = order_shipments.filter(F.col("ship_date").isNotNull())
    keys = ["order_id"] if by is None else ["order_id", by]
    orders = shipped.groupBy(*keys).agg(F.bool_and("is_on_time_delivery").alias("on_time"))
    groups = [] if by is None else [by]
    counted = orders.groupBy(*groups).agg(
        F.count("*").alias("shipped_orders"), F.count_if("on_time").alias("on_time_orders")
    )
    share = F.try_divide(F.col("on_time_orders").cast("decimal(20,0)"), F.col("shipped_orders").cast("decimal(20,0)"))
    return counted.withColumn("on_time_rate", F.round(share, 4).cast("decimal(5,4)"))
