"""The checks declared for each dataset, and the documented ones beyond them.

``RETAIL`` and ``O2C`` map a dataset to its checks; ``PARENTS`` are named as in the mapping.
Value lists and bounds are fixed values.
"""

from __future__ import annotations

import datetime as dt

from orderloom.operators.quality import Check, accepted, between, matches, not_null, relationships, unique

TIERS = ("GOLD", "SILVER", "PLATINUM", "BRONZE")
STAGED_STATUSES = ("COMP", "COMPLETED", "PENDING", "CANCELLED", "REFUND")
CATEGORIES = ("APPAREL", "FOOTWEAR", "ACCESSORIES")
STATUSES = ("Completed", "Pending", "Cancelled", "Refunded", "Unknown")
SALES_ORDER_STATUSES = ("CONFIRMED", "SHIPPED", "INVOICED", "CANCELLED", "ON_HOLD")
CARRIERS = ("FedEx", "FedEx Freight", "UPS", "USPS", "Other")
INVOICE_STATUSES = ("PAID", "OVERDUE", "OUTSTANDING", "PARTIAL")
PAYMENT_METHODS = ("ACH", "WIRE_TRANSFER", "CHECK")
ACCOUNT_STATUSES = ("ACTIVE", "INACTIVE")
SHIPMENT_STATUSES = ("DELIVERED", "IN TRANSIT", "PENDING")
REGION_NAMES = ("Northeast", "Southeast", "Midwest", "West", "Other")
MAX_ORDER_REVENUE = 10000
MAX_LINE_REVENUE = 500000
AGING_NAMES = ("Current", "1-30 days overdue", "31-60 days overdue", "60+ days overdue", "No due date")
ORDER_DATES = (dt.date(2020, 1, 1), dt.date(2030, 1, 1))


def primary_key(column: str) -> list[Check]:
    return [unique(column), not_null(column)]


RETAIL: dict[str, list[Check]] = {
    "stg_orders": [
        *primary_key("order_id"),
        not_null("customer_id"),
        not_null("product_id"),
        accepted("status", STAGED_STATUSES),
    ],
    "stg_customers": [*primary_key("customer_id"), not_null("email"), accepted("tier", TIERS)],
    "stg_products": [*primary_key("product_id"), not_null("list_price"), accepted("category", CATEGORIES)],
    "dim_customers": [*primary_key("customer_id"), accepted("tier", TIERS)],
    "dim_products": [*primary_key("product_id"), not_null("list_price")],
    "fct_orders": [
        *primary_key("order_id"),
        not_null("customer_id"),
        relationships("customer_id", "dim_customers", "customer_id"),
        not_null("product_id"),
        relationships("product_id", "int_orders_enriched", "product_id"),
        accepted("status", STATUSES),
        between("revenue", 0, MAX_ORDER_REVENUE),
        between("discount_pct", 0, 1),
        not_null("order_date"),
        between("order_date", *ORDER_DATES),
    ],
}

O2C: dict[str, list[Check]] = {
    "stg_customers": primary_key("customer_id"),
    "stg_products": primary_key("product_id"),
    "stg_sales_orders": [
        *primary_key("order_id"),
        not_null("customer_id"),
        accepted("order_status", SALES_ORDER_STATUSES),
    ],
    "stg_order_lines": [*primary_key("line_id"), not_null("order_id"), not_null("product_id")],
    "stg_shipments": [*primary_key("shipment_id"), not_null("order_id"), accepted("carrier", CARRIERS)],
    "stg_invoices": [
        *primary_key("invoice_id"),
        not_null("order_id"),
        not_null("customer_id"),
        accepted("payment_status", INVOICE_STATUSES),
    ],
    "stg_payments": [
        *primary_key("payment_id"),
        not_null("invoice_id"),
        accepted("payment_method", PAYMENT_METHODS).where("payment_method is not null"),
    ],
    "dim_customers": [*primary_key("customer_id"), accepted("status", ACCOUNT_STATUSES)],
    "dim_products": [*primary_key("product_id"), accepted("status", ACCOUNT_STATUSES)],
    "fct_order_lines": [
        *primary_key("line_id"),
        not_null("order_id"),
        not_null("customer_id"),
        relationships("customer_id", "dim_customers", "customer_id"),
        not_null("product_id"),
        relationships("product_id", "dim_products", "product_id"),
        accepted("order_status", SALES_ORDER_STATUSES),
        accepted("shipment_status", SHIPMENT_STATUSES).where("shipment_status is not null"),
        accepted("region", REGION_NAMES).where("region is not null"),
        between("gross_revenue", 0, MAX_LINE_REVENUE).where("gross_revenue is not null"),
        between("revenue", 0, MAX_LINE_REVENUE).where("revenue is not null"),
    ],
    "fct_invoices": [
        *primary_key("invoice_id"),
        not_null("order_id"),
        not_null("customer_id"),
        relationships("customer_id", "dim_customers", "customer_id"),
        accepted("invoice_status", INVOICE_STATUSES),
        between("invoice_amount", 0, MAX_LINE_REVENUE),
    ],
}

# Described in words for the same datasets. The product check above compares the fact with the table
# it was built from and cannot fail; the one here uses the product dimension.
DOCUMENTED_RETAIL: dict[str, list[Check]] = {
    "fct_orders": [
        matches("order_id", "^O_[0-9]{4,}$"),
        relationships("product_id", "dim_products", "product_id"),
        between("revenue", 0, 100000),
    ],
}

DOCUMENTED_O2C: dict[str, list[Check]] = {
    "stg_invoices": [relationships("order_id", "stg_sales_orders", "order_id")],
    "fct_order_lines": [between("quantity", 1, None), between("line_discount_pct", 0, 100)],
    "fct_invoices": [between("invoice_amount", 0.01, None)],
    "invoice_aging": [accepted("aging_bucket", AGING_NAMES)],
    "dim_customers": [not_null("company_name"), not_null("state"), not_null("payment_terms")],
}
