"""Column lists of raw inputs (all text) and of every dataset built from them."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType


def _text(columns: str) -> StructType:
    return StructType([StructField(name, StringType()) for name in columns.split()])


# Raw files hold mixed spellings, so every column is read as text and typed in staging. Inference
# would also turn postal codes with a leading zero into numbers.
RETAIL_RAW = {
    "raw_orders": _text("id cust_id prod_id order_dt stat qty disc_pct channel promo_cd"),
    "raw_customers": _text("id first_nm last_nm email_addr cntry_cd reg_dt tier mrktng_opt_in"),
    "raw_products": _text("id prod_nm ctgry brnd lst_price cst_price is_active launch_dt"),
}

O2C_RAW = {
    "raw_customers": _text(
        "customer_id company_name industry contact_name email phone billing_address city state country "
        "payment_terms credit_limit status created_date"
    ),
    "raw_products": _text(
        "product_id product_name category sku unit_price cost_price unit_of_measure status lead_time_days "
        "created_date"
    ),
    "raw_sales_orders": _text(
        "order_id customer_id order_date requested_ship_date order_status sales_rep channel currency "
        "discount_pct po_number notes"
    ),
    "raw_order_lines": _text(
        "line_id order_id product_id quantity unit_price line_discount_pct line_total notes"
    ),
    "raw_shipments": _text(
        "shipment_id order_id ship_date carrier tracking_number ship_to_name ship_to_address ship_to_city "
        "ship_to_state ship_to_zip status weight_lbs notes"
    ),
    "raw_invoices": _text(
        "invoice_id order_id customer_id invoice_date due_date invoice_amount tax_amount total_amount "
        "payment_status payment_terms days_overdue notes"
    ),
    "raw_payments": _text(
        "payment_id invoice_id customer_id payment_date amount payment_method reference_number bank_ref notes"
    ),
}


# --- datasets: ``name:type`` in column order ------------------------------------------------------
def _columns(text: str) -> dict[str, str]:
    return dict(entry.split(":") for entry in text.split())


_LINE_AMOUNTS = (
    "gross_revenue:decimal(18,2) discount_amount:decimal(18,2) revenue:decimal(18,2) cost:decimal(18,2) "
    "gross_profit:decimal(18,2)"
)

RETAIL = {
    "stg_orders": _columns(
        "order_id:string customer_id:string product_id:string order_date:date status:string quantity:int "
        "discount_pct:decimal(9,6) channel:string promo_code:string"
    ),
    "stg_customers": _columns(
        "customer_id:string first_name:string last_name:string email:string country_code:string "
        "registered_date:date tier:string is_marketing_opted_in:boolean"
    ),
    "stg_products": _columns(
        "product_id:string product_name:string category:string brand:string list_price:decimal(14,4) "
        "cost_price:decimal(14,4) is_active:boolean launch_date:date"
    ),
    "int_orders_enriched": _columns(
        "order_id:string customer_id:string product_id:string order_date:date status:string quantity:int "
        "unit_price:decimal(14,4) discount_pct:decimal(9,6) channel:string promo_code:string "
        "revenue:decimal(18,2) gross_revenue:decimal(18,2) discount_amount:decimal(18,2) cost:decimal(18,2) "
        "gross_profit:decimal(18,2) product_name:string category:string brand:string"
    ),
    "dim_customers": _columns(
        "customer_id:string full_name:string first_name:string last_name:string email:string "
        "country_code:string registration_date:date tier:string is_marketing_opted_in:boolean "
        "days_since_signup:int is_new_customer:boolean"
    ),
    "dim_products": _columns(
        "product_id:string product_name:string category:string brand:string list_price:decimal(14,4) "
        "cost_price:decimal(14,4) is_active:boolean launch_date:date gross_margin:decimal(18,2) "
        "margin_pct:decimal(18,2)"
    ),
    "fct_orders": _columns(
        "order_id:string customer_id:string product_id:string order_date:date status:string quantity:int "
        "unit_price:decimal(14,4) discount_pct:decimal(9,6) channel:string promo_code:string "
        "revenue:decimal(18,2) gross_revenue:decimal(18,2) discount_amount:decimal(18,2) cost:decimal(18,2) "
        "gross_profit:decimal(18,2) customer_tier:string product_name:string category:string brand:string "
        "loaded_at:timestamp"
    ),
}

O2C = {
    "stg_customers": _columns(
        "customer_id:string company_name:string industry:string contact_name:string email:string phone:string "
        "billing_address:string city:string state:string country:string payment_terms:string "
        "credit_limit:decimal(12,2) status:string created_date:date"
    ),
    "stg_products": _columns(
        "product_id:string product_name:string category:string sku:string unit_price:decimal(12,2) "
        "cost_price:decimal(12,2) unit_of_measure:string status:string lead_time_days:int created_date:date"
    ),
    "stg_sales_orders": _columns(
        "order_id:string customer_id:string order_date:date requested_ship_date:date order_status:string "
        "sales_rep:string channel:string currency:string order_discount_pct:decimal(5,2) po_number:string "
        "notes:string"
    ),
    "stg_order_lines": _columns(
        "line_id:string order_id:string product_id:string quantity:decimal(38,0) unit_price:decimal(12,2) "
        "line_discount_pct:decimal(5,2) line_total:decimal(14,2) has_unparseable_quantity:boolean notes:string"
    ),
    "stg_shipments": _columns(
        "shipment_id:string order_id:string ship_date:date carrier:string carrier_raw:string "
        "tracking_number:string ship_to_name:string ship_to_address:string ship_to_city:string "
        "ship_to_state:string ship_to_zip:string status:string weight_lbs:decimal(8,2) notes:string"
    ),
    "stg_invoices": _columns(
        "invoice_id:string order_id:string customer_id:string invoice_date:date due_date:date "
        "invoice_amount:decimal(14,2) tax_amount:decimal(14,2) total_amount:decimal(14,2) payment_terms:string "
        "payment_status:string days_overdue:int notes:string"
    ),
    "stg_payments": _columns(
        "payment_id:string invoice_id:string customer_id:string payment_date:date amount:decimal(14,2) "
        "payment_method:string reference_number:string bank_ref:string notes:string is_duplicate_flag:boolean"
    ),
    "int_order_lines_enriched": _columns(
        "line_id:string order_id:string product_id:string customer_id:string order_date:date "
        "requested_ship_date:date order_status:string sales_rep:string channel:string currency:string "
        "order_discount_pct:decimal(5,2) po_number:string shipment_id:string ship_date:date carrier:string "
        "shipment_status:string tracking_number:string ship_to_city:string ship_to_state:string "
        "ship_to_zip:string weight_lbs:decimal(8,2) quantity:decimal(38,0) unit_price:decimal(12,2) "
        "line_discount_pct:decimal(5,2) line_total:decimal(14,2) has_unparseable_quantity:boolean "
        f"{_LINE_AMOUNTS} is_on_time_delivery:boolean days_to_ship:int"
    ),
    "int_invoices_enriched": _columns(
        "invoice_id:string order_id:string customer_id:string order_date:date sales_rep:string channel:string "
        "currency:string order_status:string po_number:string invoice_date:date due_date:date "
        "invoice_amount:decimal(14,2) tax_amount:decimal(14,2) total_amount:decimal(14,2) payment_terms:string "
        "payment_status:string notes:string amount_paid:decimal(18,2) payment_count:bigint "
        "last_payment_date:date outstanding_amount:decimal(18,2) days_to_due:int days_outstanding:int "
        "is_overdue:boolean"
    ),
    "dim_customers": _columns(
        "customer_id:string company_name:string industry:string contact_name:string email:string phone:string "
        "billing_address:string city:string state:string country:string payment_terms:string "
        "credit_limit:decimal(12,2) status:string created_date:date first_order_date:date "
        "days_since_first_order:int"
    ),
    "dim_products": _columns(
        "product_id:string product_name:string category:string sku:string unit_price:decimal(12,2) "
        "cost_price:decimal(12,2) unit_of_measure:string status:string lead_time_days:int created_date:date "
        "gross_margin_pct:decimal(18,2)"
    ),
    "fct_order_lines": _columns(
        "line_id:string order_id:string product_id:string customer_id:string shipment_id:string "
        "order_date:date requested_ship_date:date ship_date:date order_status:string sales_rep:string "
        "channel:string currency:string po_number:string company_name:string industry:string "
        "customer_city:string customer_state:string customer_country:string region:string product_name:string "
        "category:string sku:string unit_of_measure:string gross_margin_pct:decimal(18,2) carrier:string "
        "shipment_status:string ship_to_city:string ship_to_state:string quantity:decimal(38,0) "
        f"unit_price:decimal(12,2) line_discount_pct:decimal(5,2) {_LINE_AMOUNTS} "
        "is_on_time_delivery:boolean days_to_ship:int has_unparseable_quantity:boolean"
    ),
    "fct_invoices": _columns(
        "invoice_id:string order_id:string customer_id:string company_name:string industry:string "
        "customer_state:string customer_country:string order_date:date sales_rep:string channel:string "
        "currency:string order_status:string po_number:string invoice_date:date due_date:date "
        "payment_terms:string invoice_status:string tax_amount:decimal(14,2) total_amount:decimal(14,2) "
        "last_payment_date:date payment_count:bigint invoice_amount:decimal(14,2) amount_paid:decimal(18,2) "
        "outstanding_amount:decimal(18,2) days_to_due:int days_outstanding:int is_overdue:boolean"
    ),
}
O2C["orders_with_lines"] = O2C["stg_sales_orders"] | _columns(
    f"line_count:bigint product_count:bigint {_LINE_AMOUNTS}"
)
O2C["orders_with_shipments"] = O2C["stg_sales_orders"] | _columns(
    "shipment_id:string ship_date:date carrier:string shipment_status:string is_on_time_delivery:boolean "
    "days_to_ship:int"
)
O2C["invoice_aging"] = O2C["fct_invoices"] | _columns("days_past_due:int aging_bucket:string")
