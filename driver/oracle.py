"""SQL for the checking engine, written apart from the Spark plans.

``MODELS`` holds one SELECT per dataset over the datasets before it; ``with_models`` puts the ones a
query needs in front of it. ``flat`` gives dates as text and decimals as doubles, as the Spark side
does, so that values compare alike in both engines.
"""

from __future__ import annotations

import re

from driver.inputs import O2C, RETAIL, plain

AS_OF = "DATE '2001-12-31'"
LOADED_AT = "TIMESTAMP '2002-01-01 00:00:00'"


# --- fixed values, stated here on their own: a wrong one in the library shows ------------------------------
STAGED_STATUS = {"COMP": "COMPLETED"}
ORDER_STATUS = {
    "COMP": "Completed", "COMPLETED": "Completed", "PENDING": "Pending", "CANCELLED": "Cancelled", "REFUND": "Refunded",
    "REFUNDED": "Refunded",
}
SALES_CHANNEL = {"WEB": "Web", "MOBILE": "Mobile", "MOBILE APP": "Mobile"}
COUNTRY = {"USA": "US", "UNITED STATES": "US"}
PAYMENT_METHOD = {"WIRE TRANSFER": "WIRE_TRANSFER", "WIRE": "WIRE_TRANSFER"}
REGIONS = {
    "Northeast": ("CT", "ME", "MA", "NH", "NJ", "NY", "PA", "RI", "VT"),
    "Southeast": ("AL", "AR", "DE", "DC", "FL", "GA", "KY", "LA", "MD", "MS", "NC", "OK", "SC", "TN", "TX", "VA", "WV"),
    "Midwest": ("IL", "IN", "IA", "KS", "MI", "MN", "MO", "NE", "ND", "OH", "SD", "WI"),
    "West": ("AK", "AZ", "CA", "CO", "HI", "ID", "MT", "NV", "NM", "OR", "UT", "WA", "WY"),
}
NEW_CUSTOMER_DAYS = 90
NUMBER_WORDS = {"ONE": 1, "TWO": 2, "THREE": 3, "FOUR": 4, "FIVE": 5}
TITLE_DELIMITERS = '!?@"^#$&~_,.:;+-*%/|\\[](){}<>'


# --- pieces ---------------------------------------------------------------------------------------
def code(x: str) -> str:
    return f"upper(trim({x}))"


def blank(x: str) -> str:
    return f"nullif(trim({x}), '')"


def quote(value) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def recode(x: str, values: dict[str, str], default: str) -> str:
    arms = " ".join(f"WHEN {code(x)} = {quote(k)} THEN {quote(v)}" for k, v in values.items())
    return f"CASE {arms} ELSE {default} END"


def either_date(x: str) -> str:
    return f"CAST(coalesce(try_strptime({x}, '%Y-%m-%d'), try_strptime({x}, '%m/%d/%Y')) AS DATE)"


def dec(x: str, width: int, scale: int) -> str:
    return f"TRY_CAST({x} AS DECIMAL({width},{scale}))"


def titled(x: str) -> str:
    marks = "".join("\\" + ch for ch in TITLE_DELIMITERS).replace("'", "''")
    pieces = f"regexp_extract_all(lower(trim({x})), '[\\s{marks}]|[^\\s{marks}]+')"
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE array_to_string(list_transform({pieces}, lambda w: upper(w[1]) || w[2:]), '') END"


def capital(x: str) -> str:
    return f"upper(substr(trim({x}), 1, 1)) || lower(substr(trim({x}), 2))"


def words_to_number(x: str) -> str:
    arms = " ".join(f"WHEN {quote(w)} THEN {n}" for w, n in NUMBER_WORDS.items())
    return f"CASE {code(x)} {arms} ELSE {dec(f'trim({x})', 12, 0)} END"


def region(x: str) -> str:
    arms = " ".join(
        f"WHEN list_contains({list(codes)!r}, {x}) THEN '{name}'" for name, codes in REGIONS.items()
    )
    return f"CASE {arms} ELSE 'Other' END"


def carrier(x: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({code(x)}, 'FEDEX FREIGHT( INC)?') THEN 'FedEx Freight' "
        f"WHEN starts_with({code(x)}, 'FEDEX') THEN 'FedEx' "
        f"WHEN list_contains(['UPS', 'USPS'], {code(x)}) THEN {code(x)} ELSE 'Other' END"
    )


def days(start: str, end: str) -> str:
    return f"({end} - {start})"


def amounts(qty: str, price: str, cost: str, share: str) -> str:
    net = f"{qty} * {price} * (1 - {share})"
    return (
        f"round({net}, 2) AS revenue, round({qty} * {price}, 2) AS gross_revenue, "
        f"round({qty} * {price} * {share}, 2) AS discount_amount, round({qty} * {cost}, 2) AS cost, "
        f"round({net} - {qty} * {cost}, 2) AS gross_profit"
    )


def margin(price: str, cost: str) -> str:
    """Exact in integers, so that no engine's decimal division takes part."""
    a = f"CAST(({price} - {cost}) * 10000 AS HUGEINT) * 10000"
    b = f"CAST({price} * 10000 AS HUGEINT)"
    return half_up(a, b)


def half_up(numerator: str, denominator: str, scale: int = 2) -> str:
    """numerator / denominator / 10**scale as a double, rounded half away from zero."""
    n, d = f"({numerator})", f"nullif({denominator}, 0)"
    return f"(CASE WHEN {n} < 0 THEN -1 ELSE 1 END) * ((2 * abs({n}) + {d}) // (2 * {d})) / 1e{scale}"


# --- datasets -------------------------------------------------------------------------------------
MODELS: dict[str, str] = {f"retail_{name}": plain(sql) for name, sql in RETAIL.items()}
MODELS |= {f"o2c_{name}": plain(sql) for name, sql in O2C.items()}

MODELS["retail_stg_orders"] = f"""
    SELECT id AS order_id, cust_id AS customer_id, prod_id AS product_id,
           TRY_CAST(substr(order_dt, 1, 10) AS DATE) AS order_date,
           {recode("stat", STAGED_STATUS, code("stat"))} AS status,
           TRY_CAST(qty AS INTEGER) AS quantity, {dec("disc_pct", 9, 6)} AS discount_pct,
           {code("channel")} AS channel, promo_cd AS promo_code
    FROM retail_raw_orders WHERE id IS NOT NULL"""
MODELS["retail_stg_customers"] = f"""
    SELECT id AS customer_id, {capital("first_nm")} AS first_name, {capital("last_nm")} AS last_name,
           lower(trim(email_addr)) AS email, {code("cntry_cd")} AS country_code,
           CAST(try_strptime(reg_dt, '%Y-%m-%d') AS DATE) AS registered_date, {code("tier")} AS tier,
           list_contains(['1', 'TRUE'], {code("mrktng_opt_in")}) AS is_marketing_opted_in
    FROM retail_raw_customers WHERE id IS NOT NULL"""
MODELS["retail_stg_products"] = f"""
    SELECT id AS product_id, trim(prod_nm) AS product_name, {code("ctgry")} AS category, {code("brnd")} AS brand,
           {dec("lst_price", 14, 4)} AS list_price, {dec("cst_price", 14, 4)} AS cost_price,
           list_contains(['1', 'TRUE'], {code("is_active")}) AS is_active,
           CAST(try_strptime(launch_dt, '%Y-%m-%d') AS DATE) AS launch_date
    FROM retail_raw_products WHERE id IS NOT NULL"""
MODELS["retail_int_orders_enriched"] = f"""
    SELECT o.order_id, o.customer_id, product_id, o.order_date,
           {recode("o.status", ORDER_STATUS, "'Unknown'")} AS status, o.quantity,
           p.list_price AS unit_price, ifnull(o.discount_pct, 0) AS discount_pct,
           {recode("o.channel", SALES_CHANNEL, "'Other'")} AS channel, o.promo_code,
           {amounts("o.quantity", "p.list_price", "p.cost_price", "CAST(ifnull(o.discount_pct, 0) AS DECIMAL(9,6))")},
           p.product_name, p.category, p.brand
    FROM retail_stg_orders o LEFT JOIN retail_stg_products p USING (product_id)"""
MODELS["retail_dim_customers"] = f"""
    SELECT customer_id, first_name || ' ' || last_name AS full_name, first_name, last_name, email, country_code,
           registered_date AS registration_date, tier, is_marketing_opted_in,
           {days("registered_date", AS_OF)} AS days_since_signup,
           ifnull({days("registered_date", AS_OF)} <= {NEW_CUSTOMER_DAYS}, false) AS is_new_customer
    FROM retail_stg_customers"""
MODELS["retail_dim_products"] = f"""
    SELECT *, round(list_price - cost_price, 2) AS gross_margin, {margin("list_price", "cost_price")} AS margin_pct
    FROM retail_stg_products"""
MODELS["retail_fct_orders"] = f"""
    SELECT e.* EXCLUDE (product_name, category, brand), c.tier AS customer_tier, e.product_name, e.category, e.brand,
           {LOADED_AT} AS loaded_at
    FROM retail_int_orders_enriched e LEFT JOIN retail_dim_customers c USING (customer_id)"""

MODELS["o2c_stg_customers"] = f"""
    SELECT customer_id, {titled("company_name")} AS company_name, {titled("industry")} AS industry,
           {titled("contact_name")} AS contact_name, lower(trim(email)) AS email, {blank("phone")} AS phone,
           trim(billing_address) AS billing_address, {titled("city")} AS city, {code("state")} AS state,
           {recode("country", COUNTRY, code("country"))} AS country, {code("payment_terms")} AS payment_terms,
           {dec("credit_limit", 12, 2)} AS credit_limit, {code("status")} AS status,
           {either_date("created_date")} AS created_date
    FROM o2c_raw_customers"""
MODELS["o2c_stg_products"] = f"""
    SELECT product_id, {titled("product_name")} AS product_name, {titled("category")} AS category,
           {code("sku")} AS sku, {dec("unit_price", 12, 2)} AS unit_price, {dec("cost_price", 12, 2)} AS cost_price,
           {code("unit_of_measure")} AS unit_of_measure, {code("status")} AS status,
           TRY_CAST(lead_time_days AS INTEGER) AS lead_time_days, TRY_CAST(created_date AS DATE) AS created_date
    FROM o2c_raw_products"""
MODELS["o2c_stg_sales_orders"] = f"""
    SELECT order_id, customer_id, {either_date("order_date")} AS order_date,
           {either_date("requested_ship_date")} AS requested_ship_date,
           replace({code("order_status")}, 'ON HOLD', 'ON_HOLD') AS order_status, trim(sales_rep) AS sales_rep,
           {titled("channel")} AS channel, {code("currency")} AS currency,
           ifnull({dec("discount_pct", 5, 2)}, 0) AS order_discount_pct,
           {blank("po_number")} AS po_number, {blank("notes")} AS notes
    FROM o2c_raw_sales_orders"""
_PCT = "CAST(line_discount_pct * 0.01 AS DECIMAL(7,4))"
MODELS["o2c_stg_order_lines"] = f"""
    WITH typed AS (
        SELECT line_id, order_id, product_id, {words_to_number("quantity")} AS quantity,
               {dec("unit_price", 12, 2)} AS unit_price,
               CAST(ifnull({dec("line_discount_pct", 5, 2)}, 0) AS DECIMAL(5,2)) AS line_discount_pct,
               {dec("line_total", 14, 2)} AS stated, {blank("notes")} AS notes
        FROM o2c_raw_order_lines)
    SELECT line_id, order_id, product_id, CAST(quantity AS DECIMAL(12,0)) AS quantity, unit_price, line_discount_pct,
           ifnull(stated, round(CAST(quantity AS DECIMAL(12,0)) * unit_price * (1 - {_PCT}), 2)) AS line_total,
           quantity IS NULL AS has_unparseable_quantity, notes
    FROM typed"""
MODELS["o2c_stg_shipments"] = f"""
    SELECT shipment_id, order_id, TRY_CAST(ship_date AS DATE) AS ship_date, {carrier("carrier")} AS carrier,
           trim(carrier) AS carrier_raw, {blank("tracking_number")} AS tracking_number,
           {titled("ship_to_name")} AS ship_to_name, trim(ship_to_address) AS ship_to_address,
           {titled("ship_to_city")} AS ship_to_city, {code("ship_to_state")} AS ship_to_state,
           trim(ship_to_zip) AS ship_to_zip, {code("status")} AS status,
           nullif({dec("weight_lbs", 8, 2)}, 0) AS weight_lbs, {blank("notes")} AS notes
    FROM o2c_raw_shipments"""
MODELS["o2c_stg_invoices"] = f"""
    SELECT invoice_id, order_id, customer_id, {either_date("invoice_date")} AS invoice_date,
           {either_date("due_date")} AS due_date, {dec("invoice_amount", 14, 2)} AS invoice_amount,
           {dec("tax_amount", 14, 2)} AS tax_amount, {dec("total_amount", 14, 2)} AS total_amount,
           {code("payment_terms")} AS payment_terms, {code("payment_status")} AS payment_status,
           ifnull(TRY_CAST(days_overdue AS INTEGER), 0) AS days_overdue, {blank("notes")} AS notes
    FROM o2c_raw_invoices"""
MODELS["o2c_stg_payments"] = f"""
    WITH typed AS (
        SELECT payment_id, invoice_id, customer_id, {either_date("payment_date")} AS payment_date,
               {dec("amount", 14, 2)} AS amount,
               {recode("payment_method", PAYMENT_METHOD, f"nullif({code('payment_method')}, '')")}
                   AS payment_method,
               {blank("reference_number")} AS reference_number, {blank("bank_ref")} AS bank_ref,
               {blank("notes")} AS notes,
               ifnull(contains(upper(notes), 'DUPLICATE'), false) AS is_duplicate_flag
        FROM o2c_raw_payments),
    lowest AS (SELECT min(payment_id) AS payment_id FROM typed GROUP BY invoice_id, amount)
    SELECT t.* FROM typed t SEMI JOIN lowest USING (payment_id)"""
MODELS["o2c_payment_totals"] = """
    SELECT invoice_id, sum(amount) AS amount_paid, count(*) AS payment_count, max(payment_date) AS last_payment_date
    FROM o2c_stg_payments GROUP BY ALL"""
MODELS["o2c_payment_totals_unflagged"] = """
    SELECT invoice_id, sum(amount) AS amount_paid, count(*) AS payment_count, max(payment_date) AS last_payment_date
    FROM o2c_stg_payments WHERE NOT is_duplicate_flag GROUP BY ALL"""
MODELS["o2c_first_orders"] = """
    SELECT customer_id, min(order_date) AS first_order_date FROM o2c_stg_sales_orders GROUP BY ALL"""
MODELS["o2c_int_order_lines_enriched"] = f"""
    WITH wide AS (
        SELECT l.* EXCLUDE (notes), so.* EXCLUDE (order_id, notes), p.cost_price,
               s.shipment_id, s.ship_date, s.carrier, s.status AS shipment_status, s.tracking_number,
               s.ship_to_city, s.ship_to_state, s.ship_to_zip, s.weight_lbs
        FROM o2c_stg_order_lines l
        LEFT JOIN o2c_stg_sales_orders so USING (order_id)
        LEFT JOIN o2c_stg_shipments s USING (order_id)
        LEFT JOIN o2c_stg_products p USING (product_id))
    SELECT * EXCLUDE (cost_price), {amounts("quantity", "unit_price", "cost_price", _PCT)},
           ifnull(ship_date <= requested_ship_date, false) AS is_on_time_delivery,
           {days("order_date", "ship_date")} AS days_to_ship
    FROM wide"""


def _invoices(totals: str) -> str:
    return f"""
    SELECT i.* EXCLUDE (days_overdue), so.order_date, so.sales_rep, so.channel, so.currency, so.order_status,
           so.po_number, ifnull(t.amount_paid, 0) AS amount_paid, ifnull(t.payment_count, 0) AS payment_count,
           t.last_payment_date, i.invoice_amount - ifnull(t.amount_paid, 0) AS outstanding_amount,
           {days("i.invoice_date", "i.due_date")} AS days_to_due,
           CASE WHEN i.payment_status <> 'PAID' THEN {days("i.invoice_date", AS_OF)} END AS days_outstanding,
           ifnull(i.due_date < {AS_OF} AND i.payment_status <> 'PAID', false) AS is_overdue
    FROM o2c_stg_invoices i LEFT JOIN o2c_stg_sales_orders so USING (order_id)
    LEFT JOIN {totals} t USING (invoice_id)"""


MODELS["o2c_int_invoices_enriched"] = _invoices("o2c_payment_totals")
MODELS["o2c_int_invoices_unflagged"] = _invoices("o2c_payment_totals_unflagged")
MODELS["o2c_dim_customers"] = f"""
    SELECT c.*, f.first_order_date, {days("f.first_order_date", AS_OF)} AS days_since_first_order
    FROM o2c_stg_customers c LEFT JOIN o2c_first_orders f USING (customer_id)"""
MODELS["o2c_dim_products"] = f"""
    SELECT *, {margin("unit_price", "cost_price")} AS gross_margin_pct FROM o2c_stg_products"""
MODELS["o2c_fct_order_lines"] = f"""
    SELECT l.* EXCLUDE (order_discount_pct, tracking_number, ship_to_zip, weight_lbs, line_total),
           c.company_name, c.industry, c.city AS customer_city, c.state AS customer_state,
           c.country AS customer_country, {region("c.state")} AS region,
           p.product_name, p.category, p.sku, p.unit_of_measure, p.gross_margin_pct
    FROM o2c_int_order_lines_enriched l LEFT JOIN o2c_dim_customers c USING (customer_id)
    LEFT JOIN o2c_dim_products p USING (product_id)"""
MODELS["o2c_fct_invoices"] = """
    SELECT i.* EXCLUDE (payment_status, notes), i.payment_status AS invoice_status, c.company_name, c.industry,
           c.state AS customer_state, c.country AS customer_country
    FROM o2c_int_invoices_enriched i LEFT JOIN o2c_dim_customers c USING (customer_id)"""
MODELS["o2c_order_rollup"] = """
    SELECT order_id, count(*) AS line_count, count(DISTINCT product_id) AS product_count,
           sum(gross_revenue) AS gross_revenue, sum(discount_amount) AS discount_amount, sum(revenue) AS revenue,
           sum(cost) AS cost, sum(gross_profit) AS gross_profit
    FROM o2c_int_order_lines_enriched GROUP BY ALL"""
MODELS["o2c_orders_with_lines"] = """
    SELECT so.*, r.* EXCLUDE (order_id, line_count, product_count), ifnull(r.line_count, 0) AS line_count,
           ifnull(r.product_count, 0) AS product_count
    FROM o2c_stg_sales_orders so LEFT JOIN o2c_order_rollup r USING (order_id)"""
MODELS["o2c_orders_with_shipments"] = f"""
    SELECT so.*, s.shipment_id, s.ship_date, s.carrier, s.status AS shipment_status,
           ifnull(s.ship_date <= so.requested_ship_date, false) AS is_on_time_delivery,
           {days("so.order_date", "s.ship_date")} AS days_to_ship
    FROM o2c_stg_sales_orders so LEFT JOIN o2c_stg_shipments s USING (order_id)"""
_LATE = days("due_date", AS_OF)
MODELS["o2c_invoice_aging"] = f"""
    SELECT *, {_LATE} AS days_past_due,
           CASE WHEN due_date IS NULL THEN 'No due date' WHEN {_LATE} > 60 THEN '60+ days overdue'
                WHEN {_LATE} > 30 THEN '31-60 days overdue' WHEN {_LATE} > 0 THEN '1-30 days overdue'
                ELSE 'Current' END AS aging_bucket
    FROM o2c_fct_invoices WHERE invoice_status <> 'PAID'"""

# --- queries ----------------------------------------------------------------------------------------
def with_models(query: str, models: dict[str, str] = MODELS) -> str:
    """``query`` with the datasets it names, and those they name, as leading CTEs."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in re.findall(r"\b(?:retail|o2c)_\w+", sql):
            if name in models and name not in needed:
                visit(models[name])
                if name not in needed:
                    needed.append(name)

    visit(query)
    ctes = ",\n".join(f"{name} AS ({models[name]})" for name in needed)
    return f"WITH {ctes}\n{query}" if needed else query


def shown(columns: dict[str, str], prefix: str = "") -> str:
    """Columns of the given types as the Spark side shows them."""
    plain_types = {"decimal": "DOUBLE", "date": "VARCHAR", "timestamp": "VARCHAR", "int": "BIGINT"}
    texts = []
    for name, kind in columns.items():
        target = plain_types.get(kind.split("(")[0])
        texts.append(f"CAST({prefix}{name} AS {target}) AS {name}" if target else prefix + name)
    return ", ".join(texts)


def flat(model: str, columns: dict[str, str]) -> str:
    """All rows of a dataset."""
    return with_models(f"SELECT {shown(columns)} FROM {model}")


# --- quarantine ------------------------------------------------------------------------------------
def _iso(x: str) -> str:
    return f"CAST(try_strptime({x}, '%Y-%m-%d') AS DATE)"


_BOOLEAN = "CASE WHEN list_contains(['1', 'TRUE', '0', 'FALSE'], upper(trim({0}))) THEN true END"
#: Of each staged table its raw table and, by output, the raw column and what reading it gives.
READ = {
    "retail_orders": ("retail_raw_orders", {
        "order_date": ("order_dt", "TRY_CAST(substr(order_dt, 1, 10) AS DATE)"), "quantity": ("qty", "TRY_CAST(qty AS INTEGER)"),
        "discount_pct": ("disc_pct", dec("disc_pct", 9, 6)),
    }),
    "retail_customers": ("retail_raw_customers", {
        "registered_date": ("reg_dt", _iso("reg_dt")), "is_marketing_opted_in": ("mrktng_opt_in", _BOOLEAN.format("mrktng_opt_in")),
    }),
    "retail_products": ("retail_raw_products", {
        "list_price": ("lst_price", dec("lst_price", 14, 4)), "cost_price": ("cst_price", dec("cst_price", 14, 4)),
        "is_active": ("is_active", _BOOLEAN.format("is_active")), "launch_date": ("launch_dt", _iso("launch_dt")),
    }),
    "o2c_customers": ("o2c_raw_customers", {
        "credit_limit": ("credit_limit", dec("credit_limit", 12, 2)), "created_date": ("created_date", either_date("created_date")),
    }),
    "o2c_products": ("o2c_raw_products", {
        "unit_price": ("unit_price", dec("unit_price", 12, 2)), "cost_price": ("cost_price", dec("cost_price", 12, 2)),
        "lead_time_days": ("lead_time_days", "TRY_CAST(lead_time_days AS INTEGER)"), "created_date": ("created_date", _iso("created_date")),
    }),
    "o2c_orders": ("o2c_raw_sales_orders", {
        "order_date": ("order_date", either_date("order_date")),
        "requested_ship_date": ("requested_ship_date", either_date("requested_ship_date")),
        "order_discount_pct": ("discount_pct", dec("discount_pct", 5, 2)),
    }),
    "o2c_order_lines": ("o2c_raw_order_lines", {
        "quantity": ("quantity", words_to_number("quantity")), "unit_price": ("unit_price", dec("unit_price", 12, 2)),
        "line_discount_pct": ("line_discount_pct", dec("line_discount_pct", 5, 2)), "line_total": ("line_total", dec("line_total", 14, 2)),
    }),
    "o2c_shipments": ("o2c_raw_shipments", {
        "ship_date": ("ship_date", _iso("ship_date")), "weight_lbs": ("weight_lbs", dec("weight_lbs", 8, 2)),
    }),
    "o2c_invoices": ("o2c_raw_invoices", {
        "invoice_date": ("invoice_date", either_date("invoice_date")), "due_date": ("due_date", either_date("due_date")),
        "invoice_amount": ("invoice_amount", dec("invoice_amount", 14, 2)), "tax_amount": ("tax_amount", dec("tax_amount", 14, 2)),
        "total_amount": ("total_amount", dec("total_amount", 14, 2)), "days_overdue": ("days_overdue", "TRY_CAST(days_overdue AS INTEGER)"),
    }),
    "o2c_payments": ("o2c_raw_payments", {
        "payment_date": ("payment_date", either_date("payment_date")), "amount": ("amount", dec("amount", 14, 2)),
    }),
}


def rejected(name: str, key: str) -> str:
    """Rows with text that cannot be read, and the outputs it was for."""
    raw, read = READ[name]
    arms = ", ".join(
        f"CASE WHEN trim({column}) <> '' AND ({value}) IS NULL THEN {quote(output)} END"
        for output, (column, value) in sorted(read.items())
    )
    kept = f"WHERE {key} IS NOT NULL" if name.startswith("retail") else ""
    return with_models(f"""
        SELECT {key}, rejected FROM (SELECT {key}, concat_ws(',', {arms}) AS rejected FROM {raw} {kept}) AS named
        WHERE rejected <> ''""")


# --- checks ---------------------------------------------------------------------------------------
def check_rows(model: str, check, parents: dict[str, str]) -> str:
    """One report row for a check."""
    scope = f"({check.scope})" if check.scope else "true"
    c = check.column
    if check.kind == "unique":
        count = (
            f"(SELECT count(*) FROM (SELECT {c} FROM {model} WHERE {scope} AND {c} IS NOT NULL "
            f"GROUP BY {c} HAVING count(*) > 1) AS twice)"
        )
    elif check.kind == "relationships":
        parent, column = check.args
        count = (
            f"(SELECT count(*) FROM {model} WHERE {scope} AND {c} IS NOT NULL AND {c} NOT IN "
            f"(SELECT {column} FROM {parents[parent]} WHERE {column} IS NOT NULL))"
        )
    else:
        if check.kind == "not_null":
            broken = f"{c} IS NULL"
        elif check.kind == "accepted":
            broken = f"NOT list_contains({list(check.args)!r}, {c})"
        elif check.kind == "matches":
            broken = f"NOT regexp_matches({c}, {quote(check.args[0])})"
        else:
            low, high = check.args
            sides = [f"{c} {op} {_literal(v)}" for op, v in (("<", low), (">", high)) if v is not None]
            broken = " OR ".join(sides)
        count = f"(SELECT count(*) FROM {model} WHERE {scope} AND ({broken}))"
    return (
        f"SELECT {quote(check.name)} AS \"check\", {quote(c)} AS \"column\", {count} AS failures, "
        f"{count} = 0 AS passed"
    )


def _literal(value) -> str:
    return f"DATE {quote(value)}" if hasattr(value, "isoformat") else str(value)


def check_report(model: str, checks, parents: dict[str, str]) -> str:
    return with_models("\nUNION ALL\n".join(check_rows(model, c, parents) for c in checks))
