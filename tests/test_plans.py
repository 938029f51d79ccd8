"""Small raw inputs with the usual dirt, and what must come out of them."""

import datetime as dt
import re
from decimal import Decimal as D

import pytest
from comparing import tuples

from orderloom.plans import o2c, receivables, retail
from orderloom.sources import schemas
from orderloom.sources.readers import read_raw

AS_OF = dt.date(2024, 6, 1)
DAY = dt.date


@pytest.fixture
def raw(spark, folder):
    """A raw frame from CSV text, through the reader."""

    def make(family, name, text):
        path = f"{folder}/{name}.csv"
        with open(path, "w", newline="") as out:
            out.write("\r\n".join(line.strip() for line in text.strip().splitlines()) + "\r\n")
        return read_raw(spark, path, family[name])

    return make


def by_key(df, key, *columns):
    return {r[key]: tuple(r[c] for c in columns) for r in df.select(key, *columns).collect()}


# --- retail ------------------------------------------------------------------------------------------
@pytest.fixture
def shop(raw):
    orders = raw(schemas.RETAIL_RAW, "raw_orders", """
        id,cust_id,prod_id,order_dt,stat,qty,disc_pct,channel,promo_cd
        R1,K1,G1,2024-01-05 10:15:00,comp,2,0.1,web,NEW
        R2,K2,G2,2024-01-06 00:00:00,COMPLETED,1,0.15, Mobile App,
        R3,K1,G3,2024-01-07 09:00:00,Refund,,,kiosk,
        R4,K9,G9,2024-01-08 09:00:00,lost,3,,MOBILE,
        ,K1,G1,2024-01-08 09:00:00,comp,1,,web,""")
    customers = raw(schemas.RETAIL_RAW, "raw_customers", """
        id,first_nm,last_nm,email_addr,cntry_cd,reg_dt,tier,mrktng_opt_in
        K1,ana,Ben-AMI, Ana@Mail.COM ,in,2024-05-01,Silver,1
        K2,TOM,O'Hara,tom@mail.com,us,15/02/2023,gold,FALSE
        K3,li,,li@mail.com,us,2020-01-01,GOLD,maybe""")
    products = raw(schemas.RETAIL_RAW, "raw_products", """
        id,prod_nm,ctgry,brnd,lst_price,cst_price,is_active,launch_dt
        G1, Tee ,apparel,acme,69.99,22,1,2020-01-01
        G2,Boot,Footwear,Acme,129.99,48,0,2020-01-01
        G3,Cap,APPAREL,acme,0,1.5,1,2020-01-01
        G4,Bag,ACCESSORIES,acme,,9,1,2020-01-01""")
    return orders, customers, products


def test_retail_staging(shop):
    orders, customers, products = shop
    staged = by_key(retail.stg_orders(orders), "order_id", "order_date", "status", "quantity", "discount_pct", "channel", "promo_code")
    assert staged == {
        "R1": (DAY(2024, 1, 5), "COMPLETED", 2, D("0.1"), "WEB", "NEW"),
        "R2": (DAY(2024, 1, 6), "COMPLETED", 1, D("0.15"), "MOBILE APP", None),
        "R3": (DAY(2024, 1, 7), "REFUND", None, None, "KIOSK", None),
        "R4": (DAY(2024, 1, 8), "LOST", 3, None, "MOBILE", None),
    }
    people = by_key(retail.stg_customers(customers), "customer_id", "first_name", "last_name", "email", "tier", "registered_date", "is_marketing_opted_in")
    assert people["K1"] == ("Ana", "Ben-ami", "ana@mail.com", "SILVER", DAY(2024, 5, 1), True)
    assert people["K2"] == ("Tom", "O'hara", "tom@mail.com", "GOLD", None, False)
    assert people["K3"][-1] is None
    assert by_key(retail.stg_products(products), "product_id", "product_name", "category")["G1"] == ("Tee", "APPAREL")


def test_unreadable_values_are_quarantined_or_fail(shop):
    _, customers, _ = shop
    rejected = by_key(retail.customers_staging().rejected(customers), "id", "rejected_columns")
    assert rejected == {"K2": (["registered_date"],), "K3": (["is_marketing_opted_in"],)}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        retail.stg_customers(customers, mode="strict").collect()


def test_retail_marts(shop):
    orders, customers, products = map(lambda f, df: f(df), (retail.stg_orders, retail.stg_customers, retail.stg_products), shop)
    enriched = retail.int_orders_enriched(orders, products)
    money = by_key(enriched, "order_id", "status", "channel", "revenue", "gross_revenue", "discount_amount", "cost", "gross_profit")
    assert money == {
        "R1": ("Completed", "Web", D("125.98"), D("139.98"), D("14.00"), D("44.00"), D("81.98")),
        "R2": ("Completed", "Mobile", D("110.49"), D("129.99"), D("19.50"), D("48.00"), D("62.49")),
        "R3": ("Refunded", "Other", None, None, None, None, None),
        "R4": ("Unknown", "Mobile", None, None, None, None, None),
    }
    people = retail.dim_customers(customers, AS_OF)
    assert by_key(people, "customer_id", "full_name", "days_since_signup", "is_new_customer") == {
        "K1": ("Ana Ben-ami", 31, True), "K2": ("Tom O'hara", None, False), "K3": (None, 1613, False),
    }
    goods = by_key(retail.dim_products(products), "product_id", "gross_margin", "margin_pct")
    assert goods == {
        "G1": (D("47.99"), D("68.57")), "G2": (D("81.99"), D("63.07")), "G3": (D("-1.50"), None), "G4": (None, None),
    }
    facts = by_key(retail.fct_orders(enriched, people, dt.datetime(2024, 6, 2)), "order_id", "customer_tier", "loaded_at")
    assert facts["R1"] == ("SILVER", dt.datetime(2024, 6, 2)) and facts["R4"][0] is None


@pytest.mark.parametrize("period", ["day", "month", "year"])
def test_incremental_fact(shop, spark, folder, period):
    orders, customers, products = map(lambda f, df: f(df), (retail.stg_orders, retail.stg_customers, retail.stg_products), shop)
    enriched, people = retail.int_orders_enriched(orders, products), retail.dim_customers(customers, AS_OF)
    path = f"{folder}/fact"
    load = lambda df, **o: retail.load_fct_orders(df, people, path, period=period, loaded_at=dt.datetime(2024, 6, 2), **o)
    ids = lambda df: sorted(r.order_id for r in df.collect())
    assert ids(load(enriched.filter("order_id in ('R1', 'R2')"))) == ["R1", "R2"]
    assert ids(load(enriched)) == ["R1", "R2", "R3", "R4"]
    late = enriched.filter("order_id = 'R1'").selectExpr("'R5' as order_id", "* except (order_id)").select(*enriched.columns)
    assert ids(load(late)) == ["R1", "R2", "R3", "R4"]  # below the mark: not seen
    assert ids(load(late, lookback_days=10)) == ["R1", "R2", "R3", "R4", "R5"]
    assert ids(load(enriched, full_refresh=True)) == ["R1", "R2", "R3", "R4"]
    assert retail.loaded_until(spark, path) == DAY(2024, 1, 8)


def test_customer_history(shop, folder, spark):
    _, customers, _ = shop
    staged = retail.stg_customers(customers)
    retail.snapshot_customers(staged, f"{folder}/h", dt.datetime(2024, 1, 1))
    moved = staged.selectExpr("* except (tier, email)", "'PLATINUM' as tier", "'x' as email").select(*staged.columns)
    history = retail.snapshot_customers(moved.filter("customer_id = 'K1'"), f"{folder}/h", dt.datetime(2024, 2, 1))
    assert tuples(history.select("customer_id", "tier", "valid_to")) == [
        ("K1", "PLATINUM", None), ("K1", "SILVER", dt.datetime(2024, 2, 1)), ("K2", "GOLD", None), ("K3", "GOLD", None),
    ]


# --- order-to-cash ------------------------------------------------------------------------------------
@pytest.fixture
def trade(raw):
    class Trade:
        orders = o2c.stg_sales_orders(raw(schemas.O2C_RAW, "raw_sales_orders", """
            order_id,customer_id,order_date,requested_ship_date,order_status,sales_rep,channel,currency,discount_pct,po_number,notes
            S1,B1,2024-01-10,01/20/2024,confirmed, Kim ,direct,usd,5,PO1,
            S2,B2,01/12/2024,,on hold,,partner-web,USD,,, 
            S3,B1,2024-02-01,2024-02-10,Shipped,Kim,DIRECT,usd,0,PO3,ok"""))
        lines = o2c.stg_order_lines(raw(schemas.O2C_RAW, "raw_order_lines", """
            line_id,order_id,product_id,quantity,unit_price,line_discount_pct,line_total,notes
            L1,S1,A1,two,7500.00,10,,
            L2,S1,A2,40,,,7000.00, hours 
            L3,S2,A1,three,7500,0,,
            L4,S3,A1,abc,10,5,,
            L5,S9,A9,1,10.005,,99,"""))
        shipments = o2c.stg_shipments(raw(schemas.O2C_RAW, "raw_shipments", """
            shipment_id,order_id,ship_date,carrier,tracking_number,ship_to_name,ship_to_address,ship_to_city,ship_to_state,ship_to_zip,status,weight_lbs,notes
            H1,S1,2024-01-21,fedex,,dock-a, 1 Pier ,salem,ma,02109,delivered,0,
            H2,S3,2024-02-10,FEDEX FREIGHT,T2,dock-b,2 Pier,salem,ma,02109,In Transit,12.5,"""))
        products = o2c.stg_products(raw(schemas.O2C_RAW, "raw_products", """
            product_id,product_name,category,sku,unit_price,cost_price,unit_of_measure,status,lead_time_days,created_date
            A1,core SWITCH 24-port,hardware,sw-24,7500,2250,each,active,7,2020-01-01
            A2,Advice,services,adv,,175.00,hour,ACTIVE,,2020-01-01"""))
        customers = o2c.stg_customers(raw(schemas.O2C_RAW, "raw_customers", """
            customer_id,company_name,industry,contact_name,email,phone,billing_address,city,state,country,payment_terms,credit_limit,status,created_date
            B1,north SUPPLY llc,retail,al BO,A@B.com, ,1 St,salem,ma,United States,net30,1000,active,03/01/2020
            B2,SOUTH CO,tech,cy,,555,2 St,el paso,tx,usa,NET60,500.50,Inactive,2020-04-01
            B3,EAST CO,tech,di,,555,2 St,x,zz,CA,NET60,,Active,x"""))
        invoices = o2c.stg_invoices(raw(schemas.O2C_RAW, "raw_invoices", """
            invoice_id,order_id,customer_id,invoice_date,due_date,invoice_amount,tax_amount,total_amount,payment_status,payment_terms,days_overdue,notes
            V1,S1,B1,2024-01-22,02/21/2024,12500,0,12500,PAID,net30,,
            V2,S2,B2,01/15/2024,2024-05-20,1000.50,10,1010.50,Partial,NET60,12,
            V3,S3,B1,2024-02-12,2024-06-01,300,0,300,outstanding,net30,,
            V4,S9,B9,2024-02-12,2024-02-20,50,0,50,,net30,,"""))
        payments = o2c.stg_payments(raw(schemas.O2C_RAW, "raw_payments", """
            payment_id,invoice_id,customer_id,payment_date,amount,payment_method,reference_number,bank_ref,notes
            P1,V1,B1,2024-02-20,12500,wire,R1,B1,
            P2,V1,B1,03/07/2024,0,,,, Duplicate entry of P1
            P3,V1,B1,2024-02-21,12500.00,Wire Transfer,R1,B1,DUPLICATE
            P4,V2,B2,2024-02-21,400.25,ach,,,"""))
        lines_enriched = o2c.int_order_lines_enriched(lines, orders, shipments, products)
        invoices_enriched = o2c.int_invoices_enriched(invoices, orders, payments, AS_OF)
        dim_customers = o2c.dim_customers(customers, orders, AS_OF)
        dim_products = o2c.dim_products(products)

    return Trade


def test_o2c_staging(trade):
    assert by_key(trade.orders, "order_id", "order_date", "requested_ship_date", "order_status", "channel", "order_discount_pct", "po_number", "notes") == {
        "S1": (DAY(2024, 1, 10), DAY(2024, 1, 20), "CONFIRMED", "Direct", D("5.00"), "PO1", None),
        "S2": (DAY(2024, 1, 12), None, "ON_HOLD", "Partner-Web", D("0.00"), None, None),
        "S3": (DAY(2024, 2, 1), DAY(2024, 2, 10), "SHIPPED", "Direct", D("0.00"), "PO3", "ok"),
    }
    assert by_key(trade.lines, "line_id", "quantity", "unit_price", "line_total", "has_unparseable_quantity") == {
        "L1": (2, D("7500.00"), D("13500.00"), False),
        "L2": (40, None, D("7000.00"), False),
        "L3": (3, D("7500.00"), D("22500.00"), False),
        "L4": (None, D("10.00"), None, True),
        "L5": (1, D("10.01"), D("99.00"), False),
    }
    assert by_key(trade.shipments, "shipment_id", "carrier", "carrier_raw", "ship_to_zip", "ship_to_state", "status", "weight_lbs") == {
        "H1": ("FedEx", "fedex", "02109", "MA", "DELIVERED", None),
        "H2": ("FedEx Freight", "FEDEX FREIGHT", "02109", "MA", "IN TRANSIT", D("12.50")),
    }
    assert by_key(trade.customers, "customer_id", "company_name", "country", "phone", "status", "created_date") == {
        "B1": ("North Supply Llc", "US", None, "ACTIVE", DAY(2020, 3, 1)),
        "B2": ("South Co", "US", "555", "INACTIVE", DAY(2020, 4, 1)),
        "B3": ("East Co", "CA", "555", "ACTIVE", None),
    }
    assert by_key(trade.products, "product_id", "product_name")["A1"] == ("Core Switch 24-Port",)
    assert by_key(trade.payments, "payment_id", "amount", "payment_method", "payment_date", "is_duplicate_flag") == {
        "P1": (D("12500.00"), "WIRE_TRANSFER", DAY(2024, 2, 20), False),
        "P2": (D("0.00"), None, DAY(2024, 3, 7), True),
        "P4": (D("400.25"), "ACH", DAY(2024, 2, 21), False),
    }


def test_values_with_a_default_are_quarantined_too(frame):
    def raw(name, **values):
        columns = schemas.O2C_RAW[name].names
        return frame(", ".join(f"{c} string" for c in columns), tuple(values.get(c) for c in columns))

    def rejected(staging, df):
        rows = staging.rejected(df).collect()
        return rows[0].rejected_columns if rows else []

    lines = o2c.order_lines_staging()
    assert rejected(lines, raw("raw_order_lines", quantity="abc", line_discount_pct="ten", line_total="-")) == [
        "quantity", "line_discount_pct", "line_total",
    ]
    assert rejected(lines, raw("raw_order_lines", quantity="two", unit_price="1.5", line_total=" ")) == []
    assert rejected(o2c.sales_orders_staging(), raw("raw_sales_orders", discount_pct="x")) == ["order_discount_pct"]
    assert rejected(o2c.shipments_staging(), raw("raw_shipments", weight_lbs="0")) == []
    assert rejected(o2c.shipments_staging(), raw("raw_shipments", weight_lbs="heavy")) == ["weight_lbs"]
    assert rejected(o2c.invoices_staging(), raw("raw_invoices", days_overdue="?", due_date="soon")) == ["due_date", "days_overdue"]


def test_payments_that_cannot_be_read_are_kept_apart(frame):
    columns = schemas.O2C_RAW["raw_payments"].names
    rows = [("P1", "V", "abc"), ("P2", "V", "xyz"), ("P3", "V", "abc"), ("P4", "V", None), ("P5", "V", " "), ("P6", None, None)]
    raw = frame(
        ", ".join(f"{c} string" for c in columns),
        *[tuple({"payment_id": p, "invoice_id": i, "amount": a}.get(c) for c in columns) for p, i, a in rows],
    )
    assert sorted(r.payment_id for r in o2c.stg_payments(raw).collect()) == ["P1", "P2", "P4", "P6"]


def test_enriched_lines(trade):
    assert by_key(trade.lines_enriched, "line_id", "customer_id", "revenue", "cost", "gross_profit", "is_on_time_delivery", "days_to_ship") == {
        "L1": ("B1", D("13500.00"), D("4500.00"), D("9000.00"), False, 11),
        "L2": ("B1", None, D("7000.00"), None, False, 11),
        "L3": ("B2", D("22500.00"), D("6750.00"), D("15750.00"), False, None),
        "L4": ("B1", None, None, None, True, 9),
        "L5": (None, D("10.01"), None, None, False, None),
    }


def test_split_shipments_repeat_lines_unless_refused(trade):
    from orderloom.operators.lookup import NotUniqueError

    twice = trade.shipments.unionByName(trade.shipments.filter("order_id = 'S1'"))
    args = (trade.lines, trade.orders, twice, trade.products)
    assert o2c.int_order_lines_enriched(*args).count() == 7
    with pytest.raises(NotUniqueError):
        o2c.int_order_lines_enriched(*args, unique_shipments=True)
    guarded = o2c.int_order_lines_enriched(*args, unique_shipments="in plan")  # no job yet
    with pytest.raises(Exception, match="is not unique"):
        guarded.collect()


def test_enriched_invoices(trade):
    columns = ("amount_paid", "payment_count", "last_payment_date", "outstanding_amount", "days_to_due", "days_outstanding", "is_overdue")
    assert by_key(trade.invoices_enriched, "invoice_id", *columns) == {
        "V1": (D("12500.00"), 2, DAY(2024, 3, 7), D("0.00"), 30, None, False),
        "V2": (D("400.25"), 1, DAY(2024, 2, 21), D("600.25"), 126, 138, True),
        "V3": (D("0.00"), 0, None, D("300.00"), 110, 110, False),
        "V4": (D("0.00"), 0, None, D("50.00"), 8, None, False),
    }
    clean = o2c.int_invoices_enriched(trade.invoices, trade.orders, trade.payments, AS_OF, exclude_flagged=True)
    assert by_key(clean, "invoice_id", "payment_count")["V1"] == (1,)


def test_o2c_marts(trade):
    assert by_key(trade.dim_customers, "customer_id", "first_order_date", "days_since_first_order") == {
        "B1": (DAY(2024, 1, 10), 143), "B2": (DAY(2024, 1, 12), 141), "B3": (None, None),
    }
    assert by_key(trade.dim_products, "product_id", "gross_margin_pct") == {"A1": (D("70.00"),), "A2": (None,)}
    lines = o2c.fct_order_lines(trade.lines_enriched, trade.dim_customers, trade.dim_products)
    assert by_key(lines, "line_id", "region", "customer_city", "product_name") == {
        "L1": ("Northeast", "Salem", "Core Switch 24-Port"),
        "L2": ("Northeast", "Salem", "Advice"),
        "L3": ("Southeast", "El Paso", "Core Switch 24-Port"),
        "L4": ("Northeast", "Salem", "Core Switch 24-Port"),
        "L5": ("Other", None, None),
    }
    invoices = o2c.fct_invoices(trade.invoices_enriched, trade.dim_customers)
    assert by_key(invoices, "invoice_id", "invoice_status", "customer_state")["V2"] == ("PARTIAL", "TX")


def test_order_grain(trade):
    whole = by_key(o2c.orders_with_lines(trade.orders, trade.lines_enriched), "order_id", "line_count", "product_count", "revenue")
    assert whole == {"S1": (2, 2, D("13500.00")), "S2": (1, 1, D("22500.00")), "S3": (1, 1, None)}
    shipped = o2c.orders_with_shipments(trade.orders, trade.shipments)
    assert by_key(shipped, "order_id", "shipment_status", "is_on_time_delivery", "days_to_ship") == {
        "S1": ("DELIVERED", False, 11), "S2": (None, False, None), "S3": ("IN TRANSIT", True, 9),
    }
    assert tuples(o2c.on_time_rate(shipped)) == [(2, 1, D("0.5000"))]


def test_receivables(trade, frame):
    invoices = o2c.fct_invoices(trade.invoices_enriched, trade.dim_customers)
    assert by_key(receivables.aging_summary(invoices, AS_OF), "aging_bucket", "invoice_count", "total_outstanding") == {
        "Current": (1, D("300.00")), "1-30 days overdue": (1, D("600.25")),
        "31-60 days overdue": (0, D("0.00")), "60+ days overdue": (0, D("0.00")),
    }
    assert by_key(receivables.dso(invoices, ["region"], 90), "region", "total_outstanding", "credit_sales", "dso") == {
        "Northeast": (D("300.00"), D("12800.00"), D("2.11")),
        "Southeast": (D("600.25"), D("1000.50"), D("54.00")),
        "Other": (D("0.00"), D("50.00"), D("0.00")),
    }


def test_raw_files_are_read_by_header_name(spark, folder):
    with open(f"{folder}/a.csv", "w") as out:
        out.write("zip,id,extra\n02109,\"x, \"\"y\"\"\",1\n,z,2\n")
    schema = schemas._text("id zip")
    assert tuples(read_raw(spark, f"{folder}/a.csv", schema)) == [('x, "y"', "02109"), ("z", None)]
    with open(f"{folder}/b.csv", "w") as out:
        out.write("id,zip,extra\nq,1,2\n")
    with pytest.raises(Exception, match="header"):
        read_raw(spark, folder, schema).collect()


def test_invoices_meet_their_payments_while_narrow(trade, spark):
    """The move by invoice carries no order column."""
    before = {k: spark.conf.getAll.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = o2c.int_invoices_enriched(trade.invoices, trade.orders, trade.payments, AS_OF)._jdf.queryExecution().executedPlan().toString()
        joins = re.findall(r"SortMergeJoin \[(\w+)#", plan)  # printed top down
        assert joins[:2] == ["order_id", "invoice_id"]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
