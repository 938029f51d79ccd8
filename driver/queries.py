"""Registered queries: name -> Spark plan, and name -> checking SQL.

Names follow the dataset or operator they exercise. Each runs over whole tables.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driver import inputs, oracle
from driver.datasets import AS_OF, LOADED_AT, O2C, Retail
from orderloom.functions import mapping, metrics, parsing, text
from orderloom.operators import quality
from orderloom.operators.changes import detect_changes
from orderloom.operators.dedupe import dedupe_first
from orderloom.operators.history import scd2_apply
from orderloom.operators.incremental import incremental_filter
from orderloom.operators.lookup import as_of_join, left_lookup, orphans
from orderloom.operators.rollup import first_orders, order_rollup, payment_totals
from orderloom.operators.upsert import upsert
from orderloom.plans import build, checks, o2c, receivables, retail
from orderloom.session import apply_scale_defaults, work_dir
from orderloom.sources import schemas
from orderloom.sources.readers import read_malformed, read_raw
from orderloom.sources.snapshots import put_snapshot, read_versions
from orderloom.sources.tables import range_sort, read_changes, read_history, read_table, upsert_table, write_table
from orderloom.streaming.upserts import stream_upsert

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def flat(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and times as text, whole numbers as bigint: types both engines
    hand over alike."""
    targets = {"decimal": "double", "date": "string", "timestamp": "string", "int": "bigint"}
    columns = []
    for name, kind in df.dtypes:
        target = targets.get(kind.split("(")[0])
        columns.append(F.col(name).cast(target).alias(name) if target else F.col(name))
    return df.select(*columns)


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return flat(query(apply_scale_defaults(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return query

    return add


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared work folder."""
    return f"{work_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# --- every dataset --------------------------------------------------------------------------------
for _name, _columns in schemas.RETAIL.items():
    register(f"retail_{_name}", oracle.flat(f"retail_{_name}", _columns))(
        lambda spark, d, n=_name: getattr(Retail(spark, d), n)
    )
for _name, _columns in schemas.O2C.items():
    if _name == "invoice_aging":
        continue
    register(f"o2c_{_name}", oracle.flat(f"o2c_{_name}", _columns))(
        lambda spark, d, n=_name: getattr(O2C(spark, d), n)
    )


@register("o2c_invoice_aging", oracle.flat("o2c_invoice_aging", schemas.O2C["invoice_aging"]))
def _invoice_aging(spark, d):
    return O2C(spark, d).invoice_aging


@register(
    "o2c_invoices_without_flagged_payments",
    oracle.flat("o2c_int_invoices_unflagged", schemas.O2C["int_invoices_enriched"]),
)
def _unflagged(spark, d):
    c = O2C(spark, d)
    return o2c.int_invoices_enriched(
        c.stg_invoices, c.stg_sales_orders, c.stg_payments, AS_OF, exclude_flagged=True
    )


@register("o2c_fct_order_lines_composed", oracle.flat("o2c_fct_order_lines", schemas.O2C["fct_order_lines"]))
def _composed(spark, d):
    """The fact on top of the enriched lines, as two datasets."""
    c = O2C(spark, d)
    return o2c.fct_order_lines(c.int_order_lines_enriched, c.dim_customers, c.dim_products)


@register("o2c_orders_with_lines_composed", oracle.flat("o2c_orders_with_lines", schemas.O2C["orders_with_lines"]))
def _orders_composed(spark, d):
    """Orders with the totals of the enriched lines."""
    c = O2C(spark, d)
    return o2c.orders_with_lines(c.stg_sales_orders, c.int_order_lines_enriched)


# --- flagship: revenue and delivery by region ------------------------------------------------------
@register(
    "region_performance",
    oracle.with_models("""
        SELECT region, count(*) AS line_count, CAST(sum(gross_revenue) AS DOUBLE) AS gross_revenue,
               CAST(sum(revenue) AS DOUBLE) AS revenue, CAST(sum(gross_profit) AS DOUBLE) AS gross_profit,
               count(*) FILTER (WHERE is_on_time_delivery) AS on_time_lines,
               CAST(sum(days_to_ship) AS BIGINT) AS days_to_ship
        FROM o2c_fct_order_lines GROUP BY region"""),
)
def region_performance(spark, d):
    return O2C(spark, d).fct_order_lines.groupBy("region").agg(
        F.count("*").alias("line_count"),
        F.sum("gross_revenue").alias("gross_revenue"),
        F.sum("revenue").alias("revenue"),
        F.sum("gross_profit").alias("gross_profit"),
        F.count_if("is_on_time_delivery").alias("on_time_lines"),
        F.sum("days_to_ship").alias("days_to_ship"),
    )


# --- column functions ------------------------------------------------------------------------------
@register(
    "clean_status_map",
    f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
               {oracle.recode("raw", mapping.STAGED_STATUS, oracle.code("raw"))} AS passed_through,
               {oracle.recode("raw", mapping.ORDER_STATUS, "'Unknown'")} AS with_default
        FROM (SELECT *, CASE WHEN l_tax < 0.02 THEN NULL WHEN l_returnflag = 'A' THEN ' comp'
                             WHEN l_returnflag = 'R' THEN 'Refunded ' ELSE 'odd' END AS raw FROM lineitem) AS t""",
)
def _status_map(spark, d):
    raw = (
        F.when(F.col("l_tax") < 0.02, None)
        .when(F.col("l_returnflag") == "A", " comp")
        .when(F.col("l_returnflag") == "R", "Refunded ")
        .otherwise("odd")
    )
    return inputs.table(spark, d, "lineitem").select(
        *("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        mapping.map_values(raw, mapping.STAGED_STATUS).alias("passed_through"),
        mapping.map_values(raw, mapping.ORDER_STATUS, mapping.ORDER_STATUS_DEFAULT).alias("with_default"),
    )


@register(
    "clean_dates",
    oracle.with_models(f"""
        SELECT payment_id, CAST({oracle.either_date("payment_date")} AS VARCHAR) AS parsed,
               CAST(CAST(try_strptime(payment_date, '%m/%d/%Y') AS DATE) AS VARCHAR) AS us_only
        FROM o2c_raw_payments"""),
)
def _dates(spark, d):
    c = F.col("payment_date")
    return O2C(spark, d).raw("raw_payments").select(
        "payment_id", parsing.parse_date(c).alias("parsed"), parsing.parse_date(c, (parsing.US_DATE,)).alias("us_only")
    )


@register(
    "clean_quantity",
    oracle.with_models(f"""
        SELECT line_id, CAST({oracle.words_to_number("quantity")} AS DOUBLE) AS quantity,
               {oracle.words_to_number("quantity")} IS NULL AS unparseable FROM o2c_raw_order_lines"""),
)
def _quantity(spark, d):
    number = parsing.word_number(F.col("quantity"))
    return O2C(spark, d).raw("raw_order_lines").select(
        "line_id", number.alias("quantity"), number.isNull().alias("unparseable")
    )


@register(
    "clean_text",
    oracle.with_models(f"""
        SELECT id, trim(first_nm) AS trimmed, {oracle.code("tier")} AS upper_text,
               lower(trim(email_addr)) AS lower_text, {oracle.capital("last_nm")} AS capitalized,
               {oracle.blank("substr(first_nm, 1, 1)")} AS blank_or_letter,
               ifnull(contains(upper(email_addr), '00'), false) AS has_zeros
        FROM retail_raw_customers"""),
)
def _text(spark, d):
    return Retail(spark, d).raw("raw_customers").select(
        "id",
        text.trimmed(F.col("first_nm")).alias("trimmed"),
        text.upper_clean(F.col("tier")).alias("upper_text"),
        text.lower_clean(F.col("email_addr")).alias("lower_text"),
        text.capitalize_first(F.col("last_nm")).alias("capitalized"),
        text.blank_to_null(F.left("first_nm", F.lit(1))).alias("blank_or_letter"),
        text.contains_ci(F.col("email_addr"), "00").alias("has_zeros"),
    )


@register(
    "title_case",
    oracle.with_models(f"""
        SELECT customer_id, {oracle.titled("company_name")} AS company_name, {oracle.titled("contact_name")} AS contact_name
        FROM o2c_raw_customers"""),
)
def _title(spark, d):
    return O2C(spark, d).raw("raw_customers").select(
        "customer_id",
        text.title_case(F.col("company_name")).alias("company_name"),
        text.title_case(F.col("contact_name")).alias("contact_name"),
    )


@register(
    "carrier_rules",
    oracle.with_models(f"SELECT shipment_id, {oracle.carrier('carrier')} AS carrier FROM o2c_raw_shipments"),
)
def _carriers(spark, d):
    return O2C(spark, d).raw("raw_shipments").select("shipment_id", mapping.carrier_of(F.col("carrier")).alias("carrier"))


@register(
    "region_map",
    oracle.with_models(
        f"SELECT customer_id, {oracle.region(oracle.code('state'))} AS region FROM o2c_raw_customers"
    ),
)
def _regions(spark, d):
    state = text.upper_clean(F.col("state"))
    return O2C(spark, d).raw("raw_customers").select("customer_id", mapping.region_of(state).alias("region"))


# --- quarantine -------------------------------------------------------------------------------------
# staged table: raw table, staging, its key, the columns a reader wants to see
_STAGINGS = {
    "retail_orders": (Retail, "raw_orders", retail.orders_staging, "id"),
    "retail_customers": (Retail, "raw_customers", retail.customers_staging, "id"),
    "retail_products": (Retail, "raw_products", retail.products_staging, "id"),
    "o2c_customers": (O2C, "raw_customers", o2c.customers_staging, "customer_id"),
    "o2c_products": (O2C, "raw_products", o2c.products_staging, "product_id"),
    "o2c_orders": (O2C, "raw_sales_orders", o2c.sales_orders_staging, "order_id"),
    "o2c_order_lines": (O2C, "raw_order_lines", o2c.order_lines_staging, "line_id"),
    "o2c_shipments": (O2C, "raw_shipments", o2c.shipments_staging, "shipment_id"),
    "o2c_invoices": (O2C, "raw_invoices", o2c.invoices_staging, "invoice_id"),
    "o2c_payments": (O2C, "raw_payments", o2c.payments_staging, "payment_id"),
}


def _register_rejected(name: str, family, raw: str, staging, key: str) -> None:
    @register(f"{name}_rejected", oracle.rejected(name, key))
    def _rejected(spark, d):
        rows = staging().rejected(family(spark, d).raw(raw))
        return rows.select(key, F.array_join(F.array_sort("rejected_columns"), ",").alias("rejected"))


for _name, _staging in _STAGINGS.items():
    _register_rejected(_name, *_staging)


@register(
    "null_keys_rejected",
    oracle.with_models("""
        SELECT cust_id, prod_id, order_dt FROM retail_raw_orders WHERE CAST(substr(prod_id, 3) AS BIGINT) % 10 = 3"""),
)
def _null_keys(spark, d):
    """A tenth of the raw orders has lost its id: none of them is staged, all are in quarantine."""
    raw = Retail(spark, d).raw("raw_orders")
    raw = raw.withColumn("id", F.when(F.substring("prod_id", 3, 18).cast("bigint") % 10 != 3, F.col("id")))
    rows = retail.orders_staging().rejected(raw)
    return rows.filter(F.array_contains("rejected_columns", "missing_id")).select("cust_id", "prod_id", "order_dt")


# --- operators ---------------------------------------------------------------------------------------
@register(
    "dedupe_first",
    """SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity,
              l_extendedprice
       FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey,
                                                l_suppkey, l_linenumber, l_quantity) = 1""",
)
def _dedupe(spark, d):
    order = [F.col("l_extendedprice").desc(), "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"]
    lines = inputs.table(spark, d, "lineitem").select(
        *("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")
    )
    return dedupe_first(lines, ["l_orderkey"], order)


_TOTALS = {"invoice_id": "string", "amount_paid": "decimal", "payment_count": "bigint", "last_payment_date": "date"}


@register("payment_totals", oracle.flat("o2c_payment_totals", _TOTALS))
def _payment_totals(spark, d):
    return payment_totals(O2C(spark, d).stg_payments)


@register("first_orders", oracle.flat("o2c_first_orders", {"customer_id": "string", "first_order_date": "date"}))
def _first_orders(spark, d):
    return first_orders(O2C(spark, d).stg_sales_orders)


_ROLLUP = {"order_id": "string", "line_count": "bigint", "product_count": "bigint"} | {
    n: "decimal" for n in ("gross_revenue", "discount_amount", "revenue", "cost", "gross_profit")
}


@register("order_rollup", oracle.flat("o2c_order_rollup", _ROLLUP))
def _order_rollup(spark, d):
    return order_rollup(O2C(spark, d).int_order_lines_enriched)


@register(
    "orphans",
    """SELECT c_custkey, c_name FROM customer
       WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = c_custkey)""",
)
def _orphans(spark, d):
    customers = inputs.table(spark, d, "customer").select("c_custkey", "c_name")
    return orphans(customers, "c_custkey", inputs.table(spark, d, "lineitem"), "l_suppkey")


@register(
    "left_lookup_isolated",
    """SELECT l.l_orderkey, CAST(l.l_linenumber AS BIGINT) AS l_linenumber, l.l_partkey, l.l_linestatus, n.n_name
       FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN 7 ELSE l_suppkey END AS key FROM lineitem) AS l
       LEFT JOIN (SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey) AS n
       ON n.s_suppkey = l.key""",
)
def _isolated(spark, d):
    """A third of all lines carries one key."""
    key = F.when(F.col("l_returnflag") == "R", F.lit(7)).otherwise(F.col("l_suppkey"))
    lines = inputs.table(spark, d, "lineitem").withColumn("key", key)
    nations = inputs.table(spark, d, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    suppliers = inputs.table(spark, d, "supplier").join(nations, "s_nationkey").withColumnRenamed("s_suppkey", "key")
    joined = left_lookup(lines, suppliers, "key", ["n_name"], isolate_share=0.05)
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "l_linestatus", "n_name")


CUT = dt.date(2001, 1, 1)


@register(
    "incremental_filter",
    oracle.with_models(f"""
        SELECT order_id, CAST(order_date AS VARCHAR) AS order_date FROM o2c_stg_sales_orders
        WHERE order_date > (SELECT max(order_date) FROM o2c_stg_sales_orders WHERE order_date < DATE '{CUT}')"""),
)
def _incremental(spark, d):
    orders = O2C(spark, d).stg_sales_orders.select("order_id", "order_date")
    return incremental_filter(orders, "order_date", orders.filter(F.col("order_date") < F.lit(CUT)))


@register(
    "incremental_filter_lookback",
    oracle.with_models(f"""
        SELECT order_id, CAST(order_date AS VARCHAR) AS order_date FROM o2c_stg_sales_orders
        WHERE order_date >= (SELECT max(order_date) FROM o2c_stg_sales_orders WHERE order_date < DATE '{CUT}') - 7"""),
)
def _lookback(spark, d):
    orders = O2C(spark, d).stg_sales_orders.select("order_id", "order_date")
    loaded = orders.filter(F.col("order_date") < F.lit(CUT))
    return incremental_filter(orders, "order_date", loaded, inclusive=True, lookback_days=7)


_CHANGED = """
    SELECT order_id, customer_id, DATE '2001-12-01' AS order_date, 'CONFIRMED' AS order_status FROM o2c_stg_sales_orders
    WHERE order_status = 'ON_HOLD'
    UNION ALL SELECT 'NEW-' || order_id, customer_id, order_date, order_status FROM o2c_stg_sales_orders
    WHERE order_status = 'DRAFT'"""
_UPSERTED = oracle.with_models(f"""
    SELECT order_id, customer_id, CAST(order_date AS VARCHAR) AS order_date, order_status FROM o2c_stg_sales_orders
    WHERE order_status <> 'ON_HOLD'
    UNION ALL SELECT order_id, customer_id, CAST(order_date AS VARCHAR), order_status FROM ({_CHANGED}) AS changed""")


def _order_changes(orders: DataFrame) -> DataFrame:
    """Held orders get confirmed on a later day; drafts come back under new ids."""
    held = orders.filter("order_status = 'ON_HOLD'").select(
        "order_id",
        "customer_id",
        F.lit(dt.date(2001, 12, 1)).alias("order_date"),
        F.lit("CONFIRMED").alias("order_status"),
    )
    drafts = orders.filter("order_status = 'DRAFT'").withColumn("order_id", F.concat(F.lit("NEW-"), "order_id"))
    return held.unionByName(drafts)


@register("upsert", _UPSERTED)
def _upsert(spark, d):
    orders = O2C(spark, d).stg_sales_orders.select("order_id", "customer_id", "order_date", "order_status")
    return upsert(orders, _order_changes(orders), ["order_id"])


@register("upsert_table", _UPSERTED)
def _upsert_table(spark, d):
    """The same through a stored table, partitioned by month so that held orders change their place."""
    orders = O2C(spark, d).stg_sales_orders.select("order_id", "customer_id", "order_date", "order_status")
    month = F.date_format("order_date", "yyyy-MM")
    path = scratch(spark, "sales_orders")
    upsert_table(orders.withColumn("month", month), path, ["order_id"], ["month"])
    changes = _order_changes(orders).withColumn("month", month)
    return upsert_table(changes, path, ["order_id"], ["month"]).drop("month")


_FACT = schemas.RETAIL["fct_orders"]


@register(
    "fct_orders_incremental",
    oracle.with_models(f"""
        SELECT {oracle.shown(_FACT)} FROM (
            SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_date DESC, customer_id DESC,
                product_id DESC, status DESC, quantity DESC NULLS LAST, unit_price DESC NULLS LAST,
                discount_pct DESC) AS place
            FROM retail_fct_orders) AS ranked
        WHERE place = 1"""),
)
def _fct_incremental(spark, d):
    """First load up to a day, then everything after it; later rows replace earlier ones by id."""
    r = Retail(spark, d)
    path = scratch(spark, "fct_orders")
    early = r.stg_orders.filter(F.col("order_date") < F.lit(CUT))
    options = {"period": "month", "loaded_at": LOADED_AT, "products": r.stg_products}
    retail.load_fct_orders(early, r.dim_customers, path, **options)
    return retail.load_fct_orders(r.stg_orders, r.dim_customers, path, **options)


# --- history -----------------------------------------------------------------------------------------
FIRST_RUN = dt.datetime(1999, 1, 1)
SECOND_RUN = dt.datetime(2000, 6, 1)
_VERSIONED = ("customer_id", "tier", "country_code", "is_marketing_opted_in")


def _customer_runs(spark, d) -> tuple[DataFrame, DataFrame]:
    """Two states of the customers: some change tier or country, some are missing, some are new."""
    now = Retail(spark, d).stg_customers.select(*_VERSIONED)
    number = F.substring("customer_id", 3, 18).cast("bigint")
    before = now.filter(number % 10 != 9).select(
        "customer_id",
        F.when(number % 3 == 0, F.lit("BRONZE")).otherwise(F.col("tier")).alias("tier"),
        F.when(number % 7 == 1, F.lit(None).cast("string")).otherwise(F.col("country_code")).alias("country_code"),
        "is_marketing_opted_in",
    )
    return before, now.filter(number % 10 != 4)


def _version_sql() -> str:
    number = "CAST(substr(customer_id, 3) AS BIGINT)"
    before = f"""SELECT customer_id, CASE WHEN {number} % 3 = 0 THEN 'BRONZE' ELSE tier END AS tier,
        CASE WHEN {number} % 7 <> 1 THEN country_code END AS country_code, is_marketing_opted_in
        FROM retail_stg_customers WHERE {number} % 10 <> 9"""
    after = f"""SELECT customer_id, tier, country_code, is_marketing_opted_in
        FROM retail_stg_customers WHERE {number} % 10 <> 4"""
    first, second = f"TIMESTAMP '{FIRST_RUN}'", f"TIMESTAMP '{SECOND_RUN}'"
    moved = "a.customer_id IS NOT NULL AND (a.tier, a.country_code, a.is_marketing_opted_in) IS DISTINCT FROM (b.tier, b.country_code, b.is_marketing_opted_in)"
    return f"""
        SELECT b.*, {first} AS valid_from, CASE WHEN {moved} THEN {second} END AS valid_to
        FROM ({before}) AS b LEFT JOIN ({after}) AS a USING (customer_id)
        UNION ALL
        SELECT a.*, {second}, NULL FROM ({after}) AS a LEFT JOIN ({before}) AS b USING (customer_id)
        WHERE b.customer_id IS NULL OR {moved}"""


_HISTORY = oracle.with_models(f"""
    SELECT customer_id, tier, country_code, is_marketing_opted_in, CAST(valid_from AS VARCHAR) AS valid_from,
           CAST(valid_to AS VARCHAR) AS valid_to,
           sha256(length(customer_id) || ':' || customer_id || '|' || CAST(epoch_us(valid_from) AS VARCHAR)) AS version_id
    FROM ({_version_sql()}) AS versions""")


@register("scd2_apply", _HISTORY)
def _scd2(spark, d):
    before, after = _customer_runs(spark, d)
    first = scd2_apply(None, before, ["customer_id"], retail.HISTORY_CHECK, FIRST_RUN)
    return scd2_apply(first, after, ["customer_id"], retail.HISTORY_CHECK, SECOND_RUN)


@register("snapshot_customers", _HISTORY)
def _snapshot(spark, d):
    """The same through a stored history."""
    before, after = _customer_runs(spark, d)
    path = scratch(spark, "customer_history")
    retail.snapshot_customers(before, path, FIRST_RUN)
    retail.snapshot_customers(after, path, SECOND_RUN)
    return read_history(spark, path)


LATE_RUN = dt.datetime(1999, 9, 1)


def _late_sql() -> str:
    """Versions of what was seen in three snapshots, by what a key was before and after; no notion of runs."""
    number = "CAST(substr(customer_id, 3) AS BIGINT)"
    seen = f"""
        SELECT TIMESTAMP '{FIRST_RUN}' AS seen_at, customer_id, CASE WHEN {number} % 3 = 0 THEN 'BRONZE' ELSE tier END AS tier,
               CASE WHEN {number} % 7 <> 1 THEN country_code END AS country_code, is_marketing_opted_in
        FROM retail_stg_customers WHERE {number} % 10 <> 9
        UNION ALL SELECT TIMESTAMP '{LATE_RUN}', customer_id, CASE WHEN {number} % 5 = 0 THEN 'GOLD' ELSE tier END,
               country_code, is_marketing_opted_in FROM retail_stg_customers WHERE {number} % 4 <> 1
        UNION ALL SELECT TIMESTAMP '{SECOND_RUN}', customer_id, tier, country_code, is_marketing_opted_in
        FROM retail_stg_customers WHERE {number} % 10 <> 4"""
    return f"""
        SELECT * FROM (WITH seen AS ({seen}), beside AS (
            SELECT *, lag((tier, country_code, is_marketing_opted_in)) OVER (PARTITION BY customer_id ORDER BY seen_at) AS old,
                   row_number() OVER (PARTITION BY customer_id ORDER BY seen_at) AS place FROM seen),
        starts AS (SELECT * FROM beside WHERE place = 1 OR old IS DISTINCT FROM (tier, country_code, is_marketing_opted_in))
        SELECT customer_id, tier, country_code, is_marketing_opted_in, CAST(seen_at AS VARCHAR) AS valid_from,
               CAST(lead(seen_at) OVER (PARTITION BY customer_id ORDER BY seen_at) AS VARCHAR) AS valid_to,
               sha256(length(customer_id) || ':' || customer_id || '|' || CAST(epoch_us(seen_at) AS VARCHAR)) AS version_id
        FROM starts) AS versions"""


@register("snapshot_late", oracle.with_models(_late_sql()))
def _snapshot_late(spark, d):
    """Three snapshots, the middle one last, and one of them twice."""
    before, after = _customer_runs(spark, d)
    now = Retail(spark, d).stg_customers.select(*_VERSIONED)
    number = F.substring("customer_id", 3, 18).cast("bigint")
    golden = F.when(number % 5 == 0, F.lit("GOLD")).otherwise(F.col("tier"))
    late = now.filter(number % 4 != 1).withColumn("tier", golden)
    path = scratch(spark, "customer_sightings")
    for rows, at in ((after, SECOND_RUN), (before, FIRST_RUN), (late, LATE_RUN), (after, SECOND_RUN)):
        put_snapshot(rows, path, ["customer_id"], at)
    return read_versions(spark, path, ["customer_id"], retail.HISTORY_CHECK)


_AS_OF = oracle.with_models(f"""
    SELECT f.order_id, f.product_id, CAST(f.order_date AS VARCHAR) AS order_date, f.customer_id,
           CAST(f.quantity AS BIGINT) AS quantity, v.tier AS tier, v.country_code
    FROM retail_stg_orders f LEFT JOIN ({_version_sql()}) AS v
    ON v.customer_id = f.customer_id AND f.order_date >= v.valid_from
       AND (v.valid_to IS NULL OR f.order_date < v.valid_to)""")


def _as_of(spark, d, **options):
    before, after = _customer_runs(spark, d)
    first = scd2_apply(None, before, ["customer_id"], retail.HISTORY_CHECK, FIRST_RUN)
    history = scd2_apply(first, after, ["customer_id"], retail.HISTORY_CHECK, SECOND_RUN)
    orders = Retail(spark, d).stg_orders.select("order_id", "product_id", "order_date", "customer_id", "quantity")
    return as_of_join(orders, history, "customer_id", "order_date", ["tier", "country_code"], **options)


@register("as_of_join", _AS_OF)
def _as_of_plain(spark, d):
    return _as_of(spark, d)


@register("as_of_join_sliced", _AS_OF)
def _as_of_sliced(spark, d):
    """Facts and versions merged by time, keys with a twentieth of the facts cut into ranges."""
    return _as_of(spark, d, hot_share=0.05)


_HOT_KEY = "CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END"


@register(
    "as_of_join_hot",
    f"""
    WITH facts AS (
        SELECT o_orderkey, {_HOT_KEY} AS key, CAST(o_orderdate AS TIMESTAMP) + to_minutes(o_orderkey % 1440) AS moment FROM orders),
    versions AS (
        SELECT CAST(1 AS BIGINT) AS key, TIMESTAMP '1992-01-01' + to_minutes(o_orderkey * 200) AS valid_from,
            TIMESTAMP '1992-01-01' + to_minutes(o_orderkey * 200 + 150) AS valid_to, o_orderkey AS version FROM orders
        UNION ALL SELECT c_custkey, TIMESTAMP '1995-01-01', NULL, -c_custkey FROM customer WHERE c_custkey > 1)
    SELECT o_orderkey, facts.key, CAST(moment AS VARCHAR) AS moment, version FROM facts
    LEFT JOIN versions ON versions.key = facts.key AND moment >= valid_from AND (valid_to IS NULL OR moment < valid_to)""",
)
def _as_of_hot(spark, d):
    """A third of all orders are one customer's, who has as many versions as there are orders, with gaps between them."""
    orders, customers = inputs.table(spark, d, "orders"), inputs.table(spark, d, "customer")

    def minutes(since, n):
        return F.timestamp_micros(F.unix_micros(since.cast("timestamp")) + n * 60_000_000)

    facts = orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey")).cast("bigint").alias("key"),
        minutes(F.col("o_orderdate"), F.col("o_orderkey") % 1440).alias("moment"),
    )
    begin = F.lit(dt.datetime(1992, 1, 1))
    versions = orders.select(
        F.lit(1).cast("bigint").alias("key"),
        minutes(begin, F.col("o_orderkey") * 200).alias("valid_from"),
        minutes(begin, F.col("o_orderkey") * 200 + 150).alias("valid_to"),
        F.col("o_orderkey").alias("version"),
    ).unionByName(
        customers.filter("c_custkey > 1").select(
            F.col("c_custkey").cast("bigint").alias("key"),
            F.lit(dt.datetime(1995, 1, 1)).alias("valid_from"),
            F.lit(None).cast("timestamp").alias("valid_to"),
            (-F.col("c_custkey")).alias("version"),
        )
    )
    return as_of_join(facts, versions, "key", "moment", ["version"], hot_share=0.02)


# --- checks -------------------------------------------------------------------------------------------
def _register_suite(family, prefix: str, dataset: str, suite: list[quality.Check], suffix: str = "") -> None:
    parents = {c.args[0]: f"{prefix}_{c.args[0]}" for c in suite if c.kind == "relationships"}

    @register(f"check_{prefix}_{dataset}{suffix}", oracle.check_report(f"{prefix}_{dataset}", suite, parents))
    def _run(spark, d):
        data = family(spark, d)
        return quality.run_checks(getattr(data, dataset), suite, {p: getattr(data, p) for p in parents})


for _family, _prefix, _declared, _documented in (
    (Retail, "retail", checks.RETAIL, checks.DOCUMENTED_RETAIL),
    (O2C, "o2c", checks.O2C, checks.DOCUMENTED_O2C),
):
    for _dataset, _suite in _declared.items():
        _register_suite(_family, _prefix, _dataset, _suite)
    for _dataset, _suite in _documented.items():
        _register_suite(_family, _prefix, _dataset, _suite, "_documented")


@register(
    "check_unique_failures",
    oracle.with_models("""
        SELECT order_id, count(*) AS occurrences FROM retail_stg_orders GROUP BY order_id HAVING count(*) > 1"""),
)
def _unique_failures(spark, d):
    return quality.failing(Retail(spark, d).stg_orders, quality.unique("order_id"))


@register(
    "check_where",
    oracle.with_models("""
        SELECT line_id, order_id, CAST(revenue AS DOUBLE) AS revenue FROM o2c_fct_order_lines
        WHERE region = 'West' AND NOT revenue BETWEEN 100 AND 50000"""),
)
def _where(spark, d):
    check = quality.between("revenue", 100, 50000).where("region = 'West'")
    return quality.failing(O2C(spark, d).fct_order_lines, check).select("line_id", "order_id", "revenue")


@register(
    "stored_failures",
    oracle.with_models("""
        SELECT 'not_null_list_price' AS "check", product_id FROM retail_stg_products WHERE list_price IS NULL
        UNION ALL SELECT 'accepted_category', product_id FROM retail_stg_products
        WHERE category NOT IN ('APPAREL', 'FOOTWEAR', 'ACCESSORIES')
        UNION ALL SELECT 'not_null_product_id', product_id FROM retail_stg_products WHERE product_id IS NULL
        UNION ALL SELECT 'unique_product_id', product_id FROM retail_stg_products
        GROUP BY product_id HAVING count(*) > 1"""),
)
def _stored(spark, d):
    suite = checks.RETAIL["stg_products"]
    path = scratch(spark, "failures")
    quality.store_failures(Retail(spark, d).stg_products, suite, path)
    stored = [
        quality.read_failures(spark, c, path).select(F.lit(c.name).alias("check"), "product_id")
        for c in suite
    ]
    report = stored[0]
    for other in stored[1:]:
        report = report.unionByName(other)
    return report


def _build_sql(prefix: str, suites: dict[str, list[quality.Check]]) -> str:
    rows = []
    for dataset, suite in suites.items():
        parents = {c.args[0]: f"{prefix}_{c.args[0]}" for c in suite if c.kind == "relationships"}
        for check in suite:
            rows.append(f"SELECT '{dataset}' AS dataset, * FROM ({oracle.check_rows(f'{prefix}_{dataset}', check, parents)})")
    return "\nUNION ALL\n".join(rows)


@register("build_o2c", oracle.with_models(_build_sql("o2c", checks.O2C)))
def _build_o2c(spark, d):
    """All marts stored, then the report of all checks."""
    c = O2C(spark, d)
    return build.build_o2c({name: c.raw(name) for name in inputs.O2C}, scratch(spark, "o2c"), AS_OF)


# the stored fact holds each order once
_ONE_PER_ORDER = """SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_date DESC, customer_id DESC, product_id DESC,
        status DESC, quantity DESC NULLS LAST, unit_price DESC NULLS LAST, discount_pct DESC) AS place
    FROM (_FCT_) AS loaded) AS ranked WHERE place = 1"""
_STORED_MODELS = oracle.MODELS | {
    "retail_fct_orders": _ONE_PER_ORDER.replace("_FCT_", oracle.MODELS["retail_fct_orders"])
}


@register("build_retail", oracle.with_models(_build_sql("retail", checks.RETAIL), _STORED_MODELS))
def _build_retail(spark, d):
    r = Retail(spark, d)
    raw = {name: r.raw(name) for name in inputs.RETAIL}
    return build.build_retail(raw, scratch(spark, "retail"), LOADED_AT, AS_OF, period="month")


# --- reports --------------------------------------------------------------------------------------------
@register(
    "aging_summary",
    oracle.with_models("""
        SELECT b.aging_bucket, count(i.invoice_id) AS invoice_count,
               CAST(ifnull(sum(i.outstanding_amount), 0) AS DOUBLE) AS total_outstanding
        FROM (SELECT DISTINCT aging_bucket FROM o2c_invoice_aging
              UNION VALUES ('Current'), ('1-30 days overdue'), ('31-60 days overdue'), ('60+ days overdue')) AS b
        LEFT JOIN o2c_invoice_aging i USING (aging_bucket) GROUP BY b.aging_bucket"""),
)
def _aging(spark, d):
    return receivables.aging_summary(O2C(spark, d).invoice_balances, AS_OF)


def _dso_sql(by: str, expression: str) -> str:
    owed = "sum(CASE WHEN invoice_status <> 'PAID' THEN outstanding_amount END)"
    ratio = oracle.half_up(
        "CAST(total_outstanding * 100 AS HUGEINT) * 365 * 100", "CAST(credit_sales * 100 AS HUGEINT)"
    )
    return oracle.with_models(f"""
        SELECT {by}, CAST(total_outstanding AS DOUBLE) AS total_outstanding, CAST(credit_sales AS DOUBLE) AS credit_sales,
               {ratio} AS dso
        FROM (SELECT {expression} AS {by}, ifnull({owed}, 0) AS total_outstanding, sum(invoice_amount) AS credit_sales
              FROM o2c_fct_invoices GROUP BY 1) AS sums""")


@register("dso_customer", _dso_sql("customer_id", "customer_id"))
def _dso_customer(spark, d):
    return receivables.dso(O2C(spark, d).invoice_balances, ["customer_id"], 365)


def _stored_payments(spark, data: O2C) -> DataFrame:
    """What balances need of staged payments, compared once and stored: both loads read them, the second one twice."""
    path = scratch(spark, "stg_payments")
    return write_table(data.stg_payments.select("invoice_id", "amount", "payment_date"), path)


def _kept_receivables(spark, d) -> str:
    """Balances as they were known at a day, then what has come since: later invoices, and earlier ones with later payments."""
    data, out = O2C(spark, d), scratch(spark, "receivables")
    invoices, payments = data.stg_invoices, _stored_payments(spark, data)
    known = invoices.filter(F.col("invoice_date") < F.lit(CUT))
    paid = payments.filter(F.col("payment_date") < F.lit(CUT))
    receivables.load_balances(o2c.invoice_balances(known, paid), out)
    later = F.coalesce(F.col("invoice_date") >= F.lit(CUT), F.lit(True))
    paid_later = F.coalesce(F.col("payment_date") >= F.lit(CUT), F.lit(True))
    changed = invoices.filter(later).select("invoice_id").union(payments.filter(paid_later).select("invoice_id"))
    receivables.load_balances(receivables.changed_balances(invoices, payments, changed), out)
    return out


@register("aging_kept", ORACLE["aging_summary"])
def _aging_kept(spark, d):
    """The aging of open invoices from totals that a second load has brought up to date."""
    totals = receivables.open_by_due_date(_kept_receivables(spark, d))
    return receivables.kept_aging_summary(totals.read(spark), AS_OF)


@register("dso_kept", ORACLE["dso_customer"])
def _dso_kept(spark, d):
    totals = receivables.sales_by_customer(_kept_receivables(spark, d))
    return receivables.kept_dso(totals.read(spark), 365)


@register("dso_region", _dso_sql("region", oracle.region("customer_state")))
def _dso_region(spark, d):
    return receivables.dso(O2C(spark, d).fct_invoices, ["region"], 365)


@register("dso_sales_rep", _dso_sql("sales_rep", "sales_rep"))
def _dso_rep(spark, d):
    return receivables.dso(O2C(spark, d).fct_invoices, ["sales_rep"], 365)


def _on_time_sql(by: str) -> str:
    group = f"{by}, " if by else ""
    per_order = f"""SELECT {group}order_id, bool_and(is_on_time_delivery) AS on_time
        FROM o2c_orders_with_shipments WHERE ship_date IS NOT NULL GROUP BY ALL"""
    return oracle.with_models(f"""
        SELECT {group}shipped_orders, on_time_orders,
               {oracle.half_up("CAST(on_time_orders AS HUGEINT) * 10000", "CAST(shipped_orders AS HUGEINT)", 4)} AS on_time_rate
        FROM (SELECT {group}count(*) AS shipped_orders, count(*) FILTER (WHERE on_time) AS on_time_orders
              FROM ({per_order}) AS orders GROUP BY ALL) AS counts""")


@register("on_time_rate", _on_time_sql(""))
def _on_time(spark, d):
    return o2c.on_time_rate(O2C(spark, d).orders_with_shipments)


@register("on_time_rate_by_carrier", _on_time_sql("carrier"))
def _on_time_carrier(spark, d):
    return o2c.on_time_rate(O2C(spark, d).orders_with_shipments, "carrier")


# --- sources and sinks ------------------------------------------------------------------------------------
@register("csv_round_trip", oracle.flat("o2c_stg_shipments", schemas.O2C["stg_shipments"]))
def _csv(spark, d):
    """Raw shipments through text files: postal codes keep their zero, empty fields become null."""
    path = scratch(spark, "raw_shipments")
    O2C(spark, d).raw("raw_shipments").write.option("header", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    return o2c.stg_shipments(read_raw(spark, path, schemas.O2C_RAW["raw_shipments"]))


@register("table_by_invoice_date", oracle.flat("o2c_fct_invoices", schemas.O2C["fct_invoices"]))
def _clustered(spark, d):
    """The invoice fact written clustered by invoice date, and read back."""
    path = scratch(spark, "fct_invoices")
    write_table(O2C(spark, d).fct_invoices, path, layout=range_sort("invoice_date"))
    return read_table(spark, path)


_MOVED = "CAST(substr(order_id, 4) AS BIGINT) % 7 = 0"
_STREAMED = f"""SELECT * REPLACE (CASE WHEN {_MOVED} THEN DATE '2002-01-15' ELSE order_date END AS order_date)
    FROM o2c_stg_sales_orders"""


@register(
    "stream_upsert",
    oracle.with_models(f"SELECT {oracle.shown(schemas.O2C['stg_sales_orders'])} FROM ({_STREAMED}) AS streamed"),
)
def _stream(spark, d):
    """Raw orders arriving as files, streamed into the staged order table; a seventh of them comes again with a
    later date, in several micro-batches, and leaves its old partition."""
    landing, target, progress = (scratch(spark, name) for name in ("landing", "streamed_orders", "stream_checkpoint"))
    raw = O2C(spark, d).raw("raw_sales_orders")
    moved = raw.filter("cast(substr(order_id, 4) as bigint) % 7 = 0").withColumn("order_date", F.lit("2002-01-15"))
    splits = raw.rdd.getNumPartitions()  # as many times more files, and files a batch, as the input has splits: no task writes more than a share
    for rows, files in ((raw, splits), (moved, 3 * splits)):
        rows.repartition(files, "order_id").write.mode("append").parquet(landing)
        query = stream_upsert(
            spark,
            landing,
            schemas.O2C_RAW["raw_sales_orders"],
            target,
            ["order_id"],
            ["order_month"],
            progress,
            transform=lambda rows: o2c.stg_sales_orders(rows).withColumn(
                "order_month", F.date_format("order_date", "yyyy-MM")
            ),
            order_by=[F.col(c) for c in schemas.O2C["stg_sales_orders"]],
            max_files_per_trigger=2 * splits,
        )
        query.awaitTermination()
    return read_table(spark, target).drop("order_month")


# --- stored tables: harder cases ----------------------------------------------------------------------
def _order_columns(spark, d) -> DataFrame:
    return O2C(spark, d).stg_sales_orders.select("order_id", "customer_id", "order_date", "order_status")


@register("upsert_unpartitioned", _UPSERTED)
def _upsert_unpartitioned(spark, d):
    """A table without partitions keeps the rows that the batch does not replace."""
    orders, path = _order_columns(spark, d), scratch(spark, "orders_whole")
    upsert_table(orders, path, ["order_id"])
    return upsert_table(_order_changes(orders), path, ["order_id"])


@register("upsert_replayed", _UPSERTED)
def _upsert_replayed(spark, d):
    """One batch applied twice, to a table partitioned by a column whose name starts with an underscore."""
    orders, path = _order_columns(spark, d), scratch(spark, "orders_replayed")
    month = F.date_format("order_date", "yyyy-MM")
    upsert_table(orders.withColumn("_month", month), path, ["order_id"], ["_month"])
    for _ in range(2):
        upsert_table(_order_changes(orders).withColumn("_month", month), path, ["order_id"], ["_month"])
    return read_table(spark, path).drop("_month")


@register(
    "detect_changes",
    oracle.with_models(f"""
        SELECT order_id, CAST(order_date AS VARCHAR) AS order_date, order_status, 'unchanged' AS change
        FROM o2c_stg_sales_orders WHERE order_status NOT IN ('ON_HOLD', 'CANCELLED')
        UNION ALL SELECT order_id, CAST(order_date AS VARCHAR), order_status, 'deleted' FROM o2c_stg_sales_orders
        WHERE order_status = 'CANCELLED'
        UNION ALL SELECT order_id, CAST(order_date AS VARCHAR), order_status,
            CASE WHEN starts_with(order_id, 'NEW-') THEN 'inserted' ELSE 'updated' END FROM ({_CHANGED}) AS changed"""),
)
def _detect_changes(spark, d):
    """Two snapshots of all orders: held ones confirmed, drafts copied, cancelled ones gone, the rest as before."""
    orders = _order_columns(spark, d)
    after = orders.filter("order_status not in ('ON_HOLD', 'CANCELLED')").unionByName(_order_changes(orders))
    found = detect_changes(orders, after, ["order_id"], deletions=True)
    return found.select("order_id", "order_date", "order_status", "change")


@register(
    "change_feed",
    oracle.with_models(f"""
        SELECT order_id, CAST(order_date AS VARCHAR) AS order_date, order_status, CAST(1 AS BIGINT) AS load,
            CASE WHEN starts_with(order_id, 'NEW-') THEN 'inserted' ELSE 'updated' END AS change
        FROM ({_CHANGED}) AS changed"""),
)
def _change_feed(spark, d):
    """A whole snapshot comes again with some orders changed and some new; the table tells which. A replay adds nothing."""
    orders, path = _order_columns(spark, d), scratch(spark, "orders_fed")
    month = F.date_format("order_date", "yyyy-MM")
    upsert_table(orders.withColumn("month", month), path, ["order_id"], ["month"])
    after = orders.filter("order_status <> 'ON_HOLD'").unionByName(_order_changes(orders)).withColumn("month", month)
    for _ in range(2):
        upsert_table(after, path, ["order_id"], ["month"])
    return read_changes(spark, path, since=0).select("order_id", "order_date", "order_status", "load", "change")


@register(
    "table_by_postal_code",
    oracle.with_models("SELECT shipment_id, trim(ship_to_zip) AS ship_to_zip FROM o2c_raw_shipments"),
)
def _by_postal_code(spark, d):
    """Postal codes as partition values keep their leading zero."""
    path = scratch(spark, "shipments_by_zip")
    write_table(O2C(spark, d).stg_shipments.select("shipment_id", "ship_to_zip"), path, ["ship_to_zip"])
    return read_table(spark, path)


@register(
    "csv_malformed",
    oracle.with_models("""
        SELECT shipment_id || CASE WHEN CAST(substr(shipment_id, 6) AS BIGINT) % 2 = 0 THEN ',too,many,fields' ELSE ',few' END
               AS line
        FROM o2c_raw_shipments WHERE CAST(substr(shipment_id, 6) AS BIGINT) % 5 < 2"""),
)
def _malformed(spark, d):
    """Two fifths of the lines have too many or too few fields for the header; none is lost or cut."""
    path = scratch(spark, "malformed")
    number = F.substring("shipment_id", 6, 18).cast("bigint")
    line = F.concat(
        "shipment_id", F.when(number % 5 >= 2, ",b,c").when(number % 2 == 0, ",too,many,fields").otherwise(",few")
    )
    lines = O2C(spark, d).raw("raw_shipments").select(line.alias("shipment_id,b,c"))
    lines.write.option("header", True).option("sep", "\t").csv(path)  # no tab anywhere: lines as they are
    return read_malformed(spark, path).select("line")

