"""Every registered query against its SQL, and what its plan may contain."""

import importlib.util
import os

import duckdb
import pytest

from driver import inputs
from driver.datasets import O2C, Retail
from driver.queries import ORACLE, QUERIES
from orderloom.sources import schemas

SF_DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = rows_of(df.columns, df.collect())
    expected = duck.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(expected.columns)
    assert got == rows_of(expected.columns, expected.fetchall())
    assert got or name.endswith("_rejected")


@pytest.mark.parametrize("family, name", [*[(inputs.RETAIL, n) for n in inputs.RETAIL], *[(inputs.O2C, n) for n in inputs.O2C]])
def test_raw_inputs_are_the_same_in_both_engines(spark, duck, family, name):
    df = inputs.derive(spark, SF_DIR, family[name])
    expected = duck.sql(inputs.plain(family[name]))
    assert rows_of(df.columns, df.collect()) == rows_of(expected.columns, expected.fetchall())


@pytest.mark.parametrize("family, raw, columns", [(Retail, inputs.RETAIL, schemas.RETAIL_RAW), (O2C, inputs.O2C, schemas.O2C_RAW)])
def test_raw_inputs_have_the_declared_columns(spark, family, raw, columns):
    for name in raw:
        assert sorted(family(spark, SF_DIR).raw(name).columns) == sorted(columns[name].names)


@pytest.mark.parametrize("family, declared", [(Retail, schemas.RETAIL), (O2C, schemas.O2C)])
def test_datasets_have_the_declared_schema(spark, family, declared):
    data = family(spark, SF_DIR)
    for name, columns in declared.items():
        if name != "invoice_aging":
            assert dict(getattr(data, name).dtypes) == columns, name
            assert list(getattr(data, name).columns) == list(columns), name


STORED = {"upsert_table", "fct_orders_incremental", "snapshot_customers", "stored_failures", "csv_round_trip",
          "table_by_invoice_date", "stream_upsert", "build_o2c", "build_retail", "upsert_unpartitioned", "upsert_replayed",
          "table_by_postal_code", "csv_malformed", "change_feed", "snapshot_late"}


#: Their windows are over parts of a key.
MERGED = {"as_of_join_sliced", "as_of_join_hot"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STORED))
def test_plans_stay_distributed(spark, name):
    """No Python, no pairing without a key, no window over everything in one task."""
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert word not in plan
    if "Window" in plan and name not in MERGED:
        assert "WindowGroupLimit" in plan


def test_columns_and_filters_reach_the_scan(spark):
    plan = QUERIES["on_time_rate"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan and "o_orderstatus" not in plan
    payments = O2C(spark, SF_DIR).stg_payments.select("invoice_id", "amount")
    assert "l_returnflag" not in payments._jdf.queryExecution().executedPlan().toString()


def test_hot_order_is_split_in_both_joins(spark):
    """Half of all lines belong to one order: the two joins on the order key each split it."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.getAll.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        from pyspark.sql import functions as F

        from orderloom.plans import o2c

        data = O2C(spark, SF_DIR)
        hot = F.when(F.substring("line_id", -1, 1).isin(*"02468"), "SO-1").otherwise(F.col("order_id"))
        lines = data.stg_order_lines.withColumn("order_id", hot).repartition(8)
        joined = o2c.int_order_lines_enriched(lines, data.stg_sales_orders, data.stg_shipments, data.stg_products)
        rows = joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        fanned = lines.join(data.stg_shipments.groupBy("order_id").count(), "order_id", "left")
        assert len(rows) == fanned.agg(F.sum(F.coalesce("count", F.lit(1)))).first()[0]
        assert plan.count("SortMergeJoin(skew=true)") >= 2
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_entry_and_registry():
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert set(QUERIES) <= set(module.queries()) and set(module.oracle_sql()) <= set(module.queries())
    assert set(ORACLE) == set(QUERIES)


def test_entry_runs(spark):
    from driver.queries import QUERIES as registered

    assert registered["region_performance"](spark, SF_DIR).count() == 5
