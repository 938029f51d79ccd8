import datetime as dt
import re

import pytest
from comparing import tuples
from pyspark.sql import functions as F

from orderloom.operators.dedupe import dedupe_first
from orderloom.operators.history import scd2_apply
from orderloom.operators.incremental import SchemaChangedError, assert_schema, incremental_filter
from orderloom.operators.lookup import NotUniqueError, as_of_join, frequent_keys, left_lookup, lookups_in_place, orphans
from orderloom.operators.rollup import first_orders, order_rollup, payment_totals
from orderloom.operators.upsert import upsert

DAY = dt.date


def test_dedupe_keeps_first_and_groups_nulls(frame):
    df = frame("k string, v int", ("a", 2), ("a", 1), (None, 5), (None, 4), ("b", 9))
    assert tuples(dedupe_first(df, ["k"], ["v"])) == [(None, 4), ("a", 1), ("b", 9)]


def test_dedupe_cuts_rows_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    plan = dedupe_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    exchange, partial = plan.index("Exchange"), plan.index("Partial")
    assert "WindowGroupLimit" in plan and exchange < partial  # the plan is printed top down


def test_lookup_keeps_every_row(frame):
    left = frame("k string, v int", ("a", 1), ("z", 2), (None, 3))
    right = frame("k string, w string, x int", ("a", "A", 0), ("b", "B", 0))
    assert tuples(left_lookup(left, right, "k", ["w"])) == [(None, 3, None), ("a", 1, "A"), ("z", 2, None)]


def test_lookup_can_demand_unique_keys(frame):
    left, right = frame("k string", ("a",)), frame("k string, w int", ("a", 1), ("a", 2))
    assert left_lookup(left, right, "k").count() == 2
    with pytest.raises(NotUniqueError):
        left_lookup(left, right, "k", unique=True)
    left_lookup(left, right.withColumn("k", F.lit(None).cast("string")), "k", unique=True)


def test_isolated_lookup_equals_plain(spark):
    skewed = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id")).alias("k"), "id"
    )
    right = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w")).union(
        spark.createDataFrame([(7, 70)], "k bigint, w bigint")
    )
    assert 7 in frequent_keys(skewed, "k", 0.1)
    plain, isolated = left_lookup(skewed, right, "k"), left_lookup(skewed, right, "k", isolate_share=0.1)
    assert tuples(plain) == tuples(isolated)
    assert isolated.filter("k = 7 and w = 70").count() == 1001  # a third of the rows, and row 7 itself


def test_isolated_lookup_deals_hot_keys_out_when_the_hot_side_is_large(spark):
    left = spark.range(100).select(F.lit(1).alias("k"), "id")
    right = spark.createDataFrame([(1, "a"), (1, "b")], "k int, w string")
    dealt = left_lookup(left, right, "k", isolate_share=0.5, broadcast_bytes=10, salts=8)
    assert dealt.columns == ["k", "id", "w"] and dealt.distinct().count() == dealt.count() == 200
    assert "_salt" in dealt._jdf.queryExecution().toString()
    assert tuples(dealt) == tuples(left_lookup(left, right, "k"))


def test_orphans_skip_null_keys(frame):
    child = frame("k string, v int", ("a", 1), ("z", 2), (None, 3))
    assert tuples(orphans(child, "k", frame("p string", ("a",), (None,)), "p")) == [("z", 2)]


HISTORY = "k string, tier string, valid_from timestamp, valid_to timestamp"
T = dt.datetime


@pytest.mark.parametrize("hot_share", [None, 0.9, 0.2, 0.02])
def test_as_of_join_edges(frame, hot_share):
    history = frame(
        HISTORY,
        ("a", "old", T(2020, 1, 1), T(2021, 1, 1)),
        ("a", "new", T(2021, 1, 1), None),
        ("b", "only", T(2020, 6, 1), T(2020, 7, 1)),
    )
    facts = frame(
        "k string, d date, n int",
        ("a", DAY(2019, 12, 31), 1), ("a", DAY(2020, 1, 1), 2), ("a", DAY(2020, 12, 31), 3), ("a", DAY(2021, 1, 1), 4),
        ("b", DAY(2020, 7, 1), 5), ("c", DAY(2020, 7, 1), 6), (None, DAY(2020, 7, 1), 7), ("a", None, 8),
    )
    got = as_of_join(facts, history, "k", "d", ["tier"], hot_share=hot_share).select("n", "tier").collect()
    assert sorted(tuple(r) for r in got) == [
        (1, None), (2, "old"), (3, "old"), (4, "new"), (5, None), (6, None), (7, None), (8, None),
    ]


def test_rollups(frame):
    from decimal import Decimal as D

    payments = frame(
        "invoice_id string, amount decimal(14,2), payment_date date, is_duplicate_flag boolean",
        ("i", D(10), DAY(2024, 1, 1), False), ("i", D(0), DAY(2024, 2, 1), True), ("j", None, None, False),
    )
    assert tuples(payment_totals(payments)) == [("i", D("10.00"), 2, DAY(2024, 2, 1)), ("j", None, 1, None)]
    assert tuples(payment_totals(payments, exclude_flagged=True))[0] == ("i", D("10.00"), 1, DAY(2024, 1, 1))
    orders = frame("customer_id string, order_date date", ("c", DAY(2024, 3, 1)), ("c", DAY(2024, 2, 1)), ("c", None))
    assert tuples(first_orders(orders)) == [("c", DAY(2024, 2, 1))]
    lines = frame(
        "order_id string, product_id string, gross_revenue decimal(18,2), discount_amount decimal(18,2), "
        "revenue decimal(18,2), cost decimal(18,2), gross_profit decimal(18,2)",
        ("o", "p", D(2), D(1), D(1), D(1), D(0)), ("o", "p", D(2), D(0), D(2), D(1), D(1)), ("o", "q", None, None, None, D(1), None),
    )
    assert tuples(order_rollup(lines)) == [("o", 3, 2, D("4.00"), D("1.00"), D("3.00"), D("3.00"), D("1.00"))]


def test_incremental_filter(frame):
    df = frame("id int, d date", (1, DAY(2024, 1, 1)), (2, DAY(2024, 1, 9)), (3, DAY(2024, 1, 10)), (4, DAY(2024, 1, 11)), (5, None))
    target = df.filter("id = 3")
    ids = lambda got: sorted(r.id for r in got.collect())
    assert ids(incremental_filter(df, "d", None)) == [1, 2, 3, 4, 5]
    assert ids(incremental_filter(df, "d", df.filter("false"))) == [1, 2, 3, 4, 5]
    assert ids(incremental_filter(df, "d", target)) == [4]
    assert ids(incremental_filter(df, "d", target, inclusive=True)) == [3, 4]
    assert ids(incremental_filter(df, "d", target, inclusive=True, lookback_days=1)) == [2, 3, 4]


def test_schema_guard(spark):
    schema = lambda s: spark.createDataFrame([], s).schema
    assert_schema(schema("a int, b string"), schema("b string, a int"))
    for other in ("a int", "a int, b string, c int", "a bigint, b string"):
        with pytest.raises(SchemaChangedError):
            assert_schema(schema("a int, b string"), schema(other))


def test_upsert_twice_is_once(frame):
    target = frame("k string, v int", ("a", 1), ("b", 2))
    batch = frame("k string, v int", ("b", 20), ("c", 30), ("c", 31))
    once = upsert(target, batch, ["k"], order_by=["v"])
    assert tuples(once) == [("a", 1), ("b", 20), ("c", 30)]
    assert tuples(upsert(once, batch, ["k"], order_by=["v"])) == tuples(once)


def test_scd2_lifecycle(frame):
    schema = "k string, tier string, note string"
    runs = [T(2024, 1, 1), T(2024, 2, 1), T(2024, 3, 1)]
    first = frame(schema, ("same", "A", "x"), ("moved", "A", "x"), ("null", None, "x"), ("gone", "A", "x"), (None, "A", "x"))
    second = frame(schema, ("same", "A", "changed note"), ("moved", "B", "x"), ("null", "A", "x"), ("new", "A", "x"))
    h1 = scd2_apply(None, first, ["k"], ["tier"], runs[0])
    h2 = scd2_apply(h1, second, ["k"], ["tier"], runs[1])
    shown = lambda h: tuples(h.select("k", "tier", "note", "valid_from", "valid_to"))
    assert shown(h2) == [
        ("gone", "A", "x", runs[0], None),
        ("moved", "A", "x", runs[0], runs[1]),
        ("moved", "B", "x", runs[1], None),
        ("new", "A", "x", runs[1], None),
        ("null", None, "x", runs[0], runs[1]),
        ("null", "A", "x", runs[1], None),
        ("same", "A", "x", runs[0], None),
    ]
    h3 = scd2_apply(h2, second, ["k"], ["tier"], runs[2])
    assert shown(h3) == shown(h2)
    open_per_key = h3.filter("valid_to is null").groupBy("k").count().filter("count <> 1").count()
    assert open_per_key == 0
    assert h3.select("version_id").distinct().count() == h3.count()


def test_uniqueness_guarded_in_the_plan(spark, frame):
    from orderloom.operators.lookup import left_lookup

    left = frame("k string, n int", ("a", 1), ("b", 2), (None, 3), ("c", 4))
    once = frame("k string, v int, w string", ("a", 10, "x"), ("b", None, "y"), (None, 5, "z"), (None, 6, "z"))
    got = left_lookup(left, once, "k", ["v", "w"], unique="in plan").collect()
    assert sorted((r.n, r.v, r.w) for r in got) == [(1, 10, "x"), (2, None, "y"), (3, None, None), (4, None, None)]
    twice = once.union(frame("k string, v int, w string", ("b", 7, "y")))
    joined = left_lookup(left, twice, "k", ["v"], unique="in plan")  # nothing runs yet
    with pytest.raises(Exception, match=r"\['k'\] is not unique, e.g. b"):
        joined.collect()
    # grouping by the key takes no exchange beyond those of the join
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        plan = left_lookup(left, once, "k", ["v"], unique="in plan")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plan.count("Exchange hashpartitioning") == 2 and "raise_error" in plan


def test_wide_rows_stay_where_they_are(spark, frame):
    """Two further lookups of rows that a join has brought together by order: only keys move. Null and repeated keys are as in plain lookups."""
    lines = frame(
        "line string, o string, p string",
        *[("a", "1", "x"), ("b", "1", "x"), ("c", "1", "y"), ("d", "2", None), ("e", None, "x"), ("f", "9", "z"), ("a", "1", "x"), ("g", "3", "y")],
    )
    orders = frame("o string, c string, ship string", ("1", "k", "s1"), ("2", "m", "s2"), ("3", None, "s3"), (None, "k", "s4"), ("2", "k", "s5"))
    products = frame("p string, name string, n int", ("x", "X", 1), ("y", "Y", None), ("y", None, None), (None, "none", 3))
    customers = frame("c string, city string", ("k", "K"), ("m", "M"), (None, "nowhere"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.getAll.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left = left_lookup(lines, orders, "o")
        plain = left_lookup(left_lookup(left, products, "p"), customers, "c")
        stayed = lookups_in_place(left, {"p": products, "c": customers}, within="o").select(*plain.columns)
        plan = stayed._jdf.queryExecution().executedPlan().toString()
        for key in ("p", "c"):  # the first exchange below the join is the one by order
            below = re.split(rf"SortMergeJoin \[o#\d+, {key}#\d+\]", plan)[1]
            assert re.search(r"Exchange hashpartitioning\((.*?)\)", below)[1].count("#") == 1
        assert tuples(stayed) == tuples(plain) and stayed.count() == 11
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
