"""What a load and a build move and keep on disk."""

import datetime as dt
import random
import time
from decimal import Decimal as D

from orderloom.operators import quality
from orderloom.operators.quality import relationships, unique
from orderloom.plans import build, retail
from orderloom.sources import index, tables
from orderloom.sources.folders import Folder

ORDER = "order_id string, customer_id string, product_id string, order_date date, status string, quantity int, discount_pct decimal(9,6), channel string, promo_code string"
PRODUCT = "product_id string, list_price decimal(14,4), cost_price decimal(14,4), product_name string, category string, brand string"


def _shop(spark, frame, seed, n=300):
    """Staged orders with repeated and null ids, products and customers that are there twice or not at all."""
    r = random.Random(seed)
    some = lambda *values: r.choice([*values, None])
    day = lambda: some(*(dt.date(2001, 1, 1) + dt.timedelta(days=20 * k) for k in range(6)))
    orders = [
        (some(*(f"O_{k}" for k in range(60))), some("C_1", "C_2", "C_9"), some("P_1", "P_2", "P_3", "P_9"), day(), some("COMP", "COMPLETED", "REFUND", "LOST"),
         some(-2, 0, 1, 5), some(D("0.1"), D("0")), some("WEB", "MOBILE", "MOBILE APP", "STORE"), some("A", "B"))
        for _ in range(n)
    ]
    products = [(f"P_{r.randint(1, 3)}", some(D("10"), D("12.5")), some(D("4"), D("4.0001"), D("9")), some("x", "y"), some("c"), some("b", "d")) for _ in range(9)]
    customers = frame("customer_id string, tier string", ("C_1", "GOLD"), ("C_1", "GOLD"), ("C_2", None), (None, "BRONZE"))
    return frame(ORDER, *orders), customers, frame(PRODUCT, *products)


def test_orders_cut_while_narrow_are_those_cut_when_wide(spark, frame, folder):
    for seed in range(2):
        orders, customers, products = _shop(spark, frame, seed)
        at = {"loaded_at": dt.datetime(2002, 1, 1), "period": "month"}
        wide, narrow = f"{folder}/wide{seed}", f"{folder}/narrow{seed}"
        early = "order_date < date'2001-03-01'"
        for part in (orders.filter(early), orders):
            want = retail.load_fct_orders(retail.int_orders_enriched(part, products), customers, wide, **at)
            got = retail.load_fct_orders(part, customers, narrow, products=products, **at)
            assert got.schema == want.schema
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_orders_move_by_id_before_they_get_prices(spark, frame):
    orders, customers, products = _shop(spark, frame, 1)
    plan = retail.priced_once(orders, customers, products)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    windows = [k for k, line in enumerate(plan) if "Window [" in line]
    joins = [k for k, line in enumerate(plan) if "Join LeftOuter" in line]
    assert len(joins) == 2 and windows[-1] > max(joins)  # deepest, so first


def test_stored_rows_move_once_in_an_upsert(spark, frame, folder, monkeypatch):
    plans, real = [], tables.replace_partitions

    def seen(rows, *args, **options):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return real(rows, *args, **options)

    monkeypatch.setattr(tables, "replace_partitions", seen)
    monkeypatch.setattr(tables, "balanced", lambda *columns: lambda rows: rows)  # the batch's own move
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        start = frame("k int, p string, v int", *((k, "ab"[k % 2], 0) for k in range(40)))
        tables.upsert_table(start, folder, ["k"], ["p"])
        tables.upsert_table(frame("k int, p string, v int", (1, "a", 1), (50, "c", 1)), folder, ["k"], ["p"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    (plan,) = plans
    assert plan.count("Exchange") == 2  # stored rows, and the keys to be replaced


def test_large_partitions_are_merged_in_shares(spark, frame, folder, monkeypatch):
    monkeypatch.setattr(tables, "SHARE_ROWS", 5)
    schema, want, r = "k int, p string, v int", {}, random.Random(4)
    for load in range(4):
        batch = {k: (r.choice(["a", "a", "a", "b", None]), load) for k in r.sample([None, *range(40)], 25)}
        want |= batch
        got = tables.upsert_table(frame(schema, *((k, *v) for k, v in batch.items())), folder, ["k"], ["p"])
        assert sorted(str((row.k, row.p, row.v)) for row in got.collect()) == sorted(str((k, *v)) for k, v in want.items())


def test_rows_are_replaced_in_the_partition_of_empty_text(frame, folder):
    schema = "k int, p string, v int"
    tables.upsert_table(frame(schema, (1, "", 0), (2, None, 0), (3, "a", 0)), folder, ["k"], ["p"])
    for load in (1, 2):
        got = tables.upsert_table(frame(schema, (1, "", load), (2, "", load)), folder, ["k"], ["p"])
        assert sorted((r["k"], r["v"]) for r in got.collect()) == [(1, load), (2, load), (3, 0)]


def test_the_index_is_built_in_one_move(spark, frame, folder, monkeypatch):
    monkeypatch.setattr(index, "KEYS_PER_BUCKET", 10)
    tables.upsert_table(frame("k int, p string", *((k, "ab"[k % 2]) for k in range(40))), folder, ["k"], ["p"])
    tables.upsert_table(frame("k int, p string", (99, "a")), folder, ["k"], ["p"])
    first = Folder(spark, tables.current_version(spark, folder) + "/_index/load=0")
    assert len(first.folders()) == 4
    for bucket in first.folders():  # each bucket came from one task
        assert len(list(spark.sparkContext._jvm.java.io.File(f"{first.path}/{bucket}").list())) <= 2  # a file and its checksum


def test_whole_rows_move_for_failing_key_checks_only(frame, folder, monkeypatch):
    real, looked = quality._none, []
    monkeypatch.setattr(quality, "_none", lambda rows: looked.append(rows.columns) or real(rows))
    data = {"parent": frame("id int", (1,), (2,)), "child": frame("k int, p int, q int", (1, 1, 1), (2, 2, 7), (2, None, None))}
    suites = {"child": [unique("k"), relationships("p", "parent", "id"), relationships("q", "parent", "id")]}
    got = {r["check"]: r["failures"] for r in build.check_all(data, suites, folder).collect()}
    assert list(got.values()) == [1, 0, 1]
    assert looked == [["k", "p", "q"]]  # the one that passes; rows of the others are looked for
    rows = [quality.read_failures(data["child"].sparkSession, c, f"{folder}/child").collect() for c in suites["child"]]
    assert [len(r) for r in rows] == [1, 0, 1] and rows[2][0]["k"] == 2


def test_shuffle_files_go_with_the_step_that_made_them(spark):
    def files():
        manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {name for name in manager.getAllFiles().mkString("\n").split("\n") if "shuffle_" in name}

    before = files()
    rows = spark.range(1000).repartition(4).groupBy("id").count()
    rows.write.format("noop").mode("overwrite").save()
    assert rows.count() == 1000 and len(rows.collect()) == len(rows.collect()) == 1000  # a frame may be used again
    for _ in range(50):
        if not files() - before:
            return
        time.sleep(0.2)
    raise AssertionError(files() - before)
