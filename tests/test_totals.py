"""Totals kept by partition, against a full run after every load."""

import datetime as dt
import glob
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from comparing import tuples
from pyspark.sql import functions as F

from orderloom.plans import o2c, receivables
from orderloom.sources.folders import Folder
from orderloom.sources.tables import current_version, read_table, upsert_table, write_table
from orderloom.sources.totals import ABOUT, Totals

SCHEMA = "id int, month string, kind string, v decimal(9,2)"


def money(n):
    return Decimal(n).quantize(Decimal("0.01"))


def totals(path, partition_by=("month",)):
    return Totals(
        f"{path}/totals",
        partition_by,
        {"kind": F.col("kind")},
        {"n": F.lit(1), "v": F.col("v")},
        {"first": F.col("id")},
        {"last": F.col("id")},
        where=F.col("id") >= 0,
    )


def full(rows):
    groups = defaultdict(list)
    for i, _, kind, v in rows:
        if i >= 0:
            groups[kind].append((i, v))
    return sorted(
        (
            (kind, len(g), sum((v for _, v in g if v is not None), 0) if any(v is not None for _, v in g) else None,
             min(i for i, _ in g), max(i for i, _ in g))
            for kind, g in groups.items()
        ),
        key=lambda r: tuple((v is not None, str(v)) for v in r),
    )


def spoil(spark, table, leaf):
    """Make a partition of a table unreadable, its file names as they were."""
    for name in glob.glob(f"{current_version(spark, table)}/{leaf}/*.parquet"):
        with open(name, "wb") as f:
            f.write(b"not a table")


def test_loads_in_any_order_give_what_a_full_run_gives(spark, folder):
    rnd, held, table = random.Random(4), {}, f"{folder}/table"
    kept = totals(folder)
    months = ["1995-01", "1995-02", "a b/c:%=", "", None]
    for _ in range(5):
        batch = {}
        for i in rnd.sample(range(-2, 30), 9):
            value = rnd.choice([None, *range(9)])
            batch[i] = (i, rnd.choice(months), rnd.choice(["x", "y", None]), None if value is None else money(value))
        held |= batch
        upsert_table(spark.createDataFrame(list(batch.values()), SCHEMA), table, ["id"], ["month"])
        kept.refresh(spark, table)
        assert tuples(kept.read(spark)) == full(held.values())
        assert kept.refresh(spark, table) == []


def test_only_partitions_that_a_load_has_changed_are_read(spark, folder):
    table, kept = f"{folder}/table", totals(folder)
    rows = [(i, f"1995-{i % 4 + 1:02d}", "x", money(i)) for i in range(40)]
    upsert_table(spark.createDataFrame(rows, SCHEMA), table, ["id"], ["month"])
    assert kept.refresh(spark, table) == [f"month=1995-{m:02d}" for m in range(1, 5)]
    # 0 moves from January to February
    upsert_table(spark.createDataFrame([(0, "1995-02", "y", money(7))], SCHEMA), table, ["id"], ["month"])
    spoil(spark, table, "month=1995-03")
    spoil(spark, table, "month=1995-04")
    assert kept.refresh(spark, table) == ["month=1995-01", "month=1995-02"]
    assert tuples(kept.read(spark)) == full([(0, "1995-02", "y", money(7)), *rows[1:]])


def test_a_partition_that_is_gone_takes_its_totals_along(spark, folder):
    table, kept = f"{folder}/table", totals(folder)
    upsert_table(spark.createDataFrame([(1, "a", "x", None), (2, "b", "x", None)], SCHEMA), table, ["id"], ["month"])
    kept.refresh(spark, table)
    upsert_table(spark.createDataFrame([(1, "b", "z", None)], SCHEMA), table, ["id"], ["month"])
    assert kept.refresh(spark, table) == ["month=b"]
    assert tuples(kept.read(spark)) == [("x", 1, None, 2, 2), ("z", 1, None, 1, 1)]


def test_rebuilds_other_definitions_and_lost_refreshes_are_read_whole(spark, folder):
    table, kept = f"{folder}/table", totals(folder)
    rows = spark.createDataFrame([(1, "a", "x", None), (2, "b", "x", None)], SCHEMA)
    write_table(rows, table, ["month"])
    assert kept.refresh(spark, table) == ["month=a", "month=b"]
    write_table(rows, table, ["month"])
    assert kept.refresh(spark, table) == ["month=a", "month=b"]
    other = Totals(kept.path, ("month",), {}, {"n": F.lit(1)})
    assert other.refresh(spark, table) == ["month=a", "month=b"]
    assert tuples(other.read(spark)) == [(2,)]
    Folder(spark, current_version(spark, kept.path)).delete(ABOUT)
    assert other.refresh(spark, table) == ["month=a", "month=b"]


def test_tables_without_partitions_and_without_rows(spark, folder):
    table, kept = f"{folder}/table", totals(folder, ())
    none = spark.createDataFrame([], SCHEMA)
    write_table(none, table)
    kept.refresh(spark, table)
    assert tuples(kept.read(spark)) == []
    write_table(spark.createDataFrame([(1, "a", "x", None)], SCHEMA), table)
    assert kept.refresh(spark, table) == [""]
    assert tuples(kept.read(spark)) == [("x", 1, None, 1, 1)]
    with pytest.raises(FileNotFoundError):
        kept.refresh(spark, f"{folder}/nothing")
    with pytest.raises(ValueError, match="kind"):
        Totals(folder, (), {"kind": F.col("kind")}, {"Kind": F.lit(1)})


D = dt.date
INVOICES = (
    "invoice_id string, order_id string, customer_id string, invoice_date date, due_date date, invoice_amount decimal(18,2), "
    "payment_status string"
)
PAYMENTS = "payment_id string, invoice_id string, payment_date date, amount decimal(18,2), is_duplicate_flag boolean"


def test_receivables_after_a_load_equal_a_full_run(spark, folder):
    def invoice(i, month, amount, status="OUTSTANDING", customer="C1"):
        return f"I{i}", f"O{i}", customer, D(2024, month, 3), D(2024, month, 28) if i % 3 else None, money(amount), status

    def payment(i, of, amount):
        return f"P{i}", of, D(2024, 5, 1), money(amount), False

    first = [invoice(i, 1 + i % 3, 100 + i, customer=f"C{i % 2}") for i in range(9)]
    paid = [payment(1, "I1", 40)]
    load = lambda rows, schema: spark.createDataFrame(rows, schema)
    receivables.load_balances(o2c.invoice_balances(load(first, INVOICES), load(paid, PAYMENTS)), folder)
    # a payment, a status and an invoice later: months 2 and 6 change, 1 and 3 do not
    now = [invoice(4, 2, 104, "PAID", "C0") if r[0] == "I4" else r for r in first] + [invoice(20, 6, 7, customer="C9")]
    paid += [payment(2, "I1", 11)]
    changed = spark.createDataFrame([("I1",), ("I4",), ("I20",), (None,), ("I1",)], "invoice_id string")
    for month in (1, 3):
        for name in ("open_by_due_date", "sales_by_customer"):
            assert read_table(spark, f"{folder}/{name}").filter(f"period = '2024-{month:02d}'").count()
    batch = receivables.changed_balances(load(now, INVOICES), load(paid, PAYMENTS), changed)
    assert batch.count() == 3
    touched = ["period=2024-02", "period=2024-06"]
    assert receivables.load_balances(batch, folder) == {"aging": touched, "dso": touched}
    whole = o2c.invoice_balances(load(now, INVOICES), load(paid, PAYMENTS))
    aging = receivables.kept_aging_summary(receivables.open_by_due_date(folder).read(spark), D(2024, 4, 1))
    assert tuples(aging) == tuples(receivables.aging_summary(whole, D(2024, 4, 1)))
    dso = receivables.kept_dso(receivables.sales_by_customer(folder).read(spark), 365)
    assert tuples(dso) == tuples(receivables.dso(whole, ["customer_id"], 365))
