import datetime as dt
from decimal import Decimal as D

import pytest
from comparing import tuples

from orderloom.operators.quality import (
    RowCounts, accepted, between, failing, matches, not_null, read_failures, relationships, report_written, run_checks, store_failures,
    stored_report, unique,
)
from orderloom.plans import build, checks
from orderloom.sources.tables import range_sort, write_table

SCHEMA = "id string, ref string, status string, amount decimal(10,2), d date"


@pytest.fixture
def rows(frame):
    day = dt.date(2024, 1, 1)
    return frame(
        SCHEMA,
        ("X_1", "p", "OK", D(5), day),
        ("X_1", "q", "ODD", D(0), dt.date(2019, 1, 1)),
        ("Y_2", "q", None, D(10), None),
        (None, None, "OK", D(11), day),
        (None, "p", "ODD", D(-1), day),
    )


SUITE = [
    unique("id"),
    not_null("id"),
    accepted("status", ["OK"]),
    accepted("status", ["OK"]).where("amount > 0"),
    relationships("ref", "parent", "k"),
    between("amount", 0, 10),
    between("amount", 6, None),
    between("d", dt.date(2020, 1, 1), dt.date(2030, 1, 1)),
    matches("id", "^X_[0-9]+$"),
]


def test_report(rows, frame):
    report = run_checks(rows, SUITE, {"parent": frame("k string", ("p",), (None,))})
    rows_of = {r.check: (r.failures, r.passed) for r in report.collect()}
    assert set(rows_of) == {c.name for c in SUITE}  # no two checks share a name
    got = sorted((c.name.split("_where_")[0] if c.kind != "matches" else "matches_id", *rows_of[c.name]) for c in SUITE)
    assert got == [
        ("accepted_status", 0, True),
        ("accepted_status", 2, False),
        ("between_amount_0_10", 2, False),
        ("between_amount_6_any", 3, False),
        ("between_d_2020-01-01_2030-01-01", 1, False),
        ("matches_id", 1, False),
        ("not_null_id", 2, False),
        ("relationships_ref_parent", 2, False),
        ("unique_id", 1, False),
    ]


def test_row_checks_share_one_scan(rows, spark, folder):
    rows.write.parquet(f"{folder}/rows")
    plan = run_checks(spark.read.parquet(f"{folder}/rows"), [not_null("id"), accepted("status", ["OK"]), between("amount", 0, 1)])
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


@pytest.mark.parametrize("layout", [None, range_sort("amount")])
def test_rows_are_counted_as_they_are_written(rows, frame, folder, layout):
    counts = RowCounts(SUITE)
    stored = write_table(rows, folder, layout=layout, counts=counts)
    parents = {"parent": frame("k string", ("p",), (None,))}
    assert tuples(report_written(stored, SUITE, counts.failures(), parents)) == tuples(run_checks(rows, SUITE, parents))


def test_counts_of_an_empty_table_and_of_no_checks(rows, folder):
    counts = RowCounts(SUITE)
    write_table(rows.filter("amount > 100"), f"{folder}/a", counts=counts)
    assert set(counts.failures().values()) == {0} and len(counts.failures()) == 7
    counts = RowCounts([])
    write_table(rows, f"{folder}/b", counts=counts)
    assert counts.failures() == {}


def test_report_of_a_written_table_reads_keys_only(rows, frame, folder):
    """Nothing for row-level checks, and one scan of two columns for all others."""
    plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()
    by_row, counts = [c for c in SUITE if c.kind not in ("unique", "relationships")], RowCounts(SUITE)
    stored = write_table(rows, folder, counts=counts)
    assert "FileScan" not in plan_of(report_written(stored, by_row, counts.failures()))
    plan = plan_of(report_written(stored, SUITE, counts.failures(), {"parent": frame("k string", ("p",))}))
    assert plan.count("FileScan") == 1 and "ReadSchema: struct<id:string,ref:string>" in plan


def test_failing_rows_are_stored_for_failing_checks_only(rows, frame, spark, folder):
    suite = [unique("id"), not_null("amount"), accepted("status", ["OK"]), relationships("ref", "parent", "k")]
    data = {"parent": frame("k string", ("p",), ("q",))}

    def run(df):
        counts = RowCounts(suite)
        data["t"] = write_table(df, f"{folder}/t", counts=counts)
        return build.check_all(data, {"t": suite}, f"{folder}/bad", {"t": counts.failures()}).drop("dataset")

    assert tuples(run(rows)) == tuples(run_checks(rows, suite, data))
    for check in suite:
        assert tuples(read_failures(spark, check, f"{folder}/bad/t")) == tuples(failing(rows, check, data))
    good = rows.filter("id = 'Y_2'")
    assert {r.passed for r in run(good).collect()} == {True}
    for check in suite:  # what the first run had stored is gone
        assert read_failures(spark, check, f"{folder}/bad/t").count() == 0


def test_failures_are_stored_and_read_back(rows, frame, spark, folder):
    parents = {"parent": frame("k string", ("p",))}
    suite = [unique("id"), not_null("id"), accepted("status", ["OK"]), relationships("ref", "parent", "k")]
    assert store_failures(rows, suite, folder, parents) == [
        "unique_id", "not_null_id", "accepted_status", "relationships_ref_parent",
    ]
    for check in suite:
        assert tuples(read_failures(spark, check, folder)) == tuples(failing(rows, check, parents))
    assert tuples(failing(rows, suite[0])) == [("X_1", 2)]
    assert tuples(stored_report(spark, suite, folder)) == tuples(run_checks(rows, suite, parents))


def test_passing_checks_are_stored_and_read_back(rows, frame, spark, folder):
    suite = [not_null("status").where("false"), unique("id").where("false")]
    store_failures(rows, suite, folder)
    assert [read_failures(spark, c, folder).count() for c in suite] == [0, 0]
    assert tuples(stored_report(spark, suite, folder).select("failures", "passed")) == [(0, True)] * 2


def test_names_tell_checks_apart():
    suite = [between("a", 0, 1), between("a", 0, 2), between("a", 0, None), between("a", 0, 1).where("b"), matches("a", "x"), matches("a", "y")]
    assert len({c.name for c in suite}) == len(suite)


def test_every_declared_check_is_there():
    count = lambda suites: sum(len(s) for s in suites.values())
    assert (count(checks.RETAIL), count(checks.O2C)) == (30, 50)
    kinds = [c.kind for family in (checks.RETAIL, checks.O2C) for suite in family.values() for c in suite]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "unique": 17, "not_null": 37, "accepted": 15, "relationships": 5, "between": 6,
    }
    scoped = [c for suite in checks.O2C.values() for c in suite if c.scope]
    assert len(scoped) == 5
    for family in (checks.RETAIL, checks.O2C, checks.DOCUMENTED_RETAIL, checks.DOCUMENTED_O2C):
        for suite in family.values():
            assert len({c.name for c in suite}) == len(suite)
