"""Results of checks that are kept up to date, against a full run after every load."""

import random

import pytest
from comparing import tuples
from test_totals import spoil

from orderloom.operators.quality import accepted, between, not_null, relationships, run_checks, unique
from orderloom.sources import check_state
from orderloom.sources.check_state import CheckState, StoredTable
from orderloom.sources.tables import read_table, upsert_table, write_table

SCHEMA = "id int, month string, code string, ref int, v int"
CHECKS = [
    not_null("code"),
    accepted("code", ["a", "b"]),
    between("v", 0, 5),
    unique("code"),
    unique("v").where("month = 'm1'"),
    relationships("ref", "parent", "key"),
]


def state(folder):
    return CheckState(
        f"{folder}/state",
        StoredTable(f"{folder}/table", ["month"]),
        CHECKS,
        {"parent": StoredTable(f"{folder}/parent", ["part"])},
        buckets=8,
    )


def full(spark, folder):
    return tuples(run_checks(read_table(spark, f"{folder}/table"), CHECKS, {"parent": read_table(spark, f"{folder}/parent")}))


def test_report_after_every_load_equals_a_full_run(spark, folder):
    rnd, kept = random.Random(8), state(folder)
    for _ in range(4):
        rows = [
            (i, rnd.choice(["m1", "m2", "m3", None]), rnd.choice(["a", "b", "c", f"x{i}", None]), rnd.choice([*range(9), None]), rnd.randrange(-1, 8))
            for i in rnd.sample(range(40), 12)
        ]
        upsert_table(spark.createDataFrame(rows, SCHEMA), f"{folder}/table", ["id"], ["month"])
        parents = [(str(k), f"p{k % 2}") for k in rnd.sample(range(9), 3)]
        upsert_table(spark.createDataFrame(parents, "key string, part string"), f"{folder}/parent", ["key"], ["part"])
        kept.refresh(spark)
        assert tuples(kept.report(spark)) == full(spark, folder)
    assert not any(kept.refresh(spark).values())


def test_only_changed_partitions_and_buckets_are_read(spark, folder, monkeypatch):
    kept = state(folder)
    rows = [(i, f"m{i % 4}", f"x{i}", i, i % 6) for i in range(200)]
    upsert_table(spark.createDataFrame(rows, SCHEMA), f"{folder}/table", ["id"], ["month"])
    write_table(spark.createDataFrame([(str(i), "p") for i in range(199)], "key string, part string"), f"{folder}/parent", ["part"])
    kept.refresh(spark)
    looked_at = []
    of = check_state.KeyCounts.of
    monkeypatch.setattr(check_state.KeyCounts, "of", lambda self, s, buckets: looked_at.append(len(buckets)) or of(self, s, buckets))
    # one row more, in a month of its own, with the code and the reference of another
    upsert_table(spark.createDataFrame([(500, "m9", "x7", 7, 3)], SCHEMA), f"{folder}/table", ["id"], ["month"])
    expected = full(spark, folder)
    for month in range(4):
        spoil(spark, f"{folder}/table", f"month=m{month}")
    spoil(spark, f"{folder}/parent", "part=p")
    read = kept.refresh(spark)
    assert {tuple(v) for v in read.values()} == {("month=m9",), ()}
    assert looked_at == [1, 1, 1]  # of unique_code, of the references and of their parent
    assert tuples(kept.report(spark)) == expected
    assert dict((r[0], r[2]) for r in expected)["unique_code"] == 1


def test_a_row_that_moves_to_another_partition_counts_no_bucket_again(spark, folder, monkeypatch):
    kept = state(folder)
    upsert_table(spark.createDataFrame([(1, "m2", "a", 1, 1), (2, "m3", "b", 2, 2)], SCHEMA), f"{folder}/table", ["id"], ["month"])
    write_table(spark.createDataFrame([("1", "p")], "key string, part string"), f"{folder}/parent", ["part"])
    kept.refresh(spark)
    upsert_table(spark.createDataFrame([(1, "m3", "a", 1, 1)], SCHEMA), f"{folder}/table", ["id"], ["month"])
    monkeypatch.setattr(check_state.KeyCounts, "of", lambda *_: pytest.fail("nothing to count"))
    kept.refresh(spark)
    assert tuples(kept.report(spark)) == full(spark, folder)


def test_an_empty_table_fails_nothing(spark, folder):
    kept = state(folder)
    write_table(spark.createDataFrame([], SCHEMA), f"{folder}/table", ["month"])
    write_table(spark.createDataFrame([], "key string, part string"), f"{folder}/parent", ["part"])
    kept.refresh(spark)
    assert {(r.failures, r.passed) for r in kept.report(spark).collect()} == {(0, True)}


def test_a_lost_recount_is_made_up_for(spark, folder, monkeypatch):
    kept = state(folder)
    write_table(spark.createDataFrame([("1", "p")], "key string, part string"), f"{folder}/parent", ["part"])
    upsert_table(spark.createDataFrame([(1, "m2", "a", 1, 1)], SCHEMA), f"{folder}/table", ["id"], ["month"])
    kept.refresh(spark)
    upsert_table(spark.createDataFrame([(2, "m3", "a", 5, 1)], SCHEMA), f"{folder}/table", ["id"], ["month"])
    with monkeypatch.context() as lost:
        lost.setattr(CheckState, "_recount", lambda *_: None)
        kept.refresh(spark)
    kept.refresh(spark)
    assert tuples(kept.report(spark)) == full(spark, folder)
