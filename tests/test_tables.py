import datetime as dt
import os

import pytest
from comparing import tuples

from orderloom.operators.incremental import SchemaChangedError
from orderloom.sources import tables
from orderloom.sources.folders import Folder
from orderloom.sources.tables import (
    current_version, drop_old_versions, newest_partition, partition_folder, range_sort, read_history, read_table,
    snapshot_table, upsert_table, write_table,
)

SCHEMA = "id string, d date, v int"
D = dt.date


def test_rebuild_may_read_what_it_replaces(spark, frame, folder):
    write_table(frame("k int", (1,), (2,)), folder)
    write_table(read_table(spark, folder).filter("k > 1"), folder)
    assert tuples(read_table(spark, folder)) == [(2,)]
    assert current_version(spark, folder).endswith("v_000002")
    assert drop_old_versions(spark, folder, keep=1) == ["v_000001"]
    assert tuples(read_table(spark, folder)) == [(2,)]


def test_unfinished_version_is_ignored(spark, frame, folder):
    write_table(frame("k int", (1,)), folder)
    os.makedirs(f"{folder}/v_000002")
    assert tuples(read_table(spark, folder)) == [(1,)]
    write_table(frame("k int", (3,)), folder)
    assert current_version(spark, folder).endswith("v_000003")


def test_missing_table(spark, folder):
    assert newest_partition(spark, folder + "/none", "d") is None
    with pytest.raises(FileNotFoundError):
        read_table(spark, folder + "/none")


def test_range_sorted_files_cover_narrow_ranges(spark, folder):
    df = spark.range(1000).selectExpr("id", "cast(id % 10 as int) as day")
    write_table(df, folder, layout=range_sort("day"))
    assert read_table(spark, folder).count() == 1000


def test_upsert_moves_rows_between_partitions(spark, frame, folder):
    first = frame(SCHEMA, ("a", D(2024, 1, 1), 1), ("b", D(2024, 1, 2), 2), ("c", D(2024, 1, 3), 3), ("n", None, 4))
    upsert_table(first, folder, ["id"], ["d"])
    batch = frame(SCHEMA, ("b", D(2024, 1, 3), 20), ("e", D(2024, 1, 4), 5), ("e", D(2024, 1, 4), 6), ("n", None, 40))
    expected = [
        ("a", D(2024, 1, 1), 1), ("b", D(2024, 1, 3), 20), ("c", D(2024, 1, 3), 3), ("e", D(2024, 1, 4), 5),
        ("n", None, 40),
    ]
    for _ in range(2):  # the second time is a replay
        got = upsert_table(batch, folder, ["id"], ["d"], order_by=["v"])
        assert tuples(got.select("id", "d", "v")) == expected
    version = current_version(spark, folder)
    assert "d=2024-01-02" not in os.listdir(version)  # the row that was there has moved
    assert not [n for n in os.listdir(version) if n in ("_batch", "_staged")]
    assert tuples(newest_partition(spark, folder, "d")) == [("e", 5)]


def test_upsert_leaves_other_partitions_alone(spark, frame, folder):
    upsert_table(frame(SCHEMA, ("a", D(2024, 1, 1), 1), ("b", D(2024, 1, 2), 2)), folder, ["id"], ["d"])
    untouched = f"{current_version(spark, folder)}/d=2024-01-01"
    before = sorted(os.listdir(untouched))
    upsert_table(frame(SCHEMA, ("b", D(2024, 1, 2), 9)), folder, ["id"], ["d"])
    assert sorted(os.listdir(untouched)) == before


def test_upsert_by_two_partition_columns(spark, frame, folder):
    schema = "id int, y int, s string, v int"
    upsert_table(frame(schema, (1, 2023, "x/y", 1), (2, 2024, None, 2)), folder, ["id"], ["y", "s"])
    got = upsert_table(frame(schema, (1, 2024, "z", 10), (2, 2024, None, 20)), folder, ["id"], ["y", "s"])
    assert tuples(got.select("id", "y", "s", "v")) == [(1, 2024, "z", 10), (2, 2024, None, 20)]


def test_upsert_into_an_empty_table_and_full_refresh(spark, frame, folder):
    upsert_table(frame(SCHEMA), folder, ["id"], ["d"])
    upsert_table(frame(SCHEMA, ("a", D(2024, 1, 1), 1)), folder, ["id"], ["d"])
    got = upsert_table(frame(SCHEMA, ("b", D(2024, 1, 1), 1)), folder, ["id"], ["d"], full_refresh=True)
    assert tuples(got.select("id")) == [("b",)]


def test_upsert_refuses_other_columns(spark, frame, folder):
    upsert_table(frame(SCHEMA, ("a", D(2024, 1, 1), 1)), folder, ["id"], ["d"])
    with pytest.raises(SchemaChangedError):
        upsert_table(frame(SCHEMA + ", w int", ("a", D(2024, 1, 1), 1, 1)), folder, ["id"], ["d"])


def test_bounded_search_for_old_rows(spark, frame, folder):
    upsert_table(frame(SCHEMA, ("a", D(2024, 1, 1), 1), ("b", D(2024, 2, 1), 2)), folder, ["id"], ["d"])
    batch = frame(SCHEMA, ("b", D(2024, 2, 2), 20))
    got = upsert_table(batch, folder, ["id"], ["d"], old_rows_in="d >= '2024-02-01'")
    assert tuples(got.select("id", "d", "v")) == [("a", D(2024, 1, 1), 1), ("b", D(2024, 2, 2), 20)]


def test_driver_lost_during_the_swap(spark, frame, folder, monkeypatch):
    upsert_table(frame(SCHEMA, ("a", D(2024, 1, 1), 1), ("b", D(2024, 1, 2), 2)), folder, ["id"], ["d"])
    moves = []

    def dies_at_second(self, other, child, real=Folder.move_in):
        if moves:
            raise KeyboardInterrupt
        moves.append(child)
        real(self, other, child)

    monkeypatch.setattr(Folder, "move_in", dies_at_second)
    batch = frame(SCHEMA, ("a", D(2024, 1, 3), 10), ("b", D(2024, 1, 2), 20))
    with pytest.raises(KeyboardInterrupt):
        upsert_table(batch, folder, ["id"], ["d"])
    monkeypatch.undo()
    expected = [("a", D(2024, 1, 3), 10), ("b", D(2024, 1, 2), 20)]
    assert tuples(read_table(spark, folder).select("id", "d", "v")) == expected
    staged = f"{current_version(spark, folder)}/_staged"
    assert os.path.exists(staged)  # reading has not finished the swap, the next load does
    got = upsert_table(frame(SCHEMA, ("c", D(2024, 1, 5), 5)), folder, ["id"], ["d"])
    assert tuples(got.select("id", "d", "v")) == [*expected, ("c", D(2024, 1, 5), 5)]
    assert not os.path.exists(staged)


def test_driver_lost_before_the_swap(spark, frame, folder, monkeypatch):
    upsert_table(frame(SCHEMA, ("a", D(2024, 1, 1), 1)), folder, ["id"], ["d"])

    def dies(self, child, value):
        raise KeyboardInterrupt

    monkeypatch.setattr(Folder, "write_json", dies)
    with pytest.raises(KeyboardInterrupt):
        upsert_table(frame(SCHEMA, ("a", D(2024, 1, 1), 5)), folder, ["id"], ["d"])
    monkeypatch.undo()
    assert tuples(read_table(spark, folder).select("id", "v")) == [("a", 1)]
    got = upsert_table(frame(SCHEMA, ("a", D(2024, 1, 1), 6)), folder, ["id"], ["d"])
    assert tuples(got.select("id", "v")) == [("a", 6)]


def test_partition_folder_names():
    assert partition_folder("p", None) == "p=__HIVE_DEFAULT_PARTITION__"
    assert partition_folder("p", "a/b:c") == "p=a%2Fb%3Ac"
    assert partition_folder("p", "2024-01-02") == "p=2024-01-02"


def test_upsert_without_partitions_keeps_the_rest(spark, frame, folder):
    upsert_table(frame("id string, v int", ("a", 1), ("b", 2), ("c", 3)), folder, ["id"])
    got = upsert_table(frame("id string, v int", ("b", 20), ("d", 4)), folder, ["id"])
    assert tuples(got) == tuples(read_table(spark, folder)) == [("a", 1), ("b", 20), ("c", 3), ("d", 4)]


def test_partition_column_with_an_underscore(spark, frame, folder):
    schema = "id string, _p string, v int"
    upsert_table(frame(schema, ("a", "x", 1), ("b", "x", 2)), folder, ["id"], ["_p"])
    got = upsert_table(frame(schema, ("b", "y", 20)), folder, ["id"], ["_p"])
    assert tuples(got.select("id", "_p", "v")) == [("a", "x", 1), ("b", "y", 20)]


@pytest.mark.parametrize("kind, one, two", [("double", 1.0, 2.5e10), ("timestamp", dt.datetime(2024, 1, 1, 1, 2, 3, 500000), dt.datetime(2024, 1, 2)), ("boolean", True, False)])
def test_rows_leave_partitions_of_any_type(spark, frame, folder, kind, one, two):
    schema = f"id string, p {kind}, v int"
    upsert_table(frame(schema, ("a", one, 1), ("b", two, 2)), folder, ["id"], ["p"])
    got = upsert_table(frame(schema, ("a", two, 10)), folder, ["id"], ["p"])
    assert tuples(got.select("id", "p", "v")) == [("a", two, 10), ("b", two, 2)]


def test_null_keys_are_replaced_like_others(spark, frame, folder):
    schema = "id string, d date, v int"
    upsert_table(frame(schema, ("a", D(2024, 1, 1), 1), (None, D(2024, 1, 1), 2)), folder, ["id"], ["d"])
    for _ in range(2):
        got = upsert_table(frame(schema, (None, D(2024, 1, 2), 20)), folder, ["id"], ["d"])
        assert tuples(got.select("id", "d", "v")) == [(None, D(2024, 1, 2), 20), ("a", D(2024, 1, 1), 1)]


def test_many_touched_partitions_of_two_columns(spark, folder):
    rows = spark.range(600).selectExpr("id", "id % 20 as y", "cast(id % 30 as string) as s", "id as v")
    upsert_table(rows, folder, ["id"], ["y", "s"])
    got = upsert_table(rows.selectExpr("id", "y", "s", "v + 1 as v"), folder, ["id"], ["y", "s"])
    assert got.count() == 600 and got.where("v = id + 1").count() == 600


def test_types_of_partition_values_are_kept(spark, frame, folder):
    write_table(frame("id int, zip string", (1, "02109"), (2, None)), folder, ["zip"])
    assert tuples(read_table(spark, folder).select("id", "zip")) == [(1, "02109"), (2, None)]
    assert read_table(spark, folder).schema["zip"].dataType.simpleString() == "string"


def test_the_search_for_old_rows_prunes_partitions(spark, frame, folder):
    """Only partitions inside the bound are listed by the scan that looks for old keys."""
    upsert_table(frame(SCHEMA, *[("k%d" % i, D(2024, 1, i), i) for i in range(1, 20)]), folder, ["id"], ["d"])
    stored = read_table(spark, folder).filter("d >= '2024-01-18'")
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan and stored.count() == 2
    got = upsert_table(frame(SCHEMA, ("k19", D(2024, 1, 20), 0)), folder, ["id"], ["d"], old_rows_in="d >= '2024-01-18'")
    assert got.count() == 19


def test_snapshot_rewrites_open_versions_only(spark, frame, folder):
    schema = "k string, tier string"
    runs = [dt.datetime(2024, m, 1) for m in (1, 2, 3)]
    states = [
        frame(schema, ("a", "X"), ("b", "X"), (None, "X")),
        frame(schema, ("a", "Y"), ("b", "X")),
        frame(schema, ("a", "Z"), ("b", "X"), ("c", "X")),
    ]
    for now, state in zip(runs, states):
        snapshot_table(state, folder, ["k"], ["tier"], now)
        snapshot_table(state, folder, ["k"], ["tier"], now)  # replay
    got = tuples(read_history(spark, folder).select("k", "tier", "valid_from", "valid_to"))
    assert got == [
        ("a", "X", runs[0], runs[1]), ("a", "Y", runs[1], runs[2]), ("a", "Z", runs[2], None),
        ("b", "X", runs[0], None), ("c", "X", runs[2], None),
    ]
    segments = [n for n in os.listdir(current_version(spark, folder)) if n.startswith("segment=")]
    assert len(segments) == 3


def test_views_and_stamps(spark, frame):
    tables.as_view(frame("k int", (1,)), "some_view")
    assert spark.table("some_view").count() == 1
    at = dt.datetime(2024, 1, 1, 12)
    assert tables.with_loaded_at(frame("k int", (1,)), at).first().loaded_at == at
    assert tables.with_loaded_at(frame("k int", (1,))).schema["loaded_at"].dataType.typeName() == "timestamp"
