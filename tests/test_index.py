"""The index of keys, and what loads have changed, against plain sets and dictionaries."""

import datetime as dt
import os
import random
import re

import pytest
from comparing import tuples

from orderloom.operators.changes import detect_changes
from orderloom.sources import index as indexes
from orderloom.sources.folders import Folder
from orderloom.sources.tables import current_version, last_load, read_changes, read_table, upsert_table

SCHEMA = "id string, d date, v int"
D = dt.date


def files(spark, path):
    version = current_version(spark, path)
    return sorted(
        os.path.relpath(os.path.join(at, f), version) for at, _, names in os.walk(version) for f in names if f.endswith(".parquet")
    )


def scans(spark, work):
    """Paths that ``work`` reads Parquet from."""
    seen = []
    real = type(spark.read).parquet

    def parquet(self, *paths, **options):
        seen.extend(paths)
        return real(self, *paths, **options)

    type(spark.read).parquet = parquet
    try:
        work()
    finally:
        type(spark.read).parquet = real
    return seen


def test_random_loads_equal_a_dictionary(spark, frame, folder, monkeypatch):
    monkeypatch.setattr(indexes, "LOADS", 3)  # the index is built anew on the way
    rnd = random.Random(11)
    model = {}
    for load in range(8):
        batch = {}
        for _ in range(12):
            key = rnd.choice([None, "", *"abcdefghij"])
            batch[key] = (rnd.choice([None, D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 3)]), rnd.choice([None, 0, 1, 2]))
        model.update(batch)
        upsert_table(frame(SCHEMA, *[(k, *v) for k, v in batch.items()]), folder, ["id"], ["d"])
        got = sorted((tuple(r) for r in read_table(spark, folder).select("id", "d", "v").collect()), key=repr)
        assert got == sorted(((k, *v) for k, v in model.items()), key=repr), load


def test_a_replay_rewrites_nothing(spark, frame, folder):
    rows = [(f"k{i}", D(2024, 1, 1 + i % 3), i) for i in range(30)]
    upsert_table(frame(SCHEMA, *rows), folder, ["id"], ["d"])
    upsert_table(frame(SCHEMA, *rows), folder, ["id"], ["d"])
    before = files(spark, folder)
    upsert_table(frame(SCHEMA, *rows), folder, ["id"], ["d"])
    assert files(spark, folder) == before and last_load(spark, folder) == 0
    rows[4] = ("k4", D(2024, 1, 2), 400)  # one partition of three
    upsert_table(frame(SCHEMA, *rows), folder, ["id"], ["d"])
    after = files(spark, folder)
    assert [f for f in before if f.startswith("d=") and f not in after] == [f for f in before if f.startswith("d=2024-01-02")]
    assert last_load(spark, folder) == 1 and read_table(spark, folder).where("v = 400").count() == 1


def test_ignored_columns_keep_what_is_stored(spark, frame, folder):
    schema = SCHEMA + ", loaded int"
    upsert_table(frame(schema, ("a", D(2024, 1, 1), 1, 1), ("b", D(2024, 1, 1), 1, 1)), folder, ["id"], ["d"])
    batch = frame(schema, ("a", D(2024, 1, 1), 1, 2), ("b", D(2024, 1, 1), 5, 2))
    got = upsert_table(batch, folder, ["id"], ["d"], ignore=["loaded"])
    assert tuples(got.select("id", "v", "loaded")) == [("a", 1, 1), ("b", 5, 2)]


def test_a_load_reads_its_buckets_and_touched_partitions_only(spark, frame, folder, monkeypatch):
    monkeypatch.setattr(indexes, "KEYS_PER_BUCKET", 20)
    rows = [(f"k{i}", D(2024, 1, 1 + i % 28), i) for i in range(280)]
    upsert_table(frame(SCHEMA, *rows), folder, ["id"], ["d"])
    upsert_table(frame(SCHEMA, ("k0", D(2024, 1, 1), -1)), folder, ["id"], ["d"])  # builds the index
    plans = []
    judged = indexes.KeyIndex.judged

    def watched(self, marked, buckets):
        made = judged(self, marked, buckets)
        plans.append((buckets, made._jdf.queryExecution().executedPlan().toString()))
        return made

    monkeypatch.setattr(indexes.KeyIndex, "judged", watched)
    paths = scans(spark, lambda: upsert_table(frame(SCHEMA, ("k5", D(2024, 1, 20), -5)), folder, ["id"], ["d"]))
    version = current_version(spark, folder)
    (buckets, plan), = plans
    assert len(buckets) == 1 and re.search(rf"PartitionFilters: \[[^]]*\(bucket#\d+ = {buckets[0]}\)", plan)
    leaves = {p for p in paths if "/d=" in p}
    assert leaves == {f"{version}/d=2024-01-06", f"{version}/d=2024-01-20"}
    # apart from these: the batch, the index, and the whole version only to hand it back
    assert paths.count(version) == 1
    assert tuples(read_table(spark, folder).where("id in ('k0', 'k5')").select("id", "d", "v")) == [
        ("k0", D(2024, 1, 1), -1), ("k5", D(2024, 1, 20), -5),
    ]


def test_a_table_with_repeated_keys_gets_rid_of_all_old_rows(spark, frame, folder):
    upsert_table(frame(SCHEMA, ("a", D(2024, 1, 1), 1), ("a", D(2024, 1, 2), 1), ("a", D(2024, 1, 2), 2), ("b", D(2024, 1, 1), 1)), folder, ["id"], ["d"])
    got = upsert_table(frame(SCHEMA, ("a", D(2024, 1, 1), 1)), folder, ["id"], ["d"])
    assert tuples(got.select("id", "d", "v")) == [("a", D(2024, 1, 1), 1), ("b", D(2024, 1, 1), 1)]


def test_bounded_search_gives_the_index_up(spark, frame, folder):
    upsert_table(frame(SCHEMA, ("a", D(2024, 1, 1), 1), ("b", D(2024, 2, 1), 2)), folder, ["id"], ["d"])
    upsert_table(frame(SCHEMA, ("b", D(2024, 2, 1), 3)), folder, ["id"], ["d"])
    upsert_table(frame(SCHEMA, ("b", D(2024, 2, 2), 4)), folder, ["id"], ["d"], old_rows_in="d >= '2024-02-01'")
    got = upsert_table(frame(SCHEMA, ("b", D(2024, 1, 1), 3)), folder, ["id"], ["d"])
    assert tuples(got.select("id", "d", "v")) == [("a", D(2024, 1, 1), 1), ("b", D(2024, 1, 1), 3)]


def test_driver_lost_before_the_swap_leaves_the_index_as_it_was(spark, frame, folder, monkeypatch):
    upsert_table(frame(SCHEMA, ("a", D(2024, 1, 1), 1)), folder, ["id"], ["d"])
    upsert_table(frame(SCHEMA, ("a", D(2024, 1, 1), 2)), folder, ["id"], ["d"])
    batch = frame(SCHEMA, ("a", D(2024, 1, 1), 3))

    def dies(self, child, value, real=Folder.write_json):
        if child == "_ready":
            raise KeyboardInterrupt
        real(self, child, value)

    monkeypatch.setattr(Folder, "write_json", dies)
    with pytest.raises(KeyboardInterrupt):
        upsert_table(batch, folder, ["id"], ["d"])
    monkeypatch.undo()
    assert last_load(spark, folder) == 1
    assert tuples(upsert_table(batch, folder, ["id"], ["d"]).select("id", "v")) == [("a", 3)]


def test_driver_lost_during_the_swap_takes_the_index_along(spark, frame, folder, monkeypatch):
    upsert_table(frame(SCHEMA, ("a", D(2024, 1, 1), 1)), folder, ["id"], ["d"])
    upsert_table(frame(SCHEMA, ("a", D(2024, 1, 1), 2)), folder, ["id"], ["d"])

    def dies(self, other, child, real=Folder.move_in):
        if child.startswith("_index"):
            raise KeyboardInterrupt
        real(self, other, child)

    monkeypatch.setattr(Folder, "move_in", dies)
    with pytest.raises(KeyboardInterrupt):
        upsert_table(frame(SCHEMA, ("a", D(2024, 1, 2), 3)), folder, ["id"], ["d"])
    monkeypatch.undo()
    got = upsert_table(frame(SCHEMA, ("a", D(2024, 1, 1), 2)), folder, ["id"], ["d"])
    assert tuples(got.select("id", "d", "v")) == [("a", D(2024, 1, 1), 2)]
    assert last_load(spark, folder) == 3


def test_changes_since_a_load(spark, frame, folder, monkeypatch):
    upsert_table(frame(SCHEMA, *[(k, D(2024, 1, 1), 0) for k in "abcd"]), folder, ["id"], ["d"])
    upsert_table(frame(SCHEMA, ("a", D(2024, 1, 2), 1), ("b", D(2024, 1, 1), 0), ("e", D(2024, 1, 1), 1)), folder, ["id"], ["d"])
    upsert_table(frame(SCHEMA, ("e", D(2024, 1, 3), 2), ("c", D(2024, 1, 1), 2), ("f", None, 2)), folder, ["id"], ["d"])
    upsert_table(frame(SCHEMA, ("f", None, 2)), folder, ["id"], ["d"])

    def changes(since):
        return tuples(read_changes(spark, folder, since).select("id", "v", "change", "load"))

    assert changes(0) == [("a", 1, "updated", 1), ("c", 2, "updated", 2), ("e", 2, "inserted", 2), ("f", 2, "inserted", 2)]
    assert changes(1) == [("c", 2, "updated", 2), ("e", 2, "updated", 2), ("f", 2, "inserted", 2)]
    assert changes(2) == []
    monkeypatch.setattr(indexes, "LOADS", 2)
    upsert_table(frame(SCHEMA, ("a", D(2024, 1, 2), 7)), folder, ["id"], ["d"])
    assert changes(2) == [("a", 7, "updated", 3)]
    with pytest.raises(ValueError, match="from load 2 on"):
        changes(1)


def test_detected_changes(frame):
    before = frame("k string, a int, b string, at int", ("x", 1, None, 1), ("y", 1, "b", 1), (None, 2, "n", 1), ("z", 3, "", 1))
    after = frame("k string, a int, b string, at int", ("x", None, "1", 2), ("y", 1, "b", 2), (None, 2, "n", 2), ("new", 1, "b", 2), ("", 2, "n", 2))
    found = detect_changes(before, after, ["k"], ignore=["at"], deletions=True).select("k", "change").collect()
    assert {(r.k, r.change) for r in found} == {
        ("x", "updated"), ("y", "unchanged"), (None, "unchanged"), ("new", "inserted"), ("", "inserted"), ("z", "deleted"),
    }
    assert len(found) == 6
    assert detect_changes(before, after, ["k"]).where("change = 'unchanged'").count() == 0


def test_a_load_looks_its_keys_up_once(spark, frame, folder, monkeypatch):
    rows, real = spark.sparkContext.accumulator(0), indexes.KeyIndex.judged

    def counted(self, marked, buckets):
        judged = real(self, marked, buckets)

        def run(batches):
            for batch in batches:
                rows.add(batch.num_rows)
                yield batch

        return judged.mapInArrow(run, judged.schema)

    upsert_table(frame(SCHEMA, *[(k, D(2024, 1, 1), 0) for k in "abcd"]), folder, ["id"], ["d"])
    monkeypatch.setattr(indexes.KeyIndex, "judged", counted)
    got = upsert_table(frame(SCHEMA, ("a", D(2024, 1, 2), 1), ("e", D(2024, 1, 1), 1)), folder, ["id"], ["d"])
    assert rows.value == 2
    assert [r[0] for r in tuples(got.select("id"))] == list("abcde")
    assert not [n for n in os.listdir(current_version(spark, folder)) if n in ("_batch", "_changes", "_staged")]
