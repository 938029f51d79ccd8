"""Histories of snapshots in any order, as stored."""

import datetime as dt
import os

import pytest
from comparing import tuples

from orderloom.operators.incremental import SchemaChangedError
from orderloom.sources import snapshots
from orderloom.sources.snapshots import put_snapshot, read_versions
from orderloom.sources.tables import current_version, read_table

SCHEMA = "k string, tier string"
JAN, FEB, MAR, MAY = (dt.datetime(2024, m, 1) for m in (1, 2, 3, 5))


def history(spark, folder):
    return tuples(read_versions(spark, folder, ["k"], ["tier"]).drop("version_id"))


def test_a_late_snapshot_splits_a_version(spark, frame, folder):
    for at in (JAN, MAR):
        put_snapshot(frame(SCHEMA, ("a", "X"), ("b", "X")), folder, ["k"], at)
    assert history(spark, folder) == [("a", "X", JAN, None), ("b", "X", JAN, None)]
    put_snapshot(frame(SCHEMA, ("a", "Y"), (None, "Z")), folder, ["k"], FEB)
    split = [("a", "X", JAN, FEB), ("a", "X", MAR, None), ("a", "Y", FEB, MAR), ("b", "X", JAN, None)]
    assert history(spark, folder) == split
    put_snapshot(frame(SCHEMA, ("a", "X"), ("b", "X")), folder, ["k"], FEB)  # corrected: one run a key again
    assert history(spark, folder) == [("a", "X", JAN, None), ("b", "X", JAN, None)]
    assert read_table(spark, folder).count() == 2


def test_a_writer_lost_before_the_swap_repeats_its_snapshot(spark, frame, folder, monkeypatch):
    first, second = frame(SCHEMA, ("a", "X")), frame(SCHEMA, ("a", "Y"))
    put_snapshot(first, folder, ["k"], JAN)
    put_snapshot(first, folder, ["k"], MAY)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "replace_partitions", lost)
        with pytest.raises(OSError, match="lost"):
            put_snapshot(second, folder, ["k"], FEB)
    put_snapshot(first, folder, ["k"], MAR)  # another comes between
    put_snapshot(second, folder, ["k"], FEB)
    assert history(spark, folder) == [("a", "X", JAN, FEB), ("a", "X", MAR, None), ("a", "Y", FEB, MAR)]


def test_the_newest_snapshot_leaves_earlier_periods_alone(spark, frame, folder):
    put_snapshot(frame(SCHEMA, ("gone", "X"), ("a", "X")), folder, ["k"], JAN)
    put_snapshot(frame(SCHEMA, ("a", "X")), folder, ["k"], MAR)
    root = current_version(spark, folder)
    files = lambda: {f"{at}/{n}" for at, _, names in os.walk(root) for n in names if n.endswith(".parquet") and "period=" in at}
    before = files()
    put_snapshot(frame(SCHEMA, ("a", "Y")), folder, ["k"], MAY)
    old = {f for f in before if f in files()}
    assert len(old) >= 1 and len(before - old) >= 1
    assert history(spark, folder) == [("a", "X", JAN, MAY), ("a", "Y", MAY, None), ("gone", "X", JAN, None)]


def test_one_period_holds_runs_that_stay(spark, frame, folder):
    """A partition that is rewritten keeps its runs that the snapshot does not touch."""
    days = [dt.datetime(2024, 1, 10) + dt.timedelta(days=n) for n in range(3)]
    put_snapshot(frame(SCHEMA, ("gone", "X"), ("a", "X")), folder, ["k"], days[0])
    for at in days[1:]:
        put_snapshot(frame(SCHEMA, ("a", "X")), folder, ["k"], at)
    assert history(spark, folder) == [("a", "X", days[0], None), ("gone", "X", days[0], None)]


def test_rows_of_one_key_columns_and_schema(spark, frame, folder):
    put_snapshot(frame(SCHEMA, ("a", "Y"), ("a", "X"), ("a", "X")), folder, ["k"], JAN)
    put_snapshot(frame(SCHEMA), folder, ["k"], FEB)
    assert history(spark, folder) == [("a", "X", JAN, None)]
    with pytest.raises(SchemaChangedError):
        put_snapshot(frame("k string", ("a",)), folder, ["k"], MAR)
    with pytest.raises(ValueError, match="period"):
        put_snapshot(frame("k string, period string", ("a", "b")), f"{folder}/other", ["k"], MAR)
    clash = frame("k string, _left string, row string, _any string", ("a", "b", "c", "d"))
    put_snapshot(clash, f"{folder}/clash", ["k"], JAN)
    put_snapshot(clash, f"{folder}/clash", ["k"], FEB)
    assert tuples(read_table(spark, f"{folder}/clash").select(*clash.columns)) == [("a", "b", "c", "d")]
