"""Left lookups on a key, point-in-time lookups, and orphans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


class NotUniqueError(ValueError):
    """A lookup side holds a key more than once and would multiply rows."""


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail now if a non-null key occurs twice; returns ``df`` for chaining. Runs one job."""
    known = df.select(*keys).na.drop("any")
    twice = known.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if twice:
        raise NotUniqueError(f"{list(keys)} is not unique, e.g. {twice[0].asDict()}")
    return df


def guard_unique(df: DataFrame, key: str) -> DataFrame:
    """``df`` without null keys; whoever computes it fails if a key occurs twice.

    No job of its own: rows are grouped by the key, as a join on it wants them anyway, counted in the map tasks first.
    """
    others = [c for c in df.columns if c != key]
    grouped = df.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count("*").alias("_n"), F.first(F.struct(*[F.col(c) for c in others])).alias("_row")
    )
    told = F.concat(F.lit(f"['{key}'] is not unique, e.g. "), F.col(key).cast("string"))
    once = F.when(F.col("_n") > 1, F.raise_error(told).cast("boolean")).otherwise(F.lit(True))
    return grouped.filter(once).select(key, *[F.col(f"_row.{c}").alias(c) for c in others])


def left_lookup(
    left: DataFrame,
    right: DataFrame,
    on: str,
    columns: Sequence[str] | None = None,
    *,
    unique: bool | str = False,
    isolate_share: float | None = None,
    broadcast_bytes: int = 64 << 20,
    salts: int = 64,
) -> DataFrame:
    """All rows of ``left`` with ``columns`` of the row of ``right`` that has the same key.

    ``unique`` makes sure that ``right`` holds each key once: True in a job beforehand, ``"in plan"`` while the result is
    computed, which then fails.

    No broadcast hint: Spark broadcasts ``right`` only where its size, estimated or measured at run
    time, is under the session's threshold, and otherwise sort-merges, splitting skewed partitions
    of ``left``. With ``isolate_share`` the keys holding at least that share of ``left`` are found
    first. Their rows are joined without a shuffle as long as the lookup rows of these keys, measured
    as text, stay under ``broadcast_bytes``; beyond that each hot key is dealt out over ``salts``
    tasks and its lookup rows are repeated that often.
    """
    side = right if columns is None else right.select(on, *columns)
    if unique == "in plan":
        side = guard_unique(side, on)
    elif unique:
        assert_unique(side, [on])
    if isolate_share is None:
        return left.join(side, on, "left")
    return _isolated_lookup(left, side, on, isolate_share, broadcast_bytes, salts)


def lookups_in_place(left: DataFrame, sides: Mapping[str, DataFrame], within: str) -> DataFrame:
    """``left_lookup`` of several sides, each under its key, for wide rows that an earlier join has brought together by ``within``:
    the rows stay where they are.

    What moves are the distinct pairs of ``within`` and a key, to the side by its key and back with what is found by ``within``.
    Spark leaves joins that only add columns out of the pairs. It pays where the columns of a side are narrow beside the rows
    and the side is too large to broadcast; otherwise it moves pairs that ``left_lookup`` would not. Rows without ``within`` are
    looked up plainly.
    """
    columns = left.columns
    known = left.filter(F.col(within).isNotNull())
    rows, plain = known, left.filter(F.col(within).isNull())
    for on, side in sides.items():
        others = [c for c in side.columns if c != on]
        # all rows of a key as one: a pair stays one row, and a key held more than once multiplies rows at the end, as in any join
        found = side.filter(F.col(on).isNotNull()).groupBy(on).agg(F.collect_list(F.struct(*others)).alias("_found"))
        answers = known.select(within, on).distinct().join(found, on, "left").repartition(within)
        rows = rows.join(answers, [within, on], "left").select(*columns, F.explode_outer("_found").alias("_row"))
        rows = rows.select(*columns, *[F.col(f"_row.{c}").alias(c) for c in others])
        plain = left_lookup(plain, side, on)
        columns = rows.columns
    return rows.unionByName(plain)


def frequent_keys(df: DataFrame, key: str, share: float) -> list:
    """Every key with at least ``share`` of the rows, and maybe some rarer ones.

    A bounded sketch per task, merged: at most ``1 / share`` candidates reach the driver, whatever
    the number of rows, and no frequent key is missed.
    """
    found = df.filter(F.col(key).isNotNull()).stat.freqItems([key], share).first()[0]
    return [value for value in found if value is not None]


def _isolated_lookup(
    left: DataFrame, side: DataFrame, on: str, share: float, broadcast_bytes: int, salts: int
) -> DataFrame:
    """Rows with a frequent key apart from all others; rows with a null key go with them."""
    hot = frequent_keys(left, on, share)
    if not hot:
        return left.join(side, on, "left")
    hot_side = side.filter(F.col(on).isin(hot))
    is_hot = F.coalesce(F.col(on).isin(hot), F.lit(True))
    hot_rows = left.filter(is_hot)
    size = hot_side.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    if size <= broadcast_bytes:
        joined = hot_rows.join(F.broadcast(hot_side), on, "left")
    else:
        salt = F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")
        repeated = hot_side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = hot_rows.withColumn("_salt", salt).join(repeated, [on, "_salt"], "left").drop("_salt")
    shuffled = left.filter(~is_hot).join(side, on, "left")
    return joined.unionByName(shuffled)


def as_of_join(
    facts: DataFrame,
    history: DataFrame,
    on: str,
    at: str,
    columns: Sequence[str],
    *,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    hot_share: float | None = None,
) -> DataFrame:
    """Each fact with the version of its key that was valid at ``at``; facts without one stay.

    Validity is ``[valid_from, valid_to)`` with an open end as null, and versions of a key must not
    overlap. The plain form is an equi join on the key with the range as a residual test, right as
    long as keys have few versions (the snapshot opens at most one per run). For long histories
    ``hot_share`` merges instead: facts and versions of a key are put in order of time and every fact takes the last
    version before it, so that a fact meets one version, however many its key has. Keys with at least that share of the facts are cut
    into ranges of time, each with about that share of the key's facts and the version carried into it.
    """
    versions = history.select(on, valid_from, valid_to, *columns)
    if hot_share is not None:
        return _merged_as_of(facts, versions, on, at, columns, valid_from, valid_to, hot_share)
    f, v = facts.alias("f"), versions.alias("v")
    start, end, moment = F.col(f"v.{valid_from}"), F.col(f"v.{valid_to}"), F.col(f"f.{at}")
    valid = (moment >= start) & (end.isNull() | (moment < end))
    joined = f.join(v, (F.col(f"f.{on}") == F.col(f"v.{on}")) & valid, "left")
    return joined.select(*[F.col(f"f.{c}") for c in facts.columns], *[F.col(f"v.{c}") for c in columns])


def _merged_as_of(
    facts: DataFrame, versions: DataFrame, on: str, at: str, columns: Sequence[str], valid_from: str, valid_to: str, share: float
) -> DataFrame:
    """The merge form. A place is a key, a range of time and a salt; a range that is a single moment many facts share has several
    salts, with the range's few versions in each."""
    moment, start, end = (F.col(c).cast("timestamp") for c in (at, valid_from, valid_to))
    known = F.col(on).isNotNull() & F.col(at).isNotNull()
    own = F.struct(*[F.col(c) for c in facts.columns]).alias("fact")
    given = F.struct(end.alias("until"), *[F.col(c) for c in columns]).alias("version")
    kind = facts.schema[on].dataType
    fact_rows = facts.filter(known).select(
        F.col(on).alias("key"), moment.alias("time"), own, F.xxhash64(*facts.columns).alias("hash")
    )
    version_rows = versions.filter(F.col(on).isNotNull() & (end.isNull() | (start < end))).select(
        F.col(on).cast(kind).alias("key"), start.alias("time"), given
    )
    version_rows = version_rows.filter(F.col("time").isNotNull())
    hot = frequent_keys(fact_rows, "key", share)
    if hot:
        bounds = F.broadcast(_time_ranges(fact_rows.filter(F.col("key").isin(hot)), share))
        number = F.coalesce(F.size(F.filter("bounds", lambda b: b <= F.col("time"))), F.lit(0))
        salts = F.coalesce(F.try_element_at("repeats", F.col("range") + 1), F.lit(1))
        fact_rows = fact_rows.join(bounds, "key", "left").withColumn("range", number)
        fact_rows = fact_rows.withColumn("salt", F.pmod("hash", salts).cast("int"))
        version_rows = version_rows.join(bounds, "key", "left").withColumn("range", number)
        version_rows = version_rows.unionByName(_carried(version_rows)).withColumn(
            "salt", F.explode(F.sequence(F.lit(0), salts.cast("int") - 1))
        )
    else:
        fact_rows, version_rows = (d.withColumns({"range": F.lit(0), "salt": F.lit(0)}) for d in (fact_rows, version_rows))
    place = ["key", "range", "salt"]
    rows = fact_rows.select(*place, "time", "fact").unionByName(
        version_rows.select(*place, "time", "version"), allowMissingColumns=True
    )
    # at one moment the version comes before the facts
    order = Window.partitionBy(*place).orderBy("time", F.col("fact").isNotNull())
    last = F.last("version", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    merged = rows.withColumn("last", last).filter(F.col("fact").isNotNull())
    valid = F.col("last.until").isNull() | (F.col("time") < F.col("last.until"))
    joined = merged.select("fact.*", *[F.when(valid, F.col(f"last.{c}")).alias(c) for c in columns])
    nothing = [F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in columns]
    return joined.unionByName(facts.filter(~known).select(*facts.columns, *nothing))


def _time_ranges(rows: DataFrame, share: float) -> DataFrame:
    """For each of a few keys the moments that cut its rows into parts of about ``share``, ascending, and how many parts begin
    at each: more than one where a moment has many rows. A list of at most ``1 / share`` moments a key, from bounded sketches."""
    steps = max(round(1 / share), 2)
    cuts = F.percentile_approx(F.unix_micros("time"), [i / steps for i in range(1, steps)], 100 * steps)
    found = rows.groupBy("key").agg(cuts.alias("cuts"))
    distinct = F.array_distinct("cuts")
    parts = F.transform(distinct, lambda c: F.size(F.filter("cuts", lambda x: x == c)))
    return found.select(
        "key",
        F.transform(distinct, F.timestamp_micros).alias("bounds"),
        F.concat(F.array(F.lit(1)), parts).alias("repeats"),
    )


def _carried(versions: DataFrame) -> DataFrame:
    """For every later range of a cut key the last version that begins before it; one row per range."""
    latest = versions.filter(F.col("bounds").isNotNull()).groupBy("key", "range").agg(
        F.max("time").alias("time"), *[F.max_by(c, "time").alias(c) for c in ("version", "bounds", "repeats")]
    )
    following = Window.partitionBy("key").orderBy("range")  # at most one row per range of the key
    until = F.coalesce(F.lead("range").over(following), F.size("bounds"))
    ranges = latest.withColumn("_until", until).filter(F.col("range") < F.col("_until"))
    return ranges.withColumn("range", F.explode(F.sequence(F.col("range") + 1, "_until"))).select(*versions.columns)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows of ``child`` whose non-null key has no parent."""
    known = parent.select(F.col(parent_column).alias(column)).filter(F.col(column).isNotNull())
    return child.filter(F.col(column).isNotNull()).join(known, column, "left_anti").select(*child.columns)
