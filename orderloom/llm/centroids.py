"""Centroid clustering in whole numbers, with bounds tightened by geometry.

Every vector keeps an upper bound of the distance to its own centroid and a lower bound for each other one. When
centroids move, a lower bound would have to give way by the whole way that the other centroid went. But all members of a cluster lie
in a ball around their old centroid, and in the plane through the ball's centre, the old and the new place of the
other centroid one sees how much nearer to any point of the ball the centroid can have come: less, and often nothing,
if it moved sideways or away. Vectors whose bounds then still part the own centroid from the others keep it; the others are scanned exactly.
Distances that decide are whole numbers, so assignments equal those of a full scan.

Vectors lie in blocks, rows of a stored table, together with their bounds; a round reads one table and writes the next, without any
shuffle, and only sums by cluster and block are brought together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orderloom.llm.shipping import ready, shared_path
from orderloom.sources.folders import Folder

#: Vectors in a block.
BLOCK = 2048
#: Whole-number components beyond this could make a squared distance leave 64 bits.
LARGEST = 1 << 27
#: How far a rounded square root or cosine may be off, relatively; bounds give way by it.
SLACK = 1e-9


# --- geometry --------------------------------------------------------------------------------------------------------
def approach(centres: np.ndarray, radii: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """``[i, j]``: by how much at most the distance from a point of ball i to centroid j fell when j moved.

    The points that came nearer by more than ``d`` are the inside of a branch of the hyperbola with the foci ``old[j]`` and ``new[j]``,
    which lies in the cone between its asymptotes; the cone's half angle has the cosine ``d / way``. With the ball's centre at the
    angle ``psi`` to the way, seen from its middle, and the ball filling ``beta`` to either side, cones up to ``psi - beta`` miss the
    ball. So the approach is at most ``way * cos(psi - beta)``: the whole way straight ahead, nothing from a right angle on.
    """
    way = np.sqrt(((new - old) ** 2).sum(1))
    seen = centres[:, None, :] - ((old + new) / 2)[None]
    distance = np.sqrt((seen**2).sum(2))
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = (seen * (new - old)[None]).sum(2) / (distance * way[None])
        psi = np.arccos(np.clip(cosine, -1, 1))
        beta = np.arcsin(np.clip(radii[:, None] * (1 + SLACK) / distance, 0, 1))
    angle = np.where((distance > radii[:, None]) & (way[None] > 0), np.clip(psi - beta - 1e-6, 0, np.pi / 2), 0.0)
    return way[None] * np.cos(angle) * (1 + SLACK) + SLACK


def squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole-number vectors to every centroid."""
    small = max(int(np.abs(vectors).max(initial=0)), int(np.abs(centroids).max(initial=0))) < 1 << 20
    v, c = (x.astype(np.float64 if small else np.int64) for x in (vectors, centroids))
    found = (v * v).sum(1)[:, None] - 2 * (v @ c.T) + (c * c).sum(1)[None]
    return found.astype(np.int64)


def _below(x: np.ndarray) -> np.ndarray:
    return np.nextafter((x * (1 - SLACK)).astype(np.float32), np.float32(-np.inf))


def _above(x: np.ndarray) -> np.ndarray:
    return np.nextafter((x * (1 + SLACK)).astype(np.float32), np.float32(np.inf))


# --- one block -------------------------------------------------------------------------------------------------------
@dataclass
class Block:
    """Vectors with their clusters; ``upper`` bounds the distance to the own centroid, ``lower`` those to all."""

    vectors: np.ndarray
    cluster: np.ndarray
    upper: np.ndarray
    lower: np.ndarray

    @classmethod
    def scanned(cls, vectors: np.ndarray, centroids: np.ndarray) -> Block:
        """Every vector with its nearest centroid, of equally near ones the first."""
        d = squared(vectors, centroids)
        cluster = d.argmin(1).astype(np.uint8 if len(centroids) <= 256 else np.int32)
        root = np.sqrt(d.astype(np.float64))
        return cls(vectors, cluster, _above(root[np.arange(len(d)), cluster]), _below(root))

    def moved(self, centroids: np.ndarray, drift: np.ndarray, loose: np.ndarray) -> int:
        """Follow the centroids; returns how many vectors had to be scanned."""
        rows, own = np.arange(len(self.cluster)), self.cluster.astype(np.int64)
        self.upper = _above(self.upper.astype(np.float64) + drift[own])
        self.lower = _below(self.lower.astype(np.float64) - loose[own])
        others = self.lower.copy()
        others[rows, own] = np.inf
        nearest = others.min(1)
        unsure = np.flatnonzero(nearest <= self.upper)
        if len(unsure):  # the own distance may be enough
            away = self.vectors[unsure].astype(np.int64) - centroids[own[unsure]]
            self.upper[unsure] = _above(np.sqrt((away * away).sum(1).astype(np.float64)))
            unsure = unsure[nearest[unsure] <= self.upper[unsure]]
        if len(unsure):
            found = Block.scanned(self.vectors[unsure], centroids)
            self.cluster[unsure], self.upper[unsure], self.lower[unsure] = found.cluster, found.upper, found.lower
        return len(unsure)

    def gathered(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sums of components, numbers of members and largest upper bounds by cluster."""
        sums, radii = np.zeros((k, self.vectors.shape[1]), dtype=np.int64), np.zeros(k)
        for c in range(k):
            inside = self.cluster == c
            sums[c] = self.vectors[inside].sum(0, dtype=np.int64)
            radii[c] = self.upper[inside].max(initial=0)
        return sums, np.bincount(self.cluster, minlength=k), radii

    def distances(self, centroids: np.ndarray) -> np.ndarray:
        away = self.vectors.astype(np.int64) - centroids[self.cluster.astype(np.int64)]
        return (away * away).sum(1)


#: A block as it is stored. ``totals`` has the sums by cluster and component, the members by cluster, and the vectors scanned.
BLOCKS = T.StructType(
    [
        T.StructField("ids", T.ArrayType(T.LongType())),
        T.StructField("vectors", T.BinaryType()),
        T.StructField("cluster", T.BinaryType()),
        T.StructField("upper", T.BinaryType()),
        T.StructField("lower", T.BinaryType()),
        T.StructField("distance", T.BinaryType()),
        T.StructField("totals", T.ArrayType(T.LongType())),
        T.StructField("radii", T.ArrayType(T.DoubleType())),
        T.StructField("inertia", T.ArrayType(T.DecimalType(38, 0))),
    ]
)
MEMBERS = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]
)


def _packed(ids: pa.Array, block: Block, centroids: np.ndarray, scanned: int, last: bool) -> pa.RecordBatch:
    """One row for a block, whose ids are the one list in ``ids``."""
    k = len(centroids)
    sums, counts, radii = block.gathered(k)
    distance = block.distances(centroids) if last else np.zeros(0, dtype=np.int64)
    values = {
        "vectors": block.vectors.tobytes(),
        "cluster": block.cluster.tobytes(),
        "upper": block.upper.tobytes(),
        "lower": block.lower.tobytes(),
        "distance": distance.tobytes(),
        "totals": [*sums.ravel().tolist(), *counts.tolist(), scanned],
        "radii": radii.tolist(),
        "inertia": [Decimal(sum(distance[block.cluster == c].tolist())) for c in range(k)] if last else [],
    }
    schema = to_arrow_schema(BLOCKS)
    columns = [ids.cast(f.type) if f.name == "ids" else pa.array([values[f.name]], f.type) for f in schema]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _unpacked(row: dict[str, bytes], k: int, dims: int) -> Block:
    cluster = np.frombuffer(row["cluster"], dtype=np.uint8 if k <= 256 else np.int32).copy()
    n = len(cluster)
    narrow = len(row["vectors"]) == 2 * n * dims
    return Block(
        np.frombuffer(row["vectors"], dtype=np.int16 if narrow else np.int32).reshape(n, dims),
        cluster,
        np.frombuffer(row["upper"], dtype=np.float32).copy(),
        np.frombuffer(row["lower"], dtype=np.float32).reshape(n, k).copy(),
    )


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """``floor(1024 * x)`` of every component, in the smallest kind that holds them."""
    scaled = np.floor(vectors * 1024.0)
    most = np.abs(scaled).max(initial=0)
    if most > LARGEST:
        raise ValueError(f"components beyond {LARGEST // 1024} have no exact squared distance in 64 bits")
    return scaled.astype(np.int16 if most < 1 << 15 else np.int32)


def _kept(lists: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors have all their components, and these vectors."""
    right = pc.equal(pc.list_value_length(lists), dims).fill_null(False)
    values = lists.filter(right).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.float64)
    finite = np.isfinite(values).all(1)
    where = np.flatnonzero(right.to_numpy(zero_copy_only=False))[finite]
    return where, values[finite]


# --- rounds ----------------------------------------------------------------------------------------------------------
@dataclass
class Clustering:
    """``members`` has ``id``, ``cluster`` and ``distance`` (squared) of every vector kept; the rest is by cluster, and the
    number of vectors scanned exactly by round."""

    members: DataFrame
    centroids: list[tuple[int, ...]]
    inertia: list[int]
    scanned: list[int]


def first_centroids(vectors: DataFrame, k: int, dims: int, seed: int) -> np.ndarray:
    """The k vectors whose ids have the smallest hashes, in that order; of one id the smaller vector first."""
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    found = vectors.where((F.size("vector") == dims) & whole).select(drawn.alias("drawn"), "vector")
    rows = found.orderBy("drawn", "vector").limit(k).collect()
    return whole_numbers(np.array([r["vector"] for r in rows], dtype=np.float64).reshape(-1, dims)).astype(np.int64)


def cluster(
    vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, key: str = "vec_id", vector: str = "embedding", seed: int = 3
) -> Clustering:
    """Cluster the vectors with ``dims`` components, all present and finite, by their whole-number values.

    Every round assigns each vector to its nearest centroid (of equally near ones the first) and moves every centroid that has members
    to the floor of their mean; at the end vectors are assigned once more. Other vectors are left out. With fewer
    than ``k`` vectors each is a centroid; without any the result is empty. Null ids are kept; repeated rows count as often as they
    are there. Components beyond 131,072 raise an error, since squared distances would leave 64 bits. Other columns are not read.

    The driver gets ``k * (dims + 2)`` numbers a round. Every round is a written table; the one before it is deleted when the
    next is complete.
    """
    spark = ready(vectors)
    rows = vectors.select(
        F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector")
    )
    at = first_centroids(rows, k, dims, seed)
    k = len(at)
    if not k:
        return Clustering(spark.createDataFrame([], MEMBERS), [], [], [])

    def written(df: DataFrame) -> tuple[DataFrame, str]:
        path = shared_path(spark, "clusters")
        df.write.parquet(path)
        return spark.read.schema(BLOCKS).parquet(path), path

    def scan(batches: Iterator[pa.RecordBatch], centroids=at, last=rounds == 0) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, values = _kept(batch.column("vector"), dims)
            for begin in range(0, len(where), BLOCK):
                part = slice(begin, begin + BLOCK)
                ids = batch.column("id").take(pa.array(where[part]))
                block = Block.scanned(whole_numbers(values[part]), centroids)
                yield _packed(pa.ListArray.from_arrays([0, len(ids)], ids), block, centroids, len(ids), last)

    table, path = written(rows.mapInArrow(scan, BLOCKS))
    scanned = []
    for r in range(rounds):
        sums, counts, radii, found = _gathered(table, k, dims)
        scanned.append(found)
        new = np.array([[s // c for s in row] if c else old for row, c, old in zip(sums, counts, at.tolist(), strict=True)], dtype=np.int64)
        drift = np.sqrt(((new - at).astype(np.float64) ** 2).sum(1)) * (1 + SLACK)
        loose = approach(at.astype(np.float64), radii, at.astype(np.float64), new.astype(np.float64))

        def follow(batches, centroids=new, drift=drift, loose=loose, last=r + 1 == rounds):
            for batch in batches:
                held = {n: batch.column(n) for n in ("vectors", "cluster", "upper", "lower")}
                for i in range(batch.num_rows):
                    block = _unpacked({n: c[i].as_py() for n, c in held.items()}, k, dims)
                    moved = block.moved(centroids, drift, loose)
                    yield _packed(batch.column("ids").slice(i, 1), block, centroids, moved, last)

        before, (table, path) = path, written(table.select("ids", "vectors", "cluster", "upper", "lower").mapInArrow(follow, BLOCKS))
        Folder(spark, before).delete()
        at = new

    inertia = table.select(F.posexplode("inertia")).groupBy("pos").agg(F.sum("col").alias("total")).collect()
    by_cluster = {r["pos"]: int(r["total"]) for r in inertia}
    _, _, _, found = _gathered(table, k, dims)

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.uint8 if k <= 256 else np.int32
        for batch in batches:
            for i in range(batch.num_rows):
                own = np.frombuffer(batch.column("cluster")[i].as_py(), dtype=kind).astype(np.int32)
                distance = np.frombuffer(batch.column("distance")[i].as_py(), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids").slice(i, 1).flatten(), pa.array(own), pa.array(distance)], schema=to_arrow_schema(MEMBERS)
                )

    return Clustering(
        table.select("ids", "cluster", "distance").mapInArrow(members, MEMBERS),
        [tuple(c) for c in at.tolist()],
        [by_cluster[c] for c in range(k)],
        [*scanned, found],
    )


def _gathered(table: DataFrame, k: int, dims: int) -> tuple[list[list[int]], list[int], np.ndarray, int]:
    """Sums of components, members and radii by cluster over all blocks, and the vectors scanned."""
    each = table.select(F.posexplode(F.arrays_zip("totals", "radii")).alias("pos", "part"))
    whole = F.sum(F.col("part.totals").cast("decimal(38,0)")).alias("total")
    rows = {r["pos"]: r for r in each.groupBy("pos").agg(whole, F.max("part.radii").alias("radius")).collect()}
    total = [int(rows[i]["total"]) for i in range(k * (dims + 1) + 1)]
    sums = [total[c * dims : (c + 1) * dims] for c in range(k)]
    radii = np.array([rows[c]["radius"] for c in range(k)], dtype=np.float64)
    return sums, total[k * dims : k * dims + k], radii, total[-1]
