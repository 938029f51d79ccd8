"""SimHash fingerprints, linked within a radius by covering locality-sensitive hashing.

Every bit position gets a non-zero vector of radius + 1 bits; the mask of a vector v keeps the positions whose vector has an
odd product with v. For up to ``radius`` differing positions some v is orthogonal to all of their vectors, so that
mask hides every difference: each pair within the radius collides in at least one of the 2**(radius + 1) - 1 tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orderloom.llm.shipping import pieces, raw_texts, ready, stored
from orderloom.llm.words import LOWER, SPACED, Words, mix

BITS = 64


def masks(radius: int, positions: tuple[int, ...] = tuple(range(BITS))) -> list[int]:
    """The covering masks over the given bit positions."""
    n = (1 << (radius + 1)) - 1
    vector = {p: 1 + k % n for k, p in enumerate(positions)}
    return [sum(1 << p for p, m in vector.items() if bin(m & v).count("1") % 2) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


# --- fingerprints ----------------------------------------------------------------------------------------------------
def majority(hashes: np.ndarray, chunk: int = 1 << 16) -> int:
    """The bits set in over half of the hashes; 0 for none."""
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), chunk):
        part = np.ascontiguousarray(hashes[at : at + chunk]).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0]) if len(hashes) else 0


def shingle_hashes(raw: bytes, size: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``size`` words of the text with A-Z lower-cased; of the whole
    word sequence if it is shorter; nothing for no words."""
    words = raw.translate(LOWER).split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) <= size:
        runs = [b" ".join(words)]
    elif size == 1:
        runs = words
    else:
        runs = map(b" ".join, zip(*(words[k:] for k in range(size)), strict=False))
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(x, 42) for x in runs), dtype=np.uint64)


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint`` (long; the 64 bits) from runs of ``shingle`` words of the whole text. Null and empty texts have
    fingerprint 0. An input column ``fingerprint`` is replaced."""
    ready(docs)
    own = [f for f in docs.schema.fields if f.name != "fingerprint"]
    schema = T.StructType([*own, T.StructField("fingerprint", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([majority(shingle_hashes(t, shingle)) for t in raw_texts(batch.column(text))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in own), pa.array(made.view(np.int64))], schema=arrow
            )

    return docs.select(*(F.col(f"`{f.name}`") for f in own)).mapInArrow(run, schema)


# --- links -----------------------------------------------------------------------------------------------------------
def links(
    prints: DataFrame, radius: int = 3, max_sketch_bits: int | None = None, bucket_rows: int = 4096, id_col: str = "id"
) -> DataFrame:
    """Pairs (``a``, ``b``) of ids that connect all ids whose fingerprints lie within ``radius`` bits.

    ``prints`` has a unique long id and ``fingerprint``; with ``max_sketch_bits`` also ``sketch`` (binary), and
    only pairs whose sketches differ in that many bits or fewer are linked. Not every pair is listed: each bucket gives a
    spanning forest of its links, so there are never more rows than ids in buckets, while whatever is connected by links stays so.

    A bucket of over ``bucket_rows`` ids is counted before anything is brought together and dealt out again by covering
    masks over the bits its own mask left free. Both masks together fix all but about a quarter of the bits, so with
    different fingerprints such a bucket is small by construction. Ids of a bucket are compared in blocks of rows, so memory
    grows with the bucket, not with its pairs.
    Null ids have no links.
    """
    ready(prints)
    sketched = ["sketch"] if max_sketch_bits is not None else []
    first = masks(radius)
    second = [masks(radius, tuple(p for p in range(BITS) if not m >> p & 1)) for m in first]
    fp = F.col("fingerprint")
    rows = prints.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), "fingerprint", *sketched)
    keyed = rows.select(
        "*", F.posexplode(F.array(*(fp.bitwiseAND(F.lit(_signed(m))) for m in first))).alias("tab", "key")
    )
    slim = rows.select(
        F.posexplode(F.array(*(fp.bitwiseAND(F.lit(_signed(m))) for m in first))).alias("tab", "key")
    )
    hot = slim.groupBy("tab", "key").count().where(F.col("count") > bucket_rows).select("tab", "key", F.lit(True).alias("hot"))
    marked = keyed.join(stored(hot, "hot"), ["tab", "key"], "left")  # few as a rule, and then no shuffle
    table = F.array(*(F.array(*(F.lit(_signed(m)) for m in ms)) for ms in second))
    deep = marked.where("hot").select(
        "id", "fingerprint", *sketched, "tab", "key", F.posexplode(F.element_at(table, F.col("tab") + 1)).alias("sub", "mask")
    )
    every = marked.where("hot is null").select(
        "id", "fingerprint", *sketched, "tab", F.lit(-1).alias("sub"), "key", F.lit(0).cast("long").alias("rest")
    ).unionByName(
        deep.select("id", "fingerprint", *sketched, "tab", "sub", "key", fp.bitwiseAND(F.col("mask")).alias("rest"))
    )
    bucket = ["tab", "sub", "key", "rest"]
    dealt = every.repartition(*bucket).sortWithinPartitions(*bucket)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, values, sketches in _buckets(batches, bucket, bool(sketched)):
            if len(ids) > 1:
                a, b = forest(ids, values, sketches, radius, max_sketch_bits)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def _buckets(batches, bucket, sketched):
    """(ids, fingerprints, sketches) of each bucket; a bucket may go on in the next batch."""
    held: list[tuple] = []
    last = None

    def joined():
        ids, values, sketches = zip(*held, strict=True)
        return np.concatenate(ids), np.concatenate(values), np.concatenate(sketches) if sketched else None

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in bucket], axis=1)
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        values = batch.column("fingerprint").to_numpy(zero_copy_only=False).view(np.uint64)
        sketches = None
        if sketched:
            sketches = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype=np.uint64).reshape(n, -1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for a, b in zip(np.r_[0, cuts], np.r_[cuts, n], strict=True):
            key = tuple(keys[a])
            if key != last and held:
                yield joined()
                held = []
            last = key
            held.append((ids[a:b], values[a:b], sketches[a:b] if sketched else None))
    if held:
        yield joined()


def forest(ids, values, sketches, radius, max_sketch_bits, block: int = 128):
    """Pairs that span the connected parts of one bucket, the smallest id of a part first."""
    order = np.argsort(ids)
    ids, values = ids[order], values[order]
    sketches = sketches[order] if sketches is not None else None
    n = len(ids)
    if n == 2:  # most buckets
        if np.bitwise_count(values[0] ^ values[1]) > radius:
            return ids[:0], ids[:0]
        if sketches is not None and np.bitwise_count(sketches[0] ^ sketches[1]).sum() > max_sketch_bits:
            return ids[:0], ids[:0]
        return ids[:1], ids[1:]
    root = np.arange(n)
    for at in range(0, n, block):
        near = np.bitwise_count(values[at : at + block, None] ^ values[None, :]) <= radius
        x, y = np.nonzero(near)
        x += at
        later = y > x
        x, y = x[later], y[later]
        while len(x):
            rx, ry = root[x], root[y]
            open_ = rx != ry  # what is connected already needs no sketch
            x, y, rx, ry = x[open_], y[open_], rx[open_], ry[open_]
            if not len(x):
                break
            part = slice(0, 1 << 14)
            if sketches is not None:
                fit = np.bitwise_count(sketches[x[part]] ^ sketches[y[part]]).sum(axis=1) <= max_sketch_bits
                rx, ry = rx[part][fit], ry[part][fit]
            else:
                rx, ry = rx[part], ry[part]
            x, y = x[1 << 14 :], y[1 << 14 :]
            _unite(root, rx, ry)
    part = np.flatnonzero(root != np.arange(n))
    return ids[root[part]], ids[part]


def _unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the parts of a and b; every entry of ``root`` stays the smallest member of its part."""
    while len(a):
        low, high = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(root, high, low)
        while True:  # follow to the smallest
            up = root[root]
            if (up == root).all():
                break
            root[:] = up
        a, b = root[low], root[high]
        rest = a != b
        a, b = a[rest], b[rest]


def components(pairs: DataFrame, rounds: int = 60) -> DataFrame:
    """(``id``, ``component``) for every id in ``pairs`` (``a``, ``b``), equal for connected ids and for no others;
    which member names a component is arbitrary.

    Rounds of contraction: each node joins the neighbour that is smallest in a pseudo-random order, and pairs are rewritten. A
    round leaves at most about half of the nodes of a long chain, whatever the ids. Pairs and labels are written to the shared
    folder in each round, so lineage stays short and lost executors cost one round at most.
    """
    rank = F.struct(F.xxhash64("id").alias("h"), F.col("id").alias("id"))
    both = pairs.where("a <> b").select(F.col("a").alias("id"), F.col("b").alias("other"))
    edges = stored(both.unionByName(both.select(F.col("other").alias("id"), F.col("id").alias("other"))).distinct(), "pairs")
    labels = None
    for _ in range(rounds):
        other = F.struct(F.xxhash64("other").alias("h"), F.col("other").alias("id"))
        parents = edges.groupBy("id").agg(F.min(other).alias("best")).select(
            "id", F.when(F.col("best") < rank, F.col("best.id")).otherwise(F.col("id")).alias("parent")
        )
        parents = stored(parents, "parents")
        if labels is None:
            labels = parents.withColumnRenamed("parent", "component")
        else:
            moved = parents.select(F.col("id").alias("component"), "parent")
            labels = labels.join(moved, "component", "left").select("id", F.coalesce("parent", "component").alias("component"))
        labels = stored(labels, "labels")
        to = parents.select(F.col("id").alias("other"), F.col("parent").alias("other_parent"))
        edges = (
            edges.join(parents, "id")
            .join(to, "other")
            .select(F.col("parent").alias("id"), F.col("other_parent").alias("other"))
            .where("id <> other")
            .distinct()
        )
        edges = stored(edges, "pairs")
        if edges.isEmpty():
            return labels
    raise RuntimeError(f"the components did not settle in {rounds} rounds")


def groups(docs: DataFrame, radius: int = 3, shingle: int = 3, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_col``, ``fingerprint`` (long) and ``component_id``: the smallest id among the documents that are
    reached over links of fingerprints that differ in ``radius`` bits or fewer.

    Equal fingerprints are one node, so thousands of copies cost one row. Documents without words have fingerprint 0 and are linked
    like any other. Repeated ids give a row each. A null id belongs to the component of its fingerprint and never
    names it, unless the component has no other id: then ``component_id`` is null. No documents, no rows.
    """
    slim = docs.select(F.col(id_col).alias(id_col), F.col(text).alias(text))
    prints = stored(fingerprints(slim, shingle, text).select(id_col, "fingerprint"), "fingerprints")
    nodes = stored(prints.groupBy("fingerprint").agg(F.min(id_col).alias("least")), "nodes")
    pairs = links(nodes.select(F.col("fingerprint").alias("id"), "fingerprint"), radius)
    comp = components(pairs).withColumnRenamed("id", "fingerprint")
    placed = nodes.join(comp, "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint"))
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    by_print = placed.join(least, "component").select("fingerprint", "component_id")
    return prints.join(by_print, "fingerprint").select(id_col, "fingerprint", "component_id")


# --- near duplicates -------------------------------------------------------------------------------------------------
def _run_sets(words: Words, n: int, shingle: int) -> list[np.ndarray]:
    """For each of n texts the sorted distinct hashes of its runs of ``shingle`` words; of the whole word sequence if it
    is shorter."""
    sets = []
    for k in range(n):
        a, b = int(words.first[k]), int(words.first[k + 1])
        size = min(shingle, b - a)
        at = np.arange(a, b - size + 1) if size else np.zeros(0, dtype=np.int64)
        sets.append(np.unique(words.ranges(at, at + size)))
    return sets


BANDS, ROWS = 20, 5


def _bands(sets: list[np.ndarray], bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A hash of ``rows`` minima for each band and set: equal for two sets with the probability Jaccard ** rows."""
    some = [k for k, h in enumerate(sets) if len(h)]
    out = np.zeros((len(sets), bands), dtype=np.uint64)
    if not some:
        return out
    every = np.concatenate([sets[k] for k in some])
    first = np.cumsum([0, *(len(sets[k]) for k in some)])[:-1]
    salts = np.random.default_rng(20240301).integers(1, 2**63, (bands, rows, 2), dtype=np.uint64)
    for b in range(bands):
        key = np.full(len(some), b + 1, dtype=np.uint64)
        for r in range(rows):
            least = np.minimum.reduceat((every ^ salts[b, r, 0]) * (salts[b, r, 1] | np.uint64(1)), first)
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + least)
        out[some, b] = key
    return out


PAIR = 2  # words of the runs that fingerprints of near duplicates are made of


def _sketches(raw: list[bytes], shingle: int, parts: int) -> tuple[list[bytes], list[int], list[int], list[bytes], list]:
    """For each text a name and the size of its set of runs of words, a SimHash fingerprint of its distinct word pairs, a sketch of
    64 * parts bits of the set of runs, and its bands (none without words)."""
    salts = np.array([(0x9E3779B97F4A7C15 * (k + 1)) % 2**64 for k in range(parts)], dtype=np.uint64)
    words = Words(raw, SPACED, LOWER)
    sets = _run_sets(words, len(raw), shingle)
    names = [xxhash.xxh3_128_digest(h.tobytes()) for h in sets]
    prints = [_signed(majority(h)) for h in _run_sets(words, len(raw), min(PAIR, shingle))]
    sketches = [b"".join(majority(mix(h ^ s)).to_bytes(8, "little") for s in salts) for h in sets]
    return names, list(map(len, sets)), prints, sketches, [k.tolist() if len(h) else [] for h, k in zip(sets, _bands(sets).view(np.int64), strict=True)]


def sketched(docs: DataFrame, shingle: int = 5, parts: int = 4, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``runs`` (a name of the set of distinct runs of ``shingle`` words), ``n_runs``, ``fingerprint`` (SimHash of
    the distinct word pairs, which that set determines), ``sketch`` (SimHash of 64 * parts bits of that set, each run counted once) and
    ``bands`` (hashes of minima of that set)."""
    ready(docs)
    made = [("runs", T.BinaryType()), ("n_runs", T.LongType()), ("fingerprint", T.LongType()), ("sketch", T.BinaryType()), ("bands", T.ArrayType(T.LongType()))]
    own = [f for f in docs.schema.fields if f.name not in dict(made) and f.name != text]
    schema = T.StructType([*own, *(T.StructField(*m) for m in made)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text=text):
            found = _sketches(raw_texts(batch.column(text)), shingle, parts)
            arrays = [pa.array(v, arrow.field(name).type) for v, (name, _) in zip(found, made, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in own), *arrays], schema=arrow)

    return docs.select(*(F.col(f"`{f.name}`") for f in own), F.col(text)).mapInArrow(run, schema)


def sketch_bits(similarity: float, parts: int = 4, deviations: float = 4.0) -> int:
    """How many of 64 * parts bits may differ between texts of this Jaccard similarity: a bit differs with the probability
    angle / pi, and ``deviations`` standard deviations are allowed on top. At 4 about one pair in 30,000 is lost."""
    share = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    n = BITS * parts
    return int(n * share + deviations * np.sqrt(n * share * (1 - share)))


def in_blocks(rows: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """``rows`` with ``low`` and ``high``, so that any two rows of one ``key`` meet under some (``key``, ``low``, ``high``).

    ``hot`` has the keys with too much for one task, and ``parts``, the number of blocks that the ids of such a key are dealt to. Every
    two blocks meet in a task of their own, which so holds 2 / parts of the key; a row is there parts - 1 times.
    """
    marked = rows.join(stored(hot.select(key, F.col("parts").cast("long").alias("parts")), "hot"), key, "left")  # few as a rule, and then no shuffle
    own = F.pmod(F.xxhash64("id"), "parts")
    met = F.when(F.col("parts").isNull(), F.array(F.struct(F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("high")))).otherwise(
        F.transform(
            F.filter(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda k: k != own),
            lambda k: F.struct(F.least(k, own).alias("low"), F.greatest(k, own).alias("high")),
        )
    )
    return marked.withColumn("met", F.explode(met)).select(*rows.columns, "met.low", "met.high")


def band_links(nodes: DataFrame, max_sketch_bits: int | None, bucket_rows: int = 4096) -> DataFrame:
    """Pairs (``a``, ``b``) of ids that connect all ids (``id``, ``sketch``, ``bands``) that share a band and whose sketches differ
    in ``max_sketch_bits`` or fewer. Each bucket gives a spanning forest of its links, never all pairs; one of over ``bucket_rows``
    ids is compared block against block, by tasks of at most about that many rows. Without a number of bits sketches are not looked at."""
    if max_sketch_bits is None:
        return band_pairs(nodes)
    ready(nodes)
    keyed = nodes.select("id", "sketch", F.explode("bands").alias("key"))
    hot = nodes.select(F.explode("bands").alias("key")).groupBy("key").count().where(F.col("count") > bucket_rows)
    bucket = ["key", "low", "high"]
    dealt = in_blocks(keyed, "key", hot.withColumn("parts", F.ceil(2 * F.col("count") / bucket_rows)))
    dealt = dealt.repartition(*bucket).sortWithinPartitions(*bucket)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sketches in _sketch_buckets(batches, bucket):
            if len(ids) > 1:
                a, b = sketch_forest(ids, sketches, max_sketch_bits)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def _sketch_buckets(batches, bucket):
    """(ids, sketches) of each bucket; a bucket may go on in the next batch."""
    held: list[tuple] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in bucket], axis=1)
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        sketches = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype=np.uint64).reshape(n, -1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for a, b in zip(np.r_[0, cuts], np.r_[cuts, n], strict=True):
            key = tuple(keys[a])
            if key != last and held:
                yield tuple(map(np.concatenate, zip(*held, strict=True)))
                held = []
            last = key
            held.append((ids[a:b], sketches[a:b]))
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def sketch_forest(ids, sketches, max_sketch_bits, block: int = 64):
    """Pairs that span the parts of one bucket that sketches within ``max_sketch_bits`` connect."""
    n = len(ids)
    root = np.arange(n)
    for at in range(0, n, block):
        if at and not root.any():  # all are one part
            break
        near = np.bitwise_count(sketches[at : at + block, None] ^ sketches[None, at:]).sum(axis=2, dtype=np.int32) <= max_sketch_bits
        x, y = np.nonzero(near)
        later = y > x
        _unite(root, x[later] + at, y[later] + at)
    part = np.flatnonzero(root != np.arange(n))
    return ids[root[part]], ids[part]


def print_links(nodes: DataFrame, radius: int) -> DataFrame:
    """Pairs (``a``, ``b``) of ids that connect all ids (``id``, ``fingerprint``) whose fingerprints lie within ``radius`` bits. Ids of one
    fingerprint are linked to the least of them, which alone takes part in the covering tables: their large buckets split because
    fingerprints differ."""
    named = nodes.groupBy("fingerprint").agg(F.min("id").alias("a"))
    equal = nodes.join(named, "fingerprint").where("id <> a").select("a", F.col("id").alias("b"))
    return links(named.withColumnRenamed("a", "id"), radius).unionByName(equal)


def band_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs (``a``, ``b``) that connect all ids (``id``, ``bands``) sharing a band: every id with the least one of each of its bands,
    never all pairs."""
    keyed = nodes.select("id", F.explode("bands").alias("key"))
    least = keyed.groupBy("key").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 1")
    return keyed.join(least, "key").where("id <> a").select("a", F.col("id").alias("b"))


def similar_pairs(sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions (a, b) of links that span the parts connected by an exact Jaccard similarity of ``similarity`` or more."""
    n = len(sets)
    size = np.array([len(h) for h in sets], dtype=np.int64)
    owner = np.repeat(np.arange(n), size)
    _, run = np.unique(np.concatenate(sets) if n else np.zeros(0, dtype=np.uint64), return_inverse=True)
    order = np.argsort(run, kind="stable")
    holders = owner[order]  # the texts of run r are holders[begin[r]:begin[r + 1]]
    begin = np.searchsorted(run[order], np.arange(int(run.max()) + 2 if len(run) else 1))
    first = np.cumsum([0, *size])
    root = np.arange(n)
    for x in range(n - 1):
        open_ = root != root[x]
        if not open_.any():
            break
        mine = run[first[x] : first[x + 1]]
        lengths = begin[mine + 1] - begin[mine]
        at = np.repeat(begin[mine] - np.r_[0, np.cumsum(lengths)[:-1]], lengths) + np.arange(int(lengths.sum())) if len(mine) else mine
        shared = np.bincount(holders[at], minlength=n)
        fit = np.flatnonzero(open_ & (size > 0) & (shared * (1 + similarity) >= similarity * (size[x] + size) - 1e-9)) if size[x] else mine[:0]
        if len(fit):
            _unite(root, np.full(len(fit), x), fit)
    part = np.flatnonzero(root != np.arange(n))
    return root[part], part


def exact_links(
    docs: DataFrame, cells: DataFrame, similarity: float, shingle: int = 5, cell_rows: int = 4096, cell_runs: int = 4 << 20
) -> DataFrame:
    """Pairs (``a``, ``b``) of ids that connect all documents of one cell (``id``, ``component``) whose sets of distinct runs have
    a Jaccard similarity of ``similarity`` or more. ``docs`` has ``id`` and ``text``, ``cells`` also ``n_runs``. A text
    moves once, to its cell; a cell of over ``cell_rows`` texts or ``cell_runs`` runs is compared block against block."""
    ready(docs)
    size = cells.groupBy("component").agg(F.greatest(F.count("*") / cell_rows, F.sum("n_runs") / cell_runs).alias("size"))
    cell = ["component", "low", "high"]
    placed = in_blocks(cells.select("id", "component"), "component", size.where("size > 1").withColumn("parts", F.ceil(2 * F.col("size"))))
    dealt = docs.join(placed, "id").repartition(*cell).sortWithinPartitions(*cell)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _cells(batches, cell, shingle):
            a, b = similar_pairs(sets, similarity)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def _cells(batches, cell, shingle):
    """(ids, sets of runs) of each cell; a cell may go on in the next batch."""
    ids: list[int] = []
    sets: list[np.ndarray] = []
    last = None
    for batch in pieces(batches):
        raw = raw_texts(batch.column("text"))
        made = _run_sets(Words(raw, SPACED, LOWER), len(raw), shingle)
        keys = zip(*(batch.column(c).to_pylist() for c in cell), strict=True)
        for key, i, h in zip(keys, batch.column("id").to_pylist(), made, strict=True):
            if key != last and ids:
                yield np.array(ids), sets
                ids, sets = [], []
            last = key
            ids.append(i)
            sets.append(h)
    if ids:
        yield np.array(ids), sets


def near_duplicates(
    docs: DataFrame, similarity: float = 0.8, shingle: int = 5, id_col: str = "doc_id", text: str = "text", radius: int = 3
) -> DataFrame:
    """``id_col`` and ``group_id`` (the smallest id of the group) of every document with an id.

    Documents are linked if the Jaccard similarity of their sets of distinct runs of ``shingle`` words, compared exactly, is
    ``similarity`` or more. Candidates are all pairs whose SimHash fingerprints of distinct word pairs differ in ``radius`` bits or fewer,
    found by the covering tables; less alike texts, whose fingerprints lie farther apart, are candidates too if they share one of 20
    bands of five minima each (at 0.8 all but one pair in 2,700 does). Nothing else rules a candidate out: what candidates connect
    is a cell, and the exact comparison takes place within cells. Equal sets of runs are one node. Null and empty texts have no words and form one group; null ids are left out; repeated ids share a row.
    """
    slim = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    prints = stored(sketched(slim, shingle, parts=0), "sketches")
    nodes = prints.groupBy("runs").agg(F.min("id").alias("node"), *[F.first(c).alias(c) for c in ("n_runs", "fingerprint", "bands")])
    nodes = stored(nodes, "nodes")
    # texts without words have neither runs nor bands, and no partner but each other
    named = nodes.withColumnRenamed("node", "id").where("n_runs > 0")
    near = print_links(named.select("id", "fingerprint"), radius).unionByName(band_links(named.select("id", "bands"), None))
    sizes = nodes.groupBy(F.col("node").alias("id")).agg(F.sum("n_runs").alias("n_runs"))
    pairs = exact_links(slim, components(near).join(sizes, "id"), similarity, shingle)
    comp = components(pairs).withColumnRenamed("id", "node")
    placed = nodes.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = placed.groupBy("component").agg(F.min("node").alias("group_id"))
    placed = placed.join(least, "component").select("runs", "group_id")
    return prints.join(placed, "runs").groupBy(F.col("id").alias(id_col)).agg(F.min("group_id").alias("group_id"))


def keep_one(docs: DataFrame, similarity: float = 0.8, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: the one with the smallest id. Rows that
    share an id are one document and stay or go together; documents with a null id are all kept."""
    found = near_duplicates(docs, similarity, id_col=id_col, text=text, **options)
    others = found.where(F.col(id_col) != F.col("group_id")).select(id_col)
    return docs.join(others, id_col, "left_anti").select(*docs.columns)
