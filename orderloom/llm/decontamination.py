"""Benchmark decontamination: word windows of test items, looked up in every window of every document."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orderloom.llm.shipping import pieces, raw_texts, ready, set_aside, stored
from orderloom.llm.words import ALNUM, Words, covered, word_table

_, LOWER = word_table(b"", lower=True)
SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
MARKS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hits", T.ArrayType(SPAN)),
    T.StructField("items", T.ArrayType(T.StringType())),
]


class Windows:
    """Windows of n consecutive words of some items; an item of fewer words is one window.

    Only arrays are kept, so that a set costs some bytes for each byte of its texts wherever it is broadcast: the words as
    text with their places, and for each length the distinct windows by hash, with the place of one occurrence and the items.
    """

    def __init__(self, items: list[tuple[str, bytes]], n: int):
        words = Words([text for _, text in items], ALNUM, LOWER)
        self.names, named = np.unique([item for item, _ in items] or [""], return_inverse=True)
        narrow = np.min_scalar_type(len(words.data))
        self.data, self.start, self.end = words.data, words.start.astype(narrow), words.end.astype(narrow)
        size = np.minimum(np.diff(words.first), n)
        self.tables: dict[int, tuple[np.ndarray, ...]] = {}
        for k in np.unique(size[size > 0]).tolist():
            at = words.runs_of(k)
            at = at[size[words.doc[at]] == k]
            self.tables[k] = self._table(words.ranges(at, at + k), at, named[words.doc[at]], k)

    def _table(self, h: np.ndarray, at: np.ndarray, item: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
        """Of each distinct window, by hash: the hash, where it stands once, where its items begin; and all items."""
        order = np.argsort(h, kind="stable")
        h, at, item = h[order], at[order], item[order]
        new = np.concatenate([[True], h[1:] != h[:-1]])
        for j in np.flatnonzero(~new).tolist():
            if self._text(int(at[j]), size) != self._text(int(at[j - 1]), size):  # other words, same hash: by words there
                a = j - int(np.argmax(new[j::-1]))
                b = int(np.searchsorted(h, h[j], "right"))
                by_words = sorted(range(a, b), key=lambda i: self._text(int(at[i]), size))
                at[a:b], item[a:b] = at[by_words], item[by_words]
                texts = [self._text(i, size) for i in at[a:b].tolist()]
                new[a + 1 : b] = [x != y for x, y in zip(texts[1:], texts, strict=False)]
        window = np.cumsum(new) - 1
        pairs = np.unique(window * len(self.names) + item)
        first = np.searchsorted(pairs, np.arange(window[-1] + 2) * len(self.names))
        narrow = np.min_scalar_type(max(len(self.start), len(pairs)))
        return h[new], at[new].astype(narrow), first.astype(narrow), (pairs % len(self.names)).astype(narrow)

    def _text(self, i: int, size: int) -> bytes:
        at = zip(self.start[i : i + size].tolist(), self.end[i : i + size].tolist(), strict=True)
        return b" ".join(self.data[a:b] for a, b in at)

    def find(self, words: Words) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, length, items) of every occurrence: equal hashes propose, equal words decide."""
        for size, (known, place, first, items) in self.tables.items():
            at = words.runs_of(size)
            h = words.ranges(at, at + size)
            near = np.searchsorted(known, h)
            hit = known[np.minimum(near, len(known) - 1)] == h
            for i, w in zip(at[hit].tolist(), near[hit].tolist(), strict=True):
                text = words.bytes_of(i, i + size)
                for v in range(w, int(np.searchsorted(known, known[w], "right"))):
                    if self._text(int(place[v]), size) == text:
                        yield i, size, self.names[items[first[v] : first[v + 1]]].tolist()


def item_blocks(
    benchmark: DataFrame, block_bytes: int, item_id: str, text: str
) -> tuple[int, Iterator[list[tuple[str, bytes]]]]:
    """How many blocks there are, and the items in lists of about ``block_bytes`` of text, dealt out by a hash of id and text;
    each is fetched when it is asked for."""
    rows = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("id"), F.col(text).alias("text")
    ).where("text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes)

    def parts():
        for k in range(n):
            part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k)
            yield [(r["id"], r["text"].encode()) for r in part.toLocalIterator()]

    return n, parts()


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = 10,
    block_bytes: int = 8 << 20,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` (spans of words, merged, end exclusive) and ``items`` (ids as
    strings, sorted) of the test items that have a window in the text.

    Words are runs of digits, letters a-z and non-ASCII characters of the text with A-Z lower-cased. A window is n
    consecutive words of an item, or a shorter item as a whole.

    Items are broadcast in blocks of about ``block_bytes`` of text, one block at a time: what tasks and driver hold grows with a
    block and its longest item, not with the number of blocks. One block is one pass over ``docs``, which are not shuffled.
    Of more, each is a pass that writes the hits of the distinct texts it finds; these are then joined to the documents by a digest of
    the text, on which Spark broadcasts the hits if they are few.

    Null and empty texts have no words and no hits; null or empty items have no window; repeated items count once;
    an item without id is called ``null``. Result columns replace input columns of the same name.
    """
    spark = ready(docs)
    kept = [f for f in docs.schema.fields if f.name not in {m.name for m in MARKS}]
    schema = T.StructType([*kept, *MARKS])
    arrow = to_arrow_schema(schema)
    blank = [F.lit(None).cast(m.dataType).alias(m.name) for m in MARKS]
    plain = docs.select(*(F.col(f"`{f.name}`") for f in kept), *blank)

    def scan(windows):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = windows.value if windows else None
            for batch in pieces(batches, text=text):
                yield _marked(batch, found, arrow, text)

        return run

    blocks, parts = item_blocks(benchmark, block_bytes, item_id, item_text)
    if blocks < 2:
        sets = [spark.sparkContext.broadcast(Windows(items, n)) for items in parts]
        return plain.mapInArrow(scan(sets[0] if sets else None), schema)
    texts = docs.select(F.col(f"`{text}`").alias("text"))
    found = None
    for items in parts:
        windows = spark.sparkContext.broadcast(Windows(items, n))
        part = stored(_texts_hit(texts, windows), "hits")
        windows.unpersist()
        found = part if found is None else found.unionByName(part)
    # a text has one row a block at most
    found = found.groupBy("digest").agg(
        F.flatten(F.collect_list("hits")).alias("hits"), F.flatten(F.collect_list("items")).alias("items")
    )
    digest, written = "_digest", F.col(f"`{text}`")
    while digest in plain.columns:
        digest = f"_{digest}"
    bare = plain.drop("hits", "items")
    empty = F.coalesce(written, F.lit("")) == ""
    joined = (
        bare.where(~empty)
        .withColumn(digest, F.sha2(written, 256))
        .join(found.withColumnRenamed("digest", digest), digest, "left")
        .select(*(F.col(f"`{f.name}`") for f in schema.fields))
    )
    return joined.unionByName(plain.where(empty)).mapInArrow(scan(None), schema)


HITS = T.StructType([T.StructField("digest", T.StringType()), *MARKS[1:]])


def _texts_hit(texts: DataFrame, windows) -> DataFrame:
    """``digest``, ``hits`` and ``items`` of every distinct text with a hit; copies meet in the tasks before they are shuffled."""
    arrow = to_arrow_schema(HITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            raw = raw_texts(batch.column("text"))
            spans, items = _hits(Words(raw, ALNUM, LOWER), windows.value, len(raw))
            rows = [
                {"digest": hashlib.sha256(t).hexdigest(), "hits": _spans(_merge(s)), "items": sorted(i)}
                for t, s, i in zip(raw, spans, items, strict=True)
                if s
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    found = texts.mapInArrow(run, HITS)
    return found.groupBy("digest").agg(F.first("hits").alias("hits"), F.first("items").alias("items"))


def _hits(words: Words, windows: Windows | None, n: int) -> tuple[list[list[tuple[int, int]]], list[set[str]]]:
    """Spans hit and items found in each of n texts."""
    spans: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    items: list[set[str]] = [set() for _ in range(n)]
    for i, size, found in windows.find(words) if windows else ():
        k = int(words.doc[i])
        a = i - int(words.first[k])
        spans[k].append((a, a + size))
        items[k].update(found)
    return spans, items


def _spans(merged: list[tuple[int, int]]) -> list[dict[str, int]]:
    return [{"start": a, "stop": b} for a, b in merged]


def _marked(batch: pa.RecordBatch, windows: Windows | None, schema: pa.Schema, text: str) -> pa.RecordBatch:
    words = Words(raw_texts(batch.column(text)), ALNUM, LOWER, hashes=windows is not None)
    spans, items = _hits(words, windows, batch.num_rows)
    known = zip(spans, items, batch.column("hits").to_pylist(), batch.column("items").to_pylist(), strict=True)
    for span, item, hits_before, items_before in known:
        span += [(s["start"], s["stop"]) for s in hits_before or ()]
        item.update(items_before or ())
    made = {
        "n_words": np.diff(words.first).tolist(),
        "hits": [_spans(_merge(s)) for s in spans],
        "items": [sorted(s) for s in items],
    }
    arrays = [
        pa.array(made[f.name], f.type) if f.name in made else batch.column(f.name) for f in schema
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the given spans of words; what stands between the words of a span goes with them."""
    words = Words([text], ALNUM, LOWER, hashes=False)
    gone = covered(len(words), np.array([a for a, _ in spans], int), np.array([b for _, b in spans], int))
    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
    parts, at = [], 0
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        parts.append(text[at : words.start[a]])
        at = int(words.end[b - 1])
    return b"".join([*parts, text[at:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", n: int = 10, **names) -> DataFrame:
    """``docs`` without what they share with the test items, in the columns of ``docs``.

    ``remove="documents"`` drops every document with a hit; ``"spans"`` keeps it and cuts the words that were hit
    out of its text. See ``mark`` for what counts as a hit and for nulls.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be 'documents' or 'spans', not {remove!r}")
    text = names.get("text", "text")
    apart, back = set_aside(docs, {m.name for m in MARKS} - {text})
    marked = mark(apart, benchmark, n, **names)
    if remove == "documents":
        return marked.where(F.size("hits") == 0).select(*back)

    @F.pandas_udf("string")
    def cut(texts, hits):
        return texts.combine(
            hits, lambda t, s: cut_spans(t.encode(), [(x["start"], x["stop"]) for x in s]).decode() if t and len(s) else t
        )

    return marked.withColumn(text, cut(text, "hits")).select(*back)
