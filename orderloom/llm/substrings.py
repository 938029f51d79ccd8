"""Substring dedup: passages of 50 words and more that an earlier document holds, located by Aho-Corasick automata.

1. Anchors. In every window of 50 words the run of 20 words with the smallest hash is its anchor, so equal windows have equal
   anchors at equal places. Windows next to each other mostly share one; such a stretch is a segment. Only hashes of anchors and segments
   are grouped, about one row for 16 words, and only anchors that occur in two documents go on.
2. Confirmed passages. A segment that an earlier document holds as a whole needs no closer look. Where an anchor has
   different segments, the windows of each different one are grouped by their hashes. Either way every recurring window gets a
   witness: a document with a smaller id that holds it.
3. Automata. The passages of a witness are compiled into one automaton (tiles of 25 words, of which every
   window holds one), sharded by witness; all stretches that point to it are streamed through. A window counts where a tile is
   hit and its 50 words are equal, word by word, to those of the witness. Hashes only propose.

Long hot groups are counted as hashes in the map tasks; a witness that many documents point to is dealt out over several tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.shipping import pieces, raw_texts, ready, stored
from orderloom.llm.words import Words, covered, mix

WINDOW = 50
GRAM = 20
TILE = WINDOW // 2
#: So many documents that point to one witness are given to one task; a bound on work, not on what is found.
DOCS_PER_SALT = 256
TOP = np.uint64(2**64 - 1)
STEP = np.uint64(0x9E3779B97F4A7C15)


class Segments:
    """The segments of a batch of texts: text, first and last window, anchor hash and segment hash of each.
    Windows are named by the position of their first word."""

    def __init__(self, texts: list[bytes]):
        self.words = words = Words(texts)
        at = words.runs_of(WINDOW)
        none = np.zeros(0, dtype=np.int64)
        if not len(at):
            self.text = self.first = self.last = none
            self.anchor = self.segment = none.astype(np.uint64)
            return
        grams = words.runs_of(GRAM)
        value = np.full(len(words), TOP)
        value[grams] = np.minimum(words.ranges(grams, grams + GRAM), TOP - np.uint64(1))
        anchor = _first_smallest(value, WINDOW - GRAM + 1)[at]
        text = words.doc[at]
        new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])
        self.text, self.first, self.last = text[new], at[new], at[np.r_[new[1:], len(at)] - 1]
        place = anchor[new]
        self.anchor = value[place]
        whole = words.ranges(self.first, self.last + WINDOW)
        self.segment = mix(whole ^ ((place - self.first).astype(np.uint64) + np.uint64(1)) * STEP)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the windows of segment k."""
        at = np.arange(self.first[k], self.last[k] + 1)
        return at, self.words.ranges(at, at + WINDOW)


def _first_smallest(value: np.ndarray, width: int) -> np.ndarray:
    """For each position the place of the smallest of ``width`` values from there on, the first of equal ones."""
    place, span = np.arange(len(value)), 1

    def join(shift):
        nonlocal value, place
        later = value[shift:] < value[:-shift]
        value = np.where(later, value[shift:], value[:-shift])
        place = np.where(later, place[shift:], place[:-shift])

    while span * 2 <= width:
        join(span)
        span *= 2
    if width > span:
        join(width - span)
    return place


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64))


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        s = Segments(raw_texts(batch.column("text")))
        ids = batch.column("doc").to_numpy(zero_copy_only=False)[s.text]
        rows = np.unique(np.stack([ids, s.anchor.view(np.int64), s.segment.view(np.int64)], axis=1), axis=0) if len(ids) else None
        if rows is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in rows.T], names=["doc", "anchor", "segment"])


def _tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of the segments that are to be looked at one by one."""
    for batch in pieces(batches):
        s = Segments(raw_texts(batch.column("text")))
        ids = batch.column("doc").to_pylist()
        wanted = {
            (k, m["anchor"], m["segment"]) for k, marks in enumerate(batch.column("marks").to_pylist()) for m in marks if m["tried"]
        }
        anchors, segments, texts = s.anchor.view(np.int64).tolist(), s.segment.view(np.int64).tolist(), s.text.tolist()
        out: list[tuple[int, int, np.ndarray]] = []
        for j in range(len(texts)):
            if (key := (texts[j], anchors[j], segments[j])) in wanted:
                wanted.discard(key)
                out.append((ids[texts[j]], anchors[j], s.windows(j)[1].view(np.int64)))
        if out:
            sizes = [len(w) for _, _, w in out]
            rows = np.stack(
                [np.repeat([d for d, _, _ in out], sizes), np.repeat([a for _, a, _ in out], sizes), np.concatenate([w for _, _, w in out])],
                axis=1,
            )
            rows = np.unique(rows, axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in rows.T], names=["doc", "anchor", "hash"])


PARTS = pa.schema(
    [("witness", pa.int64()), ("salt", pa.int32()), ("role", pa.int8()), ("doc", pa.int64()), ("row", pa.int64()), ("start", pa.int64()), ("words", pa.string())]
)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The passages that a document is witness of (role 0, once per salt), and the stretches that point to others (role 1)."""
    for batch in pieces(batches):
        raw = raw_texts(batch.column("text"))
        s = Segments(raw)
        ids, of_row = batch.column("doc").to_pylist(), batch.column("row").to_pylist()
        marks = {
            (k, m["anchor"], m["segment"]): m for k, ms in enumerate(batch.column("marks").to_pylist()) for m in ms
        }
        hits = {
            (k, m["anchor"], m["hash"]): m for k, ms in enumerate(batch.column("hits").to_pylist()) for m in ms or ()
        }
        own = np.zeros(len(s.words), dtype=bool)
        salts_of = np.ones(len(raw), dtype=np.int64)
        witness = np.full(len(s.words), -1, dtype=np.int64)  # index into the list of witnesses
        known: dict[tuple[int, int], int] = {}
        anchors, segments, texts = s.anchor.view(np.int64).tolist(), s.segment.view(np.int64).tolist(), s.text.tolist()

        def note(k, at, m, known=known, own=own, salts_of=salts_of, witness=witness, ids=ids):
            if m["witness"] == ids[k]:
                own[at] = True
                salts_of[k] = m["salts"]
            else:
                witness[at] = known.setdefault((m["witness"], m["salts"]), len(known))

        for j, k in enumerate(texts):
            m = marks.get((k, anchors[j], segments[j]))
            if m is None:
                continue
            if m["whole"]:
                note(k, slice(s.first[j], s.last[j] + 1), m)
            if m["tried"]:
                at, hashes = s.windows(j)
                for i, h in zip(at.tolist(), hashes.view(np.int64).tolist(), strict=True):
                    if (hit := hits.get((k, anchors[j], h))) is not None:
                        note(k, i, hit)
        rows: list[tuple] = []
        texts_of = s.words.doc
        for k, a, b in _runs(texts_of, own):
            words = s.words.bytes_of(a, b + WINDOW).decode()
            rows += [(ids[k], salt, 0, ids[k], of_row[k], a - int(s.words.first[k]), words) for salt in range(int(salts_of[k]))]
        names = list(known)
        for k, a, b in _runs(texts_of, witness >= 0, witness):
            home, salts = names[witness[a]]
            words = s.words.bytes_of(a, b + WINDOW).decode()
            rows.append((home, ids[k] % salts, 1, ids[k], of_row[k], a - int(s.words.first[k]), words))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PARTS, strict=True)], schema=PARTS)


def _runs(doc: np.ndarray, on: np.ndarray, value: np.ndarray | None = None) -> Iterator[tuple[int, int, int]]:
    """(text, first, last) of maximal runs of marked neighbours in one text with one value."""
    at = np.flatnonzero(on)
    if not len(at):
        return
    cut = (np.diff(at) != 1) | (doc[at[1:]] != doc[at[:-1]])
    if value is not None:
        cut |= value[at[1:]] != value[at[:-1]]
    starts = np.r_[0, np.flatnonzero(cut) + 1]
    stops = np.r_[starts[1:], len(at)] - 1
    for a, b in zip(at[starts].tolist(), at[stops].tolist(), strict=True):
        yield int(doc[a]), a, b


class Shard:
    """The passages of one witness: an automaton of their tiles, and their windows as sequences of word numbers."""

    def __init__(self):
        self.automaton = ahocorasick.Automaton()
        self.number: dict[str, int] = {}
        self.windows: set[bytes] = set()
        self.ready = False

    def add(self, passage: str) -> None:
        words = passage.split(" ")
        for at in range(0, len(words) - TILE + 1, TILE):
            self.automaton.add_word(f" {' '.join(words[at : at + TILE])} ", TILE)
        ids = np.array([self.number.setdefault(w, len(self.number)) for w in words], dtype=np.int32).tobytes()
        self.windows.update(ids[4 * i : 4 * (i + WINDOW)] for i in range(len(words) - WINDOW + 1))

    def locate(self, stretch: str) -> list[tuple[int, int]]:
        """The ranges of words of the stretch that windows of the passages cover."""
        if not self.windows:
            return []
        if not self.ready:
            self.automaton.make_automaton()
            self.ready = True
        words = stretch.split(" ")
        n = len(words) - WINDOW + 1
        ends = np.cumsum([len(w) + 1 for w in words])  # where the blank behind each word is, after a leading one
        found = [end for end, _ in self.automaton.iter(f" {stretch} ")]
        if n < 1 or not found:
            return []
        last = np.searchsorted(ends, np.array(found))  # the last word of each tile
        first = last - TILE + 1
        near = covered(n, np.clip(first - (WINDOW - TILE), 0, n), np.clip(first + 1, 0, n))
        ids = np.array([self.number.get(w, -1) for w in words], dtype=np.int32).tobytes()
        same = [i for i in np.flatnonzero(near).tolist() if ids[4 * i : 4 * (i + WINDOW)] in self.windows]
        out: list[tuple[int, int]] = []
        for i in same:
            if out and i <= out[-1][1]:
                out[-1] = out[-1][0], i + WINDOW
            else:
                out.append((i, i + WINDOW))
        return out


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by witness and salt, its passages first."""
    key, shard = None, Shard()
    for batch in batches:
        rows: list[tuple[int, int, int, int]] = []
        columns = [batch.column(c).to_pylist() for c in PARTS.names]
        for witness, salt, role, doc, row, start, words in zip(*columns, strict=True):
            if (witness, salt) != key:
                key, shard = (witness, salt), Shard()
            if role == 0:
                shard.add(words)
            else:
                rows += [(doc, row, start + a, start + b) for a, b in shard.locate(words)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["doc", "row", "start", "stop"])


def locate(texts: DataFrame) -> DataFrame:
    """``doc``, ``row``, ``start``, ``stop``: ranges of words of documents that windows of 50 words cover which also
    start in a document with a smaller id. ``texts`` has ``doc`` (long, no nulls), ``text``, and ``row`` (long), which
    tells texts under one id apart."""
    ready(texts)
    anchors = texts.mapInArrow(_anchors, "doc long, anchor long, segment long")
    often = anchors.groupBy("anchor").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most").select("anchor")
    recurring = stored(anchors.join(often, "anchor", "left_semi"), "anchors")
    by_segment = recurring.groupBy("anchor", "segment").agg(F.min("doc").alias("witness"), F.max("doc").alias("most"))
    by_anchor = recurring.groupBy("anchor").agg((F.min("segment") != F.max("segment")).alias("mixed"))
    rows = (
        recurring.join(by_segment, ["anchor", "segment"])
        .join(by_anchor, "anchor")
        .select(
            "doc", "anchor", "segment", "witness", (F.col("witness") < F.col("most")).alias("whole"),
            (F.col("mixed") & (F.col("doc") == F.col("witness"))).alias("tried"),
        )
        .where("whole or tried")
    )
    rows = stored(rows, "segments")
    plain = rows.groupBy("doc").agg(F.collect_list(F.struct("anchor", "segment", "tried")).alias("marks"))
    tried = texts.join(plain.where(F.exists("marks", lambda m: m["tried"])), "doc").mapInArrow(_tried, "doc long, anchor long, hash long")
    tried = stored(tried, "windows")
    homes = tried.groupBy("anchor", "hash").agg(F.min("doc").alias("witness"), F.max("doc").alias("most")).where("witness < most")
    hits = stored(tried.join(homes.drop("most"), ["anchor", "hash"]), "hits")

    pointing = rows.where("whole and doc <> witness").select("witness", "doc").unionByName(
        hits.where("doc <> witness").select("witness", "doc")
    )
    hot = (
        pointing.groupBy("witness")
        .agg(F.approx_count_distinct("doc").alias("n"))
        .where(F.col("n") > DOCS_PER_SALT)
        .select("witness", F.ceil(F.col("n") / DOCS_PER_SALT).alias("salts"))
    )
    hot = stored(hot, "hot")
    salted = lambda df: df.join(hot, "witness", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    marks = salted(rows).groupBy("doc").agg(
        F.collect_list(F.struct("anchor", "segment", "witness", "salts", "whole", "tried")).alias("marks")
    )
    found = salted(hits).groupBy("doc").agg(F.collect_list(F.struct("anchor", "hash", "witness", "salts")).alias("hits"))
    both = marks.join(found, "doc", "left")
    parts = texts.join(both, "doc").mapInArrow(_parts, "witness long, salt int, role byte, doc long, row long, start long, words string")
    dealt = parts.repartition("witness", "salt").sortWithinPartitions("witness", "salt", "role")
    return dealt.mapInArrow(_located, "doc long, row long, start long, stop long")


KEPT = "doc_id long, n_words long, n_removed long, kept string, removed array<struct<start: long, stop: long>>"


def dedupe(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_col``, ``n_words``, ``n_removed``, ``kept`` (the other words, joined by one blank) and ``removed`` (ranges of words, merged, end
    exclusive) of every document: each word is removed that lies in a window of 50 words which also starts in a document with a smaller id.

    Words are runs of anything but space and the control characters 9 to 13. Null and empty texts have no words, texts of fewer than 50
    words lose none, and a document never loses words to itself. Rows that share an id are not
    duplicates of each other, whatever their texts. A document with a null id neither loses words nor takes any. Other columns are left out.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text).alias("row"), F.col(text).alias("text"))
    named = slim.where("doc is not null")
    spans = locate(named).groupBy("doc").agg(F.collect_list(F.struct("row", "start", "stop")).alias("spans"))
    joined = named.join(spans, "doc", "left").unionByName(
        slim.where("doc is null").withColumn("spans", F.lit(None).cast(spans.schema["spans"].dataType))
    )
    return joined.mapInArrow(_kept, KEPT).withColumnRenamed("doc_id", id_col)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    removed_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    for batch in pieces(batches):
        n_words, n_removed, kept, removed = [], [], [], []
        columns = raw_texts(batch.column("text")), batch.column("row").to_pylist(), batch.column("spans").to_pylist()
        for raw, row, spans in zip(*columns, strict=True):
            words = raw.split()
            spans = [s for s in spans or () if s["row"] == row]
            merged: list[dict] = []
            if spans:
                gone = covered(len(words), np.array([s["start"] for s in spans]), np.array([s["stop"] for s in spans]))
                edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                merged = [{"start": a, "stop": b} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]
                kept.append(b" ".join(compress(words, (~gone).tolist())).decode())
            else:
                kept.append(b" ".join(words).decode())
            n_words.append(len(words))
            n_removed.append(sum(m["stop"] - m["start"] for m in merged))
            removed.append(merged)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()), pa.array(removed, removed_type)],
            names=["doc_id", "n_words", "n_removed", "kept", "removed"],
        )
