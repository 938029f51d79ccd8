"""Candidates of the near-duplicate removal: none is ruled out before the exact comparison."""

import random

from pyspark.sql import functions as F

from orderloom.llm import simhash


def _texts():
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    plain = [word() for _ in range(200)]
    return [(1, " ".join(plain)), (2, " ".join([*plain[:199], "other"])), (3, " ".join(word() for _ in range(200))), (4, None), (5, "")]


def test_no_sketch_rules_a_candidate_out(frame, monkeypatch):
    monkeypatch.setattr(simhash, "sketch_bits", lambda *a, **k: -1)  # would rule out all but nothing
    docs = frame("doc_id long, text string", *_texts())
    found = {r["doc_id"]: r["group_id"] for r in simhash.near_duplicates(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4}


def test_fingerprints_within_the_radius_are_all_connected(frame):
    r = random.Random(3)
    prints = [r.getrandbits(64) for _ in range(20)]
    rows = [(p ^ (1 << r.randrange(64)) if k else p) for p in prints for k in range(3)] * 2  # each twice
    signed = [x - (1 << 64) if x >= 1 << 63 else x for x in rows]
    nodes = frame("id long, fingerprint long", *enumerate(signed))
    root = list(range(len(rows)))

    def top(x):
        return x if root[x] == x else top(root[x])

    for row in simhash.print_links(nodes, 3).collect():
        assert (rows[row["a"]] ^ rows[row["b"]]).bit_count() <= 3
        root[max(top(row["a"]), top(row["b"]))] = min(top(row["a"]), top(row["b"]))
    for a in range(len(rows)):
        for b in range(a):
            if (rows[a] ^ rows[b]).bit_count() <= 3:
                assert top(a) == top(b)


def test_every_id_meets_the_least_of_its_bands(frame):
    nodes = frame("id long, bands array<long>", (5, [1, 2]), (3, [1, 9]), (4, [2, 8]), (7, [7, 6]))
    pairs = {(r["a"], r["b"]) for r in simhash.band_pairs(nodes.select("id", F.col("bands"))).collect()}
    assert pairs == {(3, 5), (4, 5)}
