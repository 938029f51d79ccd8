import random

import pytest

from orderloom.llm import substrings


def brute(docs):
    """(kept words, removed count) by the definition."""
    first = {}
    words = {}
    for k, (i, text) in enumerate(docs):
        words[k] = (text or "").encode().split()
        if i is not None:
            for a in range(len(words[k]) - 49):
                key = tuple(words[k][a : a + 50])
                first[key] = min(first.get(key, i), i)
    out = []
    for k, (i, _) in enumerate(docs):
        w, gone = words[k], set()
        for a in range(len(w) - 49):
            if i is not None and first[tuple(w[a : a + 50])] < i:
                gone.update(range(a, a + 50))
        out.append((i, len(w), len(gone), b" ".join(x for p, x in enumerate(w) if p not in gone).decode()))
    return sorted(out, key=str)


def found(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substrings.dedupe(df).collect()), key=str)


def some_docs(seed, n=40):
    rnd = random.Random(seed)
    fresh = lambda k: [f"w{rnd.randrange(5000)}" for _ in range(k)]
    passages = [fresh(rnd.randrange(45, 130)) for _ in range(6)] + [["same"] * 70, ["a", "b"] * 40]
    docs = []
    for i in range(n):
        words = fresh(rnd.randrange(30))
        for _ in range(rnd.randrange(4)):
            p = list(rnd.choice(passages))
            cut = rnd.randrange(20)
            words += p[cut:] if rnd.random() < 0.5 else p[: len(p) - cut]
            if rnd.random() < 0.3 and p:
                words[-rnd.randrange(1, min(30, len(words)) + 1)] = "changed"
            words += fresh(rnd.randrange(8))
        docs.append((rnd.randrange(1000), rnd.choice([" ", "\n", " \t"]).join(words)))
    return docs + docs[:3]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_same_as_brute_force(spark, seed):
    docs = some_docs(seed)
    assert found(spark, docs) == brute(docs)


def test_many_documents_with_one_witness_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(substrings, "DOCS_PER_SALT", 3)
    text = " ".join(f"v{i}" for i in range(120))
    docs = [(i, f"only {i} {text} tail {i}") for i in range(40)]
    assert found(spark, docs) == brute(docs)


def test_edges(edges):
    rows = substrings.dedupe(edges).collect()
    assert len(rows) == 12
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert [(r.n_words, r.n_removed, r.kept) for i in (1, 2, 3) for r in by[i]] == [(0, 0, "")] * 3
    assert by[4][0].n_removed == 0 and by[5][0].n_removed == 20000 and by[5][0].kept == ""
    assert [r.n_removed for r in by[6]] == [0, 0]  # one document, given twice
    assert sorted(r.n_removed for r in by[None]) == [0, 0]


def test_empty_table(nothing):
    assert substrings.dedupe(nothing).collect() == []
