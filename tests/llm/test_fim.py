import hashlib
import re

import numpy as np
import pytest

from orderloom.llm import fim


def by_hand(key, text):
    """The transformation, written as it is told."""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    n = len(units)
    digits = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[8 * k : 8 * k + 8], 16) for k in range(4))
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h4 % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def rising(kind, rnd):
    steps = {
        "ones": np.ones(5000, dtype=int),
        "long jumps": rnd.integers(0, 5000, 3000),
        "words": rnd.integers(1, 9, 20000),
        "phases": np.repeat(rnd.integers(1, 60, 40), 211),
        "one jump": np.array([1] * 900 + [10**9] + [1] * 900),
        "none": np.zeros(0, dtype=int),
    }[kind]
    return np.cumsum(steps)


@pytest.mark.parametrize("kind", ["ones", "long jumps", "words", "phases", "one jump", "none"])
@pytest.mark.parametrize("bound", [1, 7, 120])
def test_index_is_exact_and_its_segments_keep_the_bound(kind, bound):
    offsets = rising(kind, np.random.default_rng(5))
    index = fim.RankIndex(offsets, bound)
    assert index.offsets(np.arange(len(offsets))).tolist() == offsets.tolist()
    assert len(offsets) == 0 or np.abs(index.residual.astype(int)).max() <= bound + 1
    if kind == "ones":
        assert len(index.first) == 1  # one line fits all
    if kind == "words" and bound == 120:
        assert len(index.first) < len(offsets) / 100


def test_bound_must_fit_a_byte():
    with pytest.raises(ValueError):
        fim.RankIndex(np.arange(3), 127)


TEXTS = [
    "", "a", " ", "abc def", "\n\n", "é日本\U0001f600 x", "a<P>b", "x <S", "<M>", "<<S>>", "<P", "ends with <", "a b " * 5000, "w" * 30000,
    "\r\nA1b2\x00", "don't stop",
]


def test_every_row_equals_the_transformation_by_hand(spark):
    rows = [(k, t) for k in range(40) for t in TEXTS]
    found = fim.transform(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    made = found.withColumn("back", fim.restored()).collect()
    assert sorted((r.doc_id, r.n_units, r.form, r.prefix_chars or 0, r.middle_chars or 0, r.output) for r in made) == sorted(
        (k, n, form, p or 0, m or 0, out) for k, t in rows for n, form, p, m, out in [by_hand(k, t)]
    )
    assert sorted((r.doc_id, r.back) for r in made) == sorted(rows)
    assert {r.form for r in made} == {"plain", "psm", "spm"}


def test_shares(spark):
    rows = spark.range(2000).selectExpr("id doc_id", "'some words of a text' text")
    assert fim.transform(rows, plain_share=100).where("form <> 'plain'").count() == 0
    assert fim.transform(rows, plain_share=0, spm_share=100).where("form <> 'spm'").count() == 0
    count = {r.form: r["count"] for r in fim.transform(rows).groupBy("form").count().collect()}
    assert 140 < count["plain"] < 260 and 290 < count["spm"] < 430


def test_edges(edges, nothing):
    rows = fim.transform(edges).withColumn("back", fim.restored()).select("doc_id", "form", "back", "hits", "start", "output").collect()
    whole = edges.select("doc_id", "text").collect()
    assert sorted((r.doc_id or 0, r.back) for r in rows) == sorted((r.doc_id or 0, r.text or "") for r in whole)
    assert {r.hits for r in rows} == {r.start for r in rows} == {"own"}
    twice = [r.output for r in rows if r.doc_id == 6]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert fim.transform(nothing).collect() == []
