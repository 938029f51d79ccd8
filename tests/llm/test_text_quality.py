import random
import re
from collections import Counter

import pytest

from orderloom.llm import quality as q

GOOD = " ".join(f"word{i} and" for i in range(60))


def measures(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    count = Counter(zip(w, w[1:], w[2:]))
    hit = {p for i in range(len(w) - 2) if count[w[i], w[i + 1], w[i + 2]] > 1 for p in range(i, i + 3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_measures_same_as_brute_force():
    rnd = random.Random(4)
    for _ in range(400):
        text = "".join(rnd.choice(["a", "b ", "é日 ", "\n", " \n", "# ", "a b c ", "|", "\x0b"]) for _ in range(rnd.randrange(50)))
        doc = q.Document(text.encode())
        assert tuple(getattr(doc, m) for m in q.BASE) == measures(text), text


@pytest.mark.parametrize(
    "text, by",
    [
        (GOOD, None),
        ("é " * 0 + " ".join(f"élève{i} été" for i in range(40)), None),
        ("few words", "few_words"),
        ("one two three four " * 30, "repeated_words"),
        (" ".join(f"w{i}###" for i in range(60)), "symbols"),
        (" ".join(f"{i}" for i in range(100, 160)), "few_letters"),
        (" ".join(f"LOUD{i}" for i in range(60)), "shouted"),
        (" ".join(f"w{i}!" for i in range(60)), "exclaimed"),
        (" ".join("abcdefghijklmnopqrstuvwxyzabcdefghijklmnopqrstuvwxyz" + str(i) for i in range(60)), "word_length"),
        ("", "few_words"),
    ],
)
def test_each_rule(spark, text, by):
    assert [r.rejected_by for r in q.judge(spark.createDataFrame([(text,)], "text string")).collect()] == [by]


def test_the_order_follows_rejections_per_cost_and_changes_no_verdict(spark):
    rules = q.standard_rules()
    slow = [{"rule": r.name, "cost": 1.0 + k, "selectivity": 0.5} for k, r in enumerate(rules)]
    assert [r.name for r in q.cascade(rules, slow)] == [r.name for r in rules]
    slow[-1]["selectivity"] = 100.0
    assert q.cascade(rules, slow)[0].name == rules[-1].name
    docs = [q.Document(t.encode()) for t in (GOOD, "x", "LOUD!! " * 60, "a|b " * 70)]
    verdicts = {tuple(any(r.rejects(d) for r in order) for d in docs) for order in (rules, rules[::-1])}
    assert verdicts == {(False, True, True, True)}


def test_estimates_and_short_circuit(spark):
    docs = spark.createDataFrame([(GOOD,), ("few",), ("few",), (None,)], "text string")
    found = {e["rule"]: e for e in q.estimate(docs, q.standard_rules())}
    assert found["few_words"]["selectivity"] == 0.75 and found["shouted"]["selectivity"] == 0
    assert all(e["cost"] > 0 for e in found.values())
    runs = {r.text: r.rules_run for r in q.judge(docs).collect()}
    assert runs[GOOD] == 7 and runs["few"] < 7


def test_edges(edges, nothing):
    judged = q.judge(edges, measures=q.BASE)
    rows = judged.collect()
    assert len(rows) == 12 and {r.hits for r in rows} == {"own"}
    assert [r.rejected_by for r in rows if r.doc_id in (1, 2, 3)] == ["few_words"] * 3
    kept = q.keep_good(edges)
    assert kept.columns == edges.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [None]
    assert q.keep_good(nothing).collect() == [] and q.judge(nothing).collect() == []
