import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import languages

SF_DIR = "/root/testdata/sf0.01"
WORDS = {
    "en": "the and of which with this their would about house water morning through never always thing".split(),
    "de": "der und nicht auch mit über schön Straße wasser morgen immer zwischen ungefähr möchte haus".split(),
    "fr": "le et dans cette avec leur était maison toujours être à propos jamais quelque où déjà".split(),
    "es": "el y en esta con su era casa siempre ser acerca nunca algún dónde mañana niño corazón".split(),
    "fi": "ja ei tämä kanssa talo vesi aina koskaan hyvää päivää yhdessä ymmärtää työ".split(),
}


def made(n, seed, longest=40):
    rnd = random.Random(seed)
    langs = sorted(WORDS)
    return [
        (i, " ".join(rnd.choice(WORDS[lang]) for _ in range(rnd.randrange(6, longest))), lang)
        for i in range(n)
        for lang in [langs[i % len(langs)]]
    ]


@pytest.fixture(scope="module")
def model(spark):
    return languages.train(spark.createDataFrame(made(600, 1), "doc_id long, text string, lang string"))


def counted(text):
    """The letter sequences of a text, one after the other."""
    line = " "
    for ch in text.lower():
        if ch.isalpha():
            line += ch
        elif line[-1] != " ":
            line += " "
    line += "" if line[-1] == " " else " "
    found = {}
    for n in (1, 2, 3):
        for i in range(len(line) - n + 1):
            part = line[i : i + n]
            if part.strip():
                h = 0
                for k, ch in enumerate(part):
                    h = (h * 0x100000001B3 + ord(ch) + k + 1) % 2**64
                bucket = h * 0x9E3779B97F4A7C15 % 2**64 >> 52
                found[bucket] = found.get(bucket, 0) + 1
    return found


@pytest.mark.parametrize("step", [1 << 20, 3, 7])
def test_features_count_every_sequence(monkeypatch, step):
    monkeypatch.setattr(languages, "STEP", step)
    texts = ["", None, "a", " 12 !", "Ab c-d", "déjà vu — Straße", "x" * 50, "İstanbul \U0001f600 日本", "one two  two", "...end", "A\nB"]
    rows = languages.features(texts)
    for text, row in zip(texts, rows, strict=True):
        expected = np.zeros(languages.BUCKETS)
        for bucket, n in counted(text or "").items():
            expected[bucket] = n**0.5
        norm = np.sqrt((expected**2).sum())
        assert np.allclose(row, expected / norm if norm else expected), text


def test_machine_is_the_best_of_its_kind():
    """Gradient of the primal objective vanishes at the weights found."""
    rnd = np.random.default_rng(2)
    rows = np.vstack([rnd.normal(0.3, 1, (60, 5)), rnd.normal(-0.3, 1, (30, 5))])
    positive = np.arange(90) < 60
    weights = languages.machine(rows, np.arange(90), positive, cost=0.5, rounds=4000)
    x, y = np.hstack([rows, np.ones((90, 1))]), np.where(positive, 1.0, -1.0)
    cost = 0.5 / np.where(positive, 2 / 3, 1 / 3)
    gap = np.maximum(1 - y * (x @ weights), 0)
    assert np.allclose(weights, (cost * y * gap) @ x, atol=1e-3)


def test_families_and_their_languages(model):
    assert model.families.classes == ["Germanic", "Romance", "Uralic"]
    assert [v.classes for v in model.languages] == [["de", "en"], ["es", "fr"], ["fi"]]
    assert model.languages[0].weights.shape == (1, languages.BUCKETS + 1) and not model.languages[2].pairs
    assert languages.family_of("pt-BR") == "Romance" and languages.family_of("xx") == "xx"


def test_made_up_texts_are_told_apart(spark, model):
    rows = languages.predict(spark.createDataFrame(made(500, 2), "doc_id long, text string, lang string"), model).collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 495
    assert all(0 <= r.score <= 1 for r in rows)


def test_edges(spark, edges, nothing, model):
    for m in (model, None):
        rows = languages.predict(edges, m).collect()
        assert len(rows) == edges.count() and {r.hits for r in rows} == {"own"}
        blank = [r for r in rows if r.doc_id in (1, 2, 3)]
        assert [(r.lang_pred, r.score) for r in blank] == [("und", 0.0)] * 3
        assert m is None or all(r.lang_pred in WORDS for r in rows if r.doc_id in (4, 6, 8))
    assert languages.predict(nothing, model).collect() == []
    assert languages.train(nothing.withColumn("lang", F.lit("en"))) is None
    assert languages.train(edges.withColumn("lang", F.lit(None).cast("string"))) is None
    one = languages.train(edges.withColumn("lang", F.lit("xx")))
    assert {(r.lang_pred, r.score) for r in languages.predict(edges.where("doc_id = 4"), one).collect()} == {("xx", 1.0)}


def test_copies_and_order_change_nothing(spark, model):
    rows = made(600, 1)
    again = languages.train(spark.createDataFrame(rows[::-1] + rows[:200] * 3, "doc_id long, text string, lang string").repartition(7))
    assert np.array_equal(model.families.weights, again.families.weights)
    assert np.array_equal(model.languages[1].weights, again.languages[1].weights)


def test_sample_is_bounded(spark, monkeypatch):
    seen = []
    trained = languages.Model.trained.__func__
    monkeypatch.setattr(languages.Model, "trained", classmethod(lambda cls, rows, langs: seen.append(langs) or trained(cls, rows, langs)))
    languages.train(spark.createDataFrame(made(600, 1), "doc_id long, text string, lang string"), max_rows=50)
    assert len(seen[0]) <= 50 and min(seen[0].count(x) for x in WORDS) >= 5


def test_held_out_by_checksum(spark):
    rows = spark.range(200).withColumnRenamed("id", "doc_id").withColumn("out", languages.held_out()).collect()
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert spark.sql("select cast(null as long) doc_id").select(languages.held_out()).first()[0] is False


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
def test_held_out_documents_of_the_query(spark):
    from orderloom.llm.queries import QUERIES

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op12_language_id"](spark, SF_DIR).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    unseen = [r for r in rows if r.held_out]
    assert len(unseen) > 200 and sum(r.lang == r.lang_pred for r in unseen) >= 0.98 * len(unseen)
