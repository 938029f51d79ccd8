import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from orderloom.llm import queries

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def prose(seed, n=120):
    rnd = np.random.default_rng(seed)
    return " ".join(f"{a}{b}" for a, b in zip(rnd.choice(["ha", "lo", "mi", "re", "su"], n), rnd.integers(0, 900, n), strict=True)).replace("0", "o")


ITEM = " ".join(f"item{i}" for i in range(14))


@pytest.fixture
def folder_of_tables(spark, folder):
    docs = [
        (1, prose(1), "en", "a", 0),
        (2, prose(1), "en", "a", 0),
        (3, prose(2) + " mail me.too@post.example.org now", "de", "b", 0),
        (4, prose(3) + " " + ITEM, "en", "b", 0),
        (5, "too short", "en", "b", 0),
        (6, None, None, None, None),
        (None, prose(4), "en", "c", 0),
    ]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_keep_the_columns_and_do_what_they_say(spark, folder_of_tables):
    docs = spark.read.parquet(f"{folder_of_tables}/documents.parquet")
    columns, kept = docs.columns, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder_of_tables)
        assert docs.columns == columns
        kept.append(sorted((r.doc_id for r in docs.collect()), key=str))
    assert kept == [[1, 2, 3, 4, None], [1, 3, 4, None], [1, 3, None], [1, 3, None]]
    (masked,) = [r for r in docs.collect() if r.doc_id == 3]
    assert "[EMAIL]" in masked.text and "@" not in masked.text and masked.n_chars == len(masked.text)


def test_the_result_is_the_tokens_of_what_is_kept(spark, folder_of_tables):
    rows = corpus_pipeline.run(spark, folder_of_tables).collect()
    text = {1: prose(1), 3: prose(2) + " mail [EMAIL] now", None: prose(4)}
    assert len(rows) == 3
    for r in rows:
        ids = LIBRARY.encode(text[r.doc_id], add_special_tokens=False).ids
        assert np.frombuffer(r.ids, dtype="<u4").tolist() == ids and r.n_tokens == len(ids)


def test_every_stage_takes_an_empty_table(spark, folder_of_tables):
    docs = spark.read.parquet(f"{folder_of_tables}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder_of_tables).collect() == []


def test_names():
    assert [n for n in queries.QUERIES if n.startswith("op")] == sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert len(queries.QUERIES) == 10 and set(queries.ORACLE) <= set(queries.QUERIES)
    assert len(corpus_pipeline.STAGES) == 5
