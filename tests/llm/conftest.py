import pytest

LONG = "lorem ipsum dolor sit amet " * 4000
LINE = " ".join(f"w{i}" for i in range(80))
EDGES = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b "),
    (4, LONG),
    (5, LONG),
    (6, LINE + "\n" + LINE),
    (6, LINE + "\n" + LINE),
    (None, LINE),
    (None, None),
    (7, "é日本 \U0001f600 <|endoftext|> x@y.example +1 (212) 555-0147\r\n\x00 end"),
    (8, "one"),
    (8, "two"),
]
#: Names that the operators use themselves; as input columns they must do no harm.
CLASHES = (
    "n_words hits items fingerprint sketch rejected_by rules_run base spans ids n_tokens decoded sentence_ids licenses "
    "id node component kept removed doc start stop marks witness value file _own_hits"
).split()


@pytest.fixture
def edges(spark):
    """Null, empty, blank, long, repeated and odd texts, with clashing extra columns."""
    extra = ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame([(i, t, *["own"] * len(CLASHES)) for i, t in EDGES], f"doc_id long, text string, {extra}")


@pytest.fixture
def nothing(edges):
    return edges.where("false")
