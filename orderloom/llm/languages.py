"""Language of a text in two steps: its family first, then which of the family's languages.

Texts become counts of hashed one- to three-letter sequences, dampened by square roots and brought to length one. Families are told apart by
linear support vector machines, one for each pair of families, and so are the languages of a family, one for each pair; the class
that wins most pairs is chosen. A machine of the second step has seen its two languages only, so it spends its weights on what
parts close relatives. All machines are trained here, by dual coordinate descent on a bounded sample of labelled texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orderloom.llm.shipping import pieces, ready

#: Families by language code (fixed values); a language not named here is a family of its own.
FAMILIES = {
    "Germanic": "en de nl sv da no nb nn is fy af lb yi",
    "Romance": "fr es it pt ro ca gl oc",
    "Slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "Uralic": "fi et hu",
    "Turkic": "tr az kk uz tk ky",
    "Indo-Aryan": "hi ur bn mr ne gu pa",
    "Semitic": "ar he am mt",
    "Celtic": "ga cy gd br",
    "Baltic": "lt lv",
}
#: Buckets that letter sequences are hashed to.
BUCKETS = 1 << 12
#: Texts whose features are held at a time; with ``pieces`` this bounds a worker's memory.
AT_ONCE = 512
#: Code points whose sequences are hashed at a time.
STEP = 1 << 20
UNKNOWN = "und"


def family_of(lang: str) -> str:
    code = lang.lower().split("-")[0].split("_")[0]
    return next((name for name, codes in FAMILIES.items() if code in codes.split()), lang)


# --- features --------------------------------------------------------------------------------------------------------
@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def features(texts: list[str | None]) -> np.ndarray:
    """One row for each text, of length one; zeros for a text without a letter.

    Letters are lower-cased, any run of other characters is one gap, and sequences may begin or end at a gap.
    """
    lowered = [" " + (t or "").lower() + " " for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le"), dtype="<u4")
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in lowered])
    letter = np.zeros(len(points), dtype=bool)
    for at in range(0, len(points), STEP):
        letter[at : at + STEP] = _letters()[points[at : at + STEP]]
    keep = letter.copy()
    keep[:1] = True
    keep[1:] |= letter[:-1] | (owner[1:] != owner[:-1])
    points, owner, letter = np.where(letter, points, np.uint32(32))[keep], owner[keep], letter[keep]
    counts = np.zeros(len(texts) * BUCKETS)
    for at in range(0, len(points), STEP):
        hashed = np.zeros(min(STEP, len(points) - at), dtype=np.uint64)
        for n in (1, 2, 3):
            held = min(STEP, len(points) - at - n + 1)
            if held <= 0:
                break
            hashed = hashed[:held] * np.uint64(0x100000001B3) + points[at + n - 1 : at + n - 1 + held] + np.uint64(n)
            some = letter[at : at + held].copy()  # a letter, and one text from end to end
            for k in range(1, n):
                some |= letter[at + k : at + k + held]
            some &= owner[at : at + held] == owner[at + n - 1 : at + n - 1 + held]
            mixed = hashed[some] * np.uint64(0x9E3779B97F4A7C15)
            place = owner[at : at + held][some].astype(np.int64) * BUCKETS + (mixed >> np.uint64(52)).astype(np.int64)
            counts += np.bincount(place, minlength=len(counts))
    rows = np.sqrt(counts.reshape(len(texts), BUCKETS))
    norm = np.sqrt((rows * rows).sum(1, keepdims=True))
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)


# --- machines --------------------------------------------------------------------------------------------------------
def machine(rows: np.ndarray, members: np.ndarray, positive: np.ndarray, cost: float = 20.0, rounds: int = 15) -> np.ndarray:
    """Weights of a linear support vector machine with squared hinge loss for the rows with the numbers ``members``, the last
    weight being the offset.

    Dual coordinate descent: one multiplier is set to its best value at a time. Classes of different size weigh the same.
    """
    y = np.where(positive, 1.0, -1.0)
    share = np.where(positive, positive.mean(), 1 - positive.mean())
    soft = share / cost  # 1 / (2 C) of the usual notation, by class
    weights, offset, alpha = np.zeros(rows.shape[1]), 0.0, np.zeros(len(members))
    own = np.array([float(rows[m] @ rows[m]) for m in members]) + 1 + soft
    order = np.random.default_rng(17)
    for _ in range(rounds):
        for i in order.permutation(len(members)):
            row = rows[members[i]]
            slope = y[i] * (row @ weights + offset) - 1 + soft[i] * alpha[i]
            better = max(alpha[i] - slope / own[i], 0.0)
            if better != alpha[i]:
                step = (better - alpha[i]) * y[i]
                weights += step * row
                offset += step
                alpha[i] = better
    return np.append(weights, offset)


@dataclass
class Votes:
    """Machines for all pairs of some classes."""

    classes: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray

    @classmethod
    def trained(cls, rows: np.ndarray, members: np.ndarray, labels: np.ndarray) -> Votes:
        """From the rows with the numbers ``members``, whose classes are ``labels``."""
        classes = sorted(set(labels.tolist()))
        pairs = list(combinations(range(len(classes)), 2))
        weights = np.zeros((len(pairs), rows.shape[1] + 1))
        for k, (a, b) in enumerate(pairs):
            both = np.flatnonzero((labels == classes[a]) | (labels == classes[b]))
            weights[k] = machine(rows, members[both], labels[both] == classes[a])
        return cls(classes, pairs, weights)

    def decide(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The winner of each row and how sure its closest pair is, from 0 to 1; of equal votes the larger sum of margins wins."""
        n, k = len(rows), len(self.classes)
        if k < 2:
            return np.zeros(n, dtype=np.int64), np.ones(n)
        margins = rows @ self.weights[:, :-1].T + self.weights[:, -1]
        votes, total, least = np.zeros((n, k)), np.zeros((n, k)), np.full((n, k), np.inf)
        for m, (a, b) in zip(margins.T, self.pairs, strict=True):
            for c, side in ((a, m), (b, -m)):
                votes[:, c] += side > 0 if c == b else side >= 0
                total[:, c] += np.tanh(side)
                least[:, c] = np.minimum(least[:, c], side)
        won = (votes + total / (4 * k)).argmax(1)
        return won, 1 / (1 + np.exp(-2 * np.clip(least[np.arange(n), won], -30, 30)))


@dataclass
class Model:
    families: Votes
    languages: list[Votes]

    @classmethod
    def trained(cls, rows: np.ndarray, langs: list[str]) -> Model:
        every, langs = np.arange(len(rows)), np.array(langs, dtype=object)
        family = np.array([family_of(x) for x in langs], dtype=object)
        families = Votes.trained(rows, every, family)
        return cls(families, [Votes.trained(rows, every[family == f], langs[family == f]) for f in families.classes])

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names: list[str] = []
        scores = []
        for at in range(0, len(texts), AT_ONCE):
            rows = features(texts[at : at + AT_ONCE])
            family, sure = self.families.decide(rows)
            found = np.empty(len(rows), dtype=object)
            for f, votes in enumerate(self.languages):
                mine = np.flatnonzero(family == f)
                if len(mine):
                    won, inside = votes.decide(rows[mine])
                    found[mine] = [votes.classes[w] for w in won]
                    sure[mine] *= inside
            blank = ~rows.any(1)
            found[blank], sure[blank] = UNKNOWN, 0.0
            names += found.tolist()
            scores.append(sure)
        return names, np.concatenate(scores) if scores else np.zeros(0)


# --- Spark -----------------------------------------------------------------------------------------------------------
def held_out(key: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """Whether a document is kept from training: the CRC-32 of its id as text, modulo ``parts``, is ``part``; false for a null id."""
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % parts == part, F.lit(False))


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", max_rows: int = 4000) -> Model | None:
    """A model of all languages in ``labelled``; None if it has no text with a letter and a language.

    Languages and their numbers come from all rows. At most ``max_rows`` different texts, and the same number of each language where there are
    as many, are fitted: those with the smallest hashes of text and language. The limit of a language's hashes follows from its
    number of texts, with a fifth to spare, so no task sorts a language; what is over is cut off here. Hashes and features of
    these texts come to the driver, at most about 1.2 times ``max_rows`` rows of ``BUCKETS`` 16-bit numbers.
    """
    ready(labelled)
    rows = labelled.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    rows = rows.where(F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull())
    hashes = rows.select("lang", F.xxhash64("text", "lang").alias("h")).distinct()
    counts = {r["lang"]: r["count"] for r in hashes.groupBy("lang").count().collect()}  # one row for each language
    if not counts:
        return None
    each = max(max_rows // len(counts), 1)
    limits = {x: min(int(2**64 * min(1.2 * each / n, 1)) - 2**63, 2**63 - 1) for x, n in counts.items()}
    most = F.create_map(*(F.lit(v) for pair in limits.items() for v in pair))
    chosen = rows.withColumn("h", F.xxhash64("text", "lang")).where(F.col("h") <= most[F.col("lang")])
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("h", T.LongType()), T.StructField("row", T.BinaryType())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()  # copies of a text within a task are measured once
        for batch in pieces(batches):
            hashed = batch.column("h").to_pylist()
            new = [i for i, h in enumerate(hashed) if not (h in known or known.add(h))]
            for at in range(0, len(new), AT_ONCE):
                part = batch.take(pa.array(new[at : at + AT_ONCE]))
                made = features(part.column("text").to_pylist()).astype(np.float16)
                columns = [part.column("lang"), part.column("h"), pa.array([r.tobytes() for r in made], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=to_arrow_schema(schema))

    measured = chosen.select("text", "lang", "h").mapInArrow(measure, schema)
    found = sorted(measured.groupBy("lang", "h").agg(F.first("row").alias("row")).collect(), key=lambda r: (r["lang"], r["h"]))
    taken: dict[str, int] = {}
    sample = []
    for r in found:
        taken[r["lang"]] = taken.get(r["lang"], 0) + 1
        if taken[r["lang"]] <= each:
            sample.append(r)
    matrix = np.empty((len(sample), BUCKETS), dtype=np.float32)
    for row, r in zip(matrix, sample, strict=True):
        row[:] = np.frombuffer(r["row"], dtype=np.float16)
    langs = [r["lang"] for r in sample]
    del found, sample
    return Model.trained(matrix, langs)


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``lang_pred`` and ``score`` (how sure the closest decisions on the way were, from 0 to 1).

    The text is all that a prediction looks at. A null text, and one without a letter, has ``und`` and 0; so have all texts if there is
    no model. Result columns replace input columns of the same name.
    """
    spark = ready(docs)
    made = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    own = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score", text)]
    schema = T.StructType([*own, *made])
    arrow = to_arrow_schema(schema)
    shared = spark.sparkContext.broadcast(model)  # a few weights for each pair of languages, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text="_text"):
            texts = batch.column("_text").to_pylist()
            names, scores = shared.value.predict(texts) if shared.value else ([UNKNOWN] * len(texts), np.zeros(len(texts)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in own), pa.array(names, pa.string()), pa.array(scores, pa.float64())], schema=arrow
            )

    return docs.select(*(F.col(f"`{f.name}`") for f in own), F.col(f"`{text}`").alias("_text")).mapInArrow(run, schema)
