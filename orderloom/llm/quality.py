"""Quality rules as a short-circuit cascade: cheap rules that reject much go first.

A rule sees one document and says whether it is bad. Each is costed on a sample: seconds per document and the share it
rejects. Rules then run in the order of rejections per second, and the first that rejects a document ends its
evaluation. The order decides how much work is done, never which documents are kept.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orderloom.llm.shipping import pieces, raw_texts, ready, set_aside



class Document:
    """Measures of one text, each computed when first asked for. Words are runs of anything but space
    and the control characters 9 to 13."""

    def __init__(self, raw: bytes):
        self.raw = raw

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        joined = b"".join(self.words)
        return len(joined) - len(joined.translate(None, LEADING))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, b"#*$%&|<>"))

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines with a word."""
        return [x for x in self.raw.split(b"\n") if x and not x.isspace()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        w = self.words
        windows = list(zip(w, w[1:], w[2:], strict=False))
        if len(set(windows)) == len(windows):
            return 0
        count = Counter(windows)
        total, end = 0, 0
        for i, x in enumerate(windows):
            if count[x] > 1:
                total += i + 3 - max(i, end)
                end = i + 3
        return total

    @cached_property
    def shouted(self) -> int:
        """Words with an ASCII capital and no small ASCII letter."""
        return sum(1 for x in self.words if x.isupper())

    @cached_property
    def exclaimed(self) -> int:
        return self.raw.count(b"!")

    @cached_property
    def spoken(self) -> int:
        """Words with a letter: an ASCII letter, or any non-ASCII character."""
        return sum(1 for x in self.words if x.translate(None, NO_LETTER))


#: Bytes that begin a code point; bytes that are no part of a letter.
LEADING = bytes(b for b in range(256) if not 0x80 <= b < 0xC0)
NO_LETTER = bytes(b for b in range(128) if not chr(b).isalpha())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Document], bool]


def standard_rules(
    min_words: int = 50,
    repeated: float = 0.5,
    symbols_per_word: float = 0.1,
    word_length: tuple[float, float] = (2.0, 30.0),
    with_letters: float = 0.7,
    shouted: float = 0.5,
    exclaimed: float = 0.3,
) -> tuple[Rule, ...]:
    """Rules on length, repetition, symbols, word length, letters, capitals and exclamation marks."""
    return (
        Rule("few_words", lambda d: d.n_words < min_words),
        Rule("repeated_words", lambda d: d.n_repeat_words > repeated * d.n_words),
        Rule("symbols", lambda d: d.n_symbols > symbols_per_word * d.n_words),
        Rule(
            "word_length",
            lambda d: not word_length[0] * d.n_words <= d.word_chars <= word_length[1] * d.n_words,
        ),
        Rule("few_letters", lambda d: d.spoken < with_letters * d.n_words),
        Rule("shouted", lambda d: d.shouted > shouted * d.n_words),
        Rule("exclaimed", lambda d: d.exclaimed > exclaimed * d.n_words),
    )


def estimate(docs: DataFrame, rules: tuple[Rule, ...], sample_docs: int = 4000, text: str = "text") -> list[dict]:
    """Cost and selectivity of each rule on a random sample of about ``sample_docs`` documents.

    Every rule is timed alone on a fresh document, so what it needs to compute is part of its cost.
    Only sums by rule reach the driver. An empty sample leaves every rule at zero.
    """
    ready(docs)
    total = docs.count()
    fraction = min(1.0, sample_docs / max(total, 1))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seconds, rejected, seen = [0.0] * len(rules), [0] * len(rules), 0
        for batch in batches:
            for raw in raw_texts(batch.column(0)):
                seen += 1
                for k, rule in enumerate(rules):
                    began = time.perf_counter()
                    bad = rule.rejects(Document(raw))
                    seconds[k] += time.perf_counter() - began
                    rejected[k] += bad
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(rules)), pa.int32()), pa.array(seconds), pa.array(rejected), pa.array([seen] * len(rules))],
            names=["rule", "seconds", "rejected", "seen"],
        )

    sample = docs.select(F.col(text).alias("text")).sample(fraction=fraction, seed=7)
    rows = (
        sample.mapInArrow(measure, "rule int, seconds double, rejected long, seen long")
        .groupBy("rule")
        .agg(F.sum("seconds"), F.sum("rejected"), F.sum("seen"))
        .collect()
    )
    found = {r[0]: r[1:] for r in rows}
    none = (0.0, 0, 0)
    return [
        {
            "rule": rule.name,
            "cost": found.get(k, none)[0] / max(1, found.get(k, none)[2]),
            "selectivity": found.get(k, none)[1] / max(1, found.get(k, none)[2]),
        }
        for k, rule in enumerate(rules)
    ]


def cascade(rules: tuple[Rule, ...], estimates: list[dict]) -> tuple[Rule, ...]:
    """The rules by rejections per second, most first; ties by name."""
    rate = {e["rule"]: e["selectivity"] / max(e["cost"], 1e-9) for e in estimates}
    return tuple(sorted(rules, key=lambda r: (-rate.get(r.name, 0.0), r.name)))


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(
    docs: DataFrame,
    rules: tuple[Rule, ...] | None = None,
    measures: tuple[str, ...] = (),
    sample_docs: int = 4000,
    text: str = "text",
) -> DataFrame:
    """``docs`` with ``rejected_by`` (the first rule of the cascade that rejects, null if none does),
    ``rules_run`` and, if asked for, ``measures`` of the text.

    Null and empty texts have no words; ``few_words`` rejects them under the standard rules. Rows are judged
    one by one, so repeated rows get equal verdicts. Result columns replace input columns of the same name.
    """
    ready(docs)
    rules = standard_rules() if rules is None else rules
    ordered = cascade(rules, estimate(docs, rules, sample_docs, text))
    made = [
        T.StructField("rejected_by", T.StringType()),
        T.StructField("rules_run", T.LongType()),
        *(T.StructField(m, T.LongType()) for m in measures),
    ]
    own = [f for f in docs.schema.fields if f.name not in {m.name for m in made} or f.name == text]
    schema = T.StructType([*own, *made])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text=text):
            columns: list[list] = [[] for _ in made]
            for raw in raw_texts(batch.column(text)):
                doc = Document(raw)
                by, k = None, 0
                for k, rule in enumerate(ordered, 1):  # noqa: B007
                    if rule.rejects(doc):
                        by = rule.name
                        break
                for column, value in zip(columns, (by, k, *(getattr(doc, m) for m in measures)), strict=True):
                    column.append(value)
            arrays = [batch.column(f.name) for f in own]
            arrays += [pa.array(c, arrow.field(m.name).type) for c, m in zip(columns, made, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return docs.select(*(F.col(f"`{f.name}`") for f in own)).mapInArrow(run, schema)


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] | None = None, **options) -> DataFrame:
    """The documents that no rule rejects, in their own columns."""
    apart, back = set_aside(docs, {"rejected_by", "rules_run"})
    return judge(apart, rules, **options).where("rejected_by is null").select(*back)
