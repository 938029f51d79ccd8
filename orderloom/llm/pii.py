"""Personal data: exact patterns, and a linear-chain conditional random field over word shapes for what they miss.

The field labels tokens (runs of digits, runs of letters, single signs) of a line with begin, inside and outside tags. It is trained on
a small labelled table by gradient ascent on the likelihood (forward-backward in numpy) and decoded by Viterbi over many
sequences at once. Tags other than outside are allowed only near a digit or an at-sign; all else is outside by definition, so lines without
either need no decoding and the rest falls into short independent sequences, with the same result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orderloom.llm.pii_labelled import LABELLED
from orderloom.llm.shipping import pieces, ready

KINDS = ("email", "ip", "card", "phone")
ORDER = {k: i for i, k in enumerate(KINDS)}
TAGS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
REACH = 6
Span = tuple[str, int, int]

# --- patterns --------------------------------------------------------------------------------------------------------
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
CARRIER = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def pattern_spans(text: str) -> list[Span]:
    """Email, ip, card and phone matches in code points, leftmost and not overlapping within a kind, by
    start and kind. Linear in the length of the text: an email is found from its at-sign, not from every possible start."""
    out: list[Span] = []
    floor = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append(("email", start, m.end()))
            floor = at = m.end()
        else:
            at += 1
            floor = at
    if CARRIER.search(text):
        if "." in text:
            for m in IP.finditer(text):
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                    out.append(("ip", m.start(), m.end()))
        for m in CARD.finditer(text):
            digits = _digits(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(_digits(m.group())) <= 15:
                    out.append(("phone", m.start(), m.end()))
    return sorted(out, key=_by_place)


def _by_place(span: Span) -> tuple[int, int, int]:
    return span[1], ORDER[span[0]], span[2]


# --- tokens and features ---------------------------------------------------------------------------------------------
TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|[^\x00-\x7F]+|[\x21-\x7E]")
JOINERS = frozenset("+-.()/:")


def _bucket(n: int, edges: tuple[int, ...]) -> str:
    return str(next((e for e in edges if n <= e), "more"))


def shape(token: str) -> str:
    c = token[0]
    if "0" <= c <= "9":
        return "d" + _bucket(len(token), (1, 2, 3, 4, 6, 9, 13, 16, 19))
    if c.isascii() and c.isalpha():
        case = "X" if token.isupper() else "x" if token.islower() else "m"
        return case + _bucket(len(token), (1, 2, 3, 6))
    return c if c.isascii() else "u"


@dataclass
class Line:
    """The tokens of one line: places, shapes and the names of their features."""

    start: list[int]
    end: list[int]
    near: list[bool]
    features: list[list[str]]


def tokens_of(text: str, offset: int = 0) -> Line:
    found = [(m.group(), m.start(), m.end()) for m in TOKEN.finditer(text)]
    n = len(found)
    start, end = [s for _, s, _ in found], [e for _, _, e in found]
    carrier = [t[0] == "@" or "0" <= t[0] <= "9" for t, _, _ in found]
    near, last = [False] * n, -REACH - 1
    for i in [i for i in range(n) if carrier[i]]:
        for j in range(max(i - REACH, last), min(n, i + REACH + 1)):
            near[max(j, 0)] = True
        last = i
    shapes = [""] * n
    for i in range(n):
        if near[i] or (i + 2 < n and near[i + 2]) or (i >= 2 and near[i - 2]) or (i + 1 < n and near[i + 1]) or (i and near[i - 1]):
            shapes[i] = shape(found[i][0])
    chunk = _chunks(found)
    features: list[list[str]] = [[]] * n
    for i in range(n):
        if not near[i]:
            continue
        at = lambda k, i=i: shapes[i + k] if 0 <= i + k < n else "^"
        gap = "_" if i == 0 or start[i] > end[i - 1] else ""
        after = "_" if i + 1 == n or start[i + 1] > end[i] else ""
        a, b, c = at(-1), at(0), at(1)
        word = found[i][0].lower()
        features[i] = [
            "s" + b, "p" + a, "n" + c, "P" + at(-2), "N" + at(2), f"ps{a}|{gap}{b}", f"sn{b}{after}|{c}",
            f"psn{a}|{gap}{b}{after}|{c}", f"g{gap}{b}{after}", "c" + chunk[i], f"cs{chunk[i]}|{b}", "w" + word if len(word) < 9 else "w",
        ]
    return Line([s + offset for s in start], [e + offset for e in end], near, features)


def _chunks(found) -> list[str]:
    """For each token how many digits and dots its run of digits, joiners and blanks has; a run ends at letters, at
    other signs and at wider gaps."""
    out, i, n = [""] * len(found), 0, len(found)
    while i < n:
        j, digits, dots, groups = i, 0, 0, 0
        while j < n and (found[j][0][0].isdigit() or found[j][0] in JOINERS) and (j == i or found[j][1] <= found[j - 1][2] + 1):
            t = found[j][0]
            digits += len(t) if t[0].isdigit() else 0
            groups += t[0].isdigit()
            dots += t == "."
            j += 1
        if j > i:
            name = f"{_bucket(digits, (0, 3, 5, 6, 9, 11, 13, 16, 19))}.{min(dots, 4)}.{_bucket(groups, (1, 2, 3, 4, 5))}"
            out[i:j] = [name] * (j - i)
        i = max(j, i + 1)
    return out


def sequences(line: Line) -> list[tuple[int, int]]:
    """Maximal runs [a, b) of tokens near a carrier."""
    out, i, n = [], 0, len(line.near)
    while i < n:
        if line.near[i]:
            j = i
            while j < n and line.near[j]:
                j += 1
            out.append((i, j))
            i = j
        else:
            i += 1
    return out


# --- the field -------------------------------------------------------------------------------------------------------
NONE = -1e9


def _allowed() -> np.ndarray:
    """Scores of tag pairs: an inside tag follows its own begin or inside only."""
    table = np.zeros((len(TAGS), len(TAGS)))
    for b, tag in enumerate(TAGS):
        if tag[0] == "I":
            for a, before in enumerate(TAGS):
                if before[2:] != tag[2:] or before == "O":
                    table[a, b] = NONE
    return table


ALLOWED = _allowed()
FIRST = np.array([NONE if t[0] == "I" else 0.0 for t in TAGS])


@dataclass
class Model:
    index: dict[str, int]
    weights: np.ndarray  # features x tags; the last row is of unknown features
    moves: np.ndarray  # tags x tags

    def scores(self, features: list[list[str]]) -> np.ndarray:
        unknown = len(self.index)
        width = max(map(len, features), default=1)
        ids = np.full((len(features), width), unknown)
        for k, names in enumerate(features):
            ids[k, : len(names)] = [self.index.get(x, unknown) for x in names]
        return self.weights[ids].sum(axis=1)


def viterbi(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best tags (sequence x position) for padded scores (sequence x position x tag)."""
    n, steps, k = scores.shape
    best = scores[:, 0] + FIRST
    back = np.zeros((n, steps, k), dtype=np.int8)
    back[:, 0] = np.arange(k)
    for t in range(1, steps):
        ways = best[:, :, None] + moves[None]
        back[:, t] = ways.argmax(axis=1)
        step = ways.max(axis=1) + scores[:, t]
        live = (t < lengths)[:, None]
        best = np.where(live, step, best)
        back[:, t] = np.where(live, back[:, t], np.arange(k))
    tags = np.zeros((n, steps), dtype=np.int8)
    tags[:, -1] = best.argmax(axis=1)
    for t in range(steps - 1, 0, -1):
        tags[:, t - 1] = back[np.arange(n), t, tags[:, t]]
    return tags


MARK = re.compile(r"\{(email|ip|card|phone):([^{}]*)\}")


def labelled_line(marked: str) -> tuple[str, list[Span]]:
    """Text and spans of a line in which spans are written ``{kind:text}``."""
    text, spans, at = "", [], 0
    for m in MARK.finditer(marked):
        text += marked[at : m.start()]
        spans.append((m.group(1), len(text), len(text) + len(m.group(2))))
        text += m.group(2)
        at = m.end()
    return text + marked[at:], spans


def _tags(line: Line, spans: list[Span]) -> list[int]:
    out = []
    for s, e in zip(line.start, line.end, strict=True):
        kind = next((x for x in spans if x[1] <= s and e <= x[2]), None)
        out.append(TAGS.index(("B-" if s == kind[1] else "I-") + kind[0]) if kind else 0)
    return out


def train(rows: list[str], steps: int = 150, rate: float = 0.15, decay: float = 0.1) -> Model:
    """Fit the field on lines with spans written ``{kind:text}``: full-batch gradient ascent (Adam) on the log-likelihood
    with a Gaussian prior. The table is meant to be small: it is held in memory as a whole."""
    index: dict[str, int] = {}
    parts: list[tuple[list[list[str]], list[int]]] = []
    for row in rows:
        text, spans = labelled_line(row)
        line = tokens_of(text)
        tags = _tags(line, spans)
        for a, b in sequences(line):
            parts.append((line.features[a:b], tags[a:b]))
            for names in line.features[a:b]:
                for x in names:
                    index.setdefault(x, len(index))
    n, steps_max, width, k = len(parts), max(len(t) for _, t in parts), 12, len(TAGS)
    ids = np.full((n, steps_max, width), len(index))
    gold = np.zeros((n, steps_max), dtype=int)
    lengths = np.array([len(t) for _, t in parts])
    for i, (features, tags) in enumerate(parts):
        gold[i, : len(tags)] = tags
        for t, names in enumerate(features):
            ids[i, t, : len(names)] = [index[x] for x in names]
    live = np.arange(steps_max) < lengths[:, None]
    rows_, cols = np.nonzero(live)
    truth = np.zeros((n, steps_max, k))
    truth[rows_, cols, gold[live]] = 1
    truth_moves = np.zeros((k, k))
    pair = live[:, 1:]
    np.add.at(truth_moves, (gold[:, :-1][pair], gold[:, 1:][pair]), 1)

    w, m = np.zeros((len(index) + 1, k)), np.zeros((k, k))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(m), np.zeros_like(m)]
    for step in range(1, steps + 1):
        moves = m + ALLOWED
        scores = w[ids].sum(axis=2)
        alpha = np.zeros((n, steps_max, k))
        alpha[:, 0] = scores[:, 0] + FIRST
        for t in range(1, steps_max):
            go = _logsum(alpha[:, t - 1, :, None] + moves[None], 1) + scores[:, t]
            alpha[:, t] = np.where(live[:, t, None], go, alpha[:, t - 1])
        total = _logsum(alpha[:, -1], 1)
        beta = np.zeros((n, steps_max, k))
        expect_moves = np.zeros((k, k))
        for t in range(steps_max - 2, -1, -1):
            ahead = scores[:, t + 1] + beta[:, t + 1]
            go = _logsum(moves[None] + ahead[:, None, :], 2)
            beta[:, t] = np.where(live[:, t + 1, None], go, beta[:, t + 1])
            p = np.exp(alpha[:, t, :, None] + moves[None] + ahead[:, None, :] - total[:, None, None])
            expect_moves += p[live[:, t + 1]].sum(axis=0)
        expect = np.exp(alpha + beta - total[:, None, None]) * live[:, :, None]
        gap = truth - expect
        grad = np.zeros_like(w)
        np.add.at(grad, ids[live], np.repeat(gap[live][:, None, :], width, axis=1))
        grad -= decay * w
        grad[-1] = 0
        for value, g, i in ((w, grad, 0), (m, truth_moves - expect_moves - decay * m, 2)):
            moments[i] = 0.9 * moments[i] + 0.1 * g
            moments[i + 1] = 0.99 * moments[i + 1] + 0.01 * g * g
            value += rate * (moments[i] / (1 - 0.9**step)) / (np.sqrt(moments[i + 1] / (1 - 0.99**step)) + 1e-8)
    w[-1] = 0
    return Model(index, w, m + ALLOWED)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


# --- finding ---------------------------------------------------------------------------------------------------------
def _plausible(kind: str, text: str) -> bool:
    digits = sum("0" <= c <= "9" for c in text)
    if kind == "phone":
        return 7 <= digits <= 15
    if kind == "card":
        return 13 <= digits <= 19 and luhn(_digits(text))
    if kind == "ip":
        return digits >= 4
    return "@" in text and not text.startswith("@")


def field_spans(texts: list[str], model: Model, budget: int = 1 << 18) -> list[list[Span]]:
    """Spans that the field finds in each text. Sequences of like length are decoded together, at most
    ``budget`` padded tokens at a time."""
    found: list[list[Span]] = [[] for _ in texts]
    queue: list[tuple[int, Line]] = []  # text, and the near tokens alone

    def flush():
        queue.sort(key=lambda x: len(x[1].start))
        at = 0
        while at < len(queue):
            stop, widest = at, 0
            while stop < len(queue) and (stop == at or len(queue[stop][1].start) * (stop - at + 1) <= budget // 16):
                widest = len(queue[stop][1].start)
                stop += 1
            part = queue[at:stop]
            lengths = np.array([len(line.start) for _, line in part])
            flat = model.scores([f for _, line in part for f in line.features])
            scores = np.zeros((len(part), widest, len(TAGS)))
            scores[np.arange(widest) < lengths[:, None]] = flat
            for (k, line), tags in zip(part, viterbi(scores, lengths, model.moves), strict=True):
                if tags[: len(line.start)].any():
                    found[k] += _spans(line, tags[: len(line.start)].tolist())
            at = stop
        queue.clear()

    held = 0
    for k, text in enumerate(texts):
        if not CARRIER.search(text):
            continue
        offset = 0
        for row in text.split("\n"):
            if CARRIER.search(row):
                line = tokens_of(row, offset)
                for a, b in sequences(line):
                    queue.append((k, Line(line.start[a:b], line.end[a:b], line.near[a:b], line.features[a:b])))
                    held += b - a
            offset += len(row) + 1
        if held >= budget:
            flush()
            held = 0
    flush()
    return [[s for s in spans if _plausible(s[0], texts[k][s[1] : s[2]])] for k, spans in enumerate(found)]


def _spans(line: Line, tags: list[int]) -> list[Span]:
    out: list[list] = []
    for i, tag in enumerate(tags):
        if not tag:
            continue
        kind = TAGS[tag][2:]
        if TAGS[tag][0] == "B" or not out:
            out.append([kind, line.start[i], line.end[i]])
        else:
            out[-1][2] = line.end[i]
    return [tuple(x) for x in out]


def all_spans(base: list[Span], more: list[Span]) -> list[Span]:
    """Base spans, and those of ``more`` that overlap none of them, by start and kind."""
    taken, out = sorted((s, e) for _, s, e in base), list(base)
    k = reach = 0
    for span in sorted(more, key=_by_place):
        while k < len(taken) and taken[k][0] < span[2]:
            reach = max(reach, taken[k][1])
            k += 1
        if reach <= span[1]:
            out.append(span)
    return sorted(out, key=_by_place)


SPAN = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
)
_default: list[Model] = []


def default_model() -> Model:
    """The field trained on the labelled table of this package."""
    if not _default:
        _default.append(train(LABELLED))
    return _default[0]


def labelled_rows(table: DataFrame, column: str = "text", max_rows: int = 10_000) -> list[str]:
    """Training lines of a table, at most ``max_rows`` of them (the bound of the sample), in no particular order."""
    return [r[0] for r in table.where(F.col(column).isNotNull()).select(column).limit(max_rows).collect()]


def find(docs: DataFrame, model: Model | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` (spans of the patterns) and ``spans`` (those and what the field adds), each an array of
    (kind, start, end) in code points, end exclusive, by start and then kind (email, ip, card, phone).

    The model (some thousand weights) is sent to every task. Spans of the field that overlap a base span are dropped, as are
    phones without 7 to 15 digits, cards without a valid check digit and emails without an at-sign. Null and empty texts have no spans; rows are
    independent, so repeated rows get equal results. Result columns replace input columns of the same name.
    """
    weights = ready(docs).sparkContext.broadcast(model or default_model())
    own = [f for f in docs.schema.fields if f.name not in ("base", "spans")]
    schema = T.StructType([*own, *(T.StructField(c, T.ArrayType(SPAN)) for c in ("base", "spans"))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text=text):
            texts = [t or "" for t in batch.column(text).to_pylist()]
            base = [pattern_spans(t) for t in texts]
            every = [all_spans(b, m) for b, m in zip(base, field_spans(texts, weights.value), strict=True)]
            made = [
                pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans] for spans in column], arrow.field("base").type)
                for column in (base, every)
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in own), *made], schema=arrow)

    return docs.select(*(F.col(f"`{f.name}`") for f in own)).mapInArrow(run, schema)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans are one, named by the first."""
    parts, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def mask(docs: DataFrame, model: Model | None = None, text: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by ``[EMAIL]``, ``[IP]``, ``[CARD]`` or ``[PHONE]``; null stays null."""
    weights = ready(docs).sparkContext.broadcast(model or default_model())
    arrow = to_arrow_schema(docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text=text):
            values = batch.column(text).to_pylist()
            more = field_spans([t or "" for t in values], weights.value)
            out = [t and masked(t, all_spans(pattern_spans(t), m)) for t, m in zip(values, more, strict=True)]
            made = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays([made if n == text else batch.column(n) for n in arrow.names], schema=arrow)

    return docs.mapInArrow(run, docs.schema)
