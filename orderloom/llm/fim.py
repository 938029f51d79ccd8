"""Fill-in-middle: cut each text into prefix, middle and suffix at unit boundaries and put the middle last.

A unit is a run of Latin letters or any other single character. The boundaries of a slice of texts form one rising
sequence of offsets, and a learned rank index stands for it: line segments fitted so that none misses an offset by more than
``MAX_ERROR``, and for each boundary the difference between its offset and the line, in one byte. A cut, given as a rank, is predicted by the
segment that holds it and made exact by the stored difference.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orderloom.llm.shipping import pieces, ready

#: Marks before prefix, suffix and middle (fixed values).
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: The largest difference between a boundary and its segment; it fits a signed byte.
MAX_ERROR = 120


class RankIndex:
    """Rank to offset for a rising sequence of offsets.

    Segments are fitted from left to right: the lines through a segment's first point that miss no point so far by more
    than the bound form a cone of slopes, and the segment ends where the cone is empty.
    """

    def __init__(self, offsets: np.ndarray, max_error: int = MAX_ERROR):
        if not 1 <= max_error <= 126:
            raise ValueError("the error bound must be between 1 and 126")
        first, slope, at, n = [], [], 0, len(offsets)
        while at < n:
            stop, line = self._segment(offsets, at, max_error)
            first.append(at)
            slope.append(line)
            at = stop
        self.first = np.array(first, dtype=np.int64)
        self.slope = np.array(slope, dtype=np.float64)
        self.base = offsets[self.first].astype(np.int64) if n else self.first
        self.residual = np.zeros(n, dtype=np.int8)
        guess = self._predict(np.arange(n), np.repeat(np.arange(len(first)), np.diff([*first, n])) if n else self.first)
        self.residual[:] = offsets - guess

    @staticmethod
    def _segment(offsets: np.ndarray, at: int, max_error: int) -> tuple[int, float]:
        """Where the segment that begins at ``at`` ends, and its slope."""
        low, high, done, width = -np.inf, np.inf, at + 1, 512
        while done < len(offsets):
            stop = min(done + width, len(offsets))
            run = np.arange(done - at, stop - at, dtype=np.float64)
            rise = (offsets[done:stop] - offsets[at]).astype(np.float64)
            least = np.maximum(np.maximum.accumulate((rise - max_error) / run), low)
            most = np.minimum(np.minimum.accumulate((rise + max_error) / run), high)
            broken = np.flatnonzero(least > most)
            if len(broken):
                k = int(broken[0])
                if k:
                    low, high = least[k - 1], most[k - 1]
                done += k
                break
            low, high, done, width = least[-1], most[-1], stop, 2 * width
        return done, float((low + high) / 2) if np.isfinite(low) else 0.0

    def _predict(self, ranks: np.ndarray, segments: np.ndarray) -> np.ndarray:
        return self.base[segments] + np.rint((ranks - self.first[segments]) * self.slope[segments]).astype(np.int64)

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offsets of boundaries."""
        segments = np.searchsorted(self.first, ranks, side="right") - 1
        return self._predict(ranks, segments) + self.residual[ranks]


def boundaries(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Offsets in code points at which units of the joined texts start, with the end of all behind them;
    and the rank of the first boundary of each text, with that of the end behind them."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4")
    letter = ((points >= 65) & (points <= 90)) | ((points >= 97) & (points <= 122))
    begins = np.cumsum([0, *map(len, texts)])
    starts = np.ones(len(points) + 1, dtype=bool)
    starts[1:-1] = ~(letter[1:] & letter[:-1])
    starts[begins] = True
    offsets = np.flatnonzero(starts)
    return offsets, np.searchsorted(offsets, begins)


def draws(key: object) -> tuple[int, int, int, int]:
    """Four numbers below 2**32 drawn by hash for a document; a missing id is drawn for as if it were empty."""
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4], "big") for k in range(0, 16, 4))


def arrange(texts: list[str], keys: list[object], plain_share: int, spm_share: int) -> list[tuple]:
    """(units, form, prefix length, middle length, output) of each text."""
    offsets, first = boundaries(texts)
    index = RankIndex(offsets)
    units = np.diff(first)
    chance = np.array([draws(k) for k in keys], dtype=np.int64).reshape(-1, 4)
    cuts = np.sort(chance[:, :2] % (units + 1)[:, None], axis=1)
    begins = offsets[first[:-1]]
    at = index.offsets(first[:-1, None] + cuts) - begins[:, None] if len(texts) else cuts
    rows = []
    for text, n, (_, _, third, fourth), (a, b) in zip(texts, units.tolist(), chance.tolist(), at.tolist(), strict=True):
        marked = any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) if "<" in text else False
        if not text or marked or third % 100 >= 100 - plain_share:
            rows.append((n, "plain", None, None, text))
            continue
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if fourth % 100 < spm_share:
            rows.append((n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"))
        else:
            rows.append((n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"))
    return rows


MADE = T.StructType(
    [
        T.StructField("n_units", T.LongType()),
        T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType()),
    ]
)


def transform(
    docs: DataFrame, text: str = "text", key: str = "doc_id", plain_share: int = 10, spm_share: int = 20
) -> DataFrame:
    """``docs`` with ``n_units``, ``form`` (``plain``, ``psm`` or ``spm``), ``prefix_chars`` and ``middle_chars`` (null if plain) and
    ``output`` in place of the text.

    Cuts and form depend on ``key`` and the number of units only. ``plain_share`` percent stay as they are, and so do empty texts
    and texts that hold a mark; of the rest ``spm_share`` percent put the suffix first. A null text is empty; a null key is drawn for
    like an empty one; repeated rows get equal results. Texts are whole, however long. Result columns replace input
    columns of the same name.
    """
    ready(docs)
    made = {f.name for f in MADE}
    own = [f for f in docs.schema.fields if f.name not in made | {text}]
    schema = T.StructType([*own, *MADE.fields])
    arrow = to_arrow_schema(schema)
    read = [*(F.col(f"`{f.name}`") for f in own), F.col(f"`{text}`").alias("_text"), F.col(f"`{key}`").alias("_key")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text="_text"):
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            rows = arrange(texts, batch.column("_key").to_pylist(), plain_share, spm_share)
            columns = [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(to_arrow_schema(MADE))]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in own), *columns], schema=arrow)

    return docs.select(*read).mapInArrow(run, schema)


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text that an output was made of."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )
