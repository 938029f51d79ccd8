"""Byte-pair encoding and decoding with a given byte-level vocabulary.

A piece of text is encoded by backtracking: an Aho-Corasick automaton over the vocabulary gives the longest token at every
position; the encoder takes it if it may stand after the token before it, tries the next shorter one if not, and goes
back where none fits. Whether two tokens may stand side by side is what merging them in rank order would tell; the
answers are kept in a pair table. The first sequence found is exactly that of the merges, and no position is given up twice,
so the time is linear in the length of the piece. Decoding copies slices of one byte string through an offset table.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Regex as TokenizersRegex
from tokenizers.pre_tokenizers import Split

from orderloom.llm.shipping import pieces, ready

#: The splitting pattern of byte-level vocabularies (a fixed value), with the classes of letters, numbers and spaces by name.
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
#: The same for texts of characters below U+0250 only, in plain ranges that the standard engine matches several times faster.
LATIN_LETTER = r"A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
LATIN_NUMBER = r"0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
LATIN_SPACE = r"\t-\r \u0085\u00a0"
LATIN = re.compile(
    f"'(?:[stmd]|re|ve|ll)| ?[{LATIN_LETTER}]+| ?[{LATIN_NUMBER}]+| ?[^{LATIN_SPACE}{LATIN_LETTER}{LATIN_NUMBER}]+"
    f"|[{LATIN_SPACE}]+(?![^{LATIN_SPACE}])|[{LATIN_SPACE}]+"
)
BEYOND_LATIN = re.compile(r"[^\u0000-\u024f]")
#: How many distinct pieces, and pairs, a worker remembers before it starts again.
CACHE = 150_000


def byte_chars() -> dict[str, int]:
    """The character that stands for each byte in vocabulary files: itself if it is printable in Latin-1,
    otherwise the next free one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@cache
def any_text() -> re.Pattern:
    """The splitting pattern with the classes as the tokenizers library knows them.

    Libraries follow different versions of Unicode, so the library itself is asked: it takes apart one text of all characters in order.
    The planes beyond the third have no letters, numbers or spaces; a test asks for each character there is.
    """
    every = "".join(chr(c) for c in range(0x40000) if not 0xD800 <= c < 0xE000)
    classes = {}
    for name, members in (("L", r"\p{L}+"), ("N", r"\p{N}+"), ("S", r"\s+")):
        others = Split(TokenizersRegex(members), "removed").pre_tokenize_str(every)
        stops = [0, *(end for _, (_, end) in others)]
        starts = [*(begin for _, (begin, _) in others), len(every)]
        runs = [(every[a], every[b - 1]) for a, b in zip(stops, starts, strict=True) if a < b]
        classes[name] = "".join(f"\\U{ord(x):08x}-\\U{ord(y):08x}" for x, y in runs)
    pattern = PATTERN
    for name, members in classes.items():
        pattern = pattern.replace(f"{{{name}}}", members)
    return re.compile(pattern)


class Codec:
    """Encoder and decoder for the bytes of a tokenizer file."""

    def __init__(self, file: bytes):
        spec = json.loads(file)
        model, split = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or split["type"] != "ByteLevel" or spec["normalizer"] or split["add_prefix_space"]:
            raise ValueError("only plain byte-level BPE vocabularies are supported")
        byte_of = byte_chars()
        self.bytes_of: dict[int, bytes] = {i: bytes(byte_of[c] for c in t) for t, i in model["vocab"].items()}
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.id_of = {t.decode("latin-1"): i for i, t in self.bytes_of.items()}
        self.text_of = {i: t for t, i in self.id_of.items()}
        self.size = {i: len(t) for t, i in self.id_of.items()}

        self.rank: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.merge: dict[tuple[int, int], int] = {}
        for k, pair in enumerate(model["merges"]):
            a, b = (model["vocab"][x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            whole = self.id_of[self.text_of[a] + self.text_of[b]]
            self.merge[a, b] = k
            if whole not in self.rank:
                self.rank[whole], self.halves[whole] = k, (a, b)

        self.automaton = ahocorasick.Automaton()
        for t, i in self.id_of.items():
            if len(t) == 1 or i in self.rank:
                self.automaton.add_word(t, i)
        self.automaton.make_automaton()
        self.shorter: dict[int, int | None] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}

        size = max([*self.bytes_of, *self.added.values()], default=-1) + 1
        every = [b""] * size
        for i, t in [*self.bytes_of.items(), *((i, c.encode()) for c, i in self.added.items())]:
            every[i] = t
        self.blob = np.frombuffer(b"".join(every), dtype=np.uint8)
        self.offsets = np.cumsum([0, *map(len, every)])

        self.special = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None

    def split(self, text: str) -> list[str]:
        return (any_text() if BEYOND_LATIN.search(text) else LATIN).findall(text)

    # --- encoding ----------------------------------------------------------------------------------------------------
    def compatible(self, a: int, b: int) -> bool:
        """Whether merging in rank order leaves a boundary between tokens a and b.

        The merge made last on either side is undone step by step; the boundary would have been merged away if
        the pair that meets there has a merge that comes before the one just undone. Of equal merges the left one comes first.
        """
        key = a, b
        if (known := self.fits.get(key)) is not None:
            return known
        before = len(self.merge)
        while True:
            if self.merge.get((a, b), before) < before:
                fits = False
                break
            last_a, last_b = self.rank.get(a, -1), self.rank.get(b, -1)
            if last_a < 0 and last_b < 0:
                fits = True
                break
            if last_a > last_b:
                before, a = last_a, self.halves[a][1]
            else:
                before, b = last_b + 1, self.halves[b][0]
        if len(self.fits) >= CACHE:
            self.fits.clear()
        self.fits[key] = fits
        return fits

    def _shorter(self, token: int) -> int | None:
        """The longest token that begins this one, itself apart."""
        if token not in self.shorter:
            t = self.text_of[token]
            found = (self.id_of[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.id_of)
            self.shorter[token] = next((i for i in found if i in self.rank or len(self.text_of[i]) == 1), None)
        return self.shorter[token]

    def merge_piece(self, piece: str) -> list[int]:
        """The tokens of a piece given as one character per byte."""
        n, size, fits = len(piece), self.size, self.fits
        longest, length = [0] * n, [0] * n
        for end, token in self.automaton.iter(piece):
            m = size[token]
            if m > length[end - m + 1]:
                longest[end - m + 1], length[end - m + 1] = token, m
        closed = bytearray(n + 1)
        out: list[int] = []
        at, token, last = 0, longest[0], -1
        while at < n:
            candidate: int | None = token
            while candidate is not None:
                end = at + size[candidate]
                if not closed[end]:
                    if last < 0:
                        break
                    fit = fits.get((last, candidate))
                    if self.compatible(last, candidate) if fit is None else fit:
                        break
                candidate = self.shorter[candidate] if candidate in self.shorter else self._shorter(candidate)
            if candidate is None:  # nothing fits behind the last token: take it back and end it earlier
                closed[at] = 1
                token = out.pop()
                at -= size[token]
                last = out[-1] if out else -1
            else:
                out.append(candidate)
                last, at = candidate, end
                if at < n:
                    token = longest[at]
        return out

    def _piece(self, piece: str) -> bytes:
        ids = self.merge_piece(piece.encode().decode("latin-1"))
        if len(self.known) >= CACHE:
            self.known.clear()
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= 64:
            self.known[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """The token ids of a text as little-endian unsigned 32-bit integers."""
        known, out, at = self.known.get, [], 0
        for match in self.special.finditer(text) if self.special and "<" in text else ():
            out += [known(p) or self._piece(p) for p in self.split(text[at : match.start()])]
            out.append(np.array([self.added[match.group()]], dtype="<u4").tobytes())
            at = match.end()
        out += [known(p) or self._piece(p) for p in self.split(text[at:] if at else text)]
        return b"".join(out)

    # --- decoding ----------------------------------------------------------------------------------------------------
    def decode(self, packed: bytes) -> str:
        """The text of token ids; bytes that are no UTF-8 become replacement characters, unknown ids nothing."""
        ids = np.frombuffer(packed, dtype="<u4").astype(np.int64)
        ids = ids[ids < len(self.offsets) - 1]
        begin = self.offsets[ids]
        lengths = self.offsets[ids + 1] - begin
        ends = np.cumsum(lengths)
        if not len(ends):
            return ""
        where = np.repeat(begin - (ends - lengths), lengths) + np.arange(ends[-1])
        return self.blob[where].tobytes().decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(file: bytes) -> Codec:
    """The codec of a tokenizer file; a worker builds it once."""
    key = hashlib.sha256(file).hexdigest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(file)
    return _codecs[key]


def _shared(df: DataFrame, tokenizer: str) -> Broadcast:
    """The tokenizer file, a few megabytes whatever the data, for all executors."""
    with open(tokenizer, "rb") as f:
        return ready(df).sparkContext.broadcast(f.read())


def _apply(df: DataFrame, source: str, made: list[T.StructField], step) -> DataFrame:
    own = [f for f in df.schema.fields if f.name not in {m.name for m in made} or f.name == source]
    names = {m.name for m in made}
    schema = T.StructType([*(f for f in own if f.name not in names), *made])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text=source):
            columns = step(batch.column(source))
            yield pa.RecordBatch.from_arrays(
                [columns[f.name] if f.name in names else batch.column(f.name) for f in arrow], schema=arrow
            )

    return df.select(*(F.col(f"`{f.name}`") for f in own)).mapInArrow(run, schema)


def encode(docs: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids", n_tokens: str = "n_tokens") -> DataFrame:
    """``docs`` with ``ids`` (binary: token ids as little-endian unsigned 32-bit integers) and ``n_tokens``.

    ``tokenizer`` is the path of a byte-level BPE file on the driver. Special tokens written out in a text become their ids, as the
    tokenizers library does it; none are added. Null and empty texts have no tokens. Texts are never cut. Result
    columns replace input columns of the same name.
    """
    file = _shared(docs, tokenizer)

    def step(texts):
        c = codec(file.value)
        packed = [c.encode(t) if t else b"" for t in texts.to_pylist()]
        return {ids: pa.array(packed, pa.binary()), n_tokens: pa.array([len(p) // 4 for p in packed], pa.int64())}

    return _apply(docs, text, [T.StructField(ids, T.BinaryType()), T.StructField(n_tokens, T.LongType())], step)


def decode(tokens: DataFrame, tokenizer: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``tokens`` with the ``text`` that the ids stand for, special tokens written out; null ids give an empty text."""
    file = _shared(tokens, tokenizer)

    def step(packed):
        c = codec(file.value)
        return {text: pa.array([c.decode(p) if p else "" for p in packed.to_pylist()], pa.string())}

    return _apply(tokens, ids, [T.StructField(text, T.StringType())], step)
