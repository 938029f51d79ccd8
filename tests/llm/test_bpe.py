import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from orderloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def both():
    with open(PATH, "rb") as f:
        return bpe.Codec(f.read()), Tokenizer.from_file(PATH)


def same(both, text):
    codec, library = both
    ids = library.encode(text, add_special_tokens=False).ids
    packed = codec.encode(text)
    assert np.frombuffer(packed, dtype="<u4").tolist() == ids, text[:80]
    assert codec.decode(packed) == library.decode(ids, skip_special_tokens=False)


def test_random_texts(both):
    rnd = random.Random(7)
    marks = "aab bc  \n\t'sthe<|endoftext|>é日本\U0001f600՘ 12³\xa0\x1c"
    parts = "the a an ing tion aaaaaaaa 're import  == \n\n     return <|endoftext|>".split(" ")
    for _ in range(1500):
        same(both, "".join(rnd.choice(marks) for _ in range(rnd.randrange(60))))
        same(both, rnd.choice(["", " "]).join(rnd.choice(parts) for _ in range(rnd.randrange(25))))
        same(both, "".join(chr(rnd.choice([rnd.randrange(0xD800), rnd.randrange(0xE000, 0x110000)])) for _ in range(8)))
        same(both, "".join(rnd.choice("ethionsar") for _ in range(150)))


def test_every_code_point(both):
    """Each character there is, next to an apostrophe, a digit, a blank and a letter: pieces are those of the library."""
    codec, library = both
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(every), 512):
        text = "\n".join(f"{c}'s 1{c}a {c}" for c in every[i : i + 512])
        pieces = [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]
        assert codec.split(text) == pieces, hex(ord(every[i]))


@pytest.mark.parametrize("text", ["", " ", "a" * 40_000, " " * 20_000, "ab" * 20_000, "<|endoftext|>", "x<|endoftext|> <|endoftext|>y "])
def test_long_and_special_texts(both, text):
    same(both, text)


def test_invalid_bytes_and_unknown_ids_decode(both):
    codec, library = both
    ids = [codec.id_of["\xe6"], codec.id_of["a"], 50256]
    assert codec.decode(np.array([*ids, 60000], dtype="<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


def test_edges(edges, nothing, both):
    tokens = bpe.encode(edges, PATH)
    rows = bpe.decode(tokens, PATH).collect()
    assert len(rows) == 12
    for r in rows:
        assert r.decoded == (r.text or "")
        assert r.n_tokens == len(r.ids) // 4 == len(both[1].encode(r.text or "", add_special_tokens=False).ids)
        assert r.hits == "own"
    assert bpe.encode(nothing, PATH).collect() == []
