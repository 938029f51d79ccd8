import random
import re

import numpy as np
import pytest

from orderloom.llm.words import ALNUM, KEEP_CASE, SPACED, Words, covered, word_table

SPACE_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_, LOWER = word_table(b"", lower=True)


@pytest.mark.parametrize("mask, pattern, translate", [(SPACED, SPACE_WORDS, KEEP_CASE), (ALNUM, ALNUM_WORDS, LOWER)])
def test_words_are_those_of_the_pattern(mask, pattern, translate):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("aB1 \n\t.-é日\x0b\x7f") for _ in range(rnd.randrange(60))).encode() for _ in range(300)]
    words = Words(texts, mask, translate)
    for k, text in enumerate(texts):
        a, b = words.first[k], words.first[k + 1]
        assert [words.data[s:e] for s, e in zip(words.start[a:b], words.end[a:b], strict=True)] == pattern.findall(text.translate(translate))


def test_equal_ranges_have_equal_hashes_wherever_they_stand():
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice("ab cd ef gh".split()) for _ in range(50)).encode() for _ in range(20)]
    words = Words(texts)
    at = words.runs_of(4)
    seen = {}
    for i, h in zip(at.tolist(), words.ranges(at, at + 4).tolist(), strict=True):
        assert seen.setdefault(words.bytes_of(i, i + 4), h) == h
    assert len(set(seen.values())) == len(seen)


def test_a_word_longer_than_a_block_is_one_word():
    text = b"a " + b"x" * 3_000_000 + b" b"
    words = Words([text, b"", text])
    assert np.diff(words.first).tolist() == [3, 0, 3]
    assert words.hash[1] == words.hash[4]


def test_no_texts_and_no_words():
    assert len(Words([])) == 0
    assert np.diff(Words([b"", b" "]).first).tolist() == [0, 0]


def test_covered():
    assert covered(6, np.array([1, 2]), np.array([3, 4])).tolist() == [False, True, True, True, False, False]
