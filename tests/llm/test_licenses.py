import pytest

from orderloom.llm import licenses as lic

MIT = """Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""


def found(spark, text):
    (r,) = lic.scan(spark.createDataFrame([(text,)], "text string")).collect()
    return r.sentence_ids, r.licenses


@pytest.mark.parametrize(
    "text, names",
    [
        (MIT, ["MIT"]),
        ("x y.\nLicensed under the Apache License, Version 2.0.\nmore", ["Apache-2.0"]),
        ("All rights reserved.\n\nReleased under the MIT License", ["all-rights-reserved", "MIT"]),
        ("Licensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"] * 2),
        ("we are not licensed under the MIT License at all.", []),
        ("", []),
        (None, []),
    ],
)
def test_texts(spark, text, names):
    assert found(spark, text)[1] == names


def test_longer_rules_come_first_and_order_counts(spark):
    known = {"one": "a", "two": "b", "three": "c"}
    rules = (("ABC", ("a", "b", "c")), ("AB", ("a", "b")), ("C", ("c",)))
    df = spark.createDataFrame([("one. two. three. one. two. one. three. two. c",)], "text string")
    (r,) = lic.scan(df, known, rules).collect()
    assert r.licenses == ["ABC", "AB", "C"] and r.sentence_ids == list("abcabacb")


def test_edges(edges, nothing):
    rows = lic.scan(edges).collect()
    assert len(rows) == 12 and all(r.licenses == [] and r.hits == "own" for r in rows)
    assert lic.scan(nothing).collect() == []
