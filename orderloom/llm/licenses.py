"""Licence scans: known licence sentences become identifiers, and rules match sequences of identifiers.

A sentence is normalised to its lower-case words and numbers; a fixed table gives the identifier of each known one. Rules
are ordered sequences of identifiers; at each place the first rule that fits consumes its sentences.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orderloom.llm.shipping import pieces, ready

#: Normalised sentences of public licences and notices, and their identifiers.
SENTENCES = {
    "licensed under the apache license version 2 0": "apache-2-notice",
    "licensed under the apache license version 2 0 the license": "apache-2-notice",
    "you may not use this file except in compliance with the license": "apache-comply",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache-copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache-as-is",
    "see the license for the specific language governing permissions and limitations under the license": "apache-see",
    "released under the mit license": "mit-notice",
    "licensed under the mit license": "mit-notice",
    "this software is released under the mit license": "mit-notice",
    "the mit license mit": "mit-title",
    "mit license": "mit-title",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-keep",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-as-is",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "mit-liable",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "this work is licensed under the gnu general public license version 3": "gpl-3-notice",
    "licensed under the gnu general public license version 3": "gpl-3-notice",
    "licensed under the gnu general public license version 2": "gpl-2-notice",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl-3-later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl-2-later",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-hope",
    "see the gnu general public license for more details": "gpl-see",
    "you should have received a copy of the gnu general public license along with this program": "gpl-copy",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2-notice",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "mpl-copy",
    "licensed under cc by nc 4 0": "cc-by-nc-4",
    "licensed under cc by 4 0": "cc-by-4",
    "licensed under cc by sa 4 0": "cc-by-sa-4",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa-4",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc-4",
    "all rights reserved": "reserved",
}

#: Licences by ordered sequences of identifiers, the more specific first.
RULES = (
    ("Apache-2.0", ("apache-2-notice", "apache-comply", "apache-copy", "apache-as-is", "apache-see")),
    ("Apache-2.0", ("apache-2-notice",)),
    ("MIT", ("mit-title", "mit-grant", "mit-keep", "mit-as-is", "mit-liable")),
    ("MIT", ("mit-grant", "mit-keep", "mit-as-is", "mit-liable")),
    ("MIT", ("mit-grant", "mit-keep")),
    ("MIT", ("mit-notice",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("ISC", ("isc-grant",)),
    ("GPL-3.0-or-later", ("gpl-3-later", "gpl-hope", "gpl-see", "gpl-copy")),
    ("GPL-3.0-or-later", ("gpl-3-later",)),
    ("GPL-2.0-or-later", ("gpl-2-later", "gpl-hope", "gpl-see", "gpl-copy")),
    ("GPL-2.0-or-later", ("gpl-2-later",)),
    ("GPL-3.0-only", ("gpl-3-notice",)),
    ("GPL-2.0-only", ("gpl-2-notice",)),
    ("MPL-2.0", ("mpl-2-notice", "mpl-copy")),
    ("MPL-2.0", ("mpl-2-notice",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("all-rights-reserved", ("reserved",)),
)

#: Patterns that mean the same in SQL's regular expressions. A line that ends inside a sentence goes on in the next one if
#: that begins with a small letter, or if both are in capitals.
WRAPS = (r"([^.!?;\n])\n[ \t*#/]*([a-z])", r"([A-Z,])\n[ \t*#/]*([A-Z])")
ENDS = r"[.!?;]+[ \t\r]+|[.!?;]*\n|[.!?;]+$|:[ \t\r]*\n"
_WRAPS = tuple(re.compile(p) for p in WRAPS)
_ENDS = re.compile(ENDS)
_OTHER = re.compile(r"[^a-z0-9]+")
_CAPITALS = {c: c + 32 for c in range(65, 91)}


def sentences(text: str) -> Iterator[str]:
    """The normalised sentences of a text, empty ones left out."""
    for wrap in _WRAPS:
        text = wrap.sub(r"\1 \2", text)
    for part in _ENDS.split(text.translate(_CAPITALS)):
        if words := _OTHER.sub(" ", part).strip(" "):
            yield words


def matcher(rules: tuple[tuple[str, tuple[str, ...]], ...] = RULES) -> tuple[re.Pattern, dict[str, str]]:
    """A pattern over identifiers that are each followed by a blank, and the licence of each matched sequence."""
    named = {"".join(f"{i} " for i in ids): name for name, ids in reversed(rules)}
    return re.compile("|".join("".join(f"{re.escape(i)} " for i in ids) for _, ids in rules)), named


def scan(
    docs: DataFrame,
    known: dict[str, str] | None = None,
    rules: tuple[tuple[str, tuple[str, ...]], ...] = RULES,
    text: str = "text",
) -> DataFrame:
    """``docs`` with ``sentence_ids`` (identifiers of the known sentences, in order, repeats included) and
    ``licenses`` (of the rules matched, in order, repeats included).

    The sentence table is a fixed one, sent to every task with the code. Null and empty texts have no sentences; texts of any length are
    read as a whole; rows are independent. Result columns replace input columns of the same name.
    """
    ready(docs)
    known = SENTENCES if known is None else known
    pattern, named = matcher(rules)
    made = [T.StructField(c, T.ArrayType(T.StringType())) for c in ("sentence_ids", "licenses")]
    own = [f for f in docs.schema.fields if f.name not in {m.name for m in made}]
    schema = T.StructType([*own, *made])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text=text):
            ids, found = [], []
            for t in batch.column(text).to_pylist():
                ids.append([known[s] for s in sentences(t) if s in known] if t else [])
                found.append([named[m] for m in pattern.findall("".join(f"{i} " for i in ids[-1]))])
            arrays = [pa.array(v, arrow.field(m.name).type) for v, m in zip((ids, found), made, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in own), *arrays], schema=arrow)

    return docs.select(*(F.col(f"`{f.name}`") for f in own)).mapInArrow(run, schema)
