"""License texts and phrases in documents, by votes on offset diagonals.

Words are runs of ASCII letters and digits (A-Z lower-cased) and of all other
non-ASCII characters. Templates are four fixed phrases, and notices and texts
of common licenses. Steps:

1. Every text is cut into words; the hash of each rolling word k-gram (k = 2
   for phrases, k = 4 for longer templates) is one row of a Spark join with the
   templates' own k-grams. The templates are constants of this module, so the
   broadcast side has a few thousand rows whatever the input.
2. A match of document word p with template word t votes for diagonal p - t.
   Votes are counted per (document, template, diagonal), mostly inside the scan's
   task, before the shuffle.
3. Neighbouring diagonals of one template (words added or left out) merge.
4. Only documents with votes are read again. Their merged spans are verified
   word by word: a phrase must stand whole; of a longer template the share of
   its words found in place is the span's coverage.

A document travels as (doc_id, text digest); a pseudo-template that matches a
marker on every document's first row carries documents without any match along.

Defined cases: a null, empty or wordless text has no words and no span. Rows
repeated as a whole are worked once and returned as often as they come; other
repeats of a ``doc_id``, and null ids, are told apart by the text. Columns other than
``doc_id`` and ``text`` are left behind. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crownlake.llm.common import possibly_in, prepare, stored, texts, utf8_bytes

# Phrases of the query's contract.
PHRASES = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]

# Openings, notices and bodies of public licenses.
LICENSES = [
    ("apache", "Licensed under the Apache License, Version 2.0"),
    (
        "apache",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed "
        'under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
        "is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    ("gpl", "licensed under the GNU General Public License, version 2"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    (
        "agpl",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free "
        "Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
        "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means.",
    ),
    ("apache", "SPDX-License-Identifier: Apache-2.0"),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("gpl", "SPDX-License-Identifier: GPL-3.0"),
    ("bsd", "SPDX-License-Identifier: BSD-3-Clause"),
]

PHRASE_GRAM, LICENSE_GRAM = 2, 4
GRAMS = (PHRASE_GRAM, LICENSE_GRAM)
COVERAGE = 0.75  # a span with this share of its template's words, in place, gets the template's label
GAP = 8  # diagonals this near merge (less for short templates), and so do stretches this near
BLOCK = 4096  # words of one row on the way to the join
SLICE_BYTES = 1 << 21  # texts hashed at once
DOCUMENT = -1  # the pseudo-template
MARK = -(1 << 62)

SPANS = "spans array<struct<label: string, phrase: boolean, start: bigint, end: bigint, coverage: double>>"
SPAN_TYPE = pa.list_(
    pa.struct([("label", pa.string()), ("phrase", pa.bool_()), ("start", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())])
)
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

_bytes = np.arange(256, dtype=np.uint8)
_capital = (_bytes >= 65) & (_bytes <= 90)
LOWER = np.where(_capital, _bytes + 32, _bytes).astype(np.uint8)
IS_WORD = ((_bytes >= 48) & (_bytes <= 57)) | ((_bytes >= 97) & (_bytes <= 122)) | _capital | (_bytes >= 128)
_draw = np.random.default_rng(12).integers(1 << 62, size=2 + max(GRAMS)).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def words_of(text: str) -> list[bytes]:
    """The words of one text, in UTF-8."""
    return WORD.findall(text.encode().translate(LOWER.tobytes()))


def templates() -> list[tuple[str, int, list[bytes]]]:
    """(label, k, words) of every template; the phrases come first."""
    return [(label, PHRASE_GRAM, words_of(t)) for label, t in PHRASES] + [(label, LICENSE_GRAM, words_of(t)) for label, t in LICENSES]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _draw[0]
    return x ^ (x >> np.uint64(29))


def gram_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words per text, and for each word the hashes of the k-grams from it, one column for each k of ``GRAMS``.

    Grams that cross the end of a text are hashed with what follows; they can only give candidates that verification drops.
    """
    inside = IS_WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    first[heads] = inside[heads]
    starts = np.flatnonzero(first)
    n_words = np.searchsorted(starts, offsets[1:]) - np.searchsorted(starts, offsets[:-1])
    if not len(starts):
        return n_words, np.zeros((0, len(GRAMS)), np.int64)
    place = np.flatnonzero(inside)
    word = np.cumsum(first[place]) - 1
    depth = place - starts[word]
    powers = np.ones(int(depth.max()) + 2, np.uint64)
    powers[1:] = np.cumprod(np.full(len(powers) - 1, _draw[1], np.uint64))
    border = np.flatnonzero(first[place])
    values = (LOWER[data[place]].astype(np.uint64) + np.uint64(1)) * powers[depth]
    code = _mixed(np.add.reduceat(values, border))
    padded = np.concatenate([code, np.zeros(max(GRAMS), np.uint64)])
    out = np.empty((len(code), len(GRAMS)), np.int64)
    for column, k in enumerate(GRAMS):
        total = np.full(len(code), k, np.uint64)
        for t in range(k):
            total += padded[t : t + len(code)] * _draw[2 + t]
        out[:, column] = _mixed(total).view(np.int64)
    return n_words, out


def template_grams(spark: SparkSession) -> DataFrame:
    """``gram, template, at`` of every k-gram of every template, and the document marker."""
    rows = [(MARK, DOCUMENT, 0)]
    for number, (_, k, words) in enumerate(templates()):
        data = np.frombuffer(b" ".join(words), np.uint8)
        _, grams = gram_hashes(data, np.array([0, len(data)]))
        rows += [(int(grams[at, GRAMS.index(k)]), number, at) for at in range(len(words) - k + 1)]
    return spark.createDataFrame(rows, "gram bigint, template int, at bigint")


def _slices(texts_: pa.Array) -> Iterator[pa.Array]:
    """Consecutive parts of a string array, each within ``SLICE_BYTES`` unless one text is longer."""
    ends = np.cumsum(np.diff(utf8_bytes(texts_)[1]))
    at = 0
    while at < len(texts_):
        done = int(ends[at - 1]) if at else 0
        to = max(int(np.searchsorted(ends, done + SLICE_BYTES, side="right")), at + 1)
        yield at, texts_.slice(at, to - at)
        at = to


def _rolling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of at most ``BLOCK`` words: their grams, k by k for each word; a text's first row ends with the marker."""
    for batch in batches:
        for at, part in _slices(batch.column("text")):
            n_words, grams = gram_hashes(*utf8_bytes(part))
            blocks = np.maximum(-(-n_words // BLOCK), 1)
            row = np.repeat(np.arange(len(part)), blocks)
            number = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            size = np.minimum(n_words[row] - number * BLOCK, BLOCK)
            lengths = size * len(GRAMS) + (number == 0)
            borders = np.cumsum(size * len(GRAMS))
            values = np.insert(grams.reshape(-1), borders[number == 0], MARK)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(values))
            take = pa.array(at + row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), batch.column("digest").take(take), pa.array(n_words[row]), pa.array(number * BLOCK), lists],
                names=["doc_id", "digest", "n_words", "base", "grams"],
            )


def keyed(docs: DataFrame) -> DataFrame:
    return texts(docs).withColumn("digest", F.substring(F.unhex(F.sha2("text", 256)), 1, 16))


def diagonals(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, copies, n_words, votes`` of each different row; ``votes`` lists its diagonals, merged per template."""
    spark = docs.sparkSession
    pieces = keyed(docs).mapInArrow(_rolling, "doc_id bigint, digest binary, n_words bigint, base bigint, grams array<bigint>")
    rolling = pieces.select("doc_id", "digest", "n_words", "base", F.posexplode("grams").alias("place", "gram"))
    hits = rolling.join(F.broadcast(template_grams(spark)), "gram")
    position = F.col("base") + F.floor(F.col("place") / len(GRAMS))
    diagonal = F.when(F.col("template") == DOCUMENT, F.lit(0)).otherwise(position - F.col("at"))
    counted = (
        hits.select("doc_id", "digest", "n_words", "template", diagonal.alias("diagonal"), position.alias("position"))
        .groupBy("doc_id", "digest", "template", "diagonal")
        .agg(F.min("position").alias("first"), F.max("position").alias("last"), F.count(F.lit(1)).alias("n"), F.max("n_words").alias("n_words"))
    )
    is_document = F.col("template") == DOCUMENT
    vote = F.struct("template", "diagonal", "first", "last")
    # A phrase stands whole only on a diagonal with all its grams; a repeated row counts once for each copy.
    least = F.create_map(*[F.lit(x) for i, (_, k, w) in enumerate(templates()) if k == PHRASE_GRAM for x in (i, len(w) - k)])
    whole = F.col("last") - F.col("first") >= F.coalesce(F.try_element_at(least, "template"), F.lit(0))
    return counted.groupBy("doc_id", "digest").agg(
        F.max(F.when(is_document, F.col("n"))).alias("copies"),
        F.max("n_words").alias("n_words"),
        F.sort_array(F.collect_list(F.when(~is_document & whole, vote))).alias("votes"),
    )


def merged(votes: list[tuple[int, int, int]], k: int, size: int) -> list[list[tuple[int, int, int]]]:
    """(diagonal, first, last) of one template, joined where diagonals and stretches are near."""
    gap = min(GAP, size // 2)
    open_: list[list[tuple[int, int, int]]] = []
    for vote in sorted(votes, key=lambda v: (v[1], v[0])):
        near = [c for c in open_[-size:] if abs(c[-1][0] - vote[0]) <= gap and vote[1] <= max(x[2] for x in c[-gap:]) + k + gap]
        if near:
            near[-1].append(vote)
        else:
            open_.append([vote])
    return open_


def verify(words: list[bytes], votes: list[tuple[int, int, int, int]], known: list[tuple[str, int, list[bytes]]]) -> list[tuple]:
    """(label, phrase, start, end, coverage) of the spans whose words were compared with their template."""
    spans = []
    for number, group in groupby(sorted(votes), key=lambda v: v[0]):
        label, k, template = known[number]
        if k == PHRASE_GRAM:
            for _, diagonal, _, _ in group:
                if words[diagonal : diagonal + len(template)] == template:
                    spans.append((label, True, diagonal, diagonal + len(template), 1.0))
            continue
        for cluster in merged([v[1:] for v in group], k, len(template)):
            covered, places = set(), []
            for diagonal, first, last in cluster:
                low = max(first - k, diagonal, 0)
                for p in range(low, min(last + 2 * k, diagonal + len(template), len(words))):
                    if words[p] == template[p - diagonal]:
                        covered.add(p - diagonal)
                        places.append(p)
            if places:
                spans.append((label, False, min(places), max(places) + 1, len(covered) / len(template)))
    return sorted(spans, key=lambda s: (s[2], s[3], s[0]))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = templates()
    names = ("label", "phrase", "start", "end", "coverage")
    for batch in batches:
        found = []
        for text, votes in zip(batch.column("text").to_pylist(), batch.column("votes").to_pylist()):
            spans = verify(words_of(text), [(v["template"], v["diagonal"], v["first"], v["last"]) for v in votes], known)
            found.append([dict(zip(names, s)) for s in spans])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("copies"), batch.column("n_words"), pa.array(found, SPAN_TYPE)],
            names=["doc_id", "copies", "n_words", "spans"],
        )


def find_licenses(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, spans`` of every row; a span has its label, whether it is a phrase, its words and its coverage."""
    prepare(docs.sparkSession)
    voted = stored(diagonals(docs), "license-votes")
    candidates = voted.where(F.size("votes") > 0)
    read_again = possibly_in(keyed(docs), candidates, "doc_id").groupBy("doc_id", "digest").agg(F.max("text").alias("text"))
    same = candidates["doc_id"].eqNullSafe(read_again["doc_id"]) & (candidates["digest"] == read_again["digest"])
    joined = candidates.join(read_again, same).select(candidates["doc_id"], "copies", "n_words", "votes", "text")
    verified = joined.mapInArrow(_verify, f"doc_id bigint, copies bigint, n_words bigint, {SPANS}")
    rest = voted.where(F.size("votes") == 0).select(
        "doc_id", "copies", "n_words", F.from_json(F.lit("[]"), SPANS.removeprefix("spans ")).alias("spans")
    )
    # Repeated rows come back as often as they came.
    each = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return verified.unionByName(rest).withColumn("copy", each).drop("copies", "copy")


def license_report(found: DataFrame) -> DataFrame:
    """Places of the base phrases, labels of phrases and of covered templates, and the best coverage."""

    def labels(spans: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    base = F.filter("spans", lambda s: s["phrase"])
    starts = F.transform(base, lambda s: s["start"])
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.filter("spans", lambda s: s["coverage"] >= COVERAGE)).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["coverage"])), F.lit(0.0)).alias("score"),
    )
