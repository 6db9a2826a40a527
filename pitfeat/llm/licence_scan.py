"""License scans: a positional index of the rare words of licence notices, intersected by relative position, with phrases that must be there.

One pass over all documents counts how many hold each licence word; that is the words' inverse document frequency, over the whole corpus and the same at every size.
Of each notice the ``RARE`` rarest words are posted with their positions; phrases post all their words. A file looks up its ``LOOKED_UP`` highest-IDF words of each
notice. A posting at position q and an occurrence at word p say that the notice starts at p - q; starts on which two different words agree within ``SLACK``
words are candidates. A candidate is laid over the file: its coverage is the share of the notice's words found at their place, ``SLACK`` words either way. The label is
given where the coverage reaches ``LEAST`` and every mandatory phrase of the notice stands in the span. A phrase is its own mandatory phrase: all its words' postings
must agree on the start exactly, so every place of it is found, however often it occurs.

What travels: a few counts per task, and an index as large as the notices. Each file is judged alone, whole, in time linear in its words.

Edge cases. Null text is empty. No licence word: no labels (empty texts), score 0, null first and last word. Equal rows get equal results, null ids too. No rows in, no
rows out. Extra columns are kept under ``input``.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from pitfeat.llm.common import documents, query, small

RARE, LOOKED_UP, SLACK, LEAST = 12, 4, 6, 0.75

# Letters and digits of ASCII and all other bytes of UTF-8 are word characters; A-Z become a-z.
_FORM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

# The phrases of the contract with their labels.
BASE = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]

# Other short names of licences.
NAMES = [
    ("agpl", "gnu affero general public license"),
    ("apache-2.0", "apache license version 2 0"),
    ("bsd", "bsd license"),
    ("cc-by-nc", "cc by nc"),
    ("cc-by-nd", "cc by nd"),
    ("cc-by-sa", "cc by sa"),
    ("cc0", "cc0 1 0 universal"),
    ("gpl-2.0", "gnu general public license version 2"),
    ("gpl-3.0", "gnu general public license version 3"),
    ("isc", "isc license"),
    ("lgpl", "gnu lesser general public license"),
    ("mpl", "mozilla public license"),
    ("spdx", "spdx license identifier"),
]

# Public licence notices, each with the phrases that make it one.
NOTICES = [
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"),
     to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
     copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
     this permission notice shall be included in all copies or substantial portions of the Software.""",
     ["permission is hereby granted free of charge", "without restriction"]),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above
     copyright notice and this permission notice appear in all copies.""",
     ["with or without fee is hereby granted"]),
    ("bsd-2-clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
     1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary
     form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with
     the distribution.""",
     ["redistribution and use in source and binary forms", "redistributions in binary form must reproduce"]),
    ("bsd-3-clause", """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software
     without specific prior written permission.""",
     ["may be used to endorse or promote products"]),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a
     copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the
     License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
     governing permissions and limitations under the License.""",
     ["except in compliance with the license", "apache"]),
    ("gpl", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free
     Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful,
     but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
     details.""",
     ["under the terms of the gnu general public license"]),
    ("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the
     Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.""",
     ["gnu lesser general public license"]),
    ("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can
     obtain one at https://mozilla.org/MPL/2.0/.""",
     ["subject to the terms of the mozilla public license"]),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute
     this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
     ["free and unencumbered software"]),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the
     use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute
     it freely.""",
     ["redistribute it freely", "without any express or implied warranty"]),
    ("boost", """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by
     this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software""",
     ["person or organization obtaining a copy", "derivative works"]),
    ("cc-by", """This work is licensed under the Creative Commons Attribution 4.0 International License. To view a copy of this license, visit
     http://creativecommons.org/licenses/by/4.0/""",
     ["creative commons attribution 4 0"]),
]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FORM).split()


@dataclass(frozen=True)
class Template:
    """A notice, or a phrase (``exact``), as words."""

    label: str
    words: tuple[bytes, ...]
    keys: tuple[tuple[bytes, ...], ...]
    exact: bool


def templates(phrases: Sequence[tuple[str, str]] = tuple(BASE + NAMES), notices: Sequence[tuple[str, str, list[str]]] = tuple(NOTICES)) -> list[Template]:
    made = [Template(label, tuple(words_of(p)), (tuple(words_of(p)),), True) for label, p in phrases]
    return made + [Template(label, tuple(words_of(n)), tuple(tuple(words_of(k)) for k in keys), False) for label, n, keys in notices]


def document_counts(docs: DataFrame, vocabulary: set[bytes], text_col: str = "text") -> tuple[int, dict[bytes, int]]:
    """Number of documents, and of those that hold each word of the vocabulary (whose size bounds what the driver gets)."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, found = 0, defaultdict(int)
        for batch in small(batches):
            for text in batch.column(0).to_pylist():
                n += 1
                for w in vocabulary.intersection(words_of(text)):
                    found[w] += 1
        yield pa.RecordBatch.from_arrays([pa.array([b"", *found], pa.binary()), pa.array([n, *found.values()], pa.int64())], ["word", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(add, "word binary, n long").groupBy("word").agg(F.sum("n")).collect()
    counts = {bytes(w): n for w, n in rows}
    return counts.pop(b"", 0), counts


class Index:
    """Postings of rare words: word -> (template, position), and what verifies a candidate."""

    def __init__(self, items: Sequence[Template], n_docs: int, counts: dict[bytes, int]) -> None:
        self.items = list(items)
        self.idf = {w: math.log((1 + n_docs) / (1 + counts.get(w, 0))) for t in self.items for w in t.words}
        self.postings: list[dict[bytes, list[int]]] = []
        for t in self.items:
            some = set(t.words) if t.exact else set(sorted(set(t.words), key=self.rank)[:RARE])
            places = defaultdict(list)
            for q, w in enumerate(t.words):
                if w in some:
                    places[w].append(q)
            self.postings.append(dict(places))
        self.vocabulary = {w for t in self.items for w in t.words}

    def rank(self, word: bytes) -> tuple[float, bytes]:
        return -self.idf[word], word

    def looked_up(self, k: int, present: set[bytes]) -> list[bytes]:
        """The file's highest-IDF words of template ``k``: all of a phrase's, rarest first; none where too few are there."""
        posted = self.postings[k]
        found = sorted((w for w in posted if w in present), key=self.rank)
        if self.items[k].exact:
            return found if len(found) == len(posted) else []
        return found[:LOOKED_UP] if len(found) >= 2 else []

    def starts(self, k: int, looked: list[bytes], at: dict[bytes, np.ndarray]) -> np.ndarray:
        """Starts of template ``k`` on which the postings agree."""
        offsets = [(at[w][:, None] - np.array(self.postings[k][w])).ravel() for w in looked]
        if self.items[k].exact:  # each posted place of each word must agree
            left = None
            for w in looked:
                for q in self.postings[k][w]:
                    here = at[w] - q
                    left = here if left is None else left[np.isin(left, here, assume_unique=True)]
            return left
        every, who = np.concatenate(offsets), np.repeat(np.arange(len(looked)), [len(o) for o in offsets])
        order = np.argsort(every, kind="stable")
        every, who = every[order], who[order]
        # the nearest earlier start of each other word, within the slack
        agreed = np.zeros(len(every), bool)
        for j in range(len(looked)):
            mine = np.flatnonzero(who == j)
            last = np.searchsorted(mine, np.arange(len(every)), "right") - 1
            near = (last >= 0) & (who != j)
            near[near] = every[near] - every[mine[last[near]]] <= SLACK
            agreed |= near
            agreed[mine[last[near]]] = True
        return np.unique(every[agreed])

    def coverage(self, k: int, start: int, at: dict[bytes, np.ndarray]) -> float:
        """Share of the template's words that stand at their place, ``SLACK`` words either way."""
        words = self.items[k].words
        found = 0
        for q, w in enumerate(words):
            places = at.get(w)
            if places is not None:
                i = np.searchsorted(places, start + q - SLACK)
                found += i < len(places) and places[i] <= start + q + SLACK
        return found / len(words)

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], dict[str, tuple[int, int, float]], float]:
        """Places (template, start) of the phrases, the best verified span (start, end, coverage) of each label, and the highest coverage of any candidate."""
        present = self.vocabulary.intersection(words)
        looked = {k: some for k in range(len(self.items)) if (some := self.looked_up(k, present))}
        if not looked:
            return [], {}, 0.0
        lists = defaultdict(list)
        for i, w in enumerate(words):
            if w in present:
                lists[w].append(i)
        at = {w: np.array(x) for w, x in lists.items()}
        places, spans, best = [], {}, 0.0
        for k, some in looked.items():
            t, tried = self.items[k], -1
            for start in self.starts(k, some, at).tolist():
                if t.exact:
                    places.append((k, start))
                    share, whole, end = 1.0, True, start + len(t.words)
                else:
                    if start <= tried:  # neighbouring starts lie within the slack of one that was laid over the file
                        continue
                    tried = start + SLACK
                    share = self.coverage(k, start, at)
                    a, end = max(0, start - SLACK), min(len(words), start + len(t.words) + SLACK)
                    here = words[a:end]
                    keys = sum(any(tuple(here[j:j + len(key)]) == key for j in range(len(here) - len(key) + 1)) for key in t.keys) / len(t.keys)
                    whole, start = keys == 1 and share >= LEAST, a
                    share *= 1 if whole else keys / 2
                best = max(best, share)
                if whole and share > spans.get(t.label, (0, 0, 0.0))[2]:
                    spans[t.label] = start, end, share
        return places, spans, best


MADE = T.StructType([T.StructField(n, k) for n, k in [
    ("n_words", T.LongType()), ("n_base", T.LongType()), ("first_word", T.LongType()), ("last_word", T.LongType()), ("base_labels", T.StringType()),
    ("labels", T.StringType()), ("score", T.DoubleType())]])
SPANS = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                                  T.StructField("coverage", T.DoubleType())]))


def scan_licences(docs: DataFrame, text_col: str = "text", base: Sequence[tuple[str, str]] = tuple(BASE), names: Sequence[tuple[str, str]] = tuple(NAMES),
                  notices: Sequence[tuple[str, str, list[str]]] = tuple(NOTICES)) -> DataFrame:
    """``input`` (the row), n_words, n_base, first_word, last_word, base_labels, labels, score, and spans: the best span of words of each label."""
    items = templates([*base, *names], notices)
    index = Index(items, *document_counts(docs, {w for t in items for w in t.words}, text_col))
    rows = docs.select(F.struct("*").alias("input"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        span = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())]))
        for batch in small(batches):
            out = []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                places, spans, best = index.scan(words)
                first = [(index.items[k].label, s) for k, s in places if k < len(base)]
                starts = [s for _, s in first]
                base_labels = {b for b, _ in first}
                out.append((len(words), len(first), min(starts, default=None), max(starts, default=None), ",".join(sorted(base_labels)),
                            ",".join(sorted(base_labels | spans.keys())), round(best, 6),
                            [dict(label=b, start=s, end=e, coverage=c) for b, (s, e, c) in sorted(spans.items())]))
            columns = [pa.array(x, k) for x, k in zip(zip(*out) if out else [[]] * 8, [*kinds, span])]
            yield pa.RecordBatch.from_arrays([batch.column("input"), *columns], ["input", *MADE.names, "spans"])

    return rows.mapInArrow(run, T.StructType([rows.schema["input"], *MADE, T.StructField("spans", SPANS)]))


@query("op11_licence_scan")
def op11_licence_scan(spark, sf_dir):
    done = scan_licences(documents(spark, sf_dir).select("doc_id", "text"))
    return done.select(F.col("input.doc_id").alias("doc_id"), *MADE.names)
