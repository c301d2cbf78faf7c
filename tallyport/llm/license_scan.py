"""Licence scan: rare words of licence templates, their positions, and mandatory key phrases.

A template is a sequence of words with a label. `rarity` counts in how many documents each
template word stands, over all documents. `Index` keeps, for every template, its highest-IDF
words with their positions: so many that a text holding `share` of the template must hold one
of them (n - need + 1 positions of n). A file is read once into the ids of its template words;
its rare words are looked up, each posting gives a relative position (place in the file less
place in the template), and only around these the words are compared: a template stands where
`need` of its positions are matched within `slack` words of one relative position, and its key
phrases stand there word for word. Because of that bound the result does not depend on which
words are rare; rarity only decides what is looked up.

The short phrases of the base labels are templates like others, with share 1 and slack 0.

Words: A to Z are lower-cased, then runs of anything but ASCII characters that are no letter
or digit. Texts are cut at word ends while they are read, so a long text costs two bytes a word.

Defined results: a NULL or empty text has no words, no places and score 0; repeated rows are
scanned one by one; relative positions of a template that lie no further than its slack from the
next one are one place, the one with most matches, the first of equals; a row without doc_id is scanned
like others; an empty table gives no rows; other columns are not read, so their names cannot
clash.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.llm.common import map_arrow

# Bytes of a text that are split into words at once.
PIECE = 1 << 20
# Relative positions that are compared at once.
AT_ONCE = 2048
# Bytes that are no part of a word become spaces; A to Z become a to z.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


@dataclass(frozen=True)
class Template:
    """`words` of a licence passage; `phrases` are word sequences that must stand in it."""

    label: str
    words: tuple[str, ...]
    phrases: tuple[tuple[str, ...], ...] = ()
    share: float = 0.7
    slack: int = 6
    base: bool = False

    @property
    def need(self) -> int:
        return max(1, math.ceil(self.share * len(self.words)))


def words_of(text: str) -> list[str]:
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).decode("utf-8", "surrogatepass").split(" ")


def template(label: str, text: str, *phrases: str, **options) -> Template:
    plain = lambda t: tuple(filter(None, words_of(t)))
    return Template(label, plain(text), tuple(map(plain, phrases)), **options)


# Phrases of the base labels.
BASE = (
    template("mit", "mit license", share=1, slack=0, base=True),
    template("apache", "apache license", share=1, slack=0, base=True),
    template("gpl", "general public license", share=1, slack=0, base=True),
)
# Passages by which licences are known, as their texts have them, and what
# must stand in them.
PASSAGES = (
    template(
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
        "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "free of charge", "without restriction",
    ),
    template(
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0", "apache license version 2", share=0.8, slack=3,
    ),
    template(
        "apache-2.0-notice",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "in compliance with the license",
    ),
    template(
        "bsd-text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
        "source and binary forms",
    ),
    template(
        "bsd-3-clause-text",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission",
        "endorse or promote",
    ),
    template(
        "isc-text",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
        "with or without fee",
    ),
    template(
        "gpl-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation",
        "free software", "gnu general public license",
    ),
    template(
        "lgpl-notice",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
        "the Free Software Foundation",
        "gnu lesser general public license",
    ),
    template("gpl-3.0", "GNU General Public License, version 3", "general public license version 3", share=0.8, slack=3),
    template("gpl-2.0", "GNU General Public License, version 2", "general public license version 2", share=0.8, slack=3),
    template(
        "mpl-2.0-notice",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mozilla public license",
    ),
    template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", "cc by nc 4 0", share=0.8, slack=3),
    template("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", "cc by sa 4 0", share=0.8, slack=3),
    template("cc-by-4.0", "Licensed under CC BY 4.0", "cc by 4 0", share=0.8, slack=3),
    template(
        "unlicense-text",
        "This is free and unencumbered software released into the public domain", "released into the public domain",
    ),
    template("spdx", "SPDX-License-Identifier", "spdx license identifier", share=1, slack=0),
)
TEMPLATES = (*BASE, *PASSAGES)


class Index:
    """Postings (template, position) of each template's rarest words, by word id."""

    def __init__(self, templates: tuple[Template, ...], files_with: dict[str, int] | None = None, files: int = 0):
        files_with = files_with or {}
        self.templates = templates
        words = sorted({w for t in templates for w in (*t.words, *(p for phrase in t.phrases for p in phrase))})
        self.ids = {w.encode("utf-8", "surrogatepass"): i + 1 for i, w in enumerate(words)}
        self.idf = {w: math.log((1 + files) / (1 + files_with.get(w, 0))) for w in words}
        own = lambda w: self.ids[w.encode("utf-8", "surrogatepass")]
        self.sequences = [np.array([own(w) for w in t.words], np.int16) for t in templates]
        self.phrases = [[np.array([own(w) for w in p], np.int16) for p in t.phrases] for t in templates]
        # A template's positions from the rarest word on; equal words keep their order in the text.
        postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for t, one in enumerate(templates):
            by_rarity = sorted(range(len(one.words)), key=lambda i: (-self.idf[one.words[i]], one.words[i], i))
            for i in by_rarity[: len(one.words) - one.need + 1]:
                postings[own(one.words[i])].append((t, i))
        self.rare = np.zeros(len(words) + 1, bool)
        self.rare[list(postings)] = True
        self.postings = dict(postings)

    def read(self, text: str) -> np.ndarray:
        """The file as ids of template words, 0 for any other word."""
        raw = text.encode("utf-8", "surrogatepass").translate(WORD_BYTES)
        get, parts, at = self.ids.get, [], 0
        while at < len(raw):
            end = raw.find(b" ", at + PIECE)
            end = len(raw) if end < 0 else end
            parts.append(np.array([get(w, 0) for w in raw[at:end].split()], np.int16))
            at = end
        return np.concatenate(parts) if parts else np.zeros(0, np.int16)

    def offsets(self, file: np.ndarray) -> dict[int, np.ndarray]:
        """For each template the distinct relative positions at which a rare word of it stands."""
        found = defaultdict(list)
        places = np.flatnonzero(self.rare[file])
        kinds = file[places]
        for word in np.unique(kinds).tolist():
            at = places[kinds == word]
            for t, i in self.postings[word]:
                found[t].append(at - i)
        return {t: np.unique(np.concatenate(parts)) for t, parts in found.items()}

    def places(self, file: np.ndarray) -> list[tuple[int, int, int]]:
        """(template, start, matched positions) of all places in a file."""
        out = []
        for t, offsets in sorted(self.offsets(file).items()):
            out += self._of_template(t, file, offsets)
        return out

    def _of_template(self, t: int, file: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
        one, words = self.templates[t], self.sequences[t]
        n, slack = len(words), one.slack
        # Every relative position within the slack of a posting may be the best one.
        starts = np.unique((offsets[:, None] + np.arange(-slack, slack + 1)).ravel())
        padded = np.concatenate([np.zeros(n + 2 * slack, np.int16), file, np.zeros(n + 2 * slack, np.int16)])
        shift = n + 2 * slack
        reach = np.arange(n)[:, None] + np.arange(-slack, slack + 1)
        found: list[tuple[int, int]] = []
        for at in range(0, len(starts), AT_ONCE):
            some = starts[at : at + AT_ONCE]
            same = padded[some[:, None, None] + shift + reach] == words[None, :, None]
            matched = same.any(axis=2).sum(axis=1)
            good = matched >= one.need
            found += zip(some[good].tolist(), matched[good].tolist())
        found = [(s, m) for s, m in found if self._phrases_stand(t, file, s)]
        # The best of neighbouring relative positions is the place.
        out: list[tuple[int, int, int]] = []
        group: list[tuple[int, int]] = []
        for place in [*found, None]:
            if group and (place is None or place[0] - group[-1][0] > slack):
                start, most = max(group, key=lambda p: (p[1], -p[0]))
                out.append((t, max(0, start), most))
                group = []
            if place:
                group.append(place)
        return out

    def _phrases_stand(self, t: int, file: np.ndarray, start: int) -> bool:
        slack = self.templates[t].slack
        part = file[max(0, start - slack) : start + len(self.sequences[t]) + slack].tobytes()
        return all(any(m.start() % 2 == 0 for m in re.finditer(b"(?=" + re.escape(p.tobytes()) + b")", part)) for p in self.phrases[t])


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def rarity(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, text_col: str = "text") -> tuple[dict[str, int], int]:
    """In how many documents each template word stands, and how many documents there are.

    Tasks count for themselves, so what is shuffled and gathered is a row for each template word.
    """
    index = Index(templates)
    names = ["", *(w.decode("utf-8", "surrogatepass") for w in index.ids)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        files = 0
        for batch in batches:
            for text in batch.column(0):
                found.update(np.unique(index.read(text.as_py() or "")).tolist())
                files += 1
        found[0] = files
        yield pa.RecordBatch.from_arrays(
            [pa.array([names[i] for i in found], pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "files"]
        )

    counted = map_arrow(docs.select(F.col(text_col).alias("text")), work, "word string, files long")
    counts = {r["word"]: r["n"] for r in counted.groupBy("word").agg(F.sum("files").alias("n")).collect()}
    return counts, counts.get("", 0)


def scan(
    docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """For every document its words and `places`: label, base, first word, matched words and words of the template."""
    index = Index(templates, *rarity(docs, templates, text_col))
    place = pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("matched", pa.int32()), ("words", pa.int32())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, found = [], []
            for text in batch.column(1):
                file = index.read(text.as_py() or "")
                words.append(len(file))
                found.append([
                    {"label": one.label, "base": one.base, "start": start, "matched": matched, "words": len(one.words)}
                    for one, start, matched in ((templates[t], s, m) for t, s, m in index.places(file))
                ])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(found, pa.list_(place))], names=["doc_id", "n_words", "places"]
            )

    return map_arrow(
        _slim(docs, id_col, text_col), work,
        "doc_id long, n_words long, places array<struct<label:string,base:boolean,start:long,matched:int,words:int>>",
    )


def digest(docs: DataFrame) -> DataFrame:
    """The query's columns: places of the base phrases, labels, and the best share of a template that was matched."""
    rows = scan(docs).withColumn("b", F.filter("places", lambda p: p["base"]))
    starts, labels = F.transform("b", lambda p: p["start"]), lambda c: F.array_join(F.sort_array(F.array_distinct(F.transform(c, lambda p: p["label"]))), ",")
    return rows.select(
        "doc_id", "n_words", F.size("b").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels("b").alias("base_labels"), labels("places").alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["matched"].cast("double") / p["words"])), F.lit(0.0)).alias("score"),
        F.size("places").cast("long").alias("n_places"),
    )
