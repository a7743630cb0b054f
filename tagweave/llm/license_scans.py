"""License scans by a positional index of rare words.

Templates are phrases and whole sentences of licence texts. Their words are weighted by inverse document
frequency over all texts scanned. Each file looks up its licence words, the one of highest weight first: the
index's postings (template, place in it) give the places where a template could begin, and the places that the
next words give are intersected with them, until LOOKED_UP words of a template agree. What is left is verified
word by word, and so are the key phrases that a template demands anywhere in the file.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import slices, string_buffer, whole_text


@dataclass(frozen=True)
class Template:
    """A phrase of words in a row that speaks for ``label``; ``keys``: phrases the text must hold besides."""

    words: str
    label: str
    base: bool = False
    keys: tuple[str, ...] = ()
    weight: float = 0.5


#: The base phrases with their labels, then further phrases of public licences.
TEMPLATES = [
    Template("gnu general public license", "gpl", True, weight=0.9),
    Template("apache license", "apache", True, weight=0.8),
    Template("cc by", "cc-by", True, weight=0.6),
    Template("mit license", "mit", True, weight=0.8),
    Template("gnu lesser general public license", "lgpl", weight=0.9),
    Template("gnu affero general public license", "agpl", weight=0.9),
    Template("mozilla public license", "mpl", weight=0.9),
    Template("cc by nc", "cc-by-nc", weight=0.7),
    Template("cc by sa", "cc-by-sa", weight=0.7),
    Template("cc by nd", "cc-by-nd", weight=0.7),
    Template("eclipse public license", "epl", weight=0.8),
    Template("boost software license", "bsl", weight=0.9),
    Template("creative commons attribution", "cc-by", weight=0.6),
    Template("all rights reserved", "proprietary", weight=0.4),
    Template(
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
        "mit", keys=("the software is provided as is without warranty of any kind", "permission notice shall be included in all copies"), weight=1.0,
    ),
    Template(
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        "isc", keys=("the software is provided as is", "this permission notice appear in all copies"), weight=1.0,
    ),
    Template(
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "bsd", keys=("redistributions of source code must retain", "this software is provided by"), weight=1.0,
    ),
    Template("redistribution and use in source and binary forms", "bsd-like", keys=("must retain the above copyright notice",), weight=0.8),
    Template("neither the name of", "bsd-3", keys=("redistributions of source code must retain", "used to endorse or promote products"), weight=0.9),
    Template(
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
        "gpl", keys=("without any warranty",), weight=1.0,
    ),
    Template(
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license",
        "lgpl", keys=("without any warranty",), weight=1.0,
    ),
    Template(
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        "apache", keys=("licensed under the apache license version 2 0", "without warranties or conditions of any kind"), weight=1.0,
    ),
    Template("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl", keys=("a copy of the mpl was not distributed",), weight=1.0),
    Template("this is free and unencumbered software released into the public domain", "unlicense", keys=("anyone is free to copy modify publish use compile sell or distribute this software",), weight=1.0),
    Template(
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely",
        "zlib", keys=("the origin of this software must not be misrepresented",), weight=1.0,
    ),
    Template("boost software license version 1 0", "bsl", keys=("permission is hereby granted free of charge to any person or organization",), weight=1.0),
    Template("has waived all copyright and related or neighboring rights", "cc0", keys=("cc0",), weight=1.0),
]
#: Words looked up for each template.
LOOKED_UP = 3
SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
#: Bytes that make up words: digits, letters, and all of any character beyond ASCII.
IN_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def words_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, starts of the words, ends of the words); words don't cross the texts' offsets ``at``."""
    low = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    inside = IN_WORD[low]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    firsts, lasts = at[:-1][at[:-1] < len(data)], at[1:][at[1:] > 0] - 1
    begins[firsts] = inside[firsts]
    ends[lasts] = inside[lasts]
    return low, np.flatnonzero(begins), np.flatnonzero(ends) + 1


class Index:
    """Postings of the templates' rarest words, and the weights that say which of a file's words is looked up first."""

    def __init__(self, templates: list[Template], idf: dict[str, float]):
        self.templates, self.postings = templates, defaultdict(list)
        weight = lambda w: (-idf.get(w, math.inf), w)
        for n, t in enumerate(templates):
            words = t.words.split()
            for k in sorted(range(len(words)), key=lambda k: (weight(words[k]), k))[:LOOKED_UP]:
                self.postings[words[k].encode()].append((n, k))
        self.order = {w: n for n, w in enumerate(sorted(self.postings, key=lambda w: weight(w.decode())))}
        self.needed = [min(LOOKED_UP, len(t.words.split())) for t in templates]
        self.words = [[w.encode() for w in t.words.split()] for t in templates]
        self.keys = [[[w.encode() for w in k.split()] for k in t.keys] for t in templates]
        # one pass finds whole looked-up words in the lower-cased bytes of many texts
        some = b"|".join(re.escape(w) for w in sorted(self.postings, key=lambda w: (-len(w), w)))
        self.finder = re.compile(rb"(?<![0-9a-z\x80-\xff])(?:" + some + rb")(?![0-9a-z\x80-\xff])")

    def places(self, hits: list[tuple[int, bytes]], word: Callable[[int], bytes], count: int) -> dict[int, list[int]]:
        """Verified beginnings of each template, from the text's (place, word) hits; ``word(k)`` is its k-th word."""
        standing: dict[bytes, list[int]] = defaultdict(list)
        for place, w in hits:
            standing[w].append(place)
        begins: dict[int, set[int]] = {}
        looked_up: dict[int, int] = defaultdict(int)
        for w in sorted(standing, key=self.order.__getitem__):  # the rarest of the file's licence words first
            for n, k in self.postings[w]:
                could = {p - k for p in standing[w]}
                begins[n] = begins[n] & could if n in begins else could
                looked_up[n] += 1
        found = {}
        for n, could in begins.items():
            own = self.words[n]
            if looked_up[n] == self.needed[n]:
                real = [b for b in could if b >= 0 and b + len(own) <= count and all(word(b + k) == w for k, w in enumerate(own))]
                if real and all(any(all(word(p + k) == w for k, w in enumerate(key)) for p in range(count - len(key) + 1)) for key in self.keys[n]):
                    found[n] = sorted(real)
        return found


def _document_frequencies(rows: DataFrame, words: list[str]) -> dict[str, int]:
    """How many texts hold each word: one pass over all texts, a row a batch to add up."""
    pattern = re.compile(rb"(?<![0-9a-z\x80-\xff])(?:" + b"|".join(re.escape(w.encode()) for w in sorted(words, key=lambda w: (-len(w), w))) + rb")(?![0-9a-z\x80-\xff])")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = defaultdict(int)
        texts = 0
        for whole in batches:
            for batch in slices(whole, "text"):
                data, at = string_buffer(batch.column("text"))
                low = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data).tobytes()
                texts += batch.num_rows
                for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                    for w in set(pattern.findall(low[a:b])):
                        total[w] += 1
        yield pa.RecordBatch.from_arrays([pa.array(["", *[w.decode() for w in total]]), pa.array([texts, *total.values()], pa.int64())], ["word", "n"])

    counted = rows.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r.word: r.n for r in counted.collect()}  # as many rows as the templates have words


def scan(docs: DataFrame, templates: list[Template] = TEMPLATES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Find licence phrases in every whole text; one row for each row of ``docs``.

    Returns doc_id, n_words, n_base (places of base phrases), first_word and last_word (least and greatest
    of those places, words from 0; else null), base_labels, labels (distinct, sorted, comma-joined; empty if
    none) and score: 1 less the product of (1 - weight) over the templates found, so 0 where there are none.

    Null and empty texts have no words. Null ids and repeated rows are scanned like any other; no rows give no
    rows; other columns aren't read, whatever their names; words of equal weight are looked up in their own order.
    Two passes over the texts and no shuffle of them: the first counts in how many texts the templates' words stand.
    A worker holds a slice of a batch (4 MB of text, or one longer text) and some bytes for each of its bytes.
    """
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), whole_text(docs, text_column).alias("text"))
    frequency = _document_frequencies(rows, sorted({w for t in templates for w in t.words.split()}))
    texts = frequency.pop("", 0)
    idf = {w: math.log((1 + texts) / (1 + n)) for w, n in frequency.items()}
    index = Index(templates, idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                data, at = string_buffer(batch.column("text"))
                low, starts, ends = words_of(data, at)
                raw, per_text = low.tobytes(), np.searchsorted(starts, at)
                of, hits = [[] for _ in range(batch.num_rows)], [(m.start(), m.group()) for m in index.finder.finditer(raw)]
                texts_of = np.searchsorted(at, [h for h, _ in hits], "right") - 1
                for k, place, (h, w) in zip(texts_of.tolist(), np.searchsorted(starts, [h for h, _ in hits]).tolist(), hits, strict=True):
                    if at[k] <= h and h + len(w) <= at[k + 1]:
                        of[k].append((place - int(per_text[k]), w))
                # a word at a text's edge: the pattern looks across the edge, the words don't
                edge = {int(p) for p in (*per_text[:-1], *(per_text[1:] - 1)) if 0 <= p < len(starts)}
                seen = {(k, p) for k, hs in enumerate(of) for p, _ in hs}
                for p in edge:
                    w = raw[starts[p] : ends[p]]
                    k = int(np.searchsorted(per_text, p, "right") - 1)
                    if w in index.postings and (k, p - int(per_text[k])) not in seen:
                        of[k].append((p - int(per_text[k]), w))
                out = []
                for k, own in enumerate(of):
                    first, count = int(per_text[k]), int(per_text[k + 1] - per_text[k])
                    found = index.places(own, lambda n, first=first: raw[starts[first + n] : ends[first + n]], count) if own else {}
                    base = sorted(p for n, ps in found.items() if templates[n].base for p in ps)
                    labels = [",".join(sorted({templates[n].label for n in found if b or templates[n].base})) for b in (False, True)]
                    score = 1 - math.prod(1 - templates[n].weight for n in sorted(found))
                    out.append((count, len(base), base[0] if base else None, base[-1] if base else None, *labels, round(score, 6)))
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], [f.split()[0] for f in SCHEMA.split(", ")])

    return rows.mapInArrow(run, SCHEMA)
