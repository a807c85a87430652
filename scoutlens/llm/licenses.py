"""License scan with a positional rare-token index.

Inverse document frequencies of the licence words come from all texts. Each template puts its
highest-IDF words, with their places in it, into one table of postings (word to templates and
places). The words of a text are looked up there; a posting's alignment is the text position minus
the template position, and postings are intersected by it: an alignment needs as many of the
template's rare words as any alignment with the least share must hold (two, or one where a single word
carries the template), so none can be missed, whatever else the text holds. What is left is held
to the template's mandatory key phrases, and reported if enough of the template's words, and
enough of their IDF, stand at it.
Base phrases are matched as consecutive words beside it and always reported.

The words of a text are compared by 64-bit hash in byte buffers; only the words of the
licence library are ever looked up, so work follows the text's length. The frequency table
has one row per licence word.

Defined results: a null or empty text has no word and no label; overlapping places all
count; equal alignments go to the earliest; an empty table gives no rows; repeated rows are
each scanned; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .common import with_key

#: phrases that name a licence, and its label (fixed by the contract)
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


@dataclass(frozen=True)
class Template:
    """A licence notice: its label, its wording and the phrases that it cannot lack."""

    label: str
    text: str
    mandatory: tuple


#: notices as their licences ask for them (fixed values)
TEMPLATES = (
    Template("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
             "except in compliance with the License. You may obtain a copy of the License at",
             ("apache license",)),
    Template("apache", "Licensed under the Apache License, Version 2.0", ("apache license",)),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3",
             ("gnu general public license",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
             "associated documentation files (the \"Software\"), to deal in the Software without restriction",
             ("permission is hereby granted", "without restriction")),
    Template("mit", "Released under the MIT License.", ("mit license",)),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
             "GNU General Public License as published by the Free Software Foundation",
             ("gnu general public license",)),
    Template("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the "
             "GNU Lesser General Public License as published by the Free Software Foundation",
             ("gnu lesser general public license",)),
    Template("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software "
             "Foundation", ("gnu affero general public license",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
             "provided that the following conditions are met",
             ("redistribution and use in source and binary forms",)),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
             "fee is hereby granted", ("with or without fee",)),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
             ("mozilla public license",)),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License (CC BY 4.0)",
             ("creative commons attribution",)),
    Template("cc-by", "Licensed under CC BY 4.0", ("cc by",)),
    Template("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
             "rights to this work", ("waived all copyright",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain",
             ("released into the public domain",)),
    Template("boost", "Distributed under the Boost Software License, Version 1.0", ("boost software license",)),
    Template("mit", "The above copyright notice and this permission notice shall be included in all copies or "
             "substantial portions of the Software", ("substantial portions of the software",)),
    Template("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License "
             "is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
             ("without warranties or conditions of any kind",)),
    Template("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
             "the following disclaimer in the documentation and/or other materials provided with the distribution",
             ("must reproduce the above copyright notice",)),
    Template("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the "
             "authors be held liable for any damages arising from the use of this software",
             ("without any express or implied warranty",)),
    Template("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
             "License", ("eclipse public license",)),
    Template("cddl", "The contents of this file are subject to the terms of the Common Development and Distribution "
             "License", ("common development and distribution license",)),
    Template("gfdl", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free "
             "Documentation License", ("gnu free documentation license",)),
    Template("ofl", "This Font Software is licensed under the SIL Open Font License, Version 1.1", ("sil open font license",)),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
             ("creative commons attribution sharealike",)),
    Template("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
             ("creative commons attribution noncommercial",)),
    Template("wtfpl", "Do What The Fuck You Want To Public License", ("do what the fuck you want",)),
    Template("eupl", "Licensed under the European Union Public Licence", ("european union public licence",)),
)

AGREE = 3                # words that must agree on an alignment (or all, if the template has fewer)
SHARE = 0.6              # least IDF-weighted share of the template that must stand at its alignment


def _split(text: str) -> list[str]:
    data, offsets = T.buffers(pa.array([text]))
    w = T.words(T.fold(data), offsets, T.NOT_ALNUM)
    return [bytes(w.data[a:b]).decode() for a, b in zip(w.start, w.end)]


@dataclass(frozen=True)
class Postings:
    """Rare words of the templates: the postings of word ``x`` are ``first[x]:first[x + 1]``."""

    first: np.ndarray
    template: np.ndarray
    place: np.ndarray
    votes: np.ndarray        # by template: postings that an alignment with the least share must hold
    longest: int             # words of the longest template


class Index:
    """Licence words by number, templates and phrases as word numbers."""

    def __init__(self, templates=TEMPLATES, phrases=None):
        phrases = PHRASES if phrases is None else phrases
        self.templates = [(t.label, _split(t.text), [_split(m) for m in t.mandatory]) for t in templates]
        self.phrases = [(label, _split(p)) for p, label in phrases.items()]
        every = [w for _, words, must in self.templates for w in [*words, *(x for m in must for x in m)]]
        every += [w for _, words in self.phrases for w in words]
        self.words = sorted(set(every))
        number = {w: i for i, w in enumerate(self.words)}
        hashed = np.array([T.hash_word(w) for w in self.words], np.uint64)
        self.by_hash = np.argsort(hashed)
        self.hashes = hashed[self.by_hash]
        to_ids = lambda ws: np.array([number[w] for w in ws], np.int64)
        self.templates = [(label, to_ids(ws), [to_ids(m) for m in must]) for label, ws, must in self.templates]
        self.phrases = [(label, to_ids(ws)) for label, ws in self.phrases]

    def ids(self, w: T.Words) -> np.ndarray:
        """The number of each word of a chunk, -1 where it is no licence word."""
        h = T.hashes(w.data, w.start, w.end)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.by_hash[at], -1)


def phrase_places(ids: np.ndarray, doc: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """First words of all places where a phrase's words stand consecutively in one text."""
    n = len(ids) - len(phrase) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(ids[:n] == phrase[0])
    for k in range(1, len(phrase)):
        at = at[ids[at + k] == phrase[k]]
    return at[doc[at] == doc[at + len(phrase) - 1]]


def frequencies(docs: DataFrame, index: Index) -> np.ndarray:
    """(texts with each licence word, texts) as one array; ``docs`` has a column text."""
    def count(batches):
        total = np.zeros(len(index.words) + 1, np.int64)
        for c in T.chunks(batches):
            w = T.word_column(c.column("text"), T.NOT_ALNUM)
            ids = index.ids(w)
            have = ids >= 0
            both = np.unique(w.doc[have] * len(index.words) + ids[have])
            total[:-1] += np.bincount(both % len(index.words), minlength=len(index.words))
            total[-1] += c.num_rows
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], ["word", "n"])

    got = docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(index.words) + 1, np.int64)
    out[got["word"].to_numpy()] = got["n"].to_numpy()
    return out


def postings(index: Index, idf: np.ndarray) -> Postings:
    """Each template's rarest words, as many as its votes need.

    An alignment with SHARE of the weight lacks at most 1 - SHARE of it. If the rare words without the
    heaviest one weigh more than that, two of them at least stand at it."""
    rows, votes = [], []
    for t, (_, words, _) in enumerate(index.templates):
        weight = idf[words]
        rare = np.argsort(-weight, kind="stable")
        lacking = (1 - SHARE) * weight.sum() * (1 + 1e-9)
        sums = np.cumsum(weight[rare])
        need = 2 if sums[-1] - sums[0] > lacking else 1
        size = int(np.searchsorted(sums, lacking + (sums[0] if need == 2 else 0.0), "right")) + 1
        rows += [(int(words[k]), t, int(k)) for k in rare[:size]]
        votes.append(need)
    word, template, place = np.array(sorted(rows), np.int64).reshape(-1, 3).T
    return Postings(np.searchsorted(word, np.arange(len(index.words) + 1)), template, place, np.array(votes, np.int64),
                    max((len(w) for _, w, _ in index.templates), default=0))


def candidates(found: Postings, ids: np.ndarray, w: T.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(template, text, start in it) of all alignments with enough postings, in this order."""
    at = np.flatnonzero(ids >= 0)
    lo = found.first[ids[at]]
    n = found.first[ids[at] + 1] - lo
    which = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
    at = np.repeat(at, n)
    doc = w.doc[at]
    start = at - w.bounds[doc] - found.place[which] + found.longest       # >= 0, also where a notice is cut off in front
    span, texts = int(w.counts.max(initial=0)) + found.longest + 1, len(w.counts)
    both, votes = np.unique((found.template[which] * texts + doc) * span + start, return_counts=True)
    pair, start = both // span, both % span - found.longest
    template, doc = pair // max(texts, 1), pair % max(texts, 1)
    enough = votes >= found.votes[template]
    return template[enough], doc[enough], start[enough]


def verified(words: np.ndarray, idf: np.ndarray, ids: np.ndarray, w: T.Words, doc: np.ndarray, start: np.ndarray):
    """Which alignments of a template hold, and their weighted shares."""
    weight = idf[words]
    held, agree = np.zeros(len(start)), np.zeros(len(start), np.int64)
    first, size = w.bounds[doc], w.counts[doc]
    for k, word in enumerate(words):
        at = start + k
        inside = (at >= 0) & (at < size)
        here = inside & (ids[first + np.where(inside, at, 0)] == word)
        held += weight[k] * here
        agree += here
    share = held / weight.sum()
    return (share >= SHARE) & (agree >= min(AGREE, len(np.unique(words)))), share


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", index: Index | None = None) -> DataFrame:
    """One row per row: key, n_words, n_base, first_word, last_word, base_labels, labels, score,
    starts (template alignments as label@word, in order)."""
    index = index or Index()
    rows = with_key(docs, key, text)
    seen = frequencies(rows, index)
    idf = np.log((seen[-1] + 1.0) / (seen[:-1] + 1.0)) + 1.0
    rare = postings(index, idf)

    def apply(batches):
        for c in T.chunks(batches):
            w = T.word_column(c.column("text"), T.NOT_ALNUM)
            ids, doc = index.ids(w), w.doc
            n = c.num_rows
            base_n, first, last = np.zeros(n, np.int64), np.full(n, 2**62), np.full(n, -1)
            base: list[set] = [set() for _ in range(n)]
            for label, phrase in index.phrases:
                at = phrase_places(ids, doc, phrase)
                d, at = doc[at], at - w.bounds[doc[at]]
                base_n += np.bincount(d, minlength=n)
                np.minimum.at(first, d, at)
                np.maximum.at(last, d, at)
                for x in np.unique(d):
                    base[x].add(label)
            labels, scores, starts = [], np.zeros(n), [[] for _ in range(n)]
            found: list[set] = [set(b) for b in base]
            template, text_of_it, start = candidates(rare, ids, w)
            for t in np.unique(template):
                label, words, mandatory = index.templates[t]
                mine = template == t
                d, at = text_of_it[mine], start[mine]
                for phrase in mandatory:                 # the texts that hold the template's key phrases
                    has = np.isin(d, doc[phrase_places(ids, doc, phrase)])
                    d, at = d[has], at[has]
                good, share = verified(words, idf, ids, w, d, at)
                for x, begin, value in zip(d[good].tolist(), at[good].tolist(), share[good].tolist()):
                    found[x].add(label)
                    scores[x] = max(scores[x], value)
                    starts[x].append((begin, label))
            scores = np.maximum(scores, [1.0 if b else 0.0 for b in base])
            join = lambda s: ",".join(sorted(s))
            none = base_n == 0
            labels = [join(s) for s in found]
            yield pa.record_batch([
                c.column("key"), pa.array(w.counts), pa.array(base_n),
                pa.array(first, pa.int64(), mask=none), pa.array(last, pa.int64(), mask=none),
                pa.array([join(s) for s in base], pa.string()), pa.array(labels, pa.string()),
                pa.array(np.minimum(scores, 1.0)),
                pa.array([",".join(f"{label}@{at}" for at, label in sorted(s)) for s in starts], pa.string())],
                ["key", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "starts"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(apply, f"key {kind}, n_words long, n_base long, first_word long, last_word long, "
                           "base_labels string, labels string, score double, starts string") \
        .withColumnRenamed("key", key)
