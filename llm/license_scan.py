"""License scan by a positional index of rare licence words.

The words of each licence template have their positions in it. For every template whose
mandatory key phrases are in a file, its words in the file are looked up from the highest
inverse document frequency, counted over the whole corpus, down to where no alignment that
covers enough of the template can avoid them; a position and a place in the file give a
relative position, and where several words agree on one the template may begin there. Such an
alignment counts if the key phrases stand within it.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from llm.frames import mapped
from llm.words import ALNUM, Words, slices, utf8

# Phrases that name a licence, and their labels.
PHRASES = [("gnu general public license", "gpl"), ("apache license", "apache"),
           ("cc by", "cc-by"), ("mit license", "mit")]

# Notices of common licences with the phrases that must stand in each.
TEMPLATES = {
    "mit-text": ("""permission is hereby granted free of charge to any person obtaining a copy of
        this software and associated documentation files the software to deal in the software
        without restriction including without limitation the rights to use copy modify merge
        publish distribute sublicense and or sell copies of the software""",
                 ["permission is hereby granted free of charge", "to deal in the software"]),
    "apache-notice": ("""licensed under the apache license version 2 0 the license you may not use
        this file except in compliance with the license you may obtain a copy of the license at""",
                      ["licensed under the apache license", "in compliance with the license"]),
    "apache-short": ("licensed under the apache license version 2 0",
                     ["apache license version 2 0"]),
    "gpl-notice": ("""this program is free software you can redistribute it and or modify it under
        the terms of the gnu general public license as published by the free software
        foundation either version 3 of the license or at your option any later version""",
                   ["gnu general public license", "free software foundation"]),
    "bsd-text": ("""redistribution and use in source and binary forms with or without modification
        are permitted provided that the following conditions are met redistributions of source
        code must retain the above copyright notice this list of conditions and the following
        disclaimer""", ["redistribution and use in source and binary forms",
                        "retain the above copyright notice"]),
    "cc-by-notice": ("""this work is licensed under a creative commons attribution 4 0
        international license""", ["creative commons attribution"]),
    "mpl-notice": ("""this source code form is subject to the terms of the mozilla public license v
        2 0 if a copy of the mpl was not distributed with this file you can obtain one at""",
                   ["mozilla public license"]),
    "isc-text": ("""permission to use copy modify and or distribute this software for any purpose
        with or without fee is hereby granted provided that the above copyright notice and this
        permission notice appear in all copies""", ["for any purpose with or without fee"]),
}

#: Places of a template that must agree on where it begins; words by which an alignment may
#: shift; share of a template that must be covered.
AGREE, SHIFT, COVER = 3, 3, 0.6


def _hash_words(phrase):
    data = np.frombuffer(phrase.encode(), dtype=np.uint8)
    words = Words(data, np.array([0, len(data)]), ALNUM)
    return words.hashes(), [words.text(i) for i in range(len(words.starts))]


class Index:
    """The templates' words and key phrases as hashes."""

    def __init__(self, templates=None, phrases=None):
        templates = TEMPLATES if templates is None else templates
        phrases = PHRASES if phrases is None else phrases
        self.labels = sorted(templates)
        self.bodies = [_hash_words(templates[n][0])[0] for n in self.labels]
        self.keys = [[_hash_words(p)[0] for p in templates[n][1]] for n in self.labels]
        self.phrases = [(*_hash_words(p), label) for p, label in phrases]
        words = {}
        for name in self.labels:
            words.update(zip(*(x for x in _hash_words(templates[name][0]))))
        self.vocabulary = np.array(sorted(words), dtype=np.uint64)
        self.words = [words[h].decode() for h in self.vocabulary]

    def entries(self, hashes):
        """Places whose word is in the vocabulary, and its number."""
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        places = np.flatnonzero(self.vocabulary[at] == hashes)
        return places, at[places]


def places_of(phrase, hashes):
    """Where the phrase's words stand consecutively."""
    n = len(hashes) - len(phrase) + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    found = np.flatnonzero(hashes[:n] == phrase[0])
    for k in range(1, len(phrase)):
        found = found[hashes[found + k] == phrase[k]]
    return found


def with_keys(index, words, hashes):
    """{document: [(template, places of each of its key phrases)]} where none is missing."""
    found = {}
    for t, keys in enumerate(index.keys):
        docs, at = np.arange(len(words.bounds) - 1), []
        for key in keys:
            first = places_of(key, hashes)
            doc = np.searchsorted(words.bounds, first, "right") - 1
            inside = first + len(key) <= words.bounds[doc + 1]
            at.append((first[inside], doc[inside]))
            docs = np.intersect1d(docs, doc[inside])
        for d in docs.tolist():
            found.setdefault(d, []).append(
                (t, [first[doc == d] - words.bounds[d] for first, doc in at]))
    return found


def _windows(index, idf, t, places, entries):
    """Bins in which template t may begin so that COVER of it is there; none is missed.

    The template's places are looked up from the rarest word on, until so few are left that
    an alignment that covers enough has AGREE of those looked up.
    """
    body = np.searchsorted(index.vocabulary, index.bodies[t])
    n = len(body)
    enough = next((m for m in range(1, n + 1) if m / n >= COVER), n + 1)
    present = np.isin(body, entries)
    if present.sum() < enough:
        return np.zeros(0, dtype=np.int64)
    # Places whose word isn't in the file come first: they cost nothing.
    looked = np.lexsort((body, -idf[body], present))[:n - enough + min(AGREE, enough)]
    pairs = []
    for w in np.unique(body[looked[present[looked]]]):
        at = places[entries == w]
        pairs += [(at - q) // SHIFT * n + q for q in looked[body[looked] == w].tolist()]
    pairs = np.concatenate(pairs)
    pairs = np.unique(np.concatenate([pairs, pairs - n]))  # a window is a bin and the next
    bins, votes = np.unique(pairs // n, return_counts=True)
    return bins[votes >= len(looked) - n + enough]


def aligned(index, idf, hashes, templates):
    """[(template, first word, coverage)] of the best alignment of each of the templates.

    ``templates`` has their key phrases' places, as from ``with_keys``. Of equal alignments
    the one that most words place in its own bin counts, then the first.
    """
    places, entries = index.entries(hashes)
    found = []
    for t, keys in templates:
        body, best = index.bodies[t], (COVER, -1, 0)
        bins = _windows(index, idf, t, places, entries)
        for key, at in zip(index.keys[t], keys):
            first = np.searchsorted(at, (bins - 1) * SHIFT)
            at = np.append(at, len(hashes) + 2 * len(body) + 9 * SHIFT)
            bins = bins[at[first] + len(key) <= (bins + 3) * SHIFT + len(body)]
        for bin_ in bins.tolist():
            hit = np.zeros((2, len(body)), dtype=bool)
            for first in range(bin_ * SHIFT, (bin_ + 2) * SHIFT):
                a, b = max(0, -first), min(len(body), len(hashes) - first)
                if b > a:
                    hit[first // SHIFT - bin_, a:b] |= body[a:b] == hashes[first + a:first + b]
            best = max(best, (float(hit.any(axis=0).mean()), int(hit[0].sum()), -bin_))
        if best[1] >= 0:
            found.append((t, max(0, -best[2] * SHIFT), best[0]))
    return found


def _counted(index):
    def count(batches):
        total, rows = np.zeros(len(index.vocabulary), dtype=np.int64), 0
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                words = Words(*utf8(batch.column("text")), ALNUM)
                places, entries = index.entries(words.hashes())
                doc = np.searchsorted(words.bounds, places, "right") - 1
                pairs = np.unique(doc * len(total) + entries)
                total += np.bincount(pairs % len(total), minlength=len(total))
                rows += batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, len(total))), pa.array(np.concatenate(([rows], total)))],
            ["word", "n"])
    return count


def inverse_frequencies(docs, index):
    """Inverse document frequency of every template word over all documents."""
    counts = mapped(docs.select(F.col("text").cast("string")), _counted(index),
                    "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = dict(counts.collect())  # one row for each word of the templates
    n = counts.get(-1, 0)
    return np.array([math.log((n + 1) / (counts.get(w, 0) + 1))
                     for w in range(len(index.vocabulary))])


_OUT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double, places array<string>")


def _scan(index, idf):
    types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.string())]
    names = [c.split()[0] for c in _OUT.split(", ")]

    def scan(batches):
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                words = Words(*utf8(batch.column("text")), ALNUM)
                hashes = words.hashes()
                templates = with_keys(index, words, hashes)
                found = {}
                for phrase, text, label in index.phrases:
                    at = places_of(phrase, hashes)
                    doc = np.searchsorted(words.bounds, at, "right") - 1
                    for i, d in zip(at.tolist(), doc.tolist()):
                        if i + len(phrase) <= words.bounds[d + 1] and all(
                                words.text(i + k) == w for k, w in enumerate(text)):
                            found.setdefault(d, []).append((i - int(words.bounds[d]), label))
                out = [[] for _ in types]
                for d, key in enumerate(batch.column("doc_id").to_pylist()):
                    a, b = int(words.bounds[d]), int(words.bounds[d + 1])
                    base = found.get(d, [])
                    more = aligned(index, idf, hashes[a:b], templates[d]) if d in templates else []
                    firsts = [i for i, _ in base]
                    labels = {label for _, label in base}
                    row = (key, b - a, len(base), min(firsts, default=None),
                           max(firsts, default=None), ",".join(sorted(labels)),
                           ",".join(sorted(labels | {index.labels[t] for t, _, _ in more})),
                           max([0.5 if base else 0.0] + [c for _, _, c in more]),
                           [f"{index.labels[t]}:{first}:{c:.3f}" for t, first, c in sorted(more)])
                    for column, value in zip(out, row):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, types)], names)
    return scan


def scan_licenses(docs, templates=None, phrases=None):
    """One row for each row of ``docs(doc_id, text)``; other columns are left out.

    ``n_base`` counts the places of the phrases, ``first_word`` and ``last_word`` are their
    smallest and largest start (null without any); ``labels`` adds the templates found by
    the index, ``places`` says where and how much of each is there, ``score`` is the largest
    cover, at least 0.5 with a base phrase. Null text counts as empty, repeated rows and null
    ids stay as they are, an empty table gives an empty result.
    """
    index = Index(templates, phrases)
    pairs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return mapped(pairs, _scan(index, inverse_frequencies(pairs, index)), _OUT)
