"""License scan by a positional index of rare words.

*Index.*  Postings: every word of a template's mandatory key phrases with the templates that hold
it and its place there.  How rare a word is comes from the corpus: the documents that hold it
are counted over the whole table, idf = ln(1 + documents / (1 + holders)).

*Scan.*  A file's licence words are looked up, those of highest idf first.  A place of the word
in the file, less its place in a template, is where the template would start; the starts that
the first `LOOKUPS` words of a template give are intersected, and a template without a start
left is given up.  Only templates are open whose mandatory words the file holds altogether, and
as these phrases must stand, every true start is among those of each of their words: none is
lost, whatever other notices the file holds.  The key phrases are verified at the starts left.  A
template is found where they stand and words worth `COVER` of its idf are at their place.

*Phrases.*  Beside that the base phrases are counted wherever their words stand together.

`score` is the largest share of a template's idf at its place among templates found; a
file with base phrases only has half; others 0.  A null text is empty.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scan
from .store import doc_field, packed, unpacked

COVER = 0.7
LOOKUPS = 3

# fixed values: phrases and their labels
BASE = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# fixed values: notices in their usual wording (label, notice, mandatory phrases)
NOTICES = (
    ("mit", "released under the mit license", ("released under the mit license",)),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        ("permission is hereby granted free of charge", "to deal in the software without restriction"),
    ),
    ("apache", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    (
        "apache",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at http "
        "www apache org licenses license 2 0",
        ("except in compliance with the license", "apache org licenses"),
    ),
    ("gpl", "this work is licensed under the gnu general public license version 3", ("gnu general public license",)),
    (
        "gpl",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
        "free software foundation either version 3 of the license or at your option any later version",
        ("under the terms of the gnu general public license", "free software foundation"),
    ),
    (
        "lgpl",
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published "
        "by the free software foundation either version 3 of the license or at your option any later version",
        ("gnu lesser general public license",),
    ),
    (
        "agpl",
        "you can redistribute it and or modify it under the terms of the gnu affero general public license as published "
        "by the free software foundation either version 3 of the license or at your option any later version",
        ("gnu affero general public license",),
    ),
    (
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
        "distributed with this file you can obtain one at",
        ("mozilla public license v 2 0",),
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
        ("redistribution and use in source and binary forms", "are permitted provided that"),
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        ("for any purpose with or without fee is hereby granted",),
    ),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("under cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("under cc by sa",)),
    ("cc-by", "licensed under cc by 4 0", ("under cc by 4 0",)),
    (
        "cc-by",
        "this work is licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution 4 0",),
    ),
    ("proprietary", "all rights reserved", ("all rights reserved",)),
)


class Template(NamedTuple):
    label: str
    words: np.ndarray
    # (place in the template, words) of each mandatory phrase
    phrases: list
    needed: np.ndarray


class Index(NamedTuple):
    """`postings[word]`: (template, place) of a mandatory word; `needs[word, template]`."""

    vocabulary: np.ndarray
    templates: list[Template]
    base: list
    postings: dict
    needs: np.ndarray


def index_of(notices=NOTICES, base=BASE) -> Index:
    texts = [n for _, n, _ in notices] + [p for p, _ in base]
    vocabulary = np.unique(np.array([scan.text_hash(w) for t in texts for w in t.split()], np.uint64))

    def numbers(text: str) -> np.ndarray:
        return np.searchsorted(vocabulary, np.array([scan.text_hash(w) for w in text.split()], np.uint64))

    templates, postings = [], {}
    needs = np.zeros((len(vocabulary), len(notices)), np.int32)
    for t, (label, notice, phrases) in enumerate(notices):
        words, placed = numbers(notice), []
        for phrase in phrases:
            at = f" {notice} ".find(f" {phrase} ")
            if at < 0:
                raise ValueError(f"the notice lacks its phrase {phrase!r}")
            placed.append((len(notice[:at].split()), numbers(phrase)))
        places: dict = {}
        for at, found in placed:
            for i, word in enumerate(found.tolist(), at):
                places.setdefault(word, i)
        for word, place in places.items():
            postings.setdefault(word, []).append((t, place))
            needs[word, t] = 1
        templates.append(Template(label, words, placed, np.array(sorted(places))))
    return Index(vocabulary, templates, [(numbers(p), label) for p, label in base], postings, needs)


def _plain(index: Index) -> tuple:
    """The index as built-in types, which workers read without this package."""
    return (index.vocabulary, [tuple(t) for t in index.templates], *index[2:])


def _restored(parts: tuple) -> Index:
    return Index(parts[0], [Template(*t) for t in parts[1]], *parts[2:])


def _numbered(index: Index, data: np.ndarray, off: np.ndarray) -> tuple[scan.Words, np.ndarray]:
    """The words of a block and their numbers in the vocabulary, -1 for others."""
    found = scan.words(data, off, scan.ALPHANUMERIC)
    hashes = scan.word_hashes(data, found, fold=True)
    at = np.searchsorted(index.vocabulary, hashes)
    at[at == len(index.vocabulary)] = 0
    return found, np.where(index.vocabulary[at] == hashes, at, -1)


def _holdings(index: Index, found: scan.Words, numbers: np.ndarray, texts: int) -> np.ndarray:
    """Which text holds which word."""
    held = np.zeros((texts, len(index.vocabulary)), bool)
    known = numbers >= 0
    held[scan.owners(found.first)[known], numbers[known]] = True
    return held


def _counted(shared):
    def task(batches):
        index = _restored(shared.value)
        total = np.zeros(len(index.vocabulary) + 1, np.int64)
        for batch in batches:
            for low, high, data, off in scan.blocks(batch.column(0)):
                found, numbers = _numbered(index, data, off)
                total[:-1] += _holdings(index, found, numbers, high - low).sum(axis=0)
                total[-1] += high - low
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["word", "n"])

    return task


def rarities(held: np.ndarray, documents: int) -> np.ndarray:
    """The idf of every word from the number of documents that hold it."""
    return np.log1p(documents / (1.0 + held))


def align(index: Index, idf: np.ndarray, numbers: np.ndarray, possible) -> tuple[dict[int, float], int]:
    """Templates found in one file with the largest share of their idf at its place, and how many were compared.

    `possible`: the templates whose mandatory words the file holds.
    """
    waiting = {int(t): min(LOOKUPS, len(index.templates[t].needed)) for t in possible}
    starts: dict[int, np.ndarray] = {}
    words = np.flatnonzero(index.needs[:, possible].any(axis=1))
    for word in words[np.argsort(-idf[words], kind="stable")].tolist():
        wanted = [(t, place) for t, place in index.postings[word] if t in waiting]
        if not wanted:
            continue
        places = np.flatnonzero(numbers == word)
        for t, place in wanted:
            own = starts.get(t)
            starts[t] = places - place if own is None else own[np.isin(own + place, places, assume_unique=True)]
            waiting[t] -= 1
            if not waiting[t] or not len(starts[t]):
                del waiting[t]
        if not waiting:
            break
    found: dict[int, float] = {}
    compared = [t for t, own in starts.items() if len(own)]
    if compared:
        most = max(len(x.words) for x in index.templates)
        padded = np.concatenate([np.full(most, -1), numbers, np.full(most, -1)])
    for t in compared:
        template, own = index.templates[t], starts[t] + most
        for at, phrase in template.phrases:
            for i, word in enumerate(phrase.tolist(), at):
                own = own[padded[own + i] == word]
        if len(own):
            there = sum((padded[own + i] == word) * idf[word] for i, word in enumerate(template.words.tolist()))
            # added up in the same order, so that a whole notice has exactly one
            share = float(there.max() / np.cumsum(idf[template.words])[-1])
            if share >= COVER:
                found[t] = share
    return found, len(compared)


_FIELDS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
_ADDED = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def _scanned(shared):
    def task(batches):
        parts, idf = shared.value
        index = _restored(parts)
        asked = index.needs.sum(axis=0)
        for batch in batches:
            out: list[list] = [[] for _ in _FIELDS]
            for low, high, data, off in scan.blocks(batch.column("_text")):
                found, numbers = _numbered(index, data, off)
                held = _holdings(index, found, numbers, high - low)
                possible = held.astype(np.int32) @ index.needs == asked
                places = [_phrase_places(numbers, found, words) for words, _ in index.base]
                for i in range(high - low):
                    a, b = int(found.first[i]), int(found.first[i + 1])
                    own = [p[np.searchsorted(p, a) : np.searchsorted(p, b)] - a for p in places]
                    starts = np.concatenate(own)
                    base = {label for (_, label), p in zip(index.base, own) if len(p)}
                    some = np.flatnonzero(possible[i])
                    notices = align(index, idf, numbers[a:b], some)[0] if len(some) else {}
                    labels = base | {index.templates[t].label for t in notices}
                    row = (
                        b - a,
                        len(starts),
                        int(starts.min()) if len(starts) else None,
                        int(starts.max()) if len(starts) else None,
                        ",".join(sorted(base)),
                        ",".join(sorted(labels)),
                        max([*notices.values(), 0.5 if base else 0.0]),
                    )
                    for column, value in zip(out, row):
                        column.append(value)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            columns = [batch.column("_doc"), *[pa.array(x, t) for x, t in zip(out, kinds)]]
            yield pa.RecordBatch.from_arrays(columns, names=["_doc", *_FIELDS])

    return task


def _phrase_places(numbers: np.ndarray, found: scan.Words, phrase: np.ndarray) -> np.ndarray:
    """Where in the block the phrase stands within one text."""
    places = np.flatnonzero(numbers == phrase[0])
    places = places[places + len(phrase) <= len(numbers)]
    for ahead, word in enumerate(phrase[1:].tolist(), 1):
        places = places[numbers[places + ahead] == word]
    text = np.searchsorted(found.first, places, "right") - 1
    return places[places + len(phrase) <= found.first[text + 1]]


def scan_licenses(
    docs: DataFrame, text_column: str = "text", notices=NOTICES, base=BASE, carry: list[str] | None = None
) -> DataFrame:
    """`docs` (or its columns `carry`) with the counts, places, labels and score of licences.

    Columns of the names added are replaced.
    """
    wanted = docs.select(*[f"`{c}`" for c in carry or docs.columns])
    context = docs.sparkSession.sparkContext
    index = index_of(notices, base)
    shared = context.broadcast(_plain(index))
    counts = docs.select(F.col(text_column)).mapInArrow(_counted(shared), "word long, n long")
    held = np.zeros(len(index.vocabulary) + 1)
    # one row per word of the templates, and one for all documents
    for word, n in counts.groupBy("word").agg(F.sum("n")).collect():
        held[word] = n
    ranked = context.broadcast((_plain(index), rarities(held[:-1], held[-1])))
    rows = packed(docs).select(
        F.struct(*[doc_field(c).alias(c) for c in wanted.columns]).alias("_doc"), doc_field(text_column).alias("_text")
    )
    layout = rows.select("_doc").schema
    for part in _ADDED.split(", "):
        layout = layout.add(*part.split(" "))
    return unpacked(rows.mapInArrow(_scanned(ranked), layout), wanted, *_FIELDS)
