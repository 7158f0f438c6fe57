"""License scan by a positional index of rare template words.

1. **Frequencies.** One pass counts in how many documents each word of the templates occurs.
2. **Index.** Each template's words of highest inverse document frequency are its postings:
   (word, template, position). The index holds ``rare`` words per template, whatever the data.
3. **Scan.** Every occurrence of such a word in a file is looked up; position in the file minus
   position in the template says where the template would begin. Beginnings that lie within
   ``slack`` words of each other are one candidate. A candidate counts if the weighted share of
   template words found in order around it reaches ``threshold`` and a mandatory key phrase of the
   template stands inside it.
4. **Phrases.** Places where a fixed phrase's words stand consecutively label a file by themselves.

Nothing is shuffled but the word counts; a text never leaves its task. All places of a file are
looked up, however many there are.

Defined cases: a null or empty text has no words, no labels and score 0; repeated rows and rows
without an id give one output row each.
"""

from __future__ import annotations

import functools
import math
import sys
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from typing import NamedTuple

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import map_rows, map_rows_together, term_words

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Phrases that label a file wherever they stand.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


class Template(NamedTuple):
    """A licence's usual notice, and phrases of which one has to stand in it."""

    label: str
    text: str
    keys: tuple[str, ...]


# Usual notices of public licences.
TEMPLATES = (
    Template("mit", "Released under the MIT License.", ("mit license",)),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files, to deal in the Software without restriction, including without limitation the rights to"
        " use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        ("permission is hereby granted free of charge",),
    ),
    Template("apache-2", "Licensed under the Apache License, Version 2.0.", ("apache license version 2 0", "apache license 2 0")),
    Template("gpl-3", "This work is licensed under the GNU General Public License, version 3.", ("gnu general public license version 3",)),
    Template(
        "gpl-2",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation; version 2 of the License",
        ("version 2 of the license", "gnu general public license version 2"),
    ),
    Template("lgpl-3", "This library is licensed under the GNU Lesser General Public License, version 3.", ("gnu lesser general public license",)),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    Template(
        "mpl-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        ("mozilla public license",),
    ),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0.", ("cc by nc",)),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0.", ("cc by sa",)),
    Template("cc-by", "Licensed under CC BY 4.0.", ("cc by 4 0",)),
    Template("cc0", "To the extent possible under law, the author has waived all copyright under CC0 1.0.", ("cc0 1 0", "cc0")),
)

RARE, SLACK, THRESHOLD = 4, 2, 0.8


def _words(text: str) -> tuple[bytes, ...]:
    return tuple(term_words(text))


def document_frequencies(df: DataFrame, vocabulary: frozenset[bytes], text_col: str = "text") -> DataFrame:
    """(word, n_docs) of the words of a fixed vocabulary; counted per task before the shuffle."""
    counts = map_rows_together(df.select(text_col), functools.partial(_counter, vocabulary), "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n_docs"))


def _counter(vocabulary: frozenset[bytes]) -> Callable[[list[tuple]], Iterator[tuple]]:
    def apply(rows: list[tuple]) -> Iterator[tuple]:
        found: Counter[bytes] = Counter()
        for (text,) in rows:
            found.update(vocabulary.intersection(term_words(text)))
        yield from ((word.decode(), n) for word, n in found.items())

    return apply


class Index(NamedTuple):
    """Postings of the rarest template words, template words with their weights, and key phrases."""

    postings: dict[bytes, list[tuple[int, int]]]
    words: list[tuple[bytes, ...]]
    weights: list[list[float]]
    keys: list[list[tuple[bytes, ...]]]
    labels: list[str]


def build_index(templates: tuple[Template, ...], n_docs: dict[bytes, int], total: int, rare: int = RARE) -> Index:
    idf = lambda word: math.log((total + 1) / (n_docs.get(word, 0) + 1)) + 1e-3
    words = [_words(t.text) for t in templates]
    postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
    for which, template in enumerate(words):
        for word in sorted(set(template), key=lambda w: (-idf(w), w))[:rare]:
            postings[word] += [(which, at) for at, other in enumerate(template) if other == word]
    weights = [[idf(w) for w in template] for template in words]
    return Index(dict(postings), words, weights, [[_words(k) for k in t.keys] for t in templates], [t.label for t in templates])


def _found_at(words: list[bytes], phrase: tuple[bytes, ...], low: int, high: int) -> bool:
    size = len(phrase)
    return any(tuple(words[i : i + size]) == phrase for i in range(max(0, low), min(high, len(words)) - size + 1))


def match_templates(words: list[bytes], index: Index, slack: int, threshold: float) -> list[tuple[str, int, int, float]]:
    """(label, start, stop, share) of every place where enough of a template stands."""
    begins: dict[int, set[int]] = defaultdict(set)
    postings = index.postings
    for at, word in enumerate(words):
        for which, offset in postings.get(word, ()):
            begins[which].add(at - offset)
    out = []
    for which, places in begins.items():
        template, weights = index.words[which], index.weights[which]
        last = None
        for begin in sorted(places):
            if last is not None and begin - last <= slack:
                continue
            share = _share(words, template, weights, begin, slack)
            low, high = begin - slack, begin + len(template) + slack
            if share >= threshold and any(_found_at(words, key, low, high) for key in index.keys[which]):
                out.append((index.labels[which], max(0, begin), min(len(words), begin + len(template)), share))
                last = begin
    return out


def _share(words: list[bytes], template: tuple[bytes, ...], weights: list[float], begin: int, slack: int) -> float:
    """Weight of the template words found in order, each at most ``slack`` places off."""
    shift, got = 0, 0.0
    for offset, word in enumerate(template):
        for move in sorted(range(-slack, slack + 1), key=lambda m: (abs(m - shift), m)):
            at = begin + offset + move
            if move >= shift - slack and 0 <= at < len(words) and words[at] == word:
                got += weights[offset]
                shift = move
                break
    return got / sum(weights)


def phrase_places(line: bytes, phrases: dict[tuple[bytes, ...], str]) -> list[tuple[int, str]]:
    """(word position, label) of all places of the phrases in words joined by single spaces."""
    out = []
    for phrase, label in phrases.items():
        wanted = b" " + b" ".join(phrase) + b" "
        at = line.find(wanted)
        while at >= 0:
            out.append((line.count(b" ", 0, at + 1) - 1, label))
            at = line.find(wanted, at + 1)
    return out


def scan_licenses(
    df: DataFrame,
    templates: tuple[Template, ...] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
    rare: int = RARE,
    slack: int = SLACK,
    threshold: float = THRESHOLD,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """One row per document: id_col, n_words, n_base, first_word, last_word, base_labels, labels, score
    and ``matches``, the places of the templates with their share."""
    rows = df.select(id_col, text_col)
    vocabulary = frozenset(w for t in templates for w in _words(t.text))
    # The counts are of a fixed vocabulary, so what reaches the driver does not grow with the data.
    n_docs = {r.word.encode(): r.n_docs for r in document_frequencies(rows, vocabulary, text_col).collect()}
    index = build_index(templates, n_docs, rows.count(), rare)
    listed = {_words(text): label for text, label in phrases.items()}
    kind = rows.schema[id_col].dataType.simpleString()
    return map_rows(
        rows,
        functools.partial(_scanner, index, listed, slack, threshold),
        f"{id_col} {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string,"
        " labels string, score double, matches array<struct<label: string, start: bigint, stop: bigint, share: double>>",
    )


def _scanner(index: Index, phrases: dict[tuple[bytes, ...], str], slack: int, threshold: float) -> Callable[..., Iterator[tuple]]:
    def apply(key: object, text: str | None) -> Iterator[tuple]:
        words = term_words(text)
        places = phrase_places(b" " + b" ".join(words) + b" ", phrases)
        found = match_templates(words, index, slack, threshold) if not index.postings.keys().isdisjoint(words) else []
        base = {label for _, label in places}
        labels = base | {label for label, _, _, _ in found}
        score = 1.0 if places else max((share for *_, share in found), default=0.0)
        starts = [at for at, _ in places]
        matches = [{"label": a, "start": b, "stop": c, "share": min(1.0, d)} for a, b, c, d in found]
        first, last = (min(starts), max(starts)) if starts else (None, None)
        yield key, len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), min(1.0, score), matches

    return apply
