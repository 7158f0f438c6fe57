"""Token counts of sections: documents are encoded whole, and tokens are attributed by their spans.

Every token has a character span in its document. Sections are spans too (the lines of a text, or
given ones), and an interval join gives each token to the section or sections it touches. A token
that crosses a boundary is allocated by a named rule:

- ``most``: to the section with most of its bytes, the earliest of equals;
- ``first``: to the section with its first byte;
- ``last``: to the section with its last byte.

Tokens outside all sections are not counted in any.

Defined cases: a null or empty text has no sections and no row; an empty line is a section with the
tokens of its line break; repeated rows give their sections once each; a null id stays null; the
length of a text is not bounded; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import sys
from array import array
from collections.abc import Callable, Iterator

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from ratingloom.llm.bpe import Pieces, byte_lengths, cut_text, shared_table, worker_pieces
from ratingloom.llm.common import map_rows_together

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RULES = ("most", "first", "last")


def line_sections(data: bytes) -> np.ndarray:
    """(start, stop) byte spans of the lines of a text, line breaks included; they cover the text."""
    breaks = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    starts = np.concatenate(([0], breaks[breaks < len(data)]))
    return np.stack([starts, np.append(starts[1:], len(data))], axis=1)


def attribute(starts: np.ndarray, stops: np.ndarray, sections: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(owner, crosses) per token: the index of the section it counts for, or -1, and whether it
    leaves that section. Tokens and sections are sorted, and neither overlap among themselves."""
    if not len(sections):
        return np.full(len(starts), -1), np.zeros(len(starts), bool)
    low, high = sections[:, 0], sections[:, 1]
    first = np.searchsorted(high, starts, "right")
    last = np.searchsorted(low, stops, "left") - 1
    touched = first <= last
    owner = np.where(touched, first if rule != "last" else last, -1)
    many = np.flatnonzero(touched & (last > first))
    if rule == "most":
        for token in many:
            spans = slice(first[token], last[token] + 1)
            share = np.minimum(high[spans], stops[token]) - np.maximum(low[spans], starts[token])
            owner[token] = first[token] + int(np.argmax(share))
    inside = (starts >= low[owner]) & (stops <= high[owner])
    return owner, touched & ~inside


def section_token_counts(
    df: DataFrame, ranks_path: str, pattern: str, rule: str = "most", text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """(id_col, section, char_start, char_stop, n_tokens, n_crossing): tokens of every line of every
    text under ``rule``; ``n_crossing`` of them reach into another section."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    rows = df.select(id_col, text_col)
    kind = rows.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, section int, char_start bigint, char_stop bigint, n_tokens bigint, n_crossing bigint"
    return map_rows_together(rows, functools.partial(_counter, shared_table(rows, ranks_path), pattern, rule), schema)


def _counter(table, pattern: str, rule: str) -> Callable[[list[tuple]], Iterator[tuple]]:
    lengths = byte_lengths(table.value.ranks).tolist()

    def packed(ids: list[int]) -> bytes:
        return array("i", [lengths[i] for i in ids]).tobytes()

    known = worker_pieces((table.value.digest, pattern, "lengths"), lambda: Pieces(pattern, table.value, packed))

    def apply(rows: list[tuple]) -> Iterator[tuple]:
        cuts = [cut_text(text) for _, text in rows]
        known.learn(set().union(*cuts))
        for (key, text), cut in zip(rows, cuts, strict=True):
            if text:
                sizes = np.frombuffer(b"".join([known[piece] for piece in cut]), np.intc).astype(np.int64)
                yield from count_lines(key, text, sizes, rule)

    return apply


def count_lines(key: object, text: str, lengths: np.ndarray, rule: str) -> Iterator[tuple]:
    """The rows of one text, given the byte lengths of its tokens."""
    data = text.encode("utf-8", "surrogatepass")
    stops = np.cumsum(lengths)
    sections = line_sections(data)
    owner, crosses = attribute(stops - lengths, stops, sections, rule)
    counted = np.bincount(owner[owner >= 0], minlength=len(sections))
    crossing = np.bincount(owner[crosses], minlength=len(sections))
    begun = np.cumsum(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)
    chars = np.concatenate(([0], begun))[sections]
    for i, (start, stop) in enumerate(chars.tolist()):
        yield key, i, start, stop, int(counted[i]), int(crossing[i])
