"""Substring dedup by seed and extend: repeated passages stay in the document of smallest id.

0. **Copies.** A text that a smaller id has as a whole goes whole; only first texts go on.
1. **Seeds.** Every window of ``length`` words keeps the smallest hash of its ``seed_words``-word runs
   (winnowing), so equal windows keep equal seeds. Per seed only the smallest and largest digest of
   the texts with it are aggregated, in the map tasks first; a seed of two different texts is shared.
2. **Extend.** A document's seeds that another document has too are extended both ways to the windows
   that chose them; a window is known by 128 bits of hash. The smallest document per window decides.
3. **Keep.** Covered windows that touch form the maximal repeats of a document, at least ``length``
   words long, and are cut from it.

No pair of documents is ever made, so a passage that a third of all documents share costs one row
per document and window. Texts are read as words three times and shuffled twice, windows are made
only where a seed is shared; seeds and windows are written once and every step starts from rows
written below the shared folder.

Defined cases: a null or empty text has no words and keeps nothing; texts shorter than a window are
kept whole; rows with one id count as one document and are each judged against smaller ids; a row
without an id neither owns nor loses a passage.
"""

from __future__ import annotations

import functools
import itertools
import re
import sys
from collections.abc import Callable, Iterator

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import Runs, WordHashes, map_arrays, map_rows_together, space_words, stored, tagged
from ratingloom.session import forget

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH, SEED_WORDS = 13, 6
LAYOUTS = ("words", "text")
_GAPS = re.compile(rb"([\x20\x09-\x0D]+)")


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` consecutive values."""
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        values = np.minimum(values[:-step], values[step:]) if len(values) > step else values[:0]
        reach += step
    return values


def _seeds(runs: Runs, length: int, seed_words: int) -> np.ndarray:
    """The seed of every window, by the window's first word."""
    return _lowest(runs.of(seed_words), length - seed_words + 1)


def _seed_rows(length: int, seed_words: int) -> Callable[[list[tuple]], Iterator[tuple]]:
    known = WordHashes()

    def apply(rows: list[tuple]) -> Iterator[tuple]:
        runs = Runs(known, [space_words(text) for _, _, text in rows])
        seeds, whole = _seeds(runs, length, seed_words), runs.whole(length)
        if not whole.any():
            return
        owner = runs.owner[: len(seeds)]
        keep = _each_once(seeds, owner, np.flatnonzero(whole))
        ids, said = (np.array([row[i] for row in rows], np.int64) for i in (0, 1))
        yield seeds[keep].view(np.int64), said[owner[keep]], ids[owner[keep]]

    return apply


def _window_rows(length: int, seed_words: int) -> Callable[[list[tuple]], Iterator[tuple]]:
    known = WordHashes()

    def apply(rows: list[tuple]) -> Iterator[tuple]:
        runs = Runs(known, [space_words(text) for _, text, _ in rows])
        seeds, whole = _seeds(runs, length, seed_words), runs.whole(length)
        if not whole.any():
            return
        shared = _tagged_lists([found for _, _, found in rows])
        owner = runs.owner[: len(seeds)]
        at = np.flatnonzero(whole)
        at = at[_among(tagged(seeds[at], owner[at]), shared)]
        ids = np.array([key for key, _, _ in rows], np.int64)
        one = runs.of(length)
        at = _each_once(one, owner, at)
        yield one[at].view(np.int64), runs.of(length, 1)[at].view(np.int64), ids[owner[at]]

    return apply


def _each_once(values: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The places ``at`` without those whose value their text has had, so a text that repeats a line
    sends it once."""
    # Most repeats of a seed are neighbours; what is left is sorted.
    at = at[np.concatenate(([True], (values[at[1:]] != values[at[:-1]]) | (owner[at[1:]] != owner[at[:-1]])))] if len(at) else at
    return at[np.unique(tagged(values[at], owner[at]), return_index=True)[1]]


def _tagged_lists(lists: list[list[int] | None]) -> np.ndarray:
    counts = [len(found or ()) for found in lists]
    flat = np.fromiter(itertools.chain.from_iterable(found or () for found in lists), np.int64, sum(counts))
    return np.sort(tagged(flat.view(np.uint64), np.repeat(np.arange(len(lists)), counts)))


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def _cut_rows(length: int, layout: str) -> Callable[[list[tuple]], Iterator[tuple]]:
    known = WordHashes()

    def apply(rows: list[tuple]) -> Iterator[tuple]:
        texts = [space_words(text) for _, text, _, _ in rows]
        copies = [i for i, (_, _, _, whole) in enumerate(rows) if whole and len(texts[i]) >= length]
        removed = {i: np.ones(len(texts[i]), bool) for i in copies}
        touched = [i for i, (_, _, found, _) in enumerate(rows) if found and i not in removed]
        if touched:
            runs = Runs(known, [texts[i] for i in touched])
            hit = runs.whole(length)
            owner = runs.owner[: len(hit)]
            hit &= _among(tagged(runs.of(length), owner), _tagged_lists([rows[i][2] for i in touched]))
            edges = np.zeros(runs.total + 1, np.int64)
            np.add.at(edges, np.flatnonzero(hit), 1)
            np.add.at(edges, np.flatnonzero(hit) + length, -1)
            covered = np.cumsum(edges[:-1]) > 0
            removed |= {i: covered[runs.first[k] : runs.first[k + 1]] for k, i in enumerate(touched)}
        for i, (key, text, _, _) in enumerate(rows):
            words, gone = texts[i], removed.get(i)
            if gone is None or not gone.any():
                kept = b" ".join(words).decode("utf-8", "replace") if layout == "words" else text
                yield key, len(words), 0, kept, []
                continue
            change = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
            spans = [{"start": int(a), "stop": int(b)} for a, b in change.reshape(-1, 2)]
            kept = _kept(words, text, ~gone, layout).decode("utf-8", "replace")
            yield key, len(words), int(gone.sum()), kept, spans

    return apply


def _kept(words: list[bytes], text: str, keep: np.ndarray, layout: str) -> bytes:
    if layout == "words":
        return b" ".join(itertools.compress(words, keep.tolist()))
    parts = _GAPS.split(text.encode("utf-8", "surrogatepass"))
    lead = [parts.pop(0)] if not parts[0] else []
    lead += [parts.pop(0)] if lead and parts else []
    pairs = itertools.zip_longest(parts[::2], parts[1::2], fillvalue=b"")
    stay = [word + gap for (word, gap), k in zip(pairs, keep.tolist()) if k]
    return b"".join(lead + stay)


def whole_copies(texts: DataFrame) -> DataFrame:
    """(doc_id, copies): digests of a document's texts that a document of smaller id has as well."""
    said = texts.select("doc_id", F.md5("text").alias("digest")).distinct()
    first = said.groupBy("digest").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    return said.join(first, "digest").where("doc_id > low").groupBy("doc_id").agg(F.collect_list("digest").alias("copies"))


def _is_copy() -> Column:
    return F.coalesce(F.array_contains("copies", F.md5("text")), F.lit(False))


def remove_repeats(
    df: DataFrame,
    length: int = LENGTH,
    seed_words: int = SEED_WORDS,
    layout: str = "words",
    text_col: str = "text",
    id_col: str = "doc_id",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(id_col, n_words, n_removed, kept, repeats, carried columns): every document without the words that a window of
    ``length`` words shared with a document of smaller id covers.

    ``repeats`` are the maximal removed spans in words. ``kept`` joins the words by one space, or with
    ``layout="text"`` keeps the white space of the text.
    """
    if layout not in LAYOUTS or not 0 < seed_words <= length:
        raise ValueError("layout is words or text; a seed is no longer than a window")
    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    named = texts.where("doc_id is not null and text is not null")
    copied, copied_path = stored(whole_copies(named), "copies")

    made = map_arrays(
        named.select("doc_id", F.xxhash64("text").alias("said"), "text"),
        functools.partial(_seed_rows, length, seed_words),
        "seed bigint, said bigint, doc_id bigint",
    )
    seeds, seeds_path = stored(made, "seeds")
    shared = seeds.groupBy("seed").agg(F.min("said").alias("low"), F.max("said").alias("high")).where("low < high")
    by_doc = seeds.select("seed", "doc_id").join(shared.select("seed"), "seed").groupBy("doc_id").agg(F.collect_list("seed").alias("seeds"))
    by_doc, by_doc_path = stored(by_doc.join(copied, "doc_id", "left"), "shared-seeds")
    forget(df.sparkSession, seeds_path)

    first_said = named.join(by_doc, "doc_id").where(~_is_copy())
    made = map_arrays(
        first_said.select("doc_id", "text", "seeds"),
        functools.partial(_window_rows, length, seed_words),
        "one bigint, two bigint, doc_id bigint",
    )
    windows, windows_path = stored(made, "windows")
    forget(df.sparkSession, by_doc_path)
    owners = windows.groupBy("one", "two").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    repeated = windows.join(owners, ["one", "two"]).where("doc_id > low").groupBy("doc_id").agg(F.collect_list("one").alias("found"))
    repeated, _ = stored(repeated.join(copied, "doc_id", "full"), "repeats")
    forget(df.sparkSession, copied_path, windows_path)

    columns = (id_col, *[c for c in carry if c != id_col])
    rows = df.select(F.struct(*columns).alias("carried"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["carried"].dataType.simpleString()
    cut = map_rows_together(
        rows.join(repeated, "doc_id", "left").select("carried", "text", "found", _is_copy().alias("whole")),
        functools.partial(_cut_rows, length, layout),
        f"carried {kind}, n_words bigint, n_removed bigint, kept string, repeats array<struct<start: bigint, stop: bigint>>",
    )
    made = ("n_words", "n_removed", "kept", "repeats")
    return cut.select(F.col(f"carried.{id_col}"), *made, *[F.col(f"carried.{c}") for c in columns[1:]])
