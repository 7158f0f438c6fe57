"""Language identification as inference of a mixture of languages.

Letter trigrams of all labelled texts are counted per language, in the map tasks first, over
``BUCKETS`` hashed bins: the model's size depends on the number of languages alone. A document's
trigrams are then explained as a mixture of languages: expectation-maximisation estimates the
proportions, languages are added in order of their proportion while the penalised likelihood
(``PENALTY`` half-log-counts per language) improves, and the proportions of the chosen set are what
is reported.

Only texts and labels are used; every text is read whole. Texts are never shuffled.

Defined cases: a null text or one without a letter is ``und`` with score 0 and no languages; so is
every text when nothing is labelled; ties go to the language that sorts first; repeated rows and
rows without an id give one output row each.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import lean, map_carried, rows_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 1 << 16
STEPS, PENALTY, SMOOTHING = 12, 6.0, 0.1
UNKNOWN = "und"
#: Bytes of text whose trigrams are held at once; some hundred bytes each.
TAKEN_BYTES = 500_000


@functools.cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, bucket, lettered): the hashed trigrams of lower-cased texts with all that is no letter
    as one space, and which texts have a letter."""
    lowered = [(text or "").lower() for text in texts]
    codes = np.frombuffer(" ".join(["", *lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) + 1 for t in lowered], np.int64)
    owner = np.concatenate(([0], np.repeat(np.arange(len(texts)), sizes)))[: len(codes)]
    is_letter = _letters()[codes]
    lettered = np.bincount(owner[is_letter], minlength=len(texts)) > 0
    keep = is_letter.copy()
    keep[0] = True
    keep[1:] |= is_letter[:-1]
    codes, owner, is_letter = np.where(is_letter, codes, 32)[keep], owner[keep], is_letter[keep]
    if len(codes) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64), lettered
    middle = is_letter[1:-1]
    values = codes.astype(np.uint64)
    mixed = values[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ values[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) ^ values[2:] * np.uint64(0xD6E8FEB86659FD93)
    bucket = ((mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)
    return owner[1:-1][middle], bucket[middle], lettered


class Model(NamedTuple):
    languages: list[str]
    likelihood: np.ndarray  # BUCKETS x languages


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """The model of all rows with a text and a language."""
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    counts = rows.mapInArrow(_count_trigrams, "lang string, bucket int, n bigint")
    # At most BUCKETS rows per language reach the driver, whatever the number of documents.
    table = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = table.column("lang").to_pylist()
    languages = sorted(set(names))
    at = {name: i for i, name in enumerate(languages)}
    matrix = np.zeros((BUCKETS, len(languages)))
    matrix[table.column("bucket").to_numpy(), [at[n] for n in names]] = table.column("n").to_numpy()
    matrix += SMOOTHING
    return Model(languages, matrix / matrix.sum(axis=0) if languages else matrix)


@lean
def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for rows in rows_of(batches, "lang", "text", taken=TAKEN_BYTES):
        owner, bucket, _ = trigrams([text for _, text in rows])
        names = np.array([lang for lang, _ in rows], dtype=object)
        for lang in set(names):
            mine = np.flatnonzero(names == lang)
            counted = np.bincount(bucket[np.isin(owner, mine, kind="table")], minlength=BUCKETS)
            totals[lang] = totals[lang] + counted if lang in totals else counted
    for lang, counted in totals.items():
        there = np.flatnonzero(counted)
        columns = [pa.array([lang] * len(there), pa.string()), pa.array(there.astype(np.int32)), pa.array(counted[there])]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])


def _mixture(likelihood: np.ndarray, counts: np.ndarray, starts: np.ndarray, sizes: np.ndarray, shares: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of every text after ``steps`` of expectation-maximisation."""
    total = np.add.reduceat(counts, starts)
    for step in range(steps + 1):
        joint = likelihood * np.repeat(shares, sizes, axis=0)
        norm = joint.sum(axis=1)
        if step == steps:
            return shares, np.add.reduceat(counts * np.log(norm), starts)
        joint *= (counts / norm)[:, None]
        shares = np.add.reduceat(joint, starts, axis=0) / total[:, None]


def infer(texts: list[str | None], model: Model) -> list[list[tuple[str, float]]]:
    """The chosen languages of each text with their proportions, largest first."""
    none: list[list[tuple[str, float]]] = [[] for _ in texts]
    owner, bucket, lettered = trigrams(texts)
    if not len(owner) or not model.languages:
        return none
    keys, counts = np.unique(owner << 16 | bucket, return_counts=True)
    counts = counts.astype(float)
    owner = keys >> 16
    likelihood = model.likelihood[keys & (BUCKETS - 1)]
    present, starts, sizes = np.unique(owner, return_index=True, return_counts=True)
    n_langs = len(model.languages)
    total = np.add.reduceat(counts, starts)
    shares, _ = _mixture(likelihood, counts, starts, sizes, np.full((len(present), n_langs), 1 / n_langs), STEPS)
    order = np.argsort(-shares, axis=1, kind="stable")
    rank = np.argsort(order, axis=1, kind="stable")
    # Sets of one, two, ... languages in order of proportion; the best penalised likelihood wins.
    chosen = (rank < 1).astype(float)
    _, best = _mixture(likelihood, counts, starts, sizes, chosen, 0)
    best -= PENALTY * np.log(total + 1) / 2
    open_texts = np.flatnonzero(np.take_along_axis(shares, order[:, 1:2], 1)[:, 0] > 0.01) if n_langs > 1 else np.empty(0, int)
    for size in range(2, n_langs + 1):
        if not len(open_texts):
            break
        mine = np.isin(np.repeat(np.arange(len(present)), sizes), open_texts)
        part = sizes[open_texts]
        begin = np.concatenate(([0], np.cumsum(part)[:-1]))
        start = shares[open_texts] * (rank[open_texts] < size)
        start /= start.sum(axis=1, keepdims=True)
        found, fit_ = _mixture(likelihood[mine], counts[mine], begin, part, start, STEPS // 2)
        fit_ -= PENALTY * size * np.log(total[open_texts] + 1) / 2
        better = fit_ > best[open_texts]
        chosen[open_texts[better]], best[open_texts[better]] = found[better], fit_[better]
        open_texts = open_texts[better]
    for row, text in enumerate(present.tolist()):
        if lettered[text]:
            top = sorted(((-s, name) for s, name in zip(chosen[row].tolist(), model.languages, strict=True) if s > 0))
            none[text] = [(name, min(1.0, -s)) for s, name in top]
    return none


def identify(df: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id_col, lang_pred, score, languages, carried columns): the main language of every text with its
    proportion, and all chosen languages with theirs."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = "lang_pred string, score double, languages array<struct<lang: string, share: double>>"
    return map_carried(df, id_col, text_col, carry, functools.partial(_identifier, shared), schema, TAKEN_BYTES)


def _identifier(shared) -> Callable[[list[str | None]], Iterator[tuple]]:
    model = shared.value

    def apply(texts: list[str | None]) -> Iterator[tuple]:
        for found in infer(texts, model):
            name, score = found[0] if found else (UNKNOWN, 0.0)
            yield name, score, [{"lang": lang, "share": share} for lang, share in found]

    return apply
