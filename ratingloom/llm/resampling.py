"""Importance resampling towards a target set: hashed n-grams, log-ratio gains and a Gumbel draw.

**Batches.** A task joins the texts of a batch with a separator that no word holds and finds all
words in one pass of a regular expression. ``searchsorted`` over the texts' offsets names the text
of each word; pairs of words of two texts are masked, and what is left is counted with ``bincount``.
A pair's checksum is made from those of its two words, so each distinct word is hashed once.

**Weights.** Feature counts of the texts and of the target are two rows of ``buckets`` numbers; their
smoothed log ratio, in thousandths, is a bucket's gain. A document's weight is the floored mean of
its features' gains.

**Draw.** Weight plus Gumbel noise (from a hash of the id) ranks documents as if drawn one after the
other without replacement in proportion to exp(weight / 1000). Ranks come from ranges of the sorted
rows and their sizes, so no task holds more than its range.

Defined cases: a null or empty text has no features and weight 0; a row without an id has no score,
is not counted and not drawn; rows of one id draw the same noise and are ranked one by one; the
length of a text is not bounded; an empty table or target gives an empty result or gains of the
smoothing alone.
"""

from __future__ import annotations

import functools
import itertools
import math
import re
import sys
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import before, map_carried, placed, rows_of, stored
from ratingloom.session import forget

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS, LONGEST_RUN, LEAST_WORDS, SHARE, SEED = 10_000, 2, 20, 25, 7
#: No word holds it.
SEPARATOR = "\n"
_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes.maketrans(_UPPER, _LOWER)
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Words of more bytes are hashed anew in each pair.
_SHIFTED = 64
_KNOWN_WORDS = 500_000
_ONES = np.uint32(0xFFFFFFFF)


def _byte_table() -> np.ndarray:
    """The checksum's step for each low byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320), np.uint32(0)) ^ (table >> np.uint32(1))
    return table


@functools.cache
def _shifts() -> np.ndarray:
    """[n, k, b]: what byte k of a checksum, being b, contributes after n more zero bytes."""
    table = _byte_table()
    now = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    out = [now]
    for _ in range(_SHIFTED):
        now = table[now & 255] ^ (now >> np.uint32(8))
        out.append(now)
    return np.stack(out)


def _with_space(crc: np.ndarray) -> np.ndarray:
    """Checksums of words with a space behind them."""
    crc = crc ^ _ONES
    return _byte_table()[(crc ^ np.uint32(32)) & np.uint32(255)] ^ (crc >> np.uint32(8)) ^ _ONES


class WordChecks(dict):
    """Checksum and length of words in one number, each computed once per task while memory lasts."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        made = self[word] = zlib.crc32(word) | len(word) << 32
        return made


def batch_features(known: WordChecks, texts: list[str | None], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, text) of every feature of a batch, and the words of every text. Features are all words
    and all pairs of neighbours."""
    encoded = [(text or "").encode("utf-8", "surrogatepass") for text in texts]
    joined = SEPARATOR.encode().join(encoded).translate(_FOLD)
    lengths = np.array([len(e) for e in encoded], np.int64)
    offsets = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    found = [(m.start(), known[m[0]]) for m in _WORD.finditer(joined)]
    flat = np.fromiter(itertools.chain.from_iterable(found), np.int64, 2 * len(found)).reshape(-1, 2)
    starts, packed = flat[:, 0], flat[:, 1]
    owner = np.searchsorted(offsets, starts, "right") - 1
    crc, size = (packed & 0xFFFFFFFF).astype(np.uint32), packed >> 32
    inside = np.flatnonzero(owner[1:] == owner[:-1])
    pairs = _pair_checks(crc, size, inside)
    for i in np.flatnonzero(size[inside + 1] > _SHIFTED).tolist():
        at = inside[i]
        second = joined[starts[at + 1] : starts[at + 1] + size[at + 1]]
        pairs[i] = zlib.crc32(second, zlib.crc32(b" ", int(crc[at])))
    bucket = np.concatenate((crc, pairs)).astype(np.int64) % buckets
    return bucket, np.concatenate((owner, owner[inside])), np.bincount(owner, minlength=len(texts))


def _pair_checks(crc: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Checksums of word ``first`` and the next with a space between."""
    left, length = _with_space(crc[first]), np.minimum(size[first + 1], _SHIFTED)
    shifts, out = _shifts(), crc[first + 1].copy()
    for k in range(4):
        out ^= shifts[length, k, (left >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def feature_counts(df: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how often features fall into each bucket; a task sends one row per bucket."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = WordChecks(), np.zeros(buckets, np.int64)
        for rows in rows_of(batches, "text"):
            total += np.bincount(batch_features(known, [text for (text,) in rows], buckets)[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["bucket", "n"])

    return df.select(F.col(text_col).alias("text")).mapInArrow(task, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(raw: list[int], target: list[int]) -> list[int]:
    """A bucket's gain from the counts of all buckets: thousandths of the smoothed log ratio, floored."""
    buckets, here, there = len(raw), sum(raw), sum(target)
    return [
        math.floor(1000 * math.log((t + 1) * (here + buckets) / ((s + 1) * (there + buckets)))) for s, t in zip(raw, target, strict=True)
    ]


def _weigher(gains: np.ndarray) -> Callable[[list[str | None]], Iterator[tuple]]:
    known = WordChecks()

    def apply(texts: list[str | None]) -> Iterator[tuple]:
        bucket, owner, words = batch_features(known, texts, len(gains))
        count = np.bincount(owner, minlength=len(texts))
        total = np.bincount(owner, gains[bucket].astype(float), minlength=len(texts)).astype(np.int64)
        weight = np.where(count > 0, total // np.maximum(count, 1), 0)
        yield from zip(words.tolist(), count.tolist(), weight.tolist(), strict=True)

    return apply


def _dense(counts: DataFrame, buckets: int) -> list[int]:
    """At most ``buckets`` rows, whatever the size of the table."""
    out = [0] * buckets
    for row in counts.collect():
        out[row.bucket] = row.n
    return out


def noise(id_col: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, floored, from the id's hash; null without an id."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), id_col.cast("string")).cast("binary"), 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform)))


def resample(
    df: DataFrame,
    target: DataFrame,
    share: int = SHARE,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
    text_col: str = "text",
    id_col: str = "doc_id",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(id_col, n_words, n_features, weight, score, rank, carried columns) of every row of ``df``.

    ``rank`` counts 1, 2, 3, .. over the ``share`` percent of texts of ``least_words`` words with the
    highest scores, ties to the smaller id; it is null for the others. Texts that look like those of
    ``target`` have higher weights.
    """
    spark = df.sparkSession
    gains = bucket_gains(_dense(feature_counts(df, text_col, buckets), buckets), _dense(feature_counts(target, text_col, buckets), buckets))
    # The gains are ``buckets`` numbers, whatever the data.
    weigh = functools.partial(_weigher, np.array(gains, np.int64))
    ids = df.select(F.col(id_col), F.col(text_col).alias("_text"), F.struct(*carry).alias("_carried") if carry else F.lit(0).alias("_carried"))
    weighed = map_carried(ids, id_col, "_text", ("_carried",), weigh, "n_words bigint, n_features bigint, weight bigint")
    weighed = weighed.select(
        F.col(id_col).alias("_id"), "n_words", "n_features", "weight", (F.col("weight") + noise(F.col(id_col), seed)).alias("score"), "_carried"
    )
    scored, scored_path = stored(weighed, "scores")
    asked = F.coalesce((F.col("n_words") >= least_words) & F.col("score").isNotNull(), F.lit(False))
    drawn = share * scored.where(asked).count() // 100
    order = [F.when(asked, 0).otherwise(1), F.col("score").desc(), F.col("_id"), F.col("n_features"), F.col("weight")]
    lined, _ = placed(scored, order, "ranks")
    forget(spark, scored_path)
    rank = before(lined, F.lit(1).cast("long"), "_rank").withColumn("_rank", F.col("_rank") + 1)
    return rank.select(
        F.col("_id").alias(id_col),
        "n_words",
        "n_features",
        "weight",
        "score",
        F.when(asked & (F.col("_rank") <= drawn), F.col("_rank")).alias("rank"),
        *[F.col(f"_carried.{c}") for c in carry],
    )
