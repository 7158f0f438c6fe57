"""Helpers of the text operators: word splitting, Arrow task functions, written intermediate tables."""

from __future__ import annotations

import ctypes
import functools
import hashlib
import itertools
import sys
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ratingloom.session import scratch

# Executors get task functions by value and need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of an output batch; text is processed one value at a time, so this bounds a task's memory.
OUT_ROWS = 200_000
OUT_CHARS = 8_000_000
TAKEN_ROWS, TAKEN_BYTES = 1_000, 2_000_000
#: Words whose hashes a task remembers; some 150 bytes each.
KNOWN_WORDS = 300_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: What an ASCII-lower-cased text keeps as word bytes: 0-9, a-z and every byte of a non-ASCII character.
_KEPT = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def space_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8; null has none."""
    return _utf8(text).split() if text else []


def term_words(text: str | None) -> list[bytes]:
    """Words of ASCII letters, digits and non-ASCII characters after lower-casing A-Z; null has none."""
    return _utf8(text).translate(_KEPT).split() if text else []


def _utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def rows_of(batches: Iterable[pa.RecordBatch], *columns: str, taken: int = TAKEN_BYTES) -> Iterator[list[tuple]]:
    """The rows of Arrow batches in lists: at most ``TAKEN_ROWS``, and no more once ``taken`` bytes are full."""
    for batch in batches:
        step = max(1, min(TAKEN_ROWS, int(batch.num_rows * taken / max(1, batch.nbytes))))
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            yield list(zip(*[part.column(c).to_pylist() for c in columns], strict=True))


def give_back() -> None:
    """Return to the system what this worker has freed. Workers outlive their tasks, and the allocators
    would keep some hundred MB of each, which later stages lack."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``task``, after which its memory is given back."""

    @functools.wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        give_back()

    return run


def map_rows(
    df: DataFrame, make: Callable[[], Callable[..., Iterable[tuple]]], schema: str
) -> DataFrame:
    """Apply a row function to every row of ``df`` in Arrow batches.

    ``make`` is called once per task and returns the function, which gets the columns of ``df`` and
    yields output tuples; output leaves the task in bounded batches.
    """

    def make_many() -> Callable[[list[tuple]], Iterable[tuple]]:
        apply = make()
        return lambda rows: (made for row in rows for made in apply(*row))

    return map_rows_together(df, make_many, schema)


def map_rows_together(
    df: DataFrame, make: Callable[[], Callable[[list[tuple]], Iterable[tuple]]], schema: str, taken: int = TAKEN_BYTES
) -> DataFrame:
    """As ``map_rows`` for a function that gets a few hundred rows at once, some ``taken`` bytes."""
    columns = df.columns
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    @lean
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        out: list[tuple] = []
        chars = 0
        for rows in rows_of(batches, *columns, taken=taken):
            for made in apply(rows):
                out.append(made)
                chars += sum(len(v) for v in made if isinstance(v, (str, bytes)))
                if len(out) >= OUT_ROWS or chars >= OUT_CHARS:
                    yield batch_of(out, arrow)
                    out, chars = [], 0
        if out:
            yield batch_of(out, arrow)

    return df.mapInArrow(task, schema)


def map_carried(
    df: DataFrame,
    id_col: str,
    text_col: str,
    carry: tuple[str, ...],
    make: Callable[[], Callable[[list[str | None]], Iterable[tuple]]],
    schema: str,
    taken: int = TAKEN_BYTES,
) -> DataFrame:
    """Apply a function from texts to one tuple each; rows keep ``id_col`` and the ``carry`` columns,
    whatever their names, beside the columns of ``schema``."""
    columns = (id_col, *[c for c in carry if c != id_col])
    rows = df.select(F.struct(*[F.col(c) for c in columns]).alias("carried"), F.col(text_col).alias("text"))

    def make_many() -> Callable[[list[tuple]], Iterable[tuple]]:
        apply = make()

        def together(part: list[tuple]) -> Iterator[tuple]:
            for (carried, _), made in zip(part, apply([text for _, text in part]), strict=True):
                yield carried, *made

        return together

    kind = rows.schema["carried"].dataType.simpleString()
    made = T._parse_datatype_string(schema).names
    out = map_rows_together(rows, make_many, f"carried {kind}, {schema}", taken)
    return out.select(F.col(f"carried.{id_col}"), *made, *[F.col(f"carried.{c}") for c in columns[1:]])


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


@contextmanager
def tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the actions inside are removed as soon as each action ends."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stored(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """``df`` written once below the shared folder and read back, and its path. Later steps start
    from the files, so a lost executor costs no more than its own tasks."""
    spark = df.sparkSession
    path = scratch(spark, purpose)
    with tidy_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def map_arrays(
    df: DataFrame, make: Callable[[], Callable[[list[tuple]], Iterable[tuple]]], schema: str
) -> DataFrame:
    """As ``map_rows_together`` for a function that yields tuples of equally long numpy arrays."""
    columns = df.columns
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    @lean
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for rows in rows_of(batches, *columns):
            for made in apply(rows):
                for start in range(0, len(made[0]), OUT_ROWS):
                    parts = [pa.array(a[start : start + OUT_ROWS], f.type) for a, f in zip(made, arrow, strict=True)]
                    yield pa.RecordBatch.from_arrays(parts, schema=arrow)

    return df.mapInArrow(task, schema)


class WordHashes(dict):
    """64-bit hashes of words, each computed once per task while memory lasts."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        made = self[word] = xxhash.xxh3_64_intdigest(word)
        return made


class Runs:
    """Hashes of all runs of consecutive words of many texts, from prefix sums of a polynomial.

    Texts are laid end to end; ``first[i]`` is where text i begins, ``owner`` names a word's text.
    """

    BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

    def __init__(self, known: WordHashes, texts: list[list[bytes]]):
        counts = np.array([len(t) for t in texts], np.int64)
        self.total = int(counts.sum())
        self.first = np.concatenate(([0], np.cumsum(counts)))
        self.owner = np.repeat(np.arange(len(texts)), counts)
        words = itertools.chain.from_iterable(texts)
        self.hashes = np.fromiter(map(known.__getitem__, words), np.uint64, self.total)

    def of(self, length: int, which: int = 0) -> np.ndarray:
        """The hash of every run of ``length`` words, by its first word; runs over two texts included."""
        if self.total < length:
            return np.empty(0, np.uint64)
        base = self.BASES[which]
        up = _powers(base, self.total)
        down = _powers(pow(base, -1, 1 << 64), self.total)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.hashes * up, dtype=np.uint64)))
        starts = self.total - length + 1
        return mixed((sums[length:] - sums[:starts]) * down[:starts])

    def whole(self, length: int) -> np.ndarray:
        """Which runs of ``length`` words lie inside one text."""
        if self.total < length:
            return np.empty(0, bool)
        return self.owner[: self.total - length + 1] == self.owner[length - 1 :]


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Values spread over all 64 bits."""
    out = values ^ (values >> np.uint64(32))
    out = out * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def tagged(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Values made different for different owners."""
    return mixed(values + mixed(owner.astype(np.uint64) + np.uint64(1)))


def placed(df: DataFrame, order: list[Column], purpose: str) -> tuple[DataFrame, str]:
    """``df`` written in the order of all its rows, and its path: ``part`` numbers the ranges it was
    dealt into, ``nth`` the rows of a range, both upwards. A range is a share of the rows however
    often a key repeats, as long as ``order`` tells its rows apart."""
    lined = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    split = lined.withColumns({"part": F.shiftright("_at", 33), "nth": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    return stored(split.drop("_at"), purpose)


def before(rows: DataFrame, value: Column, name: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``placed`` with ``name``: the sum of ``value`` over all earlier rows of their keys.

    Running sums are taken inside a range; what precedes a range is one row for each range and key.
    """
    valued = rows.withColumn("_value", value)
    here = Window.partitionBy("part", *keys).orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    valued = valued.withColumn("_here", F.coalesce(F.sum("_value").over(here), F.lit(0)))
    sums = rows.groupBy("part", *keys).agg(F.sum(value).alias("_sum"))
    ahead = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_ahead", F.coalesce(F.sum("_sum").over(ahead), F.lit(0))).drop("_sum")
    both = valued.join(sums, ["part", *keys])
    return both.withColumn(name, F.col("_here") + F.col("_ahead")).drop("_value", "_here", "_ahead")
