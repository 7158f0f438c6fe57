"""Stored tables that change by key: a change writes the buckets of its keys, readers merge.

A table lies in hash buckets of some of its key columns. A change is a folder with the rows it adds
and the keys it takes away, both by bucket; it never touches what other folders hold. Every bucket
counts its own changes, so writers of different buckets do not meet and of two writers of one bucket
one fails. ``compact`` folds a bucket's changes into a new base.

Layout below the table's path:

- ``table.json``: key, buckets and schema as they were when the table was made;
- ``data/kind=rows|gone/change=<id>/bucket=<b>/seq=<n>``: what change n of a bucket adds and removes;
- ``_numbers/<b>.<n>``: who makes this file makes change n of bucket b;
- ``_log/<b>.<n>.<kind>.<id>``: change n of bucket b; ``_log/done.<id>`` makes a change, with all its
  buckets, visible at once.

A row is shown if no later change of its bucket took its key away. Lookups by key open only the
folders of the keys' buckets.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingloom.session import forget
from ratingloom.sources.versions import file_system, names_below

BASE, CHANGE = "base", "change"


class ConcurrentChange(RuntimeError):
    """Another writer changed, or is changing, a bucket of this change."""


class State(NamedTuple):
    """What the log says: per bucket the last number taken and the number its base has, and the
    changes that are done."""

    last: list[int]
    base: list[int]
    live: dict[str, dict[int, int]]
    open: set[int]


class KeyedTable:
    """A stored table whose rows are replaced and removed by ``key``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        made = json.loads(spark.read.text(f"{path}/table.json", wholetext=True).first()[0])
        self.key, self.by, self.buckets = tuple(made["key"]), tuple(made["by"]), made["buckets"]
        self.schema = T.StructType.fromJson(made["schema"])

    @classmethod
    def create(
        cls, table: DataFrame, path: str, key: Sequence[str], by: Sequence[str] | None = None, buckets: int = 64
    ) -> KeyedTable:
        """Store ``table`` in ``buckets`` buckets of the key columns ``by`` (all of ``key`` by default).
        Choose the buckets by the table's size: about one file of usual size each."""
        by = tuple(by or key)
        if not set(by) <= set(key) or not set(key) <= set(table.columns):
            raise ValueError("buckets are made of key columns, and the key of the table's columns")
        spark = table.sparkSession
        made = {"key": list(key), "by": list(by), "buckets": buckets, "schema": table.schema.jsonValue()}
        _create(spark, f"{path}/table.json", json.dumps(made))
        stored = cls(spark, path)
        stored._commit(table, None, list(range(buckets)), stored._state(), BASE)
        return stored

    # --- reading -------------------------------------------------------------------------------

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(c).cast(self.schema[c].dataType) for c in self.by]), F.lit(self.buckets)).cast("int")

    def _asked(self, keys: DataFrame) -> list[int]:
        """The bucket numbers of the given keys: at most ``buckets`` numbers, whatever the keys."""
        return sorted(row.b for row in keys.select(self.bucket().alias("b")).distinct().collect())

    def _state(self) -> State:
        names = names_below(self.spark, f"{self.path}/_log")
        done = {n.removeprefix("done.") for n in names if n.startswith("done.")}
        last, base = [-1] * self.buckets, [-1] * self.buckets
        live: dict[str, dict[int, int]] = {}
        open_: set[int] = set()
        for name in names:
            if not name.startswith("done."):
                bucket, number, kind, change = name.split(".")
                bucket, number = int(bucket), int(number)
                last[bucket] = max(last[bucket], number)
                if change not in done:
                    open_.add(bucket)
                    continue
                live.setdefault(change, {})[bucket] = number
                if kind == BASE:
                    base[bucket] = max(base[bucket], number)
        shown = {change: kept for change, at in live.items() if (kept := {b: n for b, n in at.items() if n >= base[b]})}
        return State(last, base, shown, open_)

    def _scan(self, kind: str, schema: T.StructType, state: State, buckets: list[int] | None) -> DataFrame:
        """The stored rows of a kind that no base has replaced; other buckets' folders stay closed."""
        wanted = None if buckets is None else set(buckets)
        changes = [c for c, at in sorted(state.live.items()) if wanted is None or wanted & set(at)]
        held = set(names_below(self.spark, f"{self.path}/data/kind={kind}"))
        folders = [f"{self.path}/data/kind={kind}/change={c}" for c in changes if f"change={c}" in held]
        full = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType()), T.StructField("seq", T.LongType())])
        if not folders:
            return self.spark.createDataFrame([], full)
        rows = self.spark.read.schema(full).option("basePath", f"{self.path}/data/kind={kind}").parquet(*folders)
        least = F.get(F.array(*[F.lit(n).cast("long") for n in state.base]), F.col("bucket"))
        rows = rows.where(F.col("seq") >= least)
        return (rows if wanted is None else rows.where(F.col("bucket").isin(buckets))).select(*full.names)

    def _merged(self, state: State, buckets: list[int] | None) -> DataFrame:
        rows = self._scan("rows", self.schema, state, buckets)
        gone_schema = T.StructType([self.schema[c] for c in self.key])
        gone = self._scan("gone", gone_schema, state, buckets)
        last = gone.groupBy("bucket", *self.key).agg(F.max("seq").alias("_gone"))
        same = [F.col(f"r.{c}").eqNullSafe(F.col(f"g.{c}")) for c in ("bucket", *self.key)]
        both = rows.alias("r").join(last.alias("g"), same, "left")
        return both.where("_gone is null or seq >= _gone").select(*[F.col(f"r.{c}").alias(c) for c in self.schema.names])

    def rows(self, keys: DataFrame | None = None) -> DataFrame:
        """The table, or its rows with the key columns of ``keys``: those that ``by`` names, and more
        of the key where ``keys`` has it."""
        state = self._state()
        if keys is None:
            return self._merged(state, None)
        on = [c for c in self.key if c in keys.columns]
        return self._merged(state, self._asked(keys)).join(keys.select(*on).distinct(), on, "left_semi")

    # --- changing ------------------------------------------------------------------------------

    def delete(self, keys: DataFrame) -> None:
        """Take the rows with the given keys away."""
        gone = keys.select(*[F.col(c).cast(self.schema[c].dataType).alias(c) for c in self.key]).distinct()
        self._commit(None, gone, self._asked(gone), self._state())

    def append(self, rows: DataFrame) -> None:
        """Add rows; those with their key stay."""
        rows = self._typed(rows)
        self._commit(rows, None, self._asked(rows), self._state())

    def upsert(self, updates: DataFrame, order: Column | str | None = None) -> None:
        """Replace all rows of every updated key by the update that is greatest by ``order``, or by its
        other columns."""
        rest = F.struct(*[c for c in self.schema.names if c not in self.key])
        newest = updates.groupBy(*self.key).agg(F.max_by(rest, rest if order is None else order).alias("_row"))
        rows = self._typed(newest.select(*self.key, "_row.*"))
        self._commit(rows, rows.select(*self.key), self._asked(updates), self._state())

    def insert_new(self, rows: DataFrame) -> None:
        """Add the rows whose keys the table does not hold; of equal new keys one row, the least."""
        state, rows = self._state(), self._typed(rows)
        asked = self._asked(rows)
        rest = F.struct(*[c for c in self.schema.names if c not in self.key])
        one = rows.groupBy(*self.key).agg(F.min(rest).alias("_row")).select(*self.key, "_row.*")
        fresh = one.join(self._merged(state, asked).select(*self.key).distinct(), list(self.key), "left_anti")
        self._commit(self._typed(fresh), None, asked, state)

    def compact(self, buckets: Sequence[int] | None = None) -> None:
        """Fold the changes of the given buckets, by default of all that have some, into new bases."""
        state = self._state()
        changed = {b for at in state.live.values() for b, n in at.items() if n > state.base[b]}
        chosen = sorted(changed if buckets is None else changed & set(buckets))
        if chosen:
            self._commit(self._merged(state, chosen), None, chosen, state, BASE)

    def drop_older(self) -> None:
        """Delete what bases have replaced and what writers left unfinished. Call it when no writer and
        no reader of an older state is left."""
        state = self._state()
        log = [n for n in names_below(self.spark, f"{self.path}/_log") if not n.startswith("done.")]
        old = []
        for name in log:
            bucket, number, _, change = name.split(".")
            if state.live.get(change, {}).get(int(bucket)) != int(number):
                old.append(f"{self.path}/_log/{name}")
                old += [f"{self.path}/data/kind={kind}/change={change}/bucket={bucket}" for kind in ("rows", "gone")]
        for kind in ("rows", "gone"):
            held = names_below(self.spark, f"{self.path}/data/kind={kind}")
            old += [f"{self.path}/data/kind={kind}/{n}" for n in held if n.startswith("change=") and n.removeprefix("change=") not in state.live]
        committed = [max((at[b] for at in state.live.values() if b in at), default=-1) for b in range(self.buckets)]
        for name in names_below(self.spark, f"{self.path}/_numbers"):
            bucket, number = map(int, name.split("."))
            if number != committed[bucket]:
                old.append(f"{self.path}/_numbers/{name}")
        names = names_below(self.spark, f"{self.path}/_log")
        old += [f"{self.path}/_log/{n}" for n in names if n.startswith("done.") and n.removeprefix("done.") not in state.live]
        forget(self.spark, *old)

    def _typed(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])

    def _commit(self, rows: DataFrame | None, gone: DataFrame | None, buckets: list[int], state: State, kind: str = CHANGE) -> None:
        """Write rows and keys as the next change of ``buckets``, each counted on from ``state``."""
        if not buckets:
            return
        if state.open & set(buckets):
            raise ConcurrentChange(f"a change of buckets {sorted(state.open & set(buckets))} of {self.path} is not finished")
        change, taken = f"c{uuid.uuid4().hex}", []
        try:
            numbers = F.array(*[F.lit(n + 1).cast("long") for n in state.last])
            for name, part in (("rows", rows), ("gone", gone)):
                if part is not None:
                    dealt = part.withColumn("bucket", self.bucket()).withColumn("seq", F.get(numbers, F.col("bucket")))
                    # Ranges over the key spread a bucket, or a key, with very many rows over tasks.
                    order = ["bucket", *self.key]
                    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order)
                    dealt.write.partitionBy("bucket", "seq").parquet(f"{self.path}/data/kind={name}/change={change}")
            for bucket in sorted(buckets):
                entry = f"{self.path}/_log/{bucket}.{state.last[bucket] + 1}"
                # The number is taken under one name, whoever writes it and whatever it holds.
                _create(self.spark, f"{self.path}/_numbers/{bucket}.{state.last[bucket] + 1}")
                taken.append(f"{self.path}/_numbers/{bucket}.{state.last[bucket] + 1}")
                _create(self.spark, f"{entry}.{kind}.{change}")
                taken.append(f"{entry}.{kind}.{change}")
            _create(self.spark, f"{self.path}/_log/done.{change}")
        except BaseException as error:
            forget(self.spark, *taken[::-1], *[f"{self.path}/data/kind={k}/change={change}" for k in ("rows", "gone")])
            if isinstance(error, FileExistsError):
                raise ConcurrentChange(f"buckets of {self.path} were changed by another writer") from error
            raise


def _create(spark: SparkSession, path: str, text: str = "") -> None:
    """A new file; one that exists is an error."""
    fs, target = file_system(spark, path)
    try:
        out = fs.create(target, False)
    except Py4JJavaError as error:
        if fs.exists(target):
            raise FileExistsError(path) from error
        raise
    if text:
        out.write(bytearray(text.encode()))
    out.close()
