"""Vector codes by product quantisation: Lloyd's rounds over integers, with a tree on both sides.

Vectors are cut into equal parts; each part position has a codebook. Components become integers
first, so every sum and distance is exact and a rerun gives the same codebooks.

1. **Trees of parts.** Rows of a scan batch form blocks. For each part position of a block a tree
   halves the parts along their widest component; nodes keep their box, and the sum of their parts.
   Trees are written once and read by every round.
2. **Trees of entries.** The entries of a codebook, at most ``entries``, form a tree of the same kind.
3. **Rounds.** Both trees are gone down together. The largest distance between two boxes bounds how
   far an entry may lie from any part of a node; pairs of nodes whose smallest distance is above the
   least such bound are dropped. A node of parts that is left with one entry is assigned as a whole,
   by its cached sum; parts of leaves that keep several entries are compared one by one in integers.
   Bounds drop only what is strictly farther, so ties still go to the lower index.

A task sends one row of sums per entry; the codebooks, ``entries`` vectors whatever the data, go to
the driver and back between rounds. No vector is shuffled.

Defined cases: rows whose vector is null or holds null or non-finite components are dropped; vectors
of other lengths, or whose length the parts do not divide, are an error, as are components beyond
2**26 in integers, whose squares could pass a long; repeated rows and equal ids count each; rows
without an id come last in the choice of first entries; fewer rows than entries make shorter
codebooks; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import sha256, stored
from ratingloom.session import forget

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Rows of a block, and parts of a tree's leaf.
BLOCK, LEAF = 4096, 16
#: Levels that every node of parts is cut to before bounds that drop little stop it.
COARSE = 3
LARGEST = 1 << 26


class Tree:
    """A balanced tree over points, in heap order: node i has the children 2i + 1 and 2i + 2.

    ``order`` lists the points by leaf; node i holds ``order[start[i]:stop[i]]``, its box is
    ``low[i]`` .. ``high[i]``, ``sums[i]`` the sum of its points.
    """

    def __init__(self, points: np.ndarray, leaf: int, known: tuple | None = None):
        self.points, self.leaf = points, leaf
        self.levels = max(0, (len(points) // leaf).bit_length() - 1)
        self.first_leaf = (1 << self.levels) - 1
        self.start, self.stop = self._ranges()
        self.order, self.low, self.high, self.sums = known or self._built()

    def _ranges(self) -> tuple[np.ndarray, np.ndarray]:
        start, stop = [np.zeros(1, np.int64)], [np.array([len(self.points)])]
        for _ in range(self.levels):
            middle = (start[-1] + stop[-1]) // 2
            start, stop = [*start, np.stack((start[-1], middle), 1).ravel()], [*stop, np.stack((middle, stop[-1]), 1).ravel()]
        return np.concatenate(start), np.concatenate(stop)

    def _built(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        order = np.arange(len(self.points))
        for node in range(self.first_leaf):
            here = slice(self.start[node], self.stop[node])
            mine = self.points[order[here]]
            widest = int(np.argmax(mine.max(0) - mine.min(0)))
            order[here] = order[here][np.argpartition(mine[:, widest], self.start[2 * node + 2] - self.start[node])]
        laid, cuts = self.points[order], self.start[self.first_leaf :]
        levels = [[f.reduceat(laid, cuts, axis=0) for f in (np.minimum, np.maximum, np.add)]]
        while len(levels[-1][0]) > 1:
            levels.append([f(x[::2], x[1::2]) for f, x in zip((np.minimum, np.maximum, np.add), levels[-1], strict=True)])
        return (order, *(np.concatenate(column) for column in zip(*levels[::-1], strict=True)))


def _reach(q_low: np.ndarray, q_high: np.ndarray, r_low: np.ndarray, r_high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest squared distance between boxes, pair by pair."""
    gap = np.maximum(0, np.maximum(r_low - q_high, q_low - r_high))
    span = np.maximum(r_high - q_low, q_high - r_low)
    return (gap * gap).sum(1), (span * span).sum(1)


def _descend(parts: Tree, book: Tree) -> tuple[np.ndarray, np.ndarray]:
    """(node of parts, entry): the entries that may be nearest to some part of the node. A node is a
    leaf, has one entry left, or keeps most entries; every part lies in one node."""
    q, r = np.zeros(1, np.int64), np.zeros(1, np.int64)
    low, high, first, level, there = book.low, book.high, book.first_leaf, 0, 1
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while True:
        least, most = _reach(parts.low[q], parts.high[q], low[r], high[r])
        bound = np.full(len(parts.low), np.iinfo(np.int64).max)
        np.minimum.at(bound, q, most)
        near = least <= bound[q]
        q, r = q[near], r[near]
        left = np.bincount(q, minlength=len(parts.low))[q]
        # A node that keeps most of what is there is not cut finer: that would cost more than it drops.
        stays = (q >= parts.first_leaf) | ((left > there // 2) & (level >= COARSE))
        if first < 0:
            finished = stays | (left == 1)
            done.append((q[finished], r[finished]))
            q, r = q[~finished], r[~finished]
            if not len(q):
                return tuple(np.concatenate(x) for x in zip(*done, strict=True))
            q, r = np.concatenate((2 * q + 1, 2 * q + 2)), np.concatenate((r, r))
        elif (r >= first).all():
            # Below its leaves the tree of entries has the entries themselves.
            count = book.stop[r] - book.start[r]
            at = np.repeat(book.start[r], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            q, r = np.repeat(q, count), book.order[at]
            low, high, first, there = book.points, book.points, -1, len(book.points)
        else:
            q, r, stays = np.repeat(q, 2), np.stack((2 * r + 1, 2 * r + 2), 1).ravel(), np.repeat(stays, 2)
            level, there, down = level + 1, 2 * there, ~stays
            q, r = np.concatenate((q[stays], 2 * q[down] + 1, 2 * q[down] + 2)), np.concatenate((r[stays], r[down], r[down]))


def _exact(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs, up to what does not depend on the entry. Products are taken in
    doubles only where every sum of them is an integer that a double holds."""
    top = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    kind = np.float64 if 4 * points.shape[1] * top * top < 1 << 53 else np.int64
    e = entries.astype(kind)
    return (e * e).sum(1) - 2 * (points.astype(kind) @ e.T)


def assign(parts: Tree, book: Tree, whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry of every part, counts and sums by entry); without ``whole`` the parts of nodes that are
    assigned as a whole have no entry of their own (-1)."""
    entry = np.full(len(parts.points), -1)
    counts = np.zeros(len(book.points), np.int64)
    sums = np.zeros_like(book.points)
    q, r = _descend(parts, book)
    turn = np.lexsort((r, q))
    q, r = q[turn], r[turn]
    starts = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(q))
    alone = starts[ends - starts == 1]
    np.add.at(counts, r[alone], (parts.stop - parts.start)[q[alone]])
    np.add.at(sums, r[alone], parts.sums[q[alone]])
    if whole:
        for at in alone.tolist():
            entry[parts.order[parts.start[q[at]] : parts.stop[q[at]]]] = r[at]
    unsure = []
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        if b - a > 1:
            mine = parts.order[parts.start[q[a]] : parts.stop[q[a]]]
            entry[mine] = r[a:b][_exact(parts.points[mine], book.points[r[a:b]]).argmin(1)]
            unsure.append(mine)
    if unsure:
        mine = np.concatenate(unsure)
        counts += np.bincount(entry[mine], minlength=len(counts))
        np.add.at(sums, entry[mine], parts.points[mine])
    return entry, counts, sums


_TREES = "rows array<{row}>, points binary, trees array<struct<order_: binary, low: binary, high: binary, sums: binary>>"


def _vectors(column: pa.ListArray, parts: int) -> np.ndarray:
    sizes = column.value_lengths().to_numpy()
    out = column.flatten().to_numpy()
    if len(set(sizes.tolist())) > 1 or sizes[0] % parts or not sizes[0]:
        raise ValueError(f"vectors need one length that is a multiple of {parts}, not {sorted(set(sizes.tolist()))[:5]}")
    if np.abs(out).max(initial=0) > LARGEST:
        raise ValueError(f"components beyond {LARGEST} have no exact distances")
    return out.reshape(len(sizes), -1)


def _planted(parts: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                block = batch.slice(at, BLOCK)
                vectors = _vectors(block.column("vector"), parts)
                trees = [Tree(part, LEAF) for part in np.split(vectors, parts, axis=1)]
                made = [
                    {"order_": t.order.astype(np.int32).tobytes(), "low": t.low.tobytes(), "high": t.high.tobytes(), "sums": t.sums.tobytes()}
                    for t in trees
                ]
                rows = pa.ListArray.from_arrays(pa.array([0, block.num_rows], pa.int32()), block.column("row"))
                kind = pa.list_(pa.struct([(n, pa.binary()) for n in ("order_", "low", "high", "sums")]))
                packed = pa.array([vectors.astype(np.int32).tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([rows, packed, pa.array([made], kind)], names=["rows", "points", "trees"])

    return task


def _grown(points: bytes, trees: list[dict], books: list[Tree]) -> Iterator[tuple[Tree, Tree]]:
    width = books[0].points.shape[1]
    flat = np.frombuffer(points, np.int32).reshape(-1, width * len(books)).astype(np.int64)
    for part, tree, book in zip(np.split(flat, len(books), axis=1), trees, books, strict=True):
        boxes = [np.frombuffer(tree[n], np.int64).reshape(-1, width) for n in ("low", "high", "sums")]
        yield Tree(part, LEAF, (np.frombuffer(tree["order_"], np.int32), *boxes)), book


def _summed(codebooks: list[np.ndarray]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Tree(c, 1) for c in codebooks]
        counts = [np.zeros(len(c), np.int64) for c in codebooks]
        sums = [np.zeros_like(c) for c in codebooks]
        for batch in batches:
            for points, trees in zip(batch.column("points"), batch.column("trees"), strict=True):
                for i, (tree, book) in enumerate(_grown(points.as_py(), trees.as_py(), books)):
                    _, n, total = assign(tree, book, False)
                    counts[i] += n
                    sums[i] += total
        rows = [(i, e, int(counts[i][e]), sums[i][e].tolist()) for i in range(len(books)) for e in np.flatnonzero(counts[i]).tolist()]
        if rows:
            part, entry, n, total = zip(*rows, strict=True)
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
            columns = [pa.array(c, k) for c, k in zip((part, entry, n, total), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", "sums"])

    return task


def _coded(codebooks: list[np.ndarray]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Tree(c, 1) for c in codebooks]
        for batch in batches:
            for rows, points, trees in zip(*[batch.column(c) for c in ("rows", "points", "trees")], strict=True):
                codes, error = [], 0
                for tree, book in _grown(points.as_py(), trees.as_py(), books):
                    entry, _, _ = assign(tree, book, True)
                    gap = tree.points - book.points[entry]
                    codes.append(entry)
                    error = error + (gap * gap).sum(1)
                flat = np.stack(codes, 1)
                offsets = pa.array(np.arange(0, flat.size + 1, flat.shape[1]), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(flat.ravel(), pa.int32()))
                yield pa.RecordBatch.from_arrays([rows.values, lists, pa.array(error, pa.int64())], names=["row", "codes", "error"])

    return task


def _moved(codebooks: list[np.ndarray], rows: list) -> list[np.ndarray]:
    """Every used entry at the floored mean of its parts."""
    out = [c.copy() for c in codebooks]
    for row in rows:
        out[row.part][row.entry] = [int(total) // row.n for total in row[3:]]
    return out


def compress(
    df: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    vector_col: str = "embedding",
    id_col: str = "vec_id",
    carry: tuple[str, ...] = (),
) -> tuple[DataFrame, list[np.ndarray]]:
    """(id_col, codes array<int>, error, carried columns) of every kept row, and the codebooks.

    ``error`` is the summed squared distance of a row's parts from their entries.
    """
    spark = df.sparkSession
    columns = (id_col, *[c for c in carry if c != id_col])
    usable = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform(vector_col, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    kept = df.where(usable).select(F.struct(*columns).alias("row"), whole.alias("vector"))
    first = kept.orderBy(F.col(f"row.{id_col}").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    kind = kept.schema["row"].dataType.simpleString()
    trees, _ = stored(kept.mapInArrow(_planted(parts), _TREES.format(row=kind)), "trees")
    if not first:
        return df.where(F.lit(False)).select(id_col, F.array().cast("array<int>").alias("codes"), F.lit(0).cast("long").alias("error"), *columns[1:]), []
    codebooks = np.split(np.array([r.vector for r in first], np.int64), parts, axis=1)
    width = codebooks[0].shape[1]
    for _ in range(rounds):
        sums = trees.select("points", "trees").mapInArrow(_summed(codebooks), "part int, entry int, n bigint, sums array<bigint>")
        # One row per entry, whatever the size of the table.
        totals = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]) for i in range(width)])
        codebooks = _moved(codebooks, totals.collect())
    coded = trees.mapInArrow(_coded(codebooks), f"row {kind}, codes array<int>, error bigint")
    return coded.select(F.col(f"row.{id_col}"), "codes", "error", *[F.col(f"row.{c}") for c in columns[1:]]), codebooks


def labelled_codes(df: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id", label_col: str = "label", **options: int) -> DataFrame:
    """(id_col, code, error, label_error, codebooks_sha256): codes as two hex digits a part, the error
    summed over the rows of a label, and a digest of all entries."""
    coded, codebooks = compress(df, vector_col=vector_col, id_col=id_col, carry=(label_col,), **options)
    rows, _ = stored(coded.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), "codes", "error"), "codes")
    # Written, so that the join below knows its size.
    sums, _ = stored(rows.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    both = rows.join(sums.withColumnRenamed("label", "_label"), F.col("label").eqNullSafe(F.col("_label")))
    digest = sha256(",".join(str(x) for book in codebooks for x in book.ravel().tolist()).encode())
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return both.select(F.col("id").alias(id_col), code.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
