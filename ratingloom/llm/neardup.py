"""Near duplicates by DartMinHash signatures, banded joins, exact checks and components.

Equal texts become one representative first, with a number of its own: signatures, bands, links and
checks go by that number, and document ids come in at the end, so each text of an id is compared.

**Signatures.** Every shingle of a document is a region: its weight wide and endless in rank. Darts,
drawn from hashes alone, fall into all regions as a Poisson process; a document throws only as many
as fill its ``K`` coordinates, about K log K whatever its length. Each dart belongs to a coordinate,
and the one of lowest rank is kept. Two documents agree in a coordinate with the probability of
their weighted Jaccard similarity.

**Links.** Representatives that agree in a band are compared with their bucket's smallest member;
what signatures do not rule out is checked on whole texts. Components of these links leave few open
cases: members of a bucket that are not in its smallest member's component. They are compared by
signature with the bucket's other components in blocks of bounded size, and a block names no pairs:
each row with an open case points to the smallest row it hangs together with. Rows that hang together
over all buckets form a group, and every open case lies in one group. The texts of a group meet in
blocks of bounded rows and bytes, where cases are decided on whole texts and links that join two
components leave, fewer than the block has rows. Links inside a component change nothing, so no pair
that could join two classes is left out, and a group's pairs are never written out.

**Skew.** Buckets are aggregated in the map tasks; a large bucket is joined back by rows that
adaptive execution can split, and compared in blocks. All intermediate rows are written below the
shared folder.

Defined cases: texts without words are near duplicates only of equal texts; a null text is in a class of its own; texts of fewer
words than a shingle are one shingle; the length of a text is not bounded; rows with one id are one document; a row without an id has no
class.
"""

from __future__ import annotations

import functools
import itertools
import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import Runs, WordHashes, lean, map_rows, map_rows_together, mixed, space_words, stored
from ratingloom.session import forget

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE, SIMILARITY = 5, 0.8
#: 25 bands of 5 coordinates: a pair of similarity 0.8 shares none with probability 5e-5.
BANDS, BAND = 25, 5
#: The bands' coordinates and more, which narrow what signatures leave open.
K = 400
#: Signatures rule a pair out below the similarity by this many standard deviations: at 0.8 one pair
#: of it in 90,000, fewer than share no band.
DEVIATIONS = 4.5
#: Rows of one side of a block, and the bytes of their texts.
BLOCK, BLOCK_BYTES = 1024, 32 << 20
WEIGHTS = ("set", "counts")

_STEP = 0x9E3779B97F4A7C15
_COORD, _VALUE, _PLACE = (np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))
_UNIT = 2.0**-53


def _uniform(hashes: np.ndarray) -> np.ndarray:
    return ((hashes >> np.uint64(11)).astype(np.float64) + 0.5) * _UNIT


def dart_signatures(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, count: int, k: int = K) -> np.ndarray:
    """(count, k) ids of the kept darts. ``elements`` are 64-bit hashes, each once per owner, with a
    positive weight; ``owner`` says whose they are. Owners without elements get zeros."""
    cells = np.ceil(weights).astype(np.int64)
    at = np.repeat(np.arange(len(elements)), cells)
    cell = np.arange(len(at)) - np.repeat(np.cumsum(cells) - cells, cells)
    width = np.minimum(1.0, weights[at] - cell)
    seeds = mixed(elements[at] + mixed(cell.astype(np.uint64) + np.uint64(1)))
    who = owner[at]
    total = np.bincount(owner, weights, minlength=count)
    reach = np.divide(k * (math.log(k) + 3), total, out=np.zeros(count), where=total > 0)
    out = np.zeros((count, k), np.uint64)
    todo = total > 0
    while todo.any():
        mine = todo[who]
        best, value = _throw(seeds[mine], width[mine], who[mine], reach, count, k)
        full = np.isfinite(best).all(axis=1) & todo
        out[full] = value[full]
        todo &= ~full
        reach = np.where(todo, 2 * reach, reach)
    return out


def _throw(seeds: np.ndarray, width: np.ndarray, who: np.ndarray, reach: np.ndarray, count: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Lowest rank and dart per coordinate of all darts with a rank below the owner's reach."""
    best = np.full(count * k, np.inf)
    value = np.zeros(count * k, np.uint64)
    rank = np.zeros(len(seeds))
    turn = 0
    while len(seeds):
        dart = mixed(seeds + np.uint64(_STEP * (turn + 1) % 2**64))
        rank = rank - np.log(_uniform(dart))
        near = rank < reach[who]
        seeds, width, who, rank, dart = seeds[near], width[near], who[near], rank[near], dart[near]
        hit = _uniform(mixed(dart ^ _PLACE)) < width
        slot = who[hit] * k + (mixed(dart[hit] ^ _COORD) % np.uint64(k)).astype(np.int64)
        np.minimum.at(best, slot, rank[hit])
        won = best[slot] == rank[hit]
        value[slot[won]] = mixed(dart[hit][won] ^ _VALUE)
        turn += 1
    return best.reshape(count, k), value.reshape(count, k)


def shingle_elements(known: WordHashes, texts: list[list[bytes]], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, count, owner) of the distinct shingles of every text."""
    runs = Runs(known, texts)
    whole = np.flatnonzero(runs.whole(size))
    hashes, owner = runs.of(size)[whole], runs.owner[whole]
    short = [i for i, words in enumerate(texts) if 0 < len(words) < size]
    few = np.array([xxhash.xxh3_64_intdigest(b" ".join(texts[i])) for i in short], np.uint64)
    hashes, owner = np.concatenate((hashes, few)), np.concatenate((owner, np.array(short, np.int64)))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    return hashes[first], np.diff(np.append(first, len(hashes))), owner[first]


def _signature_rows(size: int, weights: str) -> Callable[[list[tuple]], Iterator[tuple]]:
    known = WordHashes()

    def apply(rows: list[tuple]) -> Iterator[tuple]:
        hashes, counts, owner = shingle_elements(known, [space_words(text) for _, _, text in rows], size)
        weight = counts.astype(float) if weights == "counts" else np.ones(len(counts))
        signatures = dart_signatures(hashes, weight, owner, len(rows))
        filled = np.bincount(owner, minlength=len(rows)) > 0
        numbers = np.arange(BANDS, dtype=np.uint64)
        banded = signatures[:, : BANDS * BAND].reshape(len(rows), BANDS, BAND)
        bands = np.broadcast_to(mixed(numbers + np.uint64(1)), (len(rows), BANDS))
        for i in range(BAND):
            bands = mixed(bands ^ banded[:, :, i])
        bands = bands.view(np.int64)
        small = (signatures & np.uint64(255)).astype(np.uint8)
        for i, (key, said, text) in enumerate(rows):
            digest = xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass")) if text is not None else None
            has = bool(filled[i])
            yield key, said, digest, bands[i].tolist() if has else [], small[i].tobytes() if has else b""

    return apply


def signatures(df: DataFrame, size: int = SHINGLE, weights: str = "set") -> DataFrame:
    """(doc_id, said, digest, bands, signature) of (doc_id, said, text)."""
    return map_rows_together(
        df.select("doc_id", "said", "text"),
        functools.partial(_signature_rows, size, weights),
        "doc_id bigint, said bigint, digest binary, bands array<bigint>, signature binary",
    )


def _agreement(left: list[bytes], right: list[bytes]) -> np.ndarray:
    a = np.frombuffer(b"".join(left), np.uint8).reshape(-1, K)
    b = np.frombuffer(b"".join(right), np.uint8).reshape(-1, K)
    return (a == b).mean(axis=1)


def _floor(similarity: float) -> float:
    return similarity - DEVIATIONS * math.sqrt(similarity * (1 - similarity) / K)


def _likely_rows(floor: float) -> Callable[[list[tuple]], Iterator[tuple]]:
    def apply(rows: list[tuple]) -> Iterator[tuple]:
        near = _agreement([r[2] for r in rows], [r[3] for r in rows]) >= floor
        yield from ((a, b) for (a, b, _, _), keep in zip(rows, near.tolist(), strict=True) if keep)

    return apply


def likely(pairs: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose signatures do not rule the similarity out."""
    both = pairs.join(sketches.selectExpr("doc_id as a", "signature as left_"), "a").join(
        sketches.selectExpr("doc_id as b", "signature as right_"), "b"
    )
    return map_rows_together(both.select("a", "b", "left_", "right_"), functools.partial(_likely_rows, _floor(similarity)), "a bigint, b bigint")


def weighted_jaccard(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two (distinct elements, weights); 0 where both are empty."""
    _, at, to = np.intersect1d(left[0], right[0], assume_unique=True, return_indices=True)
    shared = float(np.minimum(left[1][at], right[1][to]).sum())
    total = float(left[1].sum() + right[1].sum()) - shared
    return shared / total if total else 0.0


def _checked_rows(size: int, weights: str, similarity: float) -> Callable[..., Iterator[tuple]]:
    known = WordHashes()
    last: dict[int, tuple] = {}

    def elements(key: int, text: str) -> tuple[np.ndarray, np.ndarray]:
        if key not in last:
            if len(last) >= 64:
                last.clear()
            hashes, counts, _ = shingle_elements(known, [space_words(text)], size)
            last[key] = (hashes, counts if weights == "counts" else np.ones(len(counts)))
        return last[key]

    def apply(a: int, left: str, b: int, right: str) -> Iterator[tuple]:
        if weighted_jaccard(elements(a, left), elements(b, right)) >= similarity:
            yield a, b

    return apply


def checked(pairs: DataFrame, names: DataFrame, texts: DataFrame, size: int, weights: str, similarity: float) -> DataFrame:
    """The pairs of numbers whose whole texts are similar enough; ``names`` has (number, doc_id, said)."""
    both = pairs
    for side in ("a", "b"):
        both = both.join(names.selectExpr(f"number as {side}", f"doc_id as {side}_id", f"said as {side}_said"), side)
    for side, text in (("a", "left_"), ("b", "right_")):
        at = [f"{side}_id", f"{side}_said"]
        both = both.join(texts.selectExpr(f"doc_id as {at[0]}", f"said as {at[1]}", f"text as {text}"), at)
    return map_rows(both.select("a", "left_", "b", "right_"), functools.partial(_checked_rows, size, weights, similarity), "a bigint, b bigint")


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(doc_id, class_id): the smallest id every linked id is connected with. Each round takes the
    smallest label of the neighbours and then the label's own label; it ends when nothing changes."""
    spark = links.sparkSession
    both = links.select("a", "b").union(links.selectExpr("b as a", "a as b")).distinct()
    edges, edges_path = stored(both, "edges")
    labels, path = stored(edges.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a as doc_id", "least(a, m) as class_id"), "labels")
    for _ in range(max_rounds):
        theirs = edges.join(labels.selectExpr("doc_id as b", "class_id"), "b").groupBy("a").agg(F.min("class_id").alias("m"))
        lower = labels.join(theirs.withColumnRenamed("a", "doc_id"), "doc_id").selectExpr("doc_id", "class_id as old", "least(class_id, m) as near")
        above = labels.selectExpr("doc_id as near", "class_id as far")
        jumped = lower.join(above, "near").selectExpr("doc_id", "old", "least(near, far) as class_id")
        jumped, new_path = stored(jumped, "labels")
        changed = jumped.where("old <> class_id").limit(1).count()
        forget(spark, path)
        labels, path = jumped.select("doc_id", "class_id"), new_path
        if not changed:
            break
    else:
        raise RuntimeError("components did not settle")
    forget(spark, edges_path)
    return labels


def _blocks_of(columns: tuple[str, ...], key: slice, decide: Callable[[list[tuple], list[tuple]], list[tuple[int, int]]]) -> Callable:
    """A task that hands the queries and the members of each block to ``decide``. Rows come sorted by
    the ``key`` columns, so a block is complete when the next begins; the last column marks queries."""

    @lean
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*[batch.column(c).to_pylist() for c in columns], strict=True))
        for _, block in itertools.groupby(rows, key=lambda r: r[key]):
            asked, there = [], []
            for row in block:
                (asked if row[-1] else there).append(row)
            found = decide(asked, there) if asked and there else []
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return task


def _matrix(rows: list[tuple], at: int) -> np.ndarray:
    return np.frombuffer(b"".join(r[at] for r in rows), np.uint8).reshape(-1, K)


def _lowest_reachable(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Per node the smallest node that edges connect it with."""
    low = np.arange(count)
    while True:
        new = low.copy()
        np.minimum.at(new, left, low[right])
        np.minimum.at(new, right, low[left])
        new = new[new]
        if (new == low).all():
            return low
        low = new


OPEN = ("band", "asks", "holds", "doc_id", "class_id", "signature", "query")


def _hanging_rows(floor: float) -> Callable[[list[tuple], list[tuple]], list[tuple[int, int]]]:
    """Rows of open cases with the smallest row they hang together with: a row per row of the block at
    most, however many cases there are."""

    def decide(asked: list[tuple], there: list[tuple]) -> list[tuple[int, int]]:
        a, b = _matrix(asked, 5), _matrix(there, 5)
        b_class = np.array([r[4] for r in there])
        names = np.array([r[3] for r in asked + there])
        ids, number = np.unique(names, return_inverse=True)
        left, right = [], []
        for i, row in enumerate(asked):
            open_ = np.flatnonzero(b_class != row[4])
            open_ = open_[(b[open_] == a[i]).mean(axis=1) >= floor]
            left.append(np.full(len(open_), number[i]))
            right.append(number[len(asked) + open_])
        left, right = np.concatenate(left), np.concatenate(right)
        low = _lowest_reachable(len(ids), left, right)
        used = np.unique(np.concatenate((left, right)))
        return list(zip(ids[low[used]].tolist(), ids[used].tolist(), strict=True))

    return decide


def _dealt(rows: DataFrame, key: tuple[str, ...], out: tuple[str, ...]) -> DataFrame:
    """Queries and members of every key, dealt into blocks of the ``n_asks`` and ``n_holds`` parts of the
    two sides; queries are members too."""
    spread = F.xxhash64("doc_id")
    asks = rows.where("query").withColumn("asks", F.pmod(spread, F.col("n_asks")).cast("int"))
    asks = asks.withColumn("holds", F.explode(F.sequence(F.lit(0), F.col("n_holds") - 1))).select(*out)
    holds = rows.withColumn("holds", F.pmod(spread, F.col("n_holds")).cast("int")).withColumn("query", F.lit(False))
    holds = holds.withColumn("asks", F.explode(F.sequence(F.lit(0), F.col("n_asks") - 1))).select(*out)
    return asks.unionByName(holds).repartition(*key, "asks", "holds").sortWithinPartitions(*key, "asks", "holds")


def _hanging(banded: DataFrame, buckets: DataFrame, labels: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """(a, b): rows of a bucket with open cases, and the smallest row each hangs together with. A case
    is a pair in different components that signatures do not rule out, where one end is not in the
    component of the bucket's smallest member."""
    crowded = buckets.where("members > 2")
    named = banded.join(crowded, "band").join(labels, "doc_id", "left").withColumn("class_id", F.coalesce("class_id", "doc_id"))
    centres = labels.selectExpr("doc_id as centre", "class_id as centre_class")
    named = named.join(centres, "centre", "left").withColumn("query", F.col("class_id") != F.coalesce("centre_class", "centre"))
    asked = named.where("query").groupBy("band").agg(F.count("*").alias("n_asked"))
    rows = named.join(asked, "band").join(sketches.select("doc_id", "signature"), "doc_id")
    rows = rows.withColumns({"n_asks": F.ceil(F.col("n_asked") / BLOCK).cast("int"), "n_holds": F.ceil(F.col("members") / BLOCK).cast("int")})
    blocks = _dealt(rows, ("band",), OPEN)
    return blocks.mapInArrow(_blocks_of(OPEN, slice(0, 3), _hanging_rows(_floor(similarity))), "a bigint, b bigint").distinct()


GROUPED = ("group", "asks", "holds", "doc_id", "class_id", "signature", "text", "asking", "query")


def _joining_rows(size: int, weights: str, similarity: float) -> Callable[[list[tuple], list[tuple]], list[tuple[int, int]]]:
    """The links of a block that join two components, found on whole texts."""
    known = WordHashes()
    least = _floor(similarity)

    def shingled(rows: list[tuple]) -> list[tuple[np.ndarray, np.ndarray]]:
        hashes, counts, owner = shingle_elements(known, [space_words(r[6]) for r in rows], size)
        cuts = np.searchsorted(owner, np.arange(1, len(rows)))
        counts = counts if weights == "counts" else np.ones(len(counts))
        return list(zip(np.split(hashes, cuts), np.split(counts, cuts), strict=True))

    def decide(asked: list[tuple], there: list[tuple]) -> list[tuple[int, int]]:
        rows = asked + there
        matrix, elements = _matrix(rows, 5), shingled(rows)
        # Components of the block: as they were, and joined as links are found.
        component = np.unique([r[4] for r in rows], return_inverse=True)[1]
        b_id, b_asks = np.array([r[3] for r in there]), np.array([r[7] for r in there])
        found = []
        for i, row in enumerate(asked):
            # Of two queries the one of smaller number asks.
            near = len(asked) + np.flatnonzero((component[len(asked) :] != component[i]) & ~(b_asks & (b_id < row[3])))
            near = near[(matrix[near] == matrix[i]).mean(axis=1) >= least]
            while len(near):
                j, near = near[0], near[1:]
                if weighted_jaccard(elements[i], elements[j]) >= similarity:
                    found.append((min(row[3], rows[j][3]), max(row[3], rows[j][3])))
                    component[component == component[j]] = component[i]
                    near = near[component[near] != component[i]]
        return found

    return decide


def _joining(groups: DataFrame, labels: DataFrame, sketches: DataFrame, names: DataFrame, texts: DataFrame, size: int, weights: str, similarity: float) -> tuple[DataFrame, str]:
    """Links (a, b) inside the groups of rows that hang together, and their path; ``groups`` has
    (doc_id, class_id)."""
    members = groups.withColumnRenamed("class_id", "group").join(labels, "doc_id", "left").withColumn("class_id", F.coalesce("class_id", "doc_id"))
    members = members.join(names.selectExpr("number as doc_id", "doc_id as id_", "said"), "doc_id")
    members = members.join(texts.selectExpr("doc_id as id_", "said", "text"), ["id_", "said"]).dropDuplicates(["doc_id"])
    members = members.join(sketches.select("doc_id", "signature"), "doc_id").select("group", "doc_id", "class_id", "signature", "text")
    members, path = stored(members, "groups")
    # Rows of a group's largest component ask nothing: each case has an end outside.
    sized = members.groupBy("group", "class_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    sized = sized.groupBy("group").agg(
        F.sum("n").alias("rows"), F.sum("bytes").alias("bytes"), F.max(F.struct("n", "class_id", "bytes")).alias("largest")
    )
    parts = lambda n, size_: F.greatest(F.lit(1), F.ceil(n / BLOCK), F.ceil(size_ / BLOCK_BYTES)).cast("int")
    sized = sized.where("rows > largest.n").select(
        "group",
        F.col("largest.class_id").alias("largest"),
        parts(F.col("rows") - F.col("largest.n"), F.col("bytes") - F.col("largest.bytes")).alias("n_asks"),
        parts(F.col("rows"), F.col("bytes")).alias("n_holds"),
    )
    rows = members.join(sized, "group").withColumn("query", F.col("class_id") != F.col("largest")).withColumn("asking", F.col("query"))
    blocks = _dealt(rows, ("group",), GROUPED)
    links, links_path = stored(blocks.mapInArrow(_blocks_of(GROUPED, slice(0, 3), _joining_rows(size, weights, similarity)), "a bigint, b bigint"), "links")
    forget(members.sparkSession, path)
    return links, links_path


def near_duplicate_classes(
    df: DataFrame,
    size: int = SHINGLE,
    similarity: float = SIMILARITY,
    weights: str = "set",
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """(id_col, class_id): one row per input row; ``class_id`` is the smallest id of the documents it
    is connected with through pairs of (weighted) Jaccard similarity of at least ``similarity``.

    ``weights`` makes a shingle count once per document (``set``) or as often as it occurs (``counts``).
    """
    if weights not in WEIGHTS:
        raise ValueError(f"weights must be one of {WEIGHTS}")
    spark, kind = df.sparkSession, df.schema[id_col].dataType
    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("said"), F.col(text_col).alias("text"))
    sketched, sketched_path = stored(signatures(texts.where("doc_id is not null"), size, weights), "signatures")
    # Equal texts first: one representative each, and every document knows its own.
    distinct, distinct_path = stored(
        sketched.where("digest is not null")
        .groupBy("digest")
        .agg(F.min(F.struct("doc_id", "said", "bands", "signature")).alias("r"))
        .select(F.monotonically_increasing_id().alias("number"), "digest", "r.*"),
        "representatives",
    )
    names = distinct.select("number", "doc_id", "said")
    sketches = distinct.where("size(bands) > 0").selectExpr("number as doc_id", "signature")
    banded = distinct.select(F.explode("bands").alias("band"), F.col("number").alias("doc_id"))
    buckets = banded.groupBy("band").agg(F.min("doc_id").alias("centre"), F.max("doc_id").alias("high"), F.count("*").alias("members"))
    buckets = buckets.where("centre < high").drop("high")
    stars = banded.join(buckets, "band").where("doc_id > centre").selectExpr("centre as a", "doc_id as b").distinct()
    stars, stars_path = stored(likely(stars, sketches, similarity), "stars")
    first, first_path = stored(checked(stars, names, texts, size, weights, similarity), "links")
    labels = components(first)

    hanging, hanging_path = stored(_hanging(banded, buckets, labels, sketches, similarity), "open")
    more, more_path = _joining(components(hanging), labels, sketches, names, texts, size, weights, similarity)
    copies = sketched.join(distinct.selectExpr("digest", "doc_id as low"), "digest").where("doc_id > low").selectExpr("low as a", "doc_id as b").distinct()
    low, high = names.selectExpr("number as a", "doc_id as low"), names.selectExpr("number as b", "doc_id as high")
    links = first.union(more).join(low, "a").join(high, "b").where("low <> high").selectExpr("low as a", "high as b")
    labels = components(links.union(copies))
    forget(spark, sketched_path, distinct_path, stars_path, first_path, hanging_path, more_path)

    ids = df.select(F.col(id_col).cast("long").alias("doc_id"))
    classed = ids.join(labels, "doc_id", "left").withColumn("class_id", F.coalesce("class_id", "doc_id"))
    return classed.select(F.col("doc_id").cast(kind).alias(id_col), F.col("class_id").cast(kind).alias("class_id"))
