"""Search over stored postings with upper bounds: blocks that cannot reach the best n are not scored.

Items lie in hash blocks. The index keeps every posting with its BM25 weight and, per term, field and
block, the greatest weight there. For a query the bounds of its terms add up to a bound of a block.
The blocks of the greatest bounds are scored first; the n-th best score found there is a threshold,
and of all other blocks only those whose bound reaches it are scored. Every item that belongs in the
answer lies in such a block, so the answer is that of ``search``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.scalars import stable
from ratingloom.operators.lists import by_score, top_k
from ratingloom.operators.search import _weighted, field_sizes, hits_to_recs, index_corpus, query_terms
from ratingloom.schemas import SCORE_DIGITS
from ratingloom.session import materialised

#: Items of a block, and the blocks of a query that are scored for its threshold.
BLOCK_ITEMS, FIRST_BLOCKS = 64, 2
#: Sums of rounded parts differ by less.
SLACK = 10.0 ** (1 - SCORE_DIGITS)


class BlockIndex(NamedTuple):
    """Weighted postings (term, field, block, mid, w) and bounds (term, field, block, most)."""

    postings: DataFrame
    bounds: DataFrame
    fields: tuple[str, ...]


def index_blocks(corpus: DataFrame, fields: Sequence[str] = ("name", "descri"), block_items: int = BLOCK_ITEMS) -> BlockIndex:
    """Index a corpus once for many searches; both tables are written, sorted for lookups by term."""
    blocks = max(1, math.ceil(corpus.count() / block_items))
    block = F.pmod(F.xxhash64(F.col("mid").cast("long")), F.lit(blocks)).cast("int")
    weighted = _weighted(index_corpus(corpus, fields), field_sizes(corpus, fields)).withColumn("block", block)
    order = ["term", "block", "mid"]
    postings = materialised(weighted.repartitionByRange(*order).sortWithinPartitions(*order), "block-postings")
    bounds = materialised(postings.groupBy("term", "field", "block").agg(F.max("w").alias("most")), "block-bounds")
    return BlockIndex(postings, bounds, tuple(fields))


def _best_field(fields: Sequence[str], value: str):
    sums = [F.sum(F.when(F.col("field") == f, F.col(value))) for f in fields]
    return F.greatest(*sums) if len(sums) > 1 else sums[0]


def block_bounds(index: BlockIndex, terms: DataFrame) -> DataFrame:
    """(qid, block, bound): what no item of the block can score above."""
    bound = _best_field(index.fields, "most")
    return index.bounds.join(terms, "term").groupBy("qid", "block").agg(bound.alias("bound"))


def asked_postings(index: BlockIndex, terms: DataFrame, blocks: DataFrame) -> DataFrame:
    """(qid, mid, field, w): the postings of the queries' terms in their (qid, block) pairs."""
    asked = terms.join(blocks.select("qid", "block"), "qid")
    return index.postings.join(asked, ["term", "block"]).select("qid", "mid", "field", "w")


def _scored(index: BlockIndex, postings: DataFrame) -> DataFrame:
    return postings.groupBy("qid", "mid").agg(stable(_best_field(index.fields, "w")).alias("score"))


def search_blocks(index: BlockIndex, queries: DataFrame, n: int = 10, first_blocks: int = FIRST_BLOCKS) -> DataFrame:
    """(qid, rank, mid, score): the ``n`` best items of every (qid, text) query, as ``search`` has them."""
    terms = materialised(query_terms(queries), "terms")
    bounds = materialised(block_bounds(index, terms), "bounds")
    first = top_k(bounds, "qid", [F.desc("bound"), F.asc("block")], first_blocks).select("qid", "block")
    hits = materialised(_scored(index, asked_postings(index, terms, first)), "first-hits")
    more = _scored(index, asked_postings(index, terms, open_blocks(bounds, first, hits, n)))
    return hits_to_recs(hits.unionByName(more), n)


def open_blocks(bounds: DataFrame, first: DataFrame, hits: DataFrame, n: int) -> DataFrame:
    """The (qid, block) pairs outside ``first`` that may hold one of the ``n`` best."""
    best = top_k(hits, "qid", by_score(), n)
    least = best.groupBy("qid").agg(F.when(F.count("*") == n, F.min("score")).alias("least"))
    left = bounds.join(first, ["qid", "block"], "left_anti").join(least, "qid", "left")
    return left.where(F.col("least").isNull() | (F.col("bound") >= F.col("least") - SLACK)).select("qid", "block")
