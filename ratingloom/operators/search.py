"""Text search over the item corpus as joins over postings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.scalars import stable, words
from ratingloom.operators.lists import by_score, top_k
from ratingloom.operators.stats import items_with_tags
from ratingloom.schemas import BM25_B, BM25_K1, MORE_LIKE_THIS_TERMS
from ratingloom.session import materialised

# Query terms that are sent to every task; beyond, terms and postings are shuffled.
BROADCAST_TERMS = 200_000
# Words up to this length are met by removed characters, longer ones by pieces.
SHORT_WORD = 20


def build_corpus(movie: DataFrame, tag: DataFrame) -> DataFrame:
    """One row per item with its joined tags, keyed by ``mid``."""
    return items_with_tags(movie, tag)


def _documents(corpus: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(mid, field, tokens, len), one row per item and non-empty field."""
    parts = F.array(*[F.struct(F.lit(f).alias("field"), words(F.coalesce(f, F.lit(""))).alias("tokens")) for f in fields])
    rows = corpus.select("mid", F.inline(parts)).withColumn("len", F.size("tokens"))
    return rows.where(F.col("len") > 0)


def index_corpus(corpus: DataFrame, fields: Sequence[str], wanted: DataFrame | None = None) -> DataFrame:
    """Postings (term, field, mid, len, tf). Store them once, sorted by term, to search repeatedly.

    With ``wanted`` (term) all other terms are dropped before postings are shuffled.
    """
    tokens = _documents(corpus, fields).select("mid", "field", "len", F.explode("tokens").alias("term"))
    if wanted is not None:
        tokens = tokens.join(wanted, "term", "left_semi")
    return tokens.groupBy("term", "field", "mid", "len").agg(F.count("*").alias("tf"))


def field_sizes(corpus: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(field, docs, avg_len): items that have the field and its mean number of tokens."""
    return _documents(corpus, fields).groupBy("field").agg(F.count("*").alias("docs"), F.avg("len").alias("avg_len"))


def _postings_and_sizes(corpus: DataFrame, fields: Sequence[str], wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``index_corpus`` of the wanted terms and ``field_sizes``, from one pass over the corpus: every
    field brings one row without a term, and all is written once."""
    marked = F.concat(F.array(F.lit(None).cast("string")), F.col("tokens"))
    tokens = _documents(corpus, fields).select("mid", "field", "len", F.explode(marked).alias("term"))
    kept = tokens.join(wanted.withColumn("_wanted", F.lit(True)), "term", "left").where("term is null or _wanted")
    stored = materialised(kept.groupBy("term", "field", "mid", "len").agg(F.count("*").alias("tf")), "asked-postings")
    sizes = stored.where("term is null").groupBy("field").agg(F.count("*").alias("docs"), F.avg("len").alias("avg_len"))
    return stored.where("term is not null"), sizes


def _bm25(k1: float, b: float) -> Column:
    idf = F.log(1 + (F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = F.col("tf") + k1 * (1 - b + b * F.col("len") / F.col("avg_len"))
    return idf * F.col("tf") * (k1 + 1) / norm


def _term_df(postings: DataFrame) -> DataFrame:
    return postings.groupBy("field", "term").agg(F.count("*").alias("df"))


def _weighted(postings: DataFrame, sizes: DataFrame) -> DataFrame:
    weighted = postings.join(_term_df(postings), ["field", "term"]).join(sizes, "field")
    return weighted.select("term", "mid", "field", _bm25(BM25_K1, BM25_B).alias("w"))


def query_terms(queries: DataFrame) -> DataFrame:
    """(qid, term): the distinct words of every query."""
    return queries.select("qid", F.explode(F.array_distinct(words("text"))).alias("term"))


def _hits(terms: DataFrame, weighted: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(qid, mid, score): term weights summed per field, the best field counts.

    Items are dealt out by their id first and few queries are sent to every task, so all terms of an
    item meet in one task, and a term that most items have sends on no more than each query's best of
    that task.
    """
    sums = [F.sum(F.when(F.col("field") == f, F.col("w"))) for f in fields]
    best = F.greatest(*sums) if len(sums) > 1 else sums[0]
    asked = F.broadcast(terms) if terms.count() <= BROADCAST_TERMS else terms
    return weighted.repartition("mid").join(asked, "term").groupBy("qid", "mid").agg(stable(best).alias("score"))


def hits_to_recs(hits: DataFrame, n: int) -> DataFrame:
    """The ``n`` best hits of every query as (qid, rank, mid, score)."""
    return top_k(hits, "qid", by_score(), n).select("qid", "rank", "mid", "score")


def search_index(
    postings: DataFrame, sizes: DataFrame, queries: DataFrame, fields: Sequence[str] = ("name", "descri"), n: int = 10
) -> DataFrame:
    """``search`` over stored ``index_corpus`` and ``field_sizes`` tables."""
    terms = query_terms(queries)
    asked = postings.where(F.col("field").isin(*fields)).join(terms.select("term").distinct(), "term", "left_semi")
    return hits_to_recs(_hits(terms, _weighted(asked, sizes), fields), n)


def search(corpus: DataFrame, queries: DataFrame, fields: Sequence[str] = ("name", "descri"), n: int = 10) -> DataFrame:
    """BM25 over several fields for (qid, text) queries; the best field of an item is its score."""
    terms = query_terms(queries)
    postings, sizes = _postings_and_sizes(corpus, fields, terms.select("term").distinct())
    return hits_to_recs(_hits(terms, _weighted(postings, sizes), fields), n)


# The text fields of an item.
TEXT_FIELDS = ("name", "descri", "genres", "actors", "directors", "tags")


def more_like_this(
    corpus: DataFrame, mids: DataFrame, n: int = 10, max_terms: int = MORE_LIKE_THIS_TERMS, fields: Sequence[str] = TEXT_FIELDS
) -> DataFrame:
    """Items like the given ones (qid is the given item): its ``max_terms`` most telling terms over
    all text fields are the query; the item itself is left out."""
    present = [f for f in fields if f in corpus.columns]
    text = corpus.select("mid", F.concat_ws(" ", *present).alias("all"))
    seeds = text.join(mids.select("mid").distinct(), "mid", "left_semi")
    of_seeds = index_corpus(seeds, ("all",)).select("term", "field", F.col("mid").alias("qid"), F.col("tf").alias("seed_tf"))
    seed_terms = materialised(of_seeds, "seed-terms")
    postings, sizes = _postings_and_sizes(text, ("all",), seed_terms.select("term").distinct())
    total = text.agg(F.count("*").alias("docs")).scalar()
    telling = F.col("seed_tf") * F.log((total + 1) / (F.col("df") + 1))
    ranked = seed_terms.join(_term_df(postings), ["field", "term"]).withColumn("telling", stable(telling))
    terms = top_k(ranked, "qid", [F.desc("telling"), F.asc("term")], max_terms).select("qid", "term")
    hits = _hits(terms, _weighted(postings, sizes), ("all",)).where(F.col("qid") != F.col("mid"))
    return hits_to_recs(hits, n)


def _edits(text: Column) -> Column:
    """Allowed edits by length: none up to 2 characters, one up to 5, then two."""
    size = F.length(text)
    return F.when(size <= 2, 0).when(size <= 5, 1).otherwise(2)


def _one_removed(text: Column) -> Column:
    size = F.length(text)
    cut = lambda i: F.concat(F.substr(text, F.lit(1), i - 1), F.substr(text, i + 1, size))
    return F.when(size > 0, F.transform(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), cut)).otherwise(
        F.array().cast("array<string>")
    )


def _shortened(text: Column, edits: int) -> Column:
    """The text and every string that up to ``edits`` removed characters leave of it."""
    forms, last = F.array(text), F.array(text)
    for _ in range(edits):
        last = F.array_distinct(F.flatten(F.transform(last, _one_removed)))
        forms = F.array_union(forms, last)
    return forms


def _pieces(text: Column, length: Column, edits: int, slide: int) -> Column:
    """``edits`` + 1 pieces of a word cut as one of ``length`` is, each up to ``slide`` places moved.

    Of two words within ``edits`` edits one piece of the one stands in the other, moved by no more.
    """
    parts = edits + 1
    forms = []
    for part in range(parts):
        begin, end = F.floor(length * part / parts).cast("int"), F.floor(length * (part + 1) / parts).cast("int")
        for move in range(-slide, slide + 1):
            piece = F.substr(text, begin + 1 + move, end - begin)
            forms.append(F.when(begin + move >= 0, F.concat(F.lit(f"{part}|"), length.cast("string"), F.lit("|"), piece)))
    return F.array_compact(F.array(*forms))


def _query_forms(word: Column, edits: int) -> Column:
    size = F.length(word)
    return F.when(size <= SHORT_WORD, _shortened(F.when(size <= SHORT_WORD, word).otherwise(""), edits)).otherwise(_pieces(word, size, edits, 0))


def _word_forms(word: Column, edits: int, long_too: bool = True) -> Column:
    """What a vocabulary word can be met by: as a short word, as a long one, or near the limit as both.
    Where no query is long, ``long_too`` leaves the forms out that only long ones meet."""
    size = F.length(word)
    none = F.array().cast("array<string>")
    short = size <= SHORT_WORD + edits
    as_short = F.when(short, _shortened(F.when(short, word).otherwise(""), edits)).otherwise(none)
    if not long_too:
        return as_short
    cuts = F.flatten(F.array(*[_pieces(word, size + d, edits, edits) for d in range(-edits, edits + 1)]))
    return F.concat(as_short, F.when(size > SHORT_WORD - edits, cuts).otherwise(none))


def fuzzy_genre(corpus: DataFrame, queries: DataFrame, n: int = 10, max_edits: str | int = "auto") -> DataFrame:
    """Items with a genre token within the allowed edits of the query word; (qid, rank, mid, score).

    Two words within d edits share a form that at most d removals leave of each, or, if long, one of
    d + 1 pieces. So close words meet in an equi-join on forms, of which a word has a bounded number,
    and the edit distance is computed for those only. Words of a length that no query is near are
    left out first. The score is 1 - distance / length of the shorter word, the best token counts.
    """
    wanted = queries.select("qid", F.lower(F.trim("text")).alias("q")).where(F.col("q") != "")
    allowed = _edits(F.col("q")) if max_edits == "auto" else F.lit(int(max_edits))
    depth = 2 if max_edits == "auto" else int(max_edits)
    tokens = corpus.select("mid", F.explode(F.array_distinct(words("genres"))).alias("token"))
    near_lengths = wanted.select(F.explode(F.sequence(F.length("q") - depth, F.length("q") + depth)).alias("_len")).distinct()
    vocabulary = tokens.select("token").distinct().withColumn("_len", F.length("token")).join(near_lengths, "_len", "left_semi")
    long_too = (wanted.agg(F.max(F.length("q"))).first()[0] or 0) > SHORT_WORD
    left = wanted.withColumn("d", allowed.cast("int")).withColumn("form", F.explode(_query_forms(F.col("q"), depth)))
    right = vocabulary.select("token", F.explode(_word_forms(F.col("token"), depth, long_too)).alias("form"))
    distance = F.levenshtein("q", "token", depth)
    shorter = F.least(F.length("q"), F.length("token"))
    near = (
        left.join(right, "form")
        .select("qid", "q", "d", "token")
        .distinct()
        .withColumn("distance", distance)
        .where(F.col("distance").between(0, F.col("d")))
        .select("qid", "token", (1 - F.col("distance") / shorter).alias("s"))
    )
    hits = near.join(tokens, "token").groupBy("qid", "mid").agg(stable(F.max("s")).alias("score"))
    return hits_to_recs(hits, n)
