"""Benchmark decontamination over a distributed positional inverted index, in built-in functions only.

1. **Windows.** Every run of ``length`` item words is a phrase; a shorter item is one phrase.
2. **Frequencies.** One pass counts the phrases' words in the training texts. A phrase with a word
   that never occurs is gone; the others are asked for by their ``rarest`` words.
3. **Postings.** A second pass stores (word, document, position) of those words alone.
4. **Intersection.** A posting minus the word's place in a phrase says where the phrase would begin.
   Places named by all asked words of a phrase are candidates, found by one aggregation; starts that
   differ by at most ``slop`` are proximity matches.
5. **Check.** Candidates are compared word by word with their whole texts.

The benchmark's word table is broadcast only after its rows are counted (``BROADCAST_ROWS``), and
joined by shuffle beyond. Texts are shuffled at most once, only for documents with candidates.
Documents are known by (id, hash of the text), so rows with one id keep their own results.

Defined cases: a null or empty text has no words; a null or empty item is no phrase; rows without
an id are judged like others; equal items all count.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.llm.common import stored

LENGTH, RAREST = 13, 2
#: A word is at most some hundred bytes, so this many rows stay within a broadcast's means.
BROADCAST_ROWS = 500_000
#: What stands between words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text after lower-casing A-Z."""
    return _cut(F.translate(text, string.ascii_uppercase, string.ascii_lowercase), GAP)


def _cut(text: Column, gap: str) -> Column:
    """What lies between gaps, as ``regexp_extract_all`` of all else would give it; that makes an object
    for every match and takes some twenty times as long."""
    return F.array_remove(F.split(text, gap), "")


def phrases_of(items: DataFrame, length: int = LENGTH, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, phrase): the distinct windows of every item, words joined by a space."""
    listed = items.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("terms")).where("size(terms) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("terms") - (length - 1)))
    begun = listed.select("item_id", "terms", F.explode(starts).alias("begin"))
    return begun.select("item_id", F.array_join(F.slice("terms", F.col("begin"), F.lit(length)), " ").alias("phrase")).distinct()


def documents_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, said, text): documents with a key that tells rows of one id apart by their text."""
    return df.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias("doc"), F.xxhash64(text_col).alias("said"), F.col(text_col).alias("text")
    )


def small(table: DataFrame, rows: int) -> DataFrame:
    """``table`` marked for broadcast if its counted rows allow it."""
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table


def asked_words(documents: DataFrame, phrases: DataFrame, rarest: int = RAREST) -> DataFrame:
    """(phrase, term, offset, nth, n_asked): the rarest words of every phrase that can occur at all."""
    terms = phrases.select("phrase").distinct().select("phrase", F.posexplode(F.split("phrase", " ")).alias("offset", "term"))
    vocabulary = terms.select("term").distinct()
    said = documents.select(F.explode(words(F.col("text"))).alias("term"))
    counts = said.join(small(vocabulary, vocabulary.count()), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))
    counted = terms.join(counts, "term", "left")
    by_rarity = Window.partitionBy("phrase").orderBy("n", "term", "offset")
    ranked = counted.withColumns(
        {"nth": F.row_number().over(by_rarity), "possible": F.count("n").over(Window.partitionBy("phrase")) == F.size(F.split("phrase", " "))}
    )
    asked = F.least(F.lit(rarest), F.size(F.split("phrase", " ")))
    return ranked.where("possible").withColumn("n_asked", asked).where("nth <= n_asked").select("phrase", "term", "offset", "nth", "n_asked")


def postings_of(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, doc, said, pos): where the given words stand in the documents."""
    at = documents.select("doc", "said", F.posexplode(words(F.col("text"))).alias("pos", "term"))
    return at.join(small(terms, terms.count()), "term", "left_semi").select("term", "doc", "said", "pos")


def begins(postings: DataFrame, asked: DataFrame) -> DataFrame:
    """(doc, said, phrase, begin, nth, n_asked): where each asked word would have its phrase begin."""
    found = postings.join(asked, "term").withColumn("begin", F.col("pos") - F.col("offset"))
    return found.select("doc", "said", "phrase", "begin", "nth", "n_asked")


def candidates(starts: DataFrame) -> DataFrame:
    """(doc, said, phrase, begin): places that all asked words of a phrase agree on."""
    seen = starts.where("begin >= 0").groupBy("doc", "said", "phrase", "begin", "n_asked").agg(F.bit_or(F.expr("shiftleft(1, nth - 1)")).alias("mask"))
    return seen.where(F.bit_count("mask") == F.col("n_asked")).select("doc", "said", "phrase", "begin")


def exact_matches(documents: DataFrame, found: DataFrame) -> DataFrame:
    """(doc, said, phrase, begin) of the candidates whose every word stands in the text."""
    per_document = found.groupBy("doc", "said").agg(F.collect_set(F.struct("begin", F.split("phrase", " ").alias("terms"))).alias("found"))
    joined = documents.join(per_document, ["doc", "said"])
    # A lambda variable holds the words, so they are made once per text.
    agreed = F.transform(
        F.array(words(F.col("text"))),
        lambda ws: F.filter("found", lambda c: F.slice(ws, c["begin"] + 1, F.size(c["terms"])) == c["terms"]),
    )
    rows = joined.select("doc", "said", F.explode(agreed[0]).alias("c"))
    return rows.select("doc", "said", F.array_join("c.terms", " ").alias("phrase"), F.col("c.begin").alias("begin")).distinct()


def proximity_matches(starts: DataFrame, slop: int) -> DataFrame:
    """(doc, said, phrase, begin, off): places where the two rarest words of a phrase stand in one
    document at up to ``slop`` words from their right distance, but not at it."""
    first = starts.where("nth = 1").select("doc", "said", "phrase", "begin").distinct()
    second = starts.where("nth = 2").select("doc", "said", "phrase", F.col("begin").alias("other")).distinct()
    # Starts are put into bins of the slop's width, so a word that fills a text meets its neighbours only.
    width = max(1, slop)
    first = first.withColumn("bin", F.explode(F.sequence(F.floor((F.col("begin") - slop) / width), F.floor((F.col("begin") + slop) / width))))
    second = second.withColumn("bin", F.floor(F.col("other") / width))
    near = first.join(second, ["doc", "said", "phrase", "bin"]).withColumn("off", F.abs(F.col("other") - F.col("begin")))
    near = near.withColumn("begin", F.greatest(F.lit(0), F.least("begin", "other")))
    return near.where((F.col("off") <= slop) & (F.col("off") > 0)).select("doc", "said", "phrase", "begin", "off").distinct()


class PhraseIndex:
    """The stored postings of a benchmark's rarest words, and what is asked of them."""

    def __init__(self, df: DataFrame, items: DataFrame, length: int = LENGTH, rarest: int = RAREST, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id"):
        self.documents = documents_of(df, id_col, text_col)
        self.phrases, _ = stored(phrases_of(items, length, item_col), "phrases")
        self.asked, _ = stored(asked_words(self.documents, self.phrases, rarest), "asked")
        self.postings, _ = stored(postings_of(self.documents, self.asked.select("term").distinct()), "postings")
        self.begins = begins(self.postings, small(self.asked, self.asked.count()))

    def exact(self) -> DataFrame:
        return exact_matches(self.documents, candidates(self.begins))

    def near(self, slop: int) -> DataFrame:
        return proximity_matches(self.begins, slop)


def document_hits(
    df: DataFrame, items: DataFrame, length: int = LENGTH, rarest: int = RAREST, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id"
) -> DataFrame:
    """(doc, said, n_hit, items) of the documents in which phrases occur."""
    index = PhraseIndex(df, items, length, rarest, id_col, text_col, item_col)
    matches, _ = stored(index.exact(), "matches")
    places = matches.withColumn("n", F.size(F.split("phrase", " ")))
    covered = F.flatten(F.collect_set(F.sequence(F.col("begin"), F.col("begin") + F.col("n") - 1)))
    hits = places.groupBy("doc", "said").agg(F.size(F.array_distinct(covered)).cast("long").alias("n_hit"))
    named = matches.select("doc", "said", "phrase").distinct().join(index.phrases, "phrase")
    held = named.select("doc", "said", F.col("item_id").cast("string").alias("item")).distinct()
    return hits.join(held.groupBy("doc", "said").agg(F.array_sort(F.collect_list("item")).alias("items")), ["doc", "said"])


def word_count(text_col: str) -> Column:
    return F.coalesce(F.array_size(_cut(F.col(text_col), ANY_CASE_GAP)), F.lit(0)).cast("long")


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least a twentieth of the words are hit."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def contamination(
    df: DataFrame, items: DataFrame, length: int = LENGTH, rarest: int = RAREST, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id"
) -> DataFrame:
    """(id_col, n_words, n_hit, n_items, items, contaminated): one row per input row. ``n_hit`` words
    lie in a phrase of the benchmark, ``items`` are the ids whose phrases occur, sorted as text."""
    hits = document_hits(df, items, length, rarest, id_col, text_col, item_col)
    rows = df.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias("doc"), F.xxhash64(text_col).alias("said"), word_count(text_col).alias("n_words")
    )
    joined = rows.join(hits, ["doc", "said"], "left")
    n_hit, held = F.coalesce("n_hit", F.lit(0)).cast("long"), F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        F.col("id").alias(id_col),
        "n_words",
        n_hit.alias("n_hit"),
        F.size(held).cast("long").alias("n_items"),
        held.alias("items"),
        is_contaminated(n_hit, F.col("n_words")).alias("contaminated"),
    )


def without_contaminated(
    df: DataFrame, items: DataFrame, length: int = LENGTH, rarest: int = RAREST, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id"
) -> DataFrame:
    """The rows of ``df``, with all their columns, that are not contaminated."""
    hits = document_hits(df, items, length, rarest, id_col, text_col, item_col).select("doc", "said", "n_hit")
    rows = df.select(F.struct("*").alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias("doc"), F.xxhash64(text_col).alias("said"))
    marked = rows.join(hits, ["doc", "said"], "left")
    clean = F.when(F.col("n_hit").isNull(), F.lit(True)).otherwise(~is_contaminated(F.col("n_hit"), word_count(f"row.{text_col}")))
    return marked.where(clean).select("row.*")
