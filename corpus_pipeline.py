"""From raw documents to token ids: language, near duplicates, repeats, contamination, encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; each is written and read again
before the next. All but the last return the columns of ``documents``.

Rows with one id are one document and stay or go together; a row without an id is never a duplicate
of another; an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.llm import bpe, decontam, langid, neardup, substrings
from ratingloom.session import scratch

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

#: No SQL: the language and near-duplicate stages iterate. Tested beside plain Python instead.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found, with ``lang`` as found; the model is fitted on the labels."""
    model = langid.fit(docs)
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "lang"))
    found = langid.identify(docs, model, carry=rest).where(F.col("lang_pred") != langid.UNKNOWN)
    return found.select(*[F.col("lang_pred").alias("lang") if c == "lang" else F.col(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of every class of near duplicates."""
    classes = neardup.near_duplicate_classes(docs)
    gone = classes.where("class_id < doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that a document of smaller id has; white space elsewhere stays."""
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    cut = substrings.remove_repeats(docs, layout="text", carry=rest)
    new = {"text": F.col("kept").alias("text"), "n_chars": F.char_length("kept").cast(docs.schema["n_chars"].dataType).alias("n_chars")}
    return cut.select(*[new.get(c, F.col(c)) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text."""
    return decontam.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, decoded): token ids of every text and what they decode to."""
    ids = bpe.encode_texts(docs, RANKS, public_tokenizers.PATTERN, carry=("lang", "source"), remembered=96 << 20, shared=False)
    return ids.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language ID", language),
    ("MinHash near-dedup", near_duplicates),
    ("substring dedup", repeats),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE encoding and decoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
