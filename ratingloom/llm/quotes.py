"""Reply-ordered conversations by quotation linking, in built-in functions only.

Messages quote as mail does, with ``>`` before a line, once per level. A passage is a line without
its marks, lower-cased and with single spaces; it is known by its hash.

1. **Parse.** Every line gets its level; level 0 is what the message says itself.
2. **Link.** A quoted passage comes from the latest earlier message of the conversation that says it.
   That is found in buckets of turns: inside the bucket by a window, before it by the bucket maxima,
   so a passage that a long conversation repeats is never one group.
3. **Parent.** A message answers the source of its lowest quotes, the one with most of them, then the
   latest. Roots follow by pointer doubling; a message without a linked quote is its own root.
4. **Format.** Messages lose their quoted lines. Ordered by (root_turn, turn) threads follow each
   other by their first message, and messages of a thread by time.

Rows stay one per message, so a conversation of any length is never gathered in one task.

Defined cases: a null text is empty; a null role is written as an empty one; messages without a
conversation or turn link to nothing and are no source; repeated rows give one output row each and
share their links; quotes of what nobody said are removed and link to nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.llm.common import stored

MARKS = r"^[ \t]*>[ \t>]*"
BUCKET = 1024


def level_of(line: Column) -> Column:
    """How many marks a line begins with."""
    return F.char_length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))


def normalised(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(line, MARKS, ""), r"[\x20\x09-\x0D]+", " ")))


def passages(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, said, pos, level, passage): hashes of the lines of (conv_id, turn, said, text)."""
    lines = messages.select("conv_id", "turn", "said", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    made = lines.select("conv_id", "turn", "said", "pos", level_of(F.col("line")).alias("level"), normalised(F.col("line")).alias("line"))
    return made.where("line <> ''").select("conv_id", "turn", "said", "pos", "level", F.xxhash64("line").alias("passage"))


def sources(found: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(conv_id, turn, said, level, passage, source): quoted passages with the latest earlier turn that
    says them."""
    key = ["conv_id", "passage"]
    # Repeated rows quote once: their lines are equal in every column.
    quotes = found.where("level > 0 and conv_id is not null and turn is not null").distinct().withColumn("bucket", F.floor(F.col("turn") / bucket))
    asked = quotes.select(*key).distinct()
    said = found.where("level = 0").select(*key, "turn").distinct().join(asked, key, "left_semi").withColumn("bucket", F.floor(F.col("turn") / bucket))

    events = quotes.select(*key, "bucket", "turn", "said", "level", F.lit(None).cast("bigint").alias("own")).unionByName(
        said.select(*key, "bucket", "turn", F.lit(None).cast("bigint").alias("said"), F.lit(None).cast("int").alias("level"), F.col("turn").alias("own"))
    )
    earlier = Window.partitionBy(*key, "bucket").orderBy(F.col("turn"), F.col("own").isNotNull()).rowsBetween(Window.unboundedPreceding, -1)
    inside = events.withColumn("near", F.last("own", ignorenulls=True).over(earlier)).where("level is not null")

    maxima = events.groupBy(*key, "bucket").agg(F.max("own").alias("m"))
    before = Window.partitionBy(*key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = maxima.withColumn("far", F.max("m").over(before)).select(*key, "bucket", "far")
    joined = inside.join(carried, [*key, "bucket"])
    return joined.select("conv_id", "turn", "said", "level", "passage", F.coalesce("near", "far").alias("source"))


def parents(linked: DataFrame) -> DataFrame:
    """(conv_id, turn, said, parent): the message each message answers."""
    support = linked.where("source is not null").groupBy("conv_id", "turn", "said", "source").agg(F.min("level").alias("level"), F.count("*").alias("n"))
    order = F.struct(-F.col("level"), F.col("n"), F.col("source"))
    return support.groupBy("conv_id", "turn", "said").agg(F.max_by("source", order).alias("parent"))


def roots(answered: DataFrame) -> DataFrame:
    """(conv_id, turn, root, depth) of messages with a parent, by pointer doubling: as many rounds as
    the logarithm of the longest chain."""
    start = answered.groupBy("conv_id", "turn").agg(F.max("parent").alias("root")).withColumn("depth", F.lit(1).cast("bigint"))
    chain, _ = stored(start, "threads")
    while True:
        above = chain.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("higher"), F.col("depth").alias("more"))
        if not chain.join(above, ["conv_id", "root"], "left_semi").limit(1).count():
            return chain
        step = chain.join(above, ["conv_id", "root"], "left").select(
            "conv_id", "turn", F.coalesce("higher", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")
        )
        chain, _ = stored(step, "threads")


def without_quotes(text: Column) -> Column:
    """The text without quoted lines, and without blank lines at its ends."""
    own = F.filter(F.split(text, "\n", -1), lambda line: ~line.rlike(MARKS))
    return F.regexp_replace(F.array_join(own, "\n"), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")


def reply_order(conversations: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(conv_id, turn, role, text, parent_turn, root_turn, depth, n_quotes, n_linked, chat): every
    message without quotes, what it answers, its thread, and its place in a chat format. Ordered by
    (conv_id, root_turn, turn) the ``chat`` texts are the conversation."""
    messages = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
        F.xxhash64("role", "text").alias("said"),
    )
    linked, _ = stored(sources(passages(messages), bucket), "links")
    key = ["conv_id", "turn", "said"]
    counted = linked.groupBy(*key).agg(F.count("*").alias("n_quotes"), F.count("source").alias("n_linked"))
    answered, _ = stored(parents(linked), "parents")
    joined = messages.join(counted, key, "left").join(answered, key, "left")
    # Copies of a turn may differ in what they quote; a thread is a matter of the turn.
    threads = roots(answered)
    joined = joined.join(threads, ["conv_id", "turn"], "left")
    said = without_quotes(F.col("text"))
    return joined.select(
        "conv_id",
        "turn",
        "role",
        said.alias("text"),
        F.col("parent").alias("parent_turn"),
        F.coalesce("root", "turn").alias("root_turn"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
        F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), said, F.lit("\n<|end|>")).alias("chat"),
    )
