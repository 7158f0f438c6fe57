"""Mixing sources to target weights: fixed-length blocks, source counts per shard, permuted indexes.

1. **Targets.** Sources share all words by weight; a target stops at ``most`` times its source's size
   and the excess is shared again by weight until none is above.
2. **Pack.** The documents of a source, in the order of their ids, are one stream of words, cut into
   blocks of ``block`` words; the last may be shorter. Starts are sums over ranges of the ordered
   rows, so no task holds a source.
3. **Draw.** A source gives whole passes over its blocks and a part of one more, the last block cut
   to the words that are owed. A pseudorandom permutation deals all slots of the mix to output
   shards: a shard's counts by source are a multinomial draw given the totals, so a source meets its
   target to the word. Inside a pass a second permutation, keyed by source and pass, maps slots to
   block indexes; a shorter last block ends a pass.
4. **Join.** Blocks drawn and blocks that documents lie in meet by source and index.

Both permutations are computed from an index alone: rounds of swapping x with k - x or not, by a bit
of the larger one. Slots are made in chunks of bounded size, so a source with a third of all words
is spread over tasks. Everything is built-in functions.

Defined cases: a null or empty text has size 0 and nothing is taken of it; a null source is a source
of its own, the last; rows of one id are documents of their own; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import before, placed, stored
from ratingloom.session import forget

BLOCK, SHARD = 512, 1024
#: Slots made from one row, and by one task while there are tasks left.
CHUNK, TASK_SLOTS, TASKS = 8_192, 32_768, 20_000
WEIGHTS, MOST, SEED, ROUNDS = (1, 2, 3), 3, 13, 24
WORD = r"[^\x20\x09-\x0D]+"
_PRIME = (1 << 31) - 1


def permutation_keys(n: Column, *names: Column | str, rounds: int = ROUNDS) -> Column:
    """The keys of ``permuted`` over n indexes, from names of any kind."""
    said = [F.lit(x) if isinstance(x, str) else x.cast("string") for x in names]

    def key(r: Column) -> Column:
        return F.md5(F.concat_ws(":", *said, r.cast("string")).cast("binary"))

    def digits(text: Column, start: int, count: int) -> Column:
        return F.conv(F.substring(text, start, count), 16, 10).cast("long")

    made = F.transform(F.sequence(F.lit(1), F.lit(rounds)), key)
    return F.transform(
        made,
        lambda h: F.struct(
            (digits(h, 15, 14) % F.greatest(n, F.lit(1))).alias("k"), (digits(h, 1, 7) + 1).alias("a"), digits(h, 8, 7).alias("b")
        ),
    )


def permuted(at: Column, n: Column, keys: Column) -> Column:
    """Where a pseudorandom permutation of 0 .. n - 1 takes ``at``."""

    def step(x: Column, key: Column) -> Column:
        other = F.pmod(key["k"] - x, n)
        mixed = (F.greatest(x, other) % _PRIME * key["a"] + key["b"]) % _PRIME
        return F.when(F.shiftright(mixed, 15).bitwiseAND(F.lit(1).cast("long")) == 1, other).otherwise(x)

    return F.aggregate(keys, at, step)


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> tuple[DataFrame, str]:
    """(number, source, size, target) of every source of (source, size), written, and its path."""
    spark = sized.sparkSession
    sums = sized.groupBy("source").agg(F.sum("size").alias("size"))
    lined, lined_path = placed(sums, [F.col("source").asc_nulls_last()], "sources")
    sources = before(lined, F.lit(1).cast("long"), "number")
    kept, path = stored(sources.select("number", "source", "size"), "sources")
    forget(spark, lined_path)
    literal = F.array(*[F.lit(w) for w in weights])
    weight = F.get(literal, (F.col("number") % len(weights)).cast("int"))
    cap = most * F.col("size")
    row = kept.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("total"), F.coalesce(F.sum(weight), F.lit(0)).alias("parts")).first()
    total, left, parts, over = row.total, row.total, max(1, row.parts), 0
    while True:
        # A round's share per weight only grows, so sources at their cap stay there. A small number of
        # words would be an int literal, and its product with a weight may pass the ints.
        share = F.lit(left).cast("long") * weight / F.lit(parts)
        row = kept.agg(
            F.count_if(cap < share).alias("over"),
            F.coalesce(F.sum(F.when(cap < share, cap)), F.lit(0)).alias("used"),
            F.coalesce(F.sum(F.when(cap >= share, weight)), F.lit(0)).alias("parts"),
        ).first()
        if row.over == over:
            break
        left, parts, over = total - row.used, max(1, row.parts), row.over
    return kept.withColumn("target", F.when(cap < share, cap.cast("double")).otherwise(share.cast("double"))), path


def _packed(df: DataFrame, text_col: str, id_col: str, source_col: str, carry: tuple[str, ...]) -> tuple[DataFrame, str]:
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    carried = F.struct(*carry) if carry else F.lit(0)
    return stored(df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), carried.alias("carried")), "sizes")


def drawn_blocks(sources: DataFrame, block: int = BLOCK, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """(shard, slot, number, pass, block, words): every block of the mix and its place; ``words`` are
    counted from the block's start."""
    owed = F.least(F.round("target").cast("long"), MOST * F.col("size"))
    sized = sources.withColumns({"whole": F.floor(F.col("size") / block), "owed": owed})
    sized = sized.where("size > 0 and owed > 0").withColumns(
        {"n": F.ceil(F.col("size") / block), "passes": F.expr("owed div size"), "rest": F.col("owed") % F.col("size")}
    )
    sized = sized.withColumn("slots", F.col("passes") * F.col("n") + F.ceil(F.col("rest") / block))
    lined, _ = placed(sized, [F.col("number")], "slots")
    total = lined.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    started = before(lined, F.col("slots"), "start").withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes"))))
    started = started.withColumn("here", F.when(F.col("pass") < F.col("passes"), F.col("size")).otherwise(F.col("rest")))
    started = started.withColumn("count", F.ceil(F.col("here") / block)).where("count > 0")
    chunked = started.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(count - 1) div {CHUNK}"))))
    tasks = min(TASKS, total // TASK_SLOTS + 1)
    chunked = chunked.repartition(tasks, "number", "pass", "chunk").withColumns(
        {
            "keys": permutation_keys(F.col("whole"), str(seed), "block", F.col("number"), F.col("pass")),
            "deal": permutation_keys(F.lit(total).cast("long"), str(seed), "slot"),
        }
    )
    low = F.col("chunk") * CHUNK
    slots = chunked.withColumn("at", F.explode(F.sequence(low, F.least(F.col("count"), low + CHUNK) - 1)))
    index = F.when(F.col("at") < F.col("whole"), permuted(F.col("at"), F.col("whole"), F.col("keys"))).otherwise(F.col("at"))
    place = permuted(F.col("start") + F.col("pass") * F.col("n") + F.col("at"), F.lit(total).cast("long"), F.col("deal"))
    return slots.select(
        F.floor(place / shard).alias("shard"),
        (place % shard).alias("slot"),
        "number",
        "pass",
        index.alias("block"),
        F.least(F.lit(block).cast("long"), F.col("here") - F.col("at") * block).alias("words"),
    )


def _in_blocks(sized: DataFrame, sources: DataFrame, block: int) -> DataFrame:
    """Documents with the block indexes they lie in, and where their words begin and end there."""
    numbered = sized.join(sources.select("number", F.col("source").alias("_source"), F.col("size").alias("source_size"), "target"), F.col("source").eqNullSafe(F.col("_source")))
    order = [F.col("number"), F.col("id").asc_nulls_last(), F.col("size")]
    lined, _ = placed(numbered.select("id", "number", "source", "size", "source_size", "target", "carried"), order, "stream")
    started = before(lined, F.col("size"), "start", ("number",))
    last = F.expr(f"(start + size - 1) div {block}")
    index = F.when(F.col("size") > 0, F.sequence(F.expr(f"start div {block}"), last))
    laid = started.withColumn("block", F.explode_outer(index))
    return laid.withColumns(
        {
            "from": F.greatest(F.col("start") - F.col("block") * block, F.lit(0).cast("long")),
            "to": F.least(F.col("start") + F.col("size") - F.col("block") * block, F.lit(block).cast("long")),
        }
    )


def mix(
    df: DataFrame,
    block: int = BLOCK,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    seed: int = SEED,
    text_col: str = "text",
    id_col: str = "doc_id",
    source_col: str = "source",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(id_col, source_col, size, source_size, target, taken, carried columns): how many words of every
    document the mix takes, repeats counted."""
    sized, _ = _packed(df, text_col, id_col, source_col, carry)
    sources, _ = source_targets(sized, weights, most)
    drawn = drawn_blocks(sources, block, seed=seed)
    # A block is drawn at most once a pass, and one block of a source is cut; both lengths are kept.
    taken = drawn.groupBy("number", "block", "words").agg(F.count("*").alias("times"))
    taken = taken.groupBy("number", "block").agg(F.collect_list(F.struct("words", "times")).alias("draws"))
    laid = _in_blocks(sized, sources, block)
    overlap = F.aggregate(
        "draws",
        F.lit(0).cast("long"),
        lambda sum_, d: sum_ + d["times"] * F.greatest(F.lit(0).cast("long"), F.least(F.col("to"), d["words"]) - F.col("from")),
    )
    both = laid.join(taken, ["number", "block"], "left").withColumn("got", F.coalesce(overlap, F.lit(0).cast("long")))
    sums = both.groupBy("part", "nth").agg(
        F.sum("got").alias("taken"), *[F.first(c).alias(c) for c in ("id", "source", "size", "source_size", "target", "carried")]
    )
    return sums.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "taken", *[F.col(f"carried.{c}") for c in carry]
    )


def mixed_shards(
    df: DataFrame,
    block: int = BLOCK,
    shard: int = SHARD,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    seed: int = SEED,
    text_col: str = "text",
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """(shard, slot, piece, id_col, first_word, text): the mix itself. A slot's words are its pieces in
    order, each some words of one document, joined by one space."""
    rows, _ = stored(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    sized, _ = _packed(rows, text_col, id_col, source_col, ("_row",))
    sources, _ = source_targets(sized, weights, most)
    drawn = drawn_blocks(sources, block, shard, seed)
    laid = _in_blocks(sized, sources, block).where("size > 0").select("number", "block", "start", "from", "to", F.col("carried._row").alias("_row"))
    pieces = drawn.join(laid, ["number", "block"]).where(F.col("from") < F.col("words"))
    first = F.col("block") * block + F.col("from") - F.col("start")
    pieces = pieces.select("shard", "slot", F.col("from").alias("piece"), "_row", first.alias("first_word"), (F.least("to", "words") - F.col("from")).alias("n"))
    words = F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0))
    said = F.array_join(F.slice(words, (F.col("first_word") + 1).cast("int"), F.col("n").cast("int")), " ")
    return pieces.join(rows, "_row").select("shard", "slot", "piece", id_col, "first_word", said.alias("text"))
