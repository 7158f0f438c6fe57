"""Quality of texts by weak supervision, in built-in functions only.

Rules look at counts of a text and vote for it, against it, or abstain: each looks for one fault and
says nothing where it finds none, and one votes for texts that are plain in all respects. Documents
are grouped by their pattern of votes, at most three to the power of the number of rules whatever
the data, and expectation-maximisation over the patterns estimates how often each rule is right,
given the share of good texts. The posterior probability that a text is good decides, instead of a
demand that all rules pass.

Counts are taken once, inside the task that reads the text, and stored; texts are never shuffled.

Defined cases: a null or empty text has no words and fails the base rules; rules abstain where a
text has nothing to judge; an empty table leaves the rules at their prior accuracy; repeated rows
and rows without an id give one output row each.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
#: Share of good texts, prior accuracy of a rule and its weight in votes, steps of EM, and the change at which it ends.
GOOD, ACCURACY, PRIOR_VOTES, STEPS, SETTLED = 0.6, 0.8, 10.0, 40, 1e-5
LOWEST, HIGHEST = 0.55, 0.995


class Rule(NamedTuple):
    """SQL conditions on the counts; a text for which neither holds gets no vote."""

    name: str
    good: str
    bad: str


# Shares are written as products, so texts without words divide by nothing.
RULES = (
    Rule("length", "false", "n_words < 50"),
    Rule("word_length", "false", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    Rule("symbols", "false", "10 * n_symbols > n_words"),
    Rule("symbol_share", "false", "40 * n_symbols > word_chars"),
    Rule("repeated_words", "false", "4 * n_repeat_words > n_words"),
    Rule("repeated_lines", "false", "3 * n_dup_lines > n_lines"),
    Rule("capitals", "false", "3 * n_capitals > n_letters and n_letters > 0"),
    Rule("letters", "false", "10 * n_letters < 8 * word_chars"),
    Rule("digits", "false", "10 * n_digits > word_chars"),
    Rule(
        "plain",
        "n_words >= 50 and 50 * n_symbols <= n_words and 10 * n_repeat_words <= n_words and 10 * n_dup_lines <= n_lines"
        " and 10 * n_letters >= 9 * word_chars and 5 * n_capitals <= n_letters",
        "false",
    ),
)


def text_counts(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id_col, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_letters,
    n_capitals, n_digits) of every whole text."""
    said = F.coalesce(F.col(text_col), F.lit(""))
    # A lambda variable holds the words, so they are made once per text.
    split = F.array(F.regexp_extract_all(said, F.lit(WORD), F.lit(0)))
    of_words = F.transform(
        split,
        lambda ws: F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.aggregate(ws, F.lit(0).cast("long"), lambda total, w: total + F.char_length(w)).alias("word_chars"),
            _repeated(ws).alias("n_repeat_words"),
        ),
    )[0]
    lines = F.array(F.filter(F.split(said, "\n", -1), lambda line: line.rlike(WORD)))
    of_lines = F.transform(
        lines,
        lambda ls: F.struct(
            F.size(ls).cast("long").alias("n_lines"), (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines")
        ),
    )[0]
    count = lambda pattern: F.regexp_count(said, F.lit(pattern)).cast("long")
    rows = df.select(
        F.col(id_col),
        of_words.alias("of_words"),
        of_lines.alias("of_lines"),
        count(SYMBOL).alias("n_symbols"),
        count(r"\p{L}").alias("n_letters"),
        count(r"\p{Lu}").alias("n_capitals"),
        count(r"\p{Nd}").alias("n_digits"),
    )
    return rows.select(id_col, "of_words.*", "of_lines.*", "n_symbols", "n_letters", "n_capitals", "n_digits")


def _repeated(ws: Column) -> Column:
    """Words inside three-word windows that occur twice or more."""
    n = F.size(ws)
    inner = F.greatest(F.lit(0), n - 2)
    pairs = F.zip_with(F.slice(ws, F.lit(1), inner), F.slice(ws, F.lit(2), inner), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    hashes = F.zip_with(pairs, F.slice(ws, F.lit(3), inner), lambda p, c: F.xxhash64(p["a"], p["b"], c))
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    found = F.transform(F.array(placed), lambda s: _twice(s))[0]
    covered = F.transform(F.array(found), lambda at: F.when(F.size(at) > 0, _cover(at)).otherwise(F.lit(0).cast("long")))[0]
    return F.when(n < 4, F.lit(0).cast("long")).otherwise(covered)


def _twice(placed: Column) -> Column:
    """Places, in order, of windows equal to their neighbour in sorted order."""
    none = F.array(F.lit(None).cast("struct<h: bigint, i: int>"))
    rest = F.size(placed) - 1
    with_next = F.zip_with(placed, F.concat(F.slice(placed, F.lit(2), rest), none), lambda s, t: F.struct(s.alias("s"), t["h"].alias("after")))
    both = F.zip_with(
        with_next,
        F.concat(none, F.slice(placed, F.lit(1), rest)),
        lambda x, t: F.struct(x["s"]["i"].alias("i"), F.coalesce((x["s"]["h"] == x["after"]) | (x["s"]["h"] == t["h"]), x["s"]["h"] == x["after"], x["s"]["h"] == t["h"], F.lit(False)).alias("twice")),
    )
    return F.sort_array(F.transform(F.filter(both, lambda x: x["twice"]), lambda x: x["i"]))


def _cover(places: Column) -> Column:
    """How many words windows of three that begin at sorted places cover."""
    gaps = F.zip_with(F.slice(places, F.lit(1), F.size(places) - 1), F.slice(places, F.lit(2), F.size(places) - 1), lambda a, b: F.least(F.lit(3), b - a))
    return F.aggregate(gaps, F.lit(3).cast("long"), lambda total, gap: total + gap)


def votes(counts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``counts`` with one vote column per rule: 1 for, -1 against, 0 abstaining; against wins."""
    made = {f"vote_{r.name}": F.when(F.expr(r.bad), -1).when(F.expr(r.good), 1).otherwise(0) for r in rules}
    return counts.withColumns(made)


class LabelModel(NamedTuple):
    good: float  # given, not estimated
    accuracy: dict[str, float]


def posterior(model: LabelModel) -> Column:
    """Probability that a text with the row's votes is good."""
    odds = F.lit(math.log(model.good / (1 - model.good)))
    for name, right in sorted(model.accuracy.items()):
        odds = odds + F.col(f"vote_{name}") * F.lit(math.log(right / (1 - right)))
    return 1 / (1 + F.exp(-odds))


def fit(voted: DataFrame, rules: tuple[Rule, ...] = RULES, good: float = GOOD, steps: int = STEPS) -> LabelModel:
    """Accuracies by expectation-maximisation over the patterns of votes, given the share of good
    texts; each step is one aggregation of the patterns."""
    names = [r.name for r in rules]
    columns = [f"vote_{n}" for n in names]
    patterns, _ = stored(voted.groupBy(*columns).agg(F.count("*").alias("n")).coalesce(1), "patterns")
    model = LabelModel(good, {n: ACCURACY for n in names})
    for _ in range(steps):
        q = posterior(model)
        right = [
            F.sum(F.col("n") * F.when(F.col(c) == 1, q).when(F.col(c) == -1, 1 - q).otherwise(0.0)).alias(f"right_{n}") for c, n in zip(columns, names, strict=True)
        ]
        cast = [F.sum(F.col("n") * F.abs(c)).alias(f"cast_{n}") for c, n in zip(columns, names, strict=True)]
        sums = patterns.agg(F.sum("n").alias("n"), *right, *cast).first()
        if not sums["n"]:
            break
        last = model
        accuracy = {
            n: min(HIGHEST, max(LOWEST, (sums[f"right_{n}"] + PRIOR_VOTES * ACCURACY) / (sums[f"cast_{n}"] + PRIOR_VOTES))) for n in names
        }
        model = LabelModel(good, accuracy)
        if max(abs(accuracy[n] - last.accuracy[n]) for n in names) < SETTLED:
            break
    return model


BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


def judge(df: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The counts of every text with ``votes`` (one sign per rule), ``quality`` (the posterior),
    ``base_failed`` and ``kept``: base rules hold and the posterior reaches ``threshold``."""
    counts, _ = stored(text_counts(df, text_col, id_col), "counts")
    voted = votes(counts, rules)
    model = fit(voted, rules)
    signs = F.concat(*[F.when(F.col(f"vote_{r.name}") > 0, "+").when(F.col(f"vote_{r.name}") < 0, "-").otherwise("0") for r in rules])
    judged = voted.withColumns({"quality": posterior(model), "base_failed": F.expr(BASE_FAILED), "votes": signs})
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
    return judged.drop(*[f"vote_{r.name}" for r in rules])
