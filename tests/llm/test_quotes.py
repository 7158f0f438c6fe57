"""Reply order beside its SQL on conversations that quote."""

from __future__ import annotations

import random
import re

import duckdb
import pytest

from ratingloom.llm import quotes
from ratingloom.llm.queries import LLM_ORACLES

SCHEMA = "conv_id long, turn long, role string, text string, depth int"


def quoting(seed, conversations=6, length=25):
    rnd = random.Random(seed)
    said = ["Hello there", "ok", "What  about\tx?", "É à", "No.", "thanks", "a long passage of words", "> odd"]
    rows = []
    for conv in range(conversations):
        texts = []
        for turn in range(rnd.randint(1, length)):
            lines = [f"line {conv} {turn}" if rnd.random() < 0.4 else rnd.choice(said) for _ in range(rnd.randint(0, 3))]
            if texts and rnd.random() < 0.7:
                source = rnd.choice(texts).split("\n")
                lines = [rnd.choice([">", "> ", " >"]) + x.upper() for x in source] + [""] + lines
            if rnd.random() < 0.1:
                lines.append(">> nobody said this")
            texts.append("\n".join(lines))
            rows.append((conv, turn, rnd.choice(["user", "assistant"]), texts[-1], 1))
    return rows


def by_sql(rows):
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    if rows:
        con.executemany("insert into conversations values (?, ?, ?, ?)", [r[:4] for r in rows])
    found = con.execute(LLM_ORACLES["op9_reply_order"])
    names = [d[0] for d in found.description]
    return sorted((dict(zip(names, r)) for r in found.fetchall()), key=str), names


@pytest.mark.parametrize("seed, bucket", [(1, 1024), (2, 3), (3, 1)])
def test_equals_sql(spark, seed, bucket):
    rows = quoting(seed) + [(90, 0, None, None, 1), (90, 1, "user", "", 1), (None, 0, "user", "x", 1), (None, 1, "user", "> x", 1), (91, None, "user", "> x\ny", 1)]
    rows += [rows[3], *[r for r in rows if '>' in (r[3] or '')][:4]]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    expected, names = by_sql(rows)
    got = sorted(({n: r[n] for n in names} for r in quotes.reply_order(df, bucket).collect()), key=str)
    assert got == expected
    assert any(r["depth"] > 2 for r in got) and any(r["n_quotes"] > r["n_linked"] for r in got)


def test_thread(spark):
    rows = [(1, 0, "a", "Start here", 0), (1, 1, "b", "Other topic", 0), (1, 2, "c", "> start   HERE\nyes", 0), (1, 3, "d", ">> Start here\n> yes\nno", 0), (1, 4, "e", "> Other topic\nfine", 0)]
    got = quotes.reply_order(spark.createDataFrame(rows, SCHEMA)).orderBy("root_turn", "turn").collect()
    assert [(r.turn, r.parent_turn, r.root_turn, r.depth, r.text) for r in got] == [
        (0, None, 0, 0, "Start here"), (2, 0, 0, 1, "yes"), (3, 2, 0, 2, "no"), (1, None, 1, 0, "Other topic"), (4, 1, 1, 1, "fine"),
    ]
    assert got[1].chat == "<|c|>\nyes\n<|end|>"


def test_long_chain_and_long_text(spark):
    rows = [(1, t, "u", f"> m{t - 1}\nm{t}", 0) for t in range(300)] + [(2, 0, "u", "w " * 200_000, 0), (2, 1, "u", "> " + "w " * 200_000, 0)]
    got = {(r.conv_id, r.turn): r for r in quotes.reply_order(spark.createDataFrame(rows, SCHEMA), 16).collect()}
    assert got[(1, 299)].root_turn == 0 and got[(1, 299)].depth == 299
    assert got[(2, 1)].parent_turn == 0 and got[(2, 1)].text == ""


def test_empty_table(spark):
    assert quotes.reply_order(spark.createDataFrame([], SCHEMA)).count() == 0


def test_main_path_is_built_in(spark):
    plan = quotes.reply_order(spark.createDataFrame([(1, 1, "u", "t", 1)], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
