from __future__ import annotations

import hashlib
import itertools
import random

from docsync.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def replay(rows):
    """What the contract says of the turns themselves."""
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", (r[3] or "").encode())
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=key)
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        blocks = [k for k, _ in itertools.groupby(turns, lambda r: r[2] or "")]
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(blocks))
    return out


def read(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", turns string").repartition(3)
    got = chat.digest(chat.format_conversations(df)).collect()
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.n_blocks) for r in got}


TRAPS = ["", None, "\\", "\\l", "\\b\\bl<", "</turn>\n", "<next/>", "<turn user>", "\\### Assistant: </turn> ok", ">", "a\nb", "\U0001f600<é", "<" * 5 + "\\" * 5]


def test_round_trip_of_traps(spark):
    rng = random.Random(3)
    rows = [
        (c, t, rng.choice(["user", "assistant", "system", "a>b", "<x>\\g", None, ""]), rng.choice(TRAPS) if rng.random() < 0.8 else "".join(rng.choice("\\<>lbgne/xt ") for _ in range(30)))
        for c in [*range(40), None]
        for t in [*range(rng.randint(1, 9)), None]
    ]
    assert read(spark, rows) == replay(rows)


def test_merged_ties_and_repeats(spark):
    rows = [(1, 0, "assistant", "a"), (1, 0, "assistant", "a"), (1, 1, "assistant", ""), (1, 2, "user", "q"), (1, 2, "assistant", "z")]
    assert read(spark, rows) == replay(rows)


def test_the_text_itself(spark):
    df = spark.createDataFrame([(1, 0, "user", "a<b"), (1, 1, "user", "c"), (1, 2, "assistant", "d\\")], SCHEMA)
    row = chat.format_conversations(df).first()
    assert row.formatted == "<turn user>a\\lb<next/>c</turn>\n<turn assistant>d\\b</turn>\n"
    assert [row.formatted[s.start : s.start + s.length] for s in row.loss_mask] == ["d\\b"]


def test_long_and_empty(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], "x<" * 50) for i in range(1500)]
    assert read(spark, rows) == replay(rows)
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = chat.digest(chat.format_conversations(spark.range(1).selectExpr("id conv_id", "id turn", "'user' role", "'t' text")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_conversation_of_200000_turns(spark):
    from pyspark.sql import functions as F

    role = F.when(F.col("id") % 3 == 0, "assistant").otherwise("user")
    rows = spark.range(200_000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.concat(F.lit("t<é\\ "), F.col("id").cast("string")).alias("text"))
    (got,) = chat.digest(chat.format_conversations(rows)).collect()
    said = [("assistant" if i % 3 == 0 else "user", f"t<é\\ {i}") for i in range(200_000)]
    assert got.n_turns == 200_000
    assert got.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
    loss = "".join(t for r, t in said if r == "assistant")
    assert (got.loss_chars, got.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_parts_of_a_cut_text(spark, monkeypatch):
    from docsync.llm import common
    from pyspark.sql import functions as F

    monkeypatch.setattr(common, "LARGE", 12)
    monkeypatch.setattr(common, "SMALL", 4)
    text = "aé\U0001f600bcdefghijklmnopqrstuvwxyz0123"
    spans = [(a, n) for a in range(len(text)) for n in range(len(text) - a + 1)]
    df = spark.createDataFrame([(text, *s) for s in spans], "t string, a int, n int").withColumn("pieces", common.pieces_of(F.col("t")))
    got = {(r.a, r.n): r.p for r in df.select("a", "n", common.part_of(F.col("pieces"), F.col("a"), F.col("n")).alias("p")).collect()}
    assert got == {(a, n): text[a : a + n] for a, n in spans}
    assert spark.createDataFrame([("",)], "t string").select(common.pieces_of(F.col("t"))).first()[0] == [""]


def test_running_sums_and_maxima(spark):
    from docsync.llm import common
    from pyspark.sql import functions as F

    rng = random.Random(1)
    rows = [([rng.randint(0, 50) for _ in range(n)],) for n in (0, 1, 2, 3, 4, 5, 9, 10, 17, 100, 1000)]
    df = spark.createDataFrame(rows, "v array<bigint>")
    for r in df.select("v", common.running(F.col("v")).alias("s"), common.running(F.col("v"), most=True).alias("m")).collect():
        assert r.s == list(itertools.accumulate(r.v)) and r.m == list(itertools.accumulate(r.v, max))
