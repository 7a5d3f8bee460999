"""Spans inside one row: results for any length, and time for very many."""

import time

import pytest
from pyspark.sql import functions as F

from quayside.llm import chat, running, secrets


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 200, 5000])
def test_running_sums(spark, n):
    frame = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(max(1, n))), lambda x: x % 7).alias("a"))
    frame = frame.select(F.col("a") if n else F.array().cast("array<int>").alias("a"))
    got = frame.select(running.running(F.col("a"), F.lit(0), lambda s, x: s + x, lambda s, x: F.when(x > 2, F.array(s + x)).otherwise(F.array().cast("array<int>")), "array<int>")).first()[0]
    want, at = [], 0
    for x in range(1, n + 1):
        at += x % 7
        want += [at] if x % 7 > 2 else []
    assert got == want


def test_texts_are_cut_out(spark):
    text = "".join(f"é{i}|" for i in range(700))
    spans, at = [], 0
    for i in range(700):
        spans.append((at, at + len(f"é{i}")))
        at += len(f"é{i}|")
    frame = spark.createDataFrame([(text, spans), ("x", [])], "t string, s array<struct<a:int,b:int>>")
    got = frame.select(running.cut_out(F.col("t"), F.col("s"), lambda s: s["a"], lambda s: s["b"])).collect()
    assert got[0][0] == [f"é{i}" for i in range(700)] and got[1][0] == []


def test_very_many_matches_in_one_text(spark):
    n = 32_000
    frame = spark.range(1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("password = hunter2222 \n"), n).alias("text"))
    took = []
    for job in (lambda: secrets.summary(secrets.scan(frame)), lambda: secrets.redact(frame)):
        began = time.monotonic()
        row = job().first()
        took.append(time.monotonic() - began)
        if "n_assign" in row:
            assert row["n_assign"] == n and row["spans"].endswith(f"assign:{23 * (n - 1)}:{23 * (n - 1) + 21}")
        else:
            assert row["text"] == "[SECRET] \n" * n
    assert max(took) < 20, took


def test_a_very_long_conversation(spark):
    n = 4000
    turns = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"), F.concat(F.lit("text <"), F.col("id").cast("string")).alias("text"))
    back = chat.read_back(chat.format_conversations(turns)).first()
    assert [t["text"] for t in back["turns"]] == [f"text <{i}" for i in range(n)]
    assert back["learned"] == [f"text <{i}" for i in range(1, n, 2)] and back["valid"]
