"""Texts with many hits and conversations with many turns: whole results, in time that grows with their length."""

import time

from pyspark.sql import functions as F

from parcelspark.llm import chat, decontaminate
from parcelspark.llm.columns import window_hashes


def test_window_hashes_tell_windows_apart(spark):
    words = ["a", "b", "a", "b", "a", "c", "a", "b", "a", "b", "a"]
    for size in (1, 2, 3, 5, 8, 10, 11, 12):
        row = spark.range(1).select(window_hashes(F.lit(words), size).alias("h")).first().h
        windows = [tuple(words[i:i + size]) for i in range(len(words) - size + 1)]
        assert len(row) == len(windows)
        assert all((row[i] == row[j]) == (windows[i] == windows[j]) for i in range(len(row)) for j in range(len(row)))


def test_text_full_of_hits(spark):
    n = 40_000
    words = [f"w{i % 997}" for i in range(n)]
    items = spark.createDataFrame([(7, " ".join(words[:3000]))], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Before. " + " ".join(words) + " after"), (2, "clean words only")], "doc_id long, text string")
    began = time.time()
    found = {r.doc_id: r for r in decontaminate.find_hits(docs, items).collect()}
    assert time.time() - began < 30
    assert [(s.start, s.length) for s in found[1].spans] == [(i + 1, 10) for i in range(n - 9)]
    assert found[1].n_words == n + 2 and found[1]["items"] == [7] and found[2].spans == []
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, items, "spans").collect()}
    assert cut == {1: "Before. after", 2: "clean words only"}


def test_short_and_overlapping_items(spark):
    items = spark.createDataFrame([(1, "one two"), (2, "two three four"), (3, "two"), (4, None), (5, "..")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x one two three four y two"), (2, None), (3, "ONE-two")], "doc_id long, text string")
    for rows in (decontaminate.BROADCAST_ROWS, 0):
        found = {r.doc_id: r for r in decontaminate.find_hits(docs, items, broadcast_rows=rows).collect()}
        assert [(s.start, s.length) for s in found[1].spans] == [(1, 2), (2, 1), (2, 3), (6, 1)]
        assert sorted(found[1]["items"]) == [1, 2, 3] and found[2].spans == [] and found[2].n_words == 0
        assert [(s.start, s.length) for s in found[3].spans] == [(0, 2), (1, 1)]


def test_long_conversation(spark):
    n = 20_000
    texts = [f"ünï <| & &amp; {i} " + "z" * (5000 if i % 4999 == 0 else i % 7) for i in range(n)]
    role = [("user", "assistant", "assistant")[i % 3] for i in range(n)]
    turns = spark.createDataFrame([(1, i, role[i], texts[i]) for i in range(n)], "conv_id long, turn long, role string, text string")
    began = time.time()
    row = chat.format_chat(turns).withColumn("loss", chat.trained_text(F.col("formatted"), F.col("loss_spans"))) \
        .withColumn("turns", chat.read_chat(F.col("formatted"))).first()
    assert time.time() - began < 30
    assert [(t.role, t.text) for t in row.turns] == list(zip(role, texts))
    trained = [t for t, r in zip(texts, role) if r == "assistant"]
    assert row.loss == "".join(trained) and len(row.loss_spans) == len(trained)
    escaped = [t.replace("&", "&amp;").replace("<|", "&lt;|") for t in trained]
    assert [row.formatted[s.start - 1:s.start - 1 + s.length] for s in row.loss_spans] == escaped


def test_running_sums(spark):
    for values in ([], [3], [1, 2], [5, 0, 2, 7, 1], list(range(1000))):
        got = spark.range(1).select(chat.running_sums(F.lit(values).cast("array<int>") if values else F.array().cast("array<int>"))
                                    .alias("s")).first().s
        assert got == [sum(values[:i + 1]) for i in range(len(values))]
