"""Near duplicates: what moves and what meets, beside the classes."""

import random

from pyspark.sql import functions as F

from parcelspark.llm import near_dedup


def test_parts_of_one_group_rarely_meet_by_shingles(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(130)]
    texts = []
    for i in range(600):
        own = list(base)
        at = rng.randrange(100)
        for k in range(rng.randint(0, 20)):
            own[at + k] = f"v{i}x{k}"
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    met, rare_pairs = [], near_dedup.rare_pairs
    monkeypatch.setattr(near_dedup, "rare_pairs", lambda *a: met.append(rare_pairs(*a)) or met[-1])
    assert near_dedup.near_duplicates(docs).count() == len(texts)
    assert met[0].count() < 2 * len(texts)  # 4,410 with one pivot a bucket


def test_texts_that_are_not_wanted_are_not_moved(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(2000)] + [(3, "text 3"), (None, "text 8"), (8, None)], "doc_id long, text string")
    rows = docs.select(near_dedup.node_of(F.col("doc_id"), F.col("text")).alias("t_node"))
    nodes = rows.filter("t_node.id % 50 = 3").distinct().toDF("node")
    marked = near_dedup.marked_rows(rows, nodes)
    assert marked.join(nodes, F.col("t_node") == F.col("node")).count() == 41
    assert marked.count() < 60
    assert near_dedup.texts_of_nodes(docs, nodes).count() == 40


def test_new_links_merge_known_components(spark):
    node = "struct<id: bigint, text_key: bigint>"
    def n(i): return (i, 0)
    found = spark.createDataFrame([(n(1), n(1)), (n(2), n(1)), (n(5), n(5)), (n(6), n(5)), (n(8), n(8)), (n(9), n(8))], f"node {node}, component {node}")
    fresh = spark.createDataFrame([(n(2), n(6)), (n(4), n(7)), (n(3), n(9))], f"a {node}, b {node}")
    got = {r.node.id: r.component.id for r in near_dedup.merged(found, fresh).collect()}
    assert got == {1: 1, 2: 1, 5: 1, 6: 1, 4: 4, 7: 4, 3: 3, 8: 3, 9: 3}
