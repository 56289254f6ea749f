"""Queries of the subpackage against their SQL or a brute-force version, on the smallest data."""

import math
import zlib
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from parcelspark.llm import queries as llm
from suite.check import compare, connect
from suite.registry import ORACLES, QUERIES

ROOT = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT doc_id, coalesce(text, ''), source FROM '{ROOT}/documents.parquet'").fetchall()


def words(text):
    return [w.decode() for w in text.encode().split()]


@pytest.mark.parametrize("name", list(llm.oracle_sql()))
def test_against_sql(spark, name, monkeypatch):
    monkeypatch.setitem(QUERIES, name, llm.queries()[name])
    monkeypatch.setitem(ORACLES, name, llm.oracle_sql()[name])
    assert compare(spark, connect(ROOT), ROOT, name) == ""


def test_license_places(spark, documents):
    got = {r.doc_id: r for r in llm.queries()["op2_license_scans"](spark, ROOT).collect()}
    phrases = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}
    for doc_id, text, _ in documents:
        plain = "".join(c if ord(c) >= 128 or c.isalnum() else " " for c in text.translate(LOWER)).encode().split()
        plain = [w.decode() for w in plain]
        places = [(i, label) for p, label in phrases.items() for i in range(len(plain)) if tuple(plain[i:i + len(p)]) == p]
        row, starts = got[doc_id], [i for i, _ in places]
        assert (row.n_words, row.n_base) == (len(plain), len(places))
        assert (row.first_word, row.last_word) == (min(starts, default=None), max(starts, default=None))
        assert row.base_labels == ",".join(sorted({x for _, x in places}))
        assert {x for _, x in places} <= set(filter(None, row.labels.split(","))) and 0 <= row.score <= 1


def test_mix_meets_targets(spark, documents):
    rows = llm.queries()["op4_mixing"](spark, ROOT).collect()
    size = Counter()
    for _, text, source in documents:
        size[source] += len(words(text))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: [5, 2, 1][i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), 1.5 * sum(size.values())
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] > 2 * size[s]}
        target |= {s: 2.0 * size[s] for s in full} if full else share
        left -= sum(2.0 * size[s] for s in full)
        free = free - full if full else set()
    taken = Counter()
    for r in rows:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == size[r.source] and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in order)


def test_language_model(spark, documents):
    got = {r.doc_id: r for r in llm.queries()["op5_lm_scoring"](spark, ROOT).collect()}
    tokens = {i: [*words(t.translate(LOWER)), None] for i, t, _ in documents}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    c = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in tokens.items():
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)
        assert got[i].base_score == pytest.approx(base, rel=1e-9)
        assert (got[i].held_out, got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (
            held[i], len(ws), sum(c[w] > 0 for w in ws), n)
    assert sum(r.score for r in got.values() if r.held_out) > sum(r.base_score for r in got.values() if r.held_out)


def test_near_duplicates(spark, documents):
    sets = {}
    for i, t, _ in documents:
        w = words(t)
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    got = {r.doc_id: r for r in llm.queries()["op9_near_dedup"](spark, ROOT).collect()}
    assert {i: r.class_id for i, r in got.items()} == {i: root(i) for i in sets}
    assert all(r.kept == (r.class_id == i) for i, r in got.items())


def test_toxicity_on_held_out_rows(spark):
    root = "/root/testdata/sf0.1"
    toxic = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{root}/labels.parquet'").fetchall())
    rows = [r for r in llm.queries()["op10_toxicity"](spark, root).collect() if r.held_out and r.doc_id in toxic]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert sum(r.predicted == toxic[r.doc_id] for r in rows) >= 0.97 * len(rows)
    found = [r.predicted for r in rows if toxic[r.doc_id]]
    assert sum(found) >= 0.9 * len(found)


def test_pipeline_stages(spark, documents):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    rows, columns = docs, docs.columns
    ids = {i for i, _, _ in documents}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        rows = stage(spark, rows, ROOT)
        assert rows.columns[:len(columns)] == columns and (k == 4 or rows.columns == columns)
        left = {r.doc_id for r in rows.select("doc_id").collect()}
        assert left <= ids
        ids = left
    assert ids and {r.doc_id for r in corpus_pipeline.run(spark, ROOT).select("doc_id").collect()} == ids
