"""Spelling variants, centroid clustering and BPE against brute force, the public library and corner cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from parcelspark.llm import bpe, centroids, spelling
from parcelspark.llm import queries as llm

ROOT = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def variants(counts, factor=5):
    """word -> (n, n_near, form, form_n, root) by trying all pairs of words that share a half or a length."""
    words = sorted(counts)
    near = {w: [] for w in words}
    for i, a in enumerate(words):
        for b in words[i + 1:]:
            if abs(len(a) - len(b)) <= 1 and one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (counts[w], len(near[w]), form[w], counts[form[w]] if form[w] else None, root(w)) for w in words}


def shown(rows):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}


def test_spelling_query(spark):
    counts = Counter()
    for doc_id, text in duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{ROOT}/documents.parquet'").fetchall():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    expected = variants({w: n for w, n in counts.items() if n >= 5 and len(w) >= 6})
    assert any(v[2] for v in expected.values())
    assert shown(llm.queries()["op11_spelling_variants"](spark, ROOT).collect()) == expected


@pytest.mark.parametrize("pairs_of_key", [1, 6, 256])
def test_crowded_chunks_lose_no_pair(spark, pairs_of_key):
    rng = random.Random(2)
    words = {"a" * n for n in range(1, 14)} | {"ÿ" * 3, "b"}
    while len(words) < 220:
        w = "common" + "".join(rng.choice("ab") for _ in range(rng.randint(0, 6)))
        words.add(w if rng.random() < 0.7 else w[::-1])
    counts = {w: rng.choice([1, 5, 25, 130, 700]) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    got = spelling.group_variants(df, spelling.Settings(pairs_of_key=pairs_of_key))
    assert shown(got.collect()) == variants(counts)


def test_spelling_corners(spark):
    schema = "doc_id bigint, text string, word string, n string, root string"
    rows = [(1, None, "x", "x", "x"), (None, "Colour Colour", "x", "x", "x"), (2, "", "x", "x", "x"), (3, "colour " * 30_000, "x", "x", "x"),
            (3, "colour " * 30_000, "x", "x", "x"), (4, "Color color colors École école col0ur " * 5, "x", "x", "x"), (5, "k" * 40_000, "x", "x", "x")]
    docs = spark.createDataFrame(rows, schema)
    s = spelling.Settings(least_length=5)
    got = shown(spelling.group_variants(spelling.word_counts(docs, s), s).collect())
    assert got == {"colour": (60_002, 1, None, None, "colour"), "color": (10, 2, "colour", 60_002, "colour"),
                   "colors": (5, 1, None, None, "colors"), "École": (5, 1, None, None, "École"),
                   "école": (5, 1, None, None, "école")}
    assert spelling.group_variants(spelling.word_counts(docs.filter("false"), s), s).count() == 0


def plain_clusters(vectors, k=8, rounds=10, seed=3):
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in vectors
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    starts = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centre = [v for _, v in starts]

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centre)) for _, v in kept]

    for _ in range(rounds):
        who = assigned()
        for j in range(len(centre)):
            mine = [kept[i][1] for i, (_, g) in enumerate(who) if g == j]
            if mine:
                centre[j] = [sum(c) // len(mine) for c in zip(*mine)]
    who = assigned()
    inertia = Counter()
    for d, j in who:
        inertia[j] += d
    return sorted((str(i), j, d, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, centre[j])).encode()).hexdigest())
                  for (i, _), (d, j) in zip(kept, who))


def listed(rows):
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in rows)


def test_centroid_query(spark):
    vectors = duckdb.sql(f"SELECT vec_id, embedding FROM '{ROOT}/embeddings.parquet'").fetchall()
    assert listed(llm.queries()["op12_centroid_clustering"](spark, ROOT).collect()) == plain_clusters(vectors)


def test_threshold_walk_stops_early_and_breaks_ties():
    rng = np.random.default_rng(4)
    for spread, dims in ((3, 4), (50, 64)):
        centre = rng.integers(-spread, spread + 1, (9, dims))
        centre[5] = centre[2]  # a tie for every vector
        x = centre[rng.integers(0, 9, 500)] + rng.integers(-1, 2, (500, dims))
        distance = ((x[:, None] - centre[None]) ** 2).sum(2)
        who, best, steps = centroids.nearest(x, centre)
        assert (who == distance.argmin(1)).all() and (best == distance.min(1)).all()
    assert steps.max() < 9


def test_centroid_corners(spark):
    rng = random.Random(6)
    good = [[rng.uniform(-2, 2) for _ in range(64)] for _ in range(12)]
    nan, inf = float("nan"), float("inf")
    rows = [(i, v) for i, v in enumerate(good)] + [(3, good[3]), (3, good[4]), (None, good[5]), (20, None), (21, []), (22, good[0][:63]),
            (23, [*good[0], 1.0]), (24, [*good[0][:63], None]), (25, [*good[0][:63], nan]), (26, [*good[0][:63], -inf])]
    schema = "vec_id bigint, embedding array<double>, cluster string, distance string, of string, inertia string"
    df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], schema)
    assert listed(centroids.cluster(df).collect()) == plain_clusters(rows)
    for few in (df.filter("vec_id < 3"), df.filter("vec_id >= 20"), df.filter("false")):
        own = [(r.vec_id, r.embedding) for r in few.collect()]
        assert listed(centroids.cluster(few).collect()) == plain_clusters(own)
    assert centroids.cluster(df.filter("vec_id IS NULL")).count() == 0
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(spark.createDataFrame([(1, [1e300] * 64)], "vec_id bigint, embedding array<double>")).collect()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


def test_bpe_query(spark, library):
    got = {r.doc_id: r for r in llm.queries()["op13_bpe_coding"](spark, ROOT).collect()}
    for doc_id, text in duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{ROOT}/documents.parquet'").fetchall():
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert tuple(got.pop(doc_id))[1:] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                                              hashlib.sha256(decoded.encode()).hexdigest())
    assert not got


def test_bpe_on_odd_texts(vocabulary, library):
    rng = random.Random(1)
    texts = ["a<|endoftext|>b <|endoftext|><|endoftext|>", "", "   ", "a  b   \n\n c", "x" * 3000, "ab" * 5000, " " * 6000 + "a", "日本語" * 500,
             "\x00\x1c\x85  'S 's 'll'", "word " * 300_000]
    texts += ["".join(rng.choice("abcde '\n tsnl日é1") for _ in range(rng.randint(1, 60))) for _ in range(2000)]
    texts += ["".join(chr(rng.choice([rng.randint(1, 0x2FF), rng.randint(0x300, 0xD7FF), rng.randint(0xE000, 0x10FFFF)]))
                      for _ in range(rng.randint(1, 60))) for _ in range(300)]
    got = bpe.Encoder(vocabulary).encode(texts)
    for text, ids in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(got.pop(0), "<u4").tolist() == ids.ids, text[:60]


def test_words_begin_where_the_library_says(library, vocabulary):
    texts = [f"a{c}1{c}.{c} {c}{c}" for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000]
    encoder = bpe.Encoder(vocabulary)
    for start in range(0, len(texts), 30_000):
        part = texts[start:start + 30_000]
        want = [np.array(x.ids, "<u4").tobytes() for x in library.encode_batch(part, add_special_tokens=False)]
        assert encoder.encode(part) == want


def test_small_memory_and_pieces_change_nothing(vocabulary, monkeypatch):
    text = " ".join(f"w{i} Wort{i % 7}\n" for i in range(3000)) + "  end"
    whole = bpe.Encoder(vocabulary).encode([text, "tail", text])
    monkeypatch.setattr(bpe, "PIECE", 50)
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    monkeypatch.setattr(bpe, "SHORT", 3)  # failing words by the heap
    assert bpe.Encoder(vocabulary).encode([text, "tail", text]) == whole


def test_pair_check_equals_merging(vocabulary):
    rng = random.Random(9)
    a, b = (np.array([rng.randrange(50_000) for _ in range(4000)]) for _ in range(2))
    fits = vocabulary.compatible(a, b)
    for x, y, ok in zip(a.tolist(), b.tolist(), fits.tolist()):
        assert (vocabulary.merged(vocabulary.tokens[x] + vocabulary.tokens[y]) == [x, y]) == ok


def test_bpe_corners(spark, vocabulary, library):
    rows = [(1, None), (None, "no id"), (2, ""), (3, "long " * 40_000), (3, "long " * 40_000), (4, "<|endoftext|> é\n")]
    docs = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], "doc_id bigint, text string, ids string, n_tokens string, at string")
    coded = bpe.decode(bpe.encode(docs, vocabulary), vocabulary)
    got = sorted((str(r.doc_id), r.n_tokens, r.text) for r in coded.collect())
    assert got == sorted((str(i), len(library.encode(t or "", add_special_tokens=False).ids), t or "") for i, t in rows)
    assert bpe.encode(docs.filter("false"), vocabulary).count() == 0
    odd = spark.createDataFrame([(1, None), (2, bytearray(np.array([50_256, 4_000_000, 0, 0xFF], "<u4").tobytes()))], "k int, ids binary")
    found = {r.k: r.text for r in bpe.decode(odd, vocabulary).collect()}
    assert found == {1: "", 2: library.decode([50_256, 0, 0xFF], skip_special_tokens=False)}
    with pytest.raises(ValueError):
        bpe.decode(odd, vocabulary, out="k")
    with pytest.raises(ValueError):
        bpe.load_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
