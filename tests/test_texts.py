"""Cleaning without limits of depth or script, and naive Bayes against plain loops."""

import math
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from parcelspark.functions import text as tx
from parcelspark.operators import classifier as cl
from parcelspark.operators import text as ot


def cleaned(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    return [r.clean for r in ot.strip_html(df, "html", "clean").orderBy("i").collect()]


def test_empty_elements_and_attributes_of_any_number(spark):
    deep = "<p>" * 40 + "<b></b> <i> </i>" + "</p>" * 40
    wide = "<ul>" + "<li><span></span></li>" * 30 + "</ul>"
    many = "<td " + " ".join(f'id="{i}"' for i in range(12)) + " class width=3 name>x</td>"
    pages = [deep, f"<div>{wide}{deep}</div>text", many, '<p data-id="7" lang=\'class="b"\' hidden>x</p>', "a < b > c", None, "",
             "<div><p><b></b></p><i></i></div>", "<br/><p/ id=3>t", "<div><span></div></span>", "1 <p>", "<P CLASS=x><B></b></P>y",
             "<a href=x><p>gone</p></a><img src=x><p title>stays</p>"]
    assert cleaned(spark, pages) == [
        "", "text", "<td width=3>x</td>", '<p data-id="7" lang=\'class="b"\' hidden>x</p>', "a < b > c", None, "", "", "<br/><p/>t",
        "<div><span></div></span>", "1 <p>", "y", "<p>stays</p>"]


def test_every_text_keeps_something(spark):
    odd = [chr(c) for c in range(0xA0, 0x3100) if unicodedata.category(chr(c))[0] not in "CMZ"] + ["東", "\U0001F600", "ﬃ", "Ａ"]
    rows = spark.createDataFrame(list(enumerate(odd)), "i int, t string")
    got = {odd[r.i]: r.p for r in ot.scrub_text(rows, "t", "p").collect()}
    marks_only = {c for c, p in got.items() if p == ""}
    # spacing accents decompose to a blank and a mark
    assert all(unicodedata.normalize("NFKD", c)[0] == " " for c in marks_only)
    assert all(p.isascii() for p in got.values())
    assert [got[c] for c in ("Щ", "щ", "й", "ψ", "Ψ", "ά", "Ⅻ", "ﬃ", "Ａ", "東", "№", "²", "½", "Ǆ")] == [
        "Shch", "shch", "y", "ps", "Ps", "a", "XII", "ffi", "A", "?", "No", "2", "1/2", "DZ"]
    df = spark.createDataFrame([(None,), ("",), ("Привет,  мир​ é!",)], "t string")
    assert [r.p for r in ot.scrub_text(df, "t", "p").collect()] == [None, "", "Privet, mir e!"]


def test_maps_are_one_to_one_in_length():
    assert len(tx.ACCENTED + tx.ONE_LETTER) == len(tx.BASE + tx.ONE_LETTER_BASE)
    assert not set(tx.ONE_LETTER) & set(tx.ACCENTED)


def test_dictionary_is_dense_and_sorted(spark):
    terms = spark.createDataFrame([(w,) for w in ["b", "a", "é", None, "b", "", "zz", "a b"] * 3], "ngram string")
    got = cl.dictionary(terms)
    assert [tuple(r) for r in got.orderBy("term_id").collect()] == [(w, i) for i, w in enumerate(["", "a", "a b", "b", "zz", "é"])]
    many = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("ngram"))
    ids = [r.term_id for r in cl.dictionary(many.union(many)).orderBy("ngram").collect()]
    assert ids == list(range(5000))
    assert cl.dictionary(terms.filter("false")).count() == 0


def test_naive_bayes_equals_plain_loops(spark):
    texts = {1: (1, "a a b"), 2: (0, "b c"), 3: (1, "a d"), 4: (0, "c c e e"), 5: (0, ""), 6: (1, "f"), 7: (None, "a c"), 8: (0, "a x")}
    docs = spark.createDataFrame([(i, y, i % 3) for i, (y, _) in texts.items()], "doc int, label int, fold int")
    terms = spark.createDataFrame([(i, w) for i, (_, t) in texts.items() for w in t.split()], "doc int, ngram string")

    def expected(i, left_out):
        seen = {j: v for j, v in texts.items() if v[0] is not None and (left_out is None or j % 3 != left_out)}
        n = [Counter(w for y, t in seen.values() if y == k for w in t.split()) for k in (0, 1)]
        known = set(n[0]) | set(n[1])
        d = [sum(y == k for y, _ in seen.values()) for k in (0, 1)]
        total = [sum(c.values()) + len(known) for c in n]
        return math.log((d[1] + 1) / (d[0] + 1)) + sum(
            math.log((n[1][w] + 1) / total[1]) - math.log((n[0][w] + 1) / total[0]) for w in texts[i][1].split() if w in known)

    model = cl.train_naive_bayes(docs, terms, "doc", "label", fold="fold", folds=3)
    for fold, out in (("fold", lambda i: i % 3), (None, lambda i: None)):
        got = {r.doc: r for r in model.score(docs, terms, "doc", fold).collect()}
        assert set(got) == set(texts)
        for i, r in got.items():
            assert r.score == pytest.approx(expected(i, out(i)), abs=1e-9) and r.prediction == int(r.score > 0)
    none = cl.train_naive_bayes(docs.filter("false"), terms, "doc", "label")
    assert {r.score for r in none.score(docs, terms, "doc").collect()} == {0.0}


def test_training_numbers_terms_and_shuffles_them_once(spark):
    docs = spark.createDataFrame([(1, 0, 0), (2, 1, 1), (3, 1, 0), (4, None, 1)], "doc_id int, label int, fold int")
    terms = spark.createDataFrame([(1, "b"), (1, "b"), (1, "a"), (2, "a"), (3, "c"), (3, None), (4, "b"), (9, "z")], "doc_id int, ngram string")
    model = cl.train_naive_bayes(docs, terms, "doc_id", "label", fold="fold", folds=2)
    assert [(r.ngram, r.term_id) for r in model.table.orderBy("term_id").collect()] == [("a", 0), ("b", 1), ("c", 2)]
    odds = {r.ngram: r.odds for r in model.table.collect()}
    scored = model.score(docs, terms, "doc_id", "fold")
    assert {r.doc_id: pytest.approx(r.score) for r in scored.collect()} == {
        d: model.priors[f] + sum(odds[t][f] or 0.0 for t in said if t in odds)
        for d, f, said in ((1, 0, "bba"), (2, 1, "a"), (3, 0, "c"), (4, 1, "b"))}
    # occurrences meet the odds as they are, without a count by document and term first
    assert "count(1)" not in scored._jdf.queryExecution().optimizedPlan().toString()
