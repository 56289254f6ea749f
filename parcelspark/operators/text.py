"""Message cleaning, n-grams, TF-IDF and the risk classifier."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import IDF, HashingTF
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.functions import text as tx
from parcelspark.operators.setops import union_all
from parcelspark.sources.tables import written


def strip_html(df: DataFrame, col: str, out: str) -> DataFrame:
    return df.withColumn(out, tx.html_stripped(col))


def email_subject_body(df: DataFrame, col: str, subject: str = "subject", body: str = "body") -> DataFrame:
    """Subject header and the part after the first blank line; a text without headers is all body."""
    c = F.regexp_replace(F.col(col), "\r\n", "\n")
    has_head = c.rlike(r"^[A-Za-z-]+:[^\n]*\n")
    found = F.regexp_extract(c, r"(?mi)^subject:[ \t]*([^\n]*)$", 1)
    blank = F.locate("\n\n", c)
    after = F.when(blank > 0, F.substring(c, blank + 2, F.length(c))).otherwise("")
    return df.withColumns({subject: F.when(has_head, found).otherwise(""),
                           body: F.when(has_head, after).otherwise(c)})


def scrub_text(df: DataFrame, col: str, out: str) -> DataFrame:
    return df.withColumn(out, tx.scrubbed(col))


def word_ngrams(df: DataFrame, col: str, sizes: Sequence[int] = (1, 2), out: str = "ngram") -> DataFrame:
    """One row per word run of the whole text; the text itself is not carried along."""
    words = df.withColumn("words_of_text", tx.words_of(col)).drop(col)
    runs = F.concat(*[tx.ngrams_of(F.col("words_of_text"), n) for n in sizes])
    return words.select(*[c for c in words.columns if c != "words_of_text"], F.explode(runs).alias(out))


def tfidf(terms: DataFrame, doc: str, term: str, materialize: Callable[[DataFrame], DataFrame] = written) -> DataFrame:
    """``(doc, term, tf, df, tfidf)`` with ``idf = ln((N + 1) / (df + 1))``; one input row per occurrence.

    Counts combine before the shuffle and are kept, so the texts are split once. The join by term meets few rows per term on the ``df`` side; a term that is in
    most documents makes one hot key on the other side, which Spark broadcasts around or AQE splits.
    """
    tf = materialize(terms.groupBy(doc, term).agg(F.count(F.lit(1)).alias("tf")))
    df = tf.groupBy(term).agg(F.count(F.lit(1)).alias("df"))
    total = tf.select(doc).distinct().count()
    idf = F.log((F.lit(float(total)) + 1.0) / (F.col("df") + 1.0))
    return tf.join(df, term).select(doc, term, "tf", "df", (F.col("tf") * idf).alias("tfidf"))


def union_labelled_sources(sources: Mapping[str, DataFrame], bad: Sequence[str], label: str = "label") -> DataFrame:
    """Put messages of many sources into one training set; sources named in ``bad`` are labelled 1."""
    return union_all(*[
        df.withColumns({"source_name": F.lit(name), label: F.lit(1 if name in bad else 0)})
        for name, df in sources.items()
    ])


def train_message_classifier(df: DataFrame, words: str, label: str = "label", kind: str = "elastic_net",
                             features: int = 1 << 14):
    """Risk classifier on hashed TF-IDF of word runs: elastic-net logistic regression or naive Bayes."""
    stages = [HashingTF(inputCol=words, outputCol="counts", numFeatures=features),
              IDF(inputCol="counts", outputCol="features")]
    if kind == "elastic_net":
        stages.append(LogisticRegression(labelCol=label, elasticNetParam=0.5, regParam=0.01, maxIter=20))
    elif kind == "naive_bayes":
        stages.append(NaiveBayes(labelCol=label))
    else:
        raise ValueError(f"unknown kind of classifier: {kind!r}")
    return Pipeline(stages=stages).fit(df)


def classification_metrics(df: DataFrame, keys: Sequence[str], label: str, prediction: str) -> DataFrame:
    """Recall, precision, accuracy and F1 from one pass; a measure whose denominator is 0 is NULL."""
    y, p = F.col(label) == 1, F.col(prediction) == 1

    def count(condition):
        return F.sum(F.when(condition, 1.0).otherwise(0.0))

    tp, fp, fn = count(y & p), count(~y & p), count(y & ~p)
    right = count(y == p)

    def ratio(a, b):
        return a / F.nullif(b, F.lit(0.0))

    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), ratio(tp, tp + fn).alias("recall"), ratio(tp, tp + fp).alias("precision"),
        ratio(right, F.count(F.lit(1)).cast("double")).alias("accuracy"),
        ratio(tp * 2.0, tp * 2.0 + fp + fn).alias("f1"))
