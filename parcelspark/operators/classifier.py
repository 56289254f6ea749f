"""The message classifier in plain aggregates: a dictionary of word runs, naive Bayes over all of them, and its out-of-fold judgement."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.sources.tables import written

#: Bits of ``monotonically_increasing_id`` that count the rows of a partition.
ROW_BITS = 33


def dictionary(terms: DataFrame, term: str = "ngram", out: str = "term_id", materialize: Callable[[DataFrame], DataFrame] = written) -> DataFrame:
    """``(term, out)``: the distinct terms with dense numbers from 0, in text order; NULL is no term.

    Terms are sorted by ranges, numbered within their range, and shifted by the number of terms in earlier ranges. Only the
    sizes of the ranges, as many as there are shuffle partitions, meet in one place.
    """
    return _numbered(terms.select(term).filter(F.col(term).isNotNull()).distinct(), term, out, materialize)


def _numbered(listed: DataFrame, term: str, out: str, materialize: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows of distinct terms with their numbers; other columns travel along."""
    place = F.monotonically_increasing_id()
    ranged = materialize(listed.repartitionByRange(F.col(term)).sortWithinPartitions(term).withColumn("place", place))
    piece = F.shiftright("place", ROW_BITS)
    sizes = ranged.groupBy(piece.alias("piece")).agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("piece", before.alias("start"))
    number = (F.col("start") + F.col("place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))).cast("long").alias(out)
    return ranged.withColumn("piece", piece).join(starts, "piece").select(*listed.columns, number)


@dataclass(frozen=True)
class FoldedNaiveBayes:
    """``table``: term_id, ``term`` and odds, one entry per model; ``priors`` as many.

    Model k knows all folds but k, and the last model all of them. A term that a model has not seen has no odds there.
    """

    term: str
    folds: int
    table: DataFrame
    priors: list[float]

    def score(self, docs: DataFrame, terms: DataFrame, doc: str, fold: str | None = None, out: str = "score") -> DataFrame:
        """``docs`` with the log-odds of label 1 and the prediction, by the model that leaves out the document's ``fold``, or by the
        one that knows all. Terms that the model does not know say nothing; documents without terms have the prior."""
        which = F.col(fold) if fold else F.lit(self.folds)
        known = docs.select(F.col(doc).alias("of_doc"), which.alias("model")).distinct()
        # the model first, so that of a term's odds only the one needed goes on to the document
        placed = terms.join(known, F.col(doc) == F.col("of_doc")).select("of_doc", "model", self.term)
        sums = placed.join(self.table.select(self.term, "odds"), self.term).groupBy("of_doc").agg(F.sum(F.get("odds", F.col("model"))).alias("said"))
        prior = F.get(F.array(*[F.lit(p) for p in self.priors]), which)
        scored = docs.join(sums, F.col(doc) == F.col("of_doc"), "left").withColumn(out, prior + F.coalesce("said", F.lit(0.0))).drop("of_doc", "said")
        return scored.withColumn("prediction", (F.col(out) > 0).cast("int"))


def train_naive_bayes(docs: DataFrame, terms: DataFrame, doc: str, label: str, term: str = "ngram", fold: str | None = None, folds: int = 0,
                      smoothing: float = 1.0, materialize: Callable[[DataFrame], DataFrame] = written) -> FoldedNaiveBayes:
    """Multinomial naive Bayes over every term of ``terms`` (doc, term; a row per occurrence), with labels 0 and 1 in ``docs``.

    No term is hashed into a bucket or left out. With ``fold`` (whole numbers below ``folds``) the models that leave out one fold each come
    from the same pass: a fold's counts are taken off the sums of all. Documents without a label do not train.
    """
    models = folds + 1 if fold else 1
    count = folds if fold else 0
    marked = docs.filter(F.col(label).isin(0, 1)).select(
        F.col(doc).alias("of_doc"), F.col(label).cast("int").alias("label"), (F.col(fold) if fold else F.lit(0)).cast("int").alias("fold"))
    rows = terms.join(marked, F.col(doc) == F.col("of_doc"))

    def sums(y: int) -> Column:
        """Of one class, the occurrences that each model has seen."""
        of_class = F.col("label") == y
        left_out = [F.sum(F.when(of_class & (F.col("fold") != k), 1).otherwise(0)) for k in range(count)]
        return F.array(*left_out, F.sum(F.when(of_class, 1).otherwise(0)))

    counts = materialize(rows.groupBy(term).agg(sums(0).alias("n0"), sums(1).alias("n1")))
    size = counts.agg(*[F.coalesce(F.sum(F.col(f"n{y}")[k]), F.lit(0)).alias(f"n{y}_{k}") for y in (0, 1) for k in range(models)],
                      *[F.coalesce(F.sum((F.col("n0")[k] + F.col("n1")[k] > 0).cast("int")), F.lit(0)).alias(f"v_{k}") for k in range(models)]).first()
    docs_seen = marked.agg(*[F.coalesce(F.sum(F.when((F.col("label") == y) & (F.lit(k == count) | (F.col("fold") != k)), 1).otherwise(0)), F.lit(0))
                             .alias(f"d{y}_{k}") for y in (0, 1) for k in range(models)]).first()

    def odds(k: int) -> Column:
        share = [(F.col(f"n{y}")[k] + smoothing) / F.lit(float(size[f"n{y}_{k}"] + smoothing * max(1, size[f"v_{k}"]))) for y in (0, 1)]
        return F.when(F.col("n0")[k] + F.col("n1")[k] > 0, F.log(share[1]) - F.log(share[0]))

    priors = [math.log((docs_seen[f"d1_{k}"] + smoothing) / (docs_seen[f"d0_{k}"] + smoothing)) for k in range(models)]
    numbered = _numbered(counts.filter(F.col(term).isNotNull()), term, "term_id", materialize)
    table = materialize(numbered.select("term_id", term, F.array(*[odds(k) for k in range(models)]).alias("odds")))
    return FoldedNaiveBayes(term, count, table, priors)
