"""Price models of all segments at once: gamma regressions with a log link, fitted by aggregates per segment.

A gamma regression with a log link weighs all rows alike, so the cross products of the features are summed once per segment and each
iteration is one aggregate of residuals. Segments are keys of those aggregates: their number costs no jobs, and a segment
that holds most rows is summed by all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark.sources.tables import written

#: Exponents beyond this are cut off: a price of e^300 is an overflow, not a price.
MOST_LOG = 300.0


def number(name: str) -> Column:
    """A feature as a double; NaN is missing."""
    value = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(value), value)


def price_of(score: Column) -> Column:
    """The price of a score, NULL for none (``least`` would pass over it)."""
    return F.exp(F.when(score > MOST_LOG, MOST_LOG).otherwise(score))


def add_all(terms: Sequence[Column]) -> Column:
    """A sum as a flat tree of additions, so that many terms make no deep expression."""
    terms = list(terms)
    while len(terms) > 1:
        terms = [reduce(lambda a, b: a + b, terms[i:i + 2]) for i in range(0, len(terms), 2)]
    return terms[0]


def with_model(df: DataFrame, segment: str, table: DataFrame) -> DataFrame:
    """``df`` as a struct ``row``, with the columns of the segment's model row or NULLs; a NULL segment is one of its own."""
    rows = df.select(F.struct("*").alias("row"))
    return rows.join(table, rows.row[segment].eqNullSafe(table["model_segment"]), "left")


def training_rows(df: DataFrame, segment: str, features: Sequence[str], label: str) -> DataFrame:
    """Segment, label and features of the rows that train: those with a price above zero, written once for all passes."""
    price = number(label)
    return written(df.select(F.col(segment).alias("model_segment"), price.alias("y"), F.array(*[number(c) for c in features]).alias("x"))
                   .filter(F.col("y") > 0))


@dataclass(frozen=True)
class SegmentRegressions:
    """``table``: model_segment, n, beta, center, scale, gaps, one row per segment. It grows with segments times features only."""

    segment: str
    features: list[str]
    gaps: list[int]  # features with missing values in training: each has a 0/1 term of its own
    table: DataFrame

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with a price per row. A missing feature counts as the segment's mean; rows of a segment without a model get NULL."""
        met = with_model(df, self.segment, self.table)
        x = [number_in(met.row[c]) for c in self.features]
        eta = add_all([t * F.col("beta")[i] for i, t in enumerate(terms(x, self.gaps))])
        return met.select("row.*", price_of(eta).alias(out))


    def effect(self, df: DataFrame, feature: str, grid: Sequence[float]) -> DataFrame:
        """segment, value, mean_prediction: the mean price of each segment's rows if ``feature`` had each value of ``grid`` in all of them.

        The price is a product, so the factor of the other terms is averaged once and each grid value is one more factor: one pass
        over the rows, not one a value. Segments without a model have no rows.
        """
        j = self.features.index(feature)
        met = with_model(df, self.segment, self.table).filter(F.col("beta").isNotNull())
        x = [number_in(met.row[c]) for c in self.features]
        own = {1 + j} | {1 + len(self.features) + i for i, g in enumerate(self.gaps) if g == j}
        rest = add_all([t * F.col("beta")[i] for i, t in enumerate(terms(x, self.gaps)) if i not in own])
        # a segment's model is the same in all its rows, so any of them will do
        base = met.groupBy("model_segment").agg(F.avg(price_of(rest)).alias("base"), *[F.first(c).alias(c) for c in ("beta", "center", "scale")])
        values = base.withColumn("value", F.explode(F.array(*[F.lit(float(v)) for v in grid])))
        factor = F.exp(F.col("beta")[1 + j] * (F.col("value") - F.col("center")[j]) / F.col("scale")[j])
        return values.select(F.col("model_segment").alias(self.segment), "value", (F.col("base") * factor).alias("mean_prediction"))


def number_in(value: Column) -> Column:
    value = value.cast("double")
    return F.when(~F.isnan(value), value)


def terms(x: Sequence[Column], gaps: Sequence[int]) -> list[Column]:
    """One, the features (centred, scaled, missing ones at the mean) and the 0/1 terms of those with gaps."""
    scaled = [F.coalesce((v - F.col("center")[i]) / F.col("scale")[i], F.lit(0.0)) for i, v in enumerate(x)]
    return [F.lit(1.0), *scaled, *[x[i].isNull().cast("double") for i in gaps]]


def _pseudo_inverses(grams: DataFrame) -> DataFrame:
    """model_segment, inverse: of each segment's matrix of cross products; repeated or constant terms share their weight."""
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for rows in batch.column(1).to_pylist():
                a = np.array([r["products"] for r in rows])
                out.append(np.linalg.pinv((a + a.T) / 2, rcond=1e-11, hermitian=True).tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.list_(pa.float64())))], ["model_segment", "inverse"])

    kind = grams.schema["model_segment"].dataType.simpleString()
    return grams.mapInArrow(solve, f"model_segment {kind}, inverse array<array<double>>")


def train_segments(df: DataFrame, segment: str, features: Sequence[str], label: str = "close_price", iterations: int = 50,
                   tolerance: float = 1e-9) -> SegmentRegressions:
    """Fit price on features in every segment: the regressions that minimise the gamma deviance, log link.

    Rows without a price above zero do not train. A missing feature counts as the segment's mean, with a 0/1 term beside it where
    the training rows have gaps. Terms without spread in a segment, or that others make up, are allowed. Rounds go on until no
    coefficient of any segment moves by more than ``tolerance``. An empty table gives no models.
    """
    features = list(features)
    rows = training_rows(df, segment, features, label)
    count = rows.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.col("x")[i]).alias(f"c{i}") for i in range(len(features))]).first()
    gaps = [i for i in range(len(features)) if count[f"c{i}"] < count["n"]]
    x = [F.col("x")[i] for i in range(len(features))]
    spread = [F.stddev_pop(v) for v in x]
    shape = written(rows.groupBy("model_segment").agg(
        F.array(*[F.coalesce(F.avg(v), F.lit(0.0)) for v in x]).alias("center"),
        F.array(*[F.when(s > 1e-9 * F.abs(F.avg(v)), s).otherwise(F.lit(1.0)) for v, s in zip(x, spread)]).alias("scale"),
        F.count(F.lit(1)).alias("n"), F.avg(F.log("y")).alias("level")))
    of = shape.withColumnRenamed("model_segment", "of")
    scaled = written(rows.join(of, F.col("model_segment").eqNullSafe(F.col("of")))
                     .select("model_segment", "y", F.array(*terms(x, gaps)).alias("x")))
    size = 1 + len(features) + len(gaps)
    # row i of the cross products: one aggregate of as many sums as there are terms
    products = scaled.select("model_segment", "x", F.posexplode("x").alias("i", "xi")).groupBy("model_segment", "i").agg(
        F.array(*[F.sum(F.col("xi") * F.col("x")[j]) for j in range(size)]).alias("products"))
    inverses = written(_pseudo_inverses(products.groupBy("model_segment").agg(
        F.array_sort(F.collect_list(F.struct("i", "products"))).alias("rows"))))

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    def solved(pulled: DataFrame, before: Column) -> DataFrame:
        """The coefficients after adding inverse times the summed pull of the rows."""
        sums = pulled.groupBy("model_segment").agg(F.array(*[F.sum(F.col("x")[i] * F.col("pull")) for i in range(size)]).alias("pull"),
                                                   F.first("beta").alias("beta"))
        inverse = inverses.withColumnRenamed("model_segment", "of")
        step = F.transform("inverse", lambda r: dot(r, F.col("pull")))
        return written(sums.join(inverse, F.col("model_segment").eqNullSafe(F.col("of"))).select("model_segment", step.alias("step"), "beta")
                       .select("model_segment", F.zip_with(before, "step", lambda b, s: b + s).alias("beta"),
                               F.array_max(F.transform("step", F.abs)).alias("moved")))

    zero = F.array(*[F.lit(0.0)] * size)
    # the first round fits the logarithm of the price, the next ones the price itself
    models = solved(scaled.withColumns({"pull": F.log("y"), "beta": zero}), zero)
    for _ in range(iterations):
        known = models.select(F.col("model_segment").alias("of"), "beta")
        met = scaled.join(known, F.col("model_segment").eqNullSafe(F.col("of")))
        eta = add_all([F.col("x")[i] * F.col("beta")[i] for i in range(size)])
        pull = F.col("y") / F.exp(F.greatest(F.lit(-MOST_LOG), F.least(eta, F.lit(MOST_LOG)))) - 1
        models = solved(met.select("model_segment", "x", "beta", pull.alias("pull")), F.col("beta"))
        furthest = models.agg(F.max("moved")).first()[0]
        if furthest is None or furthest <= tolerance:
            break
    joined = models.join(of, F.col("model_segment").eqNullSafe(F.col("of")))
    return SegmentRegressions(segment, features, gaps, written(joined.select("model_segment", "n", "beta", "center", "scale")))
