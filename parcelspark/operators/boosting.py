"""Boosted trees with gamma loss and a log link for all segments at once, grown from histograms that are plain aggregates.

A feature is cut into quantile bins per segment. A level of the trees of all segments is one aggregate: rows and summed
ratios of price to scored price by (segment, node, feature, bin), which Spark combines before the shuffle. A leaf's best step and
the worth of a split follow from the two in closed form, so no step overshoots however far the prices spread. The best split of each node is a window
over that small table. Rows of a segment that share all bins share every node and score, so they are one cell with their number and summed price: there are
at most as many cells as rows, and as bins to the power of the features in a segment.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.operators.segments import number_in, price_of, training_rows, with_model
from parcelspark.operators.windows import top1
from parcelspark.sources.tables import written


@dataclass(frozen=True)
class TreeSettings:
    trees: int = 20
    depth: int = 3
    rate: float = 0.3
    bins: int = 32
    least_rows: int = 20  # on both sides of a split
    ridge: float = 1.0  # rows at the scored price that each side counts beside its own


def bin_of(value: Column, edges: Column) -> Column:
    """0 for a missing value, else one more than the number of edges below it."""
    return F.when(value.isNull(), F.lit(0)).otherwise(F.size(F.filter(edges, lambda e: e < value)) + 1)


def leaf_of(bins: Column, feature: Column, cut: Column, steps: int) -> Column:
    """The node (1 is the root, 2n and 2n + 1 follow n) that a row reaches after ``steps`` splits; no split goes left."""
    def down(node: Column, _: Column) -> Column:
        f = F.element_at(feature, node)
        right = (f >= 0) & (F.element_at(bins, F.greatest(f, F.lit(0)) + 1) > F.element_at(cut, node))
        return node * 2 + right.cast("int")

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.lit(1), down) if steps else F.lit(1)


@dataclass(frozen=True)
class SegmentTrees:
    """``table``: model_segment, n, start, edges (of each feature) and trees (feature, cut and value by node), a row per segment."""

    segment: str
    features: list[str]
    settings: TreeSettings
    table: DataFrame

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with a price per row; missing features go with the lowest values. Rows of a segment without a model get NULL."""
        met = with_model(df, self.segment, self.table)
        bins = F.array(*[bin_of(number_in(met.row[c]), F.col("edges")[i]) for i, c in enumerate(self.features)])
        depth = self.settings.depth
        score = F.aggregate("trees", F.col("start"), lambda s, t: s + F.element_at(t["value"], leaf_of(F.col("bins"), t["feature"], t["cut"], depth)))
        return met.select("row", "start", "trees", bins.alias("bins")) \
            .select("row.*", price_of(score).alias(out))


def _quantiles(rows: DataFrame, features: Sequence[str], settings: TreeSettings, edges: Mapping[str, Sequence[float]] | None) -> DataFrame:
    """model_segment, n, start and the sorted edges of each feature's bins: given ones, or quantiles of the segment."""
    shares = [(i + 1) / settings.bins for i in range(settings.bins - 1)]
    none = F.array().cast("array<double>")

    def cut(i: int, c: str) -> Column:
        if edges is not None:
            return F.array(*[F.lit(float(e)) for e in sorted(set(edges[c]))]) if edges[c] else none
        return F.coalesce(F.array_sort(F.array_distinct(F.percentile_approx(F.col("x")[i], shares, 10_000))), none)

    return written(rows.groupBy("model_segment").agg(
        F.count(F.lit(1)).alias("n"), F.log(F.avg("y")).alias("start"), F.array(*[cut(i, c) for i, c in enumerate(features)]).alias("edges")))


def worth(ratio: Column, n: Column, ridge: float) -> Column:
    """How much the best constant of a leaf lowers its loss: ``n`` rows whose prices are ``ratio`` times the scored ones in sum.

    A step v makes the loss ratio * exp(-v) + n * v, so the best is log(ratio / n); ``ridge`` adds rows that are scored right.
    """
    r, m = ratio + ridge, n + ridge
    return r - m - m * F.log(r / m)


def split_gains(rows: DataFrame, settings: TreeSettings) -> DataFrame:
    """The best split of each node: model_segment, node, feature, cut (bins beyond it go right), gain, and the steps left and right.

    ``rows`` have model_segment, node, n (training rows that one stands for), ratio (their prices over the scored one, summed) and bins. Nodes without a split that gains have feature -1
    and one step, left. Ties go to the first feature and the lowest cut.
    """
    cells = rows.select("model_segment", "node", "n", "ratio", F.posexplode("bins").alias("feature", "bin")) \
        .groupBy("model_segment", "node", "feature", "bin").agg(F.sum("ratio").alias("ratio"), F.sum("n").alias("n"))
    node = Window.partitionBy("model_segment", "node", "feature")
    upto = node.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = cells.select("model_segment", "node", "feature", "bin", *[F.sum(c).over(w).alias(f"{s}_{c}")
                        for s, w in (("left", upto), ("all", node)) for c in ("ratio", "n")]) \
        .withColumns({"right_ratio": F.col("all_ratio") - F.col("left_ratio"), "right_n": F.col("all_n") - F.col("left_n")})

    def measured(side: str) -> Column:
        # a side's ratio may come out a hair below zero where all its prices are next to nothing
        return worth(F.greatest(F.col(f"{side}_ratio"), F.lit(0.0)) + 1e-12, F.col(f"{side}_n"), settings.ridge)

    gain = measured("left") + measured("right") - measured("all")
    allowed = (F.col("left_n") >= settings.least_rows) & (F.col("right_n") >= settings.least_rows) & (gain > 1e-9)
    scored = sums.withColumn("gain", F.when(allowed, gain))
    best = top1(scored, ["model_segment", "node"], [F.col("gain").desc_nulls_last(), "feature", "bin"])
    split = F.col("gain").isNotNull()

    def step(side: str) -> Column:
        return F.lit(settings.rate) * F.log((F.greatest(F.col(f"{side}_ratio"), F.lit(0.0)) + 1e-12 + settings.ridge) / (F.col(f"{side}_n") + settings.ridge))

    return best.select("model_segment", "node", F.when(split, F.col("feature")).otherwise(-1).alias("feature"),
                       F.when(split, F.col("bin")).otherwise(0).alias("cut"), "gain", F.when(split, step("left")).otherwise(step("all")).alias("left"),
                       F.when(split, step("right")).alias("right"))


def _grow(scored: DataFrame, segments: DataFrame, settings: TreeSettings) -> DataFrame:
    """One tree per segment: model_segment, feature, cut and value by node."""
    size = 2 ** (settings.depth + 1)
    tree = segments.select("model_segment", F.array_repeat(F.lit(-1), size).alias("feature"), F.array_repeat(F.lit(0), size).alias("cut"),
                           F.array_repeat(F.lit(0.0), size).alias("value"))
    for level in range(settings.depth):
        known = tree.select(F.col("model_segment").alias("of"), "feature", "cut")
        placed = scored.join(known, F.col("model_segment").eqNullSafe(F.col("of"))).select(
            "model_segment", leaf_of(F.col("bins"), F.col("feature"), F.col("cut"), level).alias("node"),
            "n", (F.col("y") * F.exp(-F.col("score"))).alias("ratio"), "bins")
        made = split_gains(placed, settings).groupBy("model_segment").agg(
            F.map_from_entries(F.collect_list(F.struct("node", F.struct("feature", "cut", "left", "right")))).alias("made")) \
            .withColumnRenamed("model_segment", "of")
        met = tree.join(made, F.col("model_segment").eqNullSafe(F.col("of")), "left")

        def filled(column: str) -> Column:
            return F.transform(column, lambda v, i: F.coalesce(F.try_element_at("made", i + 1)[column], v))

        parent = lambda i: F.try_element_at("made", F.floor((i + 1) / F.lit(2)).cast("int"))
        values = F.transform("value", lambda v, i: F.coalesce(
            F.when((i + 1) % 2 == 0, parent(i)["left"]).otherwise(parent(i)["right"]), v))
        tree = written(met.select("model_segment", filled("feature").alias("feature"), filled("cut").alias("cut"),
                                  (values if level == settings.depth - 1 else F.col("value")).alias("value")))
    return tree


def train_segment_trees(df: DataFrame, segment: str, features: Sequence[str], label: str = "close_price",
                        settings: TreeSettings = TreeSettings(), edges: Mapping[str, Sequence[float]] | None = None) -> SegmentTrees:
    """Fit boosted trees that minimise the gamma deviance of the price, in every segment.

    Rows without a price above zero do not train; missing features go with the lowest values of theirs. ``edges`` gives the bins of each
    feature instead of quantiles. The rows are read once for quantiles and once for cells; a level is one pass over the cells, a tree one
    table of them; a table is read by the next tree only. An empty table gives no models.
    """
    features = list(features)
    rows = training_rows(df, segment, features, label)
    shape = _quantiles(rows, features, settings, edges)
    of = shape.withColumnRenamed("model_segment", "of")
    bins = F.array(*[bin_of(F.col("x")[i], F.col("edges")[i]) for i in range(len(features))]).cast("array<smallint>")
    scored = written(rows.join(of, F.col("model_segment").eqNullSafe(F.col("of")))
                     .select("model_segment", "y", F.col("start").alias("score"), bins.alias("bins"))
                     .groupBy("model_segment", "score", "bins").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y")))
    model = shape.withColumn("trees", F.array().cast("array<struct<feature:array<int>,cut:array<int>,value:array<double>>>"))
    for k in range(0 if shape.isEmpty() else settings.trees):
        tree = _grow(scored, shape, settings).withColumnRenamed("model_segment", "of")
        if k < settings.trees - 1:
            added = F.element_at("value", leaf_of(F.col("bins"), F.col("feature"), F.col("cut"), settings.depth))
            scored = written(scored.join(tree, F.col("model_segment").eqNullSafe(F.col("of")))
                             .select("model_segment", "n", "y", (F.col("score") + added).alias("score"), "bins"))
        grown = F.concat("trees", F.array(F.struct("feature", "cut", "value")))
        model = model.join(tree, F.col("model_segment").eqNullSafe(F.col("of"))).select("model_segment", "n", "start", "edges", grown.alias("trees"))
        model = written(model)
    return SegmentTrees(segment, features, settings, model)
