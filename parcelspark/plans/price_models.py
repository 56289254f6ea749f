"""The price-model round over all segments: train blueprints, rank them on the holdout, refit the best, score the unsold rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.operators.boosting import TreeSettings, train_segment_trees
from parcelspark.operators.models import ALLOWED_FEATURE_LISTS, FULL_SAMPLE_PCT, holdout_mape, pick_best_model, split_tvh
from parcelspark.operators.segments import train_segments
from parcelspark.operators.setops import union_all
from parcelspark.sources.tables import replace_table, written

#: A blueprint: rows, segment column, features, label -> a model of all segments with ``transform(df, out)``.
Blueprint = Callable[[DataFrame, str, Sequence[str], str], object]

TRAIN_PCT = 96


def regression(df: DataFrame, segment: str, features: Sequence[str], label: str):
    return train_segments(df, segment, features, label)


def boosted_trees(settings: TreeSettings = TreeSettings()) -> Blueprint:
    return lambda df, segment, features, label: train_segment_trees(df, segment, features, label, settings)


def leaderboard(df: DataFrame, segment: str, key: str, label: str, blueprints: Mapping[str, Blueprint],
                feature_lists: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per segment, blueprint and feature list, trained on 96 % of the rows, with its error on the 2 % holdout.

    project_name, blueprint_id, featurelist_name, model_id, sample_pct, holdout_mape. A blueprint is fitted for all segments at a time.
    Segments without holdout rows, or without training rows, have no error and so no rank.
    """
    parts = written(split_tvh(df, key))
    train, holdout = parts.filter("part = 'train'").drop("part"), parts.filter("part = 'holdout'").drop("part")
    boards = []
    for blueprint, fit in blueprints.items():
        for name, features in feature_lists.items():
            judged = fit(train, segment, features, label).transform(holdout, "predicted_price")
            error = holdout_mape(judged, [segment], label, "predicted_price", "holdout_mape")
            boards.append(error.select(
                F.col(segment).alias("project_name"), F.lit(blueprint).alias("blueprint_id"), F.lit(name).alias("featurelist_name"),
                F.concat_ws("/", F.lit(blueprint), F.lit(name)).alias("model_id"), F.lit(TRAIN_PCT).alias("sample_pct"), "holdout_mape"))
    return union_all(*boards)


@dataclass(frozen=True)
class SegmentScorer:
    """The refitted models: ``choice`` has the model_id of each segment, ``models`` the models by id, each of its own segments."""

    segment: str
    choice: DataFrame
    models: dict[str, object]

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with a price per row, in one pass. Every row comes back; those of segments without a model have NULL."""
        columns = [f"{out}_of_{i}" for i in range(len(self.models))]
        scored = reduce(lambda d, m: m[1].transform(d, m[0]), zip(columns, self.models.values()), df)
        price = F.coalesce(*[F.col(f"`{c}`") for c in columns]) if columns else F.lit(None).cast("double")
        return scored.withColumn(out, price).drop(*columns)


def refit_best(df: DataFrame, segment: str, label: str, board: DataFrame, blueprints: Mapping[str, Blueprint],
               feature_lists: Mapping[str, Sequence[str]]) -> SegmentScorer:
    """Fit each segment's best model of ``board`` again on all rows of the segment: one fit a model, for the segments that chose it."""
    best = pick_best_model(board, list(feature_lists), TRAIN_PCT)
    choice = written(best.select(F.col("project_name").alias("chosen_segment"), F.col("best_model_id").alias("model_id")))
    wanted = {r.model_id for r in choice.select("model_id").distinct().collect()}  # at most blueprints times feature lists
    models = {}
    for blueprint, fit in blueprints.items():
        for name, features in feature_lists.items():
            model_id = f"{blueprint}/{name}"
            if model_id in wanted:
                own = choice.filter(F.col("model_id") == model_id).select("chosen_segment")
                rows = df.join(own, F.col(segment).eqNullSafe(F.col("chosen_segment")), "left_semi")
                models[model_id] = fit(rows, segment, features, label)
    return SegmentScorer(segment, choice, models)


def price_round(sold: DataFrame, unsold: DataFrame, segment: str, key: str, label: str, blueprints: Mapping[str, Blueprint],
                feature_lists: Mapping[str, Sequence[str]], passthrough: Sequence[str], target: str) -> tuple[DataFrame, DataFrame]:
    """``(leaderboard, predictions)``: the whole round, with the predictions written to ``target``.

    The leaderboard has the rows of the first training and, for the refitted models, a row each with 100 % of the rows and the
    holdout error they were chosen by, so that ``pick_best_model`` finds them.
    """
    unknown = set(feature_lists) - set(ALLOWED_FEATURE_LISTS)
    if unknown:
        raise ValueError(f"models of these feature lists may not be chosen: {sorted(unknown)}")
    board = written(leaderboard(sold, segment, key, label, blueprints, feature_lists))
    scorer = refit_best(sold, segment, label, board, blueprints, feature_lists)
    picked = scorer.choice.withColumnRenamed("model_id", "picked")
    full = board.join(picked, F.col("project_name").eqNullSafe(F.col("chosen_segment")) & (F.col("model_id") == F.col("picked")), "left_semi") \
        .withColumn("sample_pct", F.lit(FULL_SAMPLE_PCT))
    return board.unionByName(full), replace_table(scorer.transform(unsold).select(*passthrough, "prediction"), target)
