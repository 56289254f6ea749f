"""Models of all segments: against closed forms, a plain-Python tree grower and the squared-error trees."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelspark.operators import boosting as bo
from parcelspark.operators import models as md
from parcelspark.operators import segments as sg
from parcelspark.plans import price_models as pm
from parcelspark.session import scratch_path

SCHEMA = "id bigint, seg string, u double, v double, c int, close_price double, n string, beta string, row string"


def made_up(n=600, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        seg = rng.choice(["a", "a", "a", "b", None])
        u, c = rng.uniform(0, 10), rng.randrange(3)
        v = None if rng.random() < 0.1 else float("nan") if rng.random() < 0.05 else rng.gauss(0, 1)
        gap = v is None or math.isnan(v)
        mean = math.exp(2 + 0.1 * u + (0.8 if gap else 0.3 * v) + (0.5 * (c == 1) * (u > 4) if seg == "a" else 0))
        rows.append((i, seg, u, v, c, mean * rng.gammavariate(8, 1 / 8), "x", "x", "x"))
    return rows + [(n, "a", 1.0, 1.0, 1, None, "x", "x", "x"), (n + 1, "a", 1.0, 1.0, 1, 0.0, "x", "x", "x"),
                   (n + 2, "b", None, None, None, -3.0, "x", "x", "x")]


@pytest.fixture(scope="module")
def homes(spark):
    return spark.createDataFrame(made_up(), SCHEMA).cache()


def deviance(rows, column="prediction"):
    """Of the whole table, the mean gamma deviance."""
    y, m = (np.array([r[c] for r in rows]) for c in ("close_price", column))
    return 2 * float(np.mean(-np.log(y / m) + (y - m) / m))


def test_regression_solves_the_score_equations(homes):
    model = sg.train_segments(homes, "seg", ["u", "v", "c"])
    rows = [r for r in model.transform(homes).collect() if r.close_price is not None and r.close_price > 0]
    assert len(rows) == 600
    for seg in ("a", "b", None):
        own = [r for r in rows if r.seg == seg]
        pull = np.array([r.close_price / r.prediction - 1 for r in own])
        missing = np.array([float(r.v is None or math.isnan(r.v)) for r in own])
        v = np.array([0.0 if m else r.v for r, m in zip(own, missing)])
        for term in (np.ones(len(own)), np.array([r.u for r in own]), v, np.array([float(r.c) for r in own]), missing):
            assert abs((term * pull).sum()) < 1e-4 * np.abs(term).sum()


def test_every_row_is_scored_where_there_is_a_model(spark, homes):
    model = sg.train_segments(homes.filter("seg = 'a'"), "seg", ["u", "v", "c"], iterations=2)
    trees = bo.train_segment_trees(homes.filter("seg = 'a'"), "seg", ["u", "v", "c"], settings=bo.TreeSettings(trees=1, depth=2))
    odd = spark.createDataFrame([(1, "a", None, None, None, None, "x", "x", "x"), (2, "z", 1.0, 1.0, 1, 5.0, "x", "x", "x"),
                                 (3, None, 1.0, 1.0, 1, 5.0, "x", "x", "x"), (3, "a", float("nan"), 1.0, 1, None, "x", "x", "x")], SCHEMA)
    for m in (model, trees):
        scored = m.transform(odd)
        assert scored.columns == [*odd.columns, "prediction"]
        got = sorted((r.id, str(r.seg), r.prediction is not None) for r in scored.collect())
        assert got == [(1, "a", True), (2, "z", False), (3, "None", False), (3, "a", True)]
    for train in (sg.train_segments, bo.train_segment_trees):
        none = train(homes.filter("false"), "seg", ["u", "v"])
        assert none.table.count() == 0 and none.transform(odd).filter("prediction IS NOT NULL").count() == 0


def test_effect_equals_scoring_every_row_at_every_value(homes):
    model = sg.train_segments(homes, "seg", ["u", "v", "c"], iterations=4)
    grid = [-1.0, 0.0, 2.5]
    for feature in ("u", "v"):
        got = {(r.seg, r.value): r.mean_prediction for r in model.effect(homes, feature, grid).collect()}
        assert len(got) == 9
        for value in grid:
            for r in model.transform(homes.withColumn(feature, F.lit(value))).groupBy("seg").agg(F.avg("prediction").alias("p")).collect():
                assert got[r.seg, value] == pytest.approx(r.p, rel=1e-9)


def test_terms_without_spread_and_repeated_terms(spark):
    rows = [(i, "a", float(i % 2), float(i % 2), 7, 10.0 if i % 2 else 20.0, "x", "x", "x") for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    for r in sg.train_segments(df, "seg", ["u", "v", "c"]).transform(df).collect():
        assert r.prediction == pytest.approx(r.close_price, rel=1e-9)


def grown(rows, features, settings, edges):
    """Scores of the rows (close_price and features) after boosting, by plain loops."""
    bins = [[0 if r[f] is None or math.isnan(r[f]) else 1 + sum(e < r[f] for e in edges[f]) for f in features] for r in rows]
    y = [r["close_price"] for r in rows]
    score = [math.log(sum(y) / len(y))] * len(y)
    for _ in range(settings.trees):
        node = [1] * len(y)
        ratio = [a * math.exp(-s) for a, s in zip(y, score)]
        for level in range(settings.depth):
            split = {}
            for k in set(node):
                own = [i for i in range(len(y)) if node[i] == k]
                best = (1e-9, None)
                for f in range(len(features)):
                    for cut in sorted({bins[i][f] for i in own}):
                        left = [i for i in own if bins[i][f] <= cut]
                        right = [i for i in own if bins[i][f] > cut]
                        if min(len(left), len(right)) < settings.least_rows:
                            continue

                        def worth(part):
                            r, m = sum(ratio[i] for i in part) + settings.ridge, len(part) + settings.ridge
                            return r - m - m * math.log(r / m)

                        gain = worth(left) + worth(right) - worth(own)
                        if gain > best[0] + 1e-9:
                            best = (gain, (f, cut))
                split[k] = best[1]
            node = [2 * k + (split[k] is not None and bins[i][split[k][0]] > split[k][1]) for i, k in enumerate(node)]
        for k in set(node):
            own = [i for i in range(len(y)) if node[i] == k]
            step = settings.rate * math.log((sum(ratio[i] for i in own) + settings.ridge) / (len(own) + settings.ridge))
            for i in own:
                score[i] += step
    return [math.exp(s) for s in score]


def test_trees_equal_a_plain_grower(homes):
    settings = bo.TreeSettings(trees=3, depth=3, least_rows=8)
    features = ["u", "v", "c"]
    edges = {"u": [1, 2, 3.5, 5, 7, 9], "v": [-1, -0.5, 0, 0.3, 1], "c": [0, 1]}
    model = bo.train_segment_trees(homes, "seg", features, settings=settings, edges=edges)
    got = [r for r in model.transform(homes).collect() if r.close_price is not None and r.close_price > 0]
    for seg in ("a", "b", None):
        own = sorted((r for r in got if r.seg == seg), key=lambda r: r.id)
        assert [r.prediction for r in own] == pytest.approx(grown(own, features, settings, edges), rel=1e-8)


def test_trees_are_grown_from_cells_not_rows(spark, monkeypatch):
    rows = [(i, "a" if i % 3 else None, float(i % 2), float(i % 5), i, 10.0 + i % 7, "x", "x", "x") for i in range(300)]
    grow, sizes = bo._grow, []

    def seen(scored, segments, settings):
        sizes.append(scored.count())
        return grow(scored, segments, settings)

    monkeypatch.setattr(bo, "_grow", seen)
    model = bo.train_segment_trees(spark.createDataFrame(rows, SCHEMA), "seg", ["u", "v"], settings=bo.TreeSettings(trees=2, depth=2, least_rows=8))
    assert sizes == [20, 20]  # two segments of 2 x 5 pairs of bins
    assert {r.model_segment: r.n for r in model.table.collect()} == {"a": 200, None: 100}


def test_gamma_trees_beat_squared_error_trees_on_the_holdout(spark):
    df = spark.createDataFrame(made_up(4000, 5), SCHEMA).filter("close_price > 0").withColumn("close_price", F.col("close_price") * F.exp("u"))
    parts = md.split_tvh(df, "id", 0, 25)
    train, rest = parts.filter("part = 'train'"), parts.filter("part = 'holdout'")
    ours = bo.train_segment_trees(train.withColumn("seg", F.lit("all")), "seg", ["u", "v", "c"], settings=bo.TreeSettings(trees=10, depth=3))
    gamma = deviance(ours.transform(rest.withColumn("seg", F.lit("all"))).collect())
    theirs = md.train_price_model(train, ["u", "v", "c"], kind="trees", iterations=10, depth=3).transform(rest)
    squared = deviance(theirs.withColumn("prediction", F.greatest("prediction", F.lit(1.0))).collect())
    assert gamma < squared


def test_round_refits_the_best_on_all_rows(spark, homes):
    sold = homes.filter("close_price > 0")
    lists = {"All_trends": ["u", "v", "c"], "Statical_list": ["c"]}
    blueprints = {"regression": lambda *a: sg.train_segments(*a, iterations=3, tolerance=0.0), "trees": pm.boosted_trees(bo.TreeSettings(trees=2, depth=2))}
    board, scored = pm.price_round(sold, homes, "seg", "id", "close_price", blueprints, lists, ["id"], scratch_path(spark, "predictions"))
    assert sorted(r.id for r in scored.collect()) == sorted(r.id for r in homes.collect())
    assert scored.filter("prediction IS NULL").count() == 0
    full = md.pick_best_model(board)
    first = md.pick_best_model(board, sample_pct=96)
    assert sorted(map(str, full.collect())) == sorted(map(str, first.collect())) and full.count() == 3
    # a segment's price is that of its best model fitted to the segment alone
    for r in full.collect():
        name, features = r.best_model_id.split("/")
        own = sold.filter(F.col("seg").eqNullSafe(F.lit(r.project_name)))
        alone = blueprints[name](own, "seg", lists[features], "close_price").transform(own, "alone").select("id", "alone")
        for x in alone.join(scored, "id").collect():
            assert x.prediction == pytest.approx(x.alone, rel=1e-7)
    with pytest.raises(ValueError):
        pm.price_round(sold, homes, "seg", "id", "close_price", blueprints, {"Mine": ["u"]}, ["id"], scratch_path(spark, "predictions"))


@pytest.mark.parametrize("kind", ["gamma", "trees"])
def test_one_model_scores_rows_with_gaps(spark, homes, kind):
    """Gaps in training only, in scoring only and in all rows."""
    none = homes.withColumn("v", F.lit(None).cast("double"))
    whole = homes.filter("v IS NOT NULL AND NOT isnan(v)")
    for train, rest in ((homes, whole), (whole, homes), (none, homes), (homes, none)):
        model = md.train_price_model(train.filter("close_price > 0"), ["u", "v"], kind=kind, iterations=2)
        out = md.score_batch(model, rest, ["id"])
        assert sorted(r.id for r in out.collect()) == sorted(r.id for r in rest.collect())
        assert out.filter("prediction IS NULL OR isnan(prediction)").count() == 0


@pytest.mark.parametrize("kind", ["gamma", "trees"])
def test_learners_go_over_kept_vectors(spark, monkeypatch, kind):
    seen, before = [], len(spark.sparkContext._jsc.getPersistentRDDs())
    for learner in (md.GeneralizedLinearRegression, md.GBTRegressor):
        def fit(self, dataset, params=None, known=learner.fit):
            seen.append((sorted(dataset.columns), dataset.storageLevel.useMemory))
            return known(self, dataset, params)
        monkeypatch.setattr(learner, "fit", fit)
    rows = spark.createDataFrame([(float(i % 7) if i % 5 else None, float(i % 3), 100.0 + 10 * (i % 7) + i % 3) for i in range(200)], "a double, b double, close_price double")
    model = md.train_price_model(rows, ["a", "b"], kind=kind, iterations=5)
    assert seen == [(["close_price", "features"], True)]
    scored = model.transform(rows.drop("close_price"))
    assert scored.count() == 200 and scored.filter("prediction IS NULL").count() == 0
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before
