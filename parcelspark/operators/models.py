"""Data steps around price models: segments, features, splits, training, choice and scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark.operators.aggregates import argmin_model
from parcelspark.operators.setops import bucket_of, whole_key
from parcelspark.sources.tables import written

# Metro segments and the metro codes each one covers.
METRO_SEGMENTS = {
    "Hawaii": [27980, 25900, 46520, 28180],
    "Alaska": [11260, 21820, 27940, 28540],
    "Grand_rapids": [24340, 26090],
    "Oklahoma": [36420, 46140, 44660, 43060],
    "Indianapolis": [26900, 14020, 18020],
    "Punta_gorda": [35840, 39460, 15980],
    "Naples_keywest": [34940, 28580],
    "Richmond": [40060],
    "Columbus": [18140],
    "Washington": [47900],
    "Tucson": [46060],
    "Tampa": [45300],
    "Seattle": [42660],
    "Saint_louis": [41180],
    "San_francisco": [41860],
    "San_diego": [41740],
    "San_antonio": [41700],
    "Sacramento": [40900],
    "Riverside": [40140],
    "Raleigh": [39580],
    "Portland": [38900],
    "Pittsburgh": [38300],
    "Phoenix": [38060],
    "Philadelphia": [37980],
    "Orlando": [36740],
    "New_york": [35620],
    "Nashville": [34980],
    "Minneapolis": [33460],
    "Miami_fort": [33100],
    "Los_angeles": [31080],
    "Las_vegas": [29820],
    "Jacksonville": [27260],
    "Houston": [26420],
    "Fort_collins": [22660],
    "Detroit": [19820],
    "Denver": [19740],
    "Dallas_fort": [19100],
    "Cleveland": [17460],
    "Colorado_springs": [17820],
    "Cincinnati": [17140],
    "Chicago": [16980],
    "Charlotte": [16740],
    "Baltimore": [12580],
    "Boston": [14460],
    "Atlanta": [12060],
    "Austin": [12420],
}
REST_SEGMENT = "no_big_ma"

# Metro codes of the cities with photo scores.
PHOTO_CITIES = {"austin": 12420, "atlanta": 12060, "seattle": 42660}

# Feature lists a model may use to be chosen, and the share of rows a final model is trained on.
ALLOWED_FEATURE_LISTS = ["All_trends", "Statical_list"]
PHOTO_FEATURE_LISTS = ["Statical_list_photos"]
FULL_SAMPLE_PCT = 100

# Columns that are no features of any model, and those that the reduced feature list leaves out as well.
NO_FEATURES = [
    "listing_id", "close_dt", "close_dt (Year)", "close_dt (Month)", "close_dt (Day of Week)",
    "close_dt (Day of Month)", "latitude", "longitude", "geometry",
]
LEFT_OUT_OF_STATICAL_LIST = [
    "public_water", "well_water", "other_water_source", "no_water_source", "private_water", "not_connected_water",
    "culinary_water", "stucco_materials", "ceramic_floorings", "tile_floorings", "wood_materials", "garage_parking",
    "fiberglass_roof_type", "wood_floorings", "no_floorings_info", "carpet_floorings", "hardwood_floorings",
    "linoleum_floorings", "laminate_floorings", "vinyl_floorings", "carport_parking", "street_parking",
    "assigned_parking", "two_car_parking", "attached_parking", "door_opener_parking", "guest_parking",
    "driveway_parking", "no_construction_materials", "other_floorings", "no_parking_features", "other_roof_type",
    "shingle_roof_type", "tile_roof_type", "composition_roof_type", "asphalt_roof_type", "metal_roof_type",
    "architectural_roof_type", "pitched_roof_type", "flat_roof_type", "concrete_roof_type", "slate_roof_type",
    "wood_roof_type", "underground_utilities", "sewer", "natural_gas", "vinyl_materials", "brick_materials",
    "aluminum_materials", "frame_materials", "site_built_materials", "block_materials", "concrete_materials",
    "cement_materials", "no_roof_type", "other_construction_materials", "stone_materials", "detached_parking",
]


def segment_names(suffixes: Sequence[str] = ("_combined_not_sold", "_combined")) -> list[str]:
    """Dataset names of all segments: name, metro codes and suffix."""
    stems = [f"{name}_{', '.join(str(c) for c in codes)}" for name, codes in METRO_SEGMENTS.items()]
    return [stem + suffix for suffix in suffixes for stem in stems]


def segment_by_metro(df: DataFrame, segments: Mapping[str, Sequence[int]], code: str, out: str = "segment",
                     rest: str = REST_SEGMENT) -> DataFrame:
    """The segment of each row's metro code; codes of no segment go to ``rest``.

    The map is a literal (its size is the length of ``segments``), so no join is needed.
    """
    pairs = [item for name, codes in segments.items() for c in codes for item in (F.lit(int(c)), F.lit(name))]
    if not pairs:
        return df.withColumn(out, F.lit(rest))
    found = F.try_element_at(F.create_map(*pairs), F.col(code).cast("int"))
    return df.withColumn(out, F.coalesce(found, F.lit(rest)))


def select_features(df: DataFrame, exclude: Sequence[str] = (), key: str | None = None) -> DataFrame:
    """Drop the excluded columns and those without information: all NULL, one single value or, with ``key``, the same in every
    row as an earlier column of the same type.

    One aggregate row decides: minimum, maximum and, to find repeated columns, an exclusive or over the rows of a 64-bit hash of the
    value and the row's key (unique, else equal rows cancel out). Arrays, maps and structs are not features.
    """
    excluded = set(exclude)
    plain = [f for f in df.schema.fields
             if f.name not in excluded and f.dataType.typeName() not in ("array", "map", "struct")]
    if not plain:
        return df.select()

    def measures(c: str) -> Column:
        value = F.col(f"`{c}`")
        mark = F.bit_xor(F.xxhash64(F.lit(1), value, F.col(key)) if key else F.lit(0))
        return F.struct(F.min(value).alias("low"), F.max(value).alias("high"), (F.count(value) == F.count(F.lit(1))).alias("complete"),
                        mark.alias("mark"))

    row = df.agg(*[measures(f.name).alias(f"c{i}") for i, f in enumerate(plain)]).first()
    informative, seen = [], set()
    for i, f in enumerate(plain):
        c = row[f"c{i}"]
        if c.low is None or (c.low == c.high and c.complete):
            continue
        if key and (f.dataType, c.mark) in seen:
            continue
        seen.add((f.dataType, c.mark))
        informative.append(F.col(f"`{f.name}`"))
    return df.select(*informative)


def split_tvh(df: DataFrame, key: str, validation_pct: int = 2, holdout_pct: int = 2, out: str = "part") -> DataFrame:
    """Mark each row as train, validation or holdout by its key: repeatable, and equal keys stay together.

    Text keys are hashed first."""
    bucket = bucket_of(whole_key(df, key), 100)
    part = (F.when(bucket < validation_pct, "validation")
            .when(bucket < validation_pct + holdout_pct, "holdout").otherwise("train"))
    return df.withColumn(out, part)


def train_price_model(df: DataFrame, features: Sequence[str], label: str = "close_price", kind: str = "gamma",
                      iterations: int | None = None, depth: int = 5):
    """Fit price on features: ``gamma`` is a log-link gamma regression (it minimises the gamma deviance), ``trees`` are
    boosted trees, which Spark fits by squared error. Both train distributed.

    Rows without a label do not train. A missing feature counts as the column's mean, and columns with missing values
    when training get a 0/1 column that says so; a column without any value is left out. Every row is scored.
    ``iterations`` are 25 (gamma) or 20 (trees) unless given.
    """
    # stored, as each iteration reads them: only what is needed of them
    rows = written(df.filter(F.col(label).isNotNull()).select(label, *features))
    present = [F.count(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))).alias(c) for c in features]
    count = rows.agg(F.count(F.lit(1)).alias("_rows"), *present).first()
    used = [c for c in features if count[c]]
    gaps = [c for c in used if count[c] < count["_rows"]]
    columns = [f"CAST(`{c}` AS DOUBLE) AS `{c}_input`" for c in used] + [
        f"CAST(`{c}` IS NULL OR isnan(CAST(`{c}` AS DOUBLE)) AS DOUBLE) AS `{c}_missing`" for c in gaps]
    inputs = SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")
    filled = Imputer(inputCols=[f"{c}_input" for c in used], outputCols=[f"{c}_filled" for c in used])
    assembler = VectorAssembler(inputCols=[f"{c}_filled" for c in used] + [f"{c}_missing" for c in gaps],
                                outputCol="features")
    if kind == "gamma":
        learner = GeneralizedLinearRegression(family="gamma", link="log", labelCol=label, maxIter=iterations or 25,
                                              regParam=1e-6)
    elif kind == "trees":
        learner = GBTRegressor(labelCol=label, maxIter=iterations or 20, maxDepth=depth, seed=7)
    else:
        raise ValueError(f"unknown kind of model: {kind!r}")
    prepared = Pipeline(stages=[inputs, filled, assembler]).fit(rows)
    # kept as vectors: the learners go over them many times, a gamma regression with every iteration
    vectors = prepared.transform(rows).select(label, "features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return PipelineModel(stages=[*prepared.stages, learner.fit(vectors)])
    finally:
        vectors.unpersist()


def _eligible(leaderboard: DataFrame, feature_lists: Sequence[str], sample_pct: int) -> DataFrame:
    full = F.floor(F.col("sample_pct")) == F.lit(sample_pct)
    return leaderboard.filter(full & F.col("featurelist_name").isin(list(feature_lists)))


def pick_best_model(leaderboard: DataFrame, feature_lists: Sequence[str] = tuple(ALLOWED_FEATURE_LISTS),
                    sample_pct: int = FULL_SAMPLE_PCT) -> DataFrame:
    """Per project the fully trained model of an allowed feature list with the lowest holdout MAPE."""
    eligible = _eligible(leaderboard, feature_lists, sample_pct)
    return argmin_model(eligible, ["project_name"], "holdout_mape", "model_id", "best_model_id")


def prune_models(leaderboard: DataFrame, feature_lists: Sequence[str] = tuple(ALLOWED_FEATURE_LISTS),
                 sample_pct: int = FULL_SAMPLE_PCT) -> tuple[DataFrame, DataFrame]:
    """``(kept, deletable)``: kept are all models whose blueprint is among the eligible ones of the project."""
    keys = ["project_name", "blueprint_id"]
    wanted = _eligible(leaderboard, feature_lists, sample_pct).select(*keys).distinct()
    return leaderboard.join(wanted, keys, "left_semi"), leaderboard.join(wanted, keys, "left_anti")


def score_batch(model, df: DataFrame, passthrough: Sequence[str] = ("listing_id", "close_dt")) -> DataFrame:
    return model.transform(df).select(*passthrough, "prediction")


def feature_effect(model, df: DataFrame, feature: str, grid: Sequence[float]) -> DataFrame:
    """Mean prediction when ``feature`` is set to each grid value on all rows (one pass, rows times grid length)."""
    values = F.explode(F.array(*[F.lit(float(g)) for g in grid]))
    varied = df.drop(feature).withColumn(feature, values)
    scored = model.transform(varied)
    return scored.groupBy(feature).agg(F.avg("prediction").alias("mean_prediction")).orderBy(feature)


def holdout_mape(df: DataFrame, keys: Sequence[str], actual: str, predicted: str, out: str = "mape") -> DataFrame:
    """Mean absolute error relative to the actual value; rows with an actual value of 0 have none."""
    error = F.abs((F.col(actual) - F.col(predicted)) / F.nullif(F.col(actual), F.lit(0.0)))
    return df.groupBy(*keys).agg(F.avg(error).alias(out))


def gamma_deviance(df: DataFrame, keys: Sequence[str], actual: str, predicted: str,
                   out: str = "gamma_deviance") -> DataFrame:
    y, m = F.col(actual), F.col(predicted)
    return df.groupBy(*keys).agg((F.lit(2.0) * F.avg(-F.log(y / m) + (y - m) / m)).alias(out))


def route_scoring_input(df: DataFrame, segment: str, rest: str = REST_SEGMENT,
                        rest_route: tuple[str, str] = ("not_sold", "no_big_metroareas_last_nonzeros")) -> DataFrame:
    """Input schema, input table and output table by segment name; the rest segment has a table of its own."""
    name = F.col(segment)
    is_rest = F.lower(name).contains(rest.lower())
    return df.withColumns({
        "input_schema": F.when(is_rest, rest_route[0]).otherwise(F.concat(name, F.lit("_not_sold"))),
        "input_table": F.when(is_rest, rest_route[1]).otherwise(F.concat(name, F.lit("_us_last"))),
        "output_table": F.when(is_rest, F.concat(name, F.lit("_predictions")))
        .otherwise(F.concat(F.lit("us_"), name, F.lit("_predictions"))),
    })
