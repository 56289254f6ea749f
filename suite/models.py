"""Model-data steps on customers, parts and lines."""

from pyspark.sql import functions as F

from parcelspark.functions.scalars import round_half_up
from parcelspark.operators import models as md
from suite.groups import bucket_sql
from suite.registry import query
from suite.sources import PRICE_FEATURES, priced_lines

ALL_CODES = [c for codes in md.METRO_SEGMENTS.values() for c in codes]
METRO_OF = ("SELECT c_custkey, CAST(CASE c_custkey % 70 "
            + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(ALL_CODES))
            + " WHEN 69 THEN NULL ELSE 99999 END AS BIGINT) AS cbsa FROM {customer}")
SEGMENT_CASE = ("CASE " + " ".join(f"WHEN cbsa IN ({', '.join(map(str, c))}) THEN '{n}'"
                                   for n, c in md.METRO_SEGMENTS.items()) + " ELSE 'no_big_ma' END")


@query("segment_by_metro", f"SELECT c_custkey, cbsa, {SEGMENT_CASE} AS segment FROM ({METRO_OF}) x")
def segment_by_metro(t):
    return md.segment_by_metro(t.sql(METRO_OF), md.METRO_SEGMENTS, "cbsa")


@query("select_features", """SELECT c_nationkey, c_acctbal, c_mktsegment,
CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE NULL END AS half FROM {customer}""")
def select_features(t):
    df = t.customer.withColumns({"fixed": F.lit(5), "nothing": F.lit(None).cast("double"),
                                 "half": F.when(F.col("c_custkey") % 2 == 0, 1), "list": F.array("c_custkey")})
    return md.select_features(df, ["c_custkey", "c_name"])


@query("select_features_once", """SELECT c_custkey, c_nationkey, c_acctbal, CASE WHEN c_custkey % 2 = 0 THEN c_nationkey END AS half,
c_mktsegment FROM {customer}""")
def select_features_once(t):
    df = t.customer.select(
        "c_custkey", "c_nationkey", "c_acctbal", F.col("c_nationkey").alias("again"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_nationkey")).alias("half"),
        "c_mktsegment", F.concat("c_mktsegment", F.lit("")).alias("sewer"), F.col("c_custkey").alias("latitude"), F.lit("x").alias("fixed"))
    return md.select_features(df.withColumn("twice", F.col("half") * 2 - F.col("half")), md.NO_FEATURES + md.LEFT_OUT_OF_STATICAL_LIST, "c_custkey")


@query("split_tvh", f"""SELECT o_orderkey, CASE WHEN {bucket_sql('o_orderkey', 100)} < 2 THEN 'validation'
WHEN {bucket_sql('o_orderkey', 100)} < 4 THEN 'holdout' ELSE 'train' END AS part FROM {{orders}}""")
def split_tvh(t):
    return md.split_tvh(t.orders.select("o_orderkey"), "o_orderkey")


@query("train_price_model")
def train_price_model(t):
    lines = md.split_tvh(priced_lines(t), "listing_id")
    train, rest = lines.filter("part = 'train'"), lines.filter("part <> 'train'")
    outs = [md.train_price_model(train, PRICE_FEATURES, kind=k).transform(rest).withColumn("kind", F.lit(k))
            for k in ("gamma", "trees")]
    both = outs[0].unionByName(outs[1])
    return md.holdout_mape(both, ["kind", "part"], "close_price", "prediction")


LEADERBOARD = """SELECT p_brand AS project_name, p_partkey AS model_id, 'bp' || CAST(p_partkey % 90 AS STRING) AS blueprint_id,
  CASE p_size % 3 WHEN 0 THEN 100e0 WHEN 1 THEN 96e0 ELSE 64e0 END AS sample_pct,
  CASE p_partkey % 4 WHEN 0 THEN 'All_trends' WHEN 1 THEN 'Statical_list' ELSE 'Other' END AS featurelist_name,
  CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE floor(p_retailprice / 100e0) END AS holdout_mape FROM {part}"""
ELIGIBLE = "floor(sample_pct) = 100 AND featurelist_name IN ('All_trends', 'Statical_list')"


def leaderboard(t):
    return t.sql(LEADERBOARD).withColumn("holdout_mape", F.col("holdout_mape").cast("double"))


@query("pick_best_model", f"""SELECT project_name, model_id AS best_model_id, holdout_mape AS best_holdout_mape
FROM ({LEADERBOARD}) x WHERE {ELIGIBLE} AND holdout_mape IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY project_name ORDER BY holdout_mape, model_id) = 1""")
def pick_best_model(t):
    return md.pick_best_model(leaderboard(t))


@query("prune_models", f"""SELECT model_id, CASE WHEN EXISTS (SELECT 1 FROM ({LEADERBOARD}) y WHERE {ELIGIBLE}
AND y.project_name = x.project_name AND y.blueprint_id = x.blueprint_id) THEN 'keep' ELSE 'delete' END AS action
FROM ({LEADERBOARD}) x""")
def prune_models(t):
    kept, deletable = md.prune_models(leaderboard(t))
    return kept.select("model_id", F.lit("keep").alias("action")).unionByName(
        deletable.select("model_id", F.lit("delete").alias("action")))


@query("score_batch")
def score_batch(t):
    lines = priced_lines(t)
    return md.score_batch(md.train_price_model(lines, PRICE_FEATURES), lines)


@query("feature_effect")
def feature_effect(t):
    lines = priced_lines(t)
    model = md.train_price_model(lines, PRICE_FEATURES)
    return md.feature_effect(model, lines, "l_quantity", [1, 10, 20, 30, 40, 50])


PREDICTED = """SELECT l_returnflag, l_extendedprice AS y, l_extendedprice * (1e0 + l_discount) + l_quantity AS p
  FROM {lineitem}"""


@query("holdout_mape", f"""SELECT l_returnflag, floor(avg(abs((y - p) / y)) * 1e8 + 5e-1) / 1e8 AS mape
FROM ({PREDICTED}) x GROUP BY l_returnflag""")
def holdout_mape(t):
    return md.holdout_mape(t.sql(PREDICTED), ["l_returnflag"], "y", "p").withColumn("mape", round_half_up("mape", 8))


@query("gamma_deviance", f"""SELECT l_returnflag, floor(2e0 * avg(-ln(y / p) + (y - p) / p) * 1e8 + 5e-1) / 1e8
AS gamma_deviance FROM ({PREDICTED}) x GROUP BY l_returnflag""")
def gamma_deviance(t):
    return md.gamma_deviance(t.sql(PREDICTED), ["l_returnflag"], "y", "p").withColumn(
        "gamma_deviance", round_half_up("gamma_deviance", 8))


ROUTED = "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'No_big_ma' WHEN c_custkey % 3 = 1 THEN 'houses' ELSE 'condos' END AS segment FROM {customer}"


@query("route_scoring_input", f"""SELECT c_custkey, segment,
CASE WHEN lower(segment) LIKE '%no_big_ma%' THEN 'not_sold' ELSE segment || '_not_sold' END AS input_schema,
CASE WHEN lower(segment) LIKE '%no_big_ma%' THEN 'no_big_metroareas_last_nonzeros' ELSE segment || '_us_last' END AS input_table,
CASE WHEN lower(segment) LIKE '%no_big_ma%' THEN segment || '_predictions' ELSE 'us_' || segment || '_predictions' END
 AS output_table FROM ({ROUTED}) x""")
def route_scoring_input(t):
    return md.route_scoring_input(t.sql(ROUTED), "segment")
