"""Price models of all segments: orders are sold homes, customers' metro codes their segments."""

from pyspark.sql import functions as F

from parcelspark.functions.scalars import round_half_up
from parcelspark.operators import boosting as bo
from parcelspark.operators import segments as sg
from parcelspark.operators.models import METRO_SEGMENTS, segment_by_metro
from parcelspark.plans import price_models as pm
from parcelspark.session import scratch_path
from suite.groups import bucket_sql
from suite.models import SEGMENT_CASE
from suite.registry import query
from suite.sources import PRICE_FEATURES, priced_lines

# Values of the two columns that become 0/1 features; orders of every 11th customer have no known priority.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATUSES = ["F", "O", "P"]
PRIORITY = "CASE WHEN o_custkey % 11 <> 0 THEN o_orderpriority END"
METRO_OF = """SELECT c_custkey, CAST(CASE c_nationkey % 4 WHEN 0 THEN 12420 WHEN 1 THEN 42660 WHEN 2 THEN 27980 ELSE 99999 END AS BIGINT) AS cbsa
  FROM {customer}"""
SOLD = f"""SELECT o_orderkey, o_orderdate, o_totalprice AS close_price, {SEGMENT_CASE} AS segment, o_orderstatus AS status,
  {PRIORITY} AS priority FROM {{orders}} JOIN ({METRO_OF}) c ON o_custkey = c_custkey"""
LISTS = {"All_trends": [f"priority_{i}" for i in range(5)], "Statical_list": [f"status_{i}" for i in range(3)]}


def homes(t):
    metros = segment_by_metro(t.sql(METRO_OF), METRO_SEGMENTS, "cbsa")
    rows = t.orders.join(metros, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_orderdate", F.col("o_totalprice").alias("close_price"), "segment", F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_custkey") % 11 != 0, F.col("o_orderpriority")).alias("priority"))
    flags = {f"{c}_{i}": (F.col(c) == v).cast("int") for c, values in (("priority", PRIORITIES), ("status", STATUSES))
             for i, v in enumerate(values)}
    return rows.withColumns(flags)


@query("train_segments", f"""SELECT segment, coalesce(priority, 'none') AS priority, count(*) AS n,
floor(avg(close_price) * 1e2 + 5e-1) / 1e2 AS prediction FROM ({SOLD}) x GROUP BY segment, coalesce(priority, 'none')""")
def train_segments(t):
    rows = homes(t)
    scored = sg.train_segments(rows, "segment", LISTS["All_trends"]).transform(rows)
    return scored.groupBy("segment", F.coalesce("priority", F.lit("none")).alias("priority")).agg(
        F.count(F.lit(1)).alias("n"), round_half_up(F.max("prediction"), 2).alias("prediction"))


@query("segment_effect", f"""SELECT segment, CAST(value AS DOUBLE) AS value,
floor(avg(CASE WHEN (CASE WHEN status = 'F' THEN 1 ELSE 0 END) = value THEN close_price END) * 1e2 + 5e-1) / 1e2 AS mean_prediction
FROM ({SOLD}) x CROSS JOIN (SELECT 0 AS value UNION ALL SELECT 1) g GROUP BY segment, value""")
def segment_effect(t):
    rows = homes(t)
    found = sg.train_segments(rows, "segment", ["status_0"]).effect(rows, "status_0", [0, 1])
    return found.withColumn("mean_prediction", round_half_up(F.col("mean_prediction"), 2))


BUCKET = bucket_sql("o_orderkey", 100)
GROUPED = """SELECT x.*, avg(CASE WHEN b >= 4 THEN close_price END) OVER (PARTITION BY segment, coalesce(priority, 'none')) AS by_priority,
  avg(CASE WHEN b >= 4 THEN close_price END) OVER (PARTITION BY segment, status) AS by_status,
  avg(close_price) OVER (PARTITION BY segment, coalesce(priority, 'none')) AS all_priority,
  avg(close_price) OVER (PARTITION BY segment, status) AS all_status
  FROM (SELECT y.*, {bucket} AS b FROM ({sold}) y) x""".format(bucket=BUCKET, sold=SOLD)
ERRORS = f"""SELECT segment, avg(CASE WHEN b >= 2 AND b < 4 THEN abs((close_price - by_priority) / close_price) END) AS e_priority,
  avg(CASE WHEN b >= 2 AND b < 4 THEN abs((close_price - by_status) / close_price) END) AS e_status FROM ({GROUPED}) g GROUP BY segment"""


def rounded(e):
    return f"floor({e} * 1e6 + 5e-1) / 1e6"


# A group of a small table may have no training row: its holdout rows are scored by what the other terms say, which SQL can't repeat.
@query("leaderboard", f"""SELECT segment AS project_name, 'All_trends' AS featurelist_name, {rounded('e_priority')} AS holdout_mape
FROM ({ERRORS}) e WHERE e_priority IS NOT NULL
UNION ALL SELECT segment, 'Statical_list', {rounded('e_status')} FROM ({ERRORS}) e WHERE e_status IS NOT NULL""")
def leaderboard(t):
    board = pm.leaderboard(homes(t), "segment", "o_orderkey", "close_price", {"regression": pm.regression}, LISTS)
    return board.select("project_name", "featurelist_name", round_half_up(F.col("holdout_mape"), 6).alias("holdout_mape"))


@query("score_segments", f"""SELECT o_orderkey, o_orderdate, floor(CASE WHEN e_priority <= e_status THEN all_priority
WHEN e_status < e_priority THEN all_status END * 1e2 + 5e-1) / 1e2 AS prediction
FROM ({GROUPED}) g JOIN ({ERRORS}) e ON g.segment = e.segment""")
def score_segments(t):
    rows = homes(t)
    _, scored = pm.price_round(rows, rows, "segment", "o_orderkey", "close_price", {"regression": pm.regression}, LISTS,
                               ["o_orderkey", "o_orderdate"], scratch_path(t.spark, "predictions"))
    return scored.withColumn("prediction", round_half_up(F.col("prediction"), 2))


CUTS = {"l_quantity": [10, 20, 30, 40], "l_discount": [0.025, 0.055, 0.085]}
CELLS = "\nUNION ALL ".join(
    f"""SELECT l_returnflag, {i} AS feature, CAST({j + 1} AS INTEGER) AS cut, s.n, s.total, count(*) AS left_n, sum(l_extendedprice) AS left_sum
  FROM {{lineitem}} JOIN (SELECT l_returnflag AS mode, count(*) AS n, sum(l_extendedprice) AS total, avg(l_extendedprice) AS mean
  FROM {{lineitem}} GROUP BY l_returnflag) s ON l_returnflag = s.mode
  WHERE {c} IS NULL OR {c} <= {e} GROUP BY l_returnflag, s.n, s.total"""
    for i, (c, edges) in enumerate(CUTS.items()) for j, e in enumerate(edges))
# with the mean as start, a side's ratio is its sum of prices over the mean
STUMP = f"""SELECT l_returnflag, feature, cut, left_n + 1e0 AS nl, left_sum * n / total + 1e0 AS rl,
  n - left_n + 1e0 AS nr, (total - left_sum) * n / total + 1e0 AS rr, total / n AS mean
  FROM ({CELLS}) c WHERE left_n >= 20 AND n - left_n >= 20"""


@query("split_stump", f"""SELECT l_returnflag, CAST(feature AS INTEGER) AS feature, cut,
floor(mean * exp(5e-1 * ln(rl / nl)) * 1e2 + 5e-1) / 1e2 AS low_price,
floor(mean * exp(5e-1 * ln(rr / nr)) * 1e2 + 5e-1) / 1e2 AS high_price
FROM (SELECT s.*, - nl * ln(rl / nl) - nr * ln(rr / nr) AS gain FROM ({STUMP}) s) y
QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY gain DESC, feature, cut) = 1""")
def split_stump(t):
    settings = bo.TreeSettings(trees=1, depth=1, rate=0.5)
    model = bo.train_segment_trees(t.lineitem, "l_returnflag", list(CUTS), "l_extendedprice", settings, CUTS)
    tree = F.col("trees")[0]

    def price(node):
        return round_half_up(F.exp(F.col("start") + tree["value"][node]), 2)

    return model.table.select(F.col("model_segment").alias("l_returnflag"), tree["feature"][0].alias("feature"), tree["cut"][0].alias("cut"),
                              price(1).alias("low_price"), price(2).alias("high_price"))


@query("train_segment_trees")
def train_segment_trees(t):
    lines = priced_lines(t).join(t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.min("l_returnflag").alias("segment")),
                                 F.col("listing_id") == F.col("k"))
    blueprints = {"regression": pm.regression, "trees": pm.boosted_trees(bo.TreeSettings(trees=4))}
    board = pm.leaderboard(lines, "segment", "listing_id", "close_price", blueprints, {"All_trends": PRICE_FEATURES})
    return board.drop("model_id")
