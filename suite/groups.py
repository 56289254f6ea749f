"""Aggregates, one row per key, sampling, unions."""

from datetime import datetime

from pyspark.sql import functions as F

from parcelspark.operators import aggregates as ag
from parcelspark.operators import setops as so
from parcelspark.operators import windows as wn
from parcelspark.plans.photos import photo_scores
from parcelspark.session import scratch_path
from suite import inputs
from suite.columns import ITEMS, part_lists
from suite.inputs import CLASSES, PHOTO_BASE, photo_class_sql, with_ctes
from suite.registry import query
from suite.sources import register_trends


@query("max_per_group", f"""SELECT CAST(l_orderkey % 1000 AS BIGINT) AS grp, CAST(max(n) AS INTEGER) AS most FROM
(SELECT l_orderkey, count(*) AS n FROM {ITEMS} GROUP BY l_orderkey) x GROUP BY l_orderkey % 1000""")
def max_per_group(t):
    lists = part_lists(t).withColumn("grp", F.col("l_orderkey") % 1000)
    return ag.max_per_group(lists, "grp", "items", "most")


EVENT_FLAGS = """SELECT user_id, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS clicks,
  CASE WHEN event_type = 'view' AND user_id % 9 > 0 THEN 1 ELSE 0 END AS views,
  CASE WHEN value > 10 AND event_type = 'view' THEN 1 ELSE 0 END AS dear_views, 1 AS all_events FROM {events}"""


def percent(part, whole):
    return (f"CASE WHEN sum({whole}) = 0 THEN 0e0 ELSE floor(CAST(sum({part}) AS DOUBLE) / sum({whole}) * 100e0 * 100e0"
            f" + 5e-1) / 100e0 END")


@query("guarded_percentages", f"""SELECT user_id, {percent('clicks', 'all_events')} AS percent_clicks,
{percent('dear_views', 'views')} AS percent_dear, max(clicks) AS any_click FROM ({EVENT_FLAGS}) x GROUP BY user_id""")
def guarded_percentages(t):
    return ag.guarded_percentages(t.sql(EVENT_FLAGS), ["user_id"], {
        "percent_clicks": ("clicks", "all_events"), "percent_dear": ("dear_views", "views")}, {"any_click": "clicks"})


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_quantity FROM {lineitem}")
def distinct_rows(t):
    return ag.distinct_rows(t.lineitem, ["l_returnflag", "l_linestatus", "l_linenumber", "l_quantity"])


@query("concat_agg", """SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ' | ' ORDER BY o_orderpriority) AS priorities
FROM {orders} GROUP BY o_custkey""")
def concat_agg(t):
    return ag.concat_agg(t.orders, ["o_custkey"], "o_orderpriority", "priorities", " | ")


@query("argmin_model", """SELECT p_brand, arg_min(p_partkey, m) AS best, min(p_retailprice) AS best_p_retailprice FROM
(SELECT p_brand, p_partkey, p_retailprice, p_retailprice * 1e9 + p_partkey AS m FROM {part}) x GROUP BY p_brand""")
def argmin_model(t):
    return ag.argmin_model(t.part, ["p_brand"], "p_retailprice", "p_partkey", "best")


@query("distinct_ids", "SELECT DISTINCT l_orderkey FROM {lineitem}")
def distinct_ids(t):
    return ag.distinct_ids(t.lineitem, "l_orderkey")


# ---------------------------------------------------------------- one row per key

DISTANCES = """SELECT o_orderkey, s_suppkey, abs(o_totalprice - s_acctbal * 50e0) AS distance
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {supplier} ON c_nationkey = s_nationkey"""


@query("top1_by_distance", f"""SELECT * FROM ({DISTANCES}) x
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY distance, s_suppkey) = 1""")
def top1_by_distance(t):
    # the rows of DISTANCES; dealt by order before the suppliers multiply them, so that they stay where they are made
    sold = t.sql("SELECT o_orderkey, o_totalprice, c_nationkey FROM {orders} JOIN {customer} ON o_custkey = c_custkey")
    distances = t.spark.sql("""SELECT o_orderkey, s_suppkey, abs(o_totalprice - s_acctbal * 50e0) AS distance
        FROM {sold} JOIN {supplier} ON c_nationkey = s_nationkey""", sold=sold.repartition("o_orderkey"), supplier=t.supplier)
    return wn.top1_by_distance(distances, "o_orderkey", "distance", ["s_suppkey"])


RATED = """SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE floor(o_totalprice / 1e5) END AS rating
  FROM {orders}"""


@query("top1_best_metric", f"""SELECT * FROM ({RATED}) x
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY rating DESC NULLS LAST, o_orderkey) = 1""")
def top1_best_metric(t):
    rated = t.sql(RATED).withColumn("rating", F.col("rating").cast("double"))
    return wn.top1_best_metric(rated, "o_custkey", "rating", ["o_orderkey"])


@query("first_per_period", """SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y, o_orderdate, o_orderkey FROM {orders}
QUALIFY row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderdate, o_orderkey) = 1""")
def first_per_period(t):
    df = t.orders.select("o_custkey", F.year("o_orderdate").alias("y"), "o_orderdate", "o_orderkey")
    return wn.first_per_period(df, ["o_custkey", "y"], "o_orderdate", ["o_orderkey"])


@query("latest_per_key", """SELECT o_custkey, o_orderdate, o_orderkey FROM {orders} WHERE o_orderdate < TIMESTAMP '1999-01-01'
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""")
def latest_per_key(t):
    df = t.orders.select("o_custkey", "o_orderdate", "o_orderkey")
    return wn.latest_per_key(df, ["o_custkey"], "o_orderdate", datetime(1999, 1, 1), ["o_orderkey"])


@query("dedupe_by_id", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM {lineitem}
QUALIFY row_number() OVER (PARTITION BY l_orderkey
 ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1""")
def dedupe_by_id(t):
    return wn.dedupe_by_id(t.lineitem, "l_orderkey", [
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


# ---------------------------------------------------------------- order, sample, union


@query("sorted_output", "SELECT o_orderkey, o_custkey FROM {orders} ORDER BY o_custkey, o_orderkey")
def sorted_output(t):
    return so.sorted_output(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", "o_orderkey")


def bucket_sql(key, buckets):
    return f"((({key} % 1000003) * 7919 + 104729) % 1000003) * 31337 % {buckets}"


@query("sample_fraction", f"SELECT o_orderkey, o_custkey FROM {{orders}} WHERE {bucket_sql('o_orderkey', 10000)} < 2500")
def sample_fraction(t):
    return so.sample_fraction(t.orders.select("o_orderkey", "o_custkey"), 0.25, "o_orderkey")


@query("union_all", """SELECT s_suppkey AS id, s_name AS name FROM {supplier} UNION ALL
SELECT c_custkey, c_name FROM {customer} UNION ALL SELECT c_custkey, c_name FROM {customer} WHERE c_acctbal < 0""")
def union_all(t):
    people = t.customer.select(F.col("c_name").alias("name"), F.col("c_custkey").alias("id"), "c_acctbal")
    return so.union_all(t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")),
                        people.drop("c_acctbal"), people.filter("c_acctbal < 0").drop("c_acctbal"))


@query("union_matching_tables", """SELECT n_regionkey, c_nationkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS close_month,
count(*) AS sold FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
WHERE n_regionkey < 4 GROUP BY n_regionkey, c_nationkey, CAST(date_trunc('month', o_orderdate) AS DATE)""")
def union_matching_tables(t):
    register_trends(t, "united")
    return so.union_matching_tables(t.spark, "united_geoid%month%")


@query("append_new_only", "SELECT event_id, user_id, value FROM {events}")
def append_new_only(t):
    path = scratch_path(t.spark, "history")
    events = t.events.select("event_id", "user_id", "value", "ts")
    events.filter("ts < TIMESTAMP '2024-01-16'").drop("ts").write.parquet(path)
    recent = events.filter("ts >= TIMESTAMP '2024-01-10'").drop("ts")
    so.append_new_only(recent, path, "event_id")
    return so.append_new_only(recent, path, "event_id")  # a second run adds nothing


PHOTO_CTES = {"base": PHOTO_BASE, **{f"t_{c}": photo_class_sql(c) for c in CLASSES}}
G = "t_unfurnished_houses.unfurnished_houses = 1"


def _filled(c):
    from parcelspark.plans.photos import FURNISHED_CLASSES
    gate = " OR unfurnished_houses = 1" if c in FURNISHED_CLASSES else ""
    return f"CASE WHEN {c} IS NULL{gate} THEN 0 ELSE {c} END AS {c}"


PHOTO_CTES |= {
    "joined": "SELECT * FROM base " + " ".join(
        f"LEFT JOIN t_{c} USING (mls_id, mls_number, path)" for c in CLASSES),
    "filled": f"SELECT mls_id, mls_number, path, indoor_photos, {', '.join(_filled(c) for c in CLASSES)} FROM joined",
    "merged": """SELECT DISTINCT * EXCLUDE (immaculate_kitchen_light, immaculate_kitchen_dark),
        CASE WHEN immaculate_kitchen_light = 1 OR immaculate_kitchen_dark = 1 THEN 1 ELSE 0 END AS immaculate_kitchen
        FROM filled""",
    "scores": f"""SELECT mls_id, mls_number,
        {percent('unfurnished_houses', 'indoor_photos')} AS percent_unfurnished_rooms,
        {percent('stylish_house', 'indoor_photos')} AS percent_stylish_house,
        {percent('immaculate_kitchen', 'kitchen')} AS percent_immaculate_kitchens,
        {percent('outdated_kitchen', 'kitchen')} AS percent_outdated_kitchens,
        {percent('stylish_bedroom', 'bedroom')} AS percent_stylish_bedrooms,
        {percent('outdated_bathroom', 'bathroom')} AS percent_outdated_bathrooms,
        {percent('stylish_living_room', 'living_room')} AS percent_stylish_living_rooms,
        max(private_pool) AS private_pool FROM merged GROUP BY mls_id, mls_number""",
}


@query("photo_scores", with_ctes(PHOTO_CTES, "SELECT * FROM scores"))
def photo_scores_query(t):
    return photo_scores(*inputs.photo_inputs(t))
