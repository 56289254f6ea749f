"""Equality joins on orders, lines, customers and events."""

from datetime import datetime

from pyspark.sql import functions as F

from parcelspark.operators import joins as jn
from suite import inputs
from suite.inputs import CLASSES, PHOTO_BASE, photo_class_sql, with_ctes
from suite.registry import query

STAR = {"base": PHOTO_BASE, **{f"t_{c}": photo_class_sql(c) for c in CLASSES}}
USING = "(mls_id, mls_number, path)"


@query("join_star_left", with_ctes(
    STAR, "SELECT * FROM base " + " ".join(f"LEFT JOIN t_{c} USING {USING}" for c in CLASSES)))
def join_star_left(t):
    photos, classes = inputs.photo_inputs(t)
    return jn.join_star_left(photos, list(classes.values()), ["mls_id", "mls_number", "path"])


@query("join_inner_using", """SELECT o_orderkey, o_custkey AS custkey, c_name, o_totalprice FROM {orders}
JOIN {customer} ON o_custkey = c_custkey WHERE c_nationkey = 3""")
def join_inner_using(t):
    orders = t.orders.select("o_orderkey", F.col("o_custkey").alias("custkey"), "o_totalprice")
    people = t.customer.filter("c_nationkey = 3").select(F.col("c_custkey").alias("custkey"), "c_name")
    return jn.join_inner_using(orders, people, ["custkey"])


WEEKS = """SELECT CAST(extract(WEEK FROM l_shipdate) AS INT) AS num_week, count(*) AS shipped FROM {lineitem}
  WHERE l_quantity > 10 GROUP BY CAST(extract(WEEK FROM l_shipdate) AS INT)"""
MONTHS = """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, count(*) AS sold, min(o_orderkey) AS first_order
  FROM {orders} WHERE o_orderstatus = 'F' GROUP BY CAST(date_trunc('month', o_orderdate) AS DATE)"""
MONTH_STATE = """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, c_nationkey, count(*) AS sold_in_nation
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey WHERE o_orderstatus = 'O'
  GROUP BY CAST(date_trunc('month', o_orderdate) AS DATE), c_nationkey"""
FACTS = """SELECT o_orderkey, c_nationkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS m,
  CAST(extract(WEEK FROM o_orderdate) AS INT) AS num_week FROM {orders} JOIN {customer} ON o_custkey = c_custkey"""


@query("join_dimensions_left", with_ctes(
    {"facts": FACTS, "weeks": WEEKS, "months": MONTHS, "ms": MONTH_STATE},
    "SELECT * FROM facts LEFT JOIN weeks USING (num_week) LEFT JOIN months USING (m) LEFT JOIN ms USING (m, c_nationkey)"))
def join_dimensions_left(t):
    return jn.join_dimensions_left(t.sql(FACTS), [
        (t.sql(WEEKS), ["num_week"]), (t.sql(MONTHS), ["m"]), (t.sql(MONTH_STATE), ["m", "c_nationkey"])])


STAMPED = """SELECT CAST(m AS TIMESTAMP) AS at_time, sold FROM months"""


@query("join_on_expression", with_ctes(
    {"facts": FACTS, "months": MONTHS}, """SELECT o_orderkey, facts.m, s.sold FROM facts
LEFT JOIN (SELECT CAST(m AS TIMESTAMP) AS at_time, sold FROM months) s ON facts.m = CAST(s.at_time AS DATE)"""))
def join_on_expression(t):
    stamped = t.sql(MONTHS).select(F.col("m").cast("timestamp").alias("at_time"), "sold")
    facts = t.sql(FACTS).select("o_orderkey", "m")
    return jn.join_on_expression(facts, stamped, "m", F.to_date("at_time")).drop("at_time")


@query("join_anti_left_null", """SELECT o_orderkey AS orderkey, o_custkey FROM {orders} LEFT JOIN
(SELECT DISTINCT l_orderkey FROM {lineitem}) l ON o_orderkey = l_orderkey WHERE l_orderkey IS NULL""")
def join_anti_left_null(t):
    orders = t.orders.select(F.col("o_orderkey").alias("orderkey"), "o_custkey")
    return jn.join_anti_left_null(orders, t.lineitem.select(F.col("l_orderkey").alias("orderkey")), ["orderkey"])


@query("join_matched_left", """SELECT o_orderkey AS orderkey, o_custkey, lines FROM {orders} LEFT JOIN
(SELECT l_orderkey, count(*) AS lines FROM {lineitem} WHERE l_quantity > 40 GROUP BY l_orderkey) l
ON o_orderkey = l_orderkey WHERE l_orderkey IS NOT NULL""")
def join_matched_left(t):
    orders = t.orders.select(F.col("o_orderkey").alias("orderkey"), "o_custkey")
    lines = t.lineitem.filter("l_quantity > 40").groupBy(F.col("l_orderkey").alias("orderkey")).agg(
        F.count("*").alias("lines"))
    return jn.join_matched_left(orders, lines, ["orderkey"])


KNOWN = "SELECT CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_orderkey END AS orderkey FROM {lineitem}"


@query("join_not_in", f"""SELECT o_orderkey AS orderkey, o_totalprice FROM {{orders}}
WHERE o_orderkey NOT IN (SELECT orderkey FROM ({KNOWN}) k WHERE orderkey IS NOT NULL)""")
def join_not_in(t):
    orders = t.orders.select(F.col("o_orderkey").alias("orderkey"), "o_totalprice")
    return jn.join_not_in(orders, t.sql(KNOWN), "orderkey")


PARTS = [f"""SELECT l_orderkey AS orderkey, count(*) AS n{i}, max(l_quantity) AS q{i} FROM {{lineitem}}
  WHERE l_returnflag = '{f}' GROUP BY l_orderkey""" for i, f in enumerate("ANR")]


@query("join_full_chain", with_ctes(
    {f"p{i}": p for i, p in enumerate(PARTS)},
    "SELECT * FROM p0 FULL JOIN p1 USING (orderkey) FULL JOIN p2 USING (orderkey)"))
def join_full_chain(t):
    return jn.join_full_chain([t.sql(p) for p in PARTS], ["orderkey"])


TREND_FACTS = """SELECT o_orderkey, 'A' || CAST(o_custkey % 40 AS STRING) AS GEOID,
  'N' || CAST(c_nationkey AS STRING) AS state_prov_short, CAST(extract(YEAR FROM o_orderdate) AS INT) AS close_year,
  CAST(extract(MONTH FROM o_orderdate) AS INT) AS close_month, CAST(extract(QUARTER FROM o_orderdate) AS INT) AS quarter
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey"""
AREA_TREND = """SELECT 'A' || CAST(o_custkey % 40 AS STRING) AS GEOID, 'N' || CAST(c_nationkey AS STRING) AS state_prov_short,
  o_orderdate AS close_dt, max(o_totalprice) AS trend_geoid_quarter, min(o_totalprice) AS yearly_geoid_quarter
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey WHERE o_orderstatus <> 'P'
  GROUP BY o_custkey % 40, c_nationkey, o_orderdate"""
NATION_TREND = """SELECT 'N' || CAST(c_nationkey AS STRING) AS state_prov_short, o_orderdate AS close_dt,
  max(o_totalprice) AS yearly_state FROM {orders} JOIN {customer} ON o_custkey = c_custkey WHERE o_orderstatus = 'O'
  GROUP BY c_nationkey, o_orderdate"""
TREND_CTES = {"facts": TREND_FACTS, "areat": AREA_TREND, "nt": NATION_TREND, "q": """
SELECT GEOID, state_prov_short, CAST(year(close_dt) AS INTEGER) AS close_year, CAST(quarter(close_dt) AS INTEGER) AS quarter,
 trend_geoid_quarter, yearly_geoid_quarter FROM areat QUALIFY row_number() OVER (
 PARTITION BY GEOID, state_prov_short, year(close_dt), quarter(close_dt) ORDER BY close_dt) = 1""", "s": """
SELECT state_prov_short, CAST(year(close_dt) AS INTEGER) AS close_year, CAST(month(close_dt) AS INTEGER) AS close_month,
 yearly_state FROM nt QUALIFY row_number() OVER (PARTITION BY state_prov_short, year(close_dt), month(close_dt)
 ORDER BY close_dt) = 1"""}


@query("join_time_trend", with_ctes(TREND_CTES, """SELECT * FROM facts
JOIN q USING (GEOID, state_prov_short, close_year, quarter) JOIN s USING (state_prov_short, close_year, close_month)"""))
def join_time_trend(t):
    return jn.join_time_trend(t.sql(TREND_FACTS), t.sql(AREA_TREND), t.sql(NATION_TREND))


# orders of every second area have no trend of their own
GAPS = """SELECT o_orderkey, 'A' || CAST(o_custkey % 400 AS STRING) AS GEOID,
  CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_totalprice END AS trend_geoid_quarter,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS yearly_geoid_quarter FROM {orders}"""
AREA_HISTORY = """SELECT 'A' || CAST(o_custkey % 450 AS STRING) AS GEOID, o_orderdate AS close_dt,
  max(o_totalprice) AS trend_geoid_quarter, min(o_totalprice) AS yearly_geoid_quarter FROM {orders}
  WHERE o_custkey % 450 > 20 GROUP BY o_custkey % 450, o_orderdate"""


@query("backfill_latest", with_ctes({"g": GAPS, "h": AREA_HISTORY, "latest": """
SELECT * FROM h WHERE close_dt < TIMESTAMP '1999-06-01'
QUALIFY row_number() OVER (PARTITION BY GEOID ORDER BY close_dt DESC) = 1"""}, """
SELECT g.o_orderkey, g.GEOID,
 CASE WHEN g.trend_geoid_quarter IS NOT NULL THEN g.trend_geoid_quarter ELSE coalesce(latest.trend_geoid_quarter, 0e0) END
  AS trend_geoid_quarter,
 CASE WHEN g.yearly_geoid_quarter IS NOT NULL THEN g.yearly_geoid_quarter
  WHEN g.trend_geoid_quarter IS NULL AND latest.yearly_geoid_quarter IS NOT NULL THEN latest.yearly_geoid_quarter
  ELSE 0e0 END AS yearly_geoid_quarter
FROM g LEFT JOIN latest ON g.GEOID = latest.GEOID"""))
def backfill_latest(t):
    return jn.backfill_latest(t.sql(GAPS), t.sql(AREA_HISTORY), "GEOID", ["trend_geoid_quarter", "yearly_geoid_quarter"],
                              "close_dt", datetime(1999, 6, 1))
