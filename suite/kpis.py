"""Before/after measures on orders and events."""

from pyspark.sql import functions as F

from parcelspark.operators import kpi
from suite.inputs import with_ctes
from suite.registry import query

TRAINED = """SELECT o_orderkey, o_custkey, c_nationkey,
  CAST(floor(o_totalprice * 100e0 + 5e-1) AS BIGINT) AS cents, CAST(o_orderdate AS DATE) AS order_day,
  CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE DATE '1998-01-01' + CAST(c_custkey % 365 AS INT) END AS training_date
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey"""
MARK = """CASE WHEN order_day >= training_date THEN 'After' WHEN order_day < training_date THEN 'Before' END"""


# amounts are whole cents: their sums are exact, whatever the order of the rows

@query("period_indicator", f"SELECT *, {MARK} AS period_indicator FROM ({TRAINED}) x")
def period_indicator(t):
    return kpi.period_indicator(t.sql(TRAINED), "order_day", "training_date")


@query("before_after_kpi", with_ctes({"m": f"SELECT *, {MARK} AS p FROM ({TRAINED}) x"}, f"""
SELECT c_nationkey, avg(cents) FILTER (p = 'Before') AS before_avg,
 avg(cents) FILTER (p = 'After') AS after_avg,
 avg(cents) FILTER (p = 'After') - avg(cents) FILTER (p = 'Before') AS change
FROM m GROUP BY c_nationkey"""))
def before_after_kpi(t):
    marked = kpi.period_indicator(t.sql(TRAINED), "order_day", "training_date")
    return kpi.before_after_kpi(marked, ["c_nationkey"], "cents")


RATINGS = """SELECT user_id, CAST(ts AS DATE) AS day, CAST(floor(value * 100e0 + 5e-1) AS BIGINT) AS points FROM {events}"""


@query("mean_rating_per_coach", f"SELECT user_id, day, avg(points) AS coach_nps FROM ({RATINGS}) x GROUP BY user_id, day")
def mean_rating_per_coach(t):
    return kpi.mean_rating_per_coach(t.sql(RATINGS), "user_id", "day", "points")


@query("ratio_kpi", f"""SELECT c_nationkey, CAST(sum(cents) AS BIGINT) AS total_cents,
CAST(sum(cents) AS DOUBLE) / count(DISTINCT o_custkey) AS per_agent, CAST(sum(cents) AS DOUBLE) / count(*) AS per_unit
FROM ({TRAINED}) x GROUP BY c_nationkey""")
def ratio_kpi(t):
    return kpi.ratio_kpi(t.sql(TRAINED), ["c_nationkey"], "cents", {
        "per_agent": F.count_distinct("o_custkey"), "per_unit": F.count("o_orderkey")})


@query("net_change", """SELECT user_id, CAST(count(*) FILTER (event_type = 'click') AS BIGINT) AS joined,
CAST(count(*) FILTER (event_type = 'error') AS BIGINT) AS departed,
CAST(count(*) FILTER (event_type = 'click') - count(*) FILTER (event_type = 'error') AS BIGINT) AS net_change
FROM {events} GROUP BY user_id""")
def net_change(t):
    return kpi.net_change(t.events, ["user_id"], "event_type", "click", "error")


SALES = "SELECT o_custkey, o_orderstatus, CAST(floor(o_totalprice * 100e0 + 5e-1) AS BIGINT) AS cents FROM {orders}"


@query("sum_kpis", f"""SELECT o_custkey, CAST(sum(cents) AS BIGINT) AS sales_volume, count(*) AS listings_taken,
CAST(count(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS units_sold FROM ({SALES}) x GROUP BY o_custkey""")
def sum_kpis(t):
    return kpi.sum_kpis(t.sql(SALES), ["o_custkey"], {"sales_volume": "cents"}, {
        "units_sold": F.col("o_orderstatus") == "F", "listings_taken": F.lit(True)})


PER_CUSTOMER = "SELECT o_custkey AS id, count(*) AS n_orders, max(o_totalprice) AS top_order FROM {orders} GROUP BY o_custkey"
PER_STATUS = """SELECT o_custkey AS id, count(*) AS finished FROM {orders} WHERE o_orderstatus = 'F' AND o_totalprice > 300000
  GROUP BY o_custkey"""


@query("analysis_table", with_ctes({"a": PER_CUSTOMER, "b": PER_STATUS}, """
SELECT c_custkey AS id, c_nationkey, n_orders, top_order, finished FROM {customer}
LEFT JOIN a ON c_custkey = a.id LEFT JOIN b ON c_custkey = b.id"""))
def analysis_table(t):
    base = t.customer.select(F.col("c_custkey").alias("id"), "c_nationkey")
    return kpi.analysis_table(base, [t.sql(PER_CUSTOMER), t.sql(PER_STATUS)], ["id"])
