"""Filters on orders, lines and parts."""

from datetime import date, datetime

from pyspark.sql import functions as F

from parcelspark.operators import filters as flt
from parcelspark.operators.features import bool_flags
from suite.registry import query

NULLING = """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice,
  CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_quantity END AS full_baths,
  CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_quantity + 2 END AS total_baths,
  CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_returnflag END AS category,
  CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE l_linestatus END AS original_category,
  CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE l_quantity > 25 END AS is_deleted FROM {lineitem}"""
NULLED = f"({NULLING}) x"


@query("filter_denylist", f"SELECT * FROM {NULLED} WHERE category IS NOT NULL AND category NOT IN ('R', 'X')")
def filter_denylist(t):
    return flt.filter_denylist(t.sql(NULLING), "category", ["R", "X"])


@query("filter_allowlist_ci", "SELECT p_partkey, p_type FROM {part} WHERE lower(p_type) IN ('economy', 'standard')")
def filter_allowlist_ci(t):
    return flt.filter_allowlist_ci(t.part, "p_type", ["Economy", "standard"]).select("p_partkey", "p_type")


@query("filter_exclude_categories",
       f"SELECT * FROM {NULLED} WHERE category NOT IN ('A', 'F') AND original_category NOT IN ('A', 'F')")
def filter_exclude_categories(t):
    return flt.filter_exclude_categories(t.sql(NULLING), ["category", "original_category"], ["A", "F"])


@query("filter_flag", f"SELECT * FROM {NULLED} WHERE is_deleted = false")
def filter_flag(t):
    return flt.filter_flag(t.sql(NULLING), "is_deleted")


@query("filter_bounds", """SELECT l_orderkey, l_quantity, l_extendedprice, l_shipdate FROM {lineitem}
WHERE l_extendedprice BETWEEN 20000 AND 60000 AND l_quantity >= 10 AND l_shipdate <= TIMESTAMP '1999-01-01'""")
def filter_bounds(t):
    lines = t.lineitem.select("l_orderkey", "l_quantity", "l_extendedprice", "l_shipdate")
    return flt.filter_bounds(lines, {"l_extendedprice": (20000, 60000), "l_quantity": (10, None),
                                     "l_shipdate": (None, datetime(1999, 1, 1))})


@query("filter_any_bound", f"SELECT * FROM {NULLED} WHERE full_baths < 10 OR total_baths < 10")
def filter_any_bound(t):
    return flt.filter_any_bound(t.sql(NULLING), ["full_baths", "total_baths"], 10)


@query("filter_null_or_between", f"SELECT * FROM {NULLED} WHERE full_baths IS NULL OR full_baths BETWEEN 0 AND 20")
def filter_null_or_between(t):
    return flt.filter_null_or_between(t.sql(NULLING), "full_baths", 0, 20)


@query("filter_recent", "SELECT o_orderkey, o_orderdate FROM {orders} WHERE o_orderdate >= DATE '2001-04-15'")
def filter_recent(t):
    return flt.filter_recent(t.orders, "o_orderdate", 3, date(2001, 7, 15)).select("o_orderkey", "o_orderdate")


@query("filter_before_now", "SELECT o_orderkey, o_orderdate FROM {orders} WHERE o_orderdate < TIMESTAMP '1998-06-01'")
def filter_before_now(t):
    return flt.filter_before_now(t.orders, "o_orderdate", datetime(1998, 6, 1)).select("o_orderkey", "o_orderdate")


@query("filter_positive_duration", """SELECT o_orderkey, l_linenumber, o_orderdate, l_shipdate
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey WHERE CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) > 0""")
def filter_positive_duration(t):
    both = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return flt.filter_positive_duration(both, "o_orderdate", "l_shipdate").select(
        "o_orderkey", "l_linenumber", "o_orderdate", "l_shipdate")


@query("require_complete", f"""SELECT * FROM {NULLED} WHERE full_baths IS NOT NULL AND total_baths IS NOT NULL
AND category IS NOT NULL AND original_category IS NOT NULL AND is_deleted IS NOT NULL""")
def require_complete(t):
    return flt.require_complete(t.sql(NULLING), ["full_baths", "total_baths", "category", "original_category",
                                                 "is_deleted"])


@query("filter_name_tokens", """SELECT p_partkey, p_name FROM {part}
WHERE p_name LIKE '%ring%' AND p_name NOT LIKE '%red%' AND p_name NOT LIKE '%big%' AND p_size > 20""")
def filter_name_tokens(t):
    parts = t.part.withColumn("unlocked", F.col("p_size") > 20)
    return flt.filter_name_tokens(parts, "p_name", ["ring"], ["red", "big"], "unlocked").select("p_partkey", "p_name")


@query("filter_codes", """SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM {lineitem}
WHERE l_returnflag IN ('A', 'N') AND l_linestatus = 'O'""")
def filter_codes(t):
    return flt.filter_codes(t.lineitem, "l_returnflag", ["A", "N"], "l_linestatus", "O").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")


@query("filter_equals", "SELECT c_custkey, c_nationkey FROM {customer} WHERE c_nationkey = 7")
def filter_equals(t):
    return flt.filter_equals(t.customer, "c_nationkey", 7).select("c_custkey", "c_nationkey")


@query("bool_flags", f"""SELECT l_orderkey, l_linenumber, l_partkey,
CASE WHEN is_deleted = true THEN 1 ELSE 0 END AS gone FROM {NULLED}""")
def bool_flags_query(t):
    df = t.sql(NULLING).select("l_orderkey", "l_linenumber", "l_partkey", F.struct("is_deleted").alias("inner"))
    return bool_flags(df, {"gone": "inner.is_deleted"}).drop("inner")
