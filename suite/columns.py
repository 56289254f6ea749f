"""Scalar features on parts, orders and lines."""

from datetime import date

from pyspark.sql import functions as F

from parcelspark.operators import features as ft
from suite.registry import query


def case_like(column, words, out):
    return f"CASE WHEN {' OR '.join(f'{column} LIKE {chr(39)}%{w}%{chr(39)}' for w in words)} THEN 1 ELSE 0 END AS {out}"


PART_TEXT = """SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN 'none'
  ELSE p_name END AS name, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE lower(p_type) END AS kind FROM {part}"""
PT = f"({PART_TEXT}) x"
WORDS = {"ring_flag": ["ring"], "metal_flag": ["gear", "bolt", "widget"], "colour_flag": ["red", "blue", "green"]}


@query("keyword_flags", f"SELECT p_partkey, {', '.join(case_like('name', w, k) for k, w in WORDS.items())} FROM {PT}")
def keyword_flags(t):
    return ft.keyword_flags(t.sql(PART_TEXT), "name", WORDS).select("p_partkey", *WORDS)


@query("missing_flag", f"""SELECT p_partkey, CASE WHEN name IS NULL OR name = 'none' THEN 1 ELSE 0 END AS no_name,
CASE WHEN kind IS NULL THEN 1 ELSE 0 END AS no_kind FROM {PT}""")
def missing_flag(t):
    df = ft.missing_flag(t.sql(PART_TEXT), "name", "no_name", ["none"])
    return ft.missing_flag(df, "kind", "no_kind").select("p_partkey", "no_name", "no_kind")


@query("keyword_flag_except", f"""SELECT p_partkey, CASE WHEN (name LIKE '%ring%' OR name LIKE '%gear%')
AND name NOT LIKE '%small%' THEN 1 ELSE 0 END AS flag FROM {PT}""")
def keyword_flag_except(t):
    return ft.keyword_flag_except(t.sql(PART_TEXT), "name", "flag", ["ring", "gear"], ["small"]).select(
        "p_partkey", "flag")


@query("cross_column_flag", f"""SELECT p_partkey, CASE WHEN name LIKE '%ring%' OR kind LIKE '%econ%' OR kind LIKE '%prom%'
THEN 1 ELSE 0 END AS flag FROM {PT}""")
def cross_column_flag(t):
    return ft.cross_column_flag(t.sql(PART_TEXT), "flag", {"name": ["ring"], "kind": ["econ", "prom"]}).select(
        "p_partkey", "flag")


@query("default_true_flag", f"""SELECT p_partkey, CASE WHEN name LIKE '%red%' OR name LIKE '%small%' THEN 0 ELSE 1 END
AS flag FROM {PT}""")
def default_true_flag(t):
    return ft.default_true_flag(t.sql(PART_TEXT), "name", "flag", ["red", "small"]).select("p_partkey", "flag")


@query("keyword_flag_weak_negation", f"""SELECT p_partkey, CASE WHEN name LIKE '%ring%' AND (name NOT LIKE '%small ring%'
OR name NOT LIKE '%small%') THEN 1 ELSE 0 END AS flag FROM {PT}""")
def keyword_flag_weak_negation(t):
    return ft.keyword_flag_weak_negation(t.sql(PART_TEXT), "name", "flag", "ring", ["small ring", "small"]).select(
        "p_partkey", "flag")


@query("other_flag", f"""SELECT *, CASE WHEN ring_flag = 0 AND metal_flag = 0 AND colour_flag = 0 THEN 1 ELSE 0 END AS rest
FROM (SELECT p_partkey, {', '.join(case_like('name', w, k) for k, w in WORDS.items())} FROM {PT}) y""")
def other_flag(t):
    df = ft.keyword_flags(t.sql(PART_TEXT), "name", WORDS).select("p_partkey", *WORDS)
    return ft.other_flag(df, list(WORDS), "rest")


AREAS = """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS living, l_extendedprice AS lot,
  CASE l_returnflag WHEN 'A' THEN 'SQM' WHEN 'N' THEN 'square feet' ELSE NULL END AS living_units,
  CASE l_returnflag WHEN 'A' THEN 'SqFt' WHEN 'N' THEN 'sqm' ELSE 'acres' END AS lot_units FROM {lineitem}"""


@query("convert_area_units", f"""SELECT l_orderkey, l_linenumber, l_partkey,
CAST(CASE WHEN lower(living_units) IN ('square meters', 'sqm', 'sm') THEN floor(living * 10.76391041671e0 + 5e-1)
 ELSE floor(living + 5e-1) END AS BIGINT) AS living,
CASE WHEN lower(lot_units) = 'sqm' THEN lot * 0.000247105e0 WHEN lower(lot_units) IN ('sqft', 'square feet')
 THEN lot * 0.0000229568e0 ELSE lot END AS lot FROM ({AREAS}) x""")
def convert_area_units(t):
    return ft.convert_area_units(t.sql(AREAS), "living", "living_units", "lot", "lot_units").drop(
        "living_units", "lot_units")


@query("cast_rounded_long", """SELECT l_orderkey, l_linenumber, l_partkey,
CAST(floor(l_quantity / 2e0 + 5e-1) AS BIGINT) AS half FROM {lineitem}""")
def cast_rounded_long(t):
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_quantity") / 2).alias("half"))
    return ft.cast_rounded_long(df, "half")


YEARS = """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'n/a' WHEN o_orderkey % 7 = 0 THEN NULL
  ELSE CAST(1900 + o_orderkey % 120 AS STRING) END AS built FROM {orders}"""


@query("safe_year", f"SELECT o_orderkey, built, CAST(try_cast(built AS INTEGER) AS INTEGER) AS year_built FROM ({YEARS}) x")
def safe_year(t):
    return ft.safe_year(t.sql(YEARS), "built", "year_built")


@query("normalize_text_lower", "SELECT c_custkey, lower(c_name) AS c_name, lower(c_mktsegment) AS c_mktsegment FROM {customer}")
def normalize_text_lower(t):
    return ft.normalize_text_lower(t.customer.select("c_custkey", "c_name", "c_mktsegment"), "c_name", "c_mktsegment")


POSTAL = """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN CAST(10000 + c_custkey AS STRING) || '-77'
  WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN 'A-1' ELSE CAST(20000 + c_custkey AS STRING) END AS code
  FROM {customer}"""


@query("postal_prefix", f"""SELECT c_custkey, code, CASE WHEN length(code) > 5 THEN split_part(code, '-', 1) ELSE code END
AS short FROM ({POSTAL}) x""")
def postal_prefix(t):
    return ft.postal_prefix(t.sql(POSTAL), "code", "short")


def part_lists(t):
    """Part keys of the dear lines of each order, in order; empty where there are none, NULL for every 50th order."""
    dear = F.filter(F.array_sort(F.collect_list(F.struct("l_partkey", "l_quantity", "l_suppkey"))),
                    lambda s: s["l_quantity"] > 30)
    lists = t.lineitem.groupBy("l_orderkey").agg(F.transform(dear, lambda s: s["l_partkey"].cast("string")).alias("items"))
    return lists.withColumn("items", F.when(F.col("l_orderkey") % 50 != 0, F.col("items")))


ITEMS = """(SELECT l_orderkey, l_partkey, l_quantity, l_suppkey FROM {lineitem}
 WHERE l_quantity > 30 AND l_orderkey % 50 <> 0) d"""


@query("array_to_text", f"""SELECT o.l_orderkey, d.items FROM (SELECT DISTINCT l_orderkey FROM {{lineitem}}) o LEFT JOIN
(SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ', ' ORDER BY l_partkey, l_quantity, l_suppkey) AS items
 FROM {ITEMS} GROUP BY l_orderkey) d ON o.l_orderkey = d.l_orderkey""")
def array_to_text(t):
    return ft.array_to_text(part_lists(t), "items")


@query("explode_inner", f"SELECT l_orderkey, CAST(l_partkey AS VARCHAR) AS item FROM {ITEMS}")
def explode_inner(t):
    return ft.explode_inner(part_lists(t), "items", "item").drop("items")


@query("array_count", f"""SELECT o.l_orderkey, CAST(CASE WHEN o.l_orderkey % 50 = 0 THEN NULL ELSE coalesce(n, 0) END
AS INTEGER) AS n_items FROM (SELECT DISTINCT l_orderkey FROM {{lineitem}}) o LEFT JOIN
(SELECT l_orderkey, count(*) AS n FROM {ITEMS} GROUP BY l_orderkey) d ON o.l_orderkey = d.l_orderkey""")
def array_count(t):
    return ft.array_count(part_lists(t), "items", "n_items").drop("items")


@query("not_null_flag", f"SELECT p_partkey, CASE WHEN name IS NOT NULL THEN 1 ELSE 0 END AS named FROM {PT}")
def not_null_flag(t):
    return ft.not_null_flag(t.sql(PART_TEXT), "name", "named").select("p_partkey", "named")


GATED = """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(event_id % 2 AS INT) END AS a,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id % 3 AS INT) END AS b,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(event_id % 2 AS INT) END AS gate FROM {events}"""


@query("fill_default", f"SELECT event_id, coalesce(a, 0) AS a, coalesce(b, 0) AS b, gate FROM ({GATED}) x")
def fill_default(t):
    return ft.fill_default(t.sql(GATED), ["a", "b"])


@query("fallback_column", f"SELECT event_id, gate, CASE WHEN a IS NULL THEN b ELSE a END AS a FROM ({GATED}) x")
def fallback_column(t):
    return ft.fallback_column(t.sql(GATED), "a", "b", "a")


@query("gated_fill", f"""SELECT event_id, CASE WHEN a IS NULL OR gate = 1 THEN 0 ELSE a END AS a,
CASE WHEN b IS NULL OR gate = 1 THEN 0 ELSE b END AS b, gate FROM ({GATED}) x""")
def gated_fill(t):
    return ft.gated_fill(t.sql(GATED), ["a", "b"], "gate")


@query("merge_flags", f"SELECT event_id, gate, CASE WHEN a = 1 OR b = 1 THEN 1 ELSE 0 END AS either FROM ({GATED}) x")
def merge_flags(t):
    return ft.merge_flags(t.sql(GATED), ["a", "b"], "either")


@query("drop_columns", "SELECT c_custkey, c_nationkey, c_acctbal FROM {customer}")
def drop_columns(t):
    return ft.drop_columns(t.customer, "c_name", "c_mktsegment", "not_there")


@query("rename_columns", "SELECT s_suppkey AS id, s_name AS name, s_nationkey, s_acctbal FROM {supplier}")
def rename_columns(t):
    return ft.rename_columns(t.supplier, {"s_suppkey": "id", "s_name": "name"})


@query("flatten_struct", "SELECT c_custkey, c_name AS name, c_acctbal AS balance FROM {customer}")
def flatten_struct(t):
    nested = t.customer.select("c_custkey", F.struct("c_name", F.struct("c_acctbal").alias("money")).alias("who"))
    return ft.flatten_struct(nested, {"name": "who.c_name", "balance": "who.money.c_acctbal"}).drop("who")


@query("calendar_parts", """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS close_year,
CAST(month(o_orderdate) AS INTEGER) AS close_month, CAST(quarter(o_orderdate) AS INTEGER) AS quarter FROM {orders}""")
def calendar_parts(t):
    return ft.calendar_parts(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate").drop("o_orderdate")


@query("iso_week_parts", """SELECT o_orderkey, CAST(isoyear(o_orderdate) AS INTEGER) AS close_year,
CAST(weekofyear(o_orderdate) AS INTEGER) AS num_week FROM {orders}""")
def iso_week_parts(t):
    return ft.iso_week_parts(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate").drop("o_orderdate")


@query("month_start", "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM {orders}")
def month_start(t):
    return ft.month_start(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "m").drop("o_orderdate")


@query("days_on_market", """SELECT o_orderkey, l_partkey, l_suppkey, l_linenumber,
CAST(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS INTEGER) AS day_on_market
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""")
def days_on_market(t):
    both = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return ft.days_on_market(both, "o_orderdate", "l_shipdate").select(
        "o_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "day_on_market")


@query("age_at_listing", f"""SELECT o_orderkey, CAST(year(o_orderdate) - try_cast(built AS INTEGER) AS INTEGER)
AS building_years_old FROM (SELECT o_orderdate, y.* FROM ({YEARS}) y JOIN {{orders}} o ON y.o_orderkey = o.o_orderkey) x""")
def age_at_listing(t):
    built = ft.safe_year(t.sql(YEARS), "built", "year_built")
    added = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year_added"))
    return ft.age_at_listing(added.join(built, "o_orderkey"), "year_added", "year_built").select(
        "o_orderkey", "building_years_old")


@query("stamp_as_of", "SELECT c_custkey, DATE '2021-01-01' AS close_dt FROM {customer}")
def stamp_as_of(t):
    return ft.stamp_as_of(t.customer.select("c_custkey"), date(2021, 1, 1))


@query("scale_round", """SELECT o_orderkey, floor(o_totalprice / 1000e0 * 100e0 + 5e-1) / 100e0 AS o_totalprice
FROM {orders}""")
def scale_round(t):
    return ft.scale_round(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice"])


TREND = """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS own,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice * 2 END AS fill FROM {orders}"""


@query("coalesce_trend", f"SELECT o_orderkey, coalesce(own, fill, 0e0) AS own FROM ({TREND}) x")
def coalesce_trend(t):
    return ft.coalesce_trend(t.sql(TREND), "own", "fill")


LONLAT = "SELECT c_custkey, c_acctbal / 50e0 AS lat, c_acctbal / 100e0 AS lon FROM {customer}"


@query("point_from_lonlat", f"SELECT * FROM ({LONLAT}) x WHERE lat BETWEEN -90 AND 90")
def point_from_lonlat(t):
    return ft.point_from_lonlat(t.sql(LONLAT))


@query("month_label", "SELECT o_orderkey, strftime(o_orderdate, '%b_%Y') AS label FROM {orders}")
def month_label(t):
    return ft.month_label(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "label").drop("o_orderdate")


NAMED = "SELECT p_partkey, p_name || '_Jan_2025' AS project FROM {part}"


@query("base_name", "SELECT p_partkey, p_name || '_Jan_2025' AS project, p_name || '_not_sold' AS dataset FROM {part}")
def base_name(t):
    return ft.base_name(t.sql(NAMED), "project", "Jan_2025", "dataset", "_not_sold")


CODES = """SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'bad' ELSE CAST(c_custkey * 10 AS STRING) END AS code
  FROM {customer}"""


@query("cast_code_long", f"SELECT c_custkey, try_cast(code AS BIGINT) AS code FROM ({CODES}) x")
def cast_code_long(t):
    return ft.cast_code_long(t.sql(CODES), "code")


@query("concat_text", f"SELECT p_partkey, name, kind, name || ' ' || kind AS both_texts FROM {PT}")
def concat_text(t):
    return ft.concat_text(t.sql(PART_TEXT), ["name", "kind"], "both_texts", " ")
