"""Inputs that the given tables do not have, derived from them by portable SQL.

Each statement runs unchanged on Spark (to build an operator's input) and in DuckDB (inside the comparison SQL), with
``{table}`` for a given table. Places, dates and texts come from keys by plain arithmetic, so there is one row per key
of the source table and the work grows with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.plans.listing_rules import BOOLEAN_PATHS
from parcelspark.plans.photos import FURNISHED_CLASSES, PLAIN_CLASSES
from parcelspark.sources.schemas import DEMOGRAPHICS, EXTERIOR_BOOLEANS, INTERIOR_BOOLEANS, STRUCTURE_BOOLEANS
from suite.registry import Tables


def with_ctes(ctes: dict[str, str], body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in ctes.items()) + "\n" + body


# ---------------------------------------------------------------- places

NATION_X = "(-100e0 + 10e0 * ({n} % 5))"
NATION_Y = "(5e0 + 10e0 * floor({n} / 5e0))"


def frac(key: str, factor: int, modulus: int) -> str:
    return f"((({key}) * {factor} % {modulus}) / {modulus}e0)"


def in_nation(nation: str, key: str) -> tuple[str, str]:
    x = f"({NATION_X.format(n=nation)} + 10e0 * {frac(key, 48271, 65537)})"
    y = f"({NATION_Y.format(n=nation)} + 10e0 * {frac(key, 69621, 65521)})"
    return x, y


ORDER_X, ORDER_Y = in_nation("c_nationkey", "o_orderkey + 1")
POINTS = f"""
SELECT o_orderkey AS id, 'N' || CAST(c_nationkey AS STRING) AS state, {ORDER_X} AS lon, {ORDER_Y} AS lat
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey"""

SUPPLIER_X, SUPPLIER_Y = in_nation("s_nationkey", "s_suppkey * 37 + 11")
PLACES = f"""
SELECT s_suppkey AS place_id, 'N' || CAST(s_nationkey AS STRING) AS state, {SUPPLIER_X} AS place_lon,
       {SUPPLIER_Y} AS place_lat
FROM {{supplier}}"""

# an arrow-head (concave) per supplier, from four corners
RADIUS = "(3e-1 + 2e-1 * (s_suppkey % 7))"
SHAPES = f"""
SELECT s_suppkey AS gid, 'N' || CAST(s_nationkey AS STRING) AS state,
       {SUPPLIER_X} - {RADIUS} AS ax, {SUPPLIER_Y} - {RADIUS} AS ay,
       {SUPPLIER_X} + {RADIUS} AS bx, {SUPPLIER_Y} - 8e-1 * {RADIUS} AS by0,
       {SUPPLIER_X} + 1e-1 * {RADIUS} AS cx, {SUPPLIER_Y} AS cy,
       {SUPPLIER_X} + 7e-1 * {RADIUS} AS dx, {SUPPLIER_Y} + {RADIUS} AS dy
FROM {{supplier}}"""
CORNERS = [("ax", "ay"), ("bx", "by0"), ("cx", "cy"), ("dx", "dy")]
CORNER_COLUMNS = [c for pair in CORNERS for c in pair]


def polygon_from_corners(df: DataFrame, out: str) -> DataFrame:
    ends = zip(CORNERS, CORNERS[1:] + CORNERS[:1])
    edges = [F.struct(F.col(a[0]).alias("x1"), F.col(a[1]).alias("y1"), F.col(b[0]).alias("x2"), F.col(b[1]).alias("y2"))
             for a, b in ends]
    return df.withColumn(out, F.array(*edges)).drop(*CORNER_COLUMNS)


def edges_sql(shapes: str, keep: str) -> str:
    """One row per edge from a table of corners."""
    ends = zip(CORNERS, CORNERS[1:] + CORNERS[:1])
    return " UNION ALL ".join(
        f"SELECT {keep}, {a[0]} AS x1, {a[1]} AS y1, {b[0]} AS x2, {b[1]} AS y2 FROM {shapes}" for a, b in ends)


def inside_sql(points: str, pid: str, edges: str, gid: str, lon: str = "lon", lat: str = "lat") -> str:
    return f"""
SELECT p.{pid}, e.{gid} FROM {points} p JOIN {edges} e
ON ((e.y1 > p.{lat}) <> (e.y2 > p.{lat})) AND p.{lon} < (e.x2 - e.x1) * (p.{lat} - e.y1) / (e.y2 - e.y1) + e.x1
GROUP BY p.{pid}, e.{gid} HAVING count(*) % 2 = 1"""


def unit_sql(lon: str, lat: str, p: str) -> str:
    return (f"cos(radians({lat})) * cos(radians({lon})) AS {p}x, cos(radians({lat})) * sin(radians({lon})) AS {p}y, "
            f"sin(radians({lat})) AS {p}z")


def squared_sql(a: str, b: str) -> str:
    return f"(({a}x-{b}x)*({a}x-{b}x) + ({a}y-{b}y)*({a}y-{b}y) + ({a}z-{b}z)*({a}z-{b}z))"


def metres_sql(squared: str) -> str:
    return f"(CASE WHEN {squared} IS NOT NULL THEN 12742020e0 * asin(least(1e0, sqrt({squared}) / 2e0)) END)"


def segment_sql(p: str, a: str, b: str) -> str:
    """Squared distance of p to the segment a-b, as one expression over columns like ``px``."""
    d2 = squared_sql(a, b)
    dot = " + ".join(f"({p}{c}-{a}{c})*({b}{c}-{a}{c})" for c in "xyz")
    t = f"(CASE WHEN {d2} = 0 THEN 0e0 ELSE greatest(0e0, least(1e0, ({dot}) / {d2})) END)"
    return "(" + " + ".join(f"pow({p}{c} - ({a}{c} + {t} * ({b}{c}-{a}{c})), 2)" for c in "xyz") + ")"


# ---------------------------------------------------------------- photos

PHOTO_BASE = """
SELECT 'M' || CAST(user_id % 20 AS STRING) AS mls_id, 'N' || CAST(user_id AS STRING) AS mls_number,
       'p' || CAST(event_id AS STRING) AS path, CASE WHEN event_type = 'view' THEN 0 ELSE 1 END AS indoor_photos
FROM {events}
UNION ALL
SELECT 'M' || CAST(user_id % 20 AS STRING), 'N' || CAST(user_id AS STRING), 'p' || CAST(event_id AS STRING),
       CASE WHEN event_type = 'view' THEN 0 ELSE 1 END
FROM {events} WHERE event_id % 10 = 0"""
CLASSES = PLAIN_CLASSES + FURNISHED_CLASSES


def photo_class_sql(name: str) -> str:
    j = CLASSES.index(name)
    zero = f"(event_id + {j}) % 4 < 2" + (" OR user_id % 9 = 0" if "kitchen" in name else "")
    return f"""
SELECT 'M' || CAST(user_id % 20 AS STRING) AS mls_id, 'N' || CAST(user_id AS STRING) AS mls_number,
       'p' || CAST(event_id AS STRING) AS path, CASE WHEN {zero} THEN 0 ELSE 1 END AS {name}
FROM {{events}} WHERE event_id % {j + 3} <> 0"""


def photo_inputs(t: Tables) -> tuple[DataFrame, dict[str, DataFrame]]:
    return t.sql(PHOTO_BASE), {c: t.sql(photo_class_sql(c)) for c in CLASSES}


# ---------------------------------------------------------------- listings

TEXTS = {
    "roof_types": ["comp shingle", "tile|concrete", "metal", "wood shake|flat", "Slate", "fiberglass", "other stuff"],
    "utilities": ["underground", "sewer not available", "gas: not available|water not connected", "community well",
                  "electricity", "sewernot", "water: not available"],
    "water_source": ["public", "city|not connected", "none", "private well", "culinary", "notconnected", "spring",
                     "irrigation"],
    "parking_features": ["attached", "attached: no", "garage|2 car", "no", "features: none", "detached, no|street",
                         "carport|driveway|guest", "no garage|assigned", "door opener"],
    "construction_materials": ["brick|wood", "stucco", "vinyl", "frame|stone", "site built", "concrete block", "straw"],
    "flooring": ["carpet", "hardwood|wood", "wood", "tile|ceramic", "laminate", "vinyl|linoleum", "cork"],
}


def _text_case(name: str) -> str:
    values = TEXTS[name]
    n, shift = len(values) + 2, list(TEXTS).index(name)
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    # two further residues: NULL array, empty array
    return f"CASE (k + {shift}) % {n} {whens} WHEN {n - 1} THEN '' END AS {name}_items"


def _bool_case(i: int, name: str) -> str:
    return f"CASE (k + {i * 3}) % 5 WHEN 0 THEN NULL WHEN 1 THEN false WHEN 2 THEN false ELSE true END AS {name}"


BOOLEANS = STRUCTURE_BOOLEANS + INTERIOR_BOOLEANS + EXTERIOR_BOOLEANS

LISTINGS_FLAT = f"""
SELECT 'L' || CAST(k AS STRING) AS listing_id, 'S' || CAST(k % 7 AS STRING) AS sa_mls_id,
  'N' || CAST(user_no AS STRING) AS mls_number, 'M' || CAST(user_no % 20 AS STRING) AS mls_id,
  CASE WHEN k % 10 = 0 THEN 'Off Market' WHEN k % 10 < 6 THEN 'Sold' WHEN k % 10 = 6 THEN 'Pending' ELSE 'Active' END
    AS listing_status,
  CASE WHEN k % 11 = 0 THEN 'For Rent' WHEN k % 37 = 0 THEN NULL ELSE 'For Sale' END AS listing_category,
  CASE WHEN k % 13 = 0 THEN 'Rented/Leased' ELSE 'For Sale' END AS original_listing_category,
  CASE WHEN k % 17 = 0 THEN 'Land' ELSE 'Residential' END AS property_type,
  CASE k % 4 WHEN 0 THEN 'Condominium' WHEN 1 THEN 'Townhouse' ELSE 'Single Family Detached' END AS property_subtype,
  CASE WHEN k % 19 = 0 THEN true WHEN k % 23 = 0 THEN NULL ELSE false END AS is_deleted,
  CAST(o_orderdate + INTERVAL 24 YEAR AS DATE) AS listing_dt,
  CAST(o_orderdate + INTERVAL 24 YEAR AS DATE) + CAST(k % 60 AS INT) AS close_dt,
  CAST(CASE WHEN k % 101 = 0 THEN 1700 ELSE 1900 + k % 130 END AS INT) AS year_built,
  o_totalprice AS close_price, o_totalprice * 1.02e0 AS current_listing_price,
  o_totalprice * 1.05e0 AS original_listing_price,
  CAST(CASE WHEN k % 9 = 0 THEN 50 + k % 300 WHEN k % 43 = 0 THEN NULL ELSE 500 + k % 3000 END AS DOUBLE) AS living_area,
  CASE WHEN k % 9 = 0 THEN 'SQM' ELSE 'square feet' END AS living_area_units,
  CASE k % 8 WHEN 0 THEN NULL WHEN 1 THEN 100e0 + k % 5000 WHEN 2 THEN 2000e0 + k % 40000 ELSE 1e-1 * (k % 250) END
    AS lot_size_area,
  CASE k % 8 WHEN 1 THEN 'sqm' WHEN 2 THEN 'SqFt' ELSE 'acres' END AS lot_size_units,
  CAST(CASE WHEN k % 6 = 0 THEN NULL ELSE k % 5 END AS DOUBLE) AS full_bathroom_count,
  CAST(CASE WHEN k % 41 = 0 THEN 12 WHEN k % 47 = 0 THEN NULL ELSE k % 5 + 1 END AS DOUBLE) AS total_bathroom_count,
  CAST(k % 7 AS DOUBLE) AS total_bedroom_count,
  'Text ' || CAST(k AS STRING) AS listing_description,
  'Main St ' || CAST(k AS STRING) AS address,
  CASE WHEN k % 29 = 0 THEN 'TX' WHEN k % 31 = 0 THEN NULL WHEN k % 3 = 0 THEN CAST(10000 + k % 80000 AS STRING) || '-1234'
    ELSE CAST(10000 + k % 80000 AS STRING) END AS postal_code,
  CASE WHEN k % 97 = 0 THEN NULL ELSE n_name || ' City' END AS city_long,
  'N' || CAST(n_nationkey AS STRING) AS state_prov_short, lon, lat,
  {", ".join(_bool_case(i, n) for i, n in enumerate(BOOLEANS))},
  {", ".join(_text_case(n) for n in TEXTS)},
  CAST(k % 5 AS INT) AS tour_count, CAST(k % 6 AS INT) AS photo_items, k
FROM (
  SELECT o_orderkey AS k, o_custkey % 150 AS user_no, o_orderdate, o_totalprice, n_name, n_nationkey,
         {ORDER_X} AS lon, {ORDER_Y} AS lat
  FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey
) src"""


def nested_listings(t: Tables) -> DataFrame:
    """The flat columns packed into the nested listing record. Tour 1 of a listing with two tours has no address."""
    df = t.sql(LISTINGS_FLAT)

    def items(name: str):
        c = F.col(f"{name}_items")
        return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(c, r"\|"))

    url = F.concat(F.lit("http://tour/"), F.col("k").cast("string"))
    tours = F.when(F.col("tour_count") == 0, F.array().cast("array<struct<virtual_tour_url:string>>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest("tour_count", F.lit(1))), lambda i: F.struct(
            F.when((i > 1) | (F.col("tour_count") != 2), url).alias("virtual_tour_url"))))
    photos = F.when(F.col("photo_items") == 0, F.array().cast("array<struct<url:string>>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest("photo_items", F.lit(1))),
                    lambda i: F.struct(i.cast("string").alias("url"))))
    return df.select(
        "listing_id", "sa_mls_id", "mls_number", "mls_id", "listing_status", "listing_category",
        "original_listing_category", "property_type", "property_subtype", "is_deleted", "listing_dt", "close_dt",
        F.col("listing_dt").cast("timestamp").alias("mls_updated_at_ts"), "year_built", "close_price",
        "current_listing_price", "original_listing_price", "living_area", "living_area_units", "lot_size_area",
        "lot_size_units", "full_bathroom_count", "total_bathroom_count", "total_bedroom_count", "listing_description",
        F.struct("address", "postal_code").alias("listing_address"),
        F.struct("city_long", "state_prov_short", F.struct(F.col("lon").alias("longitude"), F.col("lat").alias(
            "latitude")).alias("coordinates_gp")).alias("property_address"),
        F.struct(*STRUCTURE_BOOLEANS, *[items(n).alias(n) for n in TEXTS],
                 F.struct(*INTERIOR_BOOLEANS).alias("interior_features"),
                 F.struct(*EXTERIOR_BOOLEANS).alias("exterior_features")).alias("building_structure"),
        tours.alias("virtual_tours"), photos.alias("photo_data"))


BOOLEAN_SOURCE = {out: path.rsplit(".", 1)[-1] for out, path in BOOLEAN_PATHS.items()}

# ---------------------------------------------------------------- lookups


def box_sql(x0: str, y0: str, x1: str, y1: str) -> str:
    return f"{x0} AS ax, {y0} AS ay, {x1} AS bx, {y0} AS by0, {x1} AS cx, {y1} AS cy, {x0} AS dx, {y1} AS dy"


_X, _Y = NATION_X.format(n="n_nationkey"), NATION_Y.format(n="n_nationkey")

# four block groups per nation, the fourth missing in every fifth nation
BLOCK_GROUPS = " UNION ALL ".join(f"""
SELECT 'G' || CAST(n_nationkey AS STRING) || '_{j}' AS GEOID, 'N' || CAST(n_nationkey AS STRING) AS nation_state,
       CAST(n_nationkey AS BIGINT) * 4 + {j} AS area_no,
       {box_sql(f'{_X} + {5 * (j % 2)}e0', f'{_Y} + {5 * (j // 2)}e0', f'{_X} + {5 * (j % 2) + 5}e0', f'{_Y} + {5 * (j // 2) + 5}e0')}
FROM {{nation}}""" + (" WHERE n_nationkey % 5 <> 0" if j == 3 else "") for j in range(4))

METROS = f"""
SELECT 'Metro ' || CAST(n_nationkey AS STRING) || '{{part}}' AS metropolitan_area_name,
       CAST(1000 + n_nationkey AS STRING) AS cbsa, 'N' || CAST(n_nationkey AS STRING) AS state_prov_short,
       {box_sql(f'{_X} + {{x0}}', f'{_Y} + {{y0}}', f'{_X} + {{x1}}', f'{_Y} + {{y1}}')}
FROM {{{{nation}}}} WHERE n_nationkey % 6 <> 5"""
METROS = (METROS.format(part="a", x0="1e0", y0="1e0", x1="4e0", y1="5e0") + " UNION ALL "
          + METROS.format(part="b", x0="6e0", y0="5.5e0", x1="9e0", y1="9e0"))

MEDIA = f"""
SELECT CAST(n_nationkey AS STRING) AS key, n_name AS name, 'DMA ' || n_name AS dma_name,
       {box_sql(_X, _Y, f'{_X} + 10e0', f'{_Y} + 10e0')}
FROM {{nation}} WHERE n_nationkey % 7 <> 6"""

# every ninth block group has a code nobody knows; its reference point lies inside it
DEMOGRAPHIC_ROWS = f"""
SELECT CASE WHEN area_no % 9 = 4 THEN 'X' || GEOID ELSE GEOID END AS code, ay + 2.5e0 AS latitude,
       ax + 2.5e0 AS longitude,
       {", ".join(f"CAST((area_no * {17 + i} + {i}) % 700 AS DOUBLE) AS {c}" for i, c in enumerate(DEMOGRAPHICS) if c != "waterarea")},
       CAST(area_no % 51 AS DOUBLE) AS waterarea
FROM ({BLOCK_GROUPS}) bg"""

_MONTHS = "SELECT DISTINCT CAST(date_trunc('month', o_orderdate + INTERVAL 24 YEAR) AS DATE) AS m FROM {orders}"
_DAYS = "SELECT DISTINCT CAST(o_orderdate + INTERVAL 24 YEAR AS DATE) AS d FROM {orders}"

STATE_POPULATION = """
SELECT 'N' || CAST(n_nationkey AS STRING) AS state_prov_short, n_name AS State,
       CAST(n_nationkey AS BIGINT) * 1000 + 5 AS state_population FROM {nation}"""
CLIMATE = """
SELECT 'N' || CAST(n_nationkey AS STRING) AS state_prov_short, 40e0 + n_nationkey AS annual_temperature,
       5e-1 * n_nationkey AS tornado_index FROM {nation} WHERE n_nationkey <> 24"""
# the Thursday of a week lies in the ISO year of that week
_ISO_YEAR = "CAST(extract(YEAR FROM CAST(date_trunc('week', d) AS DATE) + 3) AS INT)"
_ISO_WEEK = "CAST(extract(WEEK FROM d) AS INT)"
MORTGAGE = f"""
SELECT close_year, num_week, 3e0 + num_week / 100e0 AS mortgage, min(d) AS DATE
FROM (SELECT d, {_ISO_YEAR} AS close_year, {_ISO_WEEK} AS num_week FROM ({_DAYS}) days) weeks
GROUP BY close_year, num_week"""
PRICE_INDEX = f"""
SELECT CAST(m AS TIMESTAMP) AS close_month, 100e0 + extract(MONTH FROM m) AS case_shiller,
       200e0 + extract(YEAR FROM m) AS home_price_index FROM ({_MONTHS}) months"""
_NATION_MONTHS = """
SELECT DISTINCT c_nationkey AS nation_no, CAST(date_trunc('month', o_orderdate + INTERVAL 24 YEAR) AS DATE) AS m
FROM {orders} JOIN {customer} ON o_custkey = c_custkey"""
UNEMPLOYMENT = f"""
SELECT CAST(m AS TIMESTAMP) AS close_month, 'N' || CAST(nation_no AS STRING) AS state_prov_short,
       4e0 + (nation_no + extract(MONTH FROM m)) / 10e0 AS unemployment_rate FROM ({_NATION_MONTHS}) nm"""
# several dates per quarter (first wins); no trend for each eleventh block group from 2022 on
QUARTER_TREND = f"""
SELECT GEOID, nation_state AS state_prov_short, CAST(m AS TIMESTAMP) AS close_dt,
       area_no * 10e0 + extract(YEAR FROM m) AS trend_geoid_quarter,
       1e0 * extract(MONTH FROM m) AS yearly_geoid_quarter
FROM ({BLOCK_GROUPS}) bg JOIN ({_NATION_MONTHS}) nm ON nation_state = 'N' || CAST(nation_no AS STRING)
WHERE area_no % 11 <> 3 OR extract(YEAR FROM m) < 2022"""
STATE_TREND = f"""
SELECT 'N' || CAST(nation_no AS STRING) AS state_prov_short, CAST(m AS TIMESTAMP) AS close_dt,
       nation_no + extract(MONTH FROM m) / 10e0 AS yearly_state
FROM ({_NATION_MONTHS}) nm WHERE nation_no % 8 <> 7 OR extract(YEAR FROM m) < 2023"""

SCHOOLS = f"""
SELECT 'O' || CAST(s_suppkey AS STRING) AS obj_id, s_name AS obj_name,
       CASE WHEN s_suppkey % 6 = 0 THEN 'PRI' ELSE 'PUB' END AS obj_subtcd,
       CASE s_suppkey % 8 WHEN 0 THEN 'P' WHEN 1 THEN 'PM' WHEN 2 THEN 'E' WHEN 3 THEN 'M' WHEN 4 THEN 'MH' WHEN 5 THEN 'S'
         WHEN 6 THEN 'H' ELSE 'X' END AS ed_level,
       'City' AS city, 'N' || CAST(s_nationkey AS STRING) AS state_prov,
       10e0 + s_suppkey % 17 AS pup_teach, s_acctbal / 1000e0 AS pov_lev,
       CASE WHEN s_suppkey % 15 = 0 THEN NULL ELSE CAST(s_suppkey * 7 % 100 AS DOUBLE) END AS pctile_y1,
       {SUPPLIER_X} AS longitude, {SUPPLIER_Y} AS latitude,
       {box_sql(f'{SUPPLIER_X} - 9e-1', f'{SUPPLIER_Y} - 9e-1', f'{SUPPLIER_X} + 9e-1', f'{SUPPLIER_Y} + 9e-1')}
FROM {{supplier}}"""


def dimensions(t: Tables) -> dict[str, DataFrame]:
    return {
        "block_groups": polygon_from_corners(t.sql(BLOCK_GROUPS), "geometry").select("GEOID", "geometry"),
        "metro_areas": polygon_from_corners(t.sql(METROS), "metro_polygon"),
        "media_areas": polygon_from_corners(t.sql(MEDIA), "geometry"),
        "demographics": t.sql(DEMOGRAPHIC_ROWS),
        "state_population": t.sql(STATE_POPULATION),
        "climate": t.sql(CLIMATE),
        "mortgage": t.sql(MORTGAGE),
        "price_index": t.sql(PRICE_INDEX),
        "unemployment": t.sql(UNEMPLOYMENT),
        "quarter_trend": t.sql(QUARTER_TREND),
        "state_trend": t.sql(STATE_TREND),
        "schools": polygon_from_corners(t.sql(SCHOOLS), "geom"),
    }
