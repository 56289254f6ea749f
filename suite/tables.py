"""Whole feature tables, from nested listings derived from orders."""

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.operators.models import PHOTO_CITIES
from parcelspark.plans import listing_rules as rules
from parcelspark.plans import listings as ls
from parcelspark.plans.photos import join_scores, photo_scores, photo_tables
from parcelspark.plans.sweep import run_for_each
from parcelspark.session import scratch_path
from parcelspark.sources.schemas import DEMOGRAPHICS
from parcelspark.sources.tables import written
from suite import inputs
from suite.groups import PHOTO_CTES, bucket_sql
from suite.inputs import (BOOLEAN_SOURCE, CLIMATE, DEMOGRAPHIC_ROWS, LISTINGS_FLAT, MEDIA, MORTGAGE, PRICE_INDEX,
                          QUARTER_TREND, STATE_POPULATION, STATE_TREND, TEXTS, UNEMPLOYMENT, edges_sql, inside_sql,
                          with_ctes)
from suite.places import located_ctes, school_ctes
from suite.registry import query

AS_OF = date(2025, 7, 15)


def words_sql(c, words):
    return "(" + " OR ".join(f"{c} LIKE '%{w}%'" for w in words) + ")"


def flag(condition, out):
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END AS {out}"


def flags_sql() -> list[str]:
    """The keyword flags as CASE expressions."""
    out = [flag("roof_types IS NULL", "no_roof_type")]
    out += [flag(words_sql("roof_types", w), k) for k, w in rules.ROOF_WORDS.items()]
    out.append(flag("water_source IS NULL OR water_source = 'none'", "no_water_source"))
    out.append(flag(words_sql("water_source", rules.PUBLIC_WATER_WORDS)
                    + " AND water_source NOT LIKE '%not connected%'", "public_water"))
    out += [flag(words_sql("water_source", w), k) for k, w in rules.WATER_WORDS.items()]
    for name, spec in (("well_water", rules.WELL_WATER), ("not_connected_water", rules.NOT_CONNECTED_WATER)):
        out.append(flag(" OR ".join(words_sql(c, w) for c, w in spec.items()), name))
    out.append(flag("utilities LIKE '%underground%'", "underground_utilities"))
    for name, words in (("sewer", rules.SEWER_NEGATIVES), ("natural_gas", rules.GAS_NEGATIVES)):
        out.append(f"CASE WHEN {words_sql('utilities', words)} THEN 0 ELSE 1 END AS {name}")
    out.append(flag("parking_features IS NULL OR parking_features IN ('no', 'none', 'features: none')",
                    "no_parking_features"))
    for name, (word, negatives) in rules.PARKING_NEGATABLE.items():
        none = " OR ".join(f"parking_features NOT LIKE '%{n}%'" for n in negatives)
        out.append(flag(f"parking_features LIKE '%{word}%' AND ({none})", name))
    out += [flag(words_sql("parking_features", w), k) for k, w in rules.PARKING_WORDS.items()]
    out.append(flag("construction_materials IS NULL", "no_construction_materials"))
    out += [flag(words_sql("construction_materials", w), k) for k, w in rules.MATERIAL_WORDS.items()]
    out.append(flag("flooring IS NULL", "no_floorings_info"))
    out += [flag(words_sql("flooring", w), k) for k, w in rules.FLOOR_WORDS.items()]
    out.append(flag("flooring LIKE '%wood%' AND flooring NOT LIKE '%hardwood%'", "wood_floorings"))
    return out


OTHERS = [flag(" AND ".join(f"{f} = 0" for f in family), out) for out, family in ls.OTHER_FLAGS.items()]
FLAG_NAMES = [f.rsplit(" AS ", 1)[1] for f in flags_sql() + OTHERS]
BAD = ", ".join("'" + b + "'" for b in rules.BAD_POSTCODES)


def half_up(c):
    return f"CAST(floor({c} + 5e-1) AS BIGINT)"


def base_ctes(kind: str, sold: bool, since: str = "DATE '2019-01-01'") -> dict[str, str]:
    """From the flat listings to ``base``, one row per listing (the tours of a derived listing differ by address only)."""
    subtypes = ", ".join(f"'{s}'" for s in rules.SUBTYPES[kind])
    tests = f"""postal_code IS NOT NULL AND postal_code NOT IN ({BAD}) AND is_deleted = false
        AND lower(property_type) IN ('residential', 'residential income', 'common interest', 'residental')
        AND lower(property_subtype) IN ({subtypes})
        AND listing_category NOT IN ('For Rent', 'Rent', 'Rented/Leased')
        AND original_listing_category NOT IN ('For Rent', 'Rent', 'Rented/Leased') AND listing_dt >= DATE '2013-01-01'"""
    if sold:
        tests += f""" AND close_dt >= {since} AND year_built <= {AS_OF.year + 1} AND year_built > 1800
        AND close_price >= {rules.PRICE_FLOOR[kind]} AND close_price <= 4000000
        AND (full_bathroom_count < 10 OR total_bathroom_count < 10) AND total_bedroom_count < 10
        AND lower(listing_status) IN ('sold', 'off market')"""
    else:
        tests += " AND current_listing_price > 0 AND lower(listing_status) IN ('active', 'pending')"
    texts = ", ".join(f"nullif(replace({c}_items, '|', ', '), '') AS {c}" for c in TEXTS)
    booleans = ", ".join(flag(f"{src} = true", out) for out, src in BOOLEAN_SOURCE.items())
    area = f"""CASE WHEN lower(living_area_units) IN ('square meters', 'sqm', 'sm')
        THEN {half_up('living_area * 10.76391041671e0')} ELSE {half_up('living_area')} END"""
    lot = """CASE WHEN lower(lot_size_units) = 'sqm' THEN lot_size_area * 0.000247105e0
        WHEN lower(lot_size_units) IN ('sqft', 'square feet') THEN lot_size_area * 0.0000229568e0 ELSE lot_size_area END"""
    sold_columns = f"listing_status, {half_up('close_price')} AS close_price, close_dt," if sold else \
        f"DATE '{AS_OF}' AS close_dt,"
    where = ("WHERE living_area > 0 AND living_area < 10000 AND tour_count > 0 AND close_dt - listing_dt > 0"
             if sold else "WHERE tour_count > 0")
    lot_test = "WHERE lot IS NULL OR lot BETWEEN 0 AND 20" if sold else ""
    return {
        "origin": f"SELECT * FROM ({LISTINGS_FLAT}) flat WHERE {tests}",
        "flat1": f"""SELECT listing_id, sa_mls_id, mls_number, mls_id, {sold_columns}
            CAST(year(listing_dt) - year_built AS INTEGER) AS building_years_old,
            {half_up('current_listing_price')} AS current_listing_price, lower(address) AS address,
            lower(city_long) AS city_long, state_prov_short, postal_code,
            CASE WHEN length(postal_code) > 5 THEN split_part(postal_code, '-', 1) ELSE postal_code END AS postal_code_short,
            lon, lat, {area} AS living_area, {lot} AS lot,
            {', '.join(half_up(c) + f' AS {c}' for c in ('total_bedroom_count', 'full_bathroom_count', 'total_bathroom_count'))},
            {booleans}, 1 AS virtual_tour_ind, {texts},
            CASE WHEN photo_items > 0 THEN photo_items END AS photo_count FROM origin {where}""",
        "flagged": f"SELECT *, coalesce(lot, 0e0) AS lot_size_area, {', '.join(flags_sql())} FROM flat1 {lot_test}",
        "base": f"SELECT *, {', '.join(OTHERS)} FROM flagged",
    }


DEMO = ", ".join(DEMOGRAPHICS)


def table_ctes(kind: str, sold: bool, since: str = "DATE '2019-01-01'", more: str = "") -> dict[str, str]:
    """All steps up to ``raw``; ``more`` restricts the base rows."""
    ctes = base_ctes(kind, sold, since)
    ctes["wanted"] = f"SELECT * FROM base {more}"
    ctes["listed"] = "SELECT listing_id, lon, lat, state_prov_short FROM wanted WHERE lat BETWEEN -90 AND 90"
    ctes |= located_ctes("listed")
    bounds = """WHERE landarea < 1000 AND waterarea < 50 AND population_density < 150000 AND population_grow < 10000
        AND population_grow > -1000 AND population_estimate < 8000 AND population_estimate > -750""" if sold else ""
    ctes |= {
        "demo": DEMOGRAPHIC_ROWS,
        "unknown": "SELECT * FROM bge WHERE GEOID NOT IN (SELECT code FROM demo)",
        "demo_in": inside_sql("demo", "code", "unknown", "GEOID", "longitude", "latitude"),
        "by_area": f"SELECT code AS GEOID, {DEMO} FROM demo UNION ALL "
                   f"SELECT demo_in.GEOID, {DEMO} FROM demo_in JOIN demo ON demo_in.code = demo.code",
        "d1": f"SELECT l.*, {DEMO} FROM located l JOIN by_area ON l.GEOID = by_area.GEOID {bounds}",
        "dated": "SELECT d1.*, w.close_dt, CAST(date_trunc('month', w.close_dt) AS DATE) AS month_day "
                 "FROM d1 JOIN wanted w ON d1.listing_id = w.listing_id",
        "mort": MORTGAGE, "idx": PRICE_INDEX, "unemp": UNEMPLOYMENT, "pop": STATE_POPULATION, "clim": CLIMATE,
        "media": MEDIA, "mde": edges_sql("media", "dma_name"),
        "in_media": inside_sql("dated", "listing_id", "mde", "dma_name"),
        "econ": """SELECT d.*, state_population, annual_temperature, tornado_index, mortgage, case_shiller, home_price_index,
            unemployment_rate FROM dated d JOIN in_media ON d.listing_id = in_media.listing_id
            LEFT JOIN pop ON pop.state_prov_short = d.state_prov_short
            LEFT JOIN clim ON clim.state_prov_short = d.state_prov_short
            LEFT JOIN mort ON mort.close_year = isoyear(d.close_dt) AND mort.num_week = weekofyear(d.close_dt)
            LEFT JOIN idx ON CAST(idx.close_month AS DATE) = d.month_day
            LEFT JOIN unemp ON CAST(unemp.close_month AS DATE) = d.month_day
              AND unemp.state_prov_short = d.state_prov_short""",
        **school_ctes("econ"),
        "qt": f"""SELECT * FROM ({QUARTER_TREND}) q QUALIFY row_number() OVER (
            PARTITION BY GEOID, state_prov_short, year(close_dt), quarter(close_dt) ORDER BY close_dt) = 1""",
        "st": f"""SELECT * FROM ({STATE_TREND}) s QUALIFY row_number() OVER (
            PARTITION BY state_prov_short, year(close_dt), month(close_dt) ORDER BY close_dt) = 1""",
    }
    join = "JOIN" if sold else "LEFT JOIN"
    complete = " AND ".join(f"{c} IS NOT NULL" for c in ls.COMPLETE)
    keep = "listing_status, close_price," if sold else "sa_mls_id, e.GEOID,"
    ctes["raw"] = f"""SELECT * FROM (SELECT w.listing_id, w.mls_number, w.mls_id, {keep} building_years_old,
        current_listing_price, address, city_long, w.state_prov_short, postal_code, postal_code_short, w.lat AS latitude,
        w.lon AS longitude, w.close_dt, living_area, lot_size_area, total_bedroom_count,
        coalesce(full_bathroom_count, total_bathroom_count) AS full_bathroom_count, {', '.join(BOOLEAN_SOURCE)},
        virtual_tour_ind, photo_count, {', '.join(FLAG_NAMES)}, e.metropolitan_area_name, e.cbsa, {DEMO},
        {', '.join(rules.ECONOMY_COLUMNS)}, {', '.join(rules.SCHOOL_COLUMNS)},
        qt.trend_geoid_quarter, qt.yearly_geoid_quarter, st.yearly_state
        FROM wanted w JOIN econ e ON w.listing_id = e.listing_id JOIN school_of ON school_of.listing_id = w.listing_id
        {join} qt ON qt.GEOID = e.GEOID AND qt.state_prov_short = w.state_prov_short
          AND year(qt.close_dt) = year(w.close_dt) AND quarter(qt.close_dt) = quarter(w.close_dt)
        {join} st ON st.state_prov_short = w.state_prov_short AND year(st.close_dt) = year(w.close_dt)
          AND month(st.close_dt) = month(w.close_dt)) r WHERE {complete}"""
    if not sold:
        ctes |= {
            "ql": f"""SELECT GEOID, trend_geoid_quarter AS t2, yearly_geoid_quarter AS y2 FROM ({QUARTER_TREND}) q
                WHERE close_dt < TIMESTAMP '{AS_OF}'
                QUALIFY row_number() OVER (PARTITION BY GEOID ORDER BY close_dt DESC, state_prov_short) = 1""",
            "sl": f"""SELECT state_prov_short, yearly_state AS s2 FROM ({STATE_TREND}) s
                WHERE close_dt < TIMESTAMP '{AS_OF}'
                QUALIFY row_number() OVER (PARTITION BY state_prov_short ORDER BY close_dt DESC) = 1""",
            "filled": """SELECT raw.* EXCLUDE (trend_geoid_quarter, yearly_geoid_quarter, yearly_state),
                coalesce(trend_geoid_quarter, t2, 0e0) AS trend_geoid_quarter,
                CASE WHEN trend_geoid_quarter IS NULL THEN coalesce(yearly_geoid_quarter, y2, 0e0)
                  ELSE coalesce(yearly_geoid_quarter, 0e0) END AS yearly_geoid_quarter,
                coalesce(yearly_state, s2, 0e0) AS yearly_state
                FROM raw LEFT JOIN ql ON raw.GEOID = ql.GEOID LEFT JOIN sl ON raw.state_prov_short = sl.state_prov_short""",
        }
    return ctes


SOLD_OUT = """SELECT * EXCLUDE (city_long, address, mls_id, mls_number, listing_status, metropolitan_area_name, cbsa,
  postal_code, postal_code_short, state_prov_short, current_listing_price) FROM raw"""
NOTSOLD_OUT = """SELECT * EXCLUDE (GEOID, city_long, address, mls_id, mls_number, metropolitan_area_name, cbsa, postal_code,
  postal_code_short, state_prov_short, current_listing_price, sa_mls_id) FROM filled"""


@query("build_sold_features", with_ctes(table_ctes("houses", True), SOLD_OUT))
def build_sold_features(t):
    return ls.build_sold_features(inputs.nested_listings(t), inputs.dimensions(t), "houses", AS_OF)


@query("build_notsold_features", with_ctes(table_ctes("condos", False), NOTSOLD_OUT))
def build_notsold_features(t):
    return ls.build_notsold_features(inputs.nested_listings(t), inputs.dimensions(t), "condos", AS_OF)


# ids that end in an even digit are known already
KNOWN = "SELECT 'L' || CAST(o_orderkey AS STRING) AS listing_id FROM {orders} WHERE o_orderkey % 2 = 0"
NEW_ONLY = "WHERE listing_id NOT IN (SELECT listing_id FROM known)"


@query("build_month_increment", with_ctes(
    {"known": KNOWN, **table_ctes("houses", True, "DATE '2025-04-15'", NEW_ONLY)},
    SOLD_OUT.replace("FROM raw", "FROM (SELECT raw.*, CAST(raw.close_dt - o.listing_dt AS INTEGER) AS day_on_market "
                                 "FROM raw JOIN origin o ON raw.listing_id = o.listing_id) raw")))
def build_month_increment(t):
    stages = ls.build_month_increment(inputs.nested_listings(t), t.sql(KNOWN), inputs.dimensions(t), "houses", AS_OF)
    return stages["final"]


@query("append_stages", with_ctes(
    {"known": KNOWN, **base_ctes("houses", True, "DATE '2025-04-15'")},
    f"SELECT listing_id FROM known UNION ALL SELECT listing_id FROM base {NEW_ONLY}"))
def append_stages(t):
    path = scratch_path(t.spark, "history")
    t.sql(KNOWN).write.parquet(path)
    recent = ls.base_sold(inputs.nested_listings(t), "houses", AS_OF, rules.INCREMENT_MONTHS)
    new = written(recent.select("listing_id").distinct())
    ls.append_stages({"base": new}, {"base": path})
    ls.append_stages({"base": new}, {"base": path})  # a second run adds nothing
    return t.spark.read.parquet(path)


@query("rebuild_from_base", with_ctes(table_ctes("condos", True), SOLD_OUT))
def rebuild_from_base(t):
    base = written(ls.base_sold(inputs.nested_listings(t), "condos", AS_OF))
    return ls.rebuild_from_base(base, inputs.dimensions(t), True, AS_OF)


CITY_OF = "SELECT DISTINCT 'M' || CAST(user_id % 20 AS STRING) AS mls_id, 'N' || CAST(user_id AS STRING) AS mls_number, CAST(CASE user_id % 4 WHEN 0 THEN 12420 WHEN 1 THEN 12060 WHEN 2 THEN 42660 ELSE 1 END AS BIGINT) AS cbsa, user_id AS listing_id, 'x' AS address FROM {events}"


@query("run_for_each", with_ctes({**PHOTO_CTES, "city_of": CITY_OF}, """
SELECT scores.* EXCLUDE (mls_id, mls_number), c.listing_id,
 CASE c.cbsa WHEN 12420 THEN 'austin' WHEN 12060 THEN 'atlanta' ELSE 'seattle' END AS run
FROM scores JOIN city_of c ON scores.mls_id = c.mls_id AND scores.mls_number = c.mls_number WHERE c.cbsa > 1"""))
def run_for_each_query(t):
    scores = written(photo_scores(*inputs.photo_inputs(t)))

    def build(metro):
        return join_scores(scores, t.sql(CITY_OF), metro, ["mls_id", "mls_number", "cbsa", "address"])

    return run_for_each(build, {city: {"metro": code} for city, code in PHOTO_CITIES.items()})


# listings of two kinds, sold and open, with the columns that the tables with photo scores leave out
WITH_PHOTOS = """SELECT DISTINCT 'M' || CAST(user_id % 20 AS STRING) AS mls_id, 'N' || CAST(user_id AS STRING) AS mls_number,
  CAST(CASE user_id % 4 WHEN 0 THEN 12420 WHEN 1 THEN 12060 WHEN 2 THEN 42660 ELSE 1 END AS BIGINT) AS cbsa, user_id AS listing_id,
  'x' AS city_long, 'x' AS address, 'x' AS metropolitan_area_name, 'x' AS postal_code, 'x' AS postal_code_short, 'x' AS state_prov_short,
  1 AS current_listing_price, 'Sold' AS listing_status, 'g' AS GEOID, 's' AS sa_mls_id FROM {events}"""
PHOTO_KINDS = {("houses", True): 0, ("houses", False): 1, ("condos", True): 2, ("condos", False): 3}


@query("photo_tables", with_ctes({**PHOTO_CTES, "listed": WITH_PHOTOS}, "\nUNION ALL ".join(f"""
SELECT scores.* EXCLUDE (mls_id, mls_number), l.listing_id, '{kind}' AS kind, {str(sold).lower()} AS sold,
 CASE l.cbsa WHEN 12420 THEN 'austin' WHEN 12060 THEN 'atlanta' ELSE 'seattle' END AS city
FROM scores JOIN listed l ON scores.mls_id = l.mls_id AND scores.mls_number = l.mls_number
WHERE l.cbsa > 1 AND l.listing_id % 5 <> {rest}""" for (kind, sold), rest in PHOTO_KINDS.items())))
def photo_tables_query(t):
    scores, listed = written(photo_scores(*inputs.photo_inputs(t))), t.sql(WITH_PHOTOS)
    parts = {k: listed.filter(F.col("listing_id") % 5 != rest) for k, rest in PHOTO_KINDS.items()}
    made = photo_tables(scores, {k: parts[k, True] for k in ("houses", "condos")}, {k: parts[k, False] for k in ("houses", "condos")})
    left = {True: ["GEOID", "sa_mls_id"], False: ["listing_status"]}  # what only the other kind of table leaves out
    return reduce(DataFrame.unionByName, [df.drop(*left[sold]).withColumns({"kind": F.lit(kind), "sold": F.lit(sold)})
                                          for (kind, sold), df in made.items()])


@query("sampled_training_table", f"SELECT o_orderkey AS listing_id, o_totalprice FROM {{orders}} WHERE {bucket_sql('o_orderkey', 10000)} < 2500")
def sampled_training_table(t):
    final = t.orders.select(F.col("o_orderkey").alias("listing_id"), "o_totalprice")
    assert ls.sampled_training_table(final, "condos") is None
    return ls.sampled_training_table(final, "houses")
