"""Declared schemas of the nested listings source and of the lookup tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the listings source.
STRUCTURE_BOOLEANS = ["has_garage", "has_parking", "is_new_construction"]
STRUCTURE_ARRAYS = ["roof_types", "utilities", "water_source", "parking_features", "construction_materials", "flooring"]
INTERIOR_BOOLEANS = [
    "has_security_system", "has_fireplace", "is_cable_ready", "has_mother_in_law", "has_sauna", "has_skylight",
    "has_vaulted_ceiling", "has_wet_bar", "is_wired",
]
EXTERIOR_BOOLEANS = [
    "has_patio", "has_pool", "has_porch", "is_water_front", "has_hot_tub_spa", "has_barbecue_area", "has_deck",
    "has_disabled_access", "has_dock", "has_garden", "has_gated_entry", "has_green_house", "has_pond",
    "has_rv_parking", "has_sports_court", "has_sprinkler_system",
]


def _booleans(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.BooleanType()) for n in names])


BUILDING_STRUCTURE = T.StructType(
    [T.StructField(n, T.BooleanType()) for n in STRUCTURE_BOOLEANS]
    + [T.StructField(n, T.ArrayType(T.StringType())) for n in STRUCTURE_ARRAYS]
    + [T.StructField("interior_features", _booleans(INTERIOR_BOOLEANS)),
       T.StructField("exterior_features", _booleans(EXTERIOR_BOOLEANS))]
)

LISTINGS = T.StructType([
    T.StructField("listing_id", T.StringType()),
    T.StructField("sa_mls_id", T.StringType()),
    T.StructField("mls_number", T.StringType()),
    T.StructField("mls_id", T.StringType()),
    T.StructField("listing_status", T.StringType()),
    T.StructField("listing_category", T.StringType()),
    T.StructField("original_listing_category", T.StringType()),
    T.StructField("property_type", T.StringType()),
    T.StructField("property_subtype", T.StringType()),
    T.StructField("is_deleted", T.BooleanType()),
    T.StructField("listing_dt", T.DateType()),
    T.StructField("close_dt", T.DateType()),
    T.StructField("mls_updated_at_ts", T.TimestampType()),
    T.StructField("year_built", T.IntegerType()),
    T.StructField("close_price", T.DoubleType()),
    T.StructField("current_listing_price", T.DoubleType()),
    T.StructField("original_listing_price", T.DoubleType()),
    T.StructField("living_area", T.DoubleType()),
    T.StructField("living_area_units", T.StringType()),
    T.StructField("lot_size_area", T.DoubleType()),
    T.StructField("lot_size_units", T.StringType()),
    T.StructField("full_bathroom_count", T.DoubleType()),
    T.StructField("total_bathroom_count", T.DoubleType()),
    T.StructField("total_bedroom_count", T.DoubleType()),
    T.StructField("listing_description", T.StringType()),
    T.StructField("listing_address", T.StructType([
        T.StructField("address", T.StringType()), T.StructField("postal_code", T.StringType())])),
    T.StructField("property_address", T.StructType([
        T.StructField("city_long", T.StringType()),
        T.StructField("state_prov_short", T.StringType()),
        T.StructField("coordinates_gp", T.StructType([
            T.StructField("longitude", T.DoubleType()), T.StructField("latitude", T.DoubleType())]))])),
    T.StructField("building_structure", BUILDING_STRUCTURE),
    T.StructField("virtual_tours", T.ArrayType(T.StructType([T.StructField("virtual_tour_url", T.StringType())]))),
    T.StructField("photo_data", T.ArrayType(T.StructType([T.StructField("url", T.StringType())]))),
])

POLYGON = T.ArrayType(T.StructType([T.StructField(n, T.DoubleType()) for n in ("x1", "y1", "x2", "y2")]))

# Measures of the demographics table.
DEMOGRAPHICS = [
    "landarea", "waterarea", "population_density", "population_grow", "population_estimate", "population_median_age",
    "percent_white_population", "percent_black_population", "percent_asian_population",
    "percent_other_race_population", "contract_rent_percent_median", "household_income_median", "home_value_median",
]


def _fields(text: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in text.items()])


_S, _D, _L, _I, _TS = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.TimestampType()

DIMENSIONS: dict[str, T.StructType] = {
    "block_groups": _fields({"GEOID": _S, "geometry": _S}),
    "metro_areas": _fields({"metropolitan_area_name": _S, "cbsa": _S, "state_prov_short": _S, "metro_polygon": POLYGON}),
    "demographics": _fields({"code": _S, "latitude": _D, "longitude": _D, **{n: _D for n in DEMOGRAPHICS}}),
    "media_areas": _fields({"key": _S, "name": _S, "dma_name": _S, "geometry": POLYGON}),
    "schools": _fields({
        "obj_id": _S, "obj_name": _S, "obj_subtcd": _S, "ed_level": _S, "city": _S, "state_prov": _S,
        "pup_teach": _D, "pov_lev": _D, "pctile_y1": _D, "longitude": _D, "latitude": _D, "geom": POLYGON}),
    "state_population": _fields({"state_prov_short": _S, "State": _S, "state_population": _L}),
    "climate": _fields({"state_prov_short": _S, "annual_temperature": _D, "tornado_index": _D}),
    "mortgage": _fields({"close_year": _I, "num_week": _I, "mortgage": _D, "DATE": T.DateType()}),
    "price_index": _fields({"close_month": _TS, "case_shiller": _D, "home_price_index": _D}),
    "unemployment": _fields({"close_month": _TS, "state_prov_short": _S, "unemployment_rate": _D}),
    "quarter_trend": _fields({
        "GEOID": _S, "state_prov_short": _S, "close_dt": _TS, "trend_geoid_quarter": _D, "yearly_geoid_quarter": _D}),
    "state_trend": _fields({"state_prov_short": _S, "close_dt": _TS, "yearly_state": _D}),
}
