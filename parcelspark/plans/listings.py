"""Sold and not-sold listing feature tables.

Shape of the plan: listings are wide (about 110 columns), enrichment needs five of them. So location, demographics,
economy, schools and trends are worked out on a narrow table keyed by listing id, and the wide rows are shuffled once,
by listing id, to meet the result. The stage functions take any rows with those key columns, so they also build the
wide stage tables where a user keeps them.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.functions import flags as fl
from parcelspark.functions import scalars as sc
from parcelspark.operators import features as ft
from parcelspark.operators import filters as flt
from parcelspark.operators.aggregates import max_per_group
from parcelspark.operators.joins import backfill_latest, join_dimensions_left, join_not_in, join_time_trend
from parcelspark.operators.setops import sample_fraction
from parcelspark.operators.spatial import Materialize, key_else_spatial, spatial_join
from parcelspark.operators.windows import top1
from parcelspark.plans import listing_rules as rules
from parcelspark.plans.location import enrich_location
from parcelspark.plans.schools import assign_schools
from parcelspark.sources.runs import read_parts, write_part
from parcelspark.sources.schemas import DEMOGRAPHICS
from parcelspark.sources.tables import append_aligned, read_target, written

KEY = "listing_id"
NARROW = [KEY, "lon", "lat", "state_prov_short", "close_dt"]
# decides which of several rows of one listing stays
TIES = ["mls_id", "mls_number", "sa_mls_id", "address", "postal_code", "living_area", "lot_size_area",
        "current_listing_price", "year_built", "photo_count"]

COMPLETE = [
    "city_long", "state_prov_short", "living_area", "total_bedroom_count", "full_bathroom_count",
    *rules.BOOLEAN_PATHS, "building_years_old", "virtual_tour_ind", "photo_count", *DEMOGRAPHICS,
    *rules.ECONOMY_COLUMNS, *rules.SCHOOL_COLUMNS,
]


def _selected(listings: DataFrame, kind: str) -> DataFrame:
    """Tests that sold and not-sold listings share. All of them reach the scan."""
    df = flt.filter_denylist(listings, "listing_address.postal_code", rules.BAD_POSTCODES)
    df = flt.filter_flag(df, "is_deleted", False)
    df = flt.filter_allowlist_ci(df, "property_type", rules.PROPERTY_TYPES)
    df = flt.filter_allowlist_ci(df, "property_subtype", rules.SUBTYPES[kind])
    df = flt.filter_exclude_categories(df, ["listing_category", "original_listing_category"], rules.RENTAL_CATEGORIES)
    return flt.filter_bounds(df, {"listing_dt": (rules.FIRST_LISTING, None)})


def select_sold(listings: DataFrame, kind: str, as_of: date, months: int | None = None) -> DataFrame:
    """Closed sales; with ``months``, only those closed in the last months before ``as_of``."""
    df = _selected(listings, kind)
    if months is None:
        df = flt.filter_bounds(df, {"close_dt": (rules.FIRST_CLOSING, None)})
    else:
        df = flt.filter_recent(df, "close_dt", months, as_of)
    df = flt.filter_bounds(df, {"close_price": (rules.PRICE_FLOOR[kind], rules.PRICE_CEILING),
                                "year_built": (rules.OLDEST_YEAR_BUILT + 1, as_of.year + 1)})
    df = flt.filter_any_bound(df, ["full_bathroom_count", "total_bathroom_count"], rules.ROOMS_BELOW)
    df = flt.filter_bounds(df, {"total_bedroom_count": (None, rules.ROOMS_BELOW)}, inclusive=False)
    return flt.filter_allowlist_ci(df, "listing_status", rules.SOLD_STATUSES)


def select_open(listings: DataFrame, kind: str) -> DataFrame:
    df = flt.filter_bounds(_selected(listings, kind), {"current_listing_price": (0, None)}, inclusive=False)
    return flt.filter_allowlist_ci(df, "listing_status", rules.OPEN_STATUSES)


def text_flags() -> dict:
    """Keyword flags of the six text columns, then one 'other' flag per family."""
    out = {"no_roof_type": fl.is_missing("roof_types")}
    out |= {k: fl.has_word("roof_types", w) for k, w in rules.ROOF_WORDS.items()}
    out["no_water_source"] = fl.is_missing("water_source", rules.WATER_NONE_WORDS)
    out["public_water"] = fl.has_word_except("water_source", rules.PUBLIC_WATER_WORDS, rules.PUBLIC_WATER_UNLESS)
    out["well_water"] = fl.has_word_in_any(rules.WELL_WATER)
    out["not_connected_water"] = fl.has_word_in_any(rules.NOT_CONNECTED_WATER)
    out |= {k: fl.has_word("water_source", w) for k, w in rules.WATER_WORDS.items()}
    out |= {k: fl.has_word("utilities", w) for k, w in rules.UTILITY_WORDS.items()}
    out["sewer"] = fl.true_unless_word("utilities", rules.SEWER_NEGATIVES)
    out["natural_gas"] = fl.true_unless_word("utilities", rules.GAS_NEGATIVES)
    out["no_parking_features"] = fl.is_missing("parking_features", rules.PARKING_NONE_WORDS)
    for k, (word, negatives) in rules.PARKING_NEGATABLE.items():
        out[k] = fl.has_word_weakly_negated("parking_features", word, negatives)
    out |= {k: fl.has_word("parking_features", w) for k, w in rules.PARKING_WORDS.items()}
    out["no_construction_materials"] = fl.is_missing("construction_materials")
    out |= {k: fl.has_word("construction_materials", w) for k, w in rules.MATERIAL_WORDS.items()}
    out["no_floorings_info"] = fl.is_missing("flooring")
    out |= {k: fl.has_word("flooring", w) for k, w in rules.FLOOR_WORDS.items()}
    out["wood_floorings"] = fl.has_word_except("flooring", *rules.WOOD_FLOOR)
    return out


OTHER_FLAGS = {
    "other_roof_type": ["no_roof_type", *rules.ROOF_WORDS],
    "other_water_source": ["no_water_source", "public_water", "well_water", "not_connected_water", *rules.WATER_WORDS],
    "other_construction_materials": ["no_construction_materials", *rules.MATERIAL_WORDS],
    "other_floorings": ["no_floorings_info", *rules.FLOOR_WORDS, "wood_floorings"],
}


def _flat(selected: DataFrame, sold: bool) -> DataFrame:
    """Nested listings to flat typed columns, one row per virtual tour."""
    tours = ft.explode_inner(selected, "virtual_tours", "tour")
    texts = {c: sc.joined_text(f"building_structure.{c}") for c in rules.TEXT_COLUMNS}
    columns = {
        **{c: F.col(c) for c in (KEY, "sa_mls_id", "mls_number", "mls_id")},
        "year_added": F.year("listing_dt"),
        "year_built": sc.year_or_null("year_built"),
        "current_listing_price": sc.rounded_long("current_listing_price"),
        "original_listing_price": sc.rounded_long("original_listing_price"),
        "address": F.lower("listing_address.address"),
        "city_long": F.lower("property_address.city_long"),
        "state_prov_short": F.col("property_address.state_prov_short"),
        "postal_code": F.col("listing_address.postal_code"),
        "postal_code_short": sc.postal_stem("listing_address.postal_code"),
        "lon": F.col("property_address.coordinates_gp.longitude"),
        "lat": F.col("property_address.coordinates_gp.latitude"),
        **{c: F.col(c) for c in ("listing_dt", "original_listing_category", "property_type", "property_subtype")},
        "living_area": sc.living_area_sqft("living_area", "living_area_units"),
        "lot_size_area": sc.lot_acres("lot_size_area", "lot_size_units"),
        **{c: sc.rounded_long(c) for c in ("total_bedroom_count", "full_bathroom_count", "total_bathroom_count")},
        **{out: fl.as_flag(F.col(path)) for out, path in rules.BOOLEAN_PATHS.items()},
        "virtual_tour_ind": F.col("tour.virtual_tour_url").isNotNull().cast("int"),
        **texts,
    }
    if sold:
        columns |= {"listing_status": F.col("listing_status"), "close_price": sc.rounded_long("close_price"),
                    "close_dt": F.col("close_dt")}
    return tours.select([c.alias(name) for name, c in columns.items()])


def _features(flat: DataFrame, selected: DataFrame) -> DataFrame:
    """Age, photo count and keyword flags; the texts themselves are not carried on."""
    photos = max_per_group(selected, KEY, "photo_data", "photo_count")
    df = ft.age_at_listing(ft.fill_default(flat, ["lot_size_area"], 0.0), "year_added", "year_built")
    df = df.withColumns(text_flags()).drop(*rules.TEXT_COLUMNS)
    df = df.withColumns({out: fl.none_set(family) for out, family in OTHER_FLAGS.items()})
    return df.join(photos, KEY, "left")


def base_sold(listings: DataFrame, kind: str, as_of: date, months: int | None = None,
              with_days_on_market: bool = False) -> DataFrame:
    """Cleaned sold listings with all flags, one row per listing and virtual tour."""
    selected = select_sold(listings, kind, as_of, months)
    # the area test is on the stored number, before units; the lot test on acres, before NULL becomes 0
    low, high = rules.LIVING_AREA
    flat = _flat(flt.filter_bounds(selected, {"living_area": (low, high)}, inclusive=False), sold=True)
    flat = flt.filter_positive_duration(flat, "listing_dt", "close_dt")
    flat = flt.filter_null_or_between(flat, "lot_size_area", *rules.LOT_ACRES)
    if with_days_on_market:
        flat = ft.days_on_market(flat, "listing_dt", "close_dt")
    return _features(flat, selected)


def base_notsold(listings: DataFrame, kind: str) -> DataFrame:
    selected = select_open(listings, kind)
    return _features(_flat(selected, sold=False), selected)


def one_row_per_listing(base: DataFrame, located: DataFrame) -> DataFrame:
    """Base rows at the chosen location of their listing, one per listing, with the location columns.

    ``located`` holds one row per listing. The base is reduced to one row per listing and place first: copies of one
    listing, however many, leave each input task as a single row, and the join reuses that partitioning.
    """
    state = F.coalesce("state_prov_short", F.lit(""))
    place = [KEY, "lon", "lat", "at_state"]
    single = top1(base.withColumn("at_state", state), place, [F.col("virtual_tour_ind").desc(), *TIES])
    here = located.withColumn("at_state", state).drop("state_prov_short")
    return single.join(here, place).drop("at_state")


def add_location(base: DataFrame, dims: Mapping[str, DataFrame], materialize: Materialize = written) -> DataFrame:
    """Block group, metro name and code; one row per listing."""
    located = enrich_location(base.select(KEY, "lon", "lat", "state_prov_short"), dims["block_groups"],
                              dims["metro_areas"], materialize)
    return one_row_per_listing(base, located)


def add_demographics(df: DataFrame, dims: Mapping[str, DataFrame], bounded: bool) -> DataFrame:
    """Block-group measures by code, or by the reference point inside the polygon."""
    reference = dims["demographics"].select("code", "latitude", "longitude", *DEMOGRAPHICS)
    out = key_else_spatial(df, reference, "GEOID", "code", dims["block_groups"], "geometry", "longitude", "latitude")
    return flt.filter_bounds(out, rules.DEMOGRAPHIC_BOUNDS, inclusive=False) if bounded else out


def add_economy(df: DataFrame, dims: Mapping[str, DataFrame], date_col: str = "close_dt") -> DataFrame:
    """State, week and month measures, then the media areas (rows outside all of them are dropped)."""
    dated = ft.iso_week_parts(df, date_col, "iso_year", "num_week").withColumn(
        "month_day", sc.month_start_of(date_col))
    state = ["state_prov_short"]

    def monthly(name: str) -> DataFrame:
        return dims[name].withColumn("month_day", F.to_date("close_month")).drop("close_month")

    joined = join_dimensions_left(dated, [
        (dims["state_population"].drop("State"), state),
        (dims["climate"], state),
        (dims["mortgage"].drop("DATE").withColumnRenamed("close_year", "iso_year"), ["iso_year", "num_week"]),
        (monthly("price_index"), ["month_day"]),
        (monthly("unemployment"), ["month_day", *state]),
    ]).drop("iso_year", "num_week", "month_day")
    areas = spatial_join(joined.select(KEY, "lon", "lat"), dims["media_areas"].select("geometry"), "lon", "lat",
                         "geometry")
    return joined.join(areas.select(KEY), KEY)


def add_schools(df: DataFrame, dims: Mapping[str, DataFrame], materialize: Materialize = written) -> DataFrame:
    """School measures of three levels; listings without any school are dropped."""
    where = df.select(KEY, "lon", "lat", "state_prov_short").distinct()
    return df.join(assign_schools(where, dims["schools"], materialize), KEY)


def _finished(df: DataFrame, quarter_trend: DataFrame, state_trend: DataFrame, how: str) -> DataFrame:
    joined = join_time_trend(df, quarter_trend, state_trend, how=how)
    return joined.drop("close_year", "close_month", "quarter").withColumnsRenamed(
        {"lat": "latitude", "lon": "longitude"})


_DROPPED_BY_RAW = ["listing_dt", "property_subtype", "original_listing_price", "original_listing_category",
                   "property_type", "year_added", "year_built"]
_DROPPED_BY_SOLD = ["city_long", "address", "mls_id", "mls_number", "listing_status", "metropolitan_area_name", "cbsa",
                    "postal_code", "postal_code_short", "state_prov_short", "current_listing_price"]
_DROPPED_BY_NOTSOLD = ["GEOID", "city_long", "address", "mls_id", "mls_number", "metropolitan_area_name", "cbsa",
                       "postal_code", "postal_code_short", "state_prov_short", "current_listing_price", "sa_mls_id"]


def _complete(df: DataFrame) -> DataFrame:
    bathed = ft.fallback_column(df, "full_bathroom_count", "total_bathroom_count", "full_bathroom_count")
    return flt.require_complete(bathed.drop(*_DROPPED_BY_RAW), COMPLETE)


def sold_raw(base: DataFrame, dims: Mapping[str, DataFrame], materialize: Materialize = written) -> DataFrame:
    """Sold feature table with identifiers. Enrichment runs on narrow rows (see the module text)."""
    keys = base.select(NARROW)
    located = enrich_location(keys.drop("close_dt"), dims["block_groups"], dims["metro_areas"],
                              materialize)
    chosen = materialize(one_row_per_listing(base, located))
    narrow = chosen.select(*NARROW, "GEOID")
    enriched = materialize(add_economy(add_demographics(narrow, dims, bounded=True), dims))
    enriched = ft.calendar_parts(add_schools(enriched, dims, materialize), "close_dt")
    trended = _finished(enriched, dims["quarter_trend"], dims["state_trend"], "inner")
    added = trended.drop("longitude", "latitude", "state_prov_short", "close_dt", "GEOID")
    wide = chosen.join(added, KEY)
    return _complete(wide).drop("sa_mls_id", "GEOID").withColumnsRenamed({"lat": "latitude", "lon": "longitude"})


def sold_final(raw: DataFrame) -> DataFrame:
    return raw.drop(*_DROPPED_BY_SOLD)


def build_sold_features(listings: DataFrame, dims: Mapping[str, DataFrame], kind: str, as_of: date,
                        materialize: Materialize = written) -> DataFrame:
    """Training table of sold listings."""
    return sold_final(sold_raw(base_sold(listings, kind, as_of), dims, materialize))


def notsold_raw(base: DataFrame, dims: Mapping[str, DataFrame], as_of: date, iso_year: bool = False,
                materialize: Materialize = written) -> DataFrame:
    """Scoring table with identifiers; every row is dated ``as_of``.

    ``iso_year`` joins the trends by the ISO year of ``as_of`` instead of its calendar year; the two differ only around
    New Year.
    """
    located = enrich_location(base.select(NARROW[:-1]), dims["block_groups"], dims["metro_areas"],
                              materialize)
    chosen = materialize(one_row_per_listing(ft.stamp_as_of(base, as_of), located))
    narrow = chosen.select(*NARROW, "GEOID")
    enriched = materialize(add_economy(add_demographics(narrow, dims, bounded=False), dims))
    enriched = ft.calendar_parts(add_schools(enriched, dims, materialize), "close_dt")
    if iso_year:
        enriched = enriched.withColumn("close_year", sc.iso_year("close_dt"))
    trended = _finished(enriched, dims["quarter_trend"], dims["state_trend"], "left")
    added = trended.drop("longitude", "latitude", "state_prov_short", "close_dt", "GEOID")
    return _complete(chosen.join(added, KEY)).withColumnsRenamed({"lat": "latitude", "lon": "longitude"})


def fill_trends(raw: DataFrame, dims: Mapping[str, DataFrame], as_of: date) -> DataFrame:
    """Missing trends from the newest earlier period of the area or state, else 0."""
    now = F.lit(as_of).cast("timestamp")
    by_area = backfill_latest(raw, dims["quarter_trend"], "GEOID", ["trend_geoid_quarter", "yearly_geoid_quarter"],
                              "close_dt", now, ["state_prov_short"])
    return backfill_latest(by_area, dims["state_trend"], "state_prov_short", ["yearly_state"], "close_dt", now)


def notsold_final(filled: DataFrame) -> DataFrame:
    return filled.drop(*_DROPPED_BY_NOTSOLD)


def build_notsold_features(listings: DataFrame, dims: Mapping[str, DataFrame], kind: str, as_of: date,
                           iso_year: bool = False, materialize: Materialize = written) -> DataFrame:
    """Scoring table of listings still open."""
    raw = notsold_raw(base_notsold(listings, kind), dims, as_of, iso_year, materialize)
    return notsold_final(fill_trends(raw, dims, as_of))


def sold_stages(base: DataFrame, dims: Mapping[str, DataFrame], materialize: Materialize = written
                ) -> dict[str, DataFrame]:
    """The wide stage tables one after the other, for users who keep each of them."""
    located = materialize(add_location(base, dims, materialize))
    demographics = materialize(add_demographics(located, dims, bounded=True))
    economy = materialize(add_economy(demographics, dims))
    schools = ft.fallback_column(add_schools(economy, dims, materialize), "full_bathroom_count", "total_bathroom_count",
                                 "full_bathroom_count")
    schools = materialize(schools)
    dated = ft.calendar_parts(flt.require_complete(schools.drop(*_DROPPED_BY_RAW), COMPLETE), "close_dt")
    raw = _finished(dated, dims["quarter_trend"], dims["state_trend"], "inner").drop("sa_mls_id", "GEOID")
    return {"base": base, "located": located, "demographics": demographics, "economy": economy, "schools": schools,
            "raw": raw}


def build_month_increment(listings: DataFrame, known: DataFrame, dims: Mapping[str, DataFrame], kind: str,
                          as_of: date, materialize: Materialize = written) -> dict[str, DataFrame]:
    """Stage tables of the listings closed in the last three months whose id is not known yet, plus ``final``."""
    recent = base_sold(listings, kind, as_of, rules.INCREMENT_MONTHS, with_days_on_market=True)
    stages = sold_stages(materialize(join_not_in(recent, known, KEY)), dims, materialize)
    return {**stages, "final": sold_final(stages["raw"])}


#: Columns that the stages of the monthly run have beside those of the yearly tables.
MONTHLY_ONLY = ["day_on_market"]


def append_stages(stages: Mapping[str, DataFrame], targets: Mapping[str, str], drop: Sequence[str] = tuple(MONTHLY_ONLY)) -> None:
    """Append each stage to the table kept for it (the final table is rebuilt, not appended to).

    Ids already in a target are left out, so a repeated run adds nothing. The history table goes last: until it is
    written, a rerun still sees the listings as new. Columns a target lacks raise, but for those in ``drop``.
    """
    for name in sorted(targets, key=lambda n: n == "base"):
        new = stages[name]
        present = read_target(new.sparkSession, targets[name]).select(KEY)
        append_aligned(join_not_in(new, present, KEY), targets[name], drop)


def month_run(listings: DataFrame, known: DataFrame, dims: Mapping[str, DataFrame], kind: str, as_of: date, root: str,
              with_notsold: bool = True, materialize: Materialize = written) -> str:
    """One monthly run: its tables below ``root`` as a part of their own (such as ``2025-07``), visible when all are complete.

    They are the stages and ``final`` of the newly sold homes, ``reduced`` (its sample, for the kinds that have one; the samples of all
    months make the sample of all rows) and ``notsold``, the scoring table of all homes still open.

    New are listings that neither ``known`` nor the base stage of an earlier month has; so a rerun of a month sees the same
    ones as new and takes the place of its first run. Returns the name of the part.
    """
    part = f"{as_of:%Y-%m}"
    ids = known.select(KEY)
    before = read_parts(known.sparkSession, root, "base", ids.schema, before=part).select(KEY)
    tables = build_month_increment(listings, ids.unionByName(before), dims, kind, as_of, materialize)
    reduced = sampled_training_table(tables["final"], kind)
    if reduced is not None:
        tables["reduced"] = reduced
    if with_notsold:
        tables["notsold"] = build_notsold_features(listings, dims, kind, as_of, materialize=materialize)
    write_part(tables, root, part)
    return part


def rebuild_from_base(base: DataFrame, dims: Mapping[str, DataFrame], sold: bool, as_of: date,
                      materialize: Materialize = written) -> DataFrame:
    """The feature table from a saved base table."""
    if sold:
        return sold_final(sold_raw(base, dims, materialize))
    return notsold_final(fill_trends(notsold_raw(base, dims, as_of, materialize=materialize), dims, as_of))


def sampled_training_table(final: DataFrame, kind: str) -> DataFrame | None:
    """The reduced table kept beside the full one, for the property types that have one."""
    share = rules.SAMPLED_SHARE.get(kind)
    return None if share is None else sample_fraction(final, share, KEY)
