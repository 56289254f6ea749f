"""Photo scores: class flags per photo to percentages per listing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.operators import features as ft
from parcelspark.operators.aggregates import distinct_rows, guarded_percentages
from parcelspark.operators.filters import filter_equals
from parcelspark.operators.joins import join_inner_using, join_star_left
from parcelspark.operators.models import PHOTO_CITIES

# Photo classes. Those of the second list do not count in an unfurnished room.
PLAIN_CLASSES = ["house_plan", "closet", "immaculate_kitchen_light", "immaculate_kitchen_dark", "kitchen",
                 "outdated_kitchen", "private_pool", "unfurnished_houses"]
FURNISHED_CLASSES = ["bathroom", "bedroom", "living_room", "outdated_bathroom", "stylish_bedroom", "stylish_house",
                     "stylish_living_room"]
GATE = "unfurnished_houses"
KITCHENS = ["immaculate_kitchen_light", "immaculate_kitchen_dark"]
PHOTO_KEYS = ["mls_id", "mls_number", "path"]
LISTING_KEYS = PHOTO_KEYS[:2]
PERCENTAGES = {
    "percent_unfurnished_rooms": ("unfurnished_houses", "indoor_photos"),
    "percent_stylish_house": ("stylish_house", "indoor_photos"),
    "percent_immaculate_kitchens": ("immaculate_kitchen", "kitchen"),
    "percent_outdated_kitchens": ("outdated_kitchen", "kitchen"),
    "percent_stylish_bedrooms": ("stylish_bedroom", "bedroom"),
    "percent_outdated_bathrooms": ("outdated_bathroom", "bathroom"),
    "percent_stylish_living_rooms": ("stylish_living_room", "living_room"),
}


def photo_flags(photos: DataFrame, classes: Mapping[str, DataFrame]) -> DataFrame:
    """One distinct row per photo with all class flags filled.

    ``classes`` holds one table per photo class, with the photo keys and a 0/1 column named as the class.
    """
    tables = [classes[c].select(*PHOTO_KEYS, c) for c in PLAIN_CLASSES + FURNISHED_CLASSES]
    joined = join_star_left(photos.select(*PHOTO_KEYS, "indoor_photos"), tables, PHOTO_KEYS)
    filled = ft.fill_default(ft.gated_fill(joined, FURNISHED_CLASSES, GATE), PLAIN_CLASSES, 0)
    return distinct_rows(ft.merge_flags(filled, KITCHENS, "immaculate_kitchen"))


def photo_scores(photos: DataFrame, classes: Mapping[str, DataFrame]) -> DataFrame:
    """Percentages per listing."""
    return guarded_percentages(photo_flags(photos, classes), LISTING_KEYS, PERCENTAGES,
                               {"private_pool": "private_pool"})


# Columns that the tables with photo scores leave out.
NOT_IN_PHOTO_TABLES = [
    "city_long", "address", "mls_id", "mls_number", "metropolitan_area_name", "cbsa", "postal_code", "postal_code_short", "state_prov_short",
    "current_listing_price",
]
NOT_IN_SOLD, NOT_IN_NOTSOLD = ["listing_status"], ["GEOID", "sa_mls_id"]


def photo_tables(scores: DataFrame, sold: Mapping[str, DataFrame], notsold: Mapping[str, DataFrame],
                 cities: Mapping[str, int] = PHOTO_CITIES) -> dict[tuple[str, bool], DataFrame]:
    """The training (True) and scoring (False) tables with photo scores, by kind of home and sold or not, each with a ``city``.

    All cities come from one pass over a feature table; write a table with ``partitionBy("city")`` to keep one a city. Listings
    outside the cities, or without scores, have no row.
    """
    code = F.create_map(*[F.lit(v) for city, metro in cities.items() for v in (metro, city)])
    out = {}
    for is_sold, tables, more in ((True, sold, NOT_IN_SOLD), (False, notsold, NOT_IN_NOTSOLD)):
        for kind, features in tables.items():
            in_city = features.withColumn("city", F.try_element_at(code, F.col("cbsa").cast("int"))).filter(F.col("city").isNotNull())
            out[kind, is_sold] = join_inner_using(in_city, scores, LISTING_KEYS).drop(*NOT_IN_PHOTO_TABLES, *more)
    return out


def join_scores(scores: DataFrame, features: DataFrame, metro: int, drop: list[str]) -> DataFrame:
    """Feature rows of one metro that have photo scores."""
    in_metro = filter_equals(features, "cbsa", metro)
    return join_inner_using(in_metro, scores, LISTING_KEYS).drop(*drop)
