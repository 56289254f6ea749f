"""Block group and metro of each listing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.operators.features import cast_code_long, point_from_lonlat
from parcelspark.operators.spatial import Materialize, contains_or_nearest, spatial_join
from parcelspark.operators.windows import dedupe_by_id
from parcelspark.sources.tables import written

SEPARATOR = "\u001f"  # does not occur in names
PLACE = ["listing_id", "lon", "lat", "state_prov_short"]


def enrich_location(listings: DataFrame, block_groups: DataFrame, metro_areas: DataFrame,
                    materialize: Materialize = written) -> DataFrame:
    """``(listing_id, lon, lat, state_prov_short, GEOID, metropolitan_area_name, cbsa)``, one row per listing.

    A listing outside all block groups is dropped. The metro is one it lies in, else the nearest one of its state; a
    listing in a state without metros and in none of them is dropped. Of several matches the smallest codes win. A listing
    with several places keeps the block group and the metro of one and the same place.
    """
    places = point_from_lonlat(listings.select(*PLACE)).distinct()
    # a place of a listing; a missing state is told from an empty one
    places = places.withColumn("place", F.to_json(F.struct(*PLACE)))
    areas = materialize(spatial_join(places, block_groups.select("GEOID", "geometry"), "lon", "lat", "geometry"))
    # the metro id is its code and name together: either alone may repeat
    code, name = F.coalesce(F.trim("cbsa"), F.lit("")), F.coalesce("metropolitan_area_name", F.lit(""))
    metros = metro_areas.withColumn("metro", F.concat(code, F.lit(SEPARATOR), name))
    chosen = contains_or_nearest(areas.select("place", *PLACE[1:]).distinct(), metros, "place", "metro", "state_prov_short",
                                 "lon", "lat", "metro_polygon", materialize)
    chosen = cast_code_long(chosen.select(
        "place", F.split_part("metro", F.lit(SEPARATOR), F.lit(1)).alias("cbsa"),
        F.split_part("metro", F.lit(SEPARATOR), F.lit(2)).alias("metropolitan_area_name")), "cbsa")
    joined = areas.join(chosen, "place").drop("place")
    return dedupe_by_id(joined, "listing_id",
                        ["GEOID", "cbsa", "metropolitan_area_name", "lon", "lat", "state_prov_short"])
