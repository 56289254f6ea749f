"""Schools of each listing: the best one whose zone holds it, else the nearest one of its state, per level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.functions.geometry import sphere_distance_m
from parcelspark.functions.scalars import round_half_up
from parcelspark.operators.spatial import Materialize, least_inside, nearest_school_in_state
from parcelspark.operators.windows import top1
from parcelspark.sources.tables import written
from parcelspark.plans.listing_rules import PUBLIC_SCHOOL, SCHOOL_LEVELS, SCHOOL_MEASURES


def public_schools(schools: DataFrame) -> DataFrame:
    """Public schools with a location, with the array of levels each one serves."""
    served = [F.when(F.col("ed_level").isin(codes), F.lit(level)) for level, codes in SCHOOL_LEVELS.items()]
    public = schools.filter((F.col("obj_subtcd") == PUBLIC_SCHOOL) & F.col("longitude").isNotNull()
                            & F.col("latitude").isNotNull())
    levels = F.filter(F.array(*served), lambda level: level.isNotNull())
    return public.withColumn("levels", levels).filter(F.size("levels") > 0)


def assign_schools(listings: DataFrame, schools: DataFrame, materialize: Materialize = written) -> DataFrame:
    """``listing_id`` and distance (km), pupils per teacher, poverty level and percentile for each of three levels.

    All levels go through one zone join, one nearest search (its groups are state and level) and one aggregate by
    listing; a level without any school stays NULL.
    """
    public = public_schools(schools)
    where = materialize(listings.select("listing_id", "lon", "lat", "state_prov_short"))

    # the better the school, the lower its number; ids grow with the order over all partitions
    ranked = public.orderBy(F.col("pctile_y1").desc_nulls_last(), "obj_id").withColumn("rank", F.monotonically_increasing_id())
    ranked = materialize(ranked.select("rank", "levels", "longitude", "latitude", *SCHOOL_MEASURES, "geom"))
    ranks = {level: F.when(F.array_contains("levels", level), F.col("rank")) for level in SCHOOL_LEVELS}
    zones = ranked.select("geom", *[r.alias(level) for level, r in ranks.items()])
    holding = least_inside(where.select("listing_id", "lon", "lat"), zones, "lon", "lat", "geom", list(SCHOOL_LEVELS), materialize)
    hits = holding.select("listing_id", "lon", "lat", F.explode(F.array(*[
        F.struct(F.lit(level).alias("level"), F.col(level).alias("rank")) for level in SCHOOL_LEVELS])).alias("hit"))
    hits = hits.select("listing_id", "lon", "lat", "hit.*").join(ranked.drop("levels", "geom"), "rank")
    hits = hits.withColumn("distance", sphere_distance_m("lon", "lat", "longitude", "latitude"))
    best = top1(hits, ["listing_id", "level"], ["rank", "distance"])
    best = materialize(best.select("listing_id", "level", "distance", *SCHOOL_MEASURES))

    wanted = where.withColumn("level", F.explode(F.array(*[F.lit(v) for v in SCHOOL_LEVELS])))
    missing = wanted.join(best.select("listing_id", "level"), ["listing_id", "level"], "left_anti")
    group = F.concat_ws("|", "state_prov_short", "level")
    candidates = public.withColumn("level", F.explode("levels")).withColumn(
        "place", F.concat_ws("|", "state_prov", "level"))
    nearest = nearest_school_in_state(
        missing.filter(F.col("state_prov_short").isNotNull()).withColumn("place", group),
        candidates, "listing_id", "obj_id", "place", "lon", "lat", "longitude", "latitude", materialize=materialize)
    measures = candidates.select("place", "obj_id", "level", *SCHOOL_MEASURES).dropDuplicates(["place", "obj_id"])
    nearest = nearest.join(measures, ["place", "obj_id"])
    nearest = nearest.select("listing_id", "level", "distance", *SCHOOL_MEASURES)

    columns = []
    for level in SCHOOL_LEVELS:
        here = F.col("level") == level
        columns.append(F.max(F.when(here, round_half_up(F.col("distance") / 1000.0, 2))).alias(f"{level}_distance"))
        columns += [F.max(F.when(here, round_half_up(m, 2))).alias(f"{level}_{m}") for m in SCHOOL_MEASURES]
    return best.unionByName(nearest).groupBy("listing_id").agg(*columns)
