"""Joins by location: orders and suppliers as points, suppliers as polygons."""

from pyspark.sql import functions as F

from parcelspark.functions.scalars import round_half_up
from parcelspark.operators import spatial as sp
from parcelspark.plans.location import enrich_location
from parcelspark.plans.schools import assign_schools
from suite.inputs import (BLOCK_GROUPS, METROS, PLACES, POINTS, SCHOOLS, SHAPES, edges_sql, inside_sql, metres_sql,
                          polygon_from_corners, segment_sql, squared_sql, unit_sql, with_ctes)
from suite.registry import query

CTES = {"pts": POINTS, "places": PLACES, "shapes": SHAPES, "edges": edges_sql("shapes", "gid, state"),
        "hits": inside_sql("pts", "id", "edges", "gid")}


def shapes(t):
    return polygon_from_corners(t.sql(SHAPES), "polygon")


@query("spatial_join", with_ctes(CTES, """
SELECT pts.id, pts.state, hits.gid FROM hits JOIN pts ON hits.id = pts.id"""))
def spatial_join(t):
    polygons = shapes(t).select("gid", "polygon")
    return sp.spatial_join(t.sql(POINTS), polygons, "lon", "lat", "polygon").select("id", "state", "gid")


@query("spatial_join_reverse", with_ctes(
    {**CTES, "back": inside_sql("places", "place_id", "edges", "gid", "place_lon", "place_lat")},
    "SELECT back.gid, s.state, back.place_id FROM back JOIN shapes s ON back.gid = s.gid"))
def spatial_join_reverse(t):
    places = t.sql(PLACES).select("place_id", "place_lon", "place_lat")
    return sp.spatial_join_reverse(shapes(t), places, "polygon", "place_lon", "place_lat").select(
        "gid", "state", "place_id")


AREA_FACTS = "SELECT o_orderkey, o_custkey % 120 AS gid FROM {orders}"
# codes of every third supplier are unknown; its point lies in the shapes of others or of its own
REFERENCE = f"""SELECT CASE WHEN place_id % 3 = 0 THEN NULL ELSE place_id END AS code, place_id AS measure,
  place_lon + 1e-2 AS longitude, place_lat - 1e-2 AS latitude FROM ({PLACES}) pl"""


@query("key_else_spatial", with_ctes({**CTES, "facts": AREA_FACTS, "ref": REFERENCE, "free": """
SELECT * FROM edges WHERE gid NOT IN (SELECT code FROM ref WHERE code IS NOT NULL)""",
                                      "found": inside_sql("ref", "measure", "free", "gid", "longitude", "latitude")}, """
SELECT o_orderkey, facts.gid, measure FROM facts JOIN ref ON facts.gid = ref.code
UNION ALL SELECT o_orderkey, facts.gid, measure FROM facts JOIN found ON facts.gid = found.gid"""))
def key_else_spatial(t):
    return sp.key_else_spatial(t.sql(AREA_FACTS), t.sql(REFERENCE), "gid", "code", shapes(t).select("gid", "polygon"),
                               "polygon", "longitude", "latitude")


UNITS = {"pu": f"SELECT id, state, {unit_sql('lon', 'lat', 'p')} FROM pts",
         "eu": f"SELECT gid, state, {unit_sql('x1', 'y1', 'u')}, {unit_sql('x2', 'y2', 'v')} FROM edges",
         "lu": f"SELECT place_id, state, {unit_sql('place_lon', 'place_lat', 'q')} FROM places"}


def nearest_sql(points, pid, candidates, cid, squared, group="state"):
    """Brute force: all pairs of a group, the closest one by distance and id."""
    return f"""SELECT {pid}, {group}, {cid}, d2 FROM (SELECT p.{pid}, p.{group}, c.{cid}, {squared} AS d2 FROM {points} p
JOIN {candidates} c ON p.{group} = c.{group}) pairs
QUALIFY row_number() OVER (PARTITION BY {pid}, {group} ORDER BY d2, {cid}) = 1"""


ROUNDED = f"floor({metres_sql('d2')} / 1000e0 * 100e0 + 5e-1) / 100e0"
FREE = "SELECT * FROM pu WHERE id NOT IN (SELECT id FROM hits)"


@query("nearest_in_group", with_ctes({**CTES, **UNITS, "free": FREE, "best": nearest_sql(
    "free", "id", "eu", "gid", segment_sql("p", "u", "v"))},
    f"SELECT id, state, gid, {ROUNDED} AS km FROM best"))
def nearest_in_group(t):
    points, polygons = t.sql(POINTS), shapes(t)
    rest = points.join(sp.points_inside(points, polygons, "id", "lon", "lat", "polygon"), "id", "left_anti")
    found = sp.nearest_in_group(rest, polygons, "id", "gid", "state", "lon", "lat", "polygon")
    return found.select("id", "state", "gid", round_half_up(F.col("distance") / 1000.0, 2).alias("km"))


@query("nearest_school_in_state", with_ctes({**CTES, **UNITS, "best": nearest_sql(
    "pu", "id", "lu", "place_id", squared_sql("p", "q"))},
    f"SELECT id, state, place_id, {ROUNDED} AS km FROM best"))
def nearest_school_in_state(t):
    found = sp.nearest_school_in_state(t.sql(POINTS), t.sql(PLACES), "id", "place_id", "state", "lon", "lat",
                                       "place_lon", "place_lat")
    return found.select("id", "state", "place_id", round_half_up(F.col("distance") / 1000.0, 2).alias("km"))


@query("contains_or_nearest", with_ctes({**CTES, **UNITS, "free": FREE, "best": nearest_sql(
    "free", "id", "eu", "gid", segment_sql("p", "u", "v"))},
    "SELECT id, gid FROM hits UNION ALL SELECT id, gid FROM best"))
def contains_or_nearest(t):
    return sp.contains_or_nearest(t.sql(POINTS), shapes(t), "id", "gid", "state", "lon", "lat", "polygon")


LISTED = f"SELECT id AS listing_id, state AS state_prov_short, lon, lat FROM ({POINTS}) p"

# ---- location of listings, used by the feature-table comparison as well


def located_ctes(listed: str) -> dict[str, str]:
    """From a relation ``listed`` (listing_id, lon, lat, state_prov_short) to ``located``."""
    return {
        "bg": BLOCK_GROUPS, "metros": METROS, "bge": edges_sql("bg", "GEOID"),
        "me": edges_sql("metros", "metropolitan_area_name, cbsa, state_prov_short"),
        "in_bg": inside_sql(listed, "listing_id", "bge", "GEOID"),
        "kept": f"SELECT DISTINCT l.listing_id, l.lon, l.lat, l.state_prov_short FROM {listed} l "
                "WHERE l.listing_id IN (SELECT listing_id FROM in_bg)",
        "in_metro": inside_sql("kept", "listing_id", "me", "metropolitan_area_name"),
        "free_m": f"SELECT listing_id, state_prov_short, {unit_sql('lon', 'lat', 'p')} FROM kept "
                  "WHERE listing_id NOT IN (SELECT listing_id FROM in_metro)",
        "meu": f"SELECT metropolitan_area_name, cbsa, state_prov_short, {unit_sql('x1', 'y1', 'u')}, "
               f"{unit_sql('x2', 'y2', 'v')} FROM me",
        "near_m": nearest_sql("free_m", "listing_id", "meu", "metropolitan_area_name", segment_sql("p", "u", "v"),
                              "state_prov_short"),
        "metro_of": "SELECT listing_id, metropolitan_area_name FROM in_metro UNION ALL "
                    "SELECT listing_id, metropolitan_area_name FROM near_m",
        "located": """SELECT kept.listing_id, kept.lon, kept.lat, kept.state_prov_short, in_bg.GEOID,
            m.metropolitan_area_name, CAST(m.cbsa AS BIGINT) AS cbsa FROM kept JOIN in_bg ON kept.listing_id = in_bg.listing_id
            JOIN metro_of ON kept.listing_id = metro_of.listing_id
            JOIN metros m ON metro_of.metropolitan_area_name = m.metropolitan_area_name
            QUALIFY row_number() OVER (PARTITION BY kept.listing_id
              ORDER BY in_bg.GEOID, CAST(m.cbsa AS BIGINT), m.metropolitan_area_name) = 1""",
    }


@query("enrich_location", with_ctes({"listed": LISTED, **located_ctes("listed")}, """
SELECT listing_id, state_prov_short, GEOID, metropolitan_area_name, cbsa FROM located"""))
def enrich_location_query(t):
    groups = polygon_from_corners(t.sql(BLOCK_GROUPS), "geometry")
    metros = polygon_from_corners(t.sql(METROS), "metro_polygon")
    return enrich_location(t.sql(LISTED), groups, metros).drop("lon", "lat")


LEVEL_SQL = """CASE WHEN ed_level IN ('P', 'PM', 'E', 'O', 'PMH') THEN 'elem' END AS elem,
 CASE WHEN ed_level IN ('M', 'PM', 'MH', 'O', 'PMH', 'S') THEN 'middle' END AS middle,
 CASE WHEN ed_level IN ('H', 'MH', 'O', 'PMH', 'S') THEN 'high' END AS high"""


def school_ctes(listed: str) -> dict[str, str]:
    """From a relation of listings to ``school_of``: one row per listing with twelve measures."""
    out = {
        "pub": f"SELECT *, {LEVEL_SQL}, {unit_sql('longitude', 'latitude', 'q')} FROM ({SCHOOLS}) sc WHERE obj_subtcd = 'PUB'",
        "se": edges_sql("pub", "obj_id"),
        "lst": f"SELECT DISTINCT listing_id, lon, lat, state_prov_short, {unit_sql('lon', 'lat', 'p')} FROM {listed}",
        "zone": inside_sql("lst", "listing_id", "se", "obj_id"),
    }
    for level in ("elem", "middle", "high"):
        out[f"{level}_in"] = f"""SELECT z.listing_id, s.pup_teach, s.pov_lev, s.pctile_y1, {squared_sql('p', 'q')} AS d2
            FROM zone z JOIN pub s ON z.obj_id = s.obj_id JOIN lst ON z.listing_id = lst.listing_id WHERE s.{level} IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY z.listing_id ORDER BY s.pctile_y1 DESC NULLS LAST, s.obj_id) = 1"""
        out[f"{level}_near"] = f"""SELECT listing_id, pup_teach, pov_lev, pctile_y1, {squared_sql('p', 'q')} AS d2
            FROM lst JOIN pub ON lst.state_prov_short = pub.state_prov WHERE {level} IS NOT NULL
            AND listing_id NOT IN (SELECT listing_id FROM {level}_in)
            QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY {squared_sql('p', 'q')}, obj_id) = 1"""
        out[f"{level}_all"] = f"SELECT * FROM {level}_in UNION ALL SELECT * FROM {level}_near"
    r = "floor({} * 100e0 + 5e-1) / 100e0 AS {}"
    columns = ", ".join(
        r.format(f"{metres_sql(f'{v}_all.d2')} / 1000e0", f"{v}_distance") + ", "
        + ", ".join(r.format(f"{v}_all.{m}", f"{v}_{m}") for m in ("pup_teach", "pov_lev", "pctile_y1"))
        for v in ("elem", "middle", "high"))
    out["school_of"] = f"""SELECT listing_id, {columns} FROM elem_all FULL JOIN middle_all USING (listing_id)
        FULL JOIN high_all USING (listing_id)"""
    return out


@query("assign_schools", with_ctes({"listed": LISTED, **school_ctes("listed")}, "SELECT * FROM school_of"))
def assign_schools_query(t):
    return assign_schools(t.sql(LISTED), polygon_from_corners(t.sql(SCHOOLS), "geom"))
