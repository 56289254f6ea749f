"""Location joins against brute force, on layouts that are hard for a grid."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from parcelspark.functions import geometry as geo
from parcelspark.operators import spatial as sp
from parcelspark.plans.location import enrich_location
from parcelspark.sources.tables import written

POLYGON = "array<struct<x1:double,y1:double,x2:double,y2:double>>"


def unit(lon, lat):
    a, b = math.radians(lon), math.radians(lat)
    return math.cos(b) * math.cos(a), math.cos(b) * math.sin(a), math.sin(b)


def squared(p, q):
    return sum((u - v) ** 2 for u, v in zip(p, q))


def to_segment(p, a, b):
    d = [v - u for u, v in zip(a, b)]
    length = sum(v * v for v in d)
    t = max(0, min(1, sum((u - w) * v for u, w, v in zip(p, a, d)) / length)) if length else 0
    return sum((u - (w + t * v)) ** 2 for u, w, v in zip(p, a, d))


def within(x, y, edges):
    return sum((b > y) != (d > y) and x < (c - a) * (y - b) / (d - b) + a for a, b, c, d in edges) % 2 == 1


def ring(*corners):
    return [(*a, *b) for a, b in zip(corners, corners[1:] + corners[:1])]


@pytest.fixture(scope="module")
def layout():
    """A third of the points in one spot, a third of the places at one point, some at poles and at 180 degrees."""
    rnd = random.Random(5)
    points = [(i, rnd.choice("AB"), *((rnd.uniform(-100, -99.99), rnd.uniform(30, 30.01)) if i % 3 == 0 else
                                      (rnd.uniform(-180, 180), rnd.uniform(-89.9, 89.9)))) for i in range(900)]
    points += [(9000, "A", 179.99, 10.0), (9001, "A", -179.99, 10.0), (9002, "B", 12.0, 89.99), (9003, "C", 0.0, 0.0),
               (9004, None, 1.0, 1.0), (9005, "A", None, 1.0)]
    places = [(i, rnd.choice("AB"), rnd.uniform(-180, 180), rnd.uniform(-85, 85)) for i in range(80)]
    places += [(100 + i, "A", -99.5, 30.2) for i in range(40)]
    places += [(200, "A", -179.9, 10.1), (201, "B", -170.0, 89.9)]
    return points, places


def test_nearest_place_equals_brute_force(spark, layout):
    points, places = layout
    found = sp.nearest_school_in_state(
        spark.createDataFrame(points, "id long, st string, lon double, lat double"),
        spark.createDataFrame(places, "pid long, st string, plon double, plat double"),
        "id", "pid", "st", "lon", "lat", "plon", "plat").collect()
    expected = {}
    for i, st, x, y in points:
        of_group = [(squared(unit(x, y), unit(px, py)), pid) for pid, pst, px, py in places if pst == st] if (
            st and x is not None) else []
        if of_group:
            expected[i] = min(of_group)
    got = {r.id: r for r in found}
    assert set(got) == set(expected)  # no row for a group without places, or without a location
    assert {i: r.pid for i, r in got.items()} == {i: pid for i, (_, pid) in expected.items()}
    for i, (d2, _) in expected.items():
        assert got[i].distance == pytest.approx(2 * geo.EARTH_RADIUS_M * math.asin(min(1, math.sqrt(d2) / 2)), abs=0.05)


def test_contains_or_nearest_equals_brute_force(spark, layout):
    points = [p for p in layout[0] if p[1] in ("A", "B") and p[2] is not None]
    rnd = random.Random(9)
    shapes = []
    for i in range(40):
        x, y, r = rnd.uniform(-160, 160), rnd.uniform(-70, 70), rnd.choice([0.004, 0.9, 15])
        shapes.append((i, rnd.choice("AB"), ring((x - r, y - r), (x + r, y - .8 * r), (x + .1 * r, y), (x + .7 * r, y + r))))
    shapes.append((50, "A", ring((-101.0, 29.0), (-99.993, 29.0), (-99.993, 31.0), (-101.0, 31.0))))
    got = sp.contains_or_nearest(
        spark.createDataFrame(points, "id long, st string, lon double, lat double"),
        spark.createDataFrame(shapes, f"gid long, st string, poly {POLYGON}"),
        "id", "gid", "st", "lon", "lat", "poly").collect()
    expected = set()
    for i, st, x, y in points:
        holding = {(i, g) for g, _, e in shapes if within(x, y, e)}
        if not holding:
            p = unit(x, y)
            holding = {(i, min((min(to_segment(p, unit(a, b), unit(c, d)) for a, b, c, d in e), g)
                               for g, s, e in shapes if s == st)[1])}
        expected |= holding
    assert {(r.id, r.gid) for r in got} == expected


@pytest.mark.parametrize("most", [64, 2])
def test_nearest_edge_with_long_and_crowded_edges(spark, monkeypatch, most):
    """Long borders beside many tiny shapes in one spot; ``most`` sends more of the points to the finest cells."""
    monkeypatch.setattr(sp, "MOST_PIECES", most)
    rnd = random.Random(21)
    shapes = [(i, "A", outline(rnd.uniform(-150, 150), rnd.uniform(-60, 60), rnd.choice([0.5, 8]), 12, rnd)) for i in range(25)]
    shapes += [(100 + i, "A", outline(-99.995 + rnd.uniform(-.02, .02), 30 + rnd.uniform(-.02, .02), 0.001, 5, rnd)) for i in range(60)]
    shapes += [(200, "A", ring((-120.0, -30.0), (40.0, -30.0), (40.0, -50.0))), (201, "B", ring((-120.0, -30.0), (40.0, -30.0), (40.0, -50.0)))]
    points = [(i, "A", rnd.uniform(-180, 180), rnd.uniform(-85, 85)) for i in range(300)]
    points += [(1000 + i, "A", -99.995 + rnd.uniform(-.05, .05), 30 + rnd.uniform(-.05, .05)) for i in range(300)]
    points += [(2000 + i, "B", rnd.uniform(-180, 180), rnd.uniform(-85, 85)) for i in range(30)]
    got = sp.nearest_in_group(spark.createDataFrame(points, "id long, st string, lon double, lat double"),
                              spark.createDataFrame(shapes, f"gid long, st string, poly {POLYGON}"), "id", "gid", "st", "lon", "lat", "poly")
    expected = {}
    for i, st, x, y in points:
        p = unit(x, y)
        expected[i] = min((min(to_segment(p, unit(a, b), unit(c, d)) for a, b, c, d in e), g) for g, s, e in shapes if s == st)
    rows = {r.id: r for r in got.collect()}
    assert {i: r.gid for i, r in rows.items()} == {i: g for i, (_, g) in expected.items()}
    for i, (d2, _) in expected.items():
        assert rows[i].distance == pytest.approx(2 * geo.EARTH_RADIUS_M * math.asin(min(1, math.sqrt(d2) / 2)), abs=0.05)


def test_few_pieces_are_met_and_cut_again(spark):
    """Rows before the last cut against rows after it, on the orders and suppliers of the test data."""
    from suite import inputs
    from suite.registry import Tables

    t = Tables(spark, "/root/testdata/sf0.01")
    edges = inputs.polygon_from_corners(t.sql(inputs.SHAPES), "poly").select("gid", "state", F.explode("poly").alias("e"))
    names = {n: v for k, ends in ((1, sp._END1), (2, sp._END2)) for n, v in zip(ends, geo.unit_vector(F.col(f"e.x{k}"), F.col(f"e.y{k}")))}
    segments = edges.select("gid", "state", *[v.alias(n) for n, v in names.items()]).cache()
    level = sp._piece_level(segments)
    index = sp.written(sp._segment_index(segments, level))
    seeds = t.sql(inputs.POINTS).withColumns(dict(zip(("px", "py", "pz"), geo.unit_vector("lon", "lat"))))
    leaves = sp.written(sp._leaves("state", max(0, level - 1), index, seeds).select("state", *sp._LEAF).distinct())
    before = sp.short_lists(leaves, index, "state", level, cut=False).count()
    after = sp.short_lists(leaves, index, "state", level).count()
    assert after <= before <= 2 * after


def outline(x, y, r, n, rnd):
    """A closed ring of ``n`` edges around a centre, with bays."""
    corners = []
    for k in range(n):
        a, far = 2 * math.pi * k / n, r * (1 + 0.3 * math.sin(9 * 2 * math.pi * k / n) + 0.0005 * rnd.random())
        corners.append((x + far * math.cos(a), y + 0.7 * far * math.sin(a)))
    return ring(*corners)


def test_many_edges_with_holes_equal_brute_force(spark):
    import numpy as np

    rnd = random.Random(11)
    big = outline(-100.0, 40.0, 9.0, 20_000, rnd) + outline(-101.0, 41.0, 2.0, 3000, rnd) + outline(-97.0, 39.0, 0.05, 400, rnd)
    grid = [(-110.0 + k, 30.0) for k in range(20)] + [(-90.0, 30.0 + k) for k in range(20)]
    grid += [(-90.0 - k, 50.0) for k in range(20)] + [(-110.0, 50.0 - k) for k in range(20)]  # borders on cell borders
    diamond = [(x, y) for k in range(40) for x, y in [(-100 + k / 8, 45 - k / 8)]] + [(-95 - k / 8, 40 - k / 8) for k in range(40)] \
        + [(-100 - k / 8, 35 + k / 8) for k in range(40)] + [(-105 + k / 8, 40 + k / 8) for k in range(40)]
    comb = [c for k in range(60) for c in ((-100 + k / 10, 20.0), (-100 + k / 10 + 0.05, 29.0))] + [(-94.0, 19.0), (-100.0, 19.0)]
    star = [c for k in range(300) for c in ((-80.0, 40.0), (-80 + math.cos(k / 50), 40 + math.sin(k / 50)), (-80 + math.cos(k / 50 + .01), 40 + math.sin(k / 50 + .01)))]
    shapes = [(1, big), (2, ring(*grid)), (3, ring(*diamond)), (4, ring(*comb)), (5, ring(*star)), (6, ring((-101.0, 39.0), (-99.0, 39.0), (-99.0, 42.0)))]
    points = [(i, rnd.uniform(-112, -78), rnd.uniform(18, 52)) for i in range(3000)]
    points += [(10_000 + i, -100 + 9.5 * math.cos(i), 40 + 6.6 * math.sin(i)) for i in range(2000)]  # along the border
    points += [(20_000 + i, -97 + rnd.uniform(-.1, .1), 39 + rnd.uniform(-.1, .1)) for i in range(500)]
    points += [(30_000 + i, -100 + rnd.randrange(-80, 80) / 8 + 1 / 64, 40 + rnd.randrange(-80, 80) / 8) for i in range(500)]
    table = spark.createDataFrame(shapes, f"gid long, poly {POLYGON}")
    found = sp.spatial_join(spark.createDataFrame(points, "id long, lon double, lat double"), table, "lon", "lat", "poly")
    got = sorted((r.id, r.gid) for r in found.collect())
    expected = []
    for gid, edges in shapes:
        a, b, c, d = np.array(edges).T
        for i, x, y in points:
            spans = (b > y) != (d > y)
            expected += [(i, gid)] if (x < (c - a)[spans] * (y - b[spans]) / (d - b)[spans] + a[spans]).sum() % 2 else []
    assert got == sorted(expected)
    # what a point meets does not grow with the polygon
    cells = sp.polygon_index(table.filter("gid = 1"), "poly").select(F.size("poly").alias("n"), "cell_level").collect()
    assert max(r.n for r in cells) <= sp.MOST_EDGES and len(cells) < 23_400
    assert any(r.n == 0 for r in cells)


def test_polygon_text_with_hole_and_parts(spark):
    texts = [("hole", "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))"),
             ("two", "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)), ((5 5, 6 5, 6 6, 5 6, 5 5)))")]
    shapes = sp.parse_polygons(spark.createDataFrame(texts, "name string, wkt string"), "wkt", "poly")
    points = spark.createDataFrame([(1, 1.5, 1.5), (2, 3.0, 3.0), (3, 0.5, 0.5), (4, 5.5, 5.5), (5, 9.0, 9.0)],
                                   "id int, lon double, lat double")
    got = {(r.id, r.name) for r in sp.spatial_join(points, shapes, "lon", "lat", "poly").collect()}
    assert got == {(2, "hole"), (3, "hole"), (3, "two"), (4, "two")}


def test_a_listing_with_two_places_keeps_one_of_them_whole(spark):
    square = lambda x: ring((x, 0.0), (x + 1, 0.0), (x + 1, 1.0), (x, 1.0))
    groups = spark.createDataFrame([("G2", square(0.0)), ("G1", square(10.0))], f"GEOID string, geometry {POLYGON}")
    metros = spark.createDataFrame([("100", "West", "A", square(0.0)), ("200", "East", "A", square(10.0))],
                                   f"cbsa string, metropolitan_area_name string, state_prov_short string, metro_polygon {POLYGON}")
    listings = spark.createDataFrame([("L1", 0.5, 0.5, "A"), ("L1", 10.5, 0.5, "A"), ("L2", 0.5, 0.4, "A"), ("L2", 0.5, 0.4, "A"),
                                      ("L3", 0.5, 0.4, None)], "listing_id string, lon double, lat double, state_prov_short string")
    got = {r.listing_id: (r.GEOID, r.cbsa, r.metropolitan_area_name, r.lon) for r in enrich_location(listings, groups, metros).collect()}
    assert got == {"L1": ("G1", 200, "East", 10.5), "L2": ("G2", 100, "West", 0.5), "L3": ("G2", 100, "West", 0.5)}


def test_no_polygons_gives_no_rows(spark):
    points = spark.createDataFrame([(1, 1.5, 1.5)], "id int, lon double, lat double")
    assert sp.spatial_join(points, spark.createDataFrame([], f"name string, poly {POLYGON}"), "lon", "lat",
                           "poly").count() == 0


def test_plans_have_no_pairing_of_everything(spark):
    points = spark.range(1000).select("id", (F.col("id") / 10 - 50).alias("lon"), (F.col("id") / 20).alias("lat"),
                                      F.lit("A").alias("st"))
    shapes = spark.createDataFrame([(1, "A", ring((0.0, 0.0), (1.0, 0.0), (1.0, 1.0)))], f"gid long, st string, poly {POLYGON}")
    places = spark.createDataFrame([(1, "A", 1.0, 2.0)], "pid long, st string, plon double, plat double")
    for df in (sp.contains_or_nearest(points, shapes, "id", "gid", "st", "lon", "lat", "poly"),
               sp.nearest_school_in_state(points, places, "id", "pid", "st", "lon", "lat", "plon", "plat")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_points_share_leaf_cells_when_places_are_few(spark):
    rnd = random.Random(11)
    points = [(i, "A", rnd.uniform(-100, -90), rnd.uniform(30, 40)) for i in range(4000)]
    places = [(i, "A", rnd.uniform(-100, -90), rnd.uniform(30, 40)) for i in range(20)]
    kept = []

    def materialize(df):
        kept.append(sp.written(df))
        return kept[-1]

    found = sp.nearest_school_in_state(
        spark.createDataFrame(points, "id long, st string, lon double, lat double"),
        spark.createDataFrame(places, "pid long, st string, plon double, plat double"),
        "id", "pid", "st", "lon", "lat", "plon", "plat", materialize=materialize).collect()
    at = {p: unit(x, y) for p, _, x, y in places}
    expected = {i: min(at, key=lambda p: (squared(unit(x, y), at[p]), p)) for i, _, x, y in points}
    assert {r.id: r.pid for r in found} == expected
    # cells looked up around the leaves: fewer than points, as several share a leaf
    looked_up = [df for df in kept if "far" in df.columns]
    assert len(looked_up) == 1 and looked_up[0].count() < len(points)


def test_points_inside_any_polygon_come_once(spark):
    rnd = random.Random(3)
    points = [(i, rnd.uniform(0, 10), rnd.uniform(0, 10)) for i in range(300)] + [(900, None, 1.0), (None, 2.5, 2.5), (0, 50.0, 50.0)]
    corners = [(x, y, r) for r in (0.6, 3.0) for x in map(float, range(1, 8)) for y in map(float, range(1, 6))] + [(2.0, 2.0, 2.0)] * 9
    polygons = [(g, ring((x - r, y - r), (x + r, y - r), (x, y + r))) for g, (x, y, r) in enumerate(corners)]
    df = spark.createDataFrame(points, "id long, lon double, lat double")
    inside = sp.points_inside(df, spark.createDataFrame(polygons, f"gid long, polygon {POLYGON}"), "id", "lon", "lat", "polygon")
    expected = {i for i, x, y in points if x is not None and any(within(x, y, edges) for _, edges in polygons)}
    assert sorted((r.id for r in inside.collect()), key=str) == sorted(expected, key=str)
    assert "LeftSemi" in inside._jdf.queryExecution().executedPlan().toString()
    none = spark.createDataFrame([], f"gid long, polygon {POLYGON}")
    assert sp.points_inside(df, none, "id", "lon", "lat", "polygon").count() == 0


@pytest.fixture
def crowd():
    """Many points on triangles that overlap many times over, some of them tiny or far away."""
    rnd = random.Random(8)
    points = [(i, rnd.uniform(0, 10), rnd.uniform(0, 10)) for i in range(4000)] + [(9000, None, 1.0), (9001, 2.5, None), (None, 2.5, 2.5), (9002, 50.0, 50.0)]
    points += [(i + 5000, float(i % 11), float(i // 11)) for i in range(121)]
    corners = [(rnd.uniform(0, 10), rnd.uniform(0, 10), rnd.choice((0.01, 0.7, 1.5, 4.0))) for _ in range(120)] + [(5.0, 5.0, 4.0)] * 5
    return points, [(g, g % 3, ring((x - r, y - r), (x + r, y - 0.8 * r), (x + 0.1 * r, y), (x, y + r))) for g, (x, y, r) in enumerate(corners)]


def test_crowded_cells_are_cut(spark, crowd):
    points, polygons = crowd
    kept = []

    def materialize(df):
        kept.append(sp.written(df))
        return kept[-1]

    found = sp.spatial_join(spark.createDataFrame(points, "id long, lon double, lat double"),
                            spark.createDataFrame(polygons, f"gid long, kind long, polygon {POLYGON}"), "lon", "lat", "polygon", materialize=materialize)
    expected = [(i, g) for i, x, y in points if x is not None and y is not None for g, _, edges in polygons if within(x, y, edges)]
    assert sorted((str(r.id), r.gid) for r in found.collect()) == sorted((str(i), g) for i, g in expected)
    # cells that lie wholly inside, where no edge is met
    cells = [df for df in kept if "ref_inside" in df.columns][-1]
    assert cells.filter("size(polygon) = 0 AND ref_inside").count() > 100


def test_least_rank_of_the_polygons_that_hold_a_point(spark, crowd):
    points, polygons = crowd
    table = spark.createDataFrame([(1000 - g if kind != 1 else None, g if kind != 2 else None, edges) for g, kind, edges in polygons],
                                  f"a long, b long, polygon {POLYGON}")
    found = sp.least_inside(spark.createDataFrame(points, "id long, lon double, lat double"), table, "lon", "lat", "polygon", ["a", "b"])
    expected = {}
    for i, x, y in points:
        held = [(g, kind) for g, kind, edges in polygons if x is not None and y is not None and within(x, y, edges)]
        if held:
            expected[i] = (min((1000 - g for g, kind in held if kind != 1), default=None), min((g for g, kind in held if kind != 2), default=None))
    assert {r.id: (r.a, r.b) for r in found.collect()} == expected
    none = spark.createDataFrame([], f"a long, b long, polygon {POLYGON}")
    assert sp.least_inside(spark.createDataFrame(points, "id long, lon double, lat double"), none, "lon", "lat", "polygon", ["a", "b"]).count() == 0


def mixed_polygons(spark):
    """3,000 points in two degrees, so that cells are cut, and polygons of 3 to 24 corners, some apart from all points."""
    r = random.Random(11)
    points = [(i, "N", r.uniform(0, 2), r.uniform(0, 2)) for i in range(3000)] + [(3000, "N", 9.0, 9.0), (3001, "M", 9.0, 9.0)]
    polygons = []
    for gid, n in enumerate([3, 4, 4, 5, 8, 24, 4, 4]):
        x, y, size = r.uniform(0.5, 1.5), r.uniform(0.5, 1.5), r.uniform(0.3, 1.5)
        corners = [(x + size * r.uniform(0.3, 1) * math.cos(2 * math.pi * k / n), y + size * r.uniform(0.3, 1) * math.sin(2 * math.pi * k / n))
                   for k in range(n)]
        polygons.append((gid, "N", ring(*corners)))
    polygons.append((99, "N", ring((5.0, 5.0), (6.0, 5.0), (6.0, 6.0))))
    inside = {(i, g) for i, _, x, y in points for g, _, edges in polygons if within(x, y, edges)}
    return (spark.createDataFrame(points, "id long, state string, lon double, lat double"),
            spark.createDataFrame(polygons, f"gid long, state string, polygon {POLYGON}"), inside)


def test_edges_of_small_cells_are_tested_by_compiled_columns(spark, monkeypatch):
    points, polygons, inside = mixed_polygons(spark)
    assert max(Counter(i for i, _ in inside).values()) > 2
    for most in (512, 10 ** 9):  # with crowded cells cut, and all cells as they are filed
        monkeypatch.setattr(sp, "CROWD", most)
        found = sp.spatial_join(points, polygons.select("gid", "polygon"), "lon", "lat", "polygon").select("id", "gid")
        assert Counter(map(tuple, found.collect())) == Counter(inside)
        ids = sp.points_inside(points, polygons, "id", "lon", "lat", "polygon")
        assert sorted(r.id for r in ids.collect()) == sorted({i for i, _ in inside})
    small = sp.spatial_join(points, polygons.filter(F.size("polygon") <= 4).select("gid", "polygon"), "lon", "lat", "polygon")
    joins = [line for line in small._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line]
    assert joins and not any("lambda" in line for line in joins)


def test_pairs_of_contains_or_nearest_are_not_stored(spark):
    points, polygons, inside = mixed_polygons(spark)
    stored = []

    def kept(df):
        stored.append(set(df.columns))
        return written(df)

    found = sp.contains_or_nearest(points, polygons, "id", "gid", "state", "lon", "lat", "polygon", kept)
    rows = Counter(map(tuple, found.collect()))
    assert all(not {"id", "gid"} <= columns for columns in stored)
    assert rows.keys() >= inside and set(rows.values()) == {1}
    assert {i for i, _ in rows.keys() - inside} == {r.id for r in points.collect() if r.state == "N"} - {i for i, _ in inside}
    assert (3000, 99) in rows
