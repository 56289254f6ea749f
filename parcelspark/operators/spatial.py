"""Joins by location, built from equality joins on grid cells.

*Point in polygon.* A polygon is filed at one grid level only: the finest whose cells are at least as large as its
bounding box. It then touches at most four cells, however large it is, and a cell holds only polygons of about its own
size. A cell with more than ``MOST_EDGES`` edges of its polygon is cut into 64 smaller ones, again and again: each keeps the
edges that touch it and whether a reference point of its own lies inside; cells without edges are wholly inside, or
are dropped. So a point meets a handful of edges however many its polygon has. A point looks up its cell at each level in
use. Candidates pass a bounding-box test, then the ray-cast, or the way to the reference point; all sit in the join
condition.

*Nearest.* Points and candidates are unit vectors in a cube cut into cells, each level twice as coarse as the one
before. Edges are cut into pieces no longer than a cell of one level, the finest that makes few pieces. Work is done once per
occupied cell of the points, not per point (among places, cells that several points share): two bounds (see ``short_lists``) leave a short list of pieces, the points of
the cell meet only this list, and the closest segment wins, measured as a whole.

So no group is paired with itself in full, the result is exact, and a place that holds a large share of the points
costs one lookup. Points travel as (id, x, y) rows; wide columns are joined back by id.

Narrow tables that a plan reads twice go through ``materialize``: by default they are written to the shared work folder
and read back, so they are computed once, survive lost executors, and the next join sees their true size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark.functions import geometry as geo
from parcelspark.operators.windows import top1
from parcelspark.sources.tables import written

Materialize = Callable[[DataFrame], DataFrame]

# Cell levels of the point-in-polygon grid: cells of 2^-12 (about 30 m) to 2^9 degrees (more than the whole range).
FINEST_DEGREES, COARSEST_DEGREES = -12, 9

# Cell levels of the nearest search: level 0 has cells of 2^-15 of the earth's radius (about 190 m); at the last level
# one cell holds the whole globe.
GLOBE_LEVELS = 17
CELLS_PER_RADIUS = float(2 ** 15)
#: The points' cells are a level finer than those that long pieces are filed in; in cells with more pieces, they are the finest.
MOST_PIECES = 64
#: Pieces are filed at their own level once more, under a number of its own for those who look only for these.
OWN = GLOBE_LEVELS + 1


#: Edges of one polygon that a cell holds before it is cut, and the levels that one cut goes down.
MOST_EDGES = 16
CUT_LEVELS = 3
#: Points in a cell from which on its polygons are cut there too: 64 smaller cells cost less than that many points against a box.
CROWD = 512
#: Cells are cut down to 2^-24 degrees (less than a centimetre), where many edges may still meet in a point.
FINEST_CUT = -24
#: Edges up to which a cell's are columns of the join (most cells that were cut have one or two).
FEW_EDGES = 4
#: Where a cell's reference point lies in it: places that no drawn border goes through by habit.
REFERENCE = (0.38196601125010515, 0.41421356237309503)


def polygon_table(df: DataFrame, polygon: str, box: bool = True) -> DataFrame:
    """Add the bounding box; rows without edges are dropped."""
    kept = df.filter(F.size(F.col(polygon)) > 0)
    return kept.withColumns(geo.box_of(polygon)) if box else kept


def parse_polygons(df: DataFrame, text: str, polygon: str) -> DataFrame:
    """Replace a polygon text (WKT) by its edges."""
    return df.withColumn(polygon, geo.edges_from_wkt(text)).drop(*([text] if text != polygon else []))


def _level_of_box() -> Column:
    extent = F.greatest(F.col("box_x1") - F.col("box_x0"), F.col("box_y1") - F.col("box_y0"))
    level = F.ceil(F.log2(F.nullif(extent, F.lit(0.0)))).cast("int")
    level = F.coalesce(level, F.lit(FINEST_DEGREES))
    return F.least(F.greatest(level, F.lit(FINEST_DEGREES)), F.lit(COARSEST_DEGREES))


def _cell(value: Column, level: Column) -> Column:
    return F.floor(value * F.pow(F.lit(2.0), -level)).cast("long")


def _filed_polygons(polygons: DataFrame, polygon: str) -> DataFrame:
    """Each polygon in every cell of its level that its box touches (at most four)."""
    filed = polygon_table(polygons, polygon).withColumn("cell_level", _level_of_box())
    for axis in ("x", "y"):
        first, last = (_cell(F.col(f"box_{axis}{end}"), F.col("cell_level")) for end in (0, 1))
        filed = filed.withColumn(f"cell_{axis}", F.explode(F.sequence(first, last)))
    return filed


def _reference(axis: str) -> Column:
    place = REFERENCE[axis == "y"]
    return (F.col(f"cell_{axis}") + F.lit(place)) * F.pow(F.lit(2.0), F.col("cell_level"))


def _cut_cells(cells: DataFrame, polygon: str) -> DataFrame:
    """The cells' smaller ones: with the edges that touch them, and whether their reference points are inside."""
    parts = 2 ** CUT_LEVELS
    rest = [c for c in cells.columns if c not in (polygon, "cell_level", "cell_x", "cell_y", "ref_x", "ref_y", "ref_inside")]
    size = F.pow(F.lit(2.0), F.col("cell_level"))
    known = cells.withColumns({"whole": F.col(polygon), "old_x": F.col("ref_x"), "old_y": F.col("ref_y"),
                               "cell_level": F.col("cell_level") - CUT_LEVELS})

    def same(edges: str, x0: str, y0: str, x1: str, y1: str) -> Column:
        return F.col("ref_inside") == geo.same_side(edges, *[F.col(c) for c in (x0, y0, x1, y1)])

    # columns first, then the cells of each: an edge is held against 8 boxes and then against 8 cells of the columns it touches,
    # and the reference points move across first, then up or down
    columns = known.withColumn("cell_x", F.explode(F.sequence(F.col("cell_x") * parts, F.col("cell_x") * parts + (parts - 1))))
    low = F.col("cell_y") * F.pow(F.lit(2.0), F.col("cell_level") + CUT_LEVELS)
    columns = columns.withColumn("ref_x", _reference("x")).select(
        *rest, "cell_level", "cell_x", "cell_y", "ref_x", "old_y", same("whole", "old_x", "old_y", "ref_x", "old_y").alias("ref_inside"),
        geo.touching("whole", F.col("cell_x") * size, low, size, size * parts).alias("whole"))
    small = columns.withColumn("cell_y", F.explode(F.sequence(F.col("cell_y") * parts, F.col("cell_y") * parts + (parts - 1))))
    made = small.withColumn("ref_y", _reference("y")).select(
        *rest, geo.touching("whole", F.col("cell_x") * size, F.col("cell_y") * size, size, size).alias(polygon),
        "cell_level", "cell_x", "cell_y", "ref_x", "ref_y", same("whole", "ref_x", "old_y", "ref_x", "ref_y").alias("ref_inside"))
    return made.filter((F.size(polygon) > 0) | F.col("ref_inside"))


def _pays_to_cut(polygon: str) -> Column:
    """Whether the cell has too many edges and few of them so long that they would go into most of the smaller cells."""
    size = F.pow(F.lit(2.0), F.col("cell_level"))
    reach = F.aggregate(polygon, F.lit(0.0), lambda s, e: s + F.least(size, F.abs(e["x2"] - e["x1"])) + F.least(size, F.abs(e["y2"] - e["y1"])))
    cells_met = F.size(polygon) + reach / size * (2 ** CUT_LEVELS)
    return (F.size(polygon) > MOST_EDGES) & (F.col("cell_level") - CUT_LEVELS >= FINEST_CUT) & (cells_met <= 4 * F.size(polygon))


def polygon_index(polygons: DataFrame, polygon: str, materialize: Materialize = written) -> DataFrame:
    """The cells that polygons are filed in, with the edges to test there.

    Cells of small polygons have all their edges and no reference point; cells of others the edges that touch them, and
    ``ref_inside`` for the point (``ref_x``, ``ref_y``). Polygons whose edges mostly run right through (a comb) are not cut there.
    """
    no = F.lit(None).cast("double")
    filed = materialize(_filed_polygons(polygons, polygon).withColumns({"ref_x": no, "ref_y": no, "ref_inside": F.lit(None).cast("boolean")}))
    many = F.size(polygon) > MOST_EDGES
    work = filed.filter(many)
    if work.isEmpty():
        return filed
    size = F.pow(F.lit(2.0), F.col("cell_level"))
    work = work.withColumns({"ref_x": _reference("x"), "ref_y": _reference("y")})
    work = work.withColumn("ref_inside", geo.inside(polygon, "ref_x", "ref_y"))
    work = work.withColumn(polygon, geo.touching(polygon, F.col("cell_x") * size, F.col("cell_y") * size, size, size))
    done = [filed.filter(~many)]
    while True:
        work = materialize(work.withColumn("cut", _pays_to_cut(polygon)))
        done.append(work.filter(~F.col("cut")).drop("cut"))
        more = work.filter("cut").drop("cut")
        if more.isEmpty():
            return reduce(DataFrame.unionByName, done)
        work = _cut_cells(more, polygon)


def spatial_join(points: DataFrame, polygons: DataFrame, lon: str, lat: str, polygon: str,
                 levels: Sequence[int] | None = None, materialize: Materialize = written) -> DataFrame:
    """Inner join of points with every polygon they lie in; the polygon column and its box are not kept.

    ``levels`` names the grid levels in use when known beforehand; otherwise one aggregate over the index
    finds them (34 whole numbers at most come to the driver).
    """
    keep = [c for c in polygons.columns if c != polygon]
    filed, levels = _ready(points, polygons, lon, lat, polygon, levels, materialize)
    if not levels:
        return points.join(polygons.select(*keep), F.lit(False), "inner")
    return _held(_looked_up(points, lon, lat, levels), filed, lon, lat, polygon, "inner", points.columns, keep)


def points_inside(points: DataFrame, polygons: DataFrame, point_id: str, lon: str, lat: str, polygon: str,
                  materialize: Materialize = written) -> DataFrame:
    """The distinct ids of the points that lie in some polygon: a point's search in a cell ends at the first polygon that holds it, so
    polygons that overlap many times over add no rows."""
    places = points.select(point_id, lon, lat)
    filed, levels = _ready(places, polygons.select(polygon), lon, lat, polygon, None, materialize)
    return _ids_inside(places, filed, levels, point_id, lon, lat, polygon)


def _ids_inside(places: DataFrame, filed: DataFrame, levels: Sequence[int], point_id: str, lon: str, lat: str, polygon: str) -> DataFrame:
    if not levels:
        return places.select(point_id).filter(F.lit(False))
    return _held(_looked_up(places, lon, lat, levels), filed, lon, lat, polygon, "left_semi", [point_id]).distinct()


_GRID = ["cell_level", "cell_x", "cell_y"]


def _levels_of(filed: DataFrame) -> list[int]:
    return sorted(r.cell_level for r in filed.select("cell_level").distinct().collect())


def _looked_up(points: DataFrame, lon: str, lat: str, levels: Sequence[int]) -> DataFrame:
    """A row per point and level, with the point's cell there."""
    placed = points.withColumn("cell_level", F.explode(F.array(*[F.lit(int(v)) for v in levels])))
    return placed.withColumns({"cell_x": _cell(F.col(lon), F.col("cell_level")), "cell_y": _cell(F.col(lat), F.col("cell_level"))})


def _cut_crowded(filed: DataFrame, points: DataFrame, lon: str, lat: str, polygon: str, levels: Sequence[int],
                 materialize: Materialize) -> tuple[DataFrame, Sequence[int]]:
    """The index with polygons cut into smaller cells where a cell has ``CROWD`` points, and the levels then in use.

    Where points and polygons are both many, most pairs that share an uncut cell miss; of the smaller cells most are wholly
    inside or outside, so the pairs that meet are little more than those that hold.
    """
    counts = _looked_up(points.select(lon, lat), lon, lat, levels).groupBy(*_GRID).agg(F.count(F.lit(1)).alias("n"))
    crowded = materialize(counts.filter(F.col("n") >= CROWD).select(*_GRID))
    if crowded.isEmpty():
        return filed, levels
    edges = F.size(polygon)
    may = (edges > 0) & (edges <= MOST_EDGES) & (F.col("cell_level") - CUT_LEVELS >= FINEST_CUT)
    # a small table with much work in each row
    work = filed.filter(may).join(crowded, _GRID, "left_semi").repartition(4 * filed.sparkSession.sparkContext.defaultParallelism)
    size = F.pow(F.lit(2.0), F.col("cell_level"))
    known = F.col("ref_inside").isNotNull()
    work = work.withColumns({f"ref_{v}": F.when(known, F.col(f"ref_{v}")).otherwise(_reference(v)) for v in "xy"})
    work = work.withColumn("ref_inside", F.when(known, F.col("ref_inside")).otherwise(geo.inside(polygon, "ref_x", "ref_y")))
    work = work.withColumn(polygon, geo.touching(polygon, F.col("cell_x") * size, F.col("cell_y") * size, size, size))
    rest = filed.filter(~may).unionByName(filed.filter(may).join(crowded, _GRID, "left_anti"))
    cut = materialize(rest.unionByName(_cut_cells(work, polygon)))
    return cut, _levels_of(cut)


def _ready(points: DataFrame, polygons: DataFrame, lon: str, lat: str, polygon: str, levels: Sequence[int] | None,
           materialize: Materialize) -> tuple[DataFrame, Sequence[int]]:
    """The index of the polygons, cut where points crowd, and its levels (none without any polygon)."""
    filed = polygon_index(polygons, polygon, materialize)
    levels = _levels_of(filed) if levels is None else levels
    return _cut_crowded(filed, points, lon, lat, polygon, levels, materialize) if levels else (filed, levels)


def _edge_columns(filed: DataFrame, polygon: str) -> DataFrame:
    """Each edge of cells with ``FEW_EDGES`` at most as columns, and where it crosses the vertical through the reference point.

    Without a reference point it is one far to the east, outside: then the way to a point is the ray of ``inside``. Values that no
    way meets stand for edges and crossings that are not there, so nothing is null.
    """
    far = F.lit(float("inf"))
    out = {"ref_x": F.coalesce("ref_x", far), "ref_y": F.coalesce("ref_y", F.lit(0.0)), "ref_inside": F.coalesce("ref_inside", F.lit(False))}
    for i in range(FEW_EDGES):
        edge = F.get(polygon, F.lit(i))
        x1, y1, x2, y2 = (F.coalesce(edge[c], F.lit(0.0)) for c in ("x1", "y1", "x2", "y2"))
        run, rise = x2 - x1, y2 - y1
        spans = F.col("ref_x").isNotNull() & ((x1 > F.col("ref_x")) != (x2 > F.col("ref_x")))
        at_y = rise * (F.col("ref_x") - x1) / F.nullif(run, F.lit(0.0)) + y1
        out |= {f"x{i}": x1, f"y{i}": y1, f"top{i}": y2, f"run{i}": run, f"rise{i}": F.when(rise == 0, F.lit(1.0)).otherwise(rise),
                f"up{i}": F.coalesce(F.when(spans, at_y), far)}
    return filed.withColumns(out).drop(polygon)


def _holds_by_columns(x: Column, y: Column) -> Column:
    """``same_side`` of the reference point and (x, y) as ``ref_inside`` says, by the edges of ``_edge_columns``.

    Spark compiles plain columns into the join, but runs a lambda over an array value by value.
    """
    odd = F.lit(False)
    for i in range(FEW_EDGES):
        at_x = F.col(f"g.run{i}") * (y - F.col(f"g.y{i}")) / F.col(f"g.rise{i}") + F.col(f"g.x{i}")
        across = ((F.col(f"g.y{i}") > y) != (F.col(f"g.top{i}") > y)) & ((at_x > F.col("g.ref_x")) != (at_x > x))
        up = (F.col(f"g.up{i}") > F.col("g.ref_y")) != (F.col(f"g.up{i}") > y)
        odd = odd != (up != across)
    return odd != F.col("g.ref_inside")


def _held(looked_up: DataFrame, filed: DataFrame, lon: str, lat: str, polygon: str, how: str, of_point: Sequence[str],
          of_polygon: Sequence[str] = ()) -> DataFrame:
    """Columns of the points, and of the polygons that hold them (``left_semi``: a point may come twice)."""
    x, y = F.col(f"p.{lon}"), F.col(f"p.{lat}")
    in_box = x.between(F.col("g.box_x0"), F.col("g.box_x1")) & y.between(F.col("g.box_y0"), F.col("g.box_y1"))
    by_reference = geo.same_side(f"g.{polygon}", F.col("g.ref_x"), F.col("g.ref_y"), x, y) == F.col("g.ref_inside")
    by_lambda = F.when(F.col("g.ref_inside").isNull(), geo.inside(f"g.{polygon}", x, y)).otherwise(by_reference)
    few = F.size(polygon) <= FEW_EDGES
    many = filed.filter(~few)
    parts = [(_edge_columns(filed.filter(few), polygon), _holds_by_columns(x, y))] + ([] if many.isEmpty() else [(many, by_lambda)])

    def met(part: DataFrame, holds: Column) -> DataFrame:
        p, g = looked_up.alias("p"), part.alias("g")
        same_cell = [F.col(f"p.{k}") == F.col(f"g.{k}") for k in _GRID]
        found = p.join(g, same_cell[0] & same_cell[1] & same_cell[2] & in_box & holds, how)
        return found.select(*[F.col(f"p.{c}") for c in of_point], *[F.col(f"g.{c}") for c in of_polygon])

    return reduce(DataFrame.union, [met(*v) for v in parts])


def least_inside(points: DataFrame, polygons: DataFrame, lon: str, lat: str, polygon: str, ranks: Sequence[str],
                 materialize: Materialize = written) -> DataFrame:
    """The distinct points that lie in some polygon, with the least of each rank (whole numbers) of the polygons that hold them.

    A polygon without a rank (NULL) takes no part in it. In a cell only those polygons are met that come before the first one that
    holds the whole cell, so polygons that overlap many times over add few pairs.
    """
    points = materialize(points.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull()).distinct())
    filed = polygon_index(polygons.select(polygon, *ranks), polygon, materialize)
    levels = _levels_of(filed)
    if not levels:
        return points.filter(F.lit(False)).withColumns({r: F.lit(None).cast("long") for r in ranks})
    filed, levels = _cut_crowded(filed, points, lon, lat, polygon, levels, materialize)
    whole = F.coalesce((F.size(polygon) == 0) & F.col("ref_inside"), F.lit(False))
    covers = materialize(filed.filter(whole).groupBy(*_GRID).agg(*[F.min(r).alias(f"whole_{r}") for r in ranks]))
    some = filed.filter(~whole).join(covers, _GRID, "left")
    some = some.withColumns({r: F.when(F.col(f"whole_{r}").isNull() | (F.col(r) < F.col(f"whole_{r}")), F.col(r)) for r in ranks})
    some = some.filter(F.coalesce(*ranks).isNotNull()).drop(*[f"whole_{r}" for r in ranks])
    looked_up = _looked_up(points, lon, lat, levels)
    met = _held(looked_up, some, lon, lat, polygon, "inner", points.columns, ranks)
    in_whole = looked_up.join(covers, _GRID).select(*points.columns, *[F.col(f"whole_{r}").alias(r) for r in ranks])
    return met.unionByName(in_whole).groupBy(*points.columns).agg(*[F.min(r).alias(r) for r in ranks])


def spatial_join_reverse(polygons: DataFrame, points: DataFrame, polygon: str, lon: str, lat: str) -> DataFrame:
    """The same join seen from the polygons: every polygon with each reference point inside it."""
    joined = spatial_join(points, polygons, lon, lat, polygon)
    return joined.select(*[c for c in polygons.columns if c != polygon], *points.columns)


def key_else_spatial(df: DataFrame, reference: DataFrame, key: str, code: str, polygons: DataFrame, polygon: str,
                     lon: str, lat: str) -> DataFrame:
    """Attach reference rows by code; an area whose code is unknown takes the rows located inside its polygon.

    The spatial part runs once per unmatched area, not per row of ``df``: areas are few, rows are many. ``code``,
    ``lon`` and ``lat`` of the reference are not kept.
    """
    values = [c for c in reference.columns if c not in (code, lon, lat)]
    by_code = reference.filter(F.col(code).isNotNull()).withColumnRenamed(code, key).select(key, *values)
    areas = polygons.select(key, polygon)
    unmatched = areas.join(by_code.select(key).distinct(), key, "left_anti")
    located = spatial_join(reference.select(lon, lat, *values), unmatched, lon, lat, polygon).select(key, *values)
    return df.join(by_code.unionByName(located), key, "inner")


def _globe_cells(p: Sequence[Column]) -> list[Column]:
    return [F.floor((v + F.lit(1.0)) * F.lit(CELLS_PER_RADIUS)).cast("long") for v in p]


def _pack(level: Column, cells: Sequence[Column]) -> Column:
    """One number for a cell: level, then 17 bits per axis (shifted by one, so a neighbour below zero fits)."""
    packed = level.cast("long")
    for c in cells:
        packed = packed * F.lit(2 ** 17) + (c + F.lit(1))
    return packed


def _coarser(cell: Column, level: Column) -> Column:
    return F.floor(cell / F.pow(F.lit(2.0), level)).cast("long")


def _level_as_wide_as(length: Column) -> Column:
    """The finest level whose cells are at least ``length`` wide."""
    level = F.ceil(F.log2(F.nullif(length * F.lit(CELLS_PER_RADIUS), F.lit(0.0))))
    return F.least(F.greatest(F.coalesce(level, F.lit(0)), F.lit(0)), F.lit(GLOBE_LEVELS)).cast("int")


def _squared_gap(low: Sequence[Column], high: Sequence[Column], box_low: Sequence[Column],
                 box_high: Sequence[Column]) -> Column:
    """Smallest squared distance between two boxes."""
    gaps = [F.greatest(F.lit(0.0), a0 - b1, b0 - a1) for a0, a1, b0, b1 in zip(low, high, box_low, box_high)]
    return sum((F.pow(g, F.lit(2)) for g in gaps), F.lit(0.0))


_END1, _END2, _CELL = ["ax", "ay", "az"], ["bx", "by", "bz"], ["cx", "cy", "cz"]


def _extent() -> Column:
    return F.greatest(*[F.abs(F.col(v) - F.col(u)) for u, v in zip(_END1, _END2)])


def _width(level: Column | int) -> Column:
    return F.pow(F.lit(2.0), F.lit(level) if isinstance(level, int) else level) / F.lit(CELLS_PER_RADIUS)


def _pieces_of(level: int) -> Column:
    """How many pieces no longer than a cell of the level a segment makes."""
    return F.greatest(F.lit(1), F.ceil(_extent() / _width(level))).cast("long")


def _piece_level(segments: DataFrame) -> int:
    """The finest level whose cells cut the segments into at most twice as many pieces (18 sums in one row)."""
    row = segments.agg(F.count(F.lit(1)).alias("n"), *[F.sum(_pieces_of(v)).alias(f"l{v}") for v in range(GLOBE_LEVELS + 1)]).first()
    return next((v for v in range(GLOBE_LEVELS) if (row[f"l{v}"] or 0) <= 2 * row["n"]), GLOBE_LEVELS)


_LOW, _HIGH = ["lx", "ly", "lz"], ["hx", "hy", "hz"]


def _segment_index(segments: DataFrame, level: int) -> DataFrame:
    """Pieces of the segments no longer than a cell of ``level``, each filed in the cells it touches at its own and all coarser levels.

    The own level is the finest whose cells are as wide as the piece, ``level`` at most. A row has the whole segment, by which
    distances are measured, and the box and one end of the piece.
    """
    count = _pieces_of(level)
    cut = segments.withColumn("pieces", count).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))

    def at(i: Column, a: str, b: str) -> Column:
        # both ends exactly, so that neighbouring pieces leave no gap
        return F.when(i == F.col("pieces"), F.col(b)).otherwise(F.col(a) + (F.col(b) - F.col(a)) * (i / F.col("pieces")))

    ends = [(at(F.col("piece"), a, b), at(F.col("piece") + 1, a, b)) for a, b in zip(_END1, _END2)]
    # a hair wider, as the points between are rounded
    boxes = {n: F.least(u, v) - 1e-12 for n, (u, v) in zip(_LOW, ends)} | {n: F.greatest(u, v) + 1e-12 for n, (u, v) in zip(_HIGH, ends)}
    filed = cut.withColumns(boxes | {n: u for n, (u, _) in zip(("ex", "ey", "ez"), ends)})
    own = F.least(_level_as_wide_as(F.greatest(*[F.col(h) - F.col(lo) for lo, h in zip(_LOW, _HIGH)])), F.lit(level))
    ways = F.sequence(F.col("own"), F.lit(GLOBE_LEVELS))
    ways = F.when(F.col("own") > 0, F.concat(ways, F.array(F.col("own") + OWN))).otherwise(ways)
    filed = filed.withColumn("own", own).withColumn("way", F.explode(ways)).withColumn("cell_level", F.col("way") % OWN)
    for name, lo, hi in zip(_CELL, _globe_cells([F.col(c) for c in _LOW]), _globe_cells([F.col(c) for c in _HIGH])):
        filed = filed.withColumn(name, F.explode(F.sequence(*[_coarser(v, F.col("cell_level")) for v in (lo, hi)])))
    return filed.withColumn("cell", _pack(F.col("way"), [F.col(c) for c in _CELL])).drop(*_CELL, "cell_level", "pieces", "piece", "own", "way")


def _farthest(place: Sequence[Column], low: Sequence[Column], high: Sequence[Column]) -> Column:
    """The largest distance from a place to a point of a box; rounding must never cut a winner."""
    reach = [F.greatest(F.abs(v - lo), F.abs(v - hi)) for v, lo, hi in zip(place, low, high)]
    return F.sqrt(sum((F.pow(r, F.lit(2)) for r in reach), F.lit(0.0))) * F.lit(1.000001) + F.lit(1e-12)


_LEAF = ["leaf_level", *_CELL]
#: Points that share a leaf cell on average, and places in a cell at most on average, where the search is for places.
POINTS_PER_LEAF, PLACES_PER_LEAF = 8, 2


def _shared_level(seeds: DataFrame, places: DataFrame, group: str) -> int:
    """The level of the leaf cells for a search among places: the finest that ``POINTS_PER_LEAF`` points share, or that still has no
    more than ``PLACES_PER_LEAF`` places a cell where points are rare (two rows of 18 estimates each)."""
    def per_cell(df: DataFrame, names: Sequence[str]) -> list[float]:
        cells = _globe_cells([F.col(c) for c in names])
        row = df.agg(F.count(F.lit(1)).alias("n"), *[
            F.approx_count_distinct(F.xxhash64(group, *[_coarser(c, F.lit(v)) for c in cells]), 0.1).alias(f"l{v}") for v in range(GLOBE_LEVELS + 1)]).first()
        return [row.n / max(1, row[f"l{v}"]) for v in range(GLOBE_LEVELS + 1)]

    shared = next((v for v, n in enumerate(per_cell(seeds, ("px", "py", "pz"))) if n >= POINTS_PER_LEAF), GLOBE_LEVELS)
    sparse = max((v for v, n in enumerate(per_cell(places, _END1)) if n <= PLACES_PER_LEAF), default=0)
    return min(shared, sparse)


def _leaves(group: str, level: int, index: DataFrame, seeds: DataFrame) -> DataFrame:
    """``seeds`` (with px, py, pz) with their leaf cell: of ``level``, or of the finest where many pieces are in that cell."""
    cells = _globe_cells([F.col(c) for c in ("px", "py", "pz")])
    placed = seeds.withColumns(dict(zip(_CELL, cells)))
    if not level:
        return placed.withColumn("leaf_level", F.lit(0))
    coarse = _pack(F.lit(level), [_coarser(F.col(c), F.lit(level)) for c in _CELL])
    crowded = index.groupBy(group, "cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > MOST_PIECES) \
        .select(F.col(group).alias("of"), "cell", F.lit(0).alias("finest"))
    met = placed.withColumn("coarse", coarse).join(crowded, (F.col(group) == F.col("of")) & (F.col("coarse") == F.col("cell")), "left")
    leaf = met.withColumn("leaf_level", F.coalesce("finest", F.lit(level)))
    return leaf.withColumns({c: _coarser(F.col(c), F.col("leaf_level")) for c in _CELL}).drop("coarse", "of", "cell", "finest")


def short_lists(leaves: DataFrame, index: DataFrame, group: str, piece_level: int, materialize: Materialize = written,
                cut: bool = True) -> DataFrame:
    """The pieces of the index that can be nearest to some point of each leaf cell (group, ``leaf_level`` and cell numbers).

    One end of a piece in the finest enclosing cell that is not empty gives a first bound. The cells within it, at the level whose cells
    are as wide as it (at most three an axis), hold all that can win, but for longer pieces, which are looked up at their own
    levels. The nearest of an end from each of these cells gives a second bound. Cells, then pieces, beyond that one are cut
    (``cut=False`` leaves the pieces in, to count them).
    """
    width = _width(F.col("leaf_level"))
    cell = [F.col(c) for c in _CELL]
    low = [c.cast("double") * width - F.lit(1.0) for c in cell]
    high = [v + width for v in low]
    boxes = [F.min(c).alias(c) for c in _LOW] + [F.max(c).alias(c) for c in _HIGH]
    cells = materialize(index.groupBy(group, "cell").agg(F.min(F.struct("ex", "ey", "ez")).alias("known"), *boxes))
    known = [F.col(f"known.{c}") for c in ("ex", "ey", "ez")]

    up = leaves.withColumn("level", F.explode(F.sequence(F.col("leaf_level"), F.lit(GLOBE_LEVELS))))
    up = up.withColumn("cell", _pack(F.col("level"), [_coarser(c, F.col("level") - F.col("leaf_level")) for c in cell]))
    bounds = up.join(cells, [group, "cell"]).groupBy(group, *_LEAF).agg(F.min(_farthest(known, low, high)).alias("bound"))

    first = _level_as_wide_as(F.col("bound"))
    wide = bounds.withColumn("first_level", first)
    wide = wide.withColumn("level", F.explode(F.sequence(F.col("first_level"), F.greatest(F.col("first_level"), F.lit(piece_level)))))
    for name, lo, hi in zip(("nx", "ny", "nz"), low, high):
        first_cell, last_cell = (_coarser(F.floor(v * F.lit(CELLS_PER_RADIUS)), F.col("level"))
                                 for v in (lo - F.col("bound") + F.lit(1.0), hi + F.col("bound") + F.lit(1.0)))
        wide = wide.withColumn(name, F.explode(F.sequence(first_cell, last_cell)))
    way = F.when(F.col("level") == F.col("first_level"), F.col("level")).otherwise(F.col("level") + OWN)
    wide = wide.withColumn("cell", _pack(way, [F.col("nx"), F.col("ny"), F.col("nz")])).select(group, *_LEAF, "cell")
    gap = _squared_gap(low, high, [F.col(c) for c in _LOW], [F.col(c) for c in _HIGH])
    met = materialize(wide.join(cells, [group, "cell"]).select(group, *_LEAF, "cell", gap.alias("gap"), _farthest(known, low, high).alias("far")))
    second = met.groupBy(group, *_LEAF).agg(F.min("far").alias("bound"))
    near = met.join(second, [group, *_LEAF]).filter(F.col("gap") <= F.col("bound") * F.col("bound")).select(group, *_LEAF, "cell", "bound")
    lists = near.join(index, [group, "cell"])
    return lists.filter(gap <= F.col("bound") * F.col("bound")) if cut else lists


def nearest_segment(points: DataFrame, segments: DataFrame, point_id: str, candidate_id: str, group: str,
                    lon: str, lat: str, only_points: bool, out: str = "distance",
                    materialize: Materialize = written) -> DataFrame:
    """For each point the nearest candidate of its group: ``(point_id, group, candidate_id, distance in metres)``.

    ``segments`` has ``group``, ``candidate_id`` and the end points ``lon1, lat1, lon2, lat2`` in degrees; a candidate
    may own many segments, and a place is a segment of length zero (``only_points``). Equal distances go to the
    smallest id. Points without a location, and groups without candidates, give no row.
    """
    ends = {}
    for names, (x, y) in ((_END1, ("lon1", "lat1")), (_END2, ("lon2", "lat2"))):
        ends.update(dict(zip(names, geo.unit_vector(x, y))))
    # candidates at the very same place differ by id only, and the smallest wins
    known = segments.dropna(subset=[group, candidate_id, "lon1", "lat1", "lon2", "lat2"])
    vectors = known.select(group, candidate_id, *[c.alias(n) for n, c in ends.items()])
    places = materialize(vectors.groupBy(group, *_END1, *_END2).agg(F.min(candidate_id).alias(candidate_id)))
    piece_level = 0 if only_points else _piece_level(places)
    index = _segment_index(places, piece_level)
    if only_points:  # a place is its own box: only its cells are stored
        index = materialize(index.select(group, candidate_id, *_END1, *_END2, "cell"))
        index = index.withColumns({n: F.col(c) for names in (_LOW, _HIGH, ("ex", "ey", "ez")) for n, c in zip(names, _END1)})
    else:
        index = materialize(index)

    seeds = points.select(point_id, group, lon, lat).dropna().withColumns(
        dict(zip(["px", "py", "pz"], geo.unit_vector(lon, lat))))
    p = [F.col(c) for c in ("px", "py", "pz")]
    if only_points:
        seeds = materialize(seeds.select(point_id, group, "px", "py", "pz"))
        seeds = _leaves(group, _shared_level(seeds, places, group), index, seeds).select(point_id, group, "px", "py", "pz", *_LEAF)
    else:
        seeds = _leaves(group, max(0, piece_level - 1), index, seeds)
        seeds = materialize(seeds.select(point_id, group, "px", "py", "pz", *_LEAF))
    lists = short_lists(seeds.select(group, *_LEAF).distinct(), index, group, piece_level, materialize) \
        .select(group, *_LEAF, candidate_id, *_END1, *_END2)
    if not only_points:
        lists = lists.distinct()  # a segment may come in several pieces and cells
    a, b = [F.col(c) for c in _END1], [F.col(c) for c in _END2]

    # points against the short list of their cell
    pairs = seeds.join(lists, [group, *_LEAF])
    if only_points:
        squared = geo.squared_to_point(p, a)
    else:
        # a column of its own: it is used three times
        pairs = pairs.withColumn("position", geo.position_on_segment(p, a, b))
        squared = geo.squared_to_segment_at(p, a, b, F.col("position"))
    pairs = pairs.select(point_id, group, candidate_id, squared.alias("squared"))
    best = top1(pairs, [point_id, group], ["squared", candidate_id])
    return best.select(point_id, group, candidate_id, geo.chord_to_metres(F.col("squared")).alias(out))


def nearest_in_group(points: DataFrame, polygons: DataFrame, point_id: str, polygon_id: str, group: str, lon: str,
                     lat: str, polygon: str, out: str = "distance", materialize: Materialize = written) -> DataFrame:
    """The nearest polygon of the point's group, for points that lie in none: the nearest edge decides."""
    edges = polygons.select(group, polygon_id, F.explode(polygon).alias("edge"))
    segments = edges.select(group, polygon_id, F.col("edge.x1").alias("lon1"), F.col("edge.y1").alias("lat1"),
                            F.col("edge.x2").alias("lon2"), F.col("edge.y2").alias("lat2"))
    return nearest_segment(points, segments, point_id, polygon_id, group, lon, lat, only_points=False, out=out,
                           materialize=materialize)


def nearest_school_in_state(points: DataFrame, places: DataFrame, point_id: str, place_id: str, group: str, lon: str,
                            lat: str, place_lon: str, place_lat: str, out: str = "distance",
                            materialize: Materialize = written) -> DataFrame:
    """The nearest place (such as a school of one level) in the point's group (such as its state)."""
    segments = places.select(group, place_id, F.col(place_lon).alias("lon1"), F.col(place_lat).alias("lat1"),
                             F.col(place_lon).alias("lon2"), F.col(place_lat).alias("lat2"))
    return nearest_segment(points, segments, point_id, place_id, group, lon, lat, only_points=True, out=out,
                           materialize=materialize)


def contains_or_nearest(points: DataFrame, polygons: DataFrame, point_id: str, polygon_id: str, group: str, lon: str,
                        lat: str, polygon: str, materialize: Materialize = written) -> DataFrame:
    """``(point_id, polygon_id)``: every polygon a point lies in; for points in none, the nearest of their group."""
    places = points.select(point_id, lon, lat)
    filed, levels = _ready(places, polygons.select(polygon_id, polygon), lon, lat, polygon, None, materialize)
    rest = points.select(point_id, group, lon, lat).join(_ids_inside(places, filed, levels, point_id, lon, lat, polygon), point_id, "left_anti")
    nearest = nearest_in_group(rest, polygons, point_id, polygon_id, group, lon, lat, polygon,
                               materialize=materialize)
    nearest = nearest.select(point_id, polygon_id)
    if not levels:
        return nearest
    # found last: the pairs are many, and nothing else needs them
    return _held(_looked_up(places, lon, lat, levels), filed, lon, lat, polygon, "inner", [point_id], [polygon_id]).union(nearest)
