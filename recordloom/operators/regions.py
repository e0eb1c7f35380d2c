"""Point-in-polygon and nearest-polygon enrichment without a cross join.

Points are never compared with all regions. The cells of a power-of-two grid that
hold points are found first (one distinct, so a spot that holds a third of all
points counts once). For these cells the regions that can matter are worked out by
equi-joins on grid tiles and stored as two small tables:

* ``inside``: what lies inside a region, as tiles of any level that it covers as a whole and
  cells on its border, these with only the edges a ray from the cell can meet. Each row of
  cells is cut into tiles for itself, so a region adds rows in proportion to its border;
* ``near``: per unit of cells not wholly covered, the edges that may be nearest to a point of it,
  and ``units``, which names the unit of every such cell.

Points then meet these tables by tile and unit. Both are exact: whatever is left out is
farther than something kept, for every point of the cell.

Tiles: level ``L`` has tiles of ``cell * 2**L`` degrees, so the tile of a cell is its
number shifted right by ``L``. A region is indexed from its native level upwards, the
first whose tiles are at least as large as its bounding box, and on each level in the
tiles its box touches and their neighbours: at most 16.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleaning import fill_borough, fill_zip
from ..functions.geometry import bounds, contains, distance, segments, shrink, with_polygon, wkt_problem
from ..sources.scratch import byte_count, materialize, materialize_measured, materialize_observed
from .filters import needs_region
from .joins import BROADCAST_BYTES, ROWS_PER_TASK, sized_join
from .projection import replace_columns

# Grid cell in degrees, a power of two so that cell borders are exact: 0.9 km from north to south,
# small next to postal areas. Finer cells hold fewer edges each but make larger tables.
CELL = 1 / 128

# The coarsest tiles; with their neighbours they hold every valid coordinate.
WORLD = 512.0

# Edges that start in one tile of so many cells are looked at together.
PIECE_CELLS = 2

# Tiles inside a region have sides of 1, 4, 16, ... cells: two levels apart.
TILE_STEP = 2

# How far an edge may lie from where its interpolated course says, in degrees; rounding stays far below.
WIDTH = 1e-9

# Distances are ranked after rounding to 1e-9; candidates are kept a little beyond a tie.
SLACK = 1e-8

# Cell number of a missing coordinate, far from any real one.
NOWHERE = -(1 << 40)

TILE = ["level", "tx", "ty"]
CELL_KEY = ["cx", "cy"]
NEAR_KEY = ["size", "ux", "uy"]
BOX = ["xmin", "xmax", "ymin", "ymax"]


@dataclass(frozen=True)
class RegionIndex:
    """Candidate regions of the occupied ``cells``, as written tables of known size; ``levels`` are those of ``inside``."""

    cell: float
    cells: DataFrame
    inside: DataFrame
    inside_bytes: int
    levels: tuple[int, ...]
    units: DataFrame | None = None
    units_bytes: int = 0
    near: DataFrame | None = None
    near_bytes: int = 0


def _top_level(cell: float) -> int:
    top = math.log2(WORLD / cell)
    if top != int(top) or top < 0:
        raise ValueError("cell must be a power of two, at most 512 degrees")
    return int(top)


def point(longitude: Column, latitude: Column, strict: bool = True) -> tuple[Column, Column]:
    """x and y of a coordinate pair: longitude comes first and wraps, latitude must be valid.

    ``strict`` fails the job on an invalid latitude, otherwise it counts as missing.
    """
    x, y = longitude.cast("double"), latitude.cast("double")
    wrapped = F.when(F.abs(x) <= 180.0, x).otherwise(F.pmod(x + 180.0, F.lit(360.0)) - 180.0)
    bad = F.raise_error(F.lit("latitude outside -90 to 90")).cast("double") if strict else F.lit(None).cast("double")
    return wrapped, F.when(F.abs(y) > 90.0, bad).otherwise(y)


def unreadable_regions(seed: DataFrame, wkt: str = "geom_wkt") -> DataFrame:
    """The rows whose text is no polygon, with the reason as ``problem``: what ``strict=False`` leaves out."""
    return seed.withColumn("problem", wkt_problem(F.col(wkt))).filter("problem is not null")


def parse_regions(seed: DataFrame, wkt: str = "geom_wkt", strict: bool = True) -> DataFrame:
    """Parse every polygon text once into edges and a bounding box, and give it a number.

    A text that is no closed polygon fails the job, as the records in it would go to a neighbour;
    ``strict=False`` leaves it out (see ``unreadable_regions``). NULL and EMPTY have no edges.
    Written out before anything is asked of the outcome: edges and verdict come from one reading of the
    text, and the numbers stay the same for all readers.
    """
    texts = seed.select(F.col("zip_code").alias("derived_zip"), F.col("borough").alias("derived_borough"), F.col(wkt).alias("_wkt"))
    parsed = with_polygon(texts, "_wkt").drop("_wkt").withColumn("region_id", F.monotonically_increasing_id())
    bad = F.count_if(F.col("problem").isNotNull())
    regions, seen = materialize_observed(parsed.withColumns(bounds(F.col("edges"))), "regions", bad=bad)
    if strict and seen["bad"]:
        failed = F.raise_error(F.concat(F.lit("region text: "), F.col("problem")))
        regions.filter("problem is not null").select(failed).collect()
    return regions.filter("problem is null and size(edges) > 0").drop("problem")


def cell_columns(x: Column, y: Column, cell: float) -> dict[str, Column]:
    """The cell of a point, ``NOWHERE`` without coordinates.

    Never NULL: for a join key that can be NULL, Spark adds a filter below the projection
    that works the whole coordinate expression out once more for every row.
    """
    nowhere = F.lit(NOWHERE).cast("bigint")
    return {"cx": F.coalesce(F.floor(x / F.lit(cell)), nowhere), "cy": F.coalesce(F.floor(y / F.lit(cell)), nowhere)}


def occupied_cells(points: DataFrame, x: Column, y: Column, cell: float = CELL) -> DataFrame:
    """The distinct grid cells that hold a point, and perhaps one of points without coordinates.

    That one matches no region and no point.
    """
    return cells_of(points.select(*[c.alias(n) for n, c in cell_columns(x, y, cell).items()]))


def cells_of(points: DataFrame) -> DataFrame:
    """The occupied cells of ``as_points``."""
    return points.select(*CELL_KEY).distinct()


# ---- the tile index ---------------------------------------------------------------------------


def _native_level(regions: DataFrame, cell: float) -> DataFrame:
    extent = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))
    levels = F.sequence(F.lit(0), F.lit(_top_level(cell)))
    native = F.array_min(F.filter(levels, lambda level: F.pow(F.lit(2.0), level) * cell >= extent))
    return regions.select("region_id", *BOX, native.alias("native"))


def _region_tiles(leveled: DataFrame, cell: float, ring: int) -> DataFrame:
    """The tiles each region touches on its ``level``, borders included, and ``ring`` neighbours on every side."""
    side = F.pow(F.lit(2.0), F.col("level")) * cell

    def reach(low: str, high: str) -> Column:
        return F.explode(F.sequence(F.ceil(F.col(low) / side) - 1 - ring, F.floor(F.col(high) / side) + ring))

    return leveled.withColumn("tx", reach("xmin", "xmax")).withColumn("ty", reach("ymin", "ymax"))


def _native_levels(leveled: DataFrame) -> list[int]:
    """The levels on which something is native: as many numbers as there are levels, at most."""
    return sorted(row.native for row in leveled.select("native").distinct().collect())


def _unit_tiles(units: DataFrame, first: Column, last: Column, only: list[int] | None = None) -> DataFrame:
    """The tile of every unit on each level from ``first`` to ``last``, or those ``only``; none if the range is empty.

    A unit is a tile too, ``cx``, ``cy`` on level ``size``; cells are the units of size 0.
    """
    levels = F.when(first <= last, F.sequence(first, last))
    if only is not None:
        known = F.array(*map(F.lit, only)).cast("array<int>")
        levels = F.filter(levels, lambda level: F.array_contains(known, level))
    return units.withColumn("level", F.explode(levels)).withColumns(
        {"tx": F.expr("shiftright(cx, level - size)"), "ty": F.expr("shiftright(cy, level - size)")}
    )


def _on(*keys: str) -> list[tuple[Column, Column]]:
    return [(F.col(k), F.col(f"_at_{k}")) for k in keys]


def _at(table: DataFrame, *keys: str) -> DataFrame:
    return table.withColumnsRenamed({k: f"_at_{k}" for k in keys})


def _on_tiles(tiles: DataFrame, probes: DataFrame, how: str = "inner") -> DataFrame:
    """Rows of ``tiles`` with those of ``probes`` in the same tile; the latter are written, and broadcast if they fit the budget.

    Left alone, Spark judges either side by the file it is computed from, before every row of that becomes hundreds.
    """
    probes, size = materialize_measured(_at(probes, *TILE), "probes")
    return sized_join(tiles, probes, _on(*TILE), how, size=size)


UNIT = ["size", *CELL_KEY]
UNIT_BOX = ["x0", "x1", "y0", "y1", "low", "high"]


def _with_box(units: DataFrame, cell: float) -> DataFrame:
    """Borders of each unit and the smallest and largest cosine of latitude within it.

    Columns rather than expressions: lambdas would work an expression out anew for every edge.
    """
    side = F.pow(F.lit(2.0), F.col("size")) * cell
    y0, y1 = F.col("cy") * side, (F.col("cy") + 1) * side
    nearest_to_equator = F.when((y0 <= 0) & (y1 >= 0), 0.0).otherwise(F.least(F.abs(y0), F.abs(y1)))

    def cosine(latitude: Column) -> Column:
        return F.greatest(F.lit(0.0), F.cos(F.radians(F.least(latitude, F.lit(90.0)))))

    return units.withColumns(
        {
            "x0": F.col("cx") * side, "x1": (F.col("cx") + 1) * side, "y0": y0, "y1": y1,
            "low": cosine(F.greatest(F.abs(y0), F.abs(y1))), "high": cosine(nearest_to_equator),
        }
    )


def _least_distance(xlo: Column, xhi: Column, ylo: Column, yhi: Column) -> Column:
    """No point of the cell is nearer to anything in the box than this."""
    zero = F.lit(0.0)
    return F.hypot(
        F.greatest(zero, xlo - F.col("x1"), F.col("x0") - xhi) * F.col("low"),
        F.greatest(zero, ylo - F.col("y1"), F.col("y0") - yhi),
    )


def _most_distance(xlo: Column, xhi: Column, ylo: Column, yhi: Column) -> Column:
    """No point of the cell is farther from anything in the box than this."""
    return F.hypot(
        F.greatest(F.col("x1") - xlo, xhi - F.col("x0")) * F.col("high"),
        F.greatest(F.col("y1") - ylo, yhi - F.col("y0")),
    )


def _as_units(cells: DataFrame) -> DataFrame:
    return cells.withColumn("size", F.lit(0))


def candidate_regions(cells: DataFrame, regions: DataFrame, cell: float = CELL) -> DataFrame:
    """Pairs of an occupied cell and a region whose bounding boxes touch: (cx, cy, region_id).

    Takes the place of a cross join with the regions.
    """
    leveled = _native_level(regions, cell)
    native = _region_tiles(leveled.withColumnRenamed("native", "level"), cell, 0)
    probes = _unit_tiles(_with_box(_as_units(cells), cell), F.lit(0), F.lit(_top_level(cell)), _native_levels(leveled))
    touching = _on_tiles(native, probes).filter("xmin <= x1 and xmax >= x0 and ymin <= y1 and ymax >= y0")
    return touching.select(*CELL_KEY, "region_id")


def _box_of(e: Column) -> tuple[Column, Column, Column, Column]:
    return F.least(e.x1, e.x2), F.greatest(e.x1, e.x2), F.least(e.y1, e.y2), F.greatest(e.y1, e.y2)


def _edge_rows(regions: DataFrame, cell: float) -> DataFrame:
    """Every edge once for each row of cells it touches, borders included, with the labels of its region."""
    edges = regions.select("region_id", "derived_zip", "derived_borough", F.explode("edges").alias("e"))
    _, _, low, high = _box_of(F.col("e"))
    return edges.withColumn("cy", F.explode(F.sequence(F.ceil(low / cell) - 1, F.floor(high / cell))))


def _columns_touched(e: Column, cell: float) -> Column:
    """The cells of the row ``cy`` that an edge runs through, or as near to as ``WIDTH``."""
    y0, y1 = F.col("cy") * cell, (F.col("cy") + 1) * cell
    slope = F.when(e.y1 == e.y2, 0.0).otherwise((e.x2 - e.x1) / (e.y2 - e.y1))

    def course(y: Column, x: Column, at: Column) -> Column:
        """The edge's x where it enters or leaves the row; its own end where that lies in the row."""
        return F.when(y.between(y0, y1), x).otherwise(x + (F.least(F.greatest(y, y0), y1) - y) * at)

    a, b = course(e.y1, e.x1, slope), course(e.y2, e.x2, slope)
    return F.sequence(F.floor((F.least(a, b) - WIDTH) / cell), F.floor((F.greatest(a, b) + WIDTH) / cell))


def _tiles_of_runs(runs: str, cell: float) -> Column:
    """The largest tiles (level, tx) that make up runs of cells ``first`` to ``last``: of each level at most six a run.

    On a level, the tiles ``low`` to ``high`` lie inside the run; those that lie in a tile of the next level that does, too,
    the children of ``up`` to ``upto``, are left to that one. One text, as nested lambdas are slow to put together.
    """
    above = f"(l + {TILE_STEP})"
    return F.expr(
        f"""
        flatten(flatten(transform({runs}, r -> transform(
            transform(sequence(0, {_top_level(cell)}, {TILE_STEP}), l -> struct(l AS level,
                shiftright(r.first + shiftleft(1L, l) - 1, l) AS low, shiftright(r.last + 1, l) - 1 AS high,
                shiftright(r.first + shiftleft(1L, {above}) - 1, {above}) AS up, shiftright(r.last + 1, {above}) - 1 AS upto)),
            s -> transform(
                CASE WHEN s.low > s.high THEN array()
                     WHEN s.up > s.upto THEN sequence(s.low, s.high)
                     ELSE filter(sequence(s.low, s.low + {2 << TILE_STEP}), t -> t < shiftleft(s.up, {TILE_STEP}))
                          || filter(sequence(s.high - {2 << TILE_STEP}, s.high), t -> t >= shiftleft(s.upto + 1, {TILE_STEP})) END,
                t -> struct(s.level AS level, t AS tx))))))
        """
    )


def _inside(cells: DataFrame, cells_bytes: int, regions: DataFrame, cell: float) -> DataFrame:
    """(level, tx, cy, derived_zip, derived_borough, whole, edges), region by region and row by row of cells.

    Where no edge runs through, a run of cells lies on one side of the region as a whole. Rows without
    points are left out, and so are single cells without any.
    """
    occupied_rows = cells.select("cy").distinct()
    rows = sized_join(_edge_rows(regions, cell), _at(occupied_rows, "cy"), _on("cy"), "left_semi", size=cells_bytes)
    rows = rows.groupBy("region_id", "cy", "derived_zip", "derived_borough").agg(F.collect_list("e").alias("edges"))
    columns = F.flatten(F.transform("edges", lambda e: _columns_touched(e, cell)))
    rows = rows.withColumn("touched", F.array_sort(F.array_distinct(columns)))
    n = F.size("touched") - 1
    gaps = F.zip_with(
        F.slice("touched", F.lit(1), n), F.slice("touched", F.lit(2), n),
        lambda a, b: F.struct((a + 1).alias("first"), (b - 1).alias("last")),
    )
    middle = (F.col("cy") + 0.5) * cell
    runs = F.filter(gaps, lambda g: (g.first <= g.last) & contains(F.col("edges"), (g.first + 0.5) * cell, middle))
    rows = rows.withColumn("runs", runs)
    border = F.transform("touched", lambda c: F.struct(F.lit(0).alias("level"), c.alias("tx"), F.lit(False).alias("whole")))
    whole = F.transform(_tiles_of_runs("runs", cell), lambda t: F.struct(t.level, t.tx, F.lit(True).alias("whole")))
    listed = rows.select("derived_zip", "derived_borough", "cy", "edges", F.explode(F.concat(border, whole)).alias("t"))
    placed = listed.select("derived_zip", "derived_borough", "cy", "edges", "t.*")
    single = F.when(F.col("level") == 0, F.col("tx"))
    known = cells.select(F.col("cx").alias("_cx"), F.col("cy").alias("_cy"))
    match = [(single, F.col("_cx")), (F.col("cy"), F.col("_cy"))]
    placed = sized_join(placed, known, match, "left", ["level", "tx", "cy"], cells_bytes).filter("level > 0 or _cx is not null")
    in_reach = F.filter("edges", lambda e: ~F.col("whole") & (F.greatest(e.x1, e.x2) >= F.col("tx") * cell))
    return placed.select("level", "tx", "cy", "derived_zip", "derived_borough", "whole", in_reach.alias("edges"))


def _at_levels(cells: DataFrame, levels: tuple[int, ...]) -> DataFrame:
    """Rows with a cell once for each of the levels, with the tile of its row as level, tx."""
    if levels == (0,):
        return cells.withColumns({"level": F.lit(0), "tx": F.col("cx")})
    leveled = cells.withColumn("level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>")))
    return leveled.withColumn("tx", F.expr("shiftright(cx, level)"))


def _pieces(regions: DataFrame, cell: float) -> tuple[DataFrame, int]:
    """The edges of every region in pieces, each a small region of the same labels with a box of its own, and their size.

    A piece holds the edges of about one size that start in one tile, so its box is as small as they
    allow, and what is near one end of a region does not meet the edges of the other.
    """
    edges = regions.select("region_id", "derived_zip", "derived_borough", F.explode("edges").alias("e"))
    west, east, low, high = _box_of(F.col("e"))
    # ``greatest`` passes over the NULL that an edge of no length gives.
    size = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(east - west, high - low))))
    sized = edges.withColumn("side", F.greatest(F.lit(PIECE_CELLS * cell), size))
    tile = [F.floor(west / F.col("side")).alias("tx"), F.floor(low / F.col("side")).alias("ty")]
    pieces = sized.groupBy("region_id", "derived_zip", "derived_borough", "side", *tile).agg(
        F.collect_list("e").alias("edges"),
        F.min(west).alias("xmin"), F.max(east).alias("xmax"), F.min(low).alias("ymin"), F.max(high).alias("ymax"),
    )
    return materialize_measured(pieces.drop("side", "tx", "ty").withColumn("region_id", F.monotonically_increasing_id()), "pieces")


def _near(cells: DataFrame, regions: DataFrame, cell: float) -> tuple[DataFrame, int, DataFrame, int]:
    """The unit of every cell (cx, cy, size, ux, uy), the edges near each unit, and the sizes of both tables."""
    top = F.lit(_top_level(cell))
    regions, regions_bytes = _pieces(regions, cell)
    native = _native_level(regions, cell)
    # Only tiles that hold a cell are ever asked for: far fewer than those of all pieces on all levels.
    asked, asked_bytes = materialize_measured(_unit_tiles(_as_units(cells), F.lit(0), top).select(*TILE).distinct(), "asked")

    def held(leveled: DataFrame) -> DataFrame:
        return sized_join(_region_tiles(leveled, cell, 1), _at(asked, *TILE), _on(*TILE), "left_semi", size=asked_bytes)

    tiles = held(native.withColumn("level", F.explode(F.sequence(F.col("native"), top))))
    own_tiles = held(native.withColumn("level", F.col("native")))
    shapes = regions.select(F.col("region_id").alias("_of"), "derived_zip", "derived_borough", "edges")
    box = [F.col(c) for c in BOX]

    def least(e: Column) -> Column:
        return _least_distance(*_box_of(e))

    def most(e: Column) -> Column:
        return F.least(_most_distance(e.x1, e.x1, e.y1, e.y1), _most_distance(e.x2, e.x2, e.y2, e.y2))

    # The finest level on which some region is in or next to the cell's tile. All regions are
    # farther than a tile of the level below, so cells can be handled together in units of an
    # eighth of the tile found: small next to the distance, and few however many cells are far out.
    found = _on_tiles(_unit_tiles(_as_units(cells), F.lit(0), top), tiles.select(*TILE).distinct())
    found = found.groupBy(*CELL_KEY).agg(F.min("level").alias("at"))
    grouped = found.withColumn("size", F.greatest(F.lit(0), F.col("at") - 3)).withColumns(
        {"ux": F.expr("shiftright(cx, size)"), "uy": F.expr("shiftright(cy, size)")}
    )
    of_cells, of_cells_bytes = materialize_measured(grouped, "units")
    units = of_cells.select("size", F.col("ux").alias("cx"), F.col("uy").alias("cy"), "at").distinct()
    units = _with_box(units, cell)

    # The boxes of the pieces found there bound the distance from any point of the unit.
    keep = [*UNIT, *UNIT_BOX]
    first = _on_tiles(tiles, _unit_tiles(units, F.col("at"), F.col("at")))
    bound = first.groupBy(*keep).agg(F.min(_most_distance(*box)).alias("bound"))

    # On the level whose tiles are as large as that bound, nothing beyond the neighbours can matter.
    wide_enough = F.filter(
        F.sequence(F.col("size"), top),
        lambda level: F.pow(F.lit(2.0), level) * cell * F.col("low") >= F.col("bound") + SLACK,
    )
    bound = materialize(bound.withColumn("at", F.coalesce(F.array_min(wide_enough), top)), "bound")
    here = _on_tiles(tiles, _unit_tiles(bound, F.col("at"), F.col("at")))
    larger = _on_tiles(own_tiles, _unit_tiles(bound, F.col("at") + 1, top, _native_levels(native)))
    wanted = [*keep, "bound", "region_id", *BOX]
    pairs = here.select(*wanted).unionByName(larger.select(*wanted))
    pairs = pairs.filter(_least_distance(*box) <= F.col("bound") + SLACK).drop(*BOX, "bound")
    # Their edges give a closer bound.
    reach = F.array_min(F.transform("edges", most))
    shaped = sized_join(pairs, shapes, [(F.col("region_id"), F.col("_of"))], "inner", UNIT, regions_bytes).withColumn("bound", F.min(reach).over(Window.partitionBy(*UNIT)))
    within = F.filter("edges", lambda e: least(e) <= F.col("bound") + SLACK)
    shaped = shaped.withColumn("edges", within).filter(F.size("edges") > 0)
    per_unit = shaped.groupBy(
        "size", F.col("cx").alias("ux"), F.col("cy").alias("uy"), "derived_zip", "derived_borough"
    ).agg(F.flatten(F.collect_list(segments(F.col("edges")))).alias("segments"))
    return of_cells.drop("at"), of_cells_bytes, *materialize_measured(per_unit, "near")


def index_regions(cells: DataFrame, regions: DataFrame, cell: float = CELL, with_near: bool = True) -> RegionIndex:
    """Build the candidate tables for the occupied cells; ``near`` is only needed to look for the nearest."""
    cells, cells_bytes = materialize_measured(cells, "cells")
    covers = _inside(cells, cells_bytes, regions, cell)
    levels = F.bit_or(F.expr("shiftleft(1L, level)"))
    inside, seen = materialize_observed(covers, "inside", bytes=byte_count(covers), levels=levels)
    present = tuple(level for level in range(_top_level(cell) + 1) if (seen["levels"] or 1) >> level & 1)
    if not with_near:
        return RegionIndex(cell, cells, inside, seen["bytes"], present)
    tile = ["level", "tx", "cy"]
    whole, whole_bytes = materialize_measured(_at(inside.filter("whole").select(*tile).distinct(), *tile), "whole")
    covered = sized_join(_at_levels(cells, present), whole, _on(*tile), "left_semi", size=whole_bytes).select(*CELL_KEY).distinct()
    open_cells = sized_join(cells, _at(covered, *CELL_KEY), _on(*CELL_KEY), "left_anti", size=cells_bytes)
    open_cells = materialize(open_cells, "open_cells")
    return RegionIndex(cell, cells, inside, seen["bytes"], present, *_near(open_cells, regions, cell))


# ---- operators on points ----------------------------------------------------------------------


def as_points(rows: DataFrame, key: str, x: Column, y: Column, cell: float) -> DataFrame:
    """Key, coordinates and grid cell, which is what the operators below take as points."""
    return rows.select(F.col(key), x.alias("x"), y.alias("y")).withColumns(
        cell_columns(F.col("x"), F.col("y"), cell) | {"shrunk": shrink(F.col("y"))}
    )


def containing(points: DataFrame, index: RegionIndex, key: str, multi: str = "all", **join) -> DataFrame:
    """(key, derived_zip, derived_borough) for every region that contains the point."""
    tile = ["level", "tx", "cy"]
    placed = _at_levels(points, index.levels)
    paired = sized_join(placed, _at(index.inside, *tile), _on(*tile), "inner", size=index.inside_bytes, **join)
    hit = paired.filter(F.col("whole") | contains(F.col("edges"), F.col("x"), F.col("y")))
    hit = hit.select(key, "derived_zip", "derived_borough")
    return hit if multi == "all" else _first_per(hit, key, "derived_zip", "derived_borough")


def without_match(points: DataFrame, matches: DataFrame, key: str, **join) -> DataFrame:
    """Points whose key has no match; the keys that have one are written, so what finds them runs once."""
    found, size = materialize_measured(matches.select(F.col(key).alias("_found")).distinct(), "matched")
    return sized_join(points, found, [(F.col(key), F.col("_found"))], "left_anti", size=size, **join)


def nearest(points: DataFrame, index: RegionIndex, key: str, **join) -> DataFrame:
    """(key, derived_zip, derived_borough) of the nearest region; ties go to the lower code, then borough."""
    units = _at(index.units, *CELL_KEY)
    placed = sized_join(points, units, _on(*CELL_KEY), "inner", size=index.units_bytes, **join)
    paired = sized_join(placed, _at(index.near, *NEAR_KEY), _on(*NEAR_KEY), "inner", size=index.near_bytes, **join)
    far = distance(F.col("segments"), F.col("x"), F.col("y"), F.col("shrunk"))
    ranked = paired.select(key, "derived_zip", "derived_borough", far.alias("_far"))
    return _first_per(ranked, key, "_far", "derived_zip", "derived_borough").drop("_far")


def _first_per(df: DataFrame, key: str, *order: str) -> DataFrame:
    ranking = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn("_rn", F.row_number().over(ranking)).filter("_rn = 1").drop("_rn")


def region_of(points: DataFrame, index: RegionIndex, key: str, multi: str = "all", **join) -> DataFrame:
    """Containing regions, or the nearest one where there is none: (key, derived_zip, derived_borough).

    The containing regions are written out, as both parts of the union read them.
    """
    exact = materialize(containing(points, index, key, multi, **join), "exact")
    return exact.unionByName(nearest(without_match(points, exact, key, **join), index, key, **join))


def _by_cell(index: RegionIndex) -> DataFrame:
    """Per occupied cell the regions that cover or may contain it, and its unit: one row to look at for a point."""
    entry = F.struct("derived_zip", "derived_borough", "whole", "edges")
    tile = ["level", "tx", "cy"]
    placed = sized_join(_at_levels(index.cells, index.levels), _at(index.inside, *tile), _on(*tile), "inner", size=index.inside_bytes)
    listed = placed.groupBy(*CELL_KEY).agg(F.collect_list(entry).alias("_inside")).hint("merge")
    known = index.cells.join(listed, CELL_KEY, "left").join(index.units.hint("merge"), CELL_KEY, "left")
    return known.filter("_inside is not null or size is not null")


def _with_region_in_row(rows: DataFrame, by_cell: DataFrame, index: RegionIndex, multi: str) -> DataFrame:
    """Both stages as map-side work: no shuffle of the rows, no join back by key."""
    cells = by_cell.withColumnsRenamed({c: f"_at_{c}" for c in CELL_KEY} | {c: f"_{c}" for c in NEAR_KEY})
    rows = rows.join(F.broadcast(cells), (F.col("_cx") == F.col("_at_cx")) & (F.col("_cy") == F.col("_at_cy")), "left")
    edges = index.near.groupBy(*NEAR_KEY).agg(F.collect_list(F.struct("derived_zip", "derived_borough", "segments")).alias("_near"))
    unit = reduce(Column.__and__, [F.col(f"_{c}") == F.col(f"_at_{c}") for c in NEAR_KEY])
    rows = rows.join(F.broadcast(_at(edges, *NEAR_KEY)), unit, "left")

    x, y = F.col("_x"), F.col("_y")

    def label(r: Column) -> Column:
        return F.struct(r.derived_zip.alias("derived_zip"), r.derived_borough.alias("derived_borough"))

    def ranked(r: Column) -> Column:
        return F.struct(distance(r.segments, x, y, F.col("_shrunk")).alias("far"), r.derived_zip, r.derived_borough)

    candidates = F.coalesce(F.col("_inside"), F.array())
    exact = F.transform(F.filter(candidates, lambda r: r.whole | contains(r.edges, x, y)), label)
    if multi != "all":
        exact = F.slice(F.array_sort(exact), 1, 1)
    closest = F.transform(F.array(F.array_min(F.transform("_near", ranked))), label)
    rows = rows.withColumn("_exact", exact)
    rows = rows.withColumn("_match", F.when(F.size("_exact") > 0, F.col("_exact")).otherwise(closest))
    rows = rows.withColumn("_match", F.explode_outer("_match"))
    return rows.withColumns({"derived_zip": F.col("_match.derived_zip"), "derived_borough": F.col("_match.derived_borough")})


def with_region(
    rows: DataFrame,
    index: RegionIndex,
    key: str,
    x: Column,
    y: Column,
    need: Column,
    multi: str = "all",
    budget: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Append ``derived_zip`` and ``derived_borough`` to the rows that ``need`` them.

    A row inside several regions appears once per region (``multi="first"`` keeps the
    lowest code). While both candidate tables fit ``budget`` they are broadcast and the
    rows never move. Beyond it the rows are written once, their distinct points are matched by
    split shuffles, and the matches are joined back by coordinates. What a row gets depends
    on its own point alone either way; rows with a NULL ``key`` get nothing.
    """
    columns = [*rows.columns, "derived_zip", "derived_borough"]
    wanted = need & F.col(key).isNotNull()
    placed = rows.withColumns({"_x": F.when(wanted, x), "_y": F.when(wanted, y)})
    by_cell, size = None, index.inside_bytes + index.near_bytes + index.units_bytes
    if size <= budget:
        # What covers many cells is listed with each of them here, so the size is taken again.
        by_cell, size = materialize_measured(_by_cell(index), "by_cell")
    if by_cell is not None and size + index.near_bytes <= budget:
        cells = cell_columns(F.col("_x"), F.col("_y"), index.cell)
        placed = placed.withColumns({f"_{n}": c for n, c in cells.items()} | {"_shrunk": shrink(F.col("_y"))})
        return _with_region_in_row(placed, by_cell, index, multi).select(*columns)
    placed = materialize(placed, "placed_rows")
    spots = placed.filter("_x is not null and _y is not null").select("_x", "_y").distinct()
    spots = spots.withColumn("_spot", F.struct("_x", "_y"))
    points = materialize(as_points(spots, "_spot", F.col("_x"), F.col("_y"), index.cell), "points")
    sizes = {"budget": budget, "rows_per_task": rows_per_task}
    matches = materialize(region_of(points, index, "_spot", multi, spread=["_spot"], **sizes), "matches")
    matches = matches.select(F.col("_spot._x").alias("_at_x"), F.col("_spot._y").alias("_at_y"), "derived_zip", "derived_borough")
    back = [(F.col("_x"), F.col("_at_x")), (F.col("_y"), F.col("_at_y"))]
    return sized_join(placed, matches, back, "left", **sizes).select(*columns)


def fill_regions(rows: DataFrame, zip_code: str = "zip_code", borough: str = "borough") -> DataFrame:
    """Fill each missing field from the derived one; both fields move to the end."""
    filled = {
        zip_code: fill_zip(F.col(zip_code), F.col("derived_zip")),
        borough: fill_borough(F.col(borough), F.col("derived_borough")),
    }
    return replace_columns(rows, [zip_code, borough, "derived_zip", "derived_borough"], filled)


def enrich_regions(
    rows: DataFrame,
    seed: DataFrame,
    key: str,
    longitude: str = "longitude",
    latitude: str = "latitude",
    zip_code: str = "zip_code",
    borough: str = "borough",
    places: DataFrame | None = None,
    multi: str = "all",
    cell: float = CELL,
    strict: bool = True,
    budget: int = BROADCAST_BYTES,
) -> DataFrame:
    """Derive and fill missing region fields of ``rows`` from polygons.

    ``places`` may name a cheaper frame with the same four columns whose points include
    all those of ``rows`` (say, before deduplication); the grid cells are taken from it.
    """
    gate = needs_region(F.col(zip_code), F.col(borough), F.col(longitude), F.col(latitude))
    x, y = point(F.when(gate, F.col(longitude)), F.when(gate, F.col(latitude)), strict)
    # Rows of ``places`` that are not among ``rows`` may hold anything; those of ``rows`` are judged when they are matched.
    cells = occupied_cells(rows, x, y, cell) if places is None else occupied_cells(places, *point(
        F.when(gate, F.col(longitude)), F.when(gate, F.col(latitude)), strict=False), cell)
    index = index_regions(cells, parse_regions(seed, strict=strict), cell)
    return fill_regions(with_region(rows, index, key, x, y, gate, multi, budget), zip_code, borough)
