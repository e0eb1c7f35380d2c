"""Planar geometry on edge lists, as column expressions.

A polygon is the list of its edges over all rings. Longitude is x, latitude is y.
Edges are straight in the longitude/latitude plane: against edges that follow the
globe, an edge of 1 km is about 2 cm off and one of 10 km about 2 m at 41 degrees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Brackets and what stands between them, all of it kept.
_CUTS = r"(?<=[()])|(?=[()])"

# What remains of a valid text once the vertices of every ring are written as p; possessive, so many rings need no stack.
_PARTS = r"\(\(p\)(?:,\(p\))*+\)"
_SHAPE = rf"^(?:POLYGON{_PARTS}|MULTIPOLYGON\({_PARTS}(?:,{_PARTS})*+\)|(?:MULTI)?POLYGONEMPTY)$"


def _is_ring(token: Column) -> Column:
    return token.rlike("[0-9]")


def _rings(tokens: Column) -> Column:
    """Every ring as its vertices: x, y, and whether the text was two plain numbers."""

    def vertex(parts: Column) -> Column:
        x, y = (F.get(parts, F.lit(i)).try_cast("double") for i in (0, 1))
        return F.struct(x.alias("x"), y.alias("y"), (F.size(parts) == 2).alias("ok"))

    def ring(token: Column) -> Column:
        # A cast would also take NaN, Infinity and the type letters of literals.
        plain = ~token.rlike("[A-DF-Za-df-z]")
        # The inner lambda splits each vertex once; its parts are then a variable.
        words = F.transform(F.split(token, ","), lambda v: F.split(F.btrim(v, F.lit(" \t\r\n")), r"\s+"))
        return F.struct(plain.alias("plain"), F.transform(words, vertex).alias("v"))

    return F.transform(F.filter(tokens, _is_ring), ring)


def _shape(tokens: Column) -> Column:
    return F.array_join(F.transform(tokens, lambda t: F.when(_is_ring(t), "p").otherwise(F.upper(F.regexp_replace(t, r"\s+", "")))), "")


def _problem(shape: Column, rings: Column) -> Column:
    def is_read(ring: Column) -> Column:
        return ring.plain & F.forall(ring.v, lambda v: v.ok & v.x.isNotNull() & v.y.isNotNull())

    def is_closed(ring: Column) -> Column:
        first, last = F.element_at(ring.v, 1), F.element_at(ring.v, -1)
        return (F.size(ring.v) >= 4) & (first.x == last.x) & (first.y == last.y)

    readable = shape.rlike(_SHAPE) & F.forall(rings, is_read)
    return (
        F.when(shape.isNull(), F.lit(None).cast("string"))
        .when(~F.coalesce(readable, F.lit(False)), "not the text of a polygon")
        .when(~F.forall(rings, is_closed), "a ring that is not closed")
    )


def _edges(rings: Column) -> Column:
    def ring_edges(ring: Column) -> Column:
        steps = F.greatest(F.size(ring.v) - 1, F.lit(0))
        return F.zip_with(
            F.slice(ring.v, F.lit(1), steps),
            F.slice(ring.v, F.lit(2), steps),
            lambda a, b: F.struct(a.x.alias("x1"), a.y.alias("y1"), b.x.alias("x2"), b.y.alias("y2")),
        )

    return F.flatten(F.transform(rings, ring_edges))


def with_polygon(df: DataFrame, wkt: str) -> DataFrame:
    """Add ``edges`` and ``problem`` of a text column, cutting every text once.

    In steps, each of which is used more than once by the next: the optimizer then keeps them apart, and
    nothing is worked out twice. A filter on the outcome would undo that unless the frame is written first.
    """
    cut = df.withColumn("_tokens", F.split(F.col(wkt), _CUTS))
    read = cut.withColumns({"_rings": _rings(F.col("_tokens")), "_shape": _shape(F.col("_tokens"))})
    told = read.withColumns({"edges": _edges(F.col("_rings")), "problem": _problem(F.col("_shape"), F.col("_rings"))})
    return told.drop("_tokens", "_rings", "_shape")


def wkt_problem(wkt: Column) -> Column:
    """Why a text is not a closed POLYGON or MULTIPOLYGON; NULL if it is one, is EMPTY or is NULL."""
    tokens = F.split(wkt, _CUTS)
    return _problem(_shape(tokens), _rings(tokens))


def wkt_edges(wkt: Column) -> Column:
    """Edges of a POLYGON or MULTIPOLYGON text: every ring, holes included."""
    return _edges(_rings(F.split(wkt, _CUTS)))


def bounds(edges: Column) -> dict[str, Column]:
    """Bounding box; closed rings start an edge at every vertex."""
    return {
        "xmin": F.array_min(F.transform(edges, lambda e: e.x1)),
        "xmax": F.array_max(F.transform(edges, lambda e: e.x1)),
        "ymin": F.array_min(F.transform(edges, lambda e: e.y1)),
        "ymax": F.array_max(F.transform(edges, lambda e: e.y1)),
    }


def _turn(e: Column, x: Column, y: Column) -> Column:
    """Positive when the point lies left of the edge, zero on its line."""
    return (e.x2 - e.x1) * (y - e.y1) - (x - e.x1) * (e.y2 - e.y1)


# What an edge through the point adds to the count of crossings; no polygon has as many edges.
_ON_EDGE = 1 << 40
_ODD_AND_ON_NO_EDGE = -_ON_EDGE | 1


def _crossing(e: Column, x: Column, y: Column) -> Column:
    """1 if the ray from the point towards larger x crosses the edge, more if the point is on it.

    Most edges lie above or below and are dismissed by comparisons alone. There is no
    division, so level edges are safe; a corner counts with the edge above it.
    """
    beside = ((e.y1 > y) & (e.y2 > y)) | ((e.y1 < y) & (e.y2 < y))
    across = x.between(F.least(e.x1, e.x2), F.greatest(e.x1, e.x2))
    rising = (e.y1 <= y) & (y < e.y2)
    falling = (e.y2 <= y) & (y < e.y1)
    turn = _turn(e, x, y)
    return (
        F.when(beside, 0)
        .when(across & (turn == 0), _ON_EDGE)
        .when((rising & (turn > 0)) | (falling & (turn < 0)), 1)
        .otherwise(0)
    )


def contains(edges: Column, x: Column, y: Column) -> Column:
    """Even-odd containment over all rings; a point on an edge is not contained."""
    crossings = F.aggregate(edges, F.lit(0).cast("bigint"), lambda n, e: n + _crossing(e, x, y))
    return crossings.bitwiseAND(F.lit(_ODD_AND_ON_NO_EDGE)) == 1


def shrink(y: Column) -> Column:
    """How much shorter a degree of longitude is than one of latitude."""
    return F.cos(F.radians(y))


def segments(edges: Column) -> Column:
    """Edges as start and direction, the form in which distances take the least work."""
    return F.transform(
        edges,
        lambda e: F.struct(
            e.x1.alias("x1"), e.y1.alias("y1"), (e.x2 - e.x1).alias("dx"), (e.y2 - e.y1).alias("dy")
        ),
    )


def distance(segs: Column, x: Column, y: Column, shrunk: Column) -> Column:
    """Distance from the point to the nearest segment, in degrees of latitude.

    Longitude is scaled by ``shrunk``, the cosine of the point's latitude. Only good for
    ranking what is near one point. Rounded, so that the two sides of a shared edge tie.
    Lambdas work out every mention of a part anew, hence the two passes.
    """
    never_zero = F.lit(1e-300)

    def along(s: Column) -> Column:
        """How far along the segment the closest point lies, from 0 to 1."""
        toward = (x - s.x1) * shrunk * shrunk * s.dx + (y - s.y1) * s.dy
        length = s.dx * s.dx * shrunk * shrunk + s.dy * s.dy + never_zero
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), toward / length))

    def away(s: Column, t: Column) -> Column:
        return F.hypot((s.x1 + t * s.dx - x) * shrunk, s.y1 + t * s.dy - y)

    nearest = F.array_min(F.zip_with(segs, F.transform(segs, along), away))
    return F.floor(nearest * 1e9 + 0.5) / 1e9
