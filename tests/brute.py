"""Plain Python geometry to check against."""

from __future__ import annotations

import math
import re


def edges_of(wkt):
    edges = []
    for ring in re.findall(r"\(([^()]+)\)", wkt):
        vertices = [tuple(map(float, v.split())) for v in ring.split(",")]
        edges += [(*a, *b) for a, b in zip(vertices, vertices[1:])]
    return edges


def _turn(e, x, y):
    x1, y1, x2, y2 = e
    return (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)


def contains(edges, x, y):
    crossings = 0
    for e in edges:
        x1, y1, x2, y2 = e
        t = _turn(e, x, y)
        if t == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
            return False
        if (y1 > y) != (y2 > y) and ((t > 0) if y2 > y1 else (t < 0)):
            crossings += 1
    return crossings % 2 == 1


def distance(edges, x, y):
    k = math.cos(math.radians(y))
    best = math.inf
    for x1, y1, x2, y2 in edges:
        ax, ay, dx, dy = (x1 - x) * k, y1 - y, (x2 - x1) * k, y2 - y1
        length = dx * dx + dy * dy
        t = 0.0 if length == 0 else max(0.0, min(1.0, -(ax * dx + ay * dy) / length))
        best = min(best, math.sqrt((ax + t * dx) ** 2 + (ay + t * dy) ** 2))
    return round(best, 9)


def regions_of(seed, x, y):
    """All containing regions, else the nearest: a list of (zip, borough)."""
    parsed = [(z, b, edges_of(w)) for z, b, w in seed]
    inside = sorted((z, b) for z, b, e in parsed if contains(e, x, y))
    if inside or not parsed:
        return inside
    return [min((distance(e, x, y), z, b) for z, b, e in parsed if e)[1:]]
