"""Vectors, matrices and boxes as arrays of doubles; all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def normalized(a: Column) -> Column:
    """a over its norm; zeros stay zeros."""
    n = norm(a)
    return F.transform(a, lambda x: F.when(n == 0, F.lit(0.0)).otherwise(F.try_divide(x.cast("double"), n)))


def projected(a: Column, onto: Column) -> Column:
    """The part of a along ``onto``."""
    scale = F.try_divide(dot(a, onto), dot(onto, onto))
    return F.transform(onto, lambda x: x * scale)


def cross(a: Column, b: Column) -> Column:
    at = lambda v, k: F.get(v, F.lit(k))
    return F.array(*[at(a, (k + 1) % 3) * at(b, (k + 2) % 3) - at(a, (k + 2) % 3) * at(b, (k + 1) % 3) for k in range(3)])


def homogenized(a: Column) -> Column:
    return F.concat(a, F.array(F.lit(1.0)))


def dehomogenized(a: Column) -> Column:
    w = F.element_at(a, -1)
    return F.transform(F.slice(a, 1, F.size(a) - 1), lambda x: x / w)


def applied(matrix: Column, v: Column) -> Column:
    """Matrix (rows of arrays) times vector."""
    return F.transform(matrix, lambda row: dot(row, v))


def rigid(matrix: Column, point: Column) -> Column:
    """A 4 x 4 transform of a 3-D point."""
    return dehomogenized(applied(matrix, homogenized(point)))


def turned(v: Column, axis: Column, angle: Column) -> Column:
    """Rodrigues' rotation about a unit axis."""
    along, side = dot(axis, v) * (1 - F.cos(angle)), cross(axis, v)
    parts = F.arrays_zip(v.alias("v"), side.alias("s"), axis.alias("a"))
    return F.transform(parts, lambda p: p["v"] * F.cos(angle) + p["s"] * F.sin(angle) + p["a"] * along)


# boxes: STRUCT<mins ARRAY<DOUBLE>, maxs ARRAY<DOUBLE>> ---------------------------------------------


def box(mins: Column, maxs: Column) -> Column:
    return F.struct(mins.alias("mins"), maxs.alias("maxs"))


def box_union(a: Column, b: Column) -> Column:
    return box(F.zip_with(a["mins"], b["mins"], lambda x, y: F.least(x, y)), F.zip_with(a["maxs"], b["maxs"], lambda x, y: F.greatest(x, y)))


def box_intersection(a: Column, b: Column) -> Column:
    return box(F.zip_with(a["mins"], b["mins"], lambda x, y: F.greatest(x, y)), F.zip_with(a["maxs"], b["maxs"], lambda x, y: F.least(x, y)))


def box_empty(a: Column) -> Column:
    return F.exists(F.zip_with(a["mins"], a["maxs"], lambda x, y: x >= y), lambda x: x)


def box_contains(a: Column, point: Column) -> Column:
    inside = F.zip_with(F.zip_with(a["mins"], point, lambda x, p: x <= p), F.zip_with(point, a["maxs"], lambda p, y: p <= y), lambda x, y: x & y)
    return F.forall(inside, lambda x: x)


def box_dims(a: Column) -> Column:
    return F.zip_with(a["maxs"], a["mins"], lambda x, y: x - y)


def box_center(a: Column) -> Column:
    return F.zip_with(a["maxs"], a["mins"], lambda x, y: (x + y) / 2)


def box_measure(a: Column) -> Column:
    return F.aggregate(box_dims(a), F.lit(1.0), lambda s, x: s * F.greatest(x, F.lit(0.0)))


def box_grown(a: Column, by: Column) -> Column:
    """Inflated by ``by`` on all sides; eroded if it is negative."""
    return box(F.transform(a["mins"], lambda x: x - by), F.transform(a["maxs"], lambda x: x + by))


def box_corners(a: Column) -> Column:
    """All corners, in binary order."""
    at = lambda side, k: F.get(a[side], F.lit(k))
    return F.array(*[F.array(*[at("maxs" if n >> k & 1 else "mins", k) for k in range(3)]) for n in range(8)])


def to_local(a: Column, point: Column) -> Column:
    """Coordinates in [0, 1] inside the box."""
    parts = F.arrays_zip(point.alias("p"), a["mins"].alias("low"), a["maxs"].alias("high"))
    return F.transform(parts, lambda x: F.try_divide(x["p"] - x["low"], x["high"] - x["low"]))


def to_global(a: Column, local: Column) -> Column:
    parts = F.arrays_zip(local.alias("p"), a["mins"].alias("low"), a["maxs"].alias("high"))
    return F.transform(parts, lambda x: x["low"] + x["p"] * (x["high"] - x["low"]))


# polygons: ARRAY<STRUCT<x, y>>, closed implicitly ---------------------------------------------------


def _edges(p: Column) -> Column:
    after = F.concat(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), F.slice(p, 1, 1))
    return F.arrays_zip(p.alias("a"), after.alias("b"))


def polygon_area(p: Column) -> Column:
    """By the shoelace rule."""
    return F.abs(_sum(F.transform(_edges(p), lambda e: e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]))) / 2


def polygon_length(p: Column) -> Column:
    step = lambda e: F.sqrt(F.pow(e["a"]["x"] - e["b"]["x"], 2) + F.pow(e["a"]["y"] - e["b"]["y"], 2))
    return _sum(F.transform(_edges(p), step))


def polygon_aspect(p: Column) -> Column:
    """Longer over shorter side of the bounding box."""
    side = lambda c: F.array_max(F.transform(p, lambda v: v[c])) - F.array_min(F.transform(p, lambda v: v[c]))
    return F.greatest(side("x"), side("y")) / F.least(side("x"), side("y"))
