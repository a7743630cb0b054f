"""Measures of shapes as terms of the language, registered with the compiler.

Entities carry what a measure asks for: ``corners`` (a polygon, array of (x, y)) for rooms; ``centre`` and ``axis`` (two
numbers) for what faces something; ``box`` (a turned box) and ``front`` for what needs free space. All are DataFrame plans
over the members of the sets, grouped by the loop variables that they depend on; shapes meet once, by cells, whatever number of
loops they stand in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.functions.vectors import dot, normalized, polygon_area, polygon_aspect, polygon_length
from tagweave.operators import plane, solids
from tagweave.operators.aggregates import grid_line_count
from tagweave.plans import lang as L
from tagweave.plans.compile import Compiler, register

#: Lengths of cells in which shapes meet, and what counts as on one line.
CELL, TOLERANCE = 10.0, 1e-6
MEASURES: dict[str, Callable[[Compiler, L.Measure], tuple[DataFrame, Column]]] = {}


def measure(name: str):
    """Register the decorated function as what a measure of this name is."""

    def put(f):
        MEASURES[name] = f
        return f

    return put


@register(L.Measure)
def _measured(c: Compiler, e: L.Measure) -> tuple[DataFrame, Column]:
    if e.what not in MEASURES:
        raise TypeError(f"no measure {e.what}; there are {sorted(MEASURES)}")
    return MEASURES[e.what](c, e)


def hull_area(p: Column) -> Column:
    """Area of a polygon's convex hull, by Andrew's two chains: a fold over the corners in order."""
    corner = lambda v: F.struct(v["x"].cast("double").alias("x"), v["y"].cast("double").alias("y"))
    turn = lambda a, b, q: (b["x"] - a["x"]) * (q["y"] - a["y"]) - (b["y"] - a["y"]) * (q["x"] - a["x"])

    def chain(points: Column) -> Column:
        # the last of the chain so far from which the way to the next corner turns left: all after it are inside
        def step(held: Column, q: Column) -> Column:
            keeps = F.transform(held, lambda b, k: F.when(turn(F.get(held, k - 1), b, q) > 0, k + 1).otherwise(1))
            return F.concat(F.slice(held, 1, F.coalesce(F.array_max(keeps), F.lit(0))), F.array(q))

        return F.aggregate(points, F.filter(points, lambda x: F.lit(False)), step)

    ordered = F.array_sort(F.array_distinct(F.transform(p, corner)))
    hull = lambda q: F.concat(chain(q), plane.let(chain(F.reverse(q)), lambda back: F.slice(back, 2, F.greatest(F.size(back) - 2, F.lit(0)))))
    # in a let of its own: the area asks for the hull several times, and would fold the chains anew for each
    return plane.let(ordered, lambda q: plane.let(hull(q), polygon_area))


def _own(value: Callable[[Column], Column], fold: Callable[[Column], Column], empty) -> Callable:
    """A measure of each member's polygon, folded over the set.

    Members are dealt out before: a small file makes few tasks, and its rows take far longer to measure than to read.
    """

    def of(c: Compiler, e: L.Measure) -> tuple[DataFrame, Column]:
        by = sorted(e.free())
        rows = c.members(e.objs).select(*by, "name", "corners").repartition(*by, "name")
        return rows.groupBy(*by).agg(fold(value(F.col("corners"))).alias("value")), F.lit(empty)

    return of


def _of_first(value: Callable[[Column], Column]) -> Callable:
    """A measure of the set's first member by name: sets of one, as a loop's entity, are what it is for."""
    return _own(value, lambda v: F.min_by(v, F.col("name")), 0.0)


MEASURES["area"] = _own(polygon_area, F.sum, 0.0)
MEASURES["outline_length"] = _own(polygon_length, F.sum, 0.0)
#: Corners of the closed outline: the first counts at its end too.
MEASURES["n_verts"] = _own(lambda p: (F.size(p) + 1).cast("long"), F.sum, 0)
MEASURES["aspect_ratio"] = _of_first(polygon_aspect)
MEASURES["convexity"] = _of_first(lambda p: hull_area(p) / polygon_area(p))


@measure("grid_line_count")
def _grid_lines(c: Compiler, e: L.Measure) -> tuple[DataFrame, Column]:
    """Lines of a grid that corners of the set's outlines are at; option: the axis and the unit, as ``x:0.5``."""
    axis, unit = str(e.option).split(":")
    by = sorted(e.free())
    rows = c.members(e.objs).select(*by, F.explode("corners").alias("corner"))
    return grid_line_count(rows, by, F.col(f"corner.{axis}"), float(unit)).withColumnRenamed("lines", "value"), F.lit(0)


def _paired(c: Compiler, e: L.Measure, pairs: Callable[[DataFrame, DataFrame], DataFrame], attributes: list[str], fold: Callable[[Column], Column], empty) -> tuple[DataFrame, Column]:
    """A measure of pairs of the two sets: ``pairs`` gives (a, b, value) for the entities of either, each once; pairs stand in the same loops."""
    a, b = (c.members(s).select(*sorted(s.free()), "name", *attributes) for s in (e.objs, e.others))
    found = pairs(*[t.select("name", *attributes).dropDuplicates(["name"]) for t in (a, b)])
    shared = sorted(e.objs.free() & e.others.free())
    left = found.join(a.select(*sorted(e.objs.free()), F.col("name").alias("a")), "a")
    met = left.join(b.select(*sorted(e.others.free()), F.col("name").alias("b")), ["b", *shared])
    return met.groupBy(*sorted(e.free())).agg(fold(F.col("value")).alias("value")), F.lit(empty)


@measure("intersection")
def _intersection(c: Compiler, e: L.Measure) -> tuple[DataFrame, Column]:
    """Area that the members of one set share with those of the other, added up over all pairs."""

    def pairs(a: DataFrame, b: DataFrame) -> DataFrame:
        named = lambda t: t.select(F.col("name").alias("key"), "corners")
        return plane.overlays(named(a), named(b), CELL).select("a", "b", F.col("intersection").alias("value"))

    return _paired(c, e, pairs, ["corners"], F.sum, 0.0)


def _walls(a: DataFrame, b: DataFrame) -> DataFrame:
    """Stretches (a, b, ...) of walls that entities of two tables share, both ways round."""
    rooms = a.union(b).dropDuplicates(["name"]).select(F.col("name").alias("room"), "corners")
    found = plane.shared_stretches(plane.wall_lines(rooms), TOLERANCE, CELL)
    return found.union(found.select(F.col("b").alias("a"), F.col("a").alias("b"), "x0", "y0", "x1", "y1"))


@measure("shared_length")
def _shared_length(c: Compiler, e: L.Measure) -> tuple[DataFrame, Column]:
    """Length of the walls that the members of one set share with those of the other."""
    long = F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    return _paired(c, e, lambda a, b: _walls(a, b).select("a", "b", long.alias("value")), ["corners"], F.sum, 0.0)


@measure("shared_n_verts")
def _shared_corners(c: Compiler, e: L.Measure) -> tuple[DataFrame, Column]:
    """Corners of the lines that the sets' members share: pieces that follow one another are one bent line, whose inner corners count once."""

    def pairs(a: DataFrame, b: DataFrame) -> DataFrame:
        place = lambda x, y: F.struct(F.round(x, 5).alias("x"), F.round(y, 5).alias("y"))
        ends = _walls(a, b).select("a", "b", F.explode(F.array(place("x0", "y0"), place("x1", "y1"))).alias("end"))
        return ends.groupBy("a", "b").agg(F.count_distinct("end").alias("value"))

    return _paired(c, e, pairs, ["corners"], F.sum, 0)


@measure("focus_score")
def _focus(c: Compiler, e: L.Measure) -> tuple[DataFrame, Column]:
    """Over the set's members, half of 1 - cos of the angle between the axis and the way to the first other (by name), added up."""
    a = c.members(e.objs).select(*sorted(e.objs.free()), "name", "axis", "centre")
    by = sorted(e.others.free())
    b = c.members(e.others).groupBy(*by).agg(F.min_by("centre", "name").alias("there"))
    shared = sorted(e.objs.free() & e.others.free())
    met = a.join(b, shared) if shared else a.crossJoin(b)  # one row for each combination of the others' loops
    way = F.zip_with("there", "centre", lambda x, y: x - y)
    score = 0.5 - 0.5 * dot(normalized(F.col("axis")), normalized(way))
    return met.groupBy(*sorted(e.free())).agg(F.sum(score).alias("value")), F.lit(0.0)


@measure("angle_alignment")
def _alignment(c: Compiler, e: L.Measure) -> tuple[DataFrame, Column]:
    """Over the set's members, how far the axis is from the normals of the nearest edge of all others' outlines, added up.

    The others stand in no loop: their edges are searched once for all members.
    """
    if e.others.free():
        raise ValueError("angle_alignment looks for edges of a set that is the same in all loops")
    edges = plane.wall_lines(c.members(e.others).select(F.col("name").alias("room"), "corners"))
    edges = edges.withColumn("line", F.struct("room", "x0", "y0", "x1", "y1")).drop("room")
    own = c.members(e.objs).select(*sorted(e.free()), "name", "axis", "centre")
    standing = own.dropDuplicates(["name"]).select("name", F.get("centre", F.lit(0)).alias("x"), F.get("centre", F.lit(1)).alias("y"), "axis")
    scores = plane.edge_alignment(standing, edges)
    return own.join(scores, "name").groupBy(*sorted(e.free())).agg(F.sum("score").alias("value")), F.lit(0.0)


@measure("accessibility")
def _access(c: Compiler, e: L.Measure) -> tuple[DataFrame, Column]:
    """The greatest depth to which an other stands in the free space (option: its reach) before a member; 0 if all are free."""

    a, b = (c.members(s).select(*sorted(s.free()), "name", "box", *more) for s, more in ((e.objs, ["front"]), (e.others, [])))
    once = [t.select("name", "box", *more).dropDuplicates(["name"]) for t, more in ((a, ["front"]), (b, []))]
    found = solids.access_depths(*once, float(e.option), CELL).withColumnRenamed("depth", "value")
    left = found.join(a.select(*sorted(e.objs.free()), F.col("name").alias("a")), "a")
    met = left.join(b.select(*sorted(e.others.free()), F.col("name").alias("b")), ["b", *sorted(e.objs.free() & e.others.free())])
    return met.groupBy(*sorted(e.free())).agg(F.greatest(F.max("value"), F.lit(0.0)).alias("value")), F.lit(0.0)
