"""Boxes, turned boxes and meshes in space: least distances without all pairs, depths of turned boxes, what cameras see."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tagweave.functions.vectors import cross, dot
from tagweave.operators.plane import let

#: Cells on each axis of the grids that pairs are pruned by, coarse to fine; a fine cell lies in one coarse cell.
GRIDS = (8, 64)
AXES = range(3)
CELL = ("cell_x", "cell_y", "cell_z")


def at(a: Column, k: int) -> Column:
    return F.get(a, F.lit(k))


def box_gap(a_lows: Column, a_highs: Column, b_lows: Column, b_highs: Column) -> Column:
    """Euclidean distance between boxes; 0 where they touch or meet."""
    gaps = F.zip_with(F.zip_with(a_lows, b_highs, lambda x, y: x - y), F.zip_with(b_lows, a_highs, lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    return F.sqrt(dot(gaps, gaps))


def least_gaps(a: DataFrame, b: DataFrame, gap: Callable[[Column, Column], Column], bound: Callable[[Column, Column], Column]) -> DataFrame:
    """The least gap between what stands in ``a`` and what stands in ``b``, for each combination of their keys.

    Both sides have name, lows, highs (of three numbers) and ``shape``, and any other columns as keys; keys of both sides
    are equal in a pair, and nothing is compared with what has its own name. Returns the keys and ``value``; no row where there is no pair.

    Args:
        gap: the gap between two shapes; it is measured for few pairs.
        bound: a number that the gap doesn't exceed, and that is cheap.

    Everything is in one cell of a coarse grid and one of a fine grid, by its low corner. Of two cells the gap of their
    contents' boxes is a lower bound, and ``bound`` between members of theirs an upper one. Pairs of coarse cells, of which
    there are at most so many as the grid has, whatever the input, go if their lower bound is over the least upper
    one of their keys; then pairs of fine cells in these; what is left is measured.
    """
    fixed = ("name", "lows", "highs", "shape")
    own = {"a": [c for c in a.columns if c not in fixed], "b": [c for c in b.columns if c not in fixed]}
    shared, keys = [c for c in own["a"] if c in own["b"]], sorted({*own["a"], *own["b"]})
    corner = lambda f, c: [f(at(F.col(c), k)).alias(f"{c}{k}") for k in AXES]
    ends = a.select("lows", "highs").union(b.select("lows", "highs")).agg(*corner(F.min, "lows"), *corner(F.max, "highs"))  # one row

    def placed(rows: DataFrame, s: str) -> DataFrame:
        rows = rows.crossJoin(F.broadcast(ends))
        share = lambda k: (at(F.col("lows"), k) - F.col(f"lows{k}")) / F.nullif(F.col(f"highs{k}") - F.col(f"lows{k}"), F.lit(0.0))
        cell = lambda n: F.array(*[F.coalesce(F.least(F.floor(share(k) * n), F.lit(n - 1)), F.lit(0)).cast("int") for k in AXES])
        rows = rows.withColumn(f"{s}_{len(GRIDS) - 1}", cell(GRIDS[-1]))
        coarser = lambda n: F.transform(F.col(f"{s}_{len(GRIDS) - 1}"), lambda x: F.floor(x / (GRIDS[-1] // GRIDS[n])).cast("int"))
        rows = rows.withColumns({f"{s}_{n}": coarser(n) for n in range(len(GRIDS) - 1)})
        return rows.select(*own[s], *[f"{s}_{n}" for n in range(len(GRIDS))], *[F.col(c).alias(f"{s}_{c}") for c in fixed])

    sides = {"a": placed(a, "a"), "b": placed(b, "b")}

    def cells(s: str, level: int) -> DataFrame:
        """The cells of a level: the box of their contents, and two of these."""
        rows = sides[s].groupBy(*own[s], *[f"{s}_{n}" for n in range(level + 1)])
        one = F.struct(F.col(f"{s}_name").alias("name"), F.col(f"{s}_shape").alias("shape"))
        by = F.col(f"{s}_name")
        low, high = (F.array(*[f(at(F.col(f"{s}_{c}"), k)) for k in AXES]).alias(f"{s}_{c}") for f, c in ((F.min, "lows"), (F.max, "highs")))
        return rows.agg(low, high, F.array(F.min_by(one, by), F.max_by(one, by)).alias(f"{s}_some"))

    apart = lambda x, y: F.when(x["name"] != y["name"], bound(x["shape"], y["shape"]))
    left = None
    for level in range(len(GRIDS)):
        x, y = cells("a", level), cells("b", level)
        if left is None:
            met = x.join(y, shared) if shared else x.crossJoin(y)  # cells, of a bounded number
        else:
            met = left.join(x, [*own["a"], *[f"a_{n}" for n in range(level)]]).join(y, [*own["b"], *[f"b_{n}" for n in range(level)]])
        upper = F.least(*[apart(at(F.col("a_some"), i), at(F.col("b_some"), j)) for i in (0, 1) for j in (0, 1)])
        lower = box_gap(*[F.col(c) for c in ("a_lows", "a_highs", "b_lows", "b_highs")])
        met = met.select(*keys, *[f"{s}_{n}" for s in "ab" for n in range(level + 1)], lower.alias("lower"), upper.alias("upper"))
        best = met.groupBy(*keys).agg(F.min("upper").alias("best"))
        met = met.join(best, keys) if keys else met.crossJoin(F.broadcast(best))  # one row
        left = met.where(F.col("best").isNull() | (F.col("lower") <= F.col("best"))).drop("lower", "upper", "best")
    places = lambda s: [*own[s], *[f"{s}_{n}" for n in range(len(GRIDS))]]
    pairs = left.join(sides["a"], places("a")).join(sides["b"], places("b")).where("a_name <> b_name")
    return pairs.groupBy(*keys).agg(F.min(gap(F.col("a_shape"), F.col("b_shape"))).alias("value")).where("value is not null")


def with_box_shape(boxes: DataFrame) -> DataFrame:
    """Boxes (name, lows, highs, keys) for ``least_gaps``."""
    return boxes.withColumn("shape", F.struct("lows", "highs"))


def box_gaps(a: DataFrame, b: DataFrame) -> DataFrame:
    """``least_gaps`` of boxes (name, lows, highs, keys)."""
    of = lambda x, y: box_gap(x["lows"], x["highs"], y["lows"], y["highs"])
    return least_gaps(with_box_shape(a), with_box_shape(b), of, of)


# meshes -------------------------------------------------------------------------------------------


def _segments(p: np.ndarray, d: np.ndarray, q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Squared distances of segments p + s d and q + t e, s and t in [0, 1]."""
    r = p - q
    a, b, c, f, g = (d * d).sum(-1), (d * e).sum(-1), (e * e).sum(-1), (d * r).sum(-1), (e * r).sum(-1)
    with np.errstate(divide="ignore", invalid="ignore"):
        den = a * c - b * b
        s = np.where(den > 1e-14 * a * c, np.clip((b * g - c * f) / den, 0, 1), 0.0)
        t = np.where(c > 0, (b * s + g) / c, 0.0)
        low, high = t < 0, t > 1
        t = np.clip(t, 0, 1)
        s = np.where((low | high) & (a > 0), np.clip((b * t - f) / a, 0, 1), s)
    s, t = np.nan_to_num(s), np.nan_to_num(t)
    gap = r + s[..., None] * d - t[..., None] * e
    return (gap * gap).sum(-1)


def triangle_gaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of triangles (n, 3 corners, 3 numbers); 0 where they touch or cross."""
    best, hit = np.full(len(a), np.inf), np.zeros(len(a), bool)
    for i in AXES:
        for j in AXES:
            best = np.minimum(best, _segments(a[:, i], a[:, (i + 1) % 3] - a[:, i], b[:, j], b[:, (j + 1) % 3] - b[:, j]))
    for x, y in ((a, b), (b, a)):
        u, v = y[:, 1] - y[:, 0], y[:, 2] - y[:, 0]
        n = np.cross(u, v)
        long = (n * n).sum(1)
        with np.errstate(divide="ignore", invalid="ignore"):
            height = ((x - y[:, None, 0]) * n[:, None]).sum(2)  # of each corner over the other's plane
            foot = x - (height / long[:, None])[..., None] * n[:, None]
            way = np.roll(x, -1, axis=1) - x
            share = height / (height - np.roll(height, -1, axis=1))
            cut = x + share[..., None] * way

            def inside(p, y=y, n=n, long=long):
                sides = [(np.cross(y[:, (k + 1) % 3] - y[:, k], p - y[:, k]) * n).sum(1) for k in AXES]
                return (np.min(sides, axis=0) >= 0) & (long > 0)

            for k in AXES:
                best = np.where(inside(foot[:, k]), np.minimum(best, height[:, k] ** 2 / long), best)
                hit |= (height[:, k] * height[:, (k + 1) % 3] < 0) & inside(cut[:, k])
    return np.where(hit, 0.0, np.sqrt(best))


@F.pandas_udf(DoubleType())
def _triangle_gap(a: pd.Series, b: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype=float)
    return pd.Series(triangle_gaps(np.stack(a.to_list()).reshape(-1, 3, 3), np.stack(b.to_list()).reshape(-1, 3, 3)))


def mesh_gaps(a: DataFrame, b: DataFrame) -> DataFrame:
    """The least distance between the faces of two sets of meshes, for each combination of their keys (as in ``least_gaps``).

    Faces are rows (name, corners: nine numbers, keys), triangles; a set may hold only the faces of some tag. Faces of one name
    aren't compared. Bounds are those of the faces' boxes and corners; triangles meet only where these leave a choice, in Arrow
    batches.
    """

    def faces(t: DataFrame) -> DataFrame:
        corner = lambda k: F.array(*[at(F.col("corners"), 3 * n + k) for n in AXES])
        ends = {c: F.array(*[f(corner(k)) for k in AXES]) for c, f in (("lows", F.array_min), ("highs", F.array_max))}
        return t.withColumns(ends).withColumnRenamed("corners", "shape").withColumn("shape", F.col("shape").cast("array<double>"))

    def bound(x: Column, y: Column) -> Column:
        step = F.zip_with(F.slice(x, 1, 3), F.slice(y, 1, 3), lambda p, q: p - q)
        return F.sqrt(dot(step, step)) * (1 + 1e-9)

    return least_gaps(faces(a), faces(b), _triangle_gap, bound)


# turned boxes: STRUCT<center, axes (three unit rows), half (half sizes along them)> ------------------


def turned_box(center: Column, axes: Column, half: Column) -> Column:
    return F.struct(center.alias("center"), axes.alias("axes"), half.alias("half"))


def box_reach(box: Column, direction: Column) -> Column:
    """Half of a turned box's extent along a direction."""
    parts = F.zip_with(box["axes"], box["half"], lambda a, h: F.abs(dot(a, direction)) * h)
    return F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)


def overlap_depth(a: Column, b: Column) -> Column:
    """How far two turned boxes run into each other: the least shift that parts them; negative if there is a gap along some axis.

    By the separating axes: the boxes' own and the cross products of these.
    """
    gap = F.zip_with(b["center"], a["center"], lambda x, y: x - y)
    crossed = F.flatten(F.transform(a["axes"], lambda x: F.transform(b["axes"], lambda y: cross(x, y))))

    def shift(axis: Column) -> Column:
        long = F.sqrt(dot(axis, axis))
        return F.when(long > 1e-9, (box_reach(a, axis) + box_reach(b, axis) - F.abs(dot(gap, axis))) / long)

    return F.array_min(F.array_compact(F.transform(F.concat(a["axes"], b["axes"], crossed), shift)))


def free_space(box: Column, front: Column, reach: float) -> Column:
    """The box of depth ``reach`` before a turned box's side: front is 1, 2 or 3, the axis that the side looks along, or its negative."""
    place = F.abs(front) - 1
    return let(F.get(box["half"], place), lambda h: turned_box(
        F.zip_with(box["center"], F.get(box["axes"], place), lambda c, x: c + F.signum(front) * x * (h + reach / 2)),
        box["axes"], F.transform(box["half"], lambda x, k: F.when(k == place, F.lit(reach / 2)).otherwise(x))))


def box_bounds(box: Column) -> tuple[Column, Column]:
    """lows, highs of the upright box around a turned one."""
    unit = [F.array(*[F.lit(1.0 if k == n else 0.0) for n in AXES]) for k in AXES]
    end = lambda way: F.array(*[at(box["center"], k) + way * box_reach(box, unit[k]) for k in AXES])
    return end(-1), end(1)


def access_depths(entities: DataFrame, others: DataFrame, reach: float, cell: float) -> DataFrame:
    """Depth of each other (name, box) in the free space of ``reach`` before each entity (name, box, front), as far as they are near: rows (a, b, depth).

    Spaces and boxes meet in the cells of their upright bounds, each pair in one cell; nothing is in its own way.
    """

    def dealt(rows: DataFrame, s: str, box: Column) -> DataFrame:
        rows = rows.select(F.col("name").alias(s), box.alias(f"{s}_box"))
        lows, highs = box_bounds(F.col(f"{s}_box"))
        rows = rows.withColumns({f"{s}_lows": lows, f"{s}_highs": highs})
        span = lambda k: F.sequence(F.floor(at(F.col(f"{s}_lows"), k) / cell), F.floor(at(F.col(f"{s}_highs"), k) / cell))
        return reduce(lambda t, k: t.select("*", F.explode(span(k)).alias(CELL[k])), AXES, rows)

    met = dealt(entities, "a", free_space(F.col("box"), F.col("front"), reach)).join(dealt(others, "b", F.col("box")), list(CELL)).where("a <> b")
    once = [F.floor(F.greatest(at(F.col("a_lows"), k), at(F.col("b_lows"), k)) / cell) == F.col(CELL[k]) for k in AXES]
    return met.where(reduce(lambda x, y: x & y, once)).select("a", "b", overlap_depth(F.col("a_box"), F.col("b_box")).alias("depth"))


def accessibility(entities: DataFrame, others: DataFrame, reach: float, cell: float) -> DataFrame:
    """The greatest of ``access_depths`` for each entity: rows (name, cost), 0 if its space is free. Turning the whole scene changes nothing."""
    found = access_depths(entities, others, reach, cell).groupBy("a").agg(F.max("depth").alias("depth"))
    out = entities.select("name").join(found, F.col("name") == F.col("a"), "left")
    return out.select("name", F.greatest(F.coalesce("depth", F.lit(0.0)), F.lit(0.0)).alias("cost"))


# views --------------------------------------------------------------------------------------------


def points_in_view(points: DataFrame, cameras: DataFrame, most_depth: float, margin: float, cell: float) -> DataFrame:
    """Least depth and least distance from the image, in pixels, for each point (point, xyz) that some camera has before it, at a depth of less than
    ``most_depth`` and at most ``margin`` pixels outside the image: rows (point, depth, away).

    ``cameras``: (camera, K rows of 3, T world-to-camera rows of 4 with a turn and a shift, width, height), any number of them. A camera's view, up to that depth and with the margin, is in the
    upright box around its corners; it meets the points by the cells of that box that hold points and aren't wholly beyond one of the view's
    five planes. So neither table is multiplied by the other.
    """
    def ray(m: Column, u: Column, v: Column) -> Column:
        y = (v - at(at(m, 1), 2)) / at(at(m, 1), 1)
        return F.array((u - at(at(m, 0), 2) - at(at(m, 0), 1) * y) / at(at(m, 0), 0), y, F.lit(1.0))

    left, right, top, bottom = F.lit(-margin), F.col("width") + margin, F.lit(-margin), F.col("height") + margin
    rays = F.array(*[ray(F.col("K"), u, v) for u, v in ((left, top), (right, top), (right, bottom), (left, bottom))])
    # world = R' (p - t): rows of R' are columns of R
    back = lambda p: F.array(*[reduce(lambda s, x: s + x, [at(at(F.col("T"), r), k) * (at(p, r) - at(at(F.col("T"), r), 3)) for r in AXES]) for k in AXES])
    eye = F.array(*[F.lit(0.0)] * 3)
    views = cameras.withColumn("rays", rays).withColumn("corners", F.concat(F.array(back(eye)), F.transform("rays", lambda r: back(F.transform(r, lambda x: x * most_depth)))))
    ahead = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), [F.get("rays", F.lit(k)) for k in range(4)])
    inward = lambda n: F.transform(n, lambda x: x * F.signum(dot(n, F.col("ahead"))))
    views = views.withColumn("ahead", ahead)
    views = views.withColumn("planes", F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: inward(cross(F.get("rays", k), F.get("rays", (k + 1) % 4)))))
    ends = lambda f: [f(F.transform("corners", lambda c: at(c, k))) for k in AXES]  # noqa: B023, E731
    low, high = ends(F.array_min), ends(F.array_max)
    views = views.select("camera", "K", "T", "width", "height", "planes", *[F.sequence(F.floor(low[k] / cell), F.floor(high[k] / cell)).alias(f"s{k}") for k in AXES])
    for k in AXES:
        views = views.select("*", F.explode(f"s{k}").alias(CELL[k])).drop(f"s{k}")
    points = points.select("point", "xyz", *[F.floor(at(F.col("xyz"), k) / cell).alias(CELL[k]) for k in AXES])
    held = points.select(*CELL).distinct()
    # the ball around each cell against each plane
    middle = F.array(*[(F.col(c) + 0.5) * cell for c in CELL])
    moved = lambda p: F.array(*[reduce(lambda s, x: s + x, [at(at(F.col("T"), r), k) * at(p, k) for k in AXES], at(at(F.col("T"), r), 3)) for r in AXES])
    ball = cell * 3**0.5 / 2 * (1 + 1e-9)
    views = views.join(held, list(CELL), "left_semi").withColumn("mid", moved(middle))
    depth = at(F.col("mid"), 2)
    beyond = F.exists("planes", lambda n: dot(n, F.col("mid")) < -ball * F.sqrt(dot(n, n)))
    views = views.where((depth > -ball) & (depth < most_depth + ball) & ~beyond).drop("mid")
    met = points.join(views, list(CELL)).withColumn("p", moved(F.col("xyz"))).where((F.get("p", F.lit(2)) > 0) & (F.get("p", F.lit(2)) < most_depth))
    seen = lambda r: dot(at(F.col("K"), r), F.col("p")) / F.get("p", F.lit(2))
    met = met.withColumns({"u": seen(0), "v": seen(1)})
    away = F.greatest(-F.col("u"), F.col("u") - F.col("width"), -F.col("v"), F.col("v") - F.col("height"), F.lit(0.0))
    return met.select("point", F.get("p", F.lit(2)).alias("depth"), away.alias("away")).where(F.col("away") <= margin).groupBy("point").agg(F.min("depth").alias("depth"), F.min("away").alias("away"))
