"""Least gaps, turned boxes, meshes and views against brute force, and under turns of the whole scene."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagweave.operators import solids as S


def turn(r):
    """A random rotation."""
    q = np.array([r.gauss(0, 1) for _ in range(4)])
    w, x, y, z = q / np.linalg.norm(q)
    return np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)], [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)], [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]])


def gap(a, b):
    return math.sqrt(sum(max(a[0][k] - b[1][k], b[0][k] - a[1][k], 0) ** 2 for k in range(3)))


@pytest.mark.parametrize("spread", [1.0, 300.0])
def test_box_gaps(spark, spread):
    r = random.Random(3)

    def boxes(n, prefix):
        out = []
        for k in range(n):
            low = [r.gauss(0, 1) * spread + (40 * spread if prefix == "b" and k % 3 == 2 else 0) for _ in range(3)]
            out.append((f"{prefix}{k}", k % 3, [*low], [x + r.uniform(0, 2) for x in low]))
        return out

    a, b = boxes(150, "a"), boxes(120, "b")
    b.append(("a0", 0, a[0][2], a[0][3]))  # itself isn't compared
    schema = "name string, g int, lows array<double>, highs array<double>"
    left, right = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    got = {x.g: x.value for x in S.box_gaps(left, right).collect()}
    assert got == pytest.approx({g: min(gap(x[2:], y[2:]) for x in a for y in b if x[1] == g == y[1] and x[0] != y[0]) for g in range(3)})
    whole = S.box_gaps(left.drop("g"), right.drop("g")).collect()
    assert [x.value for x in whole] == pytest.approx([min(gap(x[2:], y[2:]) for x in a for y in b if x[0] != y[0])])
    # keys of one side only: each of them with all of the other
    got = {x.g: x.value for x in S.box_gaps(left, right.drop("g")).collect()}
    assert got == pytest.approx({g: min(gap(x[2:], y[2:]) for x in a for y in b if x[1] == g and x[0] != y[0]) for g in range(3)})
    assert S.box_gaps(left.where("name = 'a0'").drop("g"), left.where("name = 'a0'").drop("g")).count() == 0
    assert S.box_gaps(left.where("1 = 0"), right).count() == 0


def slow_triangle_gap(a, b, n=60):
    """From many points of each, an upper bound that is close."""
    w = np.array([(i / n, j / n) for i in range(n + 1) for j in range(n + 1 - i)])
    p, q = (t[0] + w[:, :1] * (t[1] - t[0]) + w[:, 1:] * (t[2] - t[0]) for t in (a, b))
    return np.sqrt(((p[:, None] - q[None]) ** 2).sum(-1)).min()


def test_triangle_gaps():
    r = np.random.default_rng(1)
    a, b = r.normal(size=(60, 3, 3)), r.normal(size=(60, 3, 3)) + r.normal(size=(60, 1, 3)) * 1.5
    b[0], b[1], b[2] = a[0], a[1] + [0, 0, 3], np.stack([a[2][0], a[2][0] + [5, 5, 5], a[2][0] + [5, -5, 2]])
    a[3] = [[0, 0, 0], [4, 0, 0], [0, 4, 0]]
    b[3] = [[1, 1, 2], [1, 1, 5], [2, 1, 5]]  # a corner over a face
    a[4], b[4] = [[0, 0, 0], [2, 0, 0], [4, 0, 0]], [[1, 1, 0], [1, 3, 0], [1, 2, 0]]  # without area
    got = S.triangle_gaps(a, b)
    for k in range(60):
        slow = slow_triangle_gap(a[k], b[k])
        assert got[k] <= slow + 1e-9 and slow - got[k] < 0.15, k
    assert got[0] == 0 and got[2] == pytest.approx(0, abs=1e-9) and got[3] == pytest.approx(2) and got[4] == pytest.approx(1)


def faces(name, centre, size, rotation=None, tag="side"):
    """A cube's twelve faces."""
    corners = np.array([[x, y, z] for x in (-1, 1) for y in (-1, 1) for z in (-1, 1)]) * size / 2
    corners = corners @ (rotation if rotation is not None else np.eye(3)).T + centre
    squares = [(0, 1, 3, 2), (4, 5, 7, 6), (0, 1, 5, 4), (2, 3, 7, 6), (0, 2, 6, 4), (1, 3, 7, 5)]
    return [(name, "top" if n == 5 else tag, [float(v) for k in t for v in corners[k]]) for n, s in enumerate(squares) for t in ((s[0], s[1], s[2]), (s[0], s[2], s[3]))]


def test_mesh_gaps(spark):
    r = random.Random(4)
    left, right = [], []
    for k in range(25):
        left += faces(f"a{k}", np.array([r.uniform(-30, 30) for _ in range(3)]), r.uniform(0.5, 2), turn(r))
        right += faces(f"b{k}", np.array([r.uniform(-30, 30) for _ in range(3)]), r.uniform(0.5, 2), turn(r))
    schema = "name string, tag string, corners array<double>"
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    value = [x.value for x in S.mesh_gaps(a.drop("tag"), b.drop("tag")).collect()]
    x, y = (np.array([t[2] for t in rows]).reshape(-1, 3, 3) for rows in (left, right))
    best = min(S.triangle_gaps(np.repeat(x[k : k + 1], len(y), 0), y).min() for k in range(len(x)))
    assert value == pytest.approx([best])
    cubes = spark.createDataFrame(faces("low", np.zeros(3), 2.0) + faces("high", np.array([0.0, 0, 5]), 2.0), schema)
    of = lambda n, tag=None: cubes.where(F.col("name") == n).where(F.col("tag") == tag if tag else F.lit(True)).drop("tag")
    assert [x.value for x in S.mesh_gaps(of("low"), of("high")).collect()] == pytest.approx([3.0])
    assert [x.value for x in S.mesh_gaps(of("low", "top"), of("high", "top")).collect()] == pytest.approx([5.0])  # faces of a tag alone


BOX = "struct<center: array<double>, axes: array<array<double>>, half: array<double>>"


def test_overlap_depth_and_access_when_turned(spark):
    """A scene of upright boxes, whose depths are plain, as it is and turned."""
    r = random.Random(6)
    names = [(f"e{k}", [r.uniform(0, 12) for _ in range(3)], [r.uniform(0.3, 2) for _ in range(3)], r.choice([1, -1, 2, -2, 3, -3])) for k in range(40)]
    reach = 1.5
    want = {}
    for n, c, h, front in names:
        k, way = abs(front) - 1, math.copysign(1, front)
        space, half = list(c), list(h)
        space[k], half[k] = c[k] + way * (h[k] + reach / 2), reach / 2
        depths = [min(half[j] + h2[j] - abs(space[j] - c2[j]) for j in range(3)) for m, c2, h2, _ in names if m != n]
        want[n] = max(0.0, *depths)
    for rotation, shift in ((np.eye(3), np.zeros(3)), (turn(r), np.array([50.0, -20, 3]))):
        rows = [(n, {"center": (rotation @ c + shift).tolist(), "axes": rotation.T.tolist(), "half": h}, front) for n, c, h, front in names]
        df = spark.createDataFrame(rows, f"name string, box {BOX}, front int")
        got = {x.name: x.cost for x in S.accessibility(df, df.select("name", "box"), reach, 4.0).collect()}
        assert got == pytest.approx(want, abs=1e-9)
    # a cube's edge into another's side: turned by an eighth
    s = math.sqrt(0.5)
    pair = spark.createDataFrame([({"center": [0.0] * 3, "axes": np.eye(3).tolist(), "half": [1.0] * 3}, {"center": [2.0, 0.0, 0.0], "axes": [[s, s, 0.0], [-s, s, 0.0], [0.0, 0.0, 1.0]], "half": [1.0] * 3})], f"a {BOX}, b {BOX}")
    assert pair.select(S.overlap_depth(F.col("a"), F.col("b"))).first()[0] == pytest.approx(math.sqrt(2) - 1)


@pytest.mark.parametrize("cell", [0.7, 3.0])
def test_points_in_view(spark, cell):
    r = random.Random(8)
    points = [(n, [r.uniform(-10, 10) for _ in range(3)]) for n in range(800)]
    cameras, want = [], {}
    for c in range(25):
        rotation, shift = turn(r), np.array([r.uniform(-4, 4) for _ in range(3)])
        k = [[r.uniform(50, 200), r.choice([0.0, 3.0]), r.uniform(30, 60)], [0.0, r.uniform(50, 200), r.uniform(20, 50)], [0.0, 0.0, 1.0]]
        t = [[*rotation[n].tolist(), float(shift[n])] for n in range(3)] + [[0.0, 0.0, 0.0, 1.0]]
        cameras.append((f"c{c}", k, t, 100.0, 80.0))
        for n, p in points:
            q = rotation @ p + shift
            if 0 < q[2] < 6.0:
                u, v = (np.array(k) @ q)[:2] / q[2]
                away = max(-u, u - 100, -v, v - 80, 0)
                if away <= 5.0:
                    old = want.get(n, (math.inf, math.inf))
                    want[n] = (min(old[0], q[2]), min(old[1], away))
    a = spark.createDataFrame(points, "point int, xyz array<double>")
    b = spark.createDataFrame(cameras, "camera string, K array<array<double>>, T array<array<double>>, width double, height double")
    out = S.points_in_view(a, b, 6.0, 5.0, cell)
    assert {x.point: (x.depth, x.away) for x in out.collect()} == {n: pytest.approx(w) for n, w in want.items()} and len(want) > 50
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
