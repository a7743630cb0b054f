"""Operators that the queries don't cover, on small inputs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tagweave.functions import scalar as S
from tagweave.functions import vectors as V
from tagweave.functions.sampling import draw, weighted_pick
from tagweave.operators import aggregates as A
from tagweave.operators import geometry as G
from tagweave.operators import joins as J
from tagweave.operators import raster as R
from tagweave.operators import windows as W
from tagweave.plans.solver import RECORD, Annealing, Move, Schedule, addition, deletion, pick_weighted, reassigned, rotated, translated


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


def test_scalar_functions(spark):
    r = one(
        spark, clock=S.clock_seconds(F.lit("1 day, 2:03:04")), days=S.clock_seconds(F.lit("2-01:00:00")), none=S.clock_seconds(F.lit("x")), text=S.clock_text(F.lit(3725)), room=S.room_name(F.lit("living-room_0/1")),
        asset=S.asset_name(F.lit("ChairFactory(12).spawn_asset(3)")), other=S.asset_name(F.lit("Chair:12")), late=S.clock_text(F.lit(360000.9)), tres=S.resource_map(F.lit("cpu=4,mem=24G")), mem=S.memory_gb(F.lit("2048M")), kilo=S.memory_gb(F.lit("3000000K")), bare=S.memory_gb(F.lit("7")), empty=S.memory_gb(F.lit("")), size=S.sizeof_text(F.lit(2048)), small=S.sizeof_text(F.lit(-5)), huge=S.sizeof_text(F.lit(3.5e15)), more=S.sizeof_text(F.lit(2.0**81)), snake=S.snake_case(F.lit("rooms/fooBAR")), snakes=S.snake_case(F.lit("DiningTableLamp")),
        even=S.round_to_nearest(F.lit(2.5), 1), lit=S.python_literal(F.lit("['a', 'b']"), "array<string>"), wrap=S.wrapped(F.lit(370.0), F.lit(0.0), F.lit(360.0)), hexed=S.seed_of(F.lit("ff")), decay=S.linear_decay(F.lit(5), 1.0, 0.0, 0, 10),
        quoted=S.quoted_override(F.lit("a.b=word")), number=S.quoted_override(F.lit("a=12")), lin=S.linvec(5, F.lit(2.0), F.lit(3.0)), lone=S.linvec(1, F.lit(2.0), F.lit(3.0)), spaced=S.randomspacing(0.0, 8.0, 4, 0.25, lambda k: k / 4.0), bare_spaced=S.randomspacing(0.0, 8.0, 4, 0.5, lambda k: k / 4.0),
        domain=S.new_domain((F.lit(0.0), F.lit(1.0)), F.lit(-2.0), F.lit(3.0)), affine=S.affine_to((F.lit(0.0), F.lit(1.0)), (F.lit(5.0), F.lit(9.0))), hash=S.int_hash(F.lit("a"), F.lit(1)),
    )
    import hashlib

    assert (r.clock, r.days, r.none, r.text) == (93784, 176400, None, "01:02:05") and r.late == "100:00:00"
    assert r.room.asDict() == {"type": "living-room", "level": 0, "number": 1} and tuple(r.asset) == ("ChairFactory", 12, "asset", 3) and tuple(r.other) == (None,) * 4
    assert r.tres == {"cpu": "4", "mem": "24G"} and (r.mem, r.kilo, r.bare, r.empty, r.size, r.even) == (2.048, 3.0, None, None, "2.0 KiB", 2)
    assert (r.small, r.huge, r.more, r.snake, r.snakes) == ("-5.0 B", "3.1 PiB", "2.0YiB", "foobar", "dining_table_lamp")
    assert r.lit == ["a", "b"] and r.wrap == 10 and r.hexed == 255 and r.decay == 0.5 and r.quoted == 'a.b="word"' and r.number == "a=12" and r.lin == [2.0, 2.25, 2.5, 2.75, 3.0] and r.lone == [2.0]
    assert r.spaced == [0.5, 2.75, 5.0, 7.25] and r.bare_spaced == [0.0, 2.0, 4.0, 6.0] and r.domain == [1.0, 1.5] and tuple(r.affine) == (0.25, -1.25)
    assert r.hash == int(hashlib.md5(b"a1").hexdigest(), 16) % (2**32 - 1)


def test_vectors(spark):
    a = lambda *x: F.array(*[F.lit(float(v)) for v in x])
    box, other = V.box(a(0, 0, 0), a(2, 2, 2)), V.box(a(1, 1, 1), a(3, 3, 3))
    square = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (4, 0), (4, 2), (0, 2))])
    r = one(
        spark, cross=V.cross(a(1, 0, 0), a(0, 1, 0)), turn=V.turned(a(1, 0, 0), a(0, 0, 1), F.lit(math.pi / 2)), unit=V.normalized(a(3, 4)), zero=V.normalized(a(0, 0)), meet=V.box_measure(V.box_intersection(box, other)),
        join=V.box_union(box, other), empty=V.box_empty(V.box_intersection(box, V.box(a(5, 5, 5), a(6, 6, 6)))), inside=V.box_contains(box, a(1, 1, 1)), corners=F.size(V.box_corners(box)), grown=V.box_measure(V.box_grown(box, F.lit(1.0))),
        local=V.to_local(box, a(1, 0, 2)), there=V.to_global(box, a(0.5, 0, 1)), area=V.polygon_area(square), length=V.polygon_length(square), aspect=V.polygon_aspect(square), rigid=V.rigid(F.array(a(1, 0, 0, 5), a(0, 1, 0, 0), a(0, 0, 1, 0), a(0, 0, 0, 1)), a(1, 2, 3)),
    )
    assert r.cross == [0, 0, 1] and r.turn == pytest.approx([0, 1, 0]) and r.unit == [0.6, 0.8] and r.zero == [0, 0] and r.meet == 1 and r.join.maxs == [3, 3, 3] and r.empty and r.inside and r.corners == 8 and r.grown == 64
    assert r.local == [0.5, 0, 1] and r.there == [1, 0, 2] and (r.area, r.length, r.aspect) == (8, 12, 2) and r.rigid == [6, 2, 3]


def test_draws(spark):
    specs = [("uniform", 2, 3), ("clip_gaussian", 0, 1, -1, 1), ("log_uniform", 1, 10), ("discrete_uniform", 1, 3), ("bool", 0.5), ("choice", ["a", "b"]), ("cat", 0.2, 0.8), ("power_uniform", 0, 2), ("spherical_sample", 10, None), 7, ("choice", ["a", "b"], [1, 3]), ("weighted_choice", (1, ("uniform", 5, 6)), (3, 0.0))]
    rows = spark.range(500).select("id", *[draw(s, 1, F.col("id")).alias(f"c{n}") for n, s in enumerate(specs)]).collect()
    assert all(2 <= r.c0 < 3 and -1 <= r.c1 <= 1 and 1 <= r.c2 <= 10 and r.c3 in (1, 2, 3) and r.c5 in "ab" and r.c6 in (0, 1) and 1 <= r.c7 <= 100 and 10 <= r.c8 <= 90 and r.c9 == 7 for r in rows)
    assert 0.65 < sum(r.c10 == "b" for r in rows) / 500 < 0.85 and all(r.c11 == 0 or 5 <= r.c11 < 6 for r in rows) and 0.65 < sum(r.c11 == 0 for r in rows) / 500 < 0.85
    assert 40 < sum(r.c7 < 10 for r in rows) / 5 < 60  # the powers are even, not the numbers
    assert 25 < sum(r.c8 < 30 for r in rows) / 5 < 50  # by the sine of the elevation
    assert 0.4 < sum(r.c4 for r in rows) / 500 < 0.6 and 0.7 < sum(r.c6 for r in rows) / 500 < 0.9
    picked = weighted_pick(spark.range(400), spark.createDataFrame([("a", 1.0), ("b", 3.0)], "item string, weight double"), "id", 3)
    n = {r["item"]: r["count"] for r in picked.groupBy("item").count().collect()}
    assert sum(n.values()) == 400 and 0.65 < n["b"] / 400 < 0.85


def test_asof_and_hops(spark):
    left = spark.createDataFrame([(1, 5), (1, 9), (2, 1)], "g int, t int")
    right = spark.createDataFrame([(1, 5, "x"), (1, 7, "y")], "g int, t int, v string")
    got = {(r.g, r.t): r.prev_v for r in J.asof(left, right, ["g"], "t", ["v"]).collect()}
    assert got == {(1, 5): None, (1, 9): "y", (2, 1): None}
    assert {(r.g, r.t): r.prev_v for r in J.asof(left, right, ["g"], "t", ["v"], strict=False).collect()}[1, 5] == "x"
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "a string, b string")
    assert {r.node: r.hops for r in J.hops(edges, "a").collect()} == {"a": 0, "b": 1, "c": 1, "d": 2}
    cycle = spark.createDataFrame([("a", "b"), ("b", "a")], "child string, parent string")
    assert {(r.node, r.ancestor) for r in J.ancestors(cycle).collect()} == {("a", "b"), ("b", "a"), ("a", "a"), ("b", "b")}
    assert J.symmetrised(edges, "a", "b").count() == 8


def test_matching(spark):
    costs = spark.createDataFrame([("g", i, j, float(c)) for i, row in enumerate([[4, 1, 3], [2, 0, 5], [3, 2, 2]]) for j, c in enumerate(row)], "grp string, i int, j int, cost double")
    assert sum(r.cost for r in J.matched_optimally(costs, ["grp"]).collect()) == 5
    points = spark.createDataFrame([("g", "a", -1.0, 0.0), ("g", "b", 1.0, 0.0)], "grp string, name string, x double, y double")
    assert sum(r.cost for r in J.matched_optimally(G.reflection_costs(points, "grp"), ["grp"]).collect()) == 0
    left = spark.createDataFrame([("KitchenTable",), ("Zzz",)], "name string")
    right = spark.createDataFrame([("kitchen_tables",), ("sofa",)], "name string")
    got = {r.name: r.match for r in J.best_match(left, right, "name").collect()}
    assert got == {"KitchenTable": "kitchen_tables", "Zzz": None}


def test_interval_overlap_of_the_whole_table(spark, sf):
    from tagweave.queries import QUERIES

    rows = [(r.p_partkey, r.p_retailprice, r.p_retailprice + r.p_size / 10.0) for r in spark.read.parquet(f"{sf}/part.parquet").collect()]
    want = sorted((a, b) for a, low, high in rows for b, low_b, high_b in rows if low <= high_b and low_b <= high and a < b)
    assert sorted(tuple(r) for r in QUERIES["bbox_overlap_join"](spark, sf).collect()) == want


def test_best_match_of_all_names(spark, sf):
    from tagweave.queries import QUERIES

    short = {r.c_custkey: (r.c_name, r.c_custkey % 18) for r in spark.read.parquet(f"{sf}/customer.parquet").collect()}
    got = {r.c_custkey: r.match for r in QUERIES["fuzzy_merge"](spark, sf).collect()}
    for k, (name, at) in short.items():
        lost = name[:at] + name[at + 1 :]
        assert got[k] == min(n for n, _ in short.values() if any(n[:i] + n[i + 1 :] == lost for i in range(len(n))))
    assert len(short) > 19 and set(got) == set(short)

    def likeness(x, y):
        row = [0] * (len(y) + 1)
        for c in x:
            before = row[:]
            for k, d in enumerate(y, 1):
                row[k] = before[k - 1] + 1 if c == d else max(before[k], row[k - 1])
        return 200.0 * row[-1] / (len(x) + len(y))

    right = ["anna_smith", "ana_smith", "bob_stone", "bobby_stones", "carol_reed", "dave_long", "AnnaSmith"]
    left = ["anna_smth", "annasmith", "bob_stnoe", "carol_reed", "zed", "dave_lnog", "AnnaSmith", "karol_read"]
    snake = {r.n: r.s for r in spark.createDataFrame([(n,) for n in {*left, *right}], "n string").select("n", S.snake_case(F.col("n")).alias("s")).collect()}
    want = {}
    for n in left:
        score, match = min((-likeness(snake[n], snake[m]), m) for m in right)  # the first of equally like ones
        want[n] = (match, pytest.approx(-score)) if -score >= 80 else (None, None)
    out = J.best_match(spark.createDataFrame([(n,) for n in left], "name string"), spark.createDataFrame([(n,) for n in right], "name string"), "name")
    assert {r.name: (r.match, r.score) for r in out.collect()} == want
    # names of few letters, near the limit, against all pairs
    r = random.Random(3)
    word = lambda: "".join(r.choice("abc") for _ in range(r.randrange(1, 14)))
    left, right = sorted({word() for _ in range(150)}), sorted({word() for _ in range(120)})
    got = {x.name: (x.match, x.score) for x in J.best_match(spark.createDataFrame([(n,) for n in left], "name string"), spark.createDataFrame([(n,) for n in right], "name string"), "name").collect()}
    for n in left:
        score, match = min((-likeness(n, m), m) for m in right)
        assert got[n] == ((match, pytest.approx(-score)) if -score >= 80 else (None, None)), n


def test_nearest_among_all_rows(spark, sf):
    from tagweave.queries import QUERIES

    rows = [(r.vec_id, [float(x) for x in r.embedding[:3]]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = {}
    for a, p in rows:
        d, b = min((math.dist(p, o), b) for b, o in rows if b != a)
        want[a] = (b, pytest.approx(d, abs=1e-6))
    got = QUERIES["nearest_bucket"](spark, sf).collect()
    assert len(got) == len(want) and {r.point: (r.other, r.distance) for r in got} == want


def test_ancestors_of_a_deep_hierarchy(spark):
    chain = spark.createDataFrame([(n, n + 1) for n in range(23)], "child int, parent int")
    got = {(r.node, r.ancestor): r.depth for r in J.ancestors(chain).collect()}
    assert got == {(a, b): b - a for a in range(24) for b in range(a + 1, 24)}


def rotation_score(points):
    """The mean of both asymmetries, vector by vector."""
    n, cx, cy = len(points), sum(p[0] for p in points) / len(points), sum(p[1] for p in points) / len(points)
    own = sorted(((complex(x - cx, y - cy), complex(math.cos(a), math.sin(a))) for x, y, a in points), key=lambda p: math.atan2(p[0].imag, p[0].real))
    far, out = max(abs(p) for p, _ in own), 0.0
    for vectors in ([p / far for p, _ in own], [h for _, h in own]):
        turn = [complex(math.cos(2 * math.pi * k / n), math.sin(2 * math.pi * k / n)) for k in range(n)]
        q = sum(v / t for v, t in zip(vectors, turn, strict=True)) / n
        out += sum(abs(q * t - v) ** 2 for v, t in zip(vectors, turn, strict=True)) / n / 2
    return out


def test_windows(spark):
    tasks = spark.createDataFrame([(1, 1, "succeeded", None), (1, 2, "failed", "prev_succeeded"), (1, 3, "x", "prev_failed"), (1, 4, "x", "prev_succeeded")], "s int, n int, state string, cond string")
    got = {r.n: (r.may_run, r.fatal) for r in W.sequential_gate(tasks, "s", "n", "state", "cond").collect()}
    assert got == {1: (True, True), 2: (True, False), 3: (True, True), 4: (False, True)}
    asks = {"s": "prev_succeeded", "f": "prev_failed", "r": "prev_redundant", "-": None}
    results = {"+": "succeeded", "x": "failed", ".": None}
    for program, outcomes, want in [
        ("sfs", "+++", "101"),  # what asks for a failure is skipped, and the task after it sees the state before
        ("sfs", "x+.", "111"), ("sffs", "xx+.", "1111"), ("sffs", "x+..", "1101"), ("s-s", "+x.", "110"),
        ("srs", "x+.", "111"), ("srs", ".+.", "111"), ("srr", "xx.", "111"), ("ss r".replace(" ", ""), "x..", "100"), ("sfrs", "+.x.", "1010"), ("sfr", "...", "101"), ("ffs", "xx+", "001"),
    ]:
        rows = [(1, n, results[o], asks[c]) for n, (c, o) in enumerate(zip(program, outcomes, strict=True))]
        ran = W.sequential_gate(spark.createDataFrame(rows, "s int, n int, state string, cond string"), "s", "n", "state", "cond").orderBy("n").collect()
        assert "".join(str(int(r.may_run)) for r in ran) == want, (program, outcomes)
    series = spark.createDataFrame([(0, 0.0), (1, 10.0), (2, 30.0)], "k int, x double")
    assert W.inverse_interpolated(series, "k", "x", 20.0).first().place == 1.5
    keys = spark.createDataFrame([(1, 0.0, 0.0, "LINEAR"), (1, 2.0, 4.0, "CONSTANT"), (1, 3.0, 9.0, "LINEAR")], "g int, t double, v double, mode string")
    assert [(r.slope) for r in W.keyframed(keys, ["g"], "t", "v", "mode").orderBy("t0").collect()] == [2.0, 0.0, 0.0]
    assert W.bezier_value(0, 0, (1 / 3, 1 / 3), (2 / 3, 2 / 3), 1, 1, 0.25) == pytest.approx(0.25)
    frames = [(1, 0.0, 0.0, "BEZIER", -1.0, 0.0, 0.2, 3.0), (1, 1.0, 4.0, "LINEAR", 0.9, 3.5, 1.1, 4.0), (1, 2.0, 6.0, "CONSTANT", 1.9, 6.0, 2.1, 6.0), (1, 3.0, 1.0, "BEZIER", 2.9, 1.0, 3.1, 1.0)]
    curve = spark.createDataFrame(frames, "g int, t double, value double, mode string, left_time double, left_value double, right_time double, right_value double")
    asked = spark.createDataFrame([(1, t) for t in (-1.0, 0.0, 0.5, 1.5, 2.5, 9.0)], "g int, t double")
    got = {r.t: (r.value, r.velocity) for r in W.keyframe_values(curve, asked, ["g"], "t").collect()}
    bent = lambda t: W.bezier_value(0.0, 0.0, (0.2, 3.0), (0.9, 3.5), 1.0, 4.0, t)
    assert got[-1.0] == (None, None) and got[1.5] == (5.0, 2.0) and got[2.5] == (6.0, 0.0) and got[9.0] == (1.0, 0.0) and got[0.0][0] == pytest.approx(0, abs=1e-9)
    assert got[0.5][0] == pytest.approx(bent(0.5)) and got[0.5][1] == pytest.approx((bent(0.50001) - bent(0.49999)) / 0.00002, rel=1e-4)
    ring = spark.createDataFrame([(1, math.cos(k * math.pi / 2), math.sin(k * math.pi / 2), k * math.pi / 2) for k in range(4)], "g int, x double, y double, a double")
    assert W.rotational_asymmetry(W.by_angle(ring, ["g"]), ["g"], "a").first().asymmetry == pytest.approx(0, abs=1e-6)
    pts = [(0.0, 0.0, 0.3), (2.0, 0.5, 1.0), (1.5, 3.0, -2.0), (-1.0, 2.0, 0.0), (0.5, -1.0, 2.5)]
    got = W.rotational_asymmetry(W.by_angle(spark.createDataFrame([(1, *p) for p in pts], "g int, x double, y double, a double"), ["g"]), ["g"], "a").first().asymmetry
    assert got == pytest.approx(rotation_score(pts), abs=1e-8)
    line = spark.createDataFrame([(1, "c", 2.0, 2.1), (1, "a", 0.0, 0.0), (1, "b", 1.0, 0.9)], "g int, name string, x double, y double")
    assert {(r.name, r.next_name) for r in W.principal_order(line, ["g"], "name").collect()} in ({("a", "b"), ("b", "c"), ("c", None)}, {("c", "b"), ("b", "a"), ("a", None)})
    values = spark.createDataFrame([("a", 0.0), ("b", 3.0), ("z", 7.0)], "node string, value double")
    out = {r.node: r.value for r in W.smoothed(values, spark.createDataFrame([("a", "b", 1.0)], "a string, b string, weight double"), 6).collect()}
    assert out["a"] == pytest.approx(1.5) and out["b"] == pytest.approx(1.5) and out["z"] == 7
    capped = W.capped_launch(spark.createDataFrame([(k, 1 if k < 4 else 2, k == 0) for k in range(6)], "k int, g int, stuck boolean"), "g", "k", 2, "stuck")
    assert sorted(r.k for r in capped.collect()) == [1, 4, 5]
    assert [r.n for r in W.bound_order(spark.createDataFrame([(1, 5, 9), (2, 0, 9), (3, 0, 3)], "n int, low int, high int").withColumn("c", F.col("n")), "low", "high", "c").collect()] == [1, 2, 3]
    bounds = spark.createDataFrame([(1, 5, 9, 4), (2, 0, 3, 4), (3, None, 3, 3), (4, 5, None, 9), (5, None, None, 0)], "n int, low int, high int, c int")
    assert [r.n for r in W.bound_order(bounds, "low", "high", "c").collect()][0] == 1 and {r.n for r in W.bound_order(bounds, "low", "high", "c").collect()} == {1, 3, 4, 5}
    back = [r.n for r in W.bound_order(bounds, "low", "high", "c", reverse=True).collect()]
    assert back[0] == 2 and set(back) == {2, 3, 4, 5}


def test_aggregates(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "s string, t string")
    got = {(r.s, r.t, r.level): r.n for r in A.two_level_counts(rows, "s", "t").collect()}
    assert got["a", None, 1] == 2 and got["a", "x", 0] == 1
    low, high = A.binomial_interval(30, 100, 0.01)
    assert 0.17 < low < 0.22 and 0.40 < high < 0.44 and A.binomial_interval(0, 10)[0] == 0
    assert A.control_state(3, 50, 10.0, 100.0) == (5, 2) and A.control_state(5, 50, 10.0, 100.0) == (5, 0) and A.control_state(0, 50, 500.0, 100.0) == (50, 50) and A.control_state(1, 7, 0.0, 0.0) == (7, 6)
    with pytest.raises(ValueError):
        A.control_state(6, 50, 10.0, 100.0)
    below = spark.createDataFrame([(-0.5,), (0.5,), (-1.5,)], "x double").withColumn("g", F.lit(1))
    assert A.grid_line_count(below, ["g"], F.col("x"), 1.0).first().lines == 2  # towards zero
    faces = spark.createDataFrame([(0, [0, 1, 2])], "face int, corners array<int>")
    verts = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 6.0)], "vertex int, value double")
    assert A.face_values(faces, verts).first()[1:] == (3.0, 6.0)
    codes = A.dictionary_encoded(rows, "t")
    assert {(r.t, r.code) for r in codes.collect()} == {("x", 0), ("y", 1)}
    gpus = spark.createDataFrame([("n1", "A", "g", 4, 64.0, 8), ("n2", "A", "g", 2, 32.0, 8)], "node string, gpu string, grp string, gpus int, mem double, cpus int")
    assert A.inventory(gpus).first().asDict() == {"gpu": "A", "grp": "g", "gpus": 6, "nodes": ["n1", "n2"], "mem_per_cpu": 6.0}


def test_raster(spark):
    r = one(spark, packed=R.compressed(F.array(*map(F.lit, [5, 3, 5]))), back=R.recovered(R.compressed(F.array(*map(F.lit, [5, 3, 5])))))
    assert r.packed.vals == [3, 5] and r.packed.indices == [1, 0, 1] and r.back == [5, 3, 5]
    flat = spark.createDataFrame([(0, y, x, [float(x), float(y), 1.0]) for y in range(3) for x in range(3)], "f int, y int, x int, xyz array<double>")
    ns = [r.normal for r in R.normals(flat, ["f"]).collect() if r.normal]
    assert len(ns) == 4 and all(abs(n[2]) == 1 for n in ns)
    eye = [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]]
    move = [[1.0, 0.0, 0.0, 2.0], [0.0, 1.0, 0.0, 0.0], [0.0, 0.0, 1.0, 0.0]] + [[0.0, 0.0, 0.0, 1.0]]
    px = spark.createDataFrame([(1, 1, 2.0, eye, eye, move)], "x int, y int, depth double, K array<array<double>>, K_inv array<array<double>>, T array<array<double>>")
    w = R.warped(px)
    assert (w.first().u, w.first().v, w.first().new_depth) == (2.0, 1.0, 2.0)
    assert R.occluded(w, spark.createDataFrame([(1, 2, 1.0)], "y int, x int, depth double")).first().occluded
    assert not R.occluded(w, spark.createDataFrame([(1, 2, 2.0)], "y int, x int, depth double")).first().occluded
    image = spark.createDataFrame([(y, x, float(y * 4 + x)) for y in range(4) for x in range(4)], "y int, x int, value double")
    assert {(r.y, r.x): r.value for r in R.pooled(image, [], 2, "max").collect()}[1, 1] == 15 and R.pooled(image, [], 2, "first").where("y = 0 and x = 1").first().value == 2
    cams = spark.createDataFrame([("c", eye, move, 10.0, 10.0)], "camera string, K array<array<double>>, T array<array<double>>, width double, height double")
    corners = [[x, y, z] for x in (-1.0, 1.0) for y in (0.0, 2.0) for z in (-1.0, 2.0)]
    boxes = spark.createDataFrame([("b", corners, eye), ("behind", [[0.0, 0.0, -1.0]], eye)], "id string, corners array<array<double>>, K array<array<double>>")
    assert [tuple(r) for r in R.boxes_in_view(boxes).collect()] == [("b", -0.5, 0.5, 0.0, 1.0, 4)]
    pts = spark.createDataFrame([("near", [0.0, 1.0, 1.0]), ("far", [0.0, 0.0, 99.0]), ("off", [50.0, 0.0, 1.0])], "point string, xyz array<double>")
    assert [r.point for r in R.in_view(pts, cams, 10.0, 1.0).collect()] == ["near"]


def test_geometry(spark):
    kind = "name string, lows array<double>, highs array<double>"
    boxes = spark.createDataFrame([("a", [0.0, 0.0, 0.0], [2.0, 2.0, 2.0]), ("b", [1.0, 1.0, 1.0], [3.0, 3.0, 3.0]), ("c", [2.5, 0.0, 0.0], [4.0, 0.5, 2.0])], kind)
    assert {(r.a_name, r.b_name) for r in G.touching_pairs(boxes, boxes, 1.0).collect()} == {("a", "b"), ("b", "a")}
    assert {r.name: r.cost for r in G.accessibility(boxes.where("name = 'a'"), boxes.where("name = 'c'"), 1.0).collect()} == {"a": 0.5}
    pairs = spark.createDataFrame([("a", [1.0, 0.0], [1.0, 0.0], [1.0, 0.0]), ("b", [1.0, 0.0], [-1.0, 0.0], [-1.0, 0.0])], "name string, axis array<double>, direction array<double>, normal array<double>")
    assert {r.name: r.score for r in G.focus_score(pairs).collect()} == {"a": 0, "b": 1} and G.angle_alignment(pairs).first().score == 1
    room = spark.createDataFrame([("l", [0.0, 2.0, 2.0, 1.0, 1.0, 0.0], [0.0, 0.0, 1.0, 1.0, 2.0, 2.0])], "room string, xs array<double>, ys array<double>")
    assert G.convexity(room).first().convexity == pytest.approx(3.5 / 3)
    plans = spark.createDataFrame([("l", [0.0, 4.0, 4.0, 1.0, 1.0, 0.0], [0.0, 0.0, 3.0, 3.0, 4.0, 4.0]), ("s", [3.0, 6.0, 6.0, 3.0], [2.0, 2.0, 5.0, 5.0])], "room string, xs array<double>, ys array<double>")
    assert G.grid_cells(plans, 0.5).where("room = 'l'").count() == 13 * 4 and G.intersection_area(plans, 0.5).first().area == 1.0
    narrow = {r.room: r.narrowness for r in G.narrowness(plans, 1.0, 3.0).collect()}
    assert narrow["s"] == 0 and narrow["l"] == 4.0  # the arm of width 1 goes at both steps, with 2 of outline each
    walls = spark.createDataFrame([("a", "x", 1.0, 0.0, 3.0), ("b", "x", 1.0, 2.0, 5.0), ("c", "y", 1.0, 0.0, 9.0)], "room string, axis string, at double, low double, high double")
    assert G.shared_edges(walls).first()[:] == ("a", "b", 1.0) and G.shared_vertices(walls).first().vertices == 2
    centres = spark.createDataFrame([("r", 0.0, 0.0), ("a", 1.0, 0.0), ("b", 1.0, 1.0)], "room string, x double, y double")
    angles = {r.room: r.angle for r in G.access_angle(centres, spark.createDataFrame([("a", "b"), ("b", "a")], "a string, b string"), "r").collect()}
    assert angles["r"] == 0 and angles["a"] == pytest.approx(math.pi / 2, abs=1e-3) and angles["b"] == pytest.approx(math.pi / 4, abs=1e-3)
    rooms = spark.createDataFrame([(10.0,), (5.0,)], "area double")
    asked = spark.createDataFrame([("a", "b", False), ("a", "x", True)], "a string, b string, exterior boolean")
    there = spark.createDataFrame([("b", "a")], "a string, b string")
    assert G.coherence(rooms, asked, there, 16.0).first().violations == 3
    floors = spark.createDataFrame([([0.0, 0.0], [4.0, 4.0], [0.0, 0.0], [4.0, 5.0]), ([0.0, 0.0], [4.0, 6.0], [0.0, 0.0], [4.0, 5.0])], "lows array<double>, highs array<double>, below_lows array<double>, below_highs array<double>")
    assert G.coherence(rooms, asked, there, 16.0, floors).first().violations == 4


def test_annealing_and_moves():
    schedule = Schedule(steps=60)
    assert schedule.temperature(0) == 3 and schedule.temperature(51) == pytest.approx(0.001) and schedule.temperature(59) == 0.001
    assert schedule.temperature(17) == pytest.approx(3 * (0.001 / 3) ** (17 / 51))
    assert schedule.accepts(0, (1, 5), (0, 9), 0.9) and not schedule.accepts(0, (0, 1), (1, 0), 0.0)
    assert schedule.accepts(59, (0, 1), (0, 1.0005), 0.5) and not schedule.accepts(59, (0, 1), (0, 2), 0.5)  # Metropolis to the end
    search = Annealing(schedule, lambda s, k: {"up": s + 1, "down": s - 1}, lambda s, m: {k: (0.0, float(v * v)) for k, v in m.items()}, lambda s, c: c)
    best, scores = search.run(9, (0.0, 81.0))
    assert set(search.log[0]) == set(RECORD) and search.log[0]["retry"] == 0
    barred = Annealing(schedule, search.propose, search.score, search.apply, valid=lambda s, m: m != 8, retries=1)
    assert barred.run(9, (0.0, 81.0))[0] == 9 and all(r["retry"] == 1 for r in barred.log if r["move_gen"] != "up") and len(barred.log) == 60
    assert best == 0 and scores == (0.0, 0.0) and len(search.log) == 60
    assert pick_weighted({"a": 1, "b": 3}, 0.3) == "b"
    state = {"a": {"loc": (0.0, 0.0, 0.0), "relations": [{"parent": "t", "plane": 0}]}}
    for move in (addition("b", {"loc": (1, 1, 1)}), deletion(["a"]), translated(state, "a", (1.0, 0.0, 0.0)), rotated(state, "a", 7.0), reassigned(state, "a", 0, parent="u", plane=2), Move("none")):
        assert move.undo(state, move.apply(state)) == state
    assert translated(state, "a", (1.0, 0.0, 0.0)).apply(state)["a"]["loc"] == (1.0, 0.0, 0.0)


def test_rounded_is_spark_round(spark):
    values = [2.3400000000000318, 0.0, 5e-7, 4.9999999999999994e-7, 2.5e-6, 1e-7, -1.5e-6, 7.0000005, 123456.7890125, 999999999.5, 1e12 + 0.1, float("inf"), float("nan"), None]
    got = spark.createDataFrame([(v,) for v in values], "x double").select("x", S.rounded(F.col("x"), 6).alias("got"), F.round("x", 6).alias("want")).collect()
    assert [str(g.got) for g in got] == [str(g.want) for g in got]
