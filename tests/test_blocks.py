"""Pairs of large groups: the same pairs as by all with all, and no task that looks at most of them."""

import random

import pytest
from pyspark.sql import functions as F

from tagweave.operators import joins as J


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 32)
    monkeypatch.setattr(J, "PAIRS", 1_000)


def spread(df) -> float:
    """The share of the rows that the largest task has made."""
    found = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(found) / sum(found)


def test_copies_do_not_grow_with_the_square():
    """A hundred times the pairs, of a table ten times as large: as many tasks, and no more copies of a row."""
    copies = [n / J.blocks_for(float(n) * n)[1] for n in (1_000_000, 10_000_000)]
    assert copies[0] == pytest.approx(copies[1]) and copies[0] < 32 and J.blocks_for(1e14)[0] <= J.TASKS + 1
    tasks, block = J.blocks_for(4e8, 50_000)  # dear pairs: no block of them is more than a task's share
    assert tasks == J.TASKS + 1 and block == pytest.approx((4e8 / J.TASKS) ** 0.5)
    assert J.blocks_for(1e6, 50_000) == (21, pytest.approx(50_000**0.5)) and J.blocks_for(100.0)[0] == 1


def test_blocks_meet_once(spark, small_blocks):
    a = spark.createDataFrame([(n, n % 7 % 3) for n in range(500)], "a long, g int")
    b = spark.createDataFrame([(n, n % 2) for n in range(400)], "b long, g int")
    got = J.met_in_blocks(a, b, ["g"])
    assert sorted((r.a, r.b) for r in got.collect()) == sorted((n, m) for n in range(500) for m in range(400) if n % 7 % 3 == m % 2)
    assert spread(got) < 0.2 and got.columns == ["g", "a", "b"]
    assert J.met_in_blocks(a, b.where("1 = 0"), ["g"]).count() == 0


def test_intervals_of_one_cell_are_spread(spark, small_blocks):
    r = random.Random(3)
    rows = [(n, low, low + r.choice([0.0, 0.5, 3.0])) for n, low in enumerate(r.choice([1.0, 1.25, 2.0, 4.0]) for _ in range(300))] + [(300, -9.0, 40.0)]
    i = spark.createDataFrame(rows, "k long, low double, high double")
    want = sorted((a, b) for a, low, high in rows for b, low_b, high_b in rows if low <= high_b and low_b <= high)
    got = J.interval_overlap(i, i, "k", "k", "low", "high", 5.0)
    assert sorted((g.key_a, g.key_b) for g in got.collect()) == want and spread(got) < 0.4
    got = J.interval_overlap(i, i, "k", "k", "low", "high", 5.0, once=True)
    assert sorted((g.key_a, g.key_b) for g in got.collect()) == [(a, b) for a, b in want if a < b]
    assert all(g.low_a == rows[g.key_a][1] and g.high_b == rows[g.key_b][2] for g in got.collect())


def test_nothing_dealt_to_cells_is_broadcast(spark):
    """Rows in cells are many more than Spark's estimate, which is of the table before."""
    from tagweave.operators import plane

    square = "array(struct(id * 2.0 as x, 0.0 as y), struct(id * 2.0 + 3 as x, 0.0 as y), struct(id * 2.0 + 3 as x, 1.0 as y))"
    rooms = spark.range(40).selectExpr("id as key", f"{square} as corners")
    out = plane.overlays(rooms, rooms, 4.0, once=True)
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.a, r.b) for r in out.collect()) == [(n, n + 1) for n in range(39)]


def test_what_a_side_parts_is_not_laid_over(spark):
    from tagweave.operators import plane

    corner = lambda *p: [tuple(map(float, c)) for c in p]
    low, high = corner((0, 0), (8, 0), (0, 8)), corner((8, 8), (8, 1), (1, 8))
    touching, inside = corner((8, 0), (0, 8), (8, 8)), corner((1, 1), (1, 2), (2, 1))
    kind = "key long, corners array<struct<x: double, y: double>>"
    a, b = spark.createDataFrame([(0, low), (1, low[::-1])], kind), spark.createDataFrame([(2, high), (3, touching), (4, inside)], kind)
    got = {(r.a, r.b): r.intersection for r in plane.overlays(a, b, 4.0).collect()}
    assert got == {(0, 3): 0.0, (1, 3): 0.0, (0, 4): 0.5, (1, 4): 0.5}


def test_nearest_lines_of_one_place_are_spread(spark, small_blocks):
    from tagweave.operators import plane

    points = spark.range(200).selectExpr("id as point", "id / 1000.0D as x", "0.0D as y")
    lines = spark.range(150).selectExpr("id as line", "0.0D as x0", "1.0D + id as y0", "1.0D as x1", "1.0D + id as y1")
    got = plane.nearest_lines(points, lines, 500.0)
    assert sorted(tuple(r) for r in got.collect()) == [(n, 0, 1.0) for n in range(200)]


def test_boxes_of_one_cell_are_spread(spark, small_blocks):
    from tagweave.operators import geometry

    boxes = spark.range(150).selectExpr("id as name", "array(id % 5 * 1.0D, 0.0D, id % 2 * 1.0D) as lows", "array(id % 5 + 1.5D, 1.0D, id % 2 + 1.0D) as highs")
    want = sorted((n, m) for n in range(150) for m in range(n + 1, 150) if abs(n % 5 - m % 5) < 2 and n % 2 == m % 2)
    got = geometry.touching_pairs(boxes, boxes, 50.0, once=True)
    assert sorted((r.a_name, r.b_name) for r in got.collect()) == want and spread(got) < 0.4
    assert geometry.touching_pairs(boxes, boxes, 2.0).count() == 2 * len(want)


def test_walls_on_one_line_are_spread(spark, small_blocks):
    from tagweave.operators import geometry

    r = random.Random(4)
    rows = [(n, 2.0, low, low + r.choice([1.0, 4.0])) for n, low in enumerate(r.choice([0.0, 1.0, 2.5]) for _ in range(150))]
    rows += [(n, 0.0, 5.0, 9.0) for n in range(3)] + [(1, -0.0, 7.0, 8.0)]
    want = {}
    for a, at, low, high in rows:
        for b, there, l, h in rows:  # noqa: E741
            if a < b and at == there and min(high, h) > max(low, l):
                want[a, b] = want.get((a, b), 0.0) + min(high, h) - max(low, l)
    walls = spark.createDataFrame([(n, "x", *more) for n, *more in rows], "room long, axis string, at double, low double, high double")
    got = geometry.shared_edges(walls)
    assert {(g.a, g.b): g.length for g in got.collect()} == want and got.count() == len(want)
    assert spread(got) < 0.4


def test_names_a_character_apart_need_no_bigrams(spark, monkeypatch):
    def none(rows, *more):
        assert rows.isEmpty(), "names are left for the bigrams"
        return real(rows, *more)

    real = J._rarest
    names = [f"item#{n:04d}" for n in range(60)]
    left = [n[:k % 9] + n[k % 9 + 1 :] for k, n in enumerate(names)] + ["item#00077", "item#x0011"]
    monkeypatch.setattr(J, "_rarest", none)
    got = {r.name: (r.match, r.score) for r in J.best_match(spark.createDataFrame([(n,) for n in left], "name string"), spark.createDataFrame([(n,) for n in names], "name string"), "name").collect()}
    without = lambda x: {x[:k] + x[k + 1 :] for k in range(len(x))}
    for n in left:
        near = [m for m in names if n in without(m) or m in without(n)]
        assert got[n] == (min(near), pytest.approx(200.0 * min(len(n), 9 if len(n) > 9 else 8) / (len(n) + 9))), n


def test_clocks_of_many_hours_are_as_in_the_sql(spark, tmp_path):
    from tagweave import more_queries  # noqa: F401  registers
    from tagweave.queries import QUERIES

    spark.createDataFrame([(3, 1), (51429, 2), (600000, 50)], "p_partkey long, p_size int").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    got = {r.p_partkey: r.clock for r in QUERIES["formatted_numbers"](spark, str(tmp_path)).collect()}
    assert got == {3: "00:00:21", 51429: "10:00:03", 600000: "11:40:00"}  # lpad leaves two digits of 100 and 1166 hours


def test_parents_of_one_nation_are_spread(spark, small_blocks):
    a = spark.range(120).selectExpr("concat('a:', id) as name", "array('sem:a') as tags", "'a' as class")
    b = spark.range(100).selectExpr("concat('b:', id) as name", "array('sem:b') as tags", "'b' as class")
    from tagweave.plans.algebra import Domain, Relation, tags
    from tagweave.plans.compile import Bindings

    both = a.union(b)
    db = Bindings(both, both.selectExpr("name as src", "name as dst", "'touching' as kind").where("1 = 0"), frozenset("ab"))
    planes = both.selectExpr("name", "0 as plane", "array('sub:top') as tags", "1 as nation")
    got = J.relation_assignments(db, [(Relation("supported_by"), Domain(tags("a"))), (Relation("touching"), Domain(tags("b")))], planes, ["nation"])
    assert got.count() == 12_000 == got.distinct().count() and spread(got) < 0.4


def test_turned_walls_on_one_line_are_spread(spark, small_blocks):
    from tagweave.operators import plane

    rows = [(n, 3.0 * (n % 3), 4.0 * (n % 3), 3.0 * (n % 3) + 3.0 + 3 * (n % 2), 4.0 * (n % 3) + 4.0 + 4 * (n % 2)) for n in range(120)] + [(0, 30.0, 40.0, 33.0, 44.0), (200, 33.0, 44.0, 30.0, 40.0)]
    ends = [(n, x / 3, x1 / 3) for n, x, _, x1, _ in rows]
    want = {}
    for a, low, high in ends:
        for b, *more in ends:
            long = min(max(low, high), max(more)) - max(min(low, high), min(more))
            if a < b and long > 0.01:
                want[a, b] = want.get((a, b), 0.0) + 5 * long
    got = plane.shared_walls(spark.createDataFrame(rows, "room long, x0 double, y0 double, x1 double, y1 double"), 1e-6, 5.0)
    assert {(g.a, g.b): g.length for g in got.collect()} == pytest.approx(want) and spread(got) < 0.4


@pytest.mark.parametrize("angle", [0.3, 1.5707963267948966, 1.5707958])
def test_long_shared_walls_meet_at_one_end(spark, monkeypatch, angle):
    """As by lines with lines, in any direction and either way round, of few more pairs than there are walls."""
    import math

    from tagweave.operators import plane

    r, looked, real = random.Random(6), [], plane.met_in_blocks
    rows = []
    for n in range(150):
        x, y, long = r.uniform(0, 40), r.choice([0.0, 9.0]), r.uniform(3, 20)
        p, q = (x, y + r.uniform(-1e-3, 1e-3)), (x + long, y + r.uniform(-1e-3, 1e-3))
        p, q = ((c[0] * math.cos(angle) - c[1] * math.sin(angle), c[0] * math.sin(angle) + c[1] * math.cos(angle)) for c in ((p, q) if r.random() < 0.5 else (q, p)))
        rows.append((n, *p, *q))
    lines = spark.createDataFrame(rows, "room long, x0 double, y0 double, x1 double, y1 double")

    def met(*args):
        out = real(*args)
        looked.append(out.count())
        return out

    each = plane._stretches(lines, lines, 1e-3, 2.0).selectExpr("a", "b", "hypot(x1 - x0, y1 - y0) as length").where("length > 0.5")
    want = {(g.a, g.b): g.length for g in each.collect()}
    monkeypatch.setattr(plane, "met_in_blocks", met)
    got = plane.shared_walls(lines, 1e-3, 2.0, 0.5)
    assert got.count() == len(want) > 1000 and {(g.a, g.b): g.length for g in got.collect()} == pytest.approx(want)
    assert looked[0] < 6 * len(want)


def test_more_parents_make_larger_blocks(spark, small_blocks, monkeypatch):
    """Beyond the most tasks blocks grow, and no row is copied for each of many small ones."""
    monkeypatch.setattr(J, "TASKS", 4)
    a, b = spark.range(120).selectExpr("id as target_0", "1 as nation"), spark.range(100).selectExpr("id as target_1", "1 as nation")
    got = J.met_in_blocks(a, b, ["nation"])
    assert got.count() == 12_000 == got.distinct().count()
    assert got.groupBy(F.spark_partition_id()).count().count() <= 5
