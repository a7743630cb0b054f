"""Measures of shapes inside programs, against plain Python."""

import math

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from tagweave.plans import lang as L
from tagweave.plans import terms
from tagweave.plans.algebra import Domain, Relation, tags
from tagweave.plans.compile import Bindings, Compiler, evaluate, implementation
from tagweave.plans.lang import scene

ROOMS = {
    "kitchen": [(0, 0), (4, 0), (4, 3), (0, 3)], "hall": [(4, 0), (9, 0), (9, 2), (6, 2), (6, 5), (4, 5)], "bath": [(0, 3), (4, 3), (4, 6), (0, 6)], "rug": [(3, 1), (7, 1), (7, 4), (3, 4)],
}


def turned(x, y, angle):
    return math.cos(angle) * x - math.sin(angle) * y, math.sin(angle) * x + math.cos(angle) * y


def house(spark, angle):
    """Rooms, a rug and things that stand there, turned."""
    rows = []
    c, s = math.cos(angle), math.sin(angle)
    axes = [[c, s, 0.0], [-s, c, 0.0], [0.0, 0.0, 1.0]]
    for name, p in ROOMS.items():
        rows.append((name, ["sem:room" if name != "rug" else "sem:rug"], [turned(x, y, angle) for x, y in p], None, None, None, None))
    for name, x, y, way, front in (("sofa", 1.0, 1.4, (1, 0), 1), ("chair", 3.5, 2.8, (1, 0), -2), ("tv", 3.2, 1.0, (-1, 0), -1)):
        rows.append((name, ["sem:thing", f"sem:{name}"], None, list(turned(x, y, angle)), [float(v) for v in turned(*way, angle)], {"center": [*turned(x, y, angle), 0.5], "axes": axes, "half": [0.5, 0.5, 0.5]}, front))
    box = "struct<center: array<double>, axes: array<array<double>>, half: array<double>>"
    objects = spark.createDataFrame(rows, f"name string, tags array<string>, corners array<struct<x: double, y: double>>, centre array<double>, axis array<double>, box {box}, front int")
    edges = spark.createDataFrame([("sofa", "kitchen", "supported_by"), ("chair", "kitchen", "supported_by"), ("tv", "hall", "supported_by")], "src string, dst string, kind string")
    return Bindings(objects, edges)


@pytest.mark.parametrize("angle", [0.0, 0.6])
def test_measures(spark, angle):
    room, rug, thing = scene()["room"], scene()["rug"], scene()["thing"]
    on = Relation("supported_by")
    program = L.Problem({"large": room.all(lambda r: r.measure("area") >= 12)}, {
        "area": room.measure("area"), "around": room.measure("outline_length"), "corners": room.measure("n_verts"), "none": scene()["nothing"].measure("area"),
        "covered": rug.measure("intersection", room), "bent": room.sum(lambda r: r.measure("convexity")), "walls": room.sum(lambda r: r.measure("shared_length", room)),
        "ends": room.sum(lambda r: r.measure("shared_n_verts", room)), "hall_kitchen": room.mean(lambda r: r.measure("intersection", rug)),
        "facing": scene()["sofa"].measure("focus_score", scene()["tv"]), "away": scene()["tv"].measure("focus_score", scene()["chair"]), "aligned": thing.measure("angle_alignment", room),
        "in_rooms": room.sum(lambda r: thing.related_to(r, on).measure("angle_alignment", room)), "free": thing.measure("accessibility", thing, 2.0), "each": thing.sum(lambda t: t.measure("accessibility", thing, 2.0)),
    })
    got = {r["name"]: r.value for r in evaluate(program, house(spark, angle)).collect()}
    assert got["large"] == 0 and (got["area"], got["none"]) == (pytest.approx(12 + 16 + 12), 0)
    assert got["around"] == pytest.approx(14 + 20 + 14) and got["corners"] == 5 + 7 + 5
    assert got["covered"] == pytest.approx(2 + 7 + 1) and got["hall_kitchen"] == pytest.approx(10 / 3)
    assert got["bent"] == pytest.approx(2 + 20.5 / 16)
    assert got["walls"] == pytest.approx(2 * (3 + 4 + 2)) and got["ends"] == 2 * 6
    assert got["facing"] == pytest.approx(0.5 - 0.5 * 2.2 / math.hypot(2.2, 0.4)) and got["away"] == pytest.approx(0.5 + 0.5 * 0.3 / math.hypot(0.3, 1.8))
    # the sofa is nearest to x = 0, the tv to x = 4, both along the normal; the chair to y = 3, across
    assert (got["aligned"], got["in_rooms"]) == pytest.approx((0.5, 0.5))
    # shifts that part them: sofa and tv, each before the other, 0.6; the tv before the chair 0.7
    assert got["free"] == pytest.approx(0.7) and got["each"] == pytest.approx(0.6 + 0.6 + 0.7)


def test_shapes_of_one_room(spark):
    db = house(spark, 0.0)
    rows = Compiler(db).for_each(scene()["room"], lambda r: r.measure("aspect_ratio"))
    assert {r["name"]: r.value for r in rows.collect()} == pytest.approx({"kitchen": 4 / 3, "hall": 1.0, "bath": 4 / 3})
    lines = evaluate(L.Problem({}, {"x": scene()["room"].measure("grid_line_count", option="x:2.0")}), db).first().value
    assert lines == len({int(x / 2) for n in ("kitchen", "hall", "bath") for x, _ in ROOMS[n]})
    with pytest.raises(TypeError):
        evaluate(L.Problem({}, {"x": scene().measure("volume of air")}), db)
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (2, 1), (4, 0), (3, 2), (4, 4), (2, 3), (0, 4), (1, 2), (2, 2))])
    assert spark.range(1).select(terms.hull_area(ring)).first()[0] == 16


def test_what_does_not_concern_a_domain_is_left_out(spark):
    db = house(spark, 0.0)
    program = L.Problem({"rooms": scene()["room"].count() >= 9, "things": scene()["thing"].count() >= 9}, {"area": scene()["room"].measure("area")})
    assert {r["name"]: r.value for r in evaluate(program, db, Domain(tags("thing", "-room"))).collect()} == {"rooms": 0, "things": 6, "area": 0}
    assert {r["name"]: r.value for r in evaluate(program, db, Domain(tags("room", "-thing"))).collect()} == {"rooms": 6, "things": 0, "area": 40}


def test_every_node_of_the_language_has_an_implementation():
    """Classes of expressions that aren't made of others are compiled by something; operations have their columns."""
    from tagweave.plans.compile import OPERATIONS

    made = {L.Node, L.Objects, L.Scalar, L.Const, L.Call, L.Aggregate}  # the compiler's own

    def below(k):
        return {k}.union(*[below(s) for s in k.__subclasses__()])

    for k in below(L.Node) - made:
        if k.__module__ == L.__name__:
            assert implementation(k.__new__(k)) is not None, k
    assert L.CONDITIONS | L.ASSOCIATIVE <= set(OPERATIONS)
    assert set(terms.MEASURES) >= {"area", "n_verts", "convexity", "aspect_ratio", "intersection", "shared_length", "shared_n_verts", "focus_score", "angle_alignment", "accessibility"}


def test_measures_under_a_filter_are_worked_out_for_what_passes_it(spark, monkeypatch):
    """Quantifiers over one set share its members, but a dear measure isn't made for those that only others ask for."""
    seen, real = [], terms.plane.overlays
    monkeypatch.setattr(terms.plane, "overlays", lambda a, b, *more: (seen.append({r.key for r in a.collect()}), real(a, b, *more))[1])
    room, rug = scene()["room"], scene()["rug"]
    program = L.Problem({"large": room.all(lambda r: r.measure("area") >= 12)}, {"bent": room.sum(lambda r: r.measure("convexity")), "covered": rug.mean(lambda r: r.measure("intersection", room))})
    got = {r["name"]: r.value for r in evaluate(program, house(spark, 0.6)).collect()}
    assert got == {"large": 0, "bent": pytest.approx(2 + 20.5 / 16), "covered": pytest.approx(10)} and seen == [{"rug"}]
    # in both, it is made once for what passes either
    both = L.Problem({}, {"rugs": rug.sum(lambda r: r.measure("intersection", room)), "rooms": room.sum(lambda r: 2 * r.measure("intersection", room)), "things": scene()["thing"].sum(lambda t: t.measure("focus_score", scene()["tv"]))})
    got = {r["name"]: r.value for r in evaluate(both, house(spark, 0.0)).collect()}
    assert (got["rugs"], got["rooms"]) == pytest.approx((10, 2 * (12 + 16 + 12))) and seen[1:] == [{"rug", "kitchen", "hall", "bath"}]


def test_filters_of_outer_loops_hold_in_inner_ones(spark):
    """What isn't worked out for an entity isn't divided by either."""
    room, rug, thing = scene()["room"], scene()["rug"], scene()["thing"]
    on = Relation("supported_by")
    program = L.Problem({}, {
        "shares": room.sum(lambda r: room.sum(lambda t: t.measure("area") / r.measure("area"))), "rugs": rug.sum(lambda r: room.sum(lambda t: 1 / r.measure("area"))),
        "held": room.sum(lambda r: thing.related_to(r, on).sum(lambda t: r.measure("area"))), "free": scene()["chair"].sum(lambda t: 7 / t.measure("accessibility", thing, 2.0)),
        "none": scene()["nothing"].mean(lambda r: 1 / r.measure("area")), "all": rug.sum(lambda r: rug.sum(lambda t: t.measure("intersection", room) / r.measure("area"))),
    })
    got = {r["name"]: r.value for r in evaluate(program, house(spark, 0.0)).collect()}
    assert got == pytest.approx({"shares": 40 / 12 + 40 / 16 + 40 / 12, "rugs": 3 / 12, "held": 12 + 12 + 16, "free": 10, "none": 0, "all": 10 / 12})


def test_members_of_one_file_are_measured_in_many_tasks(spark, monkeypatch):
    task = F.udf(lambda p: TaskContext.get().partitionId(), "int")
    monkeypatch.setitem(terms.MEASURES, "tasks", terms._own(task, F.count_distinct, 0))
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    held = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    try:
        rows = spark.range(0, 200, 1, 1).selectExpr("concat('r', id) as name", "array('sem:room') as tags", "array(struct(0.0D as x, 0.0D as y)) as corners")
        db = Bindings(rows, rows.selectExpr("name as src", "name as dst", "'touching' as kind").where("1 = 0"))
        assert evaluate(L.Problem({}, {"tasks": scene()["room"].measure("tasks")}), db).first().value == 4
    finally:
        spark.conf.set(conf, held)


def test_a_hull_folds_each_chain_once(spark):
    p = spark.createDataFrame([([(0.0, 0.0), (2.0, 0.0), (1.0, 0.5), (1.0, 2.0), (1.0, 0.0)],), ([(1.0, 1.0)] * 2,), ([],)], "p array<struct<x: double, y: double>>")
    found = p.select(terms.hull_area(F.col("p")).alias("area"))
    assert [r.area for r in found.collect()] == [2, 0, 0]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 3  # two chains, one area
