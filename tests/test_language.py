"""The language, its compiler and its analysis."""

import math

import pytest
from pyspark.sql import functions as F

from tagweave.plans import analysis as N
from tagweave.plans import lang as L
from tagweave.plans.algebra import Domain, Relation, tags
from tagweave.plans.compile import OPERATIONS, Bindings, Compiler, evaluate, totals
from tagweave.plans.lang import Const, Problem, scalar, scene

TOUCHING = Relation("touching")


@pytest.fixture(scope="module")
def db(spark):
    rows = [
        ("chair1", True, ["sem:chair", "obj:chair1"], [], [2.0, 2.0, 2.0], [-1.0, -1.0, -1.0], [1.0, 1.0, 1.0], 0),
        ("table1", True, ["sem:table", "obj:table1"], [], [2.0, 2.0, 2.0], [2.0, -1.0, -1.0], [4.0, 1.0, 1.0], 0),
        ("sofa1", True, ["sem:sofa", "sem:seating"], ["sem:wet"], [4.0, 1.0, 2.0], [-5.0, -1.0, -1.0], [-3.0, 1.0, 1.0], 1),
        ("ghost", False, ["sem:chair"], [], [9.0, 9.0, 9.0], [0.0, 0.0, 0.0], [1.0, 1.0, 1.0], 1),
    ]
    objects = spark.createDataFrame(rows, "name string, active boolean, tags array<string>, neg_tags array<string>, dims array<double>, lows array<double>, highs array<double>, level int")
    edges = [("chair1", "table1", "touching", ["sub:bottom"], ["sub:top"]), ("sofa1", "table1", "stable_against", [], [])]
    return Bindings(objects, spark.createDataFrame(edges, "src string, dst string, kind string, child_tags array<string>, parent_tags array<string>"))


def names(db, s):
    return {r["name"] for r in Compiler(db).members(s).collect()}


def value(db, e):
    return Compiler(db).value(scalar(e)).first()[0]


def test_sets(db):
    assert names(db, scene()) == {"chair1", "table1", "sofa1"} and names(db, scene()["chair"]) == {"chair1"} and names(db, scene()["nothing"]) == set()
    assert names(db, scene()["-chair"]) == {"table1", "sofa1"} and names(db, scene().union("chair", "sofa")) == {"chair1", "sofa1"}
    assert names(db, scene().excludes("chair", "sofa")) == {"table1"} and names(db, scene()["wet"]) == set()
    assert names(db, scene().related_to(scene()["table"], TOUCHING)) == {"chair1"}
    assert names(db, scene().related_to(scene()["table"])) == {"chair1", "sofa1"}
    assert names(db, scene().related_to(scene()["table"], Relation("touching", {"sub:bottom"}))) == {"chair1"}
    assert names(db, scene().related_to(scene()["table"], Relation("touching", {"sub:back"}))) == set()
    assert names(db, scene().in_domain(Domain(tags("-table"), ((-TOUCHING, Domain(tags("table"))),)))) == {"sofa1"}
    assert names(db, scene()["sofa"].same_level()) == {"sofa1"}


def test_aggregates_of_empty_sets(db):
    none = scene()["nothing"]
    assert value(db, none.count()) == 0 and value(db, none.all(lambda x: Const(False))) is True
    assert value(db, none.sum(lambda x: x.count())) == 0 and value(db, none.mean(lambda x: x.count())) == 0
    assert value(db, none.volume()) == 0 and value(db, none.distance(scene())) == 0


def test_numbers(db):
    assert value(db, scene().count()) == 3 and value(db, scene()["chair"].distance(scene()["table"])) == 1
    assert value(db, scene()["chair"].distance(scene()["sofa"]) + scene()["chair"].distance(scene()["table"])) == 3
    assert value(db, scene().mean(lambda x: x.related_to(scene()["table"]).count())) == pytest.approx(2 / 3)
    assert value(db, scene().sum(lambda x: scene().related_to(x).count())) == 2
    assert value(db, scene()["sofa"].volume(2)) == pytest.approx(8) and value(db, scene()["sofa"].volume((0, 2))) == pytest.approx(4)
    nested = scene()["table"].sum(lambda t: scene().related_to(t).sum(lambda c: c.distance(t)))
    assert value(db, nested) == pytest.approx(1 + 5)


@pytest.mark.parametrize(
    ("expr", "want"),
    [
        (lambda a, b, c: b / c, 2 / 3), (lambda a, b, c: b**c, 8), (lambda a, b, c: a + b + c, 6), (lambda a, b, c: a - c, -2), (lambda a, b, c: -b, -2), (lambda a, b, c: abs(a - c), 2),
        (lambda a, b, c: a < b, True), (lambda a, b, c: a >= b, False), (lambda a, b, c: a.equals(a), True), (lambda a, b, c: a != a, False),
        (lambda a, b, c: c.clamp_max(2), 2), (lambda a, b, c: a.clamp_min(2), 2), (lambda a, b, c: c.clip(0, 2), 2), (lambda a, b, c: b.log(), math.log(2)),
        (lambda a, b, c: (a - a).log(), -math.inf), (lambda a, b, c: (a - a).safediv(a - a), 0), (lambda a, b, c: a.safediv(a - a), 1), (lambda a, b, c: a.safediv(b), 0.5),
        (lambda a, b, c: a.hinge(0, 2), 0), (lambda a, b, c: a.hinge(2, 3), 1), (lambda a, b, c: b.hinge(0, 1.5), 0.5), (lambda a, b, c: b.minimize(3), 6), (lambda a, b, c: b.maximize(3), -6),
        (lambda a, b, c: b.in_range(1, 3), True), (lambda a, b, c: (a < b) * (b < c), True), (lambda a, b, c: (a > b) + (b < c), True), (lambda a, b, c: ~(a < b), False),
        (lambda a, b, c: a.rand("bern", 0.25), -math.log(0.25)), (lambda a, b, c: b.rand("cat", [0.5, 0.5]), -math.log(1e-100)), (lambda a, b, c: sum([a, b]), 3), (lambda a, b, c: L.max_expr(a, c, b), 3),
    ],
)
def test_scalar_operations(db, expr, want):
    assert value(db, expr(Const(1), Const(2), Const(3))) == pytest.approx(want)


@pytest.mark.parametrize(
    ("e", "want"),
    [
        (lambda a, b: b < b, 1), (lambda a, b: a.equals(b), 2), (lambda a, b: b <= a, 2), (lambda a, b: b < a, 3), (lambda a, b: a >= b * 2, 5), (lambda a, b: a != b, 1), (lambda a, b: a != a, 0),
        (lambda a, b: (b <= a) * (b < a), 5), (lambda a, b: (b <= a) + (b < a), 2), (lambda a, b: ~(a < b), 1), (lambda a, b: ~(b < a), 0), (lambda a, b: a * 0.5 > b, 1), (lambda a, b: b.in_range(4, 9), 1),
    ],
)
def test_violations(db, e, want):
    assert value(db, L.violation(e(Const(1), Const(3)))) == want


@pytest.mark.parametrize(("n", "ranged", "most3", "least3", "is3"), [(0, 1, 0, 3, 3), (1, 0, 0, 2, 2), (3, 0, 0, 0, 0), (4, 1, 1, 0, 1), (6, 3, 3, 0, 3)])
def test_violations_of_counts(spark, n, ranged, most3, least3, is3):
    rows = [(f"c{k}", ["sem:chair"]) for k in range(n)]
    db = Bindings(spark.createDataFrame(rows, "name string, tags array<string>"), spark.createDataFrame([], "src string, dst string, kind string"))
    c = scene()["chair"].count()
    out = {r["name"]: r["value"] for r in evaluate(Problem({"a": c.in_range(1, 3), "b": c <= 3, "c": c >= 3, "d": c.equals(3)}, [c]), db).collect()}
    assert (out["a"], out["b"], out["c"], out["d"], out["0"]) == (ranged, most3, least3, is3, n)
    assert totals(evaluate(Problem([c <= 3], [c]), db)).first().asDict() == {"loss": n, "viol_count": most3}


def test_building():
    a = Const(1)
    assert (a + 2 + 3).size() == 4 and len((a * 2 * 3).args) == 3
    with pytest.raises(ValueError):
        scalar("text")
    with pytest.raises(TypeError):
        bool(a < 2)
    p = Problem({"ab": a < 2, "b": a < 3}, [a])
    assert list(p.filter("a").constraints) == ["ab"] and list(p.filter_names(["b"]).constraints) == ["ab", "b"] and list(p.terms) == ["0"]
    assert {n.op for n in [a + 1, a.log()]} <= OPERATIONS.keys()

    @L.method(L.Scalar)
    def twice(self):
        return self * 2

    assert a.twice().op == "mul"


def test_bounds():
    c = scene()["chair"].count()
    b = lambda e: [(x.low, x.high) for x in N.bounds(e)]
    assert b(c < 4) == [(None, 3)] and b(c > 0) == [(1, None)] and b(4 > c) == [(None, 3)] and b(c.equals(2)) == [(2, 2)] and b((c * 2 + 2).in_range(2, 10)) == [(0, 4)]
    assert b(10 - c >= 4) == [(None, 6)] and b(c - 1 <= 4) == [(None, 5)] and b((c >= 1) * (c <= 2)) == [(1, None), (None, 2)] and b(c / 2 <= 3) == [(None, 6)] and b(c != 3) == [] and b(c < c) == []
    nested = scene()["room"].all(lambda r: scene()["chair"].related_to(r).count() >= 2)
    (one,) = N.bounds(nested)
    assert one.low == 2 and one.domain == Domain(tags("chair"), ((Relation(), Domain(tags("room"))),))
    assert [x.low for x in N.bounds(Problem([c >= 1, c >= 2]))] == [1, 2]


def test_partition():
    chairs, cups = scene()["chair", "-cup"].count(), scene()["cup", "-chair"].count()
    dom = Domain(tags("chair"))
    assert N.same(N.partition((chairs >= 1) * (cups >= 1), dom), chairs >= 1) and N.partition(cups >= 1, dom) is None
    p = N.filtered(Problem({"a": chairs >= 1, "b": cups >= 1}, {"s": chairs + cups}), dom)
    assert list(p.constraints) == ["a"] and N.same(p.terms["s"], chairs)
    assert N.relevant(chairs, dom) and not N.relevant(cups, dom) and N.is_constant(Const(1) + 2) and not N.is_constant(chairs)
    assert N.same(scene().all(lambda x: x.count() > 1), scene().all(lambda y: y.count() > 1)) and not N.same(chairs, cups)


def test_partition_keeps_what_a_domain_sees(db):
    """Over a database with only the domain's entities, the part and the whole give the same."""
    chairs, cups = scene()["chair", "-cup"].count(), scene()["cup", "-chair"].count()
    whole = (chairs >= 3) * (cups <= 1)
    part = N.partition(whole, Domain(tags("chair")))
    assert value(db, L.violation(whole)) == value(db, L.violation(part)) == 2


def test_substitutions_and_checks():
    d = Domain(tags("cup"), ((Relation("touching"), Domain(tags("var:x"))),))
    out = list(N.substitutions(d, {next(iter(tags("var:x"))): ["a", "b", "c"]}))
    assert len(out) == 3 and all(o.finalized() for o in out)
    stages = {"large": Domain(tags("large", "-small")), "small": Domain(tags("small", "-large"))}
    good = Problem([scene()["large"].count() >= 1])
    assert N.check(good, stages) == []
    assert any("overlap" in x for x in N.check(good, stages | {"any": Domain()}))
    assert any("contradictory" in x for x in N.check(Problem([scene()["large"]["-large"].count() >= 1]), stages))
    assert any("no stage" in x for x in N.check(Problem([scene()["large", "small"].count() >= 1]), stages))


def test_nodes_can_be_registered(spark):
    """A set and a scalar of one's own, and an error for what has no implementation."""
    from dataclasses import dataclass

    from tagweave.plans import lang as L
    from tagweave.plans.compile import implementation, register

    @dataclass(frozen=True)
    class Named(L.Objects):
        objs: L.Objects
        part: str

        def children(self):
            return (self.objs,)

    @dataclass(frozen=True, eq=False)
    class Longest(L.Scalar):
        objs: L.Objects
        kind = int

        def children(self):
            return (self.objs,)

    entities = spark.createDataFrame([("a1", ["sem:a"]), ("a22", ["sem:a"]), ("b1", ["sem:b"])], "name string, tags array<string>")
    edges = spark.createDataFrame([("a1", "b1", "touching"), ("a22", "b1", "touching")], "src string, dst string, kind string")
    database = Bindings(entities, edges)
    with pytest.raises(TypeError):
        Compiler(database).members(Named(scene(), "2"))
    with pytest.raises(TypeError):
        evaluate(L.Problem({}, {"x": Longest(scene())}), database)

    @register(Named)
    def named(compiler, node):
        return compiler.members(node.objs).where(F.contains("name", F.lit(node.part)))

    @register(Longest)
    def longest(compiler, node):
        return compiler.members(node.objs).groupBy(*sorted(node.free())).agg(F.max(F.length("name")).alias("value")), F.lit(0)

    touching = L.Related(scene()["a"], scene()["b"], Relation("touching"))
    program = L.Problem({}, {"n": Named(scene()["a"], "2").count(), "l": Longest(touching), "each": scene()["b"].sum(lambda b: Longest(scene()["a"].related_to(b, Relation("touching"))) + 1), "none": Longest(scene()["c"])})
    assert {r["name"]: r.value for r in evaluate(program, database).collect()} == {"n": 1, "l": 3, "each": 4, "none": 0}
    for node in (L.Scene(), L.Item("x"), scene()["a"], scene().union("a"), scene().in_domain(Domain()), scene().same_level(), touching, L.Distance(scene(), scene())):
        assert implementation(node) is not None


def test_a_program_is_compiled_once(spark):
    """Aggregates of one set under many filters are one pass, and what is written twice is there once."""
    entities = spark.createDataFrame([(f"{k}{n}", [f"sem:{k}"] + (["sem:odd"] if n % 2 else []), float(n)) for k in "ab" for n in range(6)], "name string, tags array<string>, amount double")
    edges = spark.createDataFrame([(f"a{n}", f"b{n % 3}", "touching") for n in range(6)], "src string, dst string, kind string")
    near = Relation("touching")
    of = lambda b, *t: scene()["a", *t].related_to(b, near)
    body = lambda b: of(b).count() * 100 + of(b, "odd").count() * 10 + of(b, "-odd").count() + of(b).count() * 0 + of(b, "odd").total("amount") * 0
    program = Problem({"all": scene()["b"].all(lambda b: of(b).count() >= 1)}, {"sum": scene()["b"].sum(body), "odd": scene()["b", "odd"].sum(body), "mean": scene()["b"].mean(lambda b: of(b, "odd").count()), "count": scene()["a"].count() + scene()["b", "odd"].count() * 10})
    result = evaluate(program, Bindings(entities, edges))
    assert {r["name"]: r.value for r in result.collect()} == {"all": 3, "sum": 633, "odd": 211, "mean": 0.5, "count": 36}
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") <= 6
