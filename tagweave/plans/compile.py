"""Compile problems to DataFrames.

A set is a DataFrame of its members with a column for each loop variable it depends on. A scalar
inside quantifiers is worked out for all loop entities at once: its aggregates are grouped by the
loop variables that they depend on and left-joined to the quantifier's members, with the values of
empty sets filled in. Nothing is looped over and no Python runs per row, so Catalyst sees one
relational plan: semi joins for relations, partial aggregation before every shuffle.

A program is compiled once. Filters by tags are peeled off its sets, so that aggregates of one set
under different filters become conditional aggregates of one pass; quantifiers over one set get
one variable and share its members, and what stands under a filter is worked out for those alone
that pass it; what is written twice is worked out once.

``register`` adds an implementation for a class of sets or of scalars, in this module or elsewhere.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, fields, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.operators.solids import box_gaps
from tagweave.plans import lang as L
from tagweave.plans.algebra import SEMANTICS, Domain, Relation, decompose, implied_kinds, satisfied_by

EMPTY = {"count": 0, "volume": 0.0, "total": 0.0, "sum": 0.0, "mean": 0.0, "all": True}
#: What compiles each class of sets (compiler, node) -> members, and of scalars that aren't made of others
#: (compiler, node) -> (rows of its free variables and ``value``, the value where there is no row).
IMPLEMENTATIONS: dict[type, Callable] = {}


def register(node: type) -> Callable:
    """Register the decorated function for a class of nodes; subclasses without one of their own use it too."""

    def put(f: Callable) -> Callable:
        IMPLEMENTATIONS[node] = f
        return f

    return put


def implementation(node: L.Node) -> Callable | None:
    return next((IMPLEMENTATIONS[c] for c in type(node).__mro__ if c in IMPLEMENTATIONS), None)


@dataclass(frozen=True)
class Bindings:
    """The database: entities (name, tags and, as needed, neg_tags, active, dims, lows, highs, level, class and other
    attributes; an entity has the tag of its class, and no other class's) and relations (src, dst, kind and, as needed, child_tags and parent_tags)."""

    objects: DataFrame
    relations: DataFrame
    #: Names of the classes, if the entities have one.
    classes: frozenset[str] = frozenset()
    #: Whether no two relations of one kind lead from one entity to the same other one.
    single_edges: bool = False

    def active(self) -> DataFrame:
        return self.objects.where("active") if "active" in self.objects.columns else self.objects


def implies_column(relation: Relation, edges: DataFrame) -> Column:
    """Whether a stored relation implies ``relation``: classes by a list of kinds, sides by their tags."""
    kinds = [k for k in ("geometry", "touching", "supported_by", "coplanar", "stable_against", "room_neighbour", "cut_from", "shared_edge", "traverse") if relation.kind in implied_kinds(k)]
    out = edges["kind"].isin(kinds)
    for side, asked in (("child_tags", relation.child), ("parent_tags", relation.parent)):
        if asked:
            out = out & satisfied_by(asked, edges[side])
    return ~out if relation.negated else out


def intersects_column(relation: Relation, edges: DataFrame) -> Column:
    """Whether a stored relation and ``relation`` can hold together: no tag of one is denied by the other."""
    bare = Relation(relation.kind, connectors=relation.connectors)
    out = implies_column(bare, edges)
    for side, asked in (("child_tags", relation.child), ("parent_tags", relation.parent)):
        bars = decompose(asked)[1]
        if bars:
            out = out & satisfied_by(frozenset(-t for t in bars), edges[side])
    return out


@dataclass(frozen=True)
class Filter:
    """A test of a set's members by their own columns, peeled off a set."""

    what: str
    of: frozenset | Domain


def peeled(s: L.Objects) -> tuple[L.Objects, tuple[Filter, ...]]:
    """The set without the filters that look at nothing but its members, and these; through relations of the members too."""
    if isinstance(s, L.AnyTagged):
        base, filters = peeled(s.objs)
        return base, (*filters, Filter("any", s.tags))
    if isinstance(s, L.Tagged):
        base, filters = peeled(s.objs)
        return base, (*filters, Filter("tags", s.tags))
    if isinstance(s, L.InDomain) and not s.domain.relations:
        base, filters = peeled(s.objs)
        return base, (*filters, Filter("tags", s.domain.tags))
    if isinstance(s, L.Related):
        base, filters = peeled(s.objs)
        return replace(s, objs=base), filters
    return s, ()


def _part(e: L.Node, change: Callable) -> L.Node:
    """The node with ``change`` made to the nodes that it is made of."""
    new = {}
    for f in fields(e):
        v = getattr(e, f.name)
        if isinstance(v, L.Node):
            new[f.name] = change(v)
        elif isinstance(v, tuple) and v and all(isinstance(x, L.Node) for x in v):
            new[f.name] = tuple(map(change, v))
    return replace(e, **new) if new else e


def shape(e: L.Node):
    """A key that is equal for nodes that are written alike."""
    if isinstance(e, L.Objects):
        return e
    own = []
    for f in fields(e):
        v = getattr(e, f.name)
        own.append(shape(v) if isinstance(v, L.Node) else tuple(map(shape, v)) if isinstance(v, tuple) and v and isinstance(v[0], L.Node) else (type(v), v))
    return (type(e), *own)


class Compiler:
    """Compiles expressions over one database."""

    def __init__(self, database: Bindings):
        self.db = database
        #: For each loop variable the set it runs over, without filters, and the filters that its quantifiers have.
        self.loops: dict[str, L.Objects] = {}
        self.filters: dict[str, list[tuple[Filter, ...]]] = {}
        self.variables: dict = {}
        #: For loop variables the filters, by their places, under which what is compiled now is asked for; without an entry, all.
        self.asked: dict[str, frozenset[int]] = {}

    # sets

    def members(self, s: L.Objects) -> DataFrame:
        """Members of ``s`` with their attributes, and a column for each of its free variables."""
        how = implementation(s)
        if how is None:
            raise TypeError(f"no implementation for {type(s).__name__}")
        return how(self, s)

    def test(self, filters: tuple[Filter, ...], rows: DataFrame) -> Column:
        """The filters as one condition. A class that is asked for is a plain comparison: it reaches the scans and drops whole tables."""
        out = F.lit(True)
        denied = rows["neg_tags"] if "neg_tags" in rows.columns else None
        for f in filters:
            asks, bars = decompose(f.of)
            if f.what == "any":
                stored = F.arrays_overlap(F.array(*[F.lit(str(t)) for t in sorted(asks)]).cast("array<string>"), rows["tags"])
                out = out & reduce(lambda a, b: a | b, [~F.array_contains(rows["tags"], str(t)) for t in sorted(bars)], stored)
                continue
            of_class = [t for t in asks if t.kind == SEMANTICS and t.name in self.db.classes] if "class" in rows.columns else []
            for t in of_class:  # an entity has the tag of its class and of no other
                out = out & (rows["class"] == t.name)
            rest = f.of - frozenset(of_class)
            if rest:
                out = out & satisfied_by(rest, rows["tags"], denied)
        return out

    def filtered(self, rows: DataFrame, filters: list[tuple[Filter, ...]]) -> DataFrame:
        """Rows that pass some of the filters, if none of them lets all pass."""
        return rows.where(reduce(lambda a, b: a | b, [self.test(f, rows) for f in filters])) if filters and all(filters) else rows

    def in_domain(self, rows: DataFrame, domain: Domain) -> DataFrame:
        """Rows whose entity is in the domain: tags, then a semi join for each relation and an anti join for each denied one."""
        out = rows.where(self.test((Filter("tags", domain.tags),), rows))
        for rel, inner in domain.relations:
            edges = self.db.relations
            asked = -rel if rel.negated else rel
            edges = edges.where(intersects_column(asked, edges)).select("src", "dst")
            ends = self.in_domain(self.db.active(), inner).select(F.col("name").alias("end_name"))
            heads = edges.join(ends, F.col("dst") == F.col("end_name")).select(F.col("src").alias("head"))
            out = out.join(heads, F.col("name") == F.col("head"), "left_anti" if rel.negated else "left_semi")
        return out

    @contextmanager
    def asking(self, variable: str | None, places: Iterable[int]):
        """What is compiled inside is needed for those entities of the variable alone that pass some of the filters at ``places``."""
        held = self.asked
        self.asked = held | {variable: frozenset(places)} if variable else held
        try:
            yield
        finally:
            self.asked = held

    def looped(self, variable: str) -> DataFrame:
        """The members of the variable's set that pass some of the filters asked for."""
        filters = self.filters[variable]
        places = sorted(self.asked.get(variable, range(len(filters))))
        return self.filtered(self.members(self.loops[variable]), [filters[n] for n in places])

    def loop(self, variable: str) -> DataFrame:
        """The members of the variable's set, under its name, with the variables that the set depends on and a flag for each filter."""
        rows = self.looped(variable)
        flags = [self.test(f, rows).alias(f"{variable}_{n}") for n, f in enumerate(self.filters[variable]) if f]
        return rows.select(*sorted(self.loops[variable].free()), F.col("name").alias(variable), *flags)

    def at(self, variable: str) -> DataFrame:
        """The entities that the variable stands for, once each."""
        rows = self.loop(variable).select(variable)
        return rows.distinct() if self.loops[variable].free() else rows  # members of a set are distinct

    def closed(self, keys: frozenset[str]) -> frozenset[str]:
        more = frozenset().union(keys, *[self.loops[k].free() for k in keys])
        return keys if more == keys else self.closed(more)

    def grid(self, keys: frozenset[str]) -> DataFrame:
        """All combinations of loop entities that the quantifiers of ``keys`` reach."""
        order = [v for v in self.loops if v in keys]
        if not order:
            return self.db.objects.sparkSession.range(1).select(F.lit(1).alias("one"))
        out = self.loop(order[0])
        for v in order[1:]:
            nxt = self.loop(v)
            shared = sorted(set(out.columns) & set(nxt.columns))
            out = out.join(nxt, shared) if shared else out.crossJoin(nxt)
        return out

    # scalars

    def unified(self, e: L.Node, names: dict[str, str], depth: int = 0) -> L.Node:
        """The expression with one variable for all quantifiers over one set at one depth; notes the sets and the filters."""
        if isinstance(e, L.Item):
            return L.Item(names.get(e.variable, e.variable))
        if not (isinstance(e, L.Aggregate) and e.variable):
            return _part(e, lambda x: self.unified(x, names, depth))
        objs = self.unified(e.objs, names, depth)
        base, filters = peeled(objs)
        variable = self.variables.setdefault((base, depth), f"v{len(self.variables)}")
        self.loops[variable] = base
        held = self.filters.setdefault(variable, [])
        if filters not in held:
            held.append(filters)
        return replace(e, objs=objs, variable=variable, body=self.unified(e.body, names | {e.variable: variable}, depth + 1))

    def aggregates(self, leaves: list[L.Aggregate], by: list[str]) -> DataFrame:
        """Aggregates of one set under different filters: one pass, a column for each."""
        filters = [peeled(e.objs)[1] for e in leaves]
        own = self.filtered(self.members(peeled(leaves[0].objs)[0]), filters)
        columns = []
        for n, (e, f) in enumerate(zip(leaves, filters, strict=True)):
            chosen = (lambda x, f=f: F.when(self.test(f, own), x)) if f else (lambda x: x)
            if e.what == "count":  # members are distinct
                value = F.count(chosen(F.lit(1)))
            elif e.what == "volume":
                value = F.sum(chosen(volume_of(F.col("dims"), e.option)))
            else:
                value = F.sum(chosen(F.col(e.option).cast("double")))
            columns.append(value.alias(f"value{n}"))
        return own.groupBy(*by).agg(*columns)

    def quantified(self, leaves: list[L.Aggregate], by: list[str]) -> DataFrame:
        """Quantifiers of one variable: their bodies together, for each of its entities, then a column for each."""
        variable, columns = leaves[0].variable, []
        places = [self.filters[variable].index(peeled(e.objs)[1]) for e in leaves]
        bodies = self.frames([e.body for e in leaves], frozenset(by) | {variable}, variable, places)
        for n, e in enumerate(leaves):
            value = F.col(f"e{n}")
            if e.what != "all":
                value = value.cast("int" if e.body.kind is bool else "bigint" if e.body.kind is int else "double")
            columns.append({"all": F.bool_and, "sum": F.sum, "mean": F.avg}[e.what](value).alias(f"value{n}"))
        return bodies.groupBy(*by).agg(*columns)

    def frames(self, exprs: list[L.Scalar], keys: frozenset[str], variable: str | None = None, places: Sequence[int] = ()) -> DataFrame:
        """The expressions as columns e0, e1, ... for every combination of the loop entities of ``keys``, beside these and their flags.

        ``places``: the filter of ``variable`` that each expression stands under; it is null for other entities, and what it is made of
        is worked out for those alone that pass the filter of some expression with it.
        """
        keys = self.closed(keys)
        with self.asking(variable, places):
            out, columns, groups = self.grid(keys), {}, {}
        flags = [c for c in out.columns if c not in keys and c != "one"]
        under: dict = {}
        for n, e in enumerate(exprs):
            for x in _leaves(e):
                under.setdefault(shape(x), (x, set()))[1].update(places[n : n + 1])
        for leaf, _ in under.values():
            by = tuple(sorted(leaf.free()))
            if type(leaf) is L.Aggregate and leaf.variable:
                groups.setdefault(("quantifier", leaf.variable, by), []).append(leaf)
            elif type(leaf) is L.Aggregate:
                groups.setdefault(("set", peeled(leaf.objs)[0], by), []).append(leaf)
            else:
                groups.setdefault((shape(leaf), None, by), []).append(leaf)
        for g, ((kind, _, by), leaves) in enumerate(groups.items()):
            with self.asking(variable, set().union(*[under[shape(e)][1] for e in leaves])):
                if kind in ("quantifier", "set"):
                    rows = (self.quantified if kind == "quantifier" else self.aggregates)(leaves, list(by))
                    empty = [F.lit(EMPTY[e.what]) for e in leaves]
                else:
                    rows, default = implementation(leaves[0])(self, leaves[0])
                    rows, empty = rows.withColumnRenamed("value", "value0"), [default]
            rows = rows.withColumnsRenamed({f"value{n}": f"g{g}_{n}_{len(keys)}" for n in range(len(leaves))})
            out = out.join(rows, list(by), "left") if by else out.crossJoin(rows)  # one row
            for n, e in enumerate(leaves):
                columns[shape(e)] = F.coalesce(F.col(f"g{g}_{n}_{len(keys)}"), empty[n])
        values = [self.column(e, columns) for e in exprs]
        for n, place in enumerate(places):
            if self.filters[variable][place]:
                values[n] = F.when(F.col(f"{variable}_{place}"), values[n])
        return out.select(*sorted(keys), *flags, *[v.alias(f"e{n}") for n, v in enumerate(values)])

    def column(self, e: L.Scalar, leaves: dict) -> Column:
        if implementation(e) is not None or isinstance(e, L.Aggregate):
            return leaves[shape(e)]
        if isinstance(e, L.Const):
            return F.lit(e.value)
        if not isinstance(e, L.Call) or e.op not in OPERATIONS:
            raise TypeError(f"no implementation for {type(e).__name__} {getattr(e, 'op', '')}")
        return OPERATIONS[e.op](e, *[self.column(a, leaves) for a in e.args])

    def values(self, exprs: list[L.Scalar]) -> DataFrame:
        """One row: columns e0, e1, ..."""
        return self.frames([self.unified(e, {}) for e in exprs], frozenset())

    def for_each(self, objs: L.Objects, body: Callable[[L.Objects], L.Scalar]) -> DataFrame:
        """Rows (name, value): the scalar that ``body`` makes of each member of a set."""
        e = self.unified(objs.sum(body), {})
        rows, place = self.frames([e.body], frozenset([e.variable])), self.filters[e.variable].index(peeled(e.objs)[1])
        rows = rows.where(F.col(f"{e.variable}_{place}")) if self.filters[e.variable][place] else rows
        return rows.select(F.col(e.variable).alias("name"), F.col("e0").alias("value"))

    def value(self, e: L.Scalar) -> DataFrame:
        """One row, one column value."""
        return self.values([e]).withColumnRenamed("e0", "value")


def _leaves(e: L.Scalar) -> list[L.Scalar]:
    if isinstance(e, L.Aggregate) or implementation(e) is not None:
        return [e]
    return [x for c in e.children() for x in _leaves(c)]


@register(L.Scene)
def _scene(c: Compiler, s: L.Scene) -> DataFrame:
    return c.db.active()


@register(L.Item)
def _item(c: Compiler, s: L.Item) -> DataFrame:
    if not c.loops[s.variable].free():  # the members have their attributes already
        return c.looped(s.variable).withColumn(s.variable, F.col("name"))
    return c.at(s.variable).join(c.db.objects, F.col(s.variable) == F.col("name"))


@register(L.Tagged)
def _tagged(c: Compiler, s: L.Tagged) -> DataFrame:
    base, filters = peeled(s)
    own = c.members(base)
    return own.where(c.test(filters, own))


@register(L.InDomain)
def _in_domain(c: Compiler, s: L.InDomain) -> DataFrame:
    return c.in_domain(c.members(s.objs), s.domain)


@register(L.SameLevel)
def _same_level(c: Compiler, s: L.SameLevel) -> DataFrame:
    levels = c.members(s.objs).select(*sorted(s.free()), F.col("level").alias("this_level")).distinct()
    return c.db.active().join(levels, F.col("level") == F.col("this_level")).drop("this_level")


@register(L.Related)
def _related(c: Compiler, s: L.Related) -> DataFrame:
    edges = c.db.relations
    edges = edges.where(implies_column(s.relation, edges)).select("src", "dst")
    child, parent = s.objs.free(), s.parents.free()
    own = c.members(s.objs)
    if isinstance(s.parents, L.Item):  # whatever isn't one of its entities meets no row of the loop
        heads = edges.select("src", F.col("dst").alias(f"p_{s.parents.variable}"))
    else:
        ends = c.members(s.parents).select(F.col("name").alias("parent_name"), *[F.col(k).alias(f"p_{k}") for k in sorted(parent)])
        heads = edges.join(ends, F.col("dst") == F.col("parent_name")).select("src", *[f"p_{k}" for k in sorted(parent)])
    on = own["name"] == F.col("src")
    for k in sorted(child & parent):
        on = on & (own[k] == F.col(f"p_{k}"))
    new = sorted(parent - child)
    if not new:
        return own.join(heads, on, "left_semi")
    heads = heads if c.db.single_edges and isinstance(s.parents, L.Item) else heads.distinct()
    return own.join(heads, on).select(*[own[x] for x in own.columns], *[F.col(f"p_{k}").alias(k) for k in new])


@register(L.Distance)
def _distance(c: Compiler, e: L.Distance) -> tuple[DataFrame, Column]:
    """Least distance of boxes [lows, highs]; an entity isn't compared with itself. Empty sets are at 0.

    Pairs of cells of boxes go by their bounds before boxes meet, within groups of the variables that both depend on.
    """
    side = lambda s: c.members(s).select(*sorted(s.free()), "name", "lows", "highs")
    rows = box_gaps(side(e.objs), side(e.others))
    return (rows if e.free() else rows.agg(F.min("value").alias("value"))), F.lit(0.0)  # outside of loops always one row


def volume_of(dims: Column, option: int | tuple[int, ...]) -> Column:
    """Product of the largest ``option`` extents (or of those at its places), and a little."""
    ordered = F.sort_array(dims.cast("array<double>"), asc=False)
    chosen = F.slice(ordered, 1, option) if isinstance(option, int) else F.array(*[F.get(ordered, F.lit(k)) for k in option])
    return F.aggregate(chosen, F.lit(1.0), lambda a, b: a * b) + 1e-10


def _number(kind: type) -> str:
    return "bigint" if kind in (int, bool) else "double"


def _numeric(fold):
    """Arithmetic in the expression's own number type."""
    return lambda e, *a: reduce(fold, [x.cast(_number(e.kind)) for x in a])


def _double(x: Column) -> Column:
    return x.cast("double")


def _likelihood(e, x, *chances):
    p = [c.value for c in e.args[1:]]
    out = [1 - p[0], p[0]] if e.op == "rand_bern" else [c + 1e-20 for c in p]
    value = F.lit(-math.log(1e-100))
    for n, c in enumerate(out):
        value = F.when(x == n, F.lit(-math.log(max(c, 1e-100)))).otherwise(value)
    return value


#: Columns of the operations. Division raises on a zero divisor, as ANSI mode does; safediv has its own rule.
OPERATIONS = {
    "add": _numeric(lambda a, b: a + b),
    "sub": _numeric(lambda a, b: a - b),
    "mul": _numeric(lambda a, b: a * b),
    "div": lambda e, a, b: _double(a) / _double(b),
    "safediv": lambda e, a, b: F.when(b == 0, F.when(a == 0, 0.0).otherwise(1.0)).otherwise(F.try_divide(_double(a), _double(b))),
    "pow": lambda e, a, b: F.pow(_double(a), _double(b)),
    "abs": lambda e, a: F.abs(a),
    "log": lambda e, a: F.when(a == 0, F.lit(float("-inf"))).when(a < 0, F.lit(float("nan"))).otherwise(F.ln(_double(a))),
    "max": lambda e, *a: F.greatest(*[x.cast(_number(e.kind)) for x in a]),
    "min": lambda e, *a: F.least(*[x.cast(_number(e.kind)) for x in a]),
    "eq": lambda e, a, b: a == b,
    "ne": lambda e, a, b: a != b,
    "lt": lambda e, a, b: a < b,
    "le": lambda e, a, b: a <= b,
    "gt": lambda e, a, b: a > b,
    "ge": lambda e, a, b: a >= b,
    "and": lambda e, *a: reduce(lambda x, y: x & y, a),
    "or": lambda e, *a: reduce(lambda x, y: x | y, a),
    "not": lambda e, a: ~a,
    "in_range": lambda e, x, low, high: (x >= low) & (x <= high),
    "hinge": lambda e, x, low, high: F.greatest(_double(low) - _double(x), _double(x) - _double(high), F.lit(0.0)),
    "as_number": lambda e, a: a.cast("int").cast("bigint") if e.args[0].kind is bool else a,
    "rand_bern": _likelihood,
    "rand_cat": _likelihood,
}


def evaluate(problem: L.Problem, database: Bindings, concerning: Domain | None = None) -> DataFrame:
    """Rows (name, kind, value): each constraint's violation and each term's score, all from one plan.

    ``concerning``: what can't hold an entity of this domain isn't worked out, and is 0.
    """
    if concerning is not None:
        from tagweave.plans.analysis import relevant

        still = lambda given: {k: v if relevant(v, concerning) else L.scalar(v.kind is bool) if v.kind is bool else L.scalar(0.0) for k, v in given.items()}
        problem = L.Problem(still(problem.constraints), still(problem.terms))
    rows = [(k, "violation", L.violation(v)) for k, v in problem.constraints.items()] + [(k, "loss", v) for k, v in problem.terms.items()]
    if not rows:
        return database.objects.sparkSession.createDataFrame([], "name string, kind string, value double")
    number = lambda n, e: F.col(f"e{n}").cast("int" if e.kind is bool else "double").cast("double")
    parts = [F.struct(F.lit(name).alias("name"), F.lit(kind).alias("kind"), number(n, e).alias("value")) for n, (name, kind, e) in enumerate(rows)]
    return Compiler(database).values([e for _, _, e in rows]).select(F.inline(F.array(*parts)))


def totals(result: DataFrame) -> DataFrame:
    """One row: the sum of violations and the sum of losses."""
    of = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("value"))), F.lit(0.0))
    return result.agg(of("loss").alias("loss"), of("violation").alias("viol_count"))
