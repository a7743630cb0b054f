"""The expression language: sets of entities, scalars and conditions over them, and named problems.

Expressions are small immutable trees built by a fluent API; nothing runs until a problem is
compiled (``compile.py``) into one DataFrame.

    scene()["chair"].related_to(scene()["table"], touching).count().in_range(1, 4)
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from itertools import count as _numbers

from tagweave.plans.algebra import ANY, Domain, Relation, Tag, decompose, tags

_variables = _numbers()
#: Operations whose nested uses are one: their arguments are merged. Either-or stays as it was written.
ASSOCIATIVE = frozenset(["add", "mul", "and", "max", "min"])
COMPARISONS = frozenset(["eq", "ne", "lt", "le", "gt", "ge"])
CONDITIONS = COMPARISONS | {"and", "or", "not", "in_range"}


class Node:
    """Any expression."""

    def children(self) -> tuple[Node, ...]:
        return ()

    def traverse(self) -> Iterator[Node]:
        yield self
        for c in self.children():
            yield from c.traverse()

    def free(self) -> frozenset[str]:
        """Variables that stand in the expression without a quantifier for them."""
        return frozenset().union(*[c.free() for c in self.children()])

    def __bool__(self) -> bool:
        raise TypeError("an expression has no truth value before it is evaluated; combine conditions with *, + and ~")

    def size(self) -> int:
        return sum(1 for _ in self.traverse())


# sets ---------------------------------------------------------------------------------------------


class Objects(Node):
    """A set of entities."""

    def tagged(self, *given) -> Objects:
        """Those with all positive tags and none of the negative ones."""
        return Tagged(self, tags(*given))

    def __getitem__(self, given) -> Objects:
        return self.tagged(*(given if isinstance(given, tuple) else (given,)))

    def union(self, *given) -> Objects:
        """Those with any of the tags."""
        return AnyTagged(self, tags(*given))

    def __mod__(self, given) -> Objects:
        return self.union(given)

    def excludes(self, *given) -> Objects:
        """Those without the tags; tags that the set already asks for are left out of the question."""
        asked = self.tags if isinstance(self, Tagged) else frozenset()
        return self.tagged(frozenset(-t for t in tags(*given) - asked))

    def related_to(self, parents: Objects, relation: Relation = ANY) -> Objects:
        """Those with a relation to one of ``parents`` that implies ``relation``."""
        return Related(self, parents, relation)

    def in_domain(self, domain: Domain) -> Objects:
        return InDomain(self, domain)

    def same_level(self) -> Objects:
        """All entities on the level of any of these, by the number in their names."""
        return SameLevel(self)

    def count(self) -> Scalar:
        return Aggregate("count", self)

    def volume(self, dims: int | tuple[int, ...] = 3) -> Scalar:
        """Sum of the products of the largest ``dims`` extents, or of those at the places ``dims`` of the sorted ones."""
        return Aggregate("volume", self, option=dims)

    def total(self, column: str) -> Scalar:
        """Sum of a numeric attribute."""
        return Aggregate("total", self, option=column)

    def measure(self, what: str, others: Objects | None = None, option: float | str | None = None) -> Scalar:
        """A term of ``plans.terms``: area, n_verts, shared_length and the like."""
        return Measure(what, self, others, option)

    def distance(self, others: Objects) -> Scalar:
        """Least distance between boxes of the two sets; 0 if either is empty."""
        return Distance(self, others)

    def all(self, body: Callable[[Objects], Scalar]) -> Scalar:
        return self._over("all", body)

    def sum(self, body: Callable[[Objects], Scalar]) -> Scalar:
        return self._over("sum", body)

    def mean(self, body: Callable[[Objects], Scalar]) -> Scalar:
        return self._over("mean", body)

    def _over(self, kind: str, body) -> Scalar:
        name = f"x{next(_variables)}"
        return Aggregate(kind, self, name, scalar(body(Item(name))))


@dataclass(frozen=True)
class Scene(Objects):
    """All active entities."""


@dataclass(frozen=True)
class Item(Objects):
    """The entity that a quantifier is at."""

    variable: str

    def free(self) -> frozenset[str]:
        return frozenset([self.variable])


@dataclass(frozen=True)
class Tagged(Objects):
    objs: Objects
    tags: frozenset[Tag]

    def children(self):
        return (self.objs,)


@dataclass(frozen=True)
class AnyTagged(Tagged):
    pass


@dataclass(frozen=True)
class Related(Objects):
    objs: Objects
    parents: Objects
    relation: Relation

    def children(self):
        return (self.objs, self.parents)


@dataclass(frozen=True)
class InDomain(Objects):
    objs: Objects
    domain: Domain

    def children(self):
        return (self.objs,)


@dataclass(frozen=True)
class SameLevel(Objects):
    objs: Objects

    def children(self):
        return (self.objs,)


def scene() -> Objects:
    return Scene()


# scalars and conditions ---------------------------------------------------------------------------


class Scalar(Node):
    """A number or a condition. On conditions ``*`` is and, ``+`` is or, ``~`` is not."""

    #: int, float or bool, from the expression alone.
    kind: type = float

    def _with(self, op: str, other, swap: bool = False) -> Scalar:
        a, b = (scalar(other), self) if swap else (self, scalar(other))
        return call(op, a, b)

    def __add__(self, o):
        return self._with("or" if self.kind is bool else "add", o)

    def __radd__(self, o):
        return self if isinstance(o, int) and o == 0 else self._with("add", o, True)

    def __mul__(self, o):
        return self._with("and" if self.kind is bool else "mul", o)

    def __rmul__(self, o):
        return self._with("mul", o, True)

    def __sub__(self, o):
        return self._with("sub", o)

    def __rsub__(self, o):
        return self._with("sub", o, True)

    def __truediv__(self, o):
        return self._with("div", o)

    def __rtruediv__(self, o):
        return self._with("div", o, True)

    def __pow__(self, o):
        return self._with("pow", o)

    def __neg__(self):
        return self * -1

    def __abs__(self):
        return call("abs", self)

    def __invert__(self):
        return call("not", self)

    def __eq__(self, o):
        return self._with("eq", o)

    def __ne__(self, o):
        return self._with("ne", o)

    def __lt__(self, o):
        return self._with("lt", o)

    def __le__(self, o):
        return self._with("le", o)

    def __gt__(self, o):
        return self._with("gt", o)

    def __ge__(self, o):
        return self._with("ge", o)

    __hash__ = object.__hash__

    def equals(self, o) -> Scalar:
        return self == o

    def safediv(self, o) -> Scalar:
        """a / b; where b is 0: 0 if a is 0, else 1."""
        return self._with("safediv", o)

    def log(self) -> Scalar:
        """Natural logarithm; minus infinity at 0, not a number below."""
        return call("log", self)

    def clamp_min(self, o) -> Scalar:
        return self._with("max", o)

    def clamp_max(self, o) -> Scalar:
        return self._with("min", o)

    def clip(self, low=float("-inf"), high=float("inf")) -> Scalar:
        return self.clamp_min(low).clamp_max(high)

    def minimize(self, weight=1) -> Scalar:
        return self * weight

    def maximize(self, weight=1) -> Scalar:
        return self * -weight

    def in_range(self, low=0, high=2**31 - 1, mean=None) -> Scalar:
        """low <= x <= high; ``mean`` is for samplers only."""
        return call("in_range", self, low, high)

    def hinge(self, low, high) -> Scalar:
        """Distance to [low, high]."""
        return call("hinge", self, low, high)

    def rand(self, kind: str, chances) -> Scalar:
        """Negative log likelihood of this count: ``bern`` with a chance, ``cat`` with a list of them."""
        return call("rand_" + kind, self, *[float(c) for c in (chances if isinstance(chances, list | tuple) else [chances])])

    def debugprint(self, message: str = "") -> Scalar:
        return self


@dataclass(frozen=True, eq=False)
class Const(Scalar):
    value: bool | int | float

    def __post_init__(self):
        if type(self.value) not in (bool, int, float):
            raise ValueError(f"no constant: {self.value!r}")

    @property
    def kind(self):
        return type(self.value)


@dataclass(frozen=True, eq=False)
class Call(Scalar):
    op: str
    args: tuple[Scalar, ...]

    def children(self):
        return self.args

    @property
    def kind(self):
        if self.op in CONDITIONS:
            return bool
        whole = self.op in ("add", "sub", "mul", "max", "min", "abs", "as_number") and all(a.kind in (int, bool) for a in self.args)
        return int if whole else float


@dataclass(frozen=True, eq=False)
class Aggregate(Scalar):
    """count, volume or total of a set, or all, sum or mean of ``body`` with ``variable`` at each member."""

    what: str
    objs: Objects
    variable: str | None = None
    body: Scalar | None = None
    option: object = None

    def children(self):
        return (self.objs, self.body) if self.body is not None else (self.objs,)

    def free(self):
        inner = self.body.free() - {self.variable} if self.body is not None else frozenset()
        return self.objs.free() | inner

    @property
    def kind(self):
        if self.what == "all":
            return bool
        return int if self.what == "count" or (self.what == "sum" and self.body.kind in (int, bool)) else float


@dataclass(frozen=True, eq=False)
class Distance(Scalar):
    objs: Objects
    others: Objects

    def children(self):
        return (self.objs, self.others)


@dataclass(frozen=True, eq=False)
class Measure(Scalar):
    """A measure of a set's entities by their shapes, or of how they stand to ``others``; ``plans.terms`` has what there is."""

    what: str
    objs: Objects
    others: Objects | None = None
    option: float | str | None = None

    def children(self):
        return (self.objs,) if self.others is None else (self.objs, self.others)

    @property
    def kind(self):
        return int if self.what in ("n_verts", "shared_n_verts", "grid_line_count") else float


def scalar(value) -> Scalar:
    """Literals become constants; anything but bool, int, float and scalars is an error."""
    return value if isinstance(value, Scalar) else Const(value)


def call(op: str, *args) -> Scalar:
    """An operation, its nested uses merged where that changes nothing."""
    args = tuple(scalar(a) for a in args)
    if op in ASSOCIATIVE:
        args = tuple(x for a in args for x in (a.args if isinstance(a, Call) and a.op == op else (a,)))
    return Call(op, args)


def max_expr(*args) -> Scalar:
    return call("max", *args)


def min_expr(*args) -> Scalar:
    return call("min", *args)


def method(cls: type, name: str | None = None):
    """Register a function as a further method of an expression class."""

    def put(f):
        setattr(cls, name or f.__name__, f)
        return f

    return put


# problems -----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Problem:
    """Named hard constraints and soft score terms; lists are named by their places."""

    constraints: dict[str, Scalar]
    terms: dict[str, Scalar]

    def __init__(self, constraints=(), terms=()):
        named = lambda x: dict(x) if isinstance(x, dict) else {str(n): v for n, v in enumerate(x)}
        object.__setattr__(self, "constraints", named(constraints))
        object.__setattr__(self, "terms", named(terms))

    def filter(self, pattern: str) -> Problem:
        """Only constraints whose names begin with a match of ``pattern``."""
        return replace_constraints(self, {k: v for k, v in self.constraints.items() if re.match(pattern, k)})

    def filter_names(self, parts: list[str]) -> Problem:
        """Only constraints and terms whose names hold one of ``parts``."""
        held = lambda d: {k: v for k, v in d.items() if any(p in k for p in parts)}
        return Problem(held(self.constraints), held(self.terms))


def replace_constraints(p: Problem, constraints: dict[str, Scalar]) -> Problem:
    return Problem(constraints, p.terms)


def violation(e: Scalar) -> Scalar:
    """How far a hard constraint is from holding, as an expression.

    Whole-number comparisons fall short by a distance, others by 1; ``ne`` counts its truth value.
    """
    zero = Const(0)
    if isinstance(e, Aggregate) and e.what == "all":
        return replace(e, what="sum", body=violation(e.body))
    if isinstance(e, Call):
        if e.op == "and":
            return call("add", *map(violation, e.args))
        if e.op == "or":
            return call("min", *map(violation, e.args))
        if e.op == "in_range":
            x, low, high = e.args
            return call("max", call("sub", low, x), call("sub", x, high), zero)
        if e.op == "eq":
            return call("abs", call("sub", *e.args))
        if e.op in ("lt", "le", "gt", "ge"):
            a, b = e.args if e.op in ("lt", "le") else e.args[::-1]
            if a.kind is int and b.kind is int:
                short = call("sub", a, b)
                return call("max", call("add", short, 1) if e.op in ("lt", "gt") else short, zero)
            return call("as_number", call("not", e))
        if e.op in ("not", "ne"):
            return call("as_number", e if e.op == "ne" else e.args[0])
    if isinstance(e, Const) and e.kind is bool:
        return Const(0 if e.value else 1)
    return call("as_number", e) if e.kind is bool else e


def required(objs: Objects) -> frozenset[Tag]:
    """Positive tags that members of a set are known to have."""
    if isinstance(objs, AnyTagged):
        return required(objs.objs)
    own = decompose(objs.tags)[0] if isinstance(objs, Tagged) else frozenset()
    return own.union(*[required(c) for c in objs.children()[:1] if isinstance(c, Objects)])
