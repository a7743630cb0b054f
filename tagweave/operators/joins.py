"""Joins by meaning: as-of, nearest, division, closure, assignments, comparisons of runs."""

from __future__ import annotations

from functools import reduce
from itertools import count

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def compared(a: DataFrame, b: DataFrame, on: str) -> DataFrame:
    """Full outer equi-join of two runs: the key once, all other columns with _A and _B."""
    left = a.select(on, *[F.col(c).alias(f"{c}_A") for c in a.columns if c != on])
    right = b.select(on, *[F.col(c).alias(f"{c}_B") for c in b.columns if c != on])
    return left.join(right, on, "full_outer")


def asof(left: DataFrame, right: DataFrame, by: list[str], time: str, columns: list[str], prefix: str = "prev_", strict: bool = True) -> DataFrame:
    """Each left row with the nearest earlier right row of its group (``strict``: not one at the same time).

    Both sides are stacked and the last right row before each place is carried along a window: one shuffle on the
    group, linear in the rows, where a range join would make a row for every earlier one.
    """
    put = F.struct(F.col(time).alias(time), *[F.col(c).alias(c) for c in columns])
    kind = right.select(put.alias("x")).schema["x"].dataType
    rows = left.select(*by, F.col(time).alias("_t"), F.lit(0 if strict else 1).alias("_side"), F.struct(*left.columns).alias("_row"), F.lit(None).cast(kind).alias("_right"))
    marks = right.select(*by, F.col(time).alias("_t"), F.lit(1 if strict else 0).alias("_side"), F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"), put.alias("_right"))
    w = Window.partitionBy(*by).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    out = rows.unionByName(marks).withColumn("_last", F.last("_right", ignorenulls=True).over(w)).where("_row is not null")
    return out.select("_row.*", F.col(f"_last.{time}").alias(prefix + time), *[F.col(f"_last.{c}").alias(prefix + c) for c in columns])


def shifted_pairs(rows: DataFrame, by: list[str], order: list[str], columns: list[str], step: int = 1) -> DataFrame:
    """Each row with the one ``step`` places on in its group (none for the last)."""
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumns({f"next_{c}": F.lead(c, step).over(w) for c in columns})


def pairs_of_distinct(rows: DataFrame, key: str, columns: list[str], ordered: bool = True, on: list[str] = ()) -> DataFrame:
    """Pairs of different rows, within groups of equal ``on`` if given: for short tables such as cameras."""
    a = rows.select(*[F.col(c).alias(f"{c}_a") for c in [key, *columns, *on]])
    b = rows.select(*[F.col(c).alias(f"{c}_b") for c in [key, *columns, *on]])
    cond = F.col(f"{key}_a") != F.col(f"{key}_b") if ordered else F.col(f"{key}_a") < F.col(f"{key}_b")
    for c in on:
        cond = cond & (F.col(f"{c}_a") == F.col(f"{c}_b"))
    return a.join(b, cond)


#: Rows of a group that a block holds at most, on average; pairs of rows that one task looks at; tasks at most, beyond which blocks grow.
BLOCK, PAIRS, TASKS = 4096, 20_000_000, 1000


def blocks_for(pairs: float, most: int | None = None) -> tuple[int, float]:
    """For so many pairs the tasks, and the rows of a block.

    A group of n rows is copied n / block times. With blocks of one size these copies would grow with the square of a table, so from ``TASKS``
    tasks on blocks grow with it: a table ten times as large makes a hundred times the pairs in as many tasks, of ten times the rows.
    """
    each = max(most or PAIRS, pairs / TASKS)
    return int(pairs / each) + 1, max(min(BLOCK, (most or PAIRS) ** 0.5), (pairs / TASKS) ** 0.5)


def met_in_blocks(a: DataFrame, b: DataFrame, on: list[str], most: int | None = None) -> DataFrame:
    """``a`` and ``b``, without further columns in common, joined on equal ``on``: large groups are cut into blocks.

    Each block of a group's rows on one side meets each block of the other side as a group of its own, so that all
    tasks look at about as many pairs, however few the groups are. Neither side is broadcast: rows that were dealt to cells
    are many more than their table seems to have. ``most``: pairs for a task, where they are dear.
    ``on`` has no floating numbers: Spark would deal these anew for the join, and put the tasks together.
    """
    from tagweave.sources.shared import written

    sizes = a.groupBy(*on).agg(F.count("*").alias("_na")).hint("merge").join(b.groupBy(*on).agg(F.count("*").alias("_nb")), on)
    sizes = written(sizes)
    pairs = sizes.agg(F.sum(F.col("_na").cast("double") * F.col("_nb"))).first()[0] or 0.0
    tasks, block = blocks_for(pairs, most)
    if tasks == 1:
        return a.hint("merge").join(b, on)
    blocks = lambda n: F.ceil(F.col(n) / F.lit(block))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), blocks(n) - 1))

    def dealt(t: DataFrame, own: str, n: str, other: str, m: str) -> DataFrame:
        rows = t.hint("merge").join(sizes, on).withColumn(own, F.pmod(F.xxhash64(*t.columns), blocks(n))).withColumn(other, each(m)).drop("_na", "_nb")
        # a fixed number of partitions: Spark would put them together by their bytes, which say nothing of their pairs
        return rows.repartition(max(tasks, int(t.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *on, "_ka", "_kb")

    return dealt(a, "_ka", "_na", "_kb", "_nb").hint("merge").join(dealt(b, "_kb", "_nb", "_ka", "_na"), [*on, "_ka", "_kb"]).drop("_ka", "_kb")


def starting_within(a: DataFrame, b: DataFrame, on: list[str], a_span: tuple[str, str], start: str, width: float) -> DataFrame:
    """Pairs of rows with equal ``on`` where b's ``start`` lies in a's span (low, high): in cells of a quarter of the spans' mean length, at most ``width``.

    Spans stand in all cells that they meet, starts in one: five rows a span on average, and few pairs that aren't asked for.
    """
    low, high = a_span
    mean = a.agg(F.avg(F.abs(F.col(high) - F.col(low)).cast("double"))).first()[0]
    cell = F.lit(min(width, mean / 4 if mean else width, 1e300))
    at = lambda c: F.floor(F.col(c) / cell)
    spans = a.where(F.col(low) <= F.col(high)).withColumn("_cell", F.explode(F.sequence(at(low), at(high))))
    met = met_in_blocks(spans, b.withColumn("_cell", at(start)), [*on, "_cell"]).drop("_cell")
    return met.where((F.col(low) <= F.col(start)) & (F.col(start) <= F.col(high)))


def interval_overlap(a: DataFrame, b: DataFrame, key_a: str, key_b: str, low: str, high: str, width: float, once: bool = False) -> DataFrame:
    """Pairs whose [low, high] meet: one of the two starts in the other, in cells of at most ``width``; each pair once.

    ``once``: only pairs with key_a < key_b, for a table and itself.
    """
    named = lambda df, key, s: df.select(F.col(key).alias(f"key_{s}"), F.col(low).alias(f"low_{s}"), F.col(high).alias(f"high_{s}"))
    meets = (F.col("low_a") <= F.col("high_b")) & (F.col("low_b") <= F.col("high_a"))
    a, b = named(a, key_a, "a"), named(b, key_b, "b")
    found = starting_within(a, b, [], ("low_a", "high_a"), "low_b", width).where(meets)
    if not once:
        return found.unionByName(starting_within(b, a, [], ("low_b", "high_b"), "low_a", width).where(meets & (F.col("low_b") < F.col("low_a"))))
    found = found.where((F.col("low_a") < F.col("low_b")) | ((F.col("low_a") == F.col("low_b")) & (F.col("key_a") < F.col("key_b"))))
    turned = F.col("key_a") > F.col("key_b")
    pick = lambda c, one, other: F.when(turned, F.col(f"{c}_{other}")).otherwise(F.col(f"{c}_{one}")).alias(f"{c}_{one}")
    return found.where("key_a <> key_b").select(*[pick(c, one, other) for one, other in ("ab", "ba") for c in ("key", "low", "high")])


def divided(rows: DataFrame, key: str, value: str, wanted: list) -> DataFrame:
    """Keys that stand with every one of ``wanted``."""
    hit = rows.where(F.col(value).isin(wanted))
    return hit.groupBy(key).agg(F.count_distinct(value).alias("n")).where(F.col("n") == len(set(wanted))).select(key)


def usable(usages: DataFrame, key: str, value: str, wanted: list, barred: list) -> DataFrame:
    """Keys with every wanted usage and none that is barred."""
    out = divided(usages, key, value, wanted)
    return out.join(usages.where(F.col(value).isin(barred)).select(key), key, "left_anti") if barred else out


def not_in(rows: DataFrame, others: DataFrame, on) -> DataFrame:
    return rows.join(others, on, "left_anti")


def ancestors(edges: DataFrame) -> DataFrame:
    """Transitive closure of (child, parent): rows (node, ancestor, depth) at the least depth; cycles end.

    One join a level, over the pairs that are new; stops when a level brings none.
    """
    from tagweave.sources.shared import written

    step = edges.select(F.col("child").alias("from_"), F.col("parent").alias("to_"))
    new = written(step.select(F.col("from_").alias("node"), F.col("to_").alias("ancestor"), F.lit(1).alias("depth")).distinct())
    out = new
    for depth in count(2):
        new = new.join(step, F.col("ancestor") == F.col("from_")).select("node", F.col("to_").alias("ancestor"), F.lit(depth).alias("depth"))
        new = written(new.distinct().join(out.select("node", "ancestor"), ["node", "ancestor"], "left_anti"))
        if new.isEmpty():
            break
        out = out.union(new)
    return out


def hops(edges: DataFrame, root) -> DataFrame:
    """Least number of undirected edges (a, b) from ``root``: rows (node, hops), the root at 0."""
    from tagweave.sources.shared import written

    both = written(edges.select(F.col("a").alias("x"), F.col("b").alias("y")).union(edges.select("b", "a")).distinct())
    front = both.select(F.lit(root).alias("node")).limit(1).select("node", F.lit(0).alias("hops"))
    out, n = front, 0
    while True:
        n += 1
        nxt = front.join(both, F.col("node") == F.col("x")).select(F.col("y").alias("node"), F.lit(n).alias("hops")).distinct()
        front = written(nxt.join(out.select("node"), "node", "left_anti"))
        if front.isEmpty():
            return out
        out = out.union(front)


def symmetrised(pairs: DataFrame, a: str, b: str) -> DataFrame:
    return pairs.select(a, b).union(pairs.select(F.col(b).alias(a), F.col(a).alias(b))).distinct()


def with_children(candidates: DataFrame, barred: str = "sem:no-children") -> DataFrame:
    """Candidates (with ``tags``) that may have children; the tags go, as they are asked no more."""
    return candidates.where(~F.array_contains("tags", barred)).drop("tags")


def assignments(variables: list[tuple[str, DataFrame, Column | None]], limit: int | dict[str, int] | None = None) -> DataFrame:
    """Values for each variable in turn: (name, candidates with a column of that name, condition on the earlier ones).

    With ``limit``, so many candidates for each assignment of the variables before, by their order; a table of limits has
    one for some of the variables.
    """
    out = None
    for name, rows, on in variables:
        most = limit.get(name) if isinstance(limit, dict) else limit
        if out is None:
            out = rows if most is None else rows.orderBy(name).limit(most)
            continue
        before = list(out.columns)
        out = out.join(rows, on) if on is not None else out.crossJoin(rows)
        if most is not None:
            w = Window.partitionBy(*before).orderBy(name)
            out = out.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).drop("_n")
    return out


def relation_assignments(database, wanted: list, planes: DataFrame, together: list[str] = ()) -> DataFrame:
    """Every way to give each wanted (relation, domain) a parent and one of its planes: columns target_K, plane_K.

    ``together``: further columns of ``planes`` in which all parents of a way are alike; without any, all combinations are ways.

    Relations that others prove are left out, and those of one kind are put together first. A parent is an entity of the
    domain; its planes (name, plane, tags) are those with the tags that the relation asks of its parent. A relation
    without a kind has no parent to look for and is an error.
    """
    from tagweave.plans.algebra import Predicate, normalised, satisfied_by
    from tagweave.plans.compile import Compiler
    from tagweave.plans.lang import scene

    out = None
    for k, (relation, domain) in enumerate(normalised([Predicate(*w) for w in wanted])):
        if relation.kind == "any":
            raise ValueError(f"a relation of no kind to {domain}")
        if relation.negated:
            continue
        parents = Compiler(database).members(scene().in_domain(domain)).select(F.col("name").alias(f"target_{k}"))
        there = planes.where(satisfied_by(relation.parent, planes["tags"])).select(F.col("name").alias(f"target_{k}"), F.col("plane").alias(f"plane_{k}"), *together)
        found = parents.hint("merge").join(there, f"target_{k}")
        # all combinations are what is asked for
        out = found if out is None else met_in_blocks(out, found, list(together)) if together else out.crossJoin(found)
    return out.drop(*together) if out is not None and together else out


def active_flags(database, assignment: dict, objects: DataFrame | None = None) -> DataFrame:
    """(name, active) of objects for an assignment: ``{"room": (name, domain)}``, ``{"obj": (name, domain)}`` or both.

    An object's ancestors of a type are the first of that type on each way along its relations, or the object itself.
    It is active if the room is among its ancestors of the room's type, and if no other object is among those of the
    object's type.
    """
    from tagweave.plans.compile import Compiler
    from tagweave.plans.lang import scene
    from tagweave.sources.shared import written

    out = (objects if objects is not None else database.objects).select("name").withColumn("active", F.lit(True))
    steps = database.relations.select(F.col("src").alias("at"), F.col("dst").alias("next"))
    for variable, (name, domain) in assignment.items():
        if variable not in ("room", "obj"):
            raise ValueError(f"no variable of a stage: {variable}")
        of_type = written(Compiler(database).members(scene().in_domain(domain)).select(F.col("name").alias("at")))
        front = out.select("name", F.col("name").alias("at"))
        seen, found = written(front), []
        front = seen
        while not front.isEmpty():
            found.append(front.join(of_type, "at", "left_semi").select("name", F.col("at").alias("ancestor")))
            on = front.join(of_type, "at", "left_anti").join(steps, "at").select("name", F.col("next").alias("at")).distinct()
            front = written(on.join(seen, ["name", "at"], "left_anti"))
            seen = seen.union(front)
        ancestors = found[0]
        for more in found[1:]:
            ancestors = ancestors.union(more)
        if variable == "room":
            good = ancestors.where(F.col("ancestor") == name).select("name").distinct().withColumn("_ok", F.lit(True))
            out = out.join(good, "name", "left").select("name", (F.col("active") & F.coalesce("_ok", F.lit(False))).alias("active"))
        else:
            own = ancestors.groupBy("name").agg(F.bool_or(F.col("ancestor") == F.col("name")).alias("_own"))
            out = out.join(own, "name", "left").select("name", (F.col("active") & F.coalesce("_own", F.lit(True))).alias("active"))
    return out


def _likeness():
    @F.pandas_udf("double")
    def likeness(a: pd.Series, b: pd.Series) -> pd.Series:
        places: dict[str, dict[str, int]] = {}  # of each character in a name, as bits: names meet many others

        def one(x: str, y: str) -> float:
            if not x and not y:
                return 100.0
            if x not in places:
                places[x] = {c: sum(1 << k for k, d in enumerate(x) if c == d) for c in set(x)}
            at, open_ = places[x], (1 << len(x)) - 1  # a bit of ``open_`` falls for each character that the subsequence has
            for c in y:
                hit = open_ & at.get(c, 0)
                open_ = (open_ + hit) | (open_ - hit)
            common = len(x) - (open_ & ((1 << len(x)) - 1)).bit_count()
            return 200.0 * common / (len(x) + len(y))

        return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)])

    return likeness


def _rarest(rows: DataFrame, name: str, least: float, counts: DataFrame) -> DataFrame:
    """Each name once for each of so many of its rarest bigrams that a name as like as ``least`` percent shares one of them.

    Ends count as characters, and a bigram's second place in a name is another one. Of names of lengths x and y with d insertions and
    deletions between them, x + 1 - 2 * (deletions) - (insertions) bigrams stay, and as many from the other's side:
    half of x + y + 2 - 3 * d at least are shared; d is at most the share that ``least`` leaves of x + y, and y no less than it allows.
    """
    text, n = F.concat(F.lit("^"), F.col(name), F.lit("$")), F.length(name)
    pairs = F.transform(F.sequence(F.lit(1), n + 1), lambda k: F.substring(text, k, F.lit(2)))
    numbered = F.transform(pairs, lambda g, k: F.concat(g, F.size(F.filter(F.slice(pairs, 1, k), lambda x: x == g)).cast("string")))
    both = n + n * (least / (200 - least))
    shared = F.greatest(F.ceil((both + 2 - 3 * (1 - least / 100) * both) / 2 - 1e-9), F.lit(1))
    rows = rows.withColumn("gram", F.explode(numbered)).join(counts, "gram", "left").withColumn("of", F.coalesce("of", F.lit(0)))
    held = rows.groupBy(*[c for c in rows.columns if c not in ("gram", "of")]).agg(F.array_sort(F.collect_list(F.struct("of", "gram"))).alias("grams"))
    return held.withColumn("g", F.explode(F.slice("grams", 1, (n + 2 - shared).cast("int")))).withColumn("gram", F.col("g.gram")).drop("grams", "g")


def _one_apart(a: DataFrame, b: DataFrame, least: float) -> DataFrame:
    """Names (a, a_name) with the best of the names (b, b_name) that have one character more or less: rows (a, m: b and score).

    One of the two is the other without a character, so names meet as they are written, each in as many forms as it has characters.
    A name of three characters or more is less like all others than like these.
    """
    def shorter(name: str):
        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(name)), lambda k: F.concat(F.substring(name, F.lit(1), k - 1), F.substring(name, k + 1, F.length(name)))))

    a = a.where(F.length("a_name") > 2)
    b = b.groupBy("b_name").agg(F.min("b").alias("b"))
    fuller = b.where(F.length("b_name") > 0).select("b", F.explode(shorter("b_name")).alias("form")).groupBy("form").agg(F.min("b").alias("b"))
    found = a.hint("merge").join(fuller, F.col("a_name") == F.col("form")).select("a", "a_name", "b", F.length("a_name").alias("common"), (2 * F.length("a_name") + 1).alias("both"))
    less = a.select("a", "a_name", F.explode(shorter("a_name")).alias("form")).hint("merge").join(b, F.col("form") == F.col("b_name"))
    found = found.union(less.select("a", "a_name", "b", F.length("b_name"), 2 * F.length("b_name") + 1))
    scored = found.select("a", "b", (F.lit(200.0) * F.col("common") / F.col("both")).alias("score")).where(F.col("score") >= least)
    return scored.groupBy("a").agg(F.min_by(F.struct("b", "score"), F.struct(-F.col("score"), F.col("b"))).alias("m"))


def best_match(left: DataFrame, right: DataFrame, key: str, least: float = 80.0, steps: tuple[float, ...] = (97.0, 92.0, 86.0)) -> DataFrame:
    """Each left name with the right name of greatest likeness, at ``least`` percent, the smaller of equally like ones; left rows without one stay.

    Likeness is 200 * (longest common subsequence) / (sum of lengths), over snake-cased names. Equal names are found by a join, and those with one
    character more or less by another. The rest are searched for a match of 97 percent first, then of less, down to ``least``: whoever has one is done, as no
    other is as like. For each percentage names meet by as many of their rarest bigrams as it asks for, few at first.
    The subsequence runs as an Arrow function, a step a character over the bits of the other name: no built-in counts it.
    """
    from tagweave.functions.scalar import snake_case
    from tagweave.sources.shared import written

    likeness = _likeness()
    a = left.select(F.col(key).alias("a"), snake_case(F.col(key)).alias("a_name")).where("a is not null").distinct()
    b = written(right.select(F.col(key).alias("b"), snake_case(F.col(key)).alias("b_name")).where("b is not null").distinct())
    equal = b.groupBy(F.col("b_name").alias("same")).agg(F.min("b").alias("b")).where(F.lit(least <= 100.0))
    found = [a.hint("merge").join(equal, F.col("a_name") == F.col("same")).select("a", F.struct("b", F.lit(100.0).alias("score")).alias("m"))]
    a = written(a.hint("merge").join(equal, F.col("a_name") == F.col("same"), "left_anti"))
    found.append(written(_one_apart(a, b, least)))
    a = written(a.hint("merge").join(found[-1].select("a"), "a", "left_anti"))
    whole = F.concat(F.lit("^"), F.col("b_name"), F.lit("$"))
    pairs = F.transform(F.sequence(F.lit(1), F.length("b_name") + 1), lambda k: F.substring(whole, k, F.lit(2)))
    numbered = F.transform(pairs, lambda g, k: F.concat(g, F.size(F.filter(F.slice(pairs, 1, k), lambda x: x == g)).cast("string")))
    counts = written(b.select(F.explode(numbered).alias("gram")).groupBy("gram").agg(F.count("*").alias("of")))
    for percent in [*[s for s in steps if s > least], least]:
        if a.isEmpty():
            break
        met = _rarest(a, "a_name", percent, counts).join(_rarest(b, "b_name", percent, counts), "gram").drop("gram")
        # a subsequence is no longer than the shorter name
        met = met.where(200 * F.least(F.length("a_name"), F.length("b_name")) >= percent * (F.length("a_name") + F.length("b_name"))).distinct()
        scored = met.withColumn("score", likeness("a_name", "b_name")).where(F.col("score") >= percent)
        best = written(scored.groupBy("a").agg(F.min_by(F.struct("b", "score"), F.struct(-F.col("score"), F.col("b"))).alias("m")))
        found.append(best)
        a = written(a.hint("merge").join(best.select("a"), "a", "left_anti"))
    best = reduce(DataFrame.union, found)
    return left.hint("merge").join(best, F.col(key) == F.col("a"), "left").select(*left.columns, F.col("m.b").alias("match"), F.col("m.score").alias("score"))


def nearest(points: DataFrame, others: DataFrame, key: str, cell: float, most: float | None = None, apart: bool = False) -> DataFrame:
    """Each point's nearest other, the one with the smaller key of equally near ones; with ``most``, none that is farther.

    Both sides have ``key`` and ``xyz`` (three doubles). ``apart``: the other with the point's own key is left out.
    The 27 cells of size s around a point hold all others within s. A point whose nearest is within s is settled; the
    rest, fewer each time, look in cells of twice the size, until all are settled or the cells are as wide as everything.
    """
    from tagweave.sources.shared import written

    around = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(c).alias("c")) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1)])
    gap = F.sqrt(F.aggregate(F.zip_with("p", "o", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    side = lambda k: F.max(F.get("xyz", F.lit(k))) - F.min(F.get("xyz", F.lit(k)))
    both = points.select("xyz").union(others.select("xyz"))
    wide = both.agg(F.sqrt(side(0) * side(0) + side(1) * side(1) + side(2) * side(2))).first()[0] or 0.0
    open_, found, size = points.select(F.col(key).alias("point"), F.col("xyz").alias("p")), [], cell
    while True:
        last = size >= (wide if most is None else min(most, wide))
        size = most if last and most is not None else size
        at = lambda k: F.floor(F.get("xyz", F.lit(k)) / F.lit(size))  # noqa: B023, E731
        here = open_.withColumn("xyz", F.col("p")).select("point", "p", at(0).alias("i"), at(1).alias("j"), at(2).alias("k"))
        there = others.select(F.col(key).alias("other"), F.col("xyz").alias("o"), at(0).alias("i0"), at(1).alias("j0"), at(2).alias("k0"), F.explode(around).alias("d"))
        there = there.select("other", "o", (F.col("i0") + F.col("d.a")).alias("i"), (F.col("j0") + F.col("d.b")).alias("j"), (F.col("k0") + F.col("d.c")).alias("k"))
        met = here.join(there, ["i", "j", "k"]).withColumn("distance", gap).where(F.col("distance") <= size)
        met = met.where(F.col("point") != F.col("other")) if apart else met
        best = written(met.groupBy("point").agg(F.min(F.struct("distance", "other")).alias("m")))
        found.append(best)
        open_ = written(open_.join(best, "point", "left_anti"))
        if last or open_.isEmpty():
            break
        size *= 2
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.select("point", F.col("m.other").alias("other"), F.col("m.distance").alias("distance"))


def matched_optimally(costs: DataFrame, group: list[str]) -> DataFrame:
    """Minimum-cost perfect matchings of square cost tables (group, i, j, cost), a group at a time; rows (group, i, j, cost).

    The Hungarian method with potentials, in one task a group: groups are the few parts of one object.
    """
    fields = costs.select(*group, "i", "j", "cost").schema

    def solve(table: pd.DataFrame) -> pd.DataFrame:
        grid = table.pivot(index="i", columns="j", values="cost")
        if grid.shape[0] != grid.shape[1] or grid.isna().any().any():
            raise ValueError("matching needs a full square table of costs")
        n, c = len(grid), grid.to_numpy(float)
        u, v, match = [0.0] * (n + 1), [0.0] * (n + 1), [0] * (n + 1)
        for i in range(1, n + 1):
            match[0], j0 = i, 0
            least, used, way = [float("inf")] * (n + 1), [False] * (n + 1), [0] * (n + 1)
            while True:
                used[j0], i0, delta, j1 = True, match[j0], float("inf"), 0
                for j in range(1, n + 1):
                    if not used[j]:
                        reduced = c[i0 - 1, j - 1] - u[i0] - v[j]
                        if reduced < least[j]:
                            least[j], way[j] = reduced, j0
                        if least[j] < delta:
                            delta, j1 = least[j], j
                for j in range(n + 1):
                    if used[j]:
                        u[match[j]] += delta
                        v[j] -= delta
                    else:
                        least[j] -= delta
                j0 = j1
                if match[j0] == 0:
                    break
            while j0:
                match[j0], j0 = match[way[j0]], way[j0]
        out = pd.DataFrame([(grid.index[match[j] - 1], grid.columns[j - 1], c[match[j] - 1, j - 1]) for j in range(1, n + 1)], columns=["i", "j", "cost"])
        for g in reversed(group):
            out.insert(0, g, table[g].iloc[0])
        return out

    return costs.select(*group, "i", "j", "cost").groupBy(*group).applyInPandas(solve, fields)
