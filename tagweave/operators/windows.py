"""Ordered operators: differences, gates, picks, resampling, top-k, splits, paging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def differences(rows: DataFrame, by: list[str], order: list[str], columns: list[str], where: Column | None = None) -> DataFrame:
    """Each column less its value in the row before, after a filter."""
    w = Window.partitionBy(*by).orderBy(*order)
    rows = rows if where is None else rows.where(where)
    return rows.withColumns({f"{c}_diff": F.col(c) - F.lag(c).over(w) for c in columns})


def numbered(rows: DataFrame, order: list, name: str) -> DataFrame:
    """Add the rows' places in the given order, from 0: ranges of the order are sorted apart and counted, so no task sees all rows.

    Rows that are equal in ``order`` come in any order. The ranges are written once, as they are drawn by sampling.
    """
    from tagweave.sources.shared import written

    if not rows.columns:
        raise ValueError("rows without columns have no order")
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranges = written(ranges.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_in")))
    counts = ranges.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_in").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(F.col("_part").alias("_of"), (before - F.col("_first")).alias("_shift"))  # a row a range
    out = ranges.join(F.broadcast(starts), F.col("_part") == F.col("_of"))
    return out.select(*rows.columns, (F.col("_in") + F.col("_shift")).alias(name))


def sequential_gate(tasks: DataFrame, by: str, order: str, state: str, condition: str) -> DataFrame:
    """Which tasks of a sequence may run, and whose failure is fatal: one that the next task doesn't ask for.

    Conditions look at the state of the last task before that wasn't skipped (before the first: succeeded).
    ``prev_succeeded`` (also a null) bars the task and all after it unless that one succeeded; ``prev_failed`` skips
    only the task itself unless that one failed; ``prev_redundant`` asks for nothing.

    Skips come in runs of ``prev_failed`` tasks after one of another kind: such a task is reached only while all
    states since that one are failures. So two windows give the answer and nothing is folded over.
    """
    w = Window.partitionBy(by).orderBy(order)
    until = lambda *more: Window.partitionBy(by, *more).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    rows = tasks.withColumns({"_asks": F.coalesce(condition, F.lit("prev_succeeded")), "_state": F.coalesce(state, F.lit("not_queued"))})
    rows = rows.withColumns({"_run": F.count_if(F.col("_asks") != "prev_failed").over(w), "fatal": F.coalesce(F.lead("_asks").over(w) != "prev_failed", F.lit(True))})
    only_failures = F.coalesce(F.min((F.col("_state") == "failed").cast("int")).over(until("_run")) == 1, F.lit(False))
    rows = rows.withColumn("_reached", (F.col("_asks") != "prev_failed") | ((F.col("_run") > 0) & only_failures))
    before = F.coalesce(F.last(F.when(F.col("_reached"), F.col("_state")), ignorenulls=True).over(until()), F.lit("succeeded"))
    rows = rows.withColumn("_barred", ((F.col("_asks") == "prev_succeeded") & (before != "succeeded")).cast("int"))
    open_ = F.max("_barred").over(w.rowsBetween(Window.unboundedPreceding, 0)) == 0
    return rows.withColumn("may_run", open_ & F.col("_reached")).drop("_asks", "_state", "_run", "_reached", "_barred")


def roundrobin(rows: DataFrame, place: str, weights: list[tuple[str, int]]) -> DataFrame:
    """The item whose turn it is at each place: each item as often in a round as its weight."""
    total, run, out = sum(w for _, w in weights), 0, None
    for item, w in weights:
        run += w
        hit = F.pmod(F.col(place), F.lit(total)) + 1 <= run
        out = F.when(hit, F.lit(item)) if out is None else out.when(hit, F.lit(item))
    return rows.withColumn("pick", out)


def lerp_sampled(rows: DataFrame, by: list[str], order: str, x: str, at: DataFrame, place: str) -> DataFrame:
    """Values of each group's series at fractional places (from 0); beyond the last it stays.

    ``at`` has one row a place and is the same for all groups: each row of a series meets the places between it and the
    next by equality, and a group's last row those beyond, so nothing is compared that doesn't meet.
    """
    w = Window.partitionBy(*by).orderBy(order)
    series = rows.select(*by, (F.row_number().over(w) - 1).alias("_k"), F.col(x).alias("_x"), F.coalesce(F.lead(x).over(w), F.col(x)).alias("_y"), F.lead(x).over(w).isNull().alias("_end"))
    asked = at.withColumn("_f", F.floor(place).cast("int"))
    within = series.join(asked, F.col("_k") == F.col("_f"))
    last = series.where("_end")
    beyond = last.crossJoin(asked).where(F.col("_f") > F.col("_k"))  # a row a group and place: what is asked for
    value = F.col("_x") + (F.col("_y") - F.col("_x")) * F.least(F.col(place) - F.col("_k"), F.lit(1.0))
    return within.unionByName(beyond).select(*by, *at.columns, value.alias("value"))


def inverse_interpolated(series: DataFrame, order: str, x: str, wanted: float) -> DataFrame:
    """The fractional place where an ascending series first reaches ``wanted``: one row, null if it never does."""
    rows = numbered(series.select(F.col(order).alias("_order"), F.col(x).alias("_x")), ["_order"], "_k")
    reached = rows.where(F.col("_x") >= wanted).agg(F.min("_k").alias("_k"), F.min_by("_x", "_k").alias("_x"))
    before = rows.select((F.col("_k") + 1).alias("_next"), F.col("_x").alias("_before"))
    step = F.try_divide(F.lit(wanted) - F.col("_before"), F.col("_x") - F.col("_before"))
    out = reached.join(before, F.col("_k") == F.col("_next"), "left")  # one row meets one
    return out.select(F.when(F.col("_k") == 0, F.lit(0.0)).otherwise(F.col("_k") - 1 + step).alias("place"))


def keyframed(keys: DataFrame, by: list[str], time: str, value: str, mode: str) -> DataFrame:
    """Segments between keyframes: start, end, value at start and slope; mode CONSTANT or LINEAR a row."""
    w = Window.partitionBy(*by).orderBy(time)
    t1, v1 = F.lead(time).over(w), F.lead(value).over(w)
    slope = F.when(F.col(mode) == "CONSTANT", F.lit(0.0)).otherwise(F.try_divide(v1 - F.col(value), t1 - F.col(time)))
    return keys.select(*by, F.col(time).alias("t0"), t1.alias("t1"), F.col(value).alias("v0"), F.coalesce(slope, F.lit(0.0)).alias("slope"))


def bezier_value(t0: float, v0: float, h0: tuple[float, float], h1: tuple[float, float], t1: float, v1: float, t: float) -> float:
    """A Bezier segment with handles h0 and h1 at time t, by bisection of its time curve (monotone for sane handles)."""
    curve = lambda a, b, c, d, s: (1 - s) ** 3 * a + 3 * (1 - s) ** 2 * s * b + 3 * (1 - s) * s * s * c + s**3 * d
    low, high = 0.0, 1.0
    for _ in range(60):
        s = (low + high) / 2
        low, high = (s, high) if curve(t0, h0[0], h1[0], t1, s) < t else (low, s)
    return curve(v0, h0[1], h1[1], v1, low)


def bezier_at(times: list[Column], values: list[Column], t: Column, steps: int = 50) -> Column:
    """STRUCT<value, velocity> of a Bezier segment with four times and values (ends and handles) at time ``t``: the place on
    the curve is found by halving, as the times of sane handles ascend; both are built-in expressions."""
    power = lambda s: ((1 - s) * (1 - s) * (1 - s), 3 * (1 - s) * (1 - s) * s, 3 * (1 - s) * s * s, s * s * s)
    curve = lambda c, s: sum((p * x for p, x in zip(power(s)[1:], c[1:], strict=True)), power(s)[0] * c[0])
    slope = lambda c, s: 3 * (1 - s) * (1 - s) * (c[1] - c[0]) + 6 * (1 - s) * s * (c[2] - c[1]) + 3 * s * s * (c[3] - c[2])

    def halve(at: Column, _: Column) -> Column:
        middle = (at["low"] + at["high"]) / 2
        before = curve(times, middle) < t
        return F.struct(F.when(before, middle).otherwise(at["low"]).alias("low"), F.when(before, at["high"]).otherwise(middle).alias("high"))

    place = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.struct(F.lit(0.0).alias("low"), F.lit(1.0).alias("high")), halve, lambda at: at["low"])
    # worked out once: the place stands in an array of one, which the value and the velocity are made of
    both = F.transform(F.array(place), lambda s: F.struct(curve(values, s).alias("value"), F.try_divide(slope(values, s), slope(times, s)).alias("velocity")))
    return F.get(both, F.lit(0))


def keyframe_values(keys: DataFrame, at: DataFrame, by: list[str], time: str) -> DataFrame:
    """Value and velocity at the times of ``at`` (by..., time) of curves through keyframes (by..., time, value, mode,
    left_time, left_value, right_time, right_value: the handles); mode CONSTANT, LINEAR or BEZIER to the next frame.

    Before the first frame there is no value; from the last one on the value stays.
    """
    from tagweave.operators.joins import asof

    w = Window.partitionBy(*by).orderBy(time)
    ahead = {"t1": time, "v1": "value", "h1t": "left_time", "h1v": "left_value"}
    segments = keys.withColumns({n: F.lead(c).over(w) for n, c in ahead.items()})
    rows = asof(at, segments, by, time, ["value", "mode", "right_time", "right_value", *ahead], "k_", strict=False)
    c = lambda n: F.col(f"k_{n}")
    t, last = F.col(time), c("t1").isNull()
    line = F.try_divide(c("v1") - c("value"), c("t1") - c(time))
    bent = bezier_at([c(time), c("right_time"), c("h1t"), c("t1")], [c("value"), c("right_value"), c("h1v"), c("v1")], t)
    still, none = last | (c("mode") == "CONSTANT"), c("value").isNull()
    value = F.when(none | still, c("value")).when(c("mode") == "LINEAR", c("value") + line * (t - c(time))).otherwise(bent["value"])
    velocity = F.when(none, F.lit(None).cast("double")).when(still, F.lit(0.0)).when(c("mode") == "LINEAR", line).otherwise(bent["velocity"])
    return rows.select(*by, time, value.alias("value"), velocity.alias("velocity"))


def by_angle(points: DataFrame, by: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """Number each group's points by their angle around its centroid."""
    mid = Window.partitionBy(*by)
    rows = points.withColumns({"_a": F.atan2(F.col(y) - F.avg(y).over(mid), F.col(x) - F.avg(x).over(mid))})
    return rows.withColumn("place", F.row_number().over(mid.orderBy("_a", x, y)) - 1).drop("_a")


def rotational_asymmetry(points: DataFrame, by: list[str], angle: str, x: str = "x", y: str = "y") -> DataFrame:
    """How far each group is from looking the same after each turn by 1 / n: the mean of a part for places and one for headings.

    Rows have their ``place`` around the centroid (see ``by_angle``). Both parts turn each vector back by its place and
    take the mean squared distance to their mean, which is the mean square less the square of the mean; places count
    from the centroid, in units of the farthest one. A group that is all in one point has no asymmetry of places.
    """
    g = Window.partitionBy(*by)
    n = F.count("*").over(g)
    turn = -F.col("place") * 6.283185307179586 / n
    dx, dy = F.col(x) - F.avg(x).over(g), F.col(y) - F.avg(y).over(g)
    rows = points.withColumns({"_t": turn, "_dx": dx, "_dy": dy})
    turned = lambda a, b: (a * F.cos("_t") - b * F.sin("_t"), a * F.sin("_t") + b * F.cos("_t"))
    px, py = turned(F.col("_dx"), F.col("_dy"))
    hx, hy = turned(F.cos(angle), F.sin(angle))
    rows = rows.select(*by, px.alias("_px"), py.alias("_py"), hx.alias("_hx"), hy.alias("_hy"), (F.col("_dx") ** 2 + F.col("_dy") ** 2).alias("_r"))
    spread = lambda square, a, b: square - F.avg(a) ** 2 - F.avg(b) ** 2
    places = F.coalesce(F.try_divide(spread(F.avg("_r"), "_px", "_py"), F.max("_r")), F.lit(0.0))
    return rows.groupBy(*by).agg(F.round((places + spread(F.lit(1.0), "_hx", "_hy")) / 2, 9).alias("asymmetry"))


def principal_order(points: DataFrame, by: list[str], key: str) -> DataFrame:
    """Consecutive pairs of each group's points along its first principal axis in the plane: (key, next_key)."""
    g = Window.partitionBy(*by)
    dx, dy = F.col("x") - F.avg("x").over(g), F.col("y") - F.avg("y").over(g)
    rows = points.withColumns({"_x": dx, "_y": dy})
    angle = 0.5 * F.atan2(2 * F.sum(F.col("_x") * F.col("_y")).over(g), F.sum(F.col("_x") * F.col("_x") - F.col("_y") * F.col("_y")).over(g))
    rows = rows.withColumn("_p", F.round(F.col("_x") * F.cos(angle) + F.col("_y") * F.sin(angle), 9))
    return rows.select(*by, key, F.lead(key).over(g.orderBy("_p", key)).alias(f"next_{key}"))


def smoothed(values: DataFrame, edges: DataFrame, rounds: int = 20) -> DataFrame:
    """Values (node, value) after repeated means with their neighbours, weighted by edges (a, b, weight); isolated nodes stay."""
    from tagweave.sources.shared import written

    both = written(edges.select(F.col("a").alias("at"), F.col("b").alias("of"), "weight").union(edges.select("b", "a", "weight")))
    for n in range(rounds):
        around = both.join(values, F.col("of") == F.col("node")).groupBy("at").agg(F.sum(F.col("weight") * F.col("value")).alias("s"), F.sum("weight").alias("w"))
        mixed = (F.col("value") + F.coalesce("s", F.lit(0.0))) / (1 + F.coalesce("w", F.lit(0.0)))
        values = values.join(around, F.col("node") == F.col("at"), "left").select("node", mixed.alias("value"))
        if n % 5 == 4:
            values = written(values)
    return values


def first_per_group(rows: DataFrame, by: list[str], order: list, n: int) -> DataFrame:
    """The first ``n`` rows of each group."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def hashed_examples(rows: DataFrame, by: list[str], key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows of each group in a random but fixed order."""
    return first_per_group(rows, by, [F.md5(F.concat(F.lit(f"{seed}/"), F.col(key).cast("string"))), key], n)


def sampled(rows: DataFrame, key: str, k: int, seed: int = 0) -> DataFrame:
    """``k`` rows without replacement."""
    return rows.orderBy(F.md5(F.concat(F.lit(f"{seed}/"), F.col(key).cast("string"))), key).limit(k)


def top(rows: DataFrame, order: list, k: int) -> DataFrame:
    return rows.orderBy(*order).limit(k)


def split(rows: DataFrame, key: str, parts: list[tuple[str, int]], seed: int = 0) -> DataFrame:
    """Shuffled parts of exact sizes, the rest nulls: places in the order of md5, see ``numbered``."""
    rows = rows.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}/"), F.col(key).cast("string"))))
    rows = numbered(rows, ["_h", key], "_place")
    run, out = 0, None
    for name, n in parts:
        run += n
        out = F.when(F.col("_place") < run, name) if out is None else out.when(F.col("_place") < run, name)
    return rows.withColumn("split", out).drop("_h", "_place")


def paged(rows: DataFrame, by: list[str], order: list[str], size: int) -> DataFrame:
    """Page numbers from 0 for each group's rows."""
    return rows.withColumn("page", F.floor((F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1) / size).cast("int"))


def renumbered(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """Lexicographic rank from 1."""
    return rows.withColumn("number", F.row_number().over(Window.partitionBy(*by).orderBy(name)))


def launch_order(scenes: DataFrame, in_flight: str, place: str, n: int) -> DataFrame:
    """Most in flight first, then by place; the first ``n``."""
    return scenes.orderBy(F.desc(in_flight), place).limit(n)


def capped_launch(tasks: DataFrame, key: str, order: str, cap: int, stuck: str) -> DataFrame:
    """The first tasks of each key up to ``cap`` less those that are stuck there."""
    w = Window.partitionBy(key)
    n = F.row_number().over(w.orderBy(F.col(stuck), order)) - F.sum(F.col(stuck).cast("int")).over(w)
    room = F.lit(cap) - F.sum(F.col(stuck).cast("int")).over(w)
    return tasks.withColumns({"_n": F.when(~F.col(stuck), F.row_number().over(w.orderBy(F.col(stuck), order))), "_room": room}).where(F.col("_n") <= F.col("_room")).drop("_n", "_room")


def bound_order(rows: DataFrame, low: str, high: str, count: str, reverse: bool = False) -> DataFrame:
    """Bounds in the order in which they are served: those below their low first, then those inside; over-full ones are dropped.

    A bound that is just full stays. A null low or high is no bound. ``reverse`` serves the over-full ones first and drops
    those below their low.
    """
    level = F.when(F.col(high) < F.col(count), 1).when(F.col(low) > F.col(count), -1).otherwise(0)
    return rows.withColumn("level", -level if reverse else level).where("level < 1").orderBy("level")


def grid_place(rows: DataFrame, place: str, columns: int) -> DataFrame:
    return rows.withColumns({"col": (F.col(place) % columns).cast("int"), "row": F.floor(F.col(place) / columns).cast("int")})
