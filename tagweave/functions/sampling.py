"""Seeded random columns: the same row and seed give the same draw on every run and partitioning."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagweave.functions.scalar import int_hash

TURN = 6.283185307179586


def uniform(seed: int, *key: Column) -> Column:
    """In [0, 1), from the hash of the seed and the key."""
    return int_hash(F.lit(f"{seed}/"), *key) / F.lit(4294967295.0)


def normal(seed: int, *key: Column) -> Column:
    """Standard normal, by Box and Muller."""
    a, b = uniform(seed, F.lit("a"), *key), uniform(seed, F.lit("b"), *key)
    return F.sqrt(-2 * F.ln(F.greatest(a, F.lit(1e-12)))) * F.cos(b * TURN)


def draw(spec: tuple, seed: int, *key: Column) -> Column:
    """A draw from ``(kind, *arguments)``; anything that isn't a known kind comes back as it is.

    uniform(a, b), normal(m, s), clip_gaussian(m, s, a, b), power_uniform(a, b): 10 to a uniform power, log_uniform(a, b),
    discrete_uniform(a, b) with both ends, bool(p) or bern(p), choice(list) or choice(list, chances), cat(p0, p1, ...) or
    categorical(...): a place, weighted_choice((w, spec), ...): what is chosen is drawn in its turn, spherical_sample(min, max):
    the elevation in degrees, 0 to 90, of a direction spread evenly over the sphere, between limits that may be None.
    """
    if not isinstance(spec, tuple) or not spec or not isinstance(spec[0], str):
        return F.lit(spec)
    kind, *a = spec
    u = uniform(seed, *key)
    if kind == "uniform":
        return u * (a[1] - a[0]) + a[0]
    if kind == "normal":
        return normal(seed, *key) * a[1] + a[0]
    if kind == "clip_gaussian":  # up to 20 tries, then clipped
        tries = [normal(seed, F.lit(str(n)), *key) * a[1] + a[0] for n in range(20)]
        last = F.least(F.greatest(tries[-1], F.lit(float(a[2]))), F.lit(float(a[3])))
        return F.coalesce(*[F.when(t.between(a[2], a[3]), t) for t in tries], last)
    if kind == "power_uniform":
        return F.pow(F.lit(10.0), u * (a[1] - a[0]) + a[0])
    if kind == "log_uniform":
        return F.exp(u * (F.ln(F.lit(float(a[1]))) - F.ln(F.lit(float(a[0])))) + F.ln(F.lit(float(a[0]))))
    if kind == "discrete_uniform":
        return (F.floor(u * (a[1] - a[0] + 1)) + a[0]).cast("bigint")
    if kind in ("bool", "bern"):
        return u < a[0]
    if kind == "choice" and len(a) == 1:
        return F.get(F.array(*map(F.lit, a[0])), F.floor(u * len(a[0])).cast("int"))
    if kind in ("choice", "weighted_choice", "cat", "categorical"):
        pairs = a if kind == "weighted_choice" else list(zip(*a[::-1], strict=True)) if kind == "choice" else list(zip(a, range(len(a)), strict=True))
        drawn = [draw(v, seed, F.lit(f"{n}/"), *key) if kind == "weighted_choice" else F.lit(v) for n, (_, v) in enumerate(pairs)]
        *upto, total = accumulate(w for w, _ in pairs)
        out = drawn[-1]
        for high, v in list(zip(upto, drawn[:-1], strict=True))[::-1]:
            out = F.when(u * total < high, v).otherwise(out)
        return out
    if kind == "spherical_sample":
        low, high = (F.sin(F.radians(F.lit(float(x)))) if x is not None else F.lit(end) for x, end in zip((*a, None, None), (0.0, 1.0)))  # noqa: B905
        return F.degrees(F.asin(u * (high - low) + low))
    return F.lit(kind) if not a else F.array(F.lit(kind), *[F.lit(str(x)) for x in a])


def weighted_pick(rows: DataFrame, choices: DataFrame, key: str, seed: int) -> DataFrame:
    """One of ``choices`` (item, weight; a short list) for each row, with chances by weight: the inverse of the cumulative weights."""
    upto = Window.orderBy("item").rowsBetween(Window.unboundedPreceding, 0)
    table = choices.select("item", F.sum("weight").over(upto).alias("high"), F.sum("weight").over(Window.partitionBy()).alias("total"))
    table = table.select("item", (F.col("high") / F.col("total")).alias("high"), F.lag("high", 1, 0.0).over(Window.orderBy("item")).alias("before"), "total")
    table = table.select("item", "high", (F.col("before") / F.col("total")).alias("low"))
    drawn = rows.withColumn("u", uniform(seed, F.col(key)))
    return drawn.join(F.broadcast(table), (F.col("u") >= F.col("low")) & (F.col("u") < F.col("high"))).drop("low", "high")
