"""Arrays, tag sets and JSON as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def one_hot(index: Column, n: int) -> Column:
    """ARRAY of n zeros with a one at ``index``; no one where there is no such place."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: (k == index).cast("int"))


def resized(values: Column, n: int) -> Column:
    """n values at even steps of the array, the nearest before each."""
    step = F.size(values).cast("double") / n
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.get(values, F.floor(k * step).cast("int")))


def rounded_json(numbers: Column, digits: int = 6) -> Column:
    """JSON of a map of doubles, rounded."""
    return F.to_json(F.transform_values(numbers, lambda _, v: F.round(v, digits)))


def tags_union(a: Column, b: Column) -> Column:
    """Sorted tags of either set."""
    return F.array_sort(F.array_union(a, b))


def tags_intersection(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_intersect(a, b))


def _denied(t: Column) -> Column:
    return F.when(F.startswith(t, F.lit("-")), F.substring(t, 2, 1 << 30)).otherwise(F.concat(F.lit("-"), t))


def tags_difference(a: Column, b: Column) -> Column:
    """a, but not b: what a has, what it denies and b doesn't ask for, and the denial of what b alone asks for; denied tags begin with ``-``."""
    positive = lambda s: F.filter(s, lambda t: ~F.startswith(t, F.lit("-")))
    negative = lambda s: F.transform(F.filter(s, lambda t: F.startswith(t, F.lit("-"))), _denied)
    has, lacks, asks, bars = positive(a), negative(a), positive(b), negative(b)
    said = F.array_union(has, F.array_except(bars, lacks))
    return F.array_sort(F.array_union(said, F.transform(F.array_union(lacks, F.array_except(asks, has)), _denied)))
