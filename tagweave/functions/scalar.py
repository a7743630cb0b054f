"""Scalar column functions: text, time, numbers, seeds. All are built-in expressions, so they stay in generated code."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# text -----------------------------------------------------------------------------------------


def snake_case(name: Column) -> Column:
    """A path's last part, lower-cased, with an underscore before each capital that a lower-case letter follows."""
    return F.lower(F.regexp_replace(F.substring_index(name, "/", -1), r"(?<!^)(?=[A-Z][a-z])", "_"))


def short_reason(reason: Column, n: int = 60) -> Column:
    """The first ``n`` characters."""
    return F.left(reason, F.lit(n))


def asset_name(name: Column) -> Column:
    """STRUCT<factory, seed, kind, number> of ``Factory(seed).kind_part(number)`` names; nulls where it isn't one."""
    part = lambda k: F.when(name.rlike(form), F.regexp_extract(name, form, k))
    form = r"^(.*)\((\d+)\)\..*_(.*)\((\d+)\)$"
    return F.struct(part(1).alias("factory"), part(2).cast("bigint").alias("seed"), part(3).alias("kind"), part(4).cast("bigint").alias("number"))


def room_name(name: Column) -> Column:
    """STRUCT<type, level, number> of ``living-room_0/1``: type up to the underscore, level, number after the slash."""
    return F.struct(
        F.split_part(name, F.lit("_"), F.lit(1)).alias("type"),
        F.regexp_extract(name, r"_(-?\d+)", 1).try_cast("int").alias("level"),
        F.regexp_extract(name, r"/(\d+)$", 1).try_cast("int").alias("number"),
    )


def group_name(name: Column) -> Column:
    """The part before the first ``(``, then after the last ``:``, then before the first ``.``."""
    before = F.split_part(name, F.lit("("), F.lit(1))
    return F.split_part(F.split_part(before, F.lit(":"), F.lit(-1)), F.lit("."), F.lit(1))


def quoted_override(text: Column) -> Column:
    """``key=word`` becomes ``key="word"`` unless the value is a number, quoted, a list, a truth value, or a reference."""
    bare = text.rlike(r"^[^=]+=[A-Za-z_][\w./-]*$") & ~text.rlike(r"=(True|False|None)$")
    return F.when(bare, F.regexp_replace(text, r"^([^=]+)=(.*)$", '$1="$2"')).otherwise(text)


def resource_map(tres: Column) -> Column:
    """``cpu=4,mem=24G`` as a map; null or empty text gives an empty map."""
    return F.when(F.coalesce(tres, F.lit("")) == "", F.create_map().cast("map<string,string>")).otherwise(F.str_to_map(tres, F.lit(","), F.lit("=")))


def python_literal(text: Column, schema: str) -> Column:
    """A Python list or dict literal of plain strings and numbers, parsed by ``schema``."""
    return F.from_json(F.translate(text, "'", '"'), schema)


# time -----------------------------------------------------------------------------------------


def clock_seconds(text: Column) -> Column:
    """Seconds of ``H:M:S``, ``D-H:M:S`` or ``N day(s), H:M:S``; null if it is none."""
    g = lambda k: F.coalesce(F.nullif(F.regexp_extract(text, r"^(?:(\d+)(?:-| days?, ))?(\d+):(\d+):(\d+)", k), F.lit("")).cast("bigint"), F.lit(0))
    return F.when(text.rlike(r"^(?:\d+(?:-| days?, ))?\d+:\d+:\d+"), g(1) * 86400 + g(2) * 3600 + g(3) * 60 + g(4))


def clock_text(seconds: Column) -> Column:
    """``HH:MM:SS`` of seconds; hours go on beyond 99."""
    s = F.floor(seconds).cast("bigint")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)


def parsed_time(text: Column, pattern: str = "yyyy-MM-dd'T'HH:mm:ss") -> Column:
    """A timestamp in the given layout; null if it is none."""
    return F.try_to_timestamp(text, F.lit(pattern))


def ended(start: Column, seconds: Column) -> Column:
    """``seconds`` after ``start``."""
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def days_before(day: Column, n: int) -> Column:
    return F.date_sub(day, n)


# numbers --------------------------------------------------------------------------------------


def safediv(a: Column, b: Column) -> Column:
    """a / b; where b is 0: 0 if a is 0, else 1."""
    return F.when(b == 0, F.when(a == 0, F.lit(0.0)).otherwise(F.lit(1.0))).otherwise(F.try_divide(a.cast("double"), b.cast("double")))


def hinge(x: Column, low, high) -> Column:
    """Distance of x from [low, high]."""
    return F.greatest(F.lit(low) - x, x - F.lit(high), F.lit(0.0))


def clip(x: Column, low, high) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def round_to_nearest(x: Column, step) -> Column:
    """Multiples of ``step``; halves go to the even one."""
    return F.bround(x / step) * step


def lerp(a: Column, b: Column, t: Column) -> Column:
    return a * (1 - t) + b * t


def map_lerp(a: Column, b: Column, t: Column) -> Column:
    """Two maps of numbers with the same keys, key by key."""
    return F.map_zip_with(a, b, lambda _, x, y: x * (1 - t) + y * t)


def convex_combination(maps: list[Column], weights: list[Column]) -> Column:
    """Weighted sum of maps of numbers."""
    by = lambda w: lambda _, x: x * w
    scaled = [F.transform_values(m, by(w)) for m, w in zip(maps, weights, strict=True)]
    return reduce(lambda a, b: F.map_zip_with(a, b, lambda _, x, y: x + y), scaled)


def linvec(n: int, low: Column, high: Column) -> Column:
    """``n`` numbers from low to high in even steps, both ends among them; low alone if n is 1."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: low + k * ((high - low) / max(n - 1, 1)))


def randomspacing(low: float, high: float, n: int, margin: float, u: Callable[[Column], Column]) -> Column:
    """One number from each of ``n`` equal parts of [low, high), at least ``margin`` (0 to a half) of a part from its ends.

    ``u(k)``: a number in [0, 1) for the k-th; at a margin of a half it isn't asked and the parts' starts come back.
    """
    part = (high - low) / n
    inside = lambda k: F.lit(0.0) if margin >= 0.5 else (margin + u(k) * (1 - 2 * margin)) * part
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: low + k * part + inside(k))


def new_domain(domain: tuple[Column, Column], a: Column, b: Column) -> Column:
    """The interval of t for which a * t + b runs through ``domain``, its lower end first."""
    ends = [(x - b) / a for x in domain]
    return F.when(a > 0, F.array(*ends)).otherwise(F.array(*ends[::-1]))


def affine_to(domain: tuple[Column, Column], new: tuple[Column, Column]) -> Column:
    """STRUCT<a, b>: a * t + b takes the interval ``new`` to ``domain``."""
    a = (domain[1] - domain[0]) / (new[1] - new[0])
    return F.struct(a.alias("a"), (domain[0] - a * new[0]).alias("b"))


def wrapped(x: Column, low: Column, high: Column) -> Column:
    """x moved into [low, high) by whole turns."""
    return low + F.pmod(x - low, high - low)


def map_range(x: Column, in_low, in_high, out_low, out_high) -> Column:
    """The affine map of one interval to another, with x clipped to the first."""
    t = (clip(x.cast("double"), float(in_low), float(in_high)) - in_low) / (in_high - in_low)
    return t * (out_high - out_low) + out_low


def linear_decay(step: Column, start: float, end: float, begin: int, finish: int) -> Column:
    """start until ``begin``, end from ``finish``, a straight line between."""
    return map_range(step, begin, finish, start, end)


#: Binary units of sizes, and what a memory suffix is in decimal GB.
SIZE_UNITS = ["", "Ki", "Mi", "Gi", "Ti", "Pi", "Ei", "Zi"]
MEMORY_GB = {"K": 1e-6, "M": 1e-3, "G": 1.0}


def sizeof_text(n: Column) -> Column:
    """Bytes with one decimal and a binary unit, as in ``2.0 KiB``."""
    x = n.cast("double")
    out = F.format_string("%.1fYiB", x / float(1 << 80))
    for k, unit in reversed(list(enumerate(SIZE_UNITS))):
        out = F.when(F.abs(x) / float(1 << 10 * k) < 1024.0, F.format_string(f"%.1f {unit}B", x / float(1 << 10 * k))).otherwise(out)
    return out


def memory_gb(text: Column) -> Column:
    """Memory with a unit suffix K, M or G in decimal GB; null for anything else."""
    number = F.regexp_extract(text, r"^([\d.]+)[KMG]$", 1).try_cast("double")
    return number * F.create_map(*[F.lit(x) for kv in MEMORY_GB.items() for x in kv])[F.right(text, F.lit(1))]


# seeds ----------------------------------------------------------------------------------------


def int_hash(*parts: Column) -> Column:
    """md5 of the concatenated parts, modulo 2 ** 32 - 1: the sum of its four 32-bit words, modulo that."""
    digest = F.md5(F.concat(*[p.cast("string") for p in parts]))
    words = [F.conv(F.substring(digest, k, 8), 16, 10).cast("bigint") for k in (1, 9, 17, 25)]
    return reduce(lambda a, b: a + b, words) % 4294967295


def seed_of(text: Column) -> Column:
    """A hexadecimal seed as it is read, anything else by its hash."""
    return F.when(text.rlike(r"^(0x)?[0-9a-fA-F]{1,15}$"), F.conv(F.regexp_replace(text, "^0x", ""), 16, 10).cast("bigint")).otherwise(int_hash(text))


def hex_seed(n: Column) -> Column:
    return F.lower(F.hex(n))


def rounded(x: Column, places: int) -> Column:
    """``round`` of doubles, halves up, by a product and a whole number, as SQL engines do it: Spark's own makes a decimal of each.

    Negative numbers, and those whose whole number would have more than 15 digits, are left to Spark's.
    """
    scale = 10.0**places
    # the double before 0.5: a sum with 0.5 itself carries what is just below a half over it
    return F.when((x >= 0) & (x < 1e15 / scale), F.floor(x * scale + 0.49999999999999994) / scale).otherwise(F.round(x, places))
