"""Aggregations: counts by reason, quantiles, shares, resources, several grouping levels, dictionaries, boxes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagweave.operators.windows import numbered


def value_counts(rows: DataFrame, value: Column, name: str = "value", within: list[str] = ()) -> DataFrame:
    """How often each value stands, within groups if given."""
    return rows.groupBy(*within, value.alias(name)).agg(F.count("*").alias("n"))


def quantiles(rows: DataFrame, by: list[str], x: Column, digits: int = 6) -> DataFrame:
    """n, mean, median, p90, p95 and p99 by linear interpolation, all rounded; a group without values has none.

    Values are counted by group and value first, and the counts ranked in ranges of (group, value): a rank is a group's
    running count, so no task holds a group. Each quantile lies between two ranks, whose values are looked up.
    """
    wanted = {"median": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}
    counted = rows.select(*by, x.alias("_x")).groupBy(*by, "_x").agg(F.count("*").alias("_c"))
    totals = counted.where("_x is not null").groupBy(*by).agg(F.sum("_c").alias("_n"), (F.sum(F.col("_x") * F.col("_c")) / F.sum("_c")).alias("_mean"))
    ranked = running(counted.where("_x is not null"), [*by, "_x"], "_c", "_upto")
    first = running_start(ranked, by)
    ranked = ranked.join(first, by).join(totals, by) if by else ranked.crossJoin(first).crossJoin(totals)  # one row
    ranked = ranked.withColumn("_high", F.col("_upto") - F.col("_base"))  # ranks _high - _c to _high - 1 have this value
    out = []
    for q in wanted.values():
        at = (F.col("_n") - 1) * F.lit(q)
        down = F.floor(at)
        held = lambda k: (k >= F.col("_high") - F.col("_c")) & (k < F.col("_high"))
        low, high = F.max(F.when(held(down), F.col("_x"))), F.max(F.when(held(F.least(down + 1, F.col("_n") - 1)), F.col("_x")))
        out.append(low + (high - low) * F.max(at - down))
    found = ranked.groupBy(*by).agg(F.max("_n").alias("n"), F.round(F.max("_mean"), digits).alias("mean"), *[F.round(v, digits).alias(c) for c, v in zip(wanted, out, strict=True)])
    empty = counted.select(*by).distinct()
    return empty.join(found, by, "left").fillna(0, ["n"]) if by else found


def running(rows: DataFrame, order: list[str], weight: str, name: str) -> DataFrame:
    """Add the running sum of ``weight`` in the given order, over all rows: sums within ranges and of the ranges before."""
    from tagweave.sources.shared import written

    ranges = rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    ranges = written(ranges)
    sums = ranges.groupBy("_part").agg(F.sum(weight).alias("_s"))
    before = F.coalesce(F.sum("_s").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select(F.col("_part").alias("_of"), before.alias("_start"))  # a row a range
    inside = F.sum(weight).over(Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    out = ranges.withColumn("_inside", inside).join(F.broadcast(starts), F.col("_part") == F.col("_of"))
    return out.select(*rows.columns, (F.col("_inside") + F.col("_start")).alias(name))


def running_start(ranked: DataFrame, by: list[str]) -> DataFrame:
    """Where each group's running count begins."""
    return ranked.groupBy(*by).agg(F.min(F.col("_upto") - F.col("_c")).alias("_base"))


def shares(rows: DataFrame, by: list[str], x: Column, within: list[str] = (), digits: int = 6) -> DataFrame:
    """Sum of x for each group, its percentage of the total (within ``within``), and the number of rows."""
    out = rows.groupBy(*dict.fromkeys([*within, *by])).agg(F.sum(x).alias("total"), F.count("*").alias("n"))
    all_ = F.sum("total").over(Window.partitionBy(*within) if within else Window.partitionBy(F.lit(1)))
    return out.withColumns({"percent": F.round(100 * F.col("total") / F.nullif(all_, F.lit(0)), digits), "total": F.round("total", digits)})


def stage_report(rows: DataFrame, stage: str, seconds: str, digits: int = 6) -> DataFrame:
    """For each stage: runs, rounded mean seconds, sum, and percent of all seconds."""
    out = shares(rows, [stage], F.col(seconds), digits=digits)
    return out.select(stage, "n", F.round(F.col("total") / F.col("n"), 0).alias("mean_seconds"), "total", "percent")


def scene_resources(jobs: DataFrame, by: str = "seed") -> DataFrame:
    """For each scene: greatest memory, seconds, CPU seconds and GPU seconds; jobs without memory or GPUs don't spoil the sums."""
    return jobs.groupBy(by).agg(
        F.max("mem").alias("max_mem"), F.sum("elapsed").alias("seconds"),
        F.sum(F.col("elapsed") * F.col("cpus")).alias("cpu_seconds"),
        F.coalesce(F.sum(F.when(F.col("gpus").isNotNull(), F.col("elapsed") * F.col("gpus"))), F.lit(0)).alias("gpu_seconds"),
    )


def makespan(rows: DataFrame, by: list[str], start: Column, end: Column, first: Column, last: Column) -> DataFrame:
    """From the earliest start among ``first`` rows to the latest end among ``last`` ones."""
    begun, over = F.min(F.when(first, start)), F.max(F.when(last, end))
    return rows.groupBy(*by).agg(begun.alias("begun"), over.alias("ended"))


def two_level_counts(rows: DataFrame, outer: str, inner: str) -> DataFrame:
    """Counts by (outer, inner) and by outer alone (inner null, level 1), in one pass."""
    return rows.groupingSets([[outer, inner], [outer]], outer, inner).agg(F.count("*").alias("n"), F.grouping(inner).cast("int").alias("level"))


def proportion(rows: DataFrame, label: Column, a: str, b: str) -> DataFrame:
    """How many labels hold ``a`` and how many ``b``, and a's share of both."""
    n_a, n_b = F.count_if(label.contains(a)), F.count_if(label.contains(b))
    return rows.agg(n_a.alias("n_a"), n_b.alias("n_b")).withColumn("share_a", F.try_divide(F.col("n_a").cast("double"), (F.col("n_a") + F.col("n_b")).cast("double")))


def error_rate(rows: DataFrame, label: Column, yes: str = "Yes", unsure: str = "Not Sure") -> DataFrame:
    """Share of ``yes`` among all answers but ``unsure``."""
    sure = F.count_if(~label.contains(unsure)).cast("double")
    return rows.agg(F.try_divide(F.count_if(label.contains(yes)).cast("double"), sure).alias("rate"))


def binomial_interval(k: int, n: int, alpha: float = 0.01) -> tuple[float, float]:
    """The values of p that a two-sided exact binomial test (by point probabilities) doesn't reject at ``alpha``."""

    def p_value(p: float) -> float:
        if p <= 0 or p >= 1:
            return float(k == (0 if p <= 0 else n))
        logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(n + 1)]
        return sum(math.exp(x) for x in logs if x <= logs[k] + 1e-9)

    def edge(inside: float, outside: float) -> float:
        if p_value(outside) > alpha:
            return outside
        for _ in range(60):
            middle = (inside + outside) / 2
            inside, outside = (middle, outside) if p_value(middle) > alpha else (inside, middle)
        return inside

    return edge(k / n, 0.0), edge(k / n, 1.0)


def zero_filled_share(rows: DataFrame, key: str, dictionary: DataFrame, weight: Column | None = None) -> DataFrame:
    """For each entry of ``dictionary`` (column ``key``): its sum of weights (rows by default) and share of all, 0 where absent."""
    counted = rows.groupBy(key).agg(F.sum(weight if weight is not None else F.lit(1)).alias("n"))
    all_ = counted.agg(F.sum("n").alias("all"))
    out = dictionary.select(key).distinct().join(counted, key, "left").crossJoin(F.broadcast(all_))  # one row
    n = F.coalesce("n", F.lit(0))
    return out.select(key, n.alias("n"), F.coalesce(F.try_divide(n.cast("double"), F.col("all").cast("double")), F.lit(0.0)).alias("share"))


def regrouped(rows: DataFrame, name: Column, x: Column) -> DataFrame:
    """Sums by the group in a name; see ``functions.scalar.group_name``."""
    from tagweave.functions.scalar import group_name

    return rows.groupBy(group_name(name).alias("grp")).agg(F.sum(x).alias("total"), F.count("*").alias("n"))


def dictionary_encoded(rows: DataFrame, column: str) -> DataFrame:
    """Add ``code``, the place of the value among the sorted distinct values, from 0; null for null.

    The codes are worked out on the distinct values, in ranges, and joined back: no window holds the whole table.
    """
    words = rows.select(F.col(column).alias("word")).where("word is not null").distinct()
    coded = numbered(words, ["word"], "code").withColumn("code", F.col("code").cast("int"))
    return rows.join(coded, F.col(column) == F.col("word"), "left").drop("word")


def decoded(coded: DataFrame, values: DataFrame) -> DataFrame:
    """Codes back to values: the inverse of the encoding; ``values`` has (word, code)."""
    return coded.join(values, "code", "left")


def boxes_2d(pixels: DataFrame, by: list[str], x: str = "x", y: str = "y") -> DataFrame:
    return pixels.groupBy(*by).agg(F.min(x).alias("x_min"), F.max(x).alias("x_max"), F.min(y).alias("y_min"), F.max(y).alias("y_max"), F.count("*").alias("n"))


def boxes_3d(points: DataFrame, by: list[str]) -> DataFrame:
    """Least and greatest x, y and z of each group."""
    return points.groupBy(*by).agg(*[f(c).alias(f"{c}_{n}") for c in "xyz" for n, f in (("min", F.min), ("max", F.max))])


def complete_mean(rows: DataFrame, by: list[str], x: str) -> DataFrame:
    """Mean of x, null if any of the group's is null."""
    return rows.groupBy(*by).agg(F.when(F.count(x) == F.count("*"), F.avg(x)).alias("score"))


def histogram(rows: DataFrame, x: Column, low: float, high: float, bins: int) -> DataFrame:
    """Rows in each of ``bins`` equal intervals of [low, high]; the last holds its upper end too."""
    at = F.least(F.width_bucket(x, F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins))
    return rows.where((x >= low) & (x <= high)).groupBy((at - 1).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def inventory(nodes: DataFrame) -> DataFrame:
    """GPUs by kind and group, with the nodes that have them (a bounded list: nodes of a cluster) and memory per CPU."""
    return nodes.groupBy("gpu", "grp").agg(
        F.sum("gpus").alias("gpus"), F.array_sort(F.collect_set("node")).alias("nodes"), F.round(F.sum("mem") / F.sum("cpus"), 6).alias("mem_per_cpu")
    )


def face_values(faces: DataFrame, vertices: DataFrame) -> DataFrame:
    """Mean and maximum of the three vertices' values for each face (face, corners ARRAY) over vertices (vertex, value)."""
    corners = faces.select("face", F.explode("corners").alias("vertex"))
    return corners.join(vertices, "vertex").groupBy("face").agg(F.round(F.avg("value"), 9).alias("mean"), F.max("value").alias("max"))


def grid_line_count(rows: DataFrame, by: list[str], x: Column, unit: float) -> DataFrame:
    """Distinct grid lines that coordinates fall on; a coordinate falls towards zero."""
    return rows.groupBy(*by).agg(F.count_distinct((x / F.lit(unit)).cast("bigint")).alias("lines"))


def control_state(in_flight: int, concurrent: int, elapsed: float, warm_up: float) -> tuple[int, int]:
    """(most in flight now, how many more to launch): ``concurrent``, ramped up over the first ``warm_up`` seconds.

    More in flight than the ramp allows is an error.
    """
    share = min(elapsed / warm_up, 1.0) if warm_up > 0 else 1.0
    allowed = math.ceil(share * concurrent)
    if in_flight > allowed:
        raise ValueError(f"{in_flight} in flight, {allowed} allowed")
    return allowed, allowed - in_flight
