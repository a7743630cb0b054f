"""Runs of many jobs over many scenes: per-scene lists and shares, asset times, what to cancel; tables put side by side, meshes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagweave.functions.scalar import clock_text
from tagweave.operators.aggregates import quantiles
from tagweave.operators.windows import numbered


def seed_of_job(name: Column, prefix: str) -> Column:
    """The seed in ``PREFIX_SEED_STAGE...``: what stands up to the next underscore or space; null where it isn't one."""
    form = f"^{prefix}_([^ _]+)_.*$"
    return F.when(name.rlike(form), F.regexp_extract(name, form, 1))


def by_seed(jobs: DataFrame, prefix: str) -> DataFrame:
    """For each seed its jobs (a scene has some dozens) by number: seed, jobs ARRAY<STRUCT<job_id, name>>, n."""
    rows = jobs.withColumn("seed", seed_of_job(F.col("name"), prefix)).where("seed is not null")
    return rows.groupBy("seed").agg(F.array_sort(F.collect_list(F.struct("job_id", "name"))).alias("jobs"), F.count("*").alias("n"))


def of_finished(jobs: DataFrame, finished: DataFrame) -> DataFrame:
    """Jobs whose seed, the capitals between underscores in their names, is among ``finished`` (seed)."""
    rows = jobs.withColumn("seed", F.regexp_extract("name", r"^.*_([A-Z]+)_.*$", 1))
    return rows.join(finished.select("seed"), "seed", "left_semi")


def pipeline_times(jobs: DataFrame) -> DataFrame:
    """For each seed, over its jobs (seed, job_id, start, elapsed) by number: the first is coarse, the second fine, the others render.

    Seconds of coarse, of fine and from the start of the first to the last end of the others, and the percentages of that.
    Seeds of fewer than three jobs are left out.
    """
    w = Window.partitionBy("seed").orderBy("job_id")
    rows = jobs.withColumn("_k", F.row_number().over(w))
    at = lambda k, x: F.max(F.when(F.col("_k") == k, x))
    end = F.max(F.when(F.col("_k") > 2, F.unix_timestamp("start") + F.col("elapsed")))
    out = rows.groupBy("seed").agg(at(1, F.col("elapsed")).alias("coarse"), at(2, F.col("elapsed")).alias("fine"), (end - at(1, F.unix_timestamp("start"))).alias("full"))
    share = lambda c: F.try_divide(100.0 * F.col(c), F.col("full").cast("double")).alias(f"{c}_percent")
    return out.where("full is not null").select("*", share("coarse"), share("fine"))


def pipeline_means(times: DataFrame) -> DataFrame:
    """One row: mean seconds of each part over all seeds, and the mean percentages as whole numbers (halves to the even one)."""
    percent = lambda c: F.bround(F.avg(f"{c}_percent")).cast("int").alias(f"{c}_percent")
    return times.agg(*[F.avg(c).alias(c) for c in ("coarse", "fine", "full")], percent("coarse"), percent("fine"))


def asset_times(rows: DataFrame, scenes: int, text: bool = False) -> DataFrame:
    """For each asset, over its uses (asset, step, seconds, step_seconds, scene_seconds): mean, quantiles and sum in whole seconds,
    percentages of its scenes' and steps' time, its step and how many uses there are a scene.

    Quantiles interpolate between ranks. With ``text``, times are ``HH:MM:SS``. An asset stands in one step.
    """
    sums = rows.groupBy("asset").agg(
        F.sum("seconds").alias("total"), F.try_divide(100.0 * F.sum("seconds"), F.sum("scene_seconds").cast("double")).alias("scene_percent"),
        F.try_divide(100.0 * F.sum("seconds"), F.sum("step_seconds").cast("double")).alias("step_percent"), F.min("step").alias("step"), (F.count("*") / F.lit(scenes)).alias("chance"),
    )
    shown = lambda c: (clock_text(F.bround(c)) if text else F.bround(c)).alias(c)
    out = quantiles(rows, ["asset"], F.col("seconds"), 9).drop("n").join(sums, "asset")
    return out.select("asset", *map(shown, ("mean", "median", "p90", "p95", "p99", "total")), "scene_percent", "step_percent", "step", "chance")


def polygons(objects: DataFrame) -> DataFrame:
    """Polygons of each collection's meshes (collection, type, polygons), as a number and as a line ``name: 1,234``."""
    count = F.coalesce(F.sum(F.when(F.col("type") == "MESH", F.col("polygons"))), F.lit(0))
    out = objects.groupBy("collection").agg(count.alias("polygons"))
    return out.withColumn("line", F.concat("collection", F.lit(": "), F.format_number("polygons", 0)))


def to_cancel(queue: DataFrame, holds: str, lacks: str | None = None, not_running: bool = False) -> DataFrame:
    """Jobs (job_id, name, state) whose names hold one text and not the other; with ``not_running``, none that is on a node."""
    out = queue.where(F.contains("name", F.lit(holds)))
    out = out.where(~F.contains("name", F.lit(lacks))) if lacks is not None else out
    return out.where(~F.contains("state", F.lit("node"))) if not_running else out


def side_by_side(a: DataFrame, b: DataFrame, order_a: list[str], order_b: list[str], suffixes: tuple[str, str] = ("_A", "_B")) -> DataFrame:
    """Two tables column by column, row by row in their orders; the shorter one is filled with nulls."""
    left, right = numbered(a, order_a, "row"), numbered(b, order_b, "row")
    left = left.select("row", *[F.col(c).alias(c + suffixes[0]) for c in a.columns])
    right = right.select("row", *[F.col(c).alias(c + suffixes[1]) for c in b.columns])
    return left.join(right, "row", "full_outer")


def sorted_mesh(vertices: DataFrame, faces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A mesh whose vertices (vertex, x, y, z, ...) are numbered by z, then y, then x, and whose faces (a, b, c) by c, then b, then a, from 0."""
    placed = numbered(vertices, ["z", "y", "x", "vertex"], "place")
    names = placed.select(F.col("vertex").alias("old"), F.col("place").alias("new"))
    moved = faces.select("a", "b", "c")
    for corner in "abc":
        moved = moved.join(names, F.col(corner) == F.col("old")).drop(corner, "old").withColumnRenamed("new", corner)
    return placed.drop("vertex").withColumnRenamed("place", "vertex"), numbered(moved, ["c", "b", "a"], "face")


def joined_meshes(vertices: DataFrame, faces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Meshes one after the other: vertices (mesh, vertex, ...) and faces (mesh, face, a, b, c) numbered through, in the meshes' order.

    Vertices come with the attributes of all meshes; one that a mesh doesn't have is 0 there.
    """
    sizes = vertices.groupBy("mesh").agg((F.max("vertex") + 1).alias("n")).join(faces.groupBy("mesh").agg((F.max("face") + 1).alias("m")), "mesh", "left")
    before = Window.orderBy("mesh").rowsBetween(Window.unboundedPreceding, -1)  # a row a mesh
    at = lambda c: F.coalesce(F.sum(F.coalesce(c, F.lit(0))).over(before), F.lit(0))
    starts = sizes.select("mesh", at("n").alias("from_vertex"), at("m").alias("from_face"))
    attributes = [c for c in vertices.columns if c not in ("mesh", "vertex", "x", "y", "z")]
    points = vertices.join(starts, "mesh").withColumn("vertex", F.col("vertex") + F.col("from_vertex"))
    points = points.withColumns({c: F.coalesce(c, F.lit(0)) for c in attributes}).select("vertex", "x", "y", "z", *attributes)
    moved = faces.join(starts, "mesh")
    return points, moved.select((F.col("face") + F.col("from_face")).alias("face"), *[(F.col(c) + F.col("from_vertex")).alias(c) for c in "abc"])
