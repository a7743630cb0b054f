"""Dense arrays and cameras: dictionary masks, boxes in view, reprojection, normals, occlusion, co-visibility, pooling.

Rasters come as pixel rows (frame, y, x, value...), so that Catalyst prunes and aggregates them; matrices are
arrays of rows. Only decoding and polygon overlays need Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagweave.functions.vectors import applied, cross, homogenized, normalized


def compressed(values: Column) -> Column:
    """STRUCT<vals, indices>: the sorted distinct values of an array and each element's place among them."""
    vals = F.array_sort(F.array_distinct(values))
    return F.struct(vals.alias("vals"), F.transform(values, lambda x: (F.array_position(vals, x) - 1).cast("int")).alias("indices"))


def recovered(packed: Column) -> Column:
    """The array that ``compressed`` was given."""
    return F.transform(packed["indices"], lambda k: F.get(packed["vals"], k))


def visible_objects(objects: DataFrame, pixels: DataFrame) -> DataFrame:
    """Objects that some pixel shows."""
    return objects.join(pixels.select("object_idx"), "object_idx", "left_semi")


def visible_instances(instances: DataFrame, pixels: DataFrame) -> DataFrame:
    """Instances (object_idx, instance_id) that some pixel shows."""
    return instances.join(pixels.select("object_idx", "instance_id"), ["object_idx", "instance_id"], "left_semi")


def named_like(objects: DataFrame, text: str) -> DataFrame:
    """Objects whose name holds ``text``, in either case."""
    return objects.where(F.lower("object_name").contains(text.lower()))


def in_view(points: DataFrame, cameras: DataFrame, most_depth: float, margin: float) -> DataFrame:
    """Least depth and least distance from the image for each point over all cameras, for points that come within both limits.

    ``cameras``: (camera, K rows of 3, T world-to-camera rows of 4, width, height): a short list, sent to all tasks when it is small.
    """
    at = points.crossJoin(cameras)
    p = applied(F.col("T"), homogenized(F.col("xyz")))
    at = at.withColumn("p", F.slice(p, 1, 3)).withColumn("uvw", applied(F.col("K"), F.col("p")))
    u, v = (F.try_divide(F.get("uvw", F.lit(k)), F.get("uvw", F.lit(2))) for k in (0, 1))
    out = F.greatest(-u, u - F.col("width"), -v, v - F.col("height"), F.lit(0.0))
    at = at.select("point", F.get("p", F.lit(2)).alias("depth"), out.alias("away"))
    return at.where((F.col("depth") < most_depth) & (F.col("away") <= margin)).groupBy("point").agg(F.min("depth").alias("depth"), F.min("away").alias("away"))


def warped(pixels: DataFrame) -> DataFrame:
    """Where each pixel (x, y, depth, K, K_inv, T between cameras, as arrays of rows) lands in the other camera: u, v, and its depth there."""
    ray = applied(F.col("K_inv"), F.array(F.col("x").cast("double"), F.col("y").cast("double"), F.lit(1.0)))
    point = F.transform(ray, lambda r: r * F.col("depth"))
    moved = F.slice(applied(F.col("T"), homogenized(point)), 1, 3)
    seen = applied(F.col("K"), moved)
    at = lambda k: F.get("_seen", F.lit(k))
    rows = pixels.withColumn("_seen", seen)
    return rows.withColumns({"u": F.try_divide(at(0), at(2)), "v": F.try_divide(at(1), at(2)), "new_depth": at(2)}).drop("_seen")


def occluded(warps: DataFrame, depths: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Whether the other frame shows something nearer where a pixel lands, or nothing: the pixel isn't seen there."""
    other = depths.select(F.col("y").alias("vy"), F.col("x").alias("ux"), F.col("depth").alias("there"))
    rows = warps.withColumns({"ux": F.bround("u").cast("int"), "vy": F.bround("v").cast("int")}).join(other, ["ux", "vy"], "left")
    hidden = F.col("there").isNull() | (F.col("new_depth") > F.col("there") * (1 + tolerance))
    return rows.withColumn("occluded", hidden)


def covisibility(cycles: DataFrame, most: float = 1.0) -> DataFrame:
    """For each pair of cameras the share of pixels that come back to within ``most`` pixels."""
    return cycles.where("camera_a <> camera_b").groupBy("camera_a", "camera_b").agg(F.avg((F.col("error") < most).cast("double")).alias("share"))


def normals(pixels: DataFrame, by: list[str]) -> DataFrame:
    """Unit normals of a grid of points (by..., y, x, xyz): cross products of the steps to the right and downwards; none at the far edges."""
    right = F.lead("xyz").over(Window.partitionBy(*by, "y").orderBy("x"))
    down = F.lead("xyz").over(Window.partitionBy(*by, "x").orderBy("y"))
    step = lambda to: F.zip_with(to, F.col("xyz"), lambda a, b: a - b)
    return pixels.withColumns({"_r": right, "_d": down}).withColumn(
        "normal", F.when(F.col("_r").isNotNull() & F.col("_d").isNotNull(), normalized(cross(step(F.col("_d")), step(F.col("_r")))))
    ).drop("_r", "_d")


def boxes_in_view(boxes: DataFrame) -> DataFrame:
    """Boxes (id, corners in camera space, K) that have a corner before the camera, with their least and greatest u and v there."""
    c = boxes.select("*", F.explode("corners").alias("p")).where(F.get("p", F.lit(2)) > 0).withColumn("uvw", applied(F.col("K"), F.col("p")))
    u, v = (F.get("uvw", F.lit(k)) / F.get("uvw", F.lit(2)) for k in (0, 1))
    return c.groupBy("id").agg(F.min(u).alias("u_min"), F.max(u).alias("u_max"), F.min(v).alias("v_min"), F.max(v).alias("v_max"), F.count("*").alias("n_corners"))


def pooled(pixels: DataFrame, by: list[str], factor: int, how: str) -> DataFrame:
    """Rasters made smaller by a whole factor: mean, max, min or first (the upper left) of each cell."""
    cell = {c: F.floor(F.col(c) / factor).cast("int") for c in ("y", "x")}
    value = {"mean": F.avg("value"), "max": F.max("value"), "min": F.min("value"), "first": F.min_by("value", F.struct("y0", "x0"))}[how]
    rows = pixels.select(*by, F.col("y").alias("y0"), F.col("x").alias("x0"), "value", cell["y"].alias("y"), cell["x"].alias("x"))
    return rows.groupBy(*by, "y", "x").agg(value.alias("value"))


def pooled_by_type(pixels: DataFrame, actions: DataFrame) -> DataFrame:
    """Rasters (data_type, y, x, value, ...) made smaller as a table of actions says: data_type, factor, how (see ``pooled``).

    ``how`` is mean, max, min, first or mask (1 where any of a cell is over 0.01). Types without an action stay out.
    """
    rows = pixels.join(F.broadcast(actions), "data_type")  # a row a type of data
    cell = lambda c: F.floor(F.col(c) / F.col("factor")).cast("int").alias(c)
    rows = rows.select("data_type", "how", cell("y"), cell("x"), F.col("y").alias("y0"), F.col("x").alias("x0"), "value")
    how, mask = F.first("how"), (F.max("value") > 0.01).cast("double")
    first = F.min_by("value", F.struct("y0", "x0"))
    value = F.when(how == "mean", F.avg("value")).when(how == "max", F.max("value")).when(how == "min", F.min("value")).when(how == "mask", mask).otherwise(first)
    return rows.groupBy("data_type", "y", "x").agg(value.alias("value"))


def dark(pixels: DataFrame, by: list[str], least: float = 20.0) -> DataFrame:
    """Images whose mean is below ``least``."""
    return pixels.groupBy(*by).agg(F.avg("value").alias("mean")).where(F.col("mean") < least)


def view_coverage(hits: DataFrame, flags: DataFrame) -> DataFrame:
    """For each view (view, face): rays and how many hit faces with the flag."""
    rows = hits.join(flags, "face", "left")
    return rows.groupBy("view").agg(F.count("*").alias("n_pix"), F.count_if(F.coalesce("flag", F.lit(False))).alias("n_flagged"))


def segment_shares(faces: DataFrame) -> DataFrame:
    """Share of each tag among each mesh's faces (mesh, tag), greatest first."""
    n = faces.groupBy("mesh", "tag").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("mesh"))).orderBy("mesh", F.desc("share"), "tag")
