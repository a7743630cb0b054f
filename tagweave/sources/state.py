"""Sinks and small sources: state JSON, scene tables, stage records, time series, dictionaries, samples, configs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from tagweave.functions.scalar import python_literal


def state_from_collections(members: DataFrame) -> DataFrame:
    """Entities from (name, collection): tags are the collections and the entity itself."""
    own = members.groupBy("name").agg(F.collect_set(F.concat(F.lit("sem:"), F.col("collection"))).alias("tags"))
    return own.select("name", F.lit(True).alias("active"), F.array_sort(F.array_append("tags", F.concat(F.lit("obj:"), F.col("name")))).alias("tags"))


def state_json(objects: DataFrame, relations: DataFrame) -> DataFrame:
    """One JSON text for each entity, fields by name, with its relations; what has no JSON form says so."""
    plain = lambda f: F.lit("<not-serialized>") if isinstance(f.dataType, BinaryType) else F.col(f.name)
    objects = objects.select(*[plain(f).alias(f.name) for f in objects.schema.fields])
    own = relations.groupBy(F.col("src").alias("name")).agg(F.array_sort(F.collect_list(F.struct(F.col("kind").alias("relation"), F.col("dst").alias("target")))).alias("relations"))
    rows = objects.join(own, "name", "left")
    return rows.select("name", F.to_json(F.struct(*[F.col(c) for c in sorted(rows.columns)])).alias("json"))


def scene_table(spark: SparkSession, path: str) -> DataFrame:
    """A wide scene CSV; its ``configs`` column holds list literals."""
    return spark.read.csv(path, header=True).withColumn("configs", python_literal(F.col("configs"), "array<string>"))


def wide_status(statuses: DataFrame, tasks: list[str]) -> DataFrame:
    """Rows (seed, task, state) as one row a scene with a column for each task."""
    return statuses.groupBy("seed").pivot("task", tasks).agg(F.first("state"))


def stage_records(spark: SparkSession, results: list[dict]) -> DataFrame:
    """Stages of a run as a table, to be written as CSV: name, ran, mem_at_finish, obj_count, instance_count."""
    kind = "name string, ran boolean, mem_at_finish bigint, obj_count bigint, instance_count bigint"
    return spark.createDataFrame([tuple(r.get(c.split()[0]) for c in kind.split(", ")) for r in results], kind)


def write_csv(rows: DataFrame, path: str, append: bool = False) -> None:
    rows.write.mode("append" if append else "overwrite").csv(path, header=True)


def write_lines(rows: DataFrame, line: Column, path: str) -> None:
    """Append lines to a text table."""
    rows.select(line.alias("value")).write.mode("append").text(path)


def series_lines(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Space-separated lines of a time series, in the order of its first column; readers skip ``#`` lines."""
    return rows.orderBy(columns[0]).select(F.concat_ws(" ", *[F.col(c).cast("string") for c in columns]).alias("value"))


def read_series(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return spark.read.csv(path, sep=" ", comment="#", schema=", ".join(f"{c} double" for c in columns))


def tag_dictionary(text: Column) -> Column:
    """A JSON object of tag names and numbers as a map."""
    return F.from_json(text, "map<string,bigint>")


def tagged_faces(faces: DataFrame, dictionary: DataFrame, wanted: list[str], barred: list[str] = ()) -> DataFrame:
    """Add ``hit`` to faces (face, tag): all wanted and no barred part in its dot-joined tag name; an untagged face has no parts."""
    named = faces.join(dictionary.select(F.col("id").alias("tag"), "name"), "tag", "left")
    parts = F.coalesce(F.split("name", r"\."), F.array().cast("array<string>"))
    array = lambda xs: F.array(*map(F.lit, xs)).cast("array<string>")
    return named.withColumn("hit", (F.size(F.array_except(array(wanted), parts)) == 0) & ~F.arrays_overlap(array(list(barred)), parts))


def merged_config(base: dict, *layers: dict, exclusive: list[set[str]] = (), mandatory: list[str] = ()) -> dict:
    """Config layers, later ones over earlier ones, nested tables merged; names that exclude one another, and mandatory ones, are checked."""
    out = dict(base)
    for layer in layers:
        for k, v in layer.items():
            out[k] = merged_config(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    for group in exclusive:
        if len(group & out.keys()) > 1:
            raise ValueError(f"only one of {sorted(group)} may be set")
    if missing := [m for m in mandatory if m not in out]:
        raise ValueError(f"missing: {missing}")
    return out


def disk_report(lines: DataFrame) -> DataFrame:
    """Used and free GB from ``total used free`` lines of KB."""
    g = lambda k: F.regexp_extract("raw", r"(\d+)\s+(\d+)\s+(\d+)", k).cast("bigint") / F.lit(1 << 20)
    return lines.where(F.col("raw").rlike(r"\d+\s+\d+\s+\d+")).select(g(1).alias("total_gb"), g(2).alias("used_gb"), g(3).alias("free_gb"), (g(2) / g(1)).alias("share"))
