"""Frame folders: files named by data type, camera rig, resample, frame and sub-camera; manifests and archives."""

from __future__ import annotations

import io
import re
import tarfile
import zipfile
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTS = ["cam_rig", "resample", "frame", "subcam"]


def parsed_suffix(text: Column) -> Column:
    """STRUCT of the four whole numbers of ``rig_resample_frame_subcam``, as in ``Image_0_0_0048_1.png``.

    What follows the first point and underscores at the ends go, and so does the first of five parts. Fewer parts than
    four give null; more than five, and parts that aren't numbers, are errors.
    """
    parts = F.split(F.trim(F.substring_index(text, ".", 1), F.lit("_")), "_")
    parts = F.when(F.size(parts) == 5, F.slice(parts, 2, 4)).otherwise(parts)
    number = lambda k: F.get(parts, F.lit(k)).cast("int")
    too_many = F.raise_error(F.concat(F.lit("no suffix: "), text)).cast("struct<" + ", ".join(f"{n}: int" for n in PARTS) + ">")
    return F.when(F.size(parts) > 5, too_many).when(F.size(parts) == 4, F.struct(*[number(k).alias(n) for k, n in enumerate(PARTS)]))


def formatted_suffix(rig: Column, resample: Column, frame: Column, subcam: Column) -> Column:
    return F.format_string("%d_%d_%04d_%d", rig, resample, frame, subcam)


def frame_files(spark: SparkSession, root: str, content: bool = False) -> DataFrame:
    """One row a file under ``root``: path, data type, extension and the four numbers. Contents only if asked for."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    pattern = r"/([A-Za-z]\w*?)_(\d+_\d+_\d+_\d+)\.(\w+)$"
    out = files.select(
        "path", F.regexp_extract("path", pattern, 1).alias("data_type"), F.regexp_extract("path", pattern, 3).alias("ext"),
        parsed_suffix(F.nullif(F.regexp_extract("path", pattern, 2), F.lit(""))).alias("s"), "length", *(["content"] if content else []),
    )
    return out.where("s is not null").select("path", "data_type", "ext", *[f"s.{p}" for p in PARTS], "length", *(["content"] if content else []))


def frame_bounds(files: DataFrame) -> DataFrame:
    """First and last frame, and how many, for each data type and camera."""
    return files.groupBy("data_type", "cam_rig", "subcam").agg(F.min("frame").alias("first"), F.max("frame").alias("last"), F.count_distinct("frame").alias("n"))


def summary(files: DataFrame) -> DataFrame:
    """The nested index of one scene as JSON, a row for each data type: extension -> resample -> rig -> subcam -> frame -> path."""
    level = files.select("data_type", "ext", *[F.col(c).cast("string").alias(c) for c in ("resample", "cam_rig", "subcam")], F.format_string("%04d", "frame").alias("frame"), F.col("path").alias("v"))
    keys = ["data_type", "ext", "resample", "cam_rig", "subcam", "frame"]
    while len(keys) > 1:
        *keys, last = keys
        level = level.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(last).alias("k"), F.col("v"))), _by_key)).alias("v"))
    return level.select("data_type", F.to_json("v").alias("index"))


def _by_key(a: Column, b: Column) -> Column:
    return F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0)


def missing_frames(files: DataFrame, first: int, last: int, types: list[str]) -> DataFrame:
    """Files that a full scene would have and this one hasn't: every type, camera and frame from first to last."""
    cameras = files.select("cam_rig", "subcam").distinct()
    kinds = files.sparkSession.createDataFrame([(t,) for t in types], "data_type string")
    wanted = cameras.crossJoin(F.broadcast(kinds)).select("*", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("frame"))
    return wanted.join(files, ["data_type", "cam_rig", "subcam", "frame"], "left_anti")


def decoded(files: DataFrame) -> DataFrame:
    """Arrays of ``.npy`` and ``.npz`` contents as (path, name, shape, values); other types are left out."""
    import numpy as np

    def run(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in tables:
            out = []
            for path, content in zip(t["path"], t["content"], strict=True):
                loaded = np.load(io.BytesIO(content), allow_pickle=False)
                for name, a in [("", loaded)] if isinstance(loaded, np.ndarray) else loaded.items():
                    out.append((path, name, list(a.shape), a.astype(float).ravel().tolist()))
            yield pd.DataFrame(out, columns=["path", "name", "shape", "values"])

    return files.where(F.col("ext").isin("npy", "npz")).select("path", "content").mapInPandas(run, "path string, name string, shape array<bigint>, values array<double>")


def chained(scenes: list[DataFrame]) -> DataFrame:
    """The files of several scenes, with the scene's place."""
    out = None
    for n, s in enumerate(scenes):
        s = s.withColumn("scene", F.lit(n))
        out = s if out is None else out.unionByName(s, allowMissingColumns=True)
    return out


def zip_entries(files: DataFrame, content: bool = False) -> DataFrame:
    """Entries of zip archives (binaryFile rows): path, entry, size, and contents if asked for."""

    def run(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in tables:
            for path, data in zip(t["path"], t["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(data)) as z:
                    rows = [(path, i.filename, i.file_size, z.read(i) if content else None) for i in z.infolist() if not i.is_dir()]
                yield pd.DataFrame(rows, columns=["path", "entry", "size", "data"])

    return files.select("path", "content").mapInPandas(run, "path string, entry string, size bigint, data binary")


def zipped(entries: DataFrame, by: str) -> DataFrame:
    """Archives of the entries (entry, data) of each group, stored without compression."""

    def run(t: pd.DataFrame) -> pd.DataFrame:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED) as z:
            for name, data in sorted(zip(t["entry"], t["data"], strict=True)):
                z.writestr(zipfile.ZipInfo(name), data)
        return pd.DataFrame({by: [t[by].iloc[0]], "content": [buffer.getvalue()]})

    return entries.select(by, "entry", "data").groupBy(by).applyInPandas(run, f"{by} {entries.schema[by].dataType.simpleString()}, content binary")


def glob_form(glob: str) -> str:
    """The pattern of a glob whose marks don't reach across folders; a folder stands for all that is in it."""
    parts = {"*": "[^/]*", "?": "[^/]"}
    return "^" + "".join(parts.get(c, re.escape(c)) for c in glob) + "(/.*)?$"


def matching(files: DataFrame, glob: str, exclude: list[str] = (), path: str = "path") -> DataFrame:
    """Paths that a glob fits, folder by folder, without those that hold a text of ``exclude``."""
    out = files.where(F.col(path).rlike(glob_form(glob)))
    return reduce(lambda d, x: d.where(~F.contains(path, F.lit(x))), exclude, out)


def kept_paths(files: DataFrame, rules: list[tuple[str, str]], path: str = "path") -> DataFrame:
    """Add ``action``, KEEP, DELETE or UNCOVERED, by rules (action, glob) in their order, over paths from the scene's folder.

    A DELETE takes what no KEEP before it has kept. What is deleted and kept only later is an error, as is an unknown
    action or, once run, a KEEP_MANDATORY that fits no path.
    """
    keep = delete = F.lit(False)
    for action, glob in rules:
        fits = F.col(path).rlike(glob_form(glob))
        if action not in ("KEEP", "KEEP_MANDATORY", "DELETE"):
            raise ValueError(f"no action: {action}")
        if action == "KEEP_MANDATORY" and files.where(fits).isEmpty():
            raise ValueError(f"nothing fits {glob}")
        if action == "DELETE":
            delete = delete | (fits & ~keep)
        else:
            keep = keep | fits
    both = F.raise_error(F.concat(F.lit("deleted and kept: "), F.col(path))).cast("string")
    return files.withColumn("action", F.when(keep & delete, both).when(keep, "KEEP").when(delete, "DELETE").otherwise("UNCOVERED"))


def listing(lines: DataFrame, parent: str) -> DataFrame:
    """Entries of a remote folder from the lines of its listing (raw): path, is_dir. Hidden entries and the summary line go."""
    words = F.split(F.trim("raw"), r"\s+")
    rows = lines.where(~F.contains("raw", F.lit("blocks of size")) & (F.trim("raw") != "")).select(words.alias("w"))
    rows = rows.where(~F.startswith(F.get("w", F.lit(0)), F.lit(".")))
    return rows.select(F.concat(F.lit(parent.rstrip("/") + "/"), F.get("w", F.lit(0))).alias("path"), F.coalesce(F.get("w", F.lit(1)).startswith("D"), F.lit(False)).alias("is_dir"))


def listed(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """All files below ``root``, whatever store it is in: path, length, modified; those whose names fit ``glob`` if given. Contents aren't read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    rows = (reader.option("pathGlobFilter", glob) if glob else reader).load(root)
    return rows.select("path", "length", F.col("modificationTime").alias("modified"))


def uploaded(files: DataFrame, root: str, target: str) -> DataFrame:
    """Copy files (path) from below ``root`` to the same places below ``target``, through the stores' own clients.

    Returns rows (path, target). The list goes through the driver one by one; the bytes go from store to store.
    """
    spark, copied = files.sparkSession, []
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for r in files.select("path").toLocalIterator():
        to = target.rstrip("/") + "/" + r.path.split(root.rstrip("/") + "/", 1)[1]
        a, b = jvm.org.apache.hadoop.fs.Path(r.path), jvm.org.apache.hadoop.fs.Path(to)
        jvm.org.apache.hadoop.fs.FileUtil.copy(a.getFileSystem(conf), a, b.getFileSystem(conf), b, False, True, conf)
        copied.append((r.path, to))
    return spark.createDataFrame(copied, "path string, target string")


def tarred(entries: DataFrame, by: str) -> DataFrame:
    """A tar archive of the entries (entry, data) of each group: a scene's files, which one task holds."""

    def run(t: pd.DataFrame) -> pd.DataFrame:
        buffer = io.BytesIO()
        with tarfile.open(fileobj=buffer, mode="w:gz") as z:
            for name, data in sorted(zip(t["entry"], t["data"], strict=True)):
                info = tarfile.TarInfo(name)
                info.size = len(data)
                z.addfile(info, io.BytesIO(data))
        return pd.DataFrame({by: [t[by].iloc[0]], "content": [buffer.getvalue()]})

    return entries.select(by, "entry", "data").groupBy(by).applyInPandas(run, f"{by} {entries.schema[by].dataType.simpleString()}, content binary")


def chosen(files: DataFrame, types: list[str], seeds: list[str] | None = None, rigs: list[int] | None = None) -> DataFrame:
    """Files of the chosen data types, seeds and cameras; a type that no file has is an error."""
    have = {r[0] for r in files.select("data_type").distinct().collect()}  # a few dozen types
    if unknown := set(types) - have:
        raise ValueError(f"no files of types {sorted(unknown)}")
    out = files.where(F.col("data_type").isin(types))
    out = out.where(F.col("seed").isin(seeds)) if seeds is not None else out
    return out.where(F.col("cam_rig").isin(rigs)) if rigs is not None else out


def to_delete(files: DataFrame, extensions: list[str], skip_coarse: bool = True) -> DataFrame:
    """Files to clean up by extension, outside coarse folders if asked."""
    out = files.where(F.regexp_extract("path", r"\.(\w+)$", 1).isin(extensions))
    return out.where(~F.col("path").contains("/coarse/")) if skip_coarse else out


def asof_tags(frames: DataFrame, tags: DataFrame) -> DataFrame:
    """Each frame with the newest mask-tag file at or before it."""
    from tagweave.operators.joins import asof

    return asof(frames, tags, ["seed"], "frame", ["tag_path"], "tag_", strict=False)
