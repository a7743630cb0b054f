"""Run logs as tables: crash summaries, stage times, job records, queues, nodes, key-value counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.functions.scalar import clock_seconds, ended, memory_gb, parsed_time, resource_map


def lines(spark: SparkSession, path: str) -> DataFrame:
    """One row a line, with the file it stands in. Files are read in parallel and never gathered."""
    return spark.read.text(path).select(F.col("value").alias("raw"), F.input_file_name().alias("file"))


def parsed(rows: DataFrame, pattern: str, names: list[str], column: str = "raw") -> DataFrame:
    """Rows that match, with a column for each group of ``pattern``; empty groups are null."""
    groups = {n: F.nullif(F.regexp_extract(F.col(column), pattern, k + 1), F.lit("")) for k, n in enumerate(names)}
    return rows.where(F.col(column).rlike(pattern)).withColumns(groups)


#: The layout of a line of a crash summary.
CRASH_LINE = r"""^.*\s.*\s(.*/([a-zA-Z0-9]*)/logs/(.*))\sreason=["'](.*)["']\snode='(.*)'"""


def crashes(rows: DataFrame, scripts: DataFrame | None = None) -> DataFrame:
    """Crash summaries: ``... PATH/JOB/logs/STAGE_0_0.err reason="..." node='...'`` lines; others are dropped.

    The stage is the log's name up to its first point or underscore. ``scripts`` (folder, text) are the pipeline scripts
    of scene folders: ``configs`` is what stands between ``-g`` and ``-p`` in the first line that runs the stage, and
    ``scenetype`` the first word of it; null where there is none.
    """
    out = parsed(rows, CRASH_LINE, ["log_path", "job_id", "log", "reason", "node"])
    out = out.withColumn("stage", F.substring_index(F.substring_index("log", ".", 1), "_", 1)).drop("log")
    if scripts is None:
        return out
    out = out.withColumn("folder", F.regexp_extract("log_path", r"^(.*)/[^/]*/[^/]*$", 1))
    runs = scripts.select("folder", F.posexplode(F.split("text", "\n")).alias("n", "line")).where(F.col("line").rlike("--task .*") & F.col("line").rlike("-g(.*)-p"))
    met = out.select("folder", "stage").distinct().join(runs, "folder").where(F.contains("line", F.concat(F.lit("--task "), F.col("stage"))))
    first = met.groupBy("folder", "stage").agg(F.min_by(F.regexp_extract("line", "-g(.*)-p", 1), "n").alias("configs"))
    first = first.withColumn("scenetype", F.regexp_extract("configs", r"^\s*(\S+)", 1))
    return out.join(first, ["folder", "stage"], "left").drop("folder")


def stage_times(rows: DataFrame, least_seconds: int = 1) -> DataFrame:
    """``[INFO] | [stage] finished in H:M:S`` lines; those under ``least_seconds`` are dropped."""
    out = parsed(rows, r"\| \[(.+?)\] finished in ([^\n]+)$", ["stage", "took"])
    return out.withColumn("seconds", clock_seconds(F.col("took"))).where(F.col("seconds") >= least_seconds)


def chunk_times(rows: DataFrame, column: str = "raw") -> DataFrame:
    """All ``HHh:MMm:SSs`` of each line, one a row, in seconds."""
    found = F.regexp_extract_all(F.col(column), F.lit(r"(\d+)h:(\d+)m:(\d+)s"), F.lit(0))
    rows = rows.select("*", F.posexplode(found).alias("place", "took"))
    g = lambda k: F.regexp_extract("took", r"(\d+)h:(\d+)m:(\d+)s", k).cast("bigint")
    return rows.withColumn("seconds", g(1) * 3600 + g(2) * 60 + g(3))


#: Layouts of job records: names and pattern. Both ``raw`` layouts have seconds and differ in what a status
#: may hold; ``completed`` has a clock and only jobs that ended well.
JOB_DIALECTS = {
    "raw": (["job_id", "name", "tres", "elapsed", "status", "node", "start"], r"^([0-9]+) +(\S+) +(\S+) +([0-9]+) +([A-Z_]+) +(node[0-9]+) +(\S+).*$"),
    "raw_letters": (["job_id", "name", "tres", "elapsed", "status", "node", "start"], r"^([0-9]+) +([^ ]+) +([^ ]+) +([0-9]+) +([A-Z]+) +(node[0-9]+) +([^ ]+).*$"),
    "completed": (["job_id", "name", "elapsed", "tres"], r"^(\d+) +(\S+) +(\d{2}:\d{2}:\d{2}) +\S*cpu=(.*),mem=\S+ +COMPLETED *$"),
}
#: Layouts of the lines that have a job's greatest memory.
MEMORY_LINES = {"raw": r"^([0-9]+)\.0 +.* +([0-9]*.?[0-9]*[KMG])", "completed": r"^(\d+).0 +python +([.\d]+[KMG]) .*COMPLETED *$"}


def jobs(rows: DataFrame, dialect: str = "raw") -> DataFrame:
    """Job records: job_id, name, elapsed seconds, cpus and gpus, and as the layout has them status, node, start and the request.

    ``raw`` layouts: the request is a map of ``key=value`` parts; no ``gpu`` in it is 0. ``completed``: CPUs are the first
    of the parts after ``cpu=``, and ``gpu`` and ``gpus`` come from ``gres/gpu:kind=n``, null where there is none.
    """
    names, form = JOB_DIALECTS[dialect]
    out = parsed(rows, form, names).withColumn("job_id", F.col("job_id").cast("bigint"))
    if dialect == "completed":
        gpu = r"(?:^|.*,)gres/gpu:([^,=]*)=(\d+),gres/gpu=.*"
        out = out.withColumns({"elapsed": clock_seconds(F.col("elapsed")), "cpus": F.substring_index("tres", ",", 1).try_cast("int")})
        return out.withColumns({"gpu": F.nullif(F.regexp_extract("tres", gpu, 1), F.lit("")), "gpus": F.regexp_extract("tres", gpu, 2).try_cast("int")}).drop("tres")
    out = out.withColumns({"elapsed": F.col("elapsed").cast("bigint"), "tres": resource_map(F.col("tres")), "start": parsed_time(F.col("start"))})
    out = out.withColumns({"cpus": F.col("tres")["cpu"].try_cast("int"), "gpus": F.coalesce(F.col("tres")["gpu"], F.lit("0")).try_cast("int"), "req_memory": F.col("tres")["mem"]})
    return out.withColumn("ended", ended(F.col("start"), F.col("elapsed")))


def job_memory(rows: DataFrame, dialect: str = "raw") -> DataFrame:
    """(job_id, mem): greatest memory in decimal GB from the lines of jobs' first steps; of several lines of a job the last counts."""
    found = parsed(rows.withColumn("_at", F.monotonically_increasing_id()), MEMORY_LINES[dialect], ["job_id", "mem"])
    last = found.groupBy(F.col("job_id").cast("bigint").alias("job_id")).agg(F.max_by("mem", "_at").alias("mem"))
    return last.withColumn("mem", memory_gb(F.col("mem")))


def pending(rows: DataFrame, prefix: str) -> DataFrame:
    """Queue lines ``id name (Reason)`` whose names begin with ``prefix``."""
    return parsed(rows, r"([0-9]+) +(\S+) +(\([a-zA-Z]+\))", ["job_id", "name", "state"]).where(F.startswith("name", F.lit(prefix)))


def nodes(rows: DataFrame, skip: str = "all") -> DataFrame:
    """Node lines ``node group allocated/idle/other/total``; the group ``skip`` lists every node again."""
    out = parsed(rows, r"^(\S+)\s+(\S+)\s+(\d+)/\d+/\d+/(\d+)", ["node", "grp", "allocated_cpus", "cpus"])
    return out.where(F.col("grp") != skip).withColumns({c: F.col(c).cast("int") for c in ("allocated_cpus", "cpus")})


def key_values(rows: DataFrame, column: str = "raw") -> DataFrame:
    """``key:value`` lines; others are skipped."""
    parts = F.split(F.col(column), ":")
    rows = rows.where(F.size(parts) == 2)
    return rows.select("*", F.trim(parts[0]).alias("key"), F.trim(parts[1]).try_cast("double").alias("value"))


def with_jobs(stages: DataFrame, found: DataFrame, groups: DataFrame) -> DataFrame:
    """Stages with their jobs' memory and their nodes' groups, where known (see ``jobs`` and ``job_memory``)."""
    return stages.join(found.select("job_id", "mem", "elapsed"), "job_id", "left").join(groups.select("node", "grp").dropDuplicates(["node"]), "node", "left")


def first_reason(rules: list[tuple[str, Column]], otherwise: str) -> Column:
    """The first reason whose condition holds."""
    out = None
    for reason, cond in rules:
        out = F.when(cond, reason) if out is None else out.when(cond, reason)
    return out.otherwise(otherwise) if out is not None else F.lit(otherwise)


def error_lines(text: Column, ignore: list[str] = ()) -> Column:
    """Error messages in a log, without those that hold a phrase to ignore."""
    found = F.regexp_extract_all(text, F.lit(r"(?m)^.*(?:Error|Exception|ERROR)\b.*$"), F.lit(0))
    return F.filter(found, lambda x: ~F.exists(F.array(*[F.lit(i) for i in ignore]).cast("array<string>"), lambda i: F.contains(x, i)))
