"""Jobs of scenes as a state machine over an append-only event stream, and windows over event time.

The state machine's rules are plain columns, so that a batch over the whole log and the stream agree.
Windows in event time are an extension: nothing like them is asked for by the state machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: States of a task that are final, the order of a scene's phases, what a queue calls a job that waits,
#: and what stands for the job of a task that succeeded before.
FINAL = ["succeeded", "failed", "cancelled"]
PHASES = ["coarse", "populate", "fine", "render", "ground_truth", "finalize"]
QUEUED = ["PENDING", "REQUEUED"]
SUCCEEDED_MARK = "MARK_AS_SUCCEEDED"


def task_state(submitted: Column, job_state: Column, has_finish: Column, crash_recorded: Column | None = None, force_cancelled: Column | None = None) -> Column:
    """A task's state: what was recorded of it comes first, then what the queue says, then whether its finish file is there.

    ``crash_recorded`` and ``force_cancelled`` may be left out (never). A job object that is the mark of success stands
    for a job that succeeded earlier.
    """
    said = lambda c: F.coalesce(c, F.lit(False)) if c is not None else F.lit(False)
    return (
        F.when(~said(submitted), "not_queued")
        .when(said(crash_recorded), "failed")
        .when(said(force_cancelled), "cancelled")
        .when(job_state == SUCCEEDED_MARK, "succeeded")
        .when(job_state.isin(QUEUED), "queued")
        .when(job_state == "RUNNING", "running")
        .when(said(has_finish), "succeeded")
        .otherwise("failed")
    )


def _event_state(rows: DataFrame, at: str = "") -> Column:
    """``task_state`` over the columns of events, of which the recorded ones may be missing."""
    names = rows.schema["e"].dataType.names if at else rows.columns
    col = lambda c: F.col(at + c) if c in names else None
    return task_state(col("submitted"), col("job_state"), col("has_finish"), col("crash_recorded"), col("force_cancelled"))


def latest_states(events: DataFrame) -> DataFrame:
    """The last event of each (seed, task), as a state; ties by event number."""
    said = [c for c in ("submitted", "job_state", "has_finish", "crash_recorded", "force_cancelled") if c in events.columns]
    last = events.groupBy("seed", "task").agg(F.max_by(F.struct(*said), F.struct("ts", "event_id")).alias("e"))
    return last.select("seed", "task", _event_state(last, "e.").alias("state"))


def task_table(scenes: DataFrame, frames: int, block: int, cameras: int) -> DataFrame:
    """All tasks of each scene in order: scene-wide ones once, view-dependent ones for each block of frames, camera-dependent
    ones for each block and camera; a task's place decides when it may run."""
    blocks = F.sequence(F.lit(1), F.lit(frames), F.lit(block))
    once = scenes.select("seed", F.explode(F.array(F.lit("coarse"), F.lit("populate"))).alias("phase"), F.lit(0).alias("frame"), F.lit(0).alias("camera"))
    views = scenes.select("seed", F.lit("fine").alias("phase"), F.explode(blocks).alias("frame"), F.lit(0).alias("camera"))
    cams = scenes.select("seed", F.explode(F.array(F.lit("render"), F.lit("ground_truth"))).alias("phase"))
    cams = cams.select("seed", "phase", F.explode(blocks).alias("frame")).select("*", F.explode(F.sequence(F.lit(0), F.lit(cameras - 1))).alias("camera"))
    end = scenes.select("seed", F.lit("finalize").alias("phase"), F.lit(0).alias("frame"), F.lit(0).alias("camera"))
    rows = once.unionByName(views).unionByName(cams).unionByName(end)
    order = F.array_position(F.array(*map(F.lit, PHASES)), F.col("phase"))
    name = F.concat_ws("_", "phase", F.col("camera").cast("string"), F.format_string("%04d", "frame"))
    return rows.select("seed", "phase", "frame", "camera", order.cast("int").alias("step"), name.alias("task"))


def runnable(tasks: DataFrame, states: DataFrame) -> DataFrame:
    """Tasks that aren't queued and whose scene has succeeded in all earlier steps; scenes with a failure have none."""
    rows = tasks.join(states, ["seed", "task"], "left").withColumn("state", F.coalesce("state", F.lit("not_queued")))
    steps = rows.groupBy("seed", "step").agg(F.bool_and(F.col("state") == "succeeded").cast("int").alias("done"), F.bool_or(F.col("state").isin("failed", "cancelled")).alias("broken"))
    w = Window.partitionBy("seed").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.select("seed", "step", (F.coalesce(F.min("done").over(w), F.lit(1)) == 1).alias("open"), F.bool_or("broken").over(Window.partitionBy("seed")).alias("fatal"))
    return rows.join(steps, ["seed", "step"]).where("open and not fatal and state = 'not_queued'").drop("open", "fatal")


def scene_states(tasks: DataFrame, states: DataFrame) -> DataFrame:
    """not_done, done or crashed, with counts, for each scene."""
    rows = tasks.join(states, ["seed", "task"], "left")
    bad, good = F.count_if(F.col("state").isin("failed", "cancelled")), F.count_if(F.col("state") == "succeeded")
    out = rows.groupBy("seed").agg(bad.alias("n_failed"), good.alias("n_succeeded"), F.count("*").alias("n"))
    return out.withColumn("scene_state", F.when(F.col("n_failed") > 0, "crashed").when(F.col("n_succeeded") == F.col("n"), "done").otherwise("not_done"))


def progress(tasks: DataFrame) -> DataFrame:
    """For each seed, over its tasks in order (seed, place, task, state, fatal): how many run and are concluded, the last
    concluded one, the first that failed fatally, and whether there is one."""
    concluded, going = F.col("state").isin(FINAL), ~F.col("state").isin([*FINAL, "not_queued"])
    broken = (F.col("state") == "failed") & F.col("fatal")
    return tasks.groupBy("seed").agg(
        F.count_if(going).alias("num_running"), F.count_if(concluded).alias("num_done"), F.max_by(F.when(concluded, F.col("task")), F.when(concluded, F.col("place"))).alias("last_concluded"),
        F.min_by(F.when(broken, F.col("task")), F.when(broken, F.col("place"))).alias("first_fatal"), F.coalesce(F.bool_or(broken), F.lit(False)).alias("any_fatal"),
    )


def next_launches(scenes: list[dict], queued: dict[str, int], greedy: bool = True, max_queued_task: int | None = None, max_queued_total: int | None = None, max_stuck_at_task: int | None = None) -> list[tuple[str, str]]:
    """(seed, task) to launch next, over scenes that aren't done or fatally broken (seed, in_flight, waiting: names of tasks
    that may run): those with most in flight first, if greedy.

    ``queued`` counts queued jobs by kind of task and grows with each launch; the counters are why this is a loop. A scene
    whose next place is taken by too many others waits.
    """
    order = sorted(scenes, key=lambda s: -s["in_flight"]) if greedy else list(scenes)
    at_place: dict[int, int] = {}
    for s in scenes:
        at_place[s["in_flight"]] = at_place.get(s["in_flight"], 0) + 1
    counts, out = dict(queued), []
    for s in order:
        if max_stuck_at_task is not None and at_place.get(s["in_flight"] + 1, 0) >= max_stuck_at_task:
            continue
        for task in s["waiting"]:
            kind = task.split("_")[0]
            if max_queued_task is not None and counts.get(kind, 0) >= max_queued_task:
                continue
            if max_queued_total is not None and sum(counts.values()) >= max_queued_total:
                continue
            out.append((s["seed"], task))
            counts[kind] = counts.get(kind, 0) + 1
    return out


def to_launch(candidates: DataFrame, slots: int, stuck_limit: int, disk_share: float, full: float = 0.99) -> DataFrame:
    """The next tasks for ``slots`` free slots: scenes in seed order, none for a kind that is stuck, none if the disk is full."""
    if disk_share >= full:
        return candidates.limit(0)
    held = candidates.where(F.col("stuck") < stuck_limit) if "stuck" in candidates.columns else candidates
    return held.orderBy("seed", "step", "task").limit(slots)


def streamed_states(events: DataFrame, forget_after_ms: int = 7 * 86_400_000) -> DataFrame:
    """The state of each (seed, task) each time it changes, from a stream of events (seed, task, ts, submitted, job_state, has_finish, ...).

    Custom state: the last state and the time of the last event, so that late events don't turn a task back. A task
    whose last event is ``forget_after_ms`` behind the watermark, which is as far behind the newest event, is forgotten,
    so the state doesn't grow for ever.
    """
    kind = "seed string, task string, state string, ts timestamp"

    def step(key, tables: Iterator[pd.DataFrame], held):
        if held.hasTimedOut:
            held.remove()
            return
        state, at = held.get if held.exists else ("not_queued", pd.Timestamp(0).value)
        out = []
        for t in tables:
            for r in t.sort_values("ts").itertuples():
                if r.ts.value < at:
                    continue
                at = r.ts.value
                if r.state != state:
                    state = r.state
                    out.append((*key, state, r.ts))
        held.update((state, at))
        held.setTimeoutTimestamp(at // 1_000_000 + forget_after_ms)
        if out:
            yield pd.DataFrame(out, columns=["seed", "task", "state", "ts"])

    rows = events.select("seed", "task", F.col("ts").cast("timestamp").alias("ts"), _event_state(events).alias("state"))
    rows = rows.withWatermark("ts", f"{forget_after_ms} milliseconds")
    return rows.groupBy("seed", "task").applyInPandasWithState(step, kind, "state string, at bigint", "append", "EventTimeTimeout")


def text_stream(spark: SparkSession, path: str) -> DataFrame:
    """New lines of append-only text tables as a stream."""
    return spark.readStream.text(path)


def tumbling(events: DataFrame, time: str, length: str, by: list[str], late: str) -> DataFrame:
    """Counts by window of event time, closed once the watermark has passed; for streams and batches."""
    rows = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return rows.groupBy(F.window(time, length), *by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *by, "n")
