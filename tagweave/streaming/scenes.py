"""Scenes as one state each in a stream of their tasks' events, and a watch that ends once every scene has.

Each scene keeps a map of its tasks' last events and a count of them by what became of them, in the state store; a timer
tells of scenes that nothing is heard of. Whatever order events come in, and however often, the last row of a scene is
what the batch over the whole log gives.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tagweave.streaming.tasks import _event_state

#: The state store that maps and timers need.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
ROWS = "seed string, scene_state string, n_running long, n_failed long, n_succeeded long, n long, ts timestamp"
COUNTS = "n_running long, n_failed long, n_succeeded long, n long, heard long, said string"
BAD, GOOD, GOING = ("failed", "cancelled"), ("succeeded",), ("queued", "running")


class Scene(StatefulProcessor):
    """What is known of one scene: its tasks' states, and how many are running, failed and succeeded."""

    def __init__(self, stuck_after_ms: int):
        self.stuck_after_ms = stuck_after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tasks = handle.getMapState("tasks", "task string", "state string, ts long, event_id long")
        self.counts = handle.getValueState("counts", COUNTS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = list(self.counts.get()) if self.counts.exists() else [0, 0, 0, 0, 0, ""]
        heard = False
        for table in rows:
            for r in table.itertuples():
                at = (r.ts.value, int(r.event_id))
                before = self.tasks.getValue((r.task,)) if self.tasks.containsKey((r.task,)) else None
                if before is not None and (before[1], before[2]) >= at:
                    continue  # late, or heard before
                for place, states in enumerate((GOING, BAD, GOOD)):
                    held[place] += (r.state in states) - (before is not None and before[0] in states)
                self.tasks.updateValue((r.task,), (r.state, *at))
                held[3], held[4], heard = int(r.n), max(held[4], at[0]), True
        said = "crashed" if held[1] else "done" if held[2] == held[3] else "not_done"
        if heard:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if said == "not_done":
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.stuck_after_ms)
        now = "/".join(map(str, (said, *held[:4])))
        fresh = now != held[5]
        held[5] = now
        self.counts.update(tuple(held))
        if fresh:
            yield self._row(key, said, held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.counts.get()
        yield self._row(key, "stuck", held)

    @staticmethod
    def _row(key, said: str, held) -> pd.DataFrame:
        return pd.DataFrame([(*key, said, *[int(x) for x in held[:4]], pd.Timestamp(held[4]))], columns=[c.split()[0] for c in ROWS.split(", ")])

    def close(self) -> None:
        pass


def streamed_scenes(events: DataFrame, tasks: DataFrame, stuck_after_ms: int = 3_600_000) -> DataFrame:
    """The state of each scene each time it changes: rows (seed, scene_state, n_running, n_failed, n_succeeded, n, ts).

    ``events``: a stream (seed, task, event_id, ts, submitted, job_state, has_finish, ...); of a task's events the last by
    ts, then event_id, holds, in whatever order they come. ``tasks``: the plan, a table (seed, task), which says
    when a scene is done. not_done, done and crashed are as in ``tasks.scene_states``; a scene that isn't done is called
    stuck, in a row of its own, when nothing new has been heard of it for ``stuck_after_ms``. There is no watermark, so
    no event is too late; the state is bounded by the plan. The session's state store must be STORE.
    """
    n = tasks.groupBy(F.col("seed").alias("of")).agg(F.count("*").alias("n"))
    rows = events.select(F.col("seed").cast("string").alias("seed"), "task", F.col("event_id").cast("long").alias("event_id"), F.col("ts").cast("timestamp").alias("ts"), _event_state(events).alias("state"))
    rows = rows.join(n, F.col("seed") == F.col("of")).drop("of")
    return rows.groupBy("seed").transformWithStateInPandas(statefulProcessor=Scene(stuck_after_ms), outputStructType=ROWS, outputMode="Update", timeMode="ProcessingTime")


def latest_scenes(rows: DataFrame) -> DataFrame:
    """The last row of each scene of what ``streamed_scenes`` has said."""
    known = F.col("n_running") + 2 * (F.col("n_failed") + F.col("n_succeeded"))
    last = rows.groupBy("seed").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "seed"]), F.struct("batch", F.col("scene_state") == "stuck", known)).alias("r"))
    return last.select("seed", "r.*").drop("batch")


def watched(states: DataFrame, n_scenes: int, folder: str, poll_seconds: float = 2.0, most_seconds: float | None = None) -> DataFrame:
    """Run a stream of scenes until ``n_scenes`` are done or crashed and have nothing running, or for ``most_seconds``; returns the
    table of all that it said, with its ``batch``.

    ``folder`` (shared) holds the table and the stream's checkpoint: run again after a loss, it goes on where it was.
    """
    spark = states.sparkSession
    table = f"{folder}/said"

    def put(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{table}/run={number}")  # once, however often it is tried

    query = states.writeStream.queryName(f"scenes-{uuid.uuid4().hex[:8]}").foreachBatch(put).option("checkpointLocation", f"{folder}/checkpoint").outputMode("update").start()
    schema = f"{ROWS}, batch long"
    began = time.monotonic()
    try:
        while not query.awaitTermination(poll_seconds) and (most_seconds is None or time.monotonic() - began < most_seconds):
            ended = latest_scenes(spark.read.schema(schema).parquet(table)).where("scene_state in ('done', 'crashed') and n_running = 0").count() if query.lastProgress else 0
            if ended >= n_scenes:
                break
    finally:
        query.stop()
    return spark.read.schema(schema).parquet(table)
