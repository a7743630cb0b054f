"""The stream of scenes against the batch over the whole log, on shuffled, late and repeated events."""

import random

import pytest
from pyspark.sql import functions as F

from tagweave.streaming import scenes, tasks

EVENTS = "seed string, task string, event_id long, ts timestamp, submitted boolean, job_state string, has_finish boolean"


@pytest.fixture
def store(spark):
    own = dict([scenes.STORE, ("spark.sql.shuffle.partitions", "1")])
    before = {k: spark.conf.get(k) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def log(seeds, broken):
    """All events of some scenes: each task waits, runs and ends; in broken scenes one fails."""
    import datetime

    at, rows, n = datetime.datetime(2024, 1, 1), [], 0
    plan = [(s, f"task_{k}") for s in seeds for k in range(4)]
    for s, t in plan:
        ends = (None, False) if s in broken and t == "task_2" else (None, True)
        for state, done in (("PENDING", False), ("RUNNING", False), ends):
            n += 1
            rows.append((s, t, n, at + datetime.timedelta(seconds=7 * n), True, state, done))
    return plan, rows


def test_stream_and_batch_agree(store, tmp_path):
    spark, r = store, random.Random(4)
    seeds = [f"s{k}" for k in range(6)]
    plan, rows = log(seeds, {"s1", "s4"})
    told = [*rows, *r.sample(rows, 20)]
    r.shuffle(told)
    for k in range(3):  # in three files, one a batch
        spark.createDataFrame(told[k::3], EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "events"))
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "events"))
    plan = spark.createDataFrame(plan, "seed string, task string")
    said = scenes.watched(scenes.streamed_scenes(stream, plan), len(seeds), str(tmp_path / "out"), 1.0, 120.0)
    got = {x.seed: (x.scene_state, x.n_failed, x.n_succeeded, x.n) for x in scenes.latest_scenes(said).collect()}
    batch = tasks.scene_states(plan, tasks.latest_states(spark.createDataFrame(rows, EVENTS)))
    assert got == {x.seed: (x.scene_state, x.n_failed, x.n_succeeded, x.n) for x in batch.collect()}
    assert {s for s, x in got.items() if x[0] == "crashed"} == {"s1", "s4"} and {x[0] for x in got.values()} == {"done", "crashed"}
    assert said.where(F.col("scene_state") == "not_done").count() > 0


def test_scenes_that_nothing_is_heard_of_are_stuck(store, tmp_path):
    import datetime

    spark, at = store, datetime.datetime(2024, 1, 1)
    first = [("old", "task_0", 1, at, True, "RUNNING", False), ("new", "task_0", 2, at, True, "RUNNING", False)]
    later = [("new", "task_0", 3, at + datetime.timedelta(hours=3), True, "RUNNING", False)]
    latest = [("new", "task_0", 4, at + datetime.timedelta(hours=3, minutes=1), True, None, True)]
    for part in (first, later, latest):
        spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "events"))
    plan = spark.createDataFrame([("old", "task_0"), ("new", "task_0")], "seed string, task string")
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "events"))
    said = scenes.watched(scenes.streamed_scenes(stream, plan, 200), 1, str(tmp_path / "out"), 1.0, 60.0)
    got = [(x.seed, x.scene_state) for x in said.orderBy("batch").collect()]
    assert ("old", "stuck") in got and [s for n, s in got if n == "new"][-1] == "done"
    assert {x.seed: x.scene_state for x in scenes.latest_scenes(said).collect()}["new"] == "done"
