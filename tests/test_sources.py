"""Logs, frame files, state tables and the task state machine."""

import io
import os
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagweave.sources import frames, logs, state
from tagweave.streaming import tasks


def raw(spark, *lines):
    return spark.createDataFrame([(x,) for x in lines], "raw string")


def test_logs(spark):
    summary = raw(
        spark, """2024-01-02 03:04:05 /runs/a/7f3a/logs/finebig_0_0.err reason="out of memory" node='node7'""",
        "seed crash /runs/a/12/logs/coarse.err reason='it broke' node='node1'", "nothing here",
    )
    scripts = spark.createDataFrame([("/runs/a/7f3a", "#!/bin/sh\nrun --task coarse -g plain -p x\nrun --task finebig -g desert simple -p y")], "folder string, text string")
    out = {r.job_id: r for r in logs.crashes(summary, scripts).collect()}
    assert {k: (r.log_path, r.stage, r.reason, r.node) for k, r in out.items()} == {
        "7f3a": ("/runs/a/7f3a/logs/finebig_0_0.err", "finebig", "out of memory", "node7"), "12": ("/runs/a/12/logs/coarse.err", "coarse", "it broke", "node1"),
    }
    assert (out["7f3a"].configs, out["7f3a"].scenetype, out["12"].configs) == (" desert simple ", "desert", None)
    times = logs.stage_times(raw(spark, "[t] [INFO] | [coarse] finished in 0:01:05", "[t] [INFO] | [tiny] finished in 0:00:00.4", "[t] [INFO] | [long] finished in 1 day, 2:00:00"))
    assert {r.stage: r.seconds for r in times.collect()} == {"coarse": 65, "long": 93600}
    assert [r.seconds for r in logs.chunk_times(raw(spark, "a 01h:02m:03s b 00h:00m:09s")).orderBy("place").collect()] == [3723, 9]
    lines = raw(
        spark, "12   run_ab12_coarse  billing=4,cpu=4,gpu=1,mem=24G,node=1   3600  COMPLETED  node012  2024-01-01T00:00:00   ", "12.0  python   cpu=4,mem=24G  3600  COMPLETED  node012  2024-01-01T00:00:00  2048M",
        "13  run_cd34_fine  cpu=2,mem=8G  10  OUT_OF_MEMORY  node3  2024-01-01T00:00:00", "14  pending  cpu=2,mem=8G  10  PENDING  None  Unknown", "bad",
    )
    got = {r.job_id: r for r in logs.jobs(lines).collect()}
    assert {k: (r.elapsed, r.cpus, r.gpus, r.req_memory, r.status) for k, r in got.items()} == {12: (3600, 4, 1, "24G", "COMPLETED"), 13: (10, 2, 0, "8G", "OUT_OF_MEMORY")}
    assert str(got[12].ended) == "2024-01-01 01:00:00" and [r.job_id for r in logs.jobs(lines, "raw_letters").collect()] == [12]
    assert [tuple(r) for r in logs.job_memory(lines).collect()] == [(12, 2.048)]
    done = raw(spark, "5  run_AB_render  01:02:03  billing=8,cpu=8,gres/gpu:a100=2,gres/gpu=2,mem=48G,node=1  COMPLETED  ", "6  run_CD_fine  00:00:10  cpu=4,mem=24G,node=1  COMPLETED", "7  run_x  00:00:10  cpu=4,mem=24G,node=1  FAILED", "5.0  python  1500000K  01:02:03  COMPLETED ")
    assert [(r.job_id, r.elapsed, r.cpus, r.gpu, r.gpus) for r in logs.jobs(done, "completed").orderBy("job_id").collect()] == [(5, 3723, 8, "a100", 2), (6, 10, 4, None, None)]
    assert [tuple(r) for r in logs.job_memory(done, "completed").collect()] == [(5, 1.5)]
    groups = spark.createDataFrame([("node012", "gpu")], "node string, grp string")
    joined = logs.with_jobs(spark.createDataFrame([(12, "coarse", "node012"), (99, "fine", "node4")], "job_id long, stage string, node string"), logs.jobs(lines).join(logs.job_memory(lines), "job_id", "left"), groups)
    assert {(r.job_id, r.mem, r.elapsed, r.grp) for r in joined.collect()} == {(12, 2.048, 3600, "gpu"), (99, None, None, None)}
    assert logs.pending(raw(spark, "1 abc   (Resources)", "2 xbc (Priority)", "3 abd node12"), "ab").count() == 1
    assert {(r.node, r.cpus) for r in logs.nodes(raw(spark, "n1 gpu 3/1/0/4", "n1 all 3/1/0/4")).collect()} == {("n1", 4)}
    assert {(r.key, r.value) for r in logs.key_values(raw(spark, "a: 3", "b:x:y", "c")).collect()} == {("a", 3.0)}
    r = raw(spark, "fine\nFooError: bad\nBarError: skip me\n").select(logs.error_lines(F.col("raw"), ["skip"]).alias("e")).first()
    assert r.e == ["FooError: bad"]


def test_suffixes(spark):
    names = ["1_0_0048_2", "1", "Image_1_2_3_4.png", "a_b", "_1_2_0003_4_", "_0_0_0001_0.tar.gz", "", "1_2_3"]
    rows = spark.createDataFrame([(n,) for n in names], "s string").select("s", frames.parsed_suffix(F.col("s")).alias("p"))
    got = {r.s: tuple(r.p) if r.p else None for r in rows.collect()}
    assert got == dict(zip(names, [(1, 0, 48, 2), None, (1, 2, 3, 4), None, (1, 2, 3, 4), (0, 0, 1, 0), None, None], strict=True))
    for bad in ("1_2_3_4_5_6", "a_b_c_d"):
        with pytest.raises(Exception, match="no suffix|CAST_INVALID_INPUT"):
            spark.range(1).select(frames.parsed_suffix(F.lit(bad))).collect()
    assert spark.range(1).select(frames.formatted_suffix(F.lit(1), F.lit(0), F.lit(48), F.lit(2))).first()[0] == "1_0_0048_2"


def test_frame_files(spark, tmp_path):
    for kind, ext in (("Image", "png"), ("Depth", "npy")):
        for frame in (1, 2, 4):
            d = tmp_path / "frames" / kind / "camera_0"
            d.mkdir(parents=True, exist_ok=True)
            p = d / f"{kind}_0_0_{frame:04d}_0.{ext}"
            np.save(p, np.full((2, 2), frame)) if ext == "npy" else p.write_bytes(b"png")
    (tmp_path / "frames" / "notes.txt").write_text("x")
    files = frames.frame_files(spark, str(tmp_path), content=True)
    assert files.count() == 6 and {tuple(r)[3:] for r in frames.frame_bounds(files).collect()} == {(1, 4, 3)}
    assert {(r.data_type, r.frame) for r in frames.missing_frames(files, 1, 4, ["Image", "Depth"]).collect()} == {("Image", 3), ("Depth", 3)}
    arrays = frames.decoded(files).collect()
    assert len(arrays) == 3 and all(list(r["shape"]) == [2, 2] for r in arrays)
    import json

    nested = {r.data_type: json.loads(r["index"]) for r in frames.summary(files).collect()}
    assert set(nested) == {"Image", "Depth"} and set(nested["Image"]["png"]["0"]["0"]["0"]) == {"0001", "0002", "0004"} and nested["Depth"]["npy"]["0"]["0"]["0"]["0001"].endswith("Depth_0_0_0001_0.npy")
    assert frames.chained([files, files]).select("scene").distinct().count() == 2
    assert frames.chosen(files.withColumn("seed", F.lit("s")), ["Image"], ["s"], [0]).count() == 3
    with pytest.raises(ValueError):
        frames.chosen(files, ["Nothing"])
    here = files.withColumn("path", F.regexp_extract("path", "(frames/.*)$", 1))
    kept = frames.kept_paths(here, [("KEEP", "frames/*/*/*_0004_0.npy"), ("DELETE", "frames/*/*/*_0004_*"), ("KEEP_MANDATORY", "frames/Image/*/*_0001_*")])
    assert {r.action: r["count"] for r in kept.groupBy("action").count().collect()} == {"DELETE": 1, "KEEP": 2, "UNCOVERED": 3}
    assert frames.kept_paths(here, [("KEEP", "frames/Image")]).where("action = 'KEEP'").count() == 3 and frames.kept_paths(here, [("KEEP", "*.npy")]).where("action = 'KEEP'").count() == 0
    with pytest.raises(ValueError):
        frames.kept_paths(here, [("KEEP_MANDATORY", "nothing*")])
    with pytest.raises(Exception, match="deleted and kept"):
        frames.kept_paths(here, [("DELETE", "frames"), ("KEEP", "frames/Image")]).collect()
    assert frames.matching(here, "frames/*/camera_?/*.npy", ["_0002_"]).count() == 2
    assert frames.listed(spark, str(tmp_path), "*.npy").count() == 3
    copied = frames.uploaded(frames.listed(spark, str(tmp_path / "frames"), "*.npy"), str(tmp_path / "frames"), f"file://{tmp_path}/there").collect()
    assert len(copied) == 3 and len(list((tmp_path / "there").rglob("*.npy"))) == 3
    lines = raw(spark, "  .   D  0 x", "  a.txt   A  12 Mon", "  sub   D  0 Mon", "", "  123 blocks of size 4096")
    assert {tuple(r) for r in frames.listing(lines, "/base/").collect()} == {("/base/a.txt", False), ("/base/sub", True)}
    assert frames.to_delete(files, ["npy"]).count() == 3


def test_archives(spark):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("frames/Image/camera_0/a.png", b"12")
        z.writestr("frames/Depth/camera_0/a.npy", b"345")
    files = spark.createDataFrame([("p.zip", bytearray(buffer.getvalue()))], "path string, content binary")
    entries = frames.zip_entries(files, content=True)
    assert {(r.entry, r.size) for r in entries.collect()} == {("frames/Image/camera_0/a.png", 2), ("frames/Depth/camera_0/a.npy", 3)}
    import tarfile

    packed = frames.tarred(entries, "path").first().content
    assert sorted(m.name for m in tarfile.open(fileobj=io.BytesIO(packed))) == ["frames/Depth/camera_0/a.npy", "frames/Image/camera_0/a.png"]
    again = frames.zipped(entries.where(F.col("entry").contains("/Image/camera_0/")), "path")
    assert [r.entry for r in frames.zip_entries(again).collect()] == ["frames/Image/camera_0/a.png"]


def test_state(spark, tmp_path):
    members = spark.createDataFrame([("a", "chair"), ("a", "old"), ("b", "chair")], "name string, collection string")
    objects = state.state_from_collections(members)
    assert {r["name"]: r.tags for r in objects.collect()} == {"a": ["obj:a", "sem:chair", "sem:old"], "b": ["obj:b", "sem:chair"]}
    text = {r["name"]: r.json for r in state.state_json(objects, spark.createDataFrame([("a", "b", "touching")], "src string, dst string, kind string")).collect()}
    assert '"relations":[{"relation":"touching","target":"b"}]' in text["a"] and text["b"].index("active") < text["b"].index("name")
    blob = objects.withColumn("mesh", F.lit(b"x"))
    assert '"mesh":"<not-serialized>"' in state.state_json(blob, spark.createDataFrame([], "src string, dst string, kind string")).first().json
    state.write_csv(state.stage_records(spark, [{"name": "coarse", "ran": True, "mem_at_finish": 5, "obj_count": 2, "instance_count": 3}, {"name": "fine", "ran": False}]), str(tmp_path / "stages"))
    assert sorted((r["name"], r.ran, r.obj_count) for r in spark.read.csv(str(tmp_path / "stages"), header=True).collect()) == [("coarse", "true", "2"), ("fine", "false", None)]
    wide = state.wide_status(spark.createDataFrame([("s", "coarse", "done"), ("s", "fine", "failed")], "seed string, task string, state string"), ["coarse", "fine"])
    state.write_csv(wide.withColumn("configs", F.lit("['a', 'b']")), str(tmp_path / "db"))
    back = state.scene_table(spark, str(tmp_path / "db")).first()
    assert back.fine == "failed" and back.configs == ["a", "b"]
    series = state.series_lines(spark.createDataFrame([(2.0, 1.0), (1.0, 3.0)], "timestamp double, x double"), ["timestamp", "x"])
    state.write_lines(series, F.col("value"), str(tmp_path / "imu"))
    state.write_lines(spark.createDataFrame([("# note",)], "value string"), F.col("value"), str(tmp_path / "imu"))
    assert sorted(tuple(r) for r in state.read_series(spark, str(tmp_path / "imu"), ["timestamp", "x"]).collect()) == [(1.0, 3.0), (2.0, 1.0)]
    disk = state.disk_report(spark.createDataFrame([("total used free",), (f"/dev/a {4 << 20} {1 << 20} {3 << 20} 25% /",)], "raw string")).first()
    assert tuple(disk) == (4.0, 1.0, 3.0, 0.25)
    assert spark.range(1).select(state.tag_dictionary(F.lit('{"a.b": 3, "c": 4}'))).first()[0] == {"a.b": 3, "c": 4}
    faces = spark.createDataFrame([(0, 1), (1, 2), (2, None)], "face int, tag long")
    names = spark.createDataFrame([(1, "a.b"), (2, "a")], "id long, name string")
    assert {r.face: r.hit for r in state.tagged_faces(faces, names, ["a"], ["b"]).collect()} == {0: False, 1: True, 2: False}
    assert state.merged_config({"a": {"x": 1}, "b": 2}, {"a": {"y": 3}}) == {"a": {"x": 1, "y": 3}, "b": 2}
    with pytest.raises(ValueError):
        state.merged_config({"a": 1, "b": 2}, exclusive=[{"a", "b"}])
    with pytest.raises(ValueError):
        state.merged_config({}, mandatory=["seed"])


def test_tasks(spark):
    plan = tasks.task_table(spark.createDataFrame([("s1",), ("s2",)], "seed string"), 8, 4, 2)
    assert plan.where("seed = 's1'").count() == 2 + 2 + 2 * 2 * 2 + 1
    kind = "seed string, task string, ts timestamp, event_id long, submitted boolean, job_state string, has_finish boolean"
    t = lambda n: __import__("datetime").datetime(2024, 1, 1, 0, n)
    first = plan.where("seed = 's1' and phase = 'coarse'").first().task
    events = spark.createDataFrame([("s1", first, t(1), 1, True, "PENDING", False), ("s1", first, t(2), 2, True, "COMPLETED", True), ("s2", first, t(1), 3, True, "COMPLETED", False)], kind)
    states = tasks.latest_states(events)
    assert {(r.seed, r.state) for r in states.collect()} == {("s1", "succeeded"), ("s2", "failed")}
    assert {(r.seed, r.phase) for r in tasks.runnable(plan, states).collect()} == {("s1", "populate")}
    assert {r.seed: r.scene_state for r in tasks.scene_states(plan, states).collect()} == {"s1": "not_done", "s2": "crashed"}
    said = spark.createDataFrame(
        [(False, None, True, None, None), (True, "RUNNING", True, True, True), (True, "RUNNING", True, None, True), (True, "MARK_AS_SUCCEEDED", False, None, None), (True, "REQUEUED", True, None, None), (True, "RUNNING", True, None, None), (True, "CANCELLED", False, None, None), (True, "TIMEOUT", True, None, None)],
        "s boolean, j string, f boolean, c boolean, k boolean",
    )
    got = [r[0] for r in said.select(tasks.task_state(*map(F.col, "sjfck"))).collect()]
    assert got == ["not_queued", "failed", "cancelled", "succeeded", "queued", "running", "failed", "succeeded"]
    flying = [{"seed": "a", "in_flight": 0, "waiting": ["coarse_0"]}, {"seed": "b", "in_flight": 2, "waiting": ["fine_1", "fine_2"]}, {"seed": "c", "in_flight": 0, "waiting": ["coarse_0"]}]
    assert tasks.next_launches(flying, {}) == [("b", "fine_1"), ("b", "fine_2"), ("a", "coarse_0"), ("c", "coarse_0")]
    assert tasks.next_launches(flying, {"fine": 1}, max_queued_task=2) == [("b", "fine_1"), ("a", "coarse_0"), ("c", "coarse_0")]
    assert tasks.next_launches(flying, {"fine": 1}, max_queued_total=3, greedy=False) == [("a", "coarse_0"), ("b", "fine_1")]
    assert [s for s, _ in tasks.next_launches([*flying, {"seed": "d", "in_flight": 1, "waiting": []}], {}, max_stuck_at_task=1)] == ["b", "b"]
    assert tasks.to_launch(plan, 3, 5, 0.5).count() == 3 and tasks.to_launch(plan, 3, 5, 0.995).count() == 0


def test_streams(spark, tmp_path):
    kind = "seed string, task string, ts timestamp, submitted boolean, job_state string, has_finish boolean"
    t = lambda n: __import__("datetime").datetime(2024, 1, 1, 0, n)
    rows = [("s", "a", t(1), True, "PENDING", False), ("s", "a", t(2), True, "RUNNING", False), ("s", "a", t(3), True, "COMPLETED", True), ("s", "b", t(1), False, None, False)]
    spark.createDataFrame(rows, kind).coalesce(1).write.parquet(str(tmp_path / "in"))
    # an event in a later batch that is older than the last one, which changed nothing, doesn't turn a task back
    for n, (job, at) in enumerate((("RUNNING", 10), ("RUNNING", 20), ("TIMEOUT", 15))):
        spark.createDataFrame([("s", "c", t(at), True, job, False)], kind).coalesce(1).write.parquet(str(tmp_path / f"later{n}"))
    late = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(str(tmp_path / "later*"))
    q = tasks.streamed_states(late).writeStream.format("memory").queryName("late").option("checkpointLocation", str(tmp_path / "ck0")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [r.state for r in spark.table("late").collect()] == ["running"]
    stream = spark.readStream.schema(kind).parquet(str(tmp_path / "in"))
    q = tasks.streamed_states(stream).writeStream.format("memory").queryName("states").option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [(r.task, r.state) for r in spark.table("states").orderBy("ts").collect()] == [("a", "queued"), ("a", "running"), ("a", "succeeded")]
    windows = tasks.tumbling(stream, "ts", "1 minute", ["seed"], "0 seconds")
    q = windows.writeStream.format("memory").queryName("windows").option("checkpointLocation", str(tmp_path / "ck2")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {(r.start.minute, r.n) for r in spark.table("windows").collect()} >= {(1, 2), (2, 1)}
    os.makedirs(tmp_path / "text", exist_ok=True)
    (tmp_path / "text" / "a.txt").write_text("one\ntwo\n")
    q = tasks.text_stream(spark, str(tmp_path / "text")).writeStream.format("memory").queryName("lines").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("lines").count() == 2


def test_queries_and_sql_have_the_same_names():
    import __spark_entry__

    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 60
