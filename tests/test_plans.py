import numpy as np
import pytest
from pyspark.sql import functions as F

from motionloom import cli
from motionloom.functions.vision import image_measures, visual_checks
from motionloom.operators import language, training, video
from motionloom.plans import policy as pol
from motionloom.plans.clean import CleanConfig, clean
from motionloom.plans.features import LayoutError, parse_layout
from motionloom.sources.datasets import Dataset, DatasetError, fingerprint, inside, inspect, read_dataset, validate
from motionloom.sources.publish import build_dataset, publish
from motionloom.streaming.audit import finite_counts, frame_stream

MAPPING = {"canonical": {"state": {"right": {"source": "q", "start": 3, "end": 5}, "left": [{"source": "q", "start": 0, "end": 2}]}, "action": {"arm": "u"}}}


def test_layouts(spark):
    lay = parse_layout(MAPPING).resolve({"q": 5, "u": 2})
    assert lay.select(["state.left", "state.right"]) == ("state", [0, 1, 2, 3])
    d = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0, 5.0], [9.0, 8.0])], "q array<double>, u array<double>")
    assert lay.project(d).first()["state"] == [4.0, 5.0, 1.0, 2.0]
    for bad, widths in ((MAPPING, {"q": 4, "u": 2}), (MAPPING, {"q": 5}), ({"canonical": {}}, {}), ({"x": 1}, {}), ({"canonical": {"state": {"a": {"sources": ["q"], "dimension": 3}}}}, {"q": 2})):
        with pytest.raises(LayoutError):
            parse_layout(bad).resolve(widths)
    with pytest.raises(LayoutError):
        lay.select(["state.left", "action.arm"])
    spin = parse_layout({"canonical": {"state": {"a": {"source": "q", "unit": "deg", "representation": "joint_position", "periodic": True}}}}).resolve({"q": 1})
    assert spin.features[0].period() == 360.0
    assert training.Contract(state_dim=1).findings(lay, set()) == ["state: 4 components exceed 1"]
    assert training.norm_problems({"a": {"mean": [0.0], "std": [1.0], "q01": [2.0], "q99": [1.0]}}, {"a": 1}) == ["a: q01 above q99"]


def test_policy(spark):
    found = spark.createDataFrame([(1, "groups/arm/velocity", False, True), (1, "finite", True, True), (2, "finite", False, False), (3, "jerk", False, True), (4, "finite", True, True)], "episode_index long, path string, passed boolean, evaluated boolean")
    p = pol.Policy(rules={"velocity": pol.Rule("reject_episode", "warn"), "finite": pol.Rule("abort", "reject_episode")}, reject=(4,))
    assert {(r[0], r[3]) for r in pol.decisions(found, p).collect()} == {(1, "reject_episode"), (2, "reject_episode"), (3, "warn")}
    assert {r[0]: (r[1], r[2]) for r in pol.verdicts(found, p).collect()} == {1: (False, False), 2: (False, False), 3: (True, False), 4: (False, False)}
    with pytest.raises(ValueError):
        p.check({"finite"})
    with pytest.raises(ValueError):
        pol.Rule("explode")


def test_clean_publish_and_read_back(spark, frames, episodes, tmp_path):
    s = [[0.0, 0.0]] * 3 + [[float(i), 0.0] for i in range(1, 6)] + [[float("nan"), 0.0]]
    f = frames(s).unionByName(frames([[float(i), 1.0] for i in range(4)], episode=2, first=20))
    planned, kept = clean(f, episodes(1, 2), None, CleanConfig(width=2, nonfinite="drop", trim_edges=False))
    assert {r["episode_index"]: r["kept_rows"] for r in planned.collect()} == {1: 8, 2: 4}
    tasks = spark.createDataFrame([(0, "lift")], "task_index long, task string")
    fr = build_dataset(kept, tasks)
    out = str(tmp_path / "clean")
    d = publish(out, fr, tasks, {"fps": 10.0})
    assert inspect(d)["frames"] == 12 and [r["index"] for r in d.frames.orderBy("index").collect()] == list(range(12))
    assert validate(spark, out) == [] and read_dataset(spark, out).rows(2, 5).count() == 3
    with pytest.raises(FileExistsError):
        publish(out, fr, tasks, {"fps": 10.0})
    with pytest.raises(DatasetError):
        publish(str(tmp_path / "bad"), fr.withColumn("action", F.array(F.lit(float("nan")))), tasks, {"fps": 10.0})
    assert not (tmp_path / "bad").exists()
    before = fingerprint(out)
    (tmp_path / "clean/meta/info.json").write_text('{"codebase_version": "v9", "fps": 10}')
    assert fingerprint(out) != before and "unknown" in validate(spark, out)[0]
    with pytest.raises(DatasetError):
        inside(out, "../secret")


def test_gap_between_ranges_of_episodes(spark):
    starts = {4094: 0, 4095: 2, 4096: 4, 8191: 6, 12288: 9, 12289: 11}
    e = spark.createDataFrame([(k, 2, v, v + 2) for k, v in starts.items()], "episode_index long, length long, dataset_from_index long, dataset_to_index long")
    f = e.select("episode_index", F.explode(F.sequence("dataset_from_index", F.col("dataset_to_index") - 1)).alias("index"))
    assert [tuple(r) for r in Dataset("", {}, f, e, None).problems().collect()] == [(12288, "gap before")]
    moved = e.withColumn("dataset_from_index", F.when(F.col("episode_index") == 4096, F.lit(3)).otherwise(F.col("dataset_from_index")))
    assert {r[0]: r[1] for r in Dataset("", {}, f, moved, None).problems().collect()} == {4096: "range differs; gap before", 12288: "gap before"}


def test_reports_are_whole(spark, frames, episodes, tmp_path, capsys, monkeypatch):
    n = 1005
    f = frames([[float(i), 0.0] for i in range(2 * n)]).withColumn("episode_index", F.floor(F.col("global_index") / 2))
    d = str(tmp_path / "set")
    tasks = spark.createDataFrame([(0, "lift")], "task_index long, task string")
    _, kept = clean(f, episodes(*range(n)), None, CleanConfig(width=2, trim_edges=False))
    publish(d, build_dataset(kept, tasks), tasks, {"fps": 10.0})
    monkeypatch.setattr(cli, "EXCERPT_ROWS", 3)
    out = str(tmp_path / "audit")
    assert cli.main(["audit", d, "--width", "2", "--output", out]) == 0 and spark.read.parquet(out).count() == n
    said = capsys.readouterr().out
    assert "3 of 1005 rows printed" in said and said.count('"episode_index"') == 3
    assert cli.main(["audit", d, "--width", "2", "--output", out]) == 1
    capsys.readouterr()
    assert cli.main(["check", d]) == 0 and "no problems" in capsys.readouterr().out
    wrong = read_dataset(spark, d).episodes.withColumn("length", F.col("length") + 1).toPandas()
    for p in (tmp_path / "set/meta/episodes").rglob("*.parquet"):
        p.unlink()
    wrong.to_parquet(tmp_path / "set/meta/episodes/wrong.parquet")
    spark.catalog.clearCache()
    assert len(validate(spark, d)) == n
    assert cli.main(["check", d]) == 1
    assert capsys.readouterr().out.count("length differs") == n
    assert cli.main(["check", d, "--output", str(tmp_path / "problems")]) == 1 and spark.read.parquet(str(tmp_path / "problems")).count() == n


def test_interpolating_clean(frames, episodes):
    f = frames([[0.0, 0.0], [float("nan"), 0.0], [2.0, 0.0]])
    _, kept = clean(f, episodes(1), None, CleanConfig(width=2, nonfinite="interpolate", trim_edges=False))
    assert [r["state"][0] for r in kept.orderBy("pos").collect()] == [0.0, 1.0, 2.0]
    with pytest.raises(ValueError):
        clean(f, episodes(1), None, CleanConfig(width=2, policy=pol.Policy(rules={"finite": pol.Rule("abort")})))


def test_language(spark):
    tasks = spark.createDataFrame([(0, "lift the cup"), (1, " "), (2, "a"), (2, "b")], "task_index long, task string")
    rows = [(1, 0, 0, "lift the cup", "x"), (1, 1, 0, "other text", "x"), (2, 0, 1, None, "x"), (3, 0, 9, "unknown", "x"), (3, 1, None, "12", "x"), (4, 0, 2, "c", "x"), (5, 0, -1, "ok text", "x"), (None, 0, 0, "t", "x")]
    s = spark.createDataFrame(rows + rows[:1], "episode_index long, sample_index long, task_index long, task_text string, task_source string")
    got = {r["episode_index"]: r for r in language.language_check(s, tasks).collect()}
    assert got[1]["inconsistent_mapping"] == 1 and got[1]["samples"] == 2 and not got[1]["passed"]
    assert got[2]["null_task_text"] == 1 and got[2]["with_task"] == 0
    assert got[3]["unresolved_task_index"] == 1 and got[3]["missing_task_index"] == 1 and got[3]["warnings"] == 2 and got[3]["tasks"] == 2
    assert got[4]["ambiguous_task_index"] == 1 and got[4]["warnings"] == 1 and got[5]["task_index_out_of_range"] == 1


def test_video_and_vision(spark):
    refs = spark.createDataFrame([(1, "k", "f", 0.0, 1.0), (2, "k", "f", 0.9, 2.0), (3, "k", "g", 0.0, 0.5)], "episode_index long, key string, file string, start double, end double")
    assert [r["episode_index"] for r in video.overlaps(refs).collect()] == [2]
    stamps = spark.createDataFrame([("f", i / 10) for i in range(20)], "file string, pts double")
    assert {r["episode_index"]: r["decoded"] for r in video.frames_in_intervals(refs, stamps).collect()} == {1: 10, 2: 11, 3: 0}
    black, noise = np.zeros((6, 8, 3), np.uint8), np.random.default_rng(0).integers(0, 255, (6, 8, 3)).astype(np.uint8)
    images = spark.createDataFrame([(1, bytearray(black.tobytes())), (2, bytearray(noise.tobytes())), (3, None)], "id long, bytes binary")
    m = image_measures(images, (6, 8, 3)).withColumn("g", F.col("id"))
    got = {r["g"]: r for r in visual_checks(m, "g").collect()}
    assert not got[1]["black_passed"] and got[2]["black_passed"] and got[2]["blur_passed"] and not got[3]["evaluated"]


def test_stream(spark, frames, tmp_path):
    f = frames([[0.0, 0.0], None, [1.0, 1.0]])
    f.unionByName(f.limit(2)).coalesce(1).write.parquet(str(tmp_path / "in"))
    q = finite_counts(frame_stream(spark, str(tmp_path / "in"), f.schema)).writeStream.format("memory").queryName("audit").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert [(r["n_rows"], r["bad_rows"]) for r in spark.table("audit").collect()] == [(3, 1)]
