import numpy as np
import pytest
from pyspark.sql import functions as F

from motionloom.operators import checks, statistics, transforms
from motionloom.operators.alignment import aligned, increasing
from motionloom.operators.trajectory import trajectory


def view(frames, episodes, states, halo=0, chunk=1 << 16, **more):
    return trajectory(frames(states, **more), episodes(1), width=2, halo=halo, chunk_rows=chunk)


@pytest.mark.parametrize("chunk", [3, 1 << 16])
def test_interpolation_equals_numpy(frames, episodes, chunk):
    n = float("nan")
    x = [n, n, 1.0, n, n, n, n, 5.0, 2.0, n, n]
    t = np.cumsum([0.0, 0.1, 0.3, 0.1, 0.1, 0.7, 0.1, 0.1, 0.2, 0.1, 0.1])
    r = view(frames, episodes, [[v, 0.0] for v in x], times=t.tolist(), chunk=chunk)
    got = [a["filled"] for a in transforms.interpolated(r, F.col("state")[0]).orderBy("pos").collect()]
    ok = ~np.isnan(x)
    assert got == pytest.approx(np.interp(t, t[ok], np.array(x)[ok]).tolist())
    by_row = [a["filled"] for a in transforms.interpolated(r, F.col("state")[0], by_time=False).orderBy("pos").collect()]
    assert by_row == pytest.approx(np.interp(np.arange(11), np.arange(11)[ok], np.array(x)[ok]).tolist())
    ahead = [a["filled"] for a in transforms.forward_filled(r, F.col("state")[0]).orderBy("pos").collect()]
    assert ahead == [None, None, 1.0, 1.0, 1.0, 1.0, 1.0, 5.0, 2.0, 2.0, 2.0]


def test_all_missing_differs_by_path(frames, episodes):
    r = view(frames, episodes, [None, None])
    assert {a["filled"] for a in transforms.interpolated(r, F.col("state")[0]).collect()} == {None}
    assert {a["filled"] for a in transforms.interpolated(r, F.col("state")[0], by_time=False).collect()} == {0.0}


@pytest.mark.parametrize("chunk", [4, 1 << 16])
def test_masks_and_new_numbers(spark, frames, episodes, chunk):
    s = [[0.0, 0.0]] * 3 + [[float(i), 0.0] for i in range(1, 5)] + [[4.0, 0.0]] * 2 + [[float("nan"), 0.0]]
    f = frames(s).unionByName(frames([[1.0, 1.0], [2.0, 2.0]], episode=9, first=50))
    r = trajectory(f, episodes(1, 9), width=2, halo=1, chunk_rows=chunk)
    listed = spark.createDataFrame([(1, 4)], "episode_index long, pos long")
    m = transforms.keep_mask(r, epsilon=0.5, drop_nonfinite=True, listed=listed)
    kept = sorted((a["episode_index"], a["pos"]) for a in m.where("keep").collect())
    assert kept == [(1, 0), (1, 3), (1, 5), (1, 6), (9, 0), (9, 1)]
    assert {a["episode_index"]: a["rejected"] for a in transforms.too_short(m, 3).collect()} == {1: False, 9: True}
    new = {(a["episode_index"], a["pos"]): (a["new_episode"], a["new_index"], a["new_global"], a["new_t"]) for a in transforms.reindexed(m.where("keep")).collect()}
    assert new[1, 5] == (0, 2, 2, 0.2) and new[9, 1] == (1, 1, 5, 0.1) and len(new) == 6


def test_padding_and_chunks(frames, episodes):
    r = view(frames, episodes, [[1.0, 2.0], [3.0, 4.0]])
    rows = transforms.padded(r, 4, "edge").orderBy("pos").collect()
    assert [a["valid"] for a in rows] == [True, True, False, False] and rows[3]["t"] == pytest.approx(0.3) and rows[3]["state"] == [3.0, 4.0]
    assert transforms.padded(r, 4, "zero").orderBy("pos").collect()[3]["state"] == [0.0, 0.0]
    c = transforms.chunk_indices(r, checks.length_check(r), 3).orderBy("pos").collect()
    assert c[1]["action_positions"] == [1, 1, 1] and c[1]["is_padding"] == [False, True, True]


@pytest.mark.parametrize("n,h,want", [(10000, 50, 0.00245), (60, 50, 1225 / 3000), (20, 50, 0.79), (1, 50, 0.98), (20, 1, 0.0)])
def test_chunk_padding_ratio(spark, n, h, want):
    lengths = spark.createDataFrame([(1, n)], "episode_index long, n_rows long")
    assert statistics.chunk_statistics(lengths, h).first()["padding_ratio"] == pytest.approx(want)


def test_robust_threshold(spark):
    rows = [("a", float(v)) for v in (1, 2, 3, 4, 5, float("nan"), -1)] + [("b", v) for v in (0.0, 0.0, 0.0, 100.0)] + [("c", 1.0)] + [("d", 0.0), ("d", 0.0)]
    got = {r["g"]: r for r in statistics.robust_threshold(spark.createDataFrame(rows, "g string, x double"), "x", "g", min_samples=2).collect()}
    assert got["a"]["threshold"] == pytest.approx(3 + 8 * 1.4826) and got["a"]["excluded"] == 2
    assert got["b"]["threshold"] == pytest.approx(np.quantile([0, 0, 0, 100], 0.995)) and got["b"]["samples_beyond"] == 1
    assert got["c"]["status"] == "insufficient_samples" and got["c"]["threshold"] is None and got["d"]["threshold"] == 1e-12


def test_alignment(spark):
    line = spark.createDataFrame([(1, t) for t in (0.0, 0.1, 0.2, 70.0)] + [(2, 0.0)], "e long, t double")
    stream = spark.createDataFrame([(1, 0.01, 10), (1, 0.11, 20), (1, 59.9, 30), (1, None, 40)], "e long, t double, v long")
    get = lambda *a, **k: [r["v"] for r in aligned(line, stream, "e", "t", "v", *a, **k).orderBy("e", "t").collect()]
    assert get("nearest", 0.02) == [10, 20, None, None, None]
    assert get("backward", 0.1) == [None, 10, 20, None, None]
    assert get("backward", 11.0) == [None, 10, 20, 30, None]
    assert get("exact") == [None] * 5
    tie = spark.createDataFrame([(1, 0.0, 1), (1, 0.2, 2)], "e long, t double, v long")
    assert [r["v"] for r in aligned(line.where("t = 0.1"), tie, "e", "t", "v", "nearest", 1.0).collect()] == [1]
    with pytest.raises(ValueError):
        aligned(line, stream, "e", "t", "v", "nearest")
    assert {r["e"]: r["usable"] for r in increasing(line.unionByName(spark.createDataFrame([(2, 0.0)], "e long, t double")), "e", "t").collect()} == {1: True, 2: False}


@pytest.mark.parametrize("chunk", [3, 1 << 16])
def test_older_static_trim(frames, episodes, chunk):
    def kept(states, n=1, **more):
        r = trajectory(frames(states), episodes(1), width=2, halo=1, chunk_rows=chunk)
        return sorted(a["pos"] for a in transforms.static_trim(r, threshold=0.5, width=2, **more).where("keep").collect())

    s = [[0.0, 0.0]] * 3 + [[1.0, 0.0], [1.0, 0.0], [2.0, 0.0]] + [[2.0, 0.1]] * 2
    assert kept(s) == [3, 4, 5] and kept(s, mode="drop_static_frames") == [0, 3, 5]
    assert kept(s, min_kept=4) == list(range(8)) == kept(s, mode="drop_static_frames", min_kept=4)
    assert kept([[1.0, 1.0]] * 5, mode="drop_static_frames") == list(range(5)) == kept([[1.0, 1.0]] * 5)
    assert kept(s, rotations=(1,), rotation_degrees=2.0) == [3, 4, 5, 6] and kept(s, rotations=(0,)) == list(range(8))
    assert kept([[0.0, 0.0], [float("nan"), 0.0], [1.0, 0.0], [1.0, 0.0]]) == [1, 2]


def test_older_gripper_binarization(frames, episodes):
    def got(states, **more):
        r = trajectory(frames(states), episodes(1), width=2, halo=0)
        return [a["binarized"] for a in transforms.gripper_binarized(r, "state", {"left": (0, 1), "right": (1, 2)}, **more).orderBy("pos").collect()]

    s = [[0.5, 0.0], [0.75, 1.0], [float("nan"), 1.0]]
    assert got(s, thresholds={"right": 2.0}) == [[0.0, 0.0], [1.0, 1.0], [0.0, 1.0]]
    assert got(s, thresholds={"right": 2.0, "left": 0.25}, skip_binary=False) == [[1.0, 0.0], [1.0, 0.0], [0.0, 0.0]]
    with pytest.raises(ValueError):
        transforms.gripper_binarized(None, "state", {"a": (0, 2), "b": (1, 2)})
