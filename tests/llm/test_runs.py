import numpy as np
import pytest
from pyspark.sql import functions as F

from motionloom.llm.runs import agglomerate, collapse_runs
from motionloom.operators.chunks import chunk_sizes


def found(f, eps=0.1, min_kept=0, chunk=1 << 16, **more):
    c = chunk_sizes(f, "episode_index", "global_index", chunk).withColumn("max_step", F.lit(eps)).withColumn("min_kept", F.lit(min_kept))
    return {(r["first_index"], r["last_index"]): r for r in collapse_runs(f, c, 2, chunk_rows=chunk, **more).collect()}


def brute(vectors, eps):
    runs, start = [], 0
    for i in range(1, len(vectors) + 1):
        a = vectors[i] if i < len(vectors) else None
        b = vectors[i - 1]
        same = a is not None and b is not None and np.isfinite(a).all() and np.isfinite(b).all() and np.abs(np.float32(a).astype(float) - np.float32(b).astype(float)).max() <= eps
        if not same:
            if i - start >= 3:
                runs.append((start, i - 1))
            start = i
    return runs


@pytest.mark.parametrize("chunk", [7, 16, 1 << 16])
def test_runs_in_any_slicing(spark, frames, chunk):
    rng = np.random.default_rng(8)
    v = [[float(x), 0.0] for x in np.cumsum(rng.choice([0.0, 0.05, 0.5], 120, p=[0.5, 0.3, 0.2]))]
    v[20] = None
    v[60] = [float("nan"), 0.0]
    v[90] = [float("inf"), 0.0]
    got = found(frames(v), chunk=chunk)
    want = brute(v, 0.1)
    assert sorted(got) == want
    kept = 120 - sum(b - a for a, b in want)
    assert {r["kept_rows"] for r in got.values()} == {kept}
    assert all(r["duration"] == pytest.approx((r["last_index"] - r["first_index"]) / 10) for r in got.values())


def test_repeats_nulls_and_empty(spark, frames):
    v = [[1.0, 1.0]] * 4
    extra = [(1, 1, 1, 0.1, 0, v[0], v[0], None), (None, 1, 1, 0.1, 0, v[0], v[0], None), (50, None, 1, 0.1, 0, v[0], v[0], None)]
    f = frames(v, times=[None] * 4, extra=extra).withColumn("entity", F.lit("clash")).withColumn("chunk", F.lit(3))
    got = found(f.where("t IS NULL OR global_index IS NULL OR global_index = 1"))
    assert list(got) == [(0, 3)] and got[0, 3]["n_rows"] == 4 and got[0, 3]["kept_rows"] == 1
    assert found(f.where("false")) == {}


def test_linkages_and_gaps():
    v = np.array([[0.0], [0.4], [0.8], [1.2], [5.0], [5.1]])
    assert agglomerate(v, 0.5).tolist() == [0, 4]
    assert agglomerate(v, 0.5, np.array([0, 1, 9, 10, 11, 12]), 3).tolist() == [0, 2, 4]
    assert agglomerate(v, 0.5, linkage="centroid").tolist() == [0, 2, 4]
    assert agglomerate(np.zeros((0, 1)), 0.5).tolist() == []
    with pytest.raises(ValueError):
        agglomerate(v, 0.5, linkage="other")


def test_stretches_over_slices_keep_gaps_and_totals(spark, frames):
    v = [[0.0, 0.0]] * 40
    times = [k / 10 if k < 17 else k / 10 + 5 for k in range(40)]
    got = found(frames(v, times=times), chunk=8, max_gap=1.0)
    assert sorted(got) == [(0, 16), (17, 39)] and {r["kept_rows"] for r in got.values()} == {2}
    assert sorted(found(frames(v, times=times), chunk=8)) == [(0, 39)]
    assert found(frames(v, times=[None] * 40), max_gap=1.0) == {}


def test_late_rows_in_other_files_stay_in_their_stretch(spark, frames, tmp_path):
    """Rows that lie in another file are brought to their slice even where the planner would leave out the shuffle."""
    f = frames([[0.0, 0.0]] * 30)
    f.where("global_index % 7 != 3").write.parquet(str(tmp_path / "a"))
    f.where("global_index % 7 = 3").write.parquet(str(tmp_path / "b"))
    f = spark.read.parquet(str(tmp_path / "a")).unionByName(spark.read.parquet(str(tmp_path / "b")))
    assert sorted(found(f)) == [(0, 29)]


def test_centroid_linkage_equals_brute_force():
    rng = np.random.default_rng(12)
    for _ in range(20):
        v = np.cumsum(rng.normal(0, 0.3, (30, 2)), axis=0)
        runs = [[i] for i in range(len(v))]
        mean = lambda r: v[r].mean(axis=0)
        while True:
            d = [np.abs(mean(a) - mean(b)).max() for a, b in zip(runs, runs[1:])]
            if not d or min(d) > 0.5:
                break
            k = int(np.argmin(d))
            runs[k : k + 2] = [runs[k] + runs[k + 1]]
        assert agglomerate(v, 0.5, linkage="centroid").tolist() == [r[0] for r in runs]
