import numpy as np
from pyspark.sql import functions as F

from motionloom.operators.chunks import chunk_sizes
from motionloom.operators.spikes import SPIKE_RATIO, cell_scores, cut_of, departures, fit_forest, gridded, implausible_readings, run_lengths, score_forest, smaller_steps


def flags(spark, f, width=2, joints=1, chunk=32, low=(-5.0, -5.0), high=(5.0, 5.0)):
    c = chunk_sizes(f, "episode_index", "global_index", chunk).withColumn("robot_id", F.lit("r1"))
    c = c.withColumn("joint_low", F.array(*[F.lit(x) for x in low])).withColumn("joint_high", F.array(*[F.lit(x) for x in high]))
    return {(r["record_id"], r["field"], r["component"]): r["reason"] for r in implausible_readings(f, c, width, joints, chunk_rows=chunk).collect()}


def test_spikes_limits_and_frozen(spark, frames):
    rng = np.random.default_rng(5)
    n = 300
    x = np.cumsum(rng.normal(0, 0.01, n))
    x[200:] += 1.0  # a lasting shift
    state = x.copy()
    state[50] += 0.8
    state[100:103] -= 0.9
    state[150:160] = state[150]
    state[33] = 9.0
    rows = [[float(v), 0.5] for v in state]
    rows[70][0] = float("inf")
    rows[80] = None
    rows[90][0] = float("nan")
    action = [[float(v), 0.5] for v in x]
    again = [(50, 1, 50, 5.0, 0, rows[50], action[50], None)]
    found = flags(spark, frames(rows, action, extra=again).withColumn("field", F.lit(1)))
    want = {(50, "state", 0): "spike", **{(k, "state", 0): "spike" for k in (100, 101, 102)}, **{(k, "state", 0): "frozen" for k in range(151, 160)}, (33, "state", 0): "limit", (70, "state", 0): "limit"}
    assert found == want


def test_empty_and_constant(spark, frames):
    f = frames([[0.0, 0.0]] * 5)
    assert flags(spark, f.where("false")) == {}
    assert flags(spark, f) == {}


def test_forest_prefers_outliers_and_memo_is_exact():
    rng = np.random.default_rng(1)
    x = rng.integers(4, 9, (2000, 4)).astype(float)
    x[:5] = [7, 35, 35, 0]
    forest = {**fit_forest(x, rng), "id": "t"}
    s = score_forest(forest, x)
    assert s[:5].min() > np.quantile(s[5:], 0.99)
    assert np.allclose(cell_scores(forest, x), s, atol=1e-6) and np.allclose(cell_scores(forest, x), s, atol=1e-6)


def test_departures():
    y = np.array([0.0, 0.1, 5.0, 0.2, 0.3, 0.3, 0.4, 0.5, 4.0, 4.2, 4.1, 0.4, 0.5, 0.6, 0.7, 9.0, 9.1, 9.2, 9.3, 9.4])
    away = departures(y, np.zeros(len(y), int))
    assert np.flatnonzero(away > 1).tolist() == [2, 8, 9, 10]
    assert not (departures(y, np.arange(len(y))) > 0).any()


def test_the_forest_decides_which_departures_are_spikes():
    """Without the score every resumed wiggle would be a case, and with it only those far beyond normal motion."""
    rng = np.random.default_rng(3)
    y = np.cumsum(rng.normal(0, 0.01, 4000)) + rng.normal(0, 0.004, 4000)
    planted = np.arange(100, 3900, 190)
    y[planted] += rng.choice([-1, 1], len(planted)) * rng.uniform(0.3, 2.0, len(planted))
    new = np.zeros(len(y), bool)
    new[0] = True
    group, scale = np.zeros(len(y), int), np.full(len(y), np.quantile(np.abs(np.diff(y)), 0.9))
    away = departures(y, group)
    x = gridded(y, smaller_steps(y, new), away, run_lengths(y, new)[0], np.full(len(y), -5.0), np.full(len(y), 5.0), scale)
    forest = fit_forest(x[rng.choice(len(x), 1000, replace=False)], rng)
    score = score_forest(forest, x)
    cut = cut_of(forest, x)
    assert np.flatnonzero((away > 0) & (score >= cut)).tolist() == planted.tolist()
    assert (away > 0).sum() > 20 * len(planted)
    ratio = away / scale
    assert ratio[planted].min() > SPIKE_RATIO


def test_keys_with_strides_change_nothing(spark, frames):
    x = [[0.01 * (k % 7), 0.0] for k in range(120)]
    x[60] = [3.0, 0.0]
    x[90:110] = [[0.02, 0.0]] * 20
    f = frames(x)
    dense = flags(spark, f)
    wide = f.withColumn("global_index", F.col("global_index") * 50)
    chunks = wide.groupBy("episode_index", F.floor(F.col("global_index") / 32).alias("chunk")).agg(F.count(F.lit(1)).alias("n_rows"))
    chunks = chunks.withColumns({"robot_id": F.lit("r1"), "joint_low": F.array(F.lit(-5.0), F.lit(-5.0)), "joint_high": F.array(F.lit(5.0), F.lit(5.0))})
    got = [(r["field"], r["component"], r["reason"]) for r in implausible_readings(wide, chunks, 2, 1, chunk_rows=32).collect()]
    assert sorted(got) == sorted((*k[1:], v) for k, v in dense.items()) and {"spike", "frozen"} <= set(dense.values())
