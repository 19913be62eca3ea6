import math

import pytest
from pyspark.sql import functions as F

from motionloom.functions.vectors import binarized, changed_values, clipped, close, difference, feature
from motionloom.operators import checks
from motionloom.operators.review import duplicates, review
from motionloom.operators.trajectory import in_order, own, trajectory


def view(frames, episodes, states, halo=3, chunk=1 << 16, actions=None, **more):
    return trajectory(frames(states, actions, **more), episodes(1), width=2, halo=halo, chunk_rows=chunk)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


@pytest.mark.parametrize("chunk", [4, 1 << 16])
def test_jerk_of_a_cube_is_six(frames, episodes, chunk):
    t = [i * 0.2 for i in range(12)]
    r = view(frames, episodes, [[x**3, 0.0] for x in t], times=t, chunk=chunk)
    got = one(checks.derivative_check(r, 3, 6.5, width=2))
    assert got["evaluated"] and got["passed"] and got["peak"] == pytest.approx(6.0, abs=1e-3)
    assert one(checks.derivative_check(r, 1, 1.0, width=2))["intervals_beyond"] > 0


def test_three_outcomes(frames, episodes):
    short = view(frames, episodes, [[0.0, 0.0]])
    got = one(checks.derivative_check(short, 1, 1.0, width=2))
    assert not got["evaluated"] and not got["passed"] and got["peak"] is None
    for bad in ([[0.0, 0.0], None, [0.0, 0.0]], [[0.0, 0.0], [float("nan"), 0.0]]):
        got = one(checks.zscore_check(view(frames, episodes, bad), 0, width=2))
        assert not got["evaluated"] and not got["passed"]
    back = view(frames, episodes, [[0.0, 0.0]] * 3, times=[0.0, 0.2, 0.1])
    assert not one(checks.derivative_check(back, 1, width=2))["evaluated"] and not one(checks.timestamp_check(back))["passed"]


def test_constant_motion_has_no_zscore(frames, episodes):
    r = view(frames, episodes, [[0.1 * i, 0.0] for i in range(30)])
    assert one(checks.zscore_check(r, 1, 50.0, width=2))["max_zscore"] < 50
    jump = view(frames, episodes, [[0.1 * i + 20 * (i >= 15), 0.0] for i in range(30)])
    assert one(checks.zscore_check(jump, 1, width=2))["rows_beyond"] == 1


@pytest.mark.parametrize("chunk", [3, 1 << 16])
def test_static_checks(frames, episodes, chunk):
    s = [[0.0, 0.0], [0.0, 0.0], [1.0, 0.0], [1.0, 0.0], [2.0, 0.0]]
    a = [[0.0, 0.0], [1.0, 0.0], [1.0, 0.0], [2.0, 0.0], [2.0, 0.0]]
    r = view(frames, episodes, s, chunk=chunk, actions=a)
    got = one(checks.joint_static_check(r, 0.1, 0.1))
    assert (got["state_static"], got["action_static"], got["static_transitions"], got["static_ratio"]) == (2, 2, 0, 0.0)
    r = view(frames, episodes, [[0.0, 0.0]] * 4 + [[1.0, 0.0], [2.0, 0.0]] + [[2.0, 0.0]] * 3, chunk=chunk)
    e = one(checks.static_edges(r, 0.5, 2))
    assert (e["trim_start"], e["trim_end"], e["should_trim"], e["passed"]) == (3, 6, True, False)
    still = one(checks.static_edges(view(frames, episodes, [[0.0, 0.0]] * 4, chunk=chunk)))
    assert still["all_static"] and not still["should_trim"] and not still["passed"]


def test_equality_passes(frames, episodes):
    r = view(frames, episodes, [[0.0, 0.0], [1.0, 0.0], [1.0, 0.0]], times=[0.0, 1.0, 2.0])
    assert one(checks.derivative_check(r, 1, 1.0, width=2))["passed"]
    assert one(checks.static_check(r, 0.0, 0.5))["passed"] and not one(checks.static_check(r, 0.0, 0.4))["passed"]
    assert one(checks.length_check(r, 3, 3))["passed"] and not one(checks.length_check(r, 4))["passed"]


@pytest.mark.parametrize("chunk", [5, 1 << 16])
def test_structure_and_repeats(spark, frames, episodes, chunk):
    f = frames([[0.0, 0.0]] * 12)
    r = trajectory(f.unionByName(f.limit(4)), episodes(1, length=12), width=2, chunk_rows=chunk)
    assert one(checks.structure_check(r, episodes(1, length=12)))["passed"]
    assert one(checks.structure_check(r, episodes(1, length=11)))["length_differs"]
    hole = trajectory(f.where("global_index <> 5"), episodes(1), width=2, chunk_rows=chunk)
    assert one(checks.structure_check(hole, episodes(1)))["frame_gap"] and one(checks.structure_check(hole, episodes(1)))["index_gap"]
    assert trajectory(f.where("false"), episodes(1), width=2).count() == 0
    assert trajectory(f, episodes(7), width=2).count() == 0


def test_expressions(spark):
    d = spark.createDataFrame([([3.13, 1.0], [-3.13, 2.0], [179.0], [-179.0])], "a array<double>, b array<double>, c array<double>, d array<double>")
    r = d.select(difference(F.col("b"), F.col("a"), 2 * math.pi).alias("rad"), difference(F.col("d"), F.col("c"), 360.0).alias("deg"), feature([(F.col("a"), 1, 2), (F.col("b"), 0, 2)]).alias("f")).first()
    assert r["rad"][0] == pytest.approx(2 * math.pi - 6.26) and r["deg"] == [2.0] and r["f"] == [1.0, -3.13, 2.0]
    n = float("nan")
    d = spark.createDataFrame([([5.0, n, -5.0], [1.0, n, -5.0])], "a array<double>, b array<double>")
    lo, hi = F.array(*[F.lit(-1.0)] * 3), F.array(*[F.lit(1.0)] * 3)
    r = d.select(clipped(F.col("a"), lo, hi).alias("c"), changed_values(F.col("a"), F.col("b")).alias("n"), close(F.col("a"), F.col("a")).alias("same"), close(F.col("a"), F.col("b")).alias("other"), binarized(F.lit(0.5), 0.5).alias("at"), binarized(F.lit(0.5), 0.5, inclusive=False).alias("above")).first()
    assert r["c"][0] == 1.0 and math.isnan(r["c"][1]) and r["c"][2] == -1.0 and r["n"] == 1 and r["same"] and not r["other"] and (r["at"], r["above"]) == (1.0, 0.0)


@pytest.mark.parametrize("chunk", [4, 1 << 16])
def test_review(frames, episodes, chunk):
    s = [[0.0, 0.0]] * 3 + [[1.0, 0.0]] + [[1.0, 0.0]] * 6
    a = [[0.0, 0.0], [0.7, 0.0], [0.0, 0.0], [0.7, 0.0]] + [[0.7, 0.0]] * 6
    got = one(review(view(frames, episodes, s, halo=2, chunk=chunk, actions=a), static_seconds=0.5))
    assert got["longest_static_seconds"] == pytest.approx(0.6) and got["action_jumps"] == 3 and got["jump_positions"] == "1,2,3"
    assert got["jitter_fraction"] == pytest.approx(2 / 8) and "long_static_state" in got["flags"] and "duration_candidate" in got["flags"]


def test_duplicates(frames, episodes):
    s = [[1.0, 2.0], [3.0, 4.0]]
    f = frames(s, episode=1).unionByName(frames(s, episode=2, first=100)).unionByName(frames(s[::-1], episode=3, first=200)).unionByName(frames([None, s[0]], episode=4, first=300)).unionByName(frames([None, s[0]], episode=5, first=400))
    got = [tuple(r) for r in duplicates(trajectory(f, episodes(1, 2, 3, 4, 5), width=2)).collect()]
    assert got == [(2, 1)]


def test_rows_across_gaps_of_the_key(frames, episodes):
    width = 1 << 16
    at = [0, 1, 2, width + 50, 4 * width + 7, 4 * width + 8, 9 * width]
    f = frames([[float(k), 0.0] for k in range(len(at))]).withColumn("global_index", F.element_at(F.array(*[F.lit(a) for a in at]), (F.col("global_index") + 1).cast("int")).cast("long"))
    for halo in (1, 2, 3):
        r = trajectory(f, episodes(1), width=2, halo=halo)
        r = r.withColumn("_p", F.lag("global_index", halo).over(in_order())).withColumn("_n", F.lead("global_index", halo).over(in_order()))
        got = {a["global_index"]: (a["_p"], a["_n"]) for a in own(r).collect()}
        assert got == {x: (at[k - halo] if k >= halo else None, at[k + halo] if k + halo < len(at) else None) for k, x in enumerate(at)}
    assert checks.structure_check(trajectory(f.where(F.col("global_index").isin(0, 1, 2, width + 50)), episodes(1), width=2, halo=1), episodes(1)).first()["index_gap"]
