import numpy as np
import pytest
from pyspark.sql import functions as F

from motionloom.operators.regular_grid import regular_grid


def brute(times, values, rate, hold):
    t0 = min(times)
    order = sorted(range(len(times)), key=lambda i: times[i])
    tau = [(times[i] - t0) * rate for i in order]
    last = int(np.rint(max(tau)))
    out = {}
    for k in range(last + 1):
        begun = sum(int(np.rint(x)) == k for x in tau)
        cover = weighed = 0.0
        for j, x in enumerate(tau):
            end = min(tau[j + 1] if j + 1 < len(tau) else float("inf"), x + hold)
            w = max(0.0, min(end, k + 0.5) - max(x, k - 0.5))
            cover += w
            weighed += w * values[order[j]]
        out[k] = (begun, min(cover, 1.0), weighed / cover if cover else None)
    return out


@pytest.mark.parametrize("block", [8, 4096])
def test_grid_against_brute_force(spark, frames, block):
    rng = np.random.default_rng(3)
    times = np.cumsum(rng.choice([0.05, 0.1, 0.13, 0.9, 2.3], 60)).tolist()
    values = rng.normal(size=60).round(3).astype(np.float32).tolist()
    f = frames([[v, 0.0] for v in values], times=times)
    rates = spark.createDataFrame([(1, 10.0)], "episode_index long, fps double")
    got = {r["slot"]: (r["n_readings"], r["coverage"], r["series"][0]) for r in regular_grid(f, rates, 2, block_slots=block, chunk_rows=16).collect()}
    want = brute(times, values, 10.0, 2.0)
    assert got.keys() == want.keys()
    for k, (n, c, v) in want.items():
        assert got[k][0] == n and got[k][1] == pytest.approx(c, abs=1e-9)
        assert (got[k][2] is None) == (v is None) and (v is None or got[k][2] == pytest.approx(v, abs=1e-6))


def test_grid_odd_inputs(spark, frames):
    extra = [(99, 1, 9, None, 0, None, None, None), (None, 1, 9, 0.1, 0, None, None, None), (98, None, 9, 0.1, 0, None, None, None), (3, 1, 3, 0.6, 0, [1.0, 1.0], [1.0, 1.0], None)]
    f = frames([[0.0, 0.0]] * 3 + [[1.0, float("nan")]], times=[0.0, 0.1, 0.1, 0.6], extra=extra).withColumn("slot", F.lit("clash"))
    rates = spark.createDataFrame([(1, 10.0), (2, 10.0), (3, None), (4, -1.0)], "episode_index long, fps double")
    rows = {r["slot"]: r for r in regular_grid(f, rates, 2).collect()}
    assert sorted(rows) == list(range(7))
    assert rows[1]["n_readings"] == 2 and rows[6]["n_readings"] == 1
    assert rows[4]["status"] == "missing" and rows[4]["series"] == [None, None]
    assert rows[6]["series"][1] is None
    assert regular_grid(f.where("false"), rates, 2).count() == 0
    with pytest.raises(ValueError):
        regular_grid(f, rates, 2, hold=0)
