import math

import numpy as np
from pyspark.sql import functions as F

from motionloom.llm.quantiles import Buffers, pack, percentile_bounds, unpack
from motionloom.operators.chunks import chunk_sizes


def rank_error(values, got, q):
    v = np.sort(values)
    lo, hi = np.searchsorted(v, got, "left"), np.searchsorted(v, got, "right")
    at = q * len(v)
    return max(0.0, lo + 1 - at, at - hi) / len(v)


def test_error_stays_within_the_stated_bound():
    rng = np.random.default_rng(1)
    for n, k in ((10_000, 64), (50_000, 128), (300, 512)):
        v = rng.choice(np.round(rng.normal(size=n // 2), 3), n)
        parts = [Buffers(k) for _ in range(7)]
        for i, p in enumerate(np.array_split(v, 7)):
            parts[i].add(p)
        total = Buffers(k)
        for p in parts:
            total.merge(unpack(pack([p], "<f8"), 1, "<f8", k)[0])
        assert total.n == n
        bound = total.error / n
        assert bound <= max(0.0, math.log2(max(n / k, 1)) / (2 * k)) + 1e-12
        for q, got in zip((0.01, 0.5, 0.99), total.quantiles([0.01, 0.5, 0.99])):
            assert rank_error(v, got, q) <= bound + 1 / n
    assert Buffers(4).n == 0


def test_days_and_whole(spark, frames):
    rng = np.random.default_rng(2)
    x = rng.normal(size=5000).round(4)
    f = frames([[float(v), 1.0] for v in x]).withColumn("received_at", F.col("received_at") + F.expr("make_interval(0, 0, 0, CAST(global_index % 5 AS INT))"))
    bad = frames([None, [float("nan"), float("inf")], [None, 2.0]], first=9000)
    f = f.unionByName(bad).unionByName(f.limit(50).withColumn("received_at", F.lit("2030-01-01").cast("timestamp")))
    c = chunk_sizes(f, "episode_index", "global_index", 512).withColumn("robot_id", F.lit("r1")).withColumn("quantile", F.lit(0.9))
    rows = percentile_bounds(f, c, 2, k=64, chunk_rows=512).collect()
    whole = {r["component"]: r for r in rows if r["day"] is None}
    days = [r for r in rows if r["day"] is not None]
    assert whole[0]["n"] == 5000 and whole[1]["n"] == 5001 and sum(r["n"] for r in days if r["component"] == 0) == 5000
    for q, name in ((0.1, "low"), (0.5, "median"), (0.9, "high")):
        assert rank_error(x.astype(np.float32).astype(float), whole[0][name], q) <= whole[0]["rank_error"] + 1 / 5000
    assert all(r["rank_error"] <= 0.2 for r in rows)
    again = percentile_bounds(f.repartition(7), c, 2, k=64, chunk_rows=512).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, rows), key=repr)
    assert percentile_bounds(f.where("false"), c, 2, chunk_rows=512).count() == 0
