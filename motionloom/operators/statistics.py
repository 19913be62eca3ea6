"""Dataset, feature and episode statistics, robust thresholds, chunk padding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionloom.functions.vectors import is_finite
from motionloom.operators.trajectory import own
from motionloom.session import bounded_broadcast, checkpointed

#: Groups whose ranges are broadcast.
MAX_GROUPS = 100_000

EPISODE = "episode_index"
QUANTILES = (0.01, 0.1, 0.5, 0.9, 0.99)


def components(rows: DataFrame, source: str, *keys: str) -> DataFrame:
    """Long form ``(keys, component, x)`` of a vector column."""
    return own(rows).select(*keys, F.posexplode(source).alias("component", "x"))


def numeric_summary(rows: DataFrame, source: str) -> DataFrame:
    """Non-finite values and, only where there are none, the range of each component (A1)."""
    c = components(rows, source).groupBy("component").agg(F.sum((~is_finite(F.col("x"))).cast("long")).alias("nonfinite"), F.min(F.when(is_finite(F.col("x")), F.col("x"))).alias("_lo"), F.max(F.when(is_finite(F.col("x")), F.col("x"))).alias("_hi"))
    clean = F.col("nonfinite") == 0
    return c.select("component", "nonfinite", F.when(clean, F.col("_lo")).alias("minimum"), F.when(clean, F.col("_hi")).alias("maximum"))


#: Cells a group's range is cut into to find where its quantiles lie.
QUANTILE_CELLS = 4096


def exact_quantiles(values: DataFrame, keys: list[str], quantiles: tuple[float, ...] = QUANTILES) -> DataFrame:
    """Exact linear quantiles of finite ``x`` by ``keys``: ``(keys, n, quantile, x)``, without one task per group.

    Values are counted in ``QUANTILE_CELLS`` cells of their group's range; only the cells that hold a wanted rank are
    sorted, each on its own. ``values`` is read three times, so the caller keeps it; rows with a null key are left out.
    """
    span = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("_lo"), F.max("x").alias("_hi"))
    cell = F.least(F.coalesce(F.floor(F.try_divide(F.col("x") - F.col("_lo"), F.col("_hi") - F.col("_lo")) * QUANTILE_CELLS), F.lit(0)), F.lit(QUANTILE_CELLS - 1)).cast("int").alias("_cell")
    placed = values.join(bounded_broadcast(span, MAX_GROUPS), keys).select(*keys, "x", "n", cell)
    counts = placed.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_k"), F.first("n").alias("n"))
    before_ = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_k").over(before_), F.lit(0)))  # at most QUANTILE_CELLS rows a group
    at = lambda q: (F.col("n") - 1) * F.lit(q)
    wanted = F.array(*[F.struct(F.lit(q).alias("quantile"), side(at(q)).cast("long").alias("_rank"), at(q).alias("_at")) for q in quantiles for side in (F.floor, F.ceil)])
    wanted = counts.withColumn("_w", F.explode(wanted)).select(*keys, "_cell", "n", "_before", "_k", "_w.*").where((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_k")))
    cells = wanted.select(*keys, "_cell", "_before").distinct()
    held = placed.join(bounded_broadcast(cells, MAX_GROUPS), [*keys, "_cell"])
    ranked = held.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys, "_cell").orderBy("x")) - 1 + F.col("_before")).select(*keys, "_cell", "_rank", "x")
    ends = ranked.join(wanted, [*keys, "_cell", "_rank"]).groupBy(*keys, "n", "quantile", "_at").agg(F.min("x").alias("_a"), F.max("x").alias("_b"))
    return ends.select(*keys, "n", "quantile", (F.col("_a") + (F.col("_b") - F.col("_a")) * (F.col("_at") - F.floor("_at"))).alias("x"))


def moments(rows: DataFrame, source: str, *keys: str, quantiles: bool = True) -> DataFrame:
    """Count, mean, population deviation, range and exact linear quantiles of the finite values."""
    c = components(rows, source, *keys).where(is_finite(F.col("x")))
    c = checkpointed(c) if quantiles else c
    aggs = [F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"), F.min("x").alias("minimum"), F.max("x").alias("maximum")]
    out = c.groupBy(*keys, "component").agg(*aggs)
    if quantiles:
        q = exact_quantiles(c, [*keys, "component"]).groupBy(*keys, "component").pivot("quantile", list(QUANTILES)).agg(F.first("x"))
        q = q.select(*keys, "component", *[F.col(f"`{x}`").alias(f"q{int(x * 100):02d}") for x in QUANTILES])
        out = out.join(q, [*keys, "component"])
    return out


def strided_bounds(rows: DataFrame, source: str, low: float = 0.01, high: float = 0.99, target_rows: int = 200_000) -> DataFrame:
    """Outlier bounds of each component over rows at a stride, about ``target_rows`` in all (A8): ``(component, low, high)``.

    The stride is part of the operator: an episode of ``n`` rows gives every ``n div per + 1``-th of them, ``per`` being the
    target over the number of episodes. A component without finite values has infinite bounds.
    """
    r = own(rows)
    sizes = r.groupBy(EPISODE, "chunk").agg(F.count(F.lit(1)).alias("_c")).withColumn("_n", F.sum("_c").over(Window.partitionBy(EPISODE))).drop("_c")
    per = max(1, target_rows // max(1, sizes.select(EPISODE).distinct().count()))
    r = r.join(sizes, [EPISODE, "chunk"]).where(F.col("pos") % F.greatest(F.lit(1), F.floor(F.col("_n") / per) + 1) == 0)
    c = components(r, source)
    p = c.where(is_finite(F.col("x"))).groupBy("component").agg(F.percentile("x", F.array(F.lit(low), F.lit(high))).alias("_p"))
    every = c.select("component").distinct().join(p, "component", "left")
    return every.select("component", F.coalesce(F.col("_p")[0], F.lit(-float("inf"))).alias("low"), F.coalesce(F.col("_p")[1], F.lit(float("inf"))).alias("high"))


def relative(rows: DataFrame) -> DataFrame:
    """Rows with ``delta``: action minus the paired state."""
    return rows.withColumn("delta", F.zip_with("action", "state", lambda a, s: a - s))


def robust_threshold(samples: DataFrame, value: str, *keys: str, quantile: float = 0.995, mad_k: float = 8.0, mad_scale: float = 1.4826, min_samples: int = 20, floor: float = 1e-12) -> DataFrame:
    """Per group the larger of a quantile and median plus scaled MAD of finite, non-negative samples.

    Samples, usually one per episode, are read several times and checkpointed first.
    """
    samples = checkpointed(samples.select(*keys, value))
    x = F.col(value)
    usable = is_finite(x) & (x >= 0)
    good = samples.where(usable).select(*keys, x.cast("double").alias("_x"))
    mid = good.groupBy(*keys).agg(F.percentile("_x", F.lit(0.5)).alias("median"), F.percentile("_x", F.lit(quantile)).alias("_q"), F.count(F.lit(1)).alias("samples"))
    mad = good.join(mid.select(*keys, "median"), list(keys)).groupBy(*keys).agg(F.percentile(F.abs(F.col("_x") - F.col("median")), F.lit(0.5)).alias("mad"))
    out = mid.join(mad, list(keys))
    raw = F.greatest(F.col("_q"), F.col("median") + F.lit(mad_k * mad_scale) * F.col("mad"))
    out = out.withColumn("threshold", F.when(F.col("samples") >= min_samples, F.greatest(raw, F.lit(floor)))).withColumn("floor_applied", raw < floor)
    beyond = good.join(out.select(*keys, "threshold"), list(keys)).groupBy(*keys).agg(F.sum(F.coalesce(F.col("_x") > F.col("threshold"), F.lit(False)).cast("long")).alias("samples_beyond"))
    excluded = samples.groupBy(*keys).agg(F.sum((~usable).cast("long")).alias("excluded"))
    out = excluded.join(out, list(keys), "left").join(beyond, list(keys), "left")
    # Names of the states of a threshold.
    status = F.when(F.coalesce("samples", F.lit(0)) < min_samples, F.lit("insufficient_samples")).when(~is_finite(F.col("threshold")), F.lit("numeric_overflow")).otherwise(F.lit("ready"))
    return out.select(*keys, F.coalesce("samples", F.lit(0)).alias("samples"), "excluded", status.alias("status"), "median", "mad", "threshold", F.coalesce("samples_beyond", F.lit(0)).alias("samples_beyond"))


def padded_slots(n: Column, horizon: int) -> Column:
    """Action slots of an episode of ``n`` rows that are padding."""
    h = F.lit(horizon)
    return F.when(n >= h, h * (h - 1) / 2).otherwise(n * h - n * (n + 1) / 2).cast("long")


def chunk_statistics(lengths: DataFrame, horizon: int) -> DataFrame:
    """Per episode padded slots, their share, and the share of rows with padding."""
    n = F.col("n_rows")
    return lengths.select(EPISODE, "n_rows", padded_slots(n, horizon).alias("padded"), (padded_slots(n, horizon) / (n * horizon)).alias("padding_ratio"), (F.least(n, F.lit(horizon - 1)) / n).alias("sample_padding_ratio"))


def chunk_summary(stats: DataFrame, horizon: int) -> DataFrame:
    """Slot-weighted share, mean, median, 95th percentile and counts beyond limits."""
    r = F.col("padding_ratio")
    over = [F.sum((r > x).cast("long")).alias(f"over_{int(x * 100)}") for x in (0.25, 0.5, 0.75)]
    return stats.agg(F.count(F.lit(1)).alias("episodes"), (F.sum("padded") / (F.sum("n_rows") * horizon)).alias("slot_ratio"), F.avg(r).alias("mean_ratio"), F.percentile(r, F.lit(0.5)).alias("median_ratio"), F.percentile(r, F.lit(0.95)).alias("p95_ratio"), *over)


def dataset_summary(rows: DataFrame, key: str = "task_index") -> DataFrame:
    """Episodes, frames and length range per task, of rows with a task."""
    n = own(rows).where(F.col(key).isNotNull()).groupBy(key, EPISODE).agg(F.count(F.lit(1)).alias("_n"))
    return n.groupBy(key).agg(F.count(F.lit(1)).alias("episodes"), F.sum("_n").alias("n_rows"), F.min("_n").alias("shortest"), F.max("_n").alias("longest"), F.percentile("_n", F.lit(0.5)).alias("median_length"))
