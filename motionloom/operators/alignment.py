"""Alignment of asynchronous streams to a reference timeline: exact, backward, nearest.

Streams and timelines are keyed by an entity and a time. Both are cut into slices of ``width`` seconds; a slice gets
the stream rows of its own span and those within the tolerance outside it, so no entity is one task. The
tolerance therefore bounds the overlap, and non-exact policies need one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionloom.functions.vectors import is_finite


def aligned(timeline: DataFrame, stream: DataFrame, entity: str, time: str, value: str, policy: str = "backward", tolerance: float | None = None, width: float | None = None) -> DataFrame:
    """The timeline's rows with the stream's value at the same, the last or the nearest time, and ``matched``.

    ``nearest`` takes the earlier of two values at equal distance. Of several stream rows at one time the smallest
    value is taken. Times that are not finite and null entities match nothing and keep their timeline row.
    """
    s = stream.where(F.col(entity).isNotNull() & is_finite(F.col(time))).groupBy(F.col(entity).alias("_e"), F.col(time).alias("_s")).agg(F.min(value).alias("_v"))
    if policy == "exact":
        out = timeline.join(s, (timeline[entity] == s["_e"]) & (timeline[time] == s["_s"]), "left")
        return out.withColumn("matched", F.col("_s").isNotNull()).withColumnRenamed("_v", value).drop("_e", "_s")
    if policy not in ("backward", "nearest") or tolerance is None or not 0 <= tolerance < float("inf"):
        raise ValueError("backward and nearest need a finite tolerance")
    span = width or max(60.0, 20 * tolerance)
    slot = lambda c: F.floor(c / span).cast("long")
    t = timeline.withColumn("_slice", slot(F.col(time))).withColumn("_is_stream", F.lit(False))
    copies = s.withColumn("_slice", F.explode(F.sequence(slot(F.col("_s") - tolerance), slot(F.col("_s") + tolerance))))
    marks = copies.select(F.col("_e").alias(entity), F.col("_s").alias(time), "_slice", F.struct(F.col("_s").alias("s"), F.col("_v").alias("v")).alias("_hit"), F.lit(True).alias("_is_stream"))
    both = t.unionByName(marks, allowMissingColumns=True)
    past = Window.partitionBy(entity, "_slice").orderBy(F.col(time).asc(), F.col("_is_stream").desc()).rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("_b", F.last("_hit", True).over(past))
    hit = F.col("_b")
    if policy == "nearest":
        ahead = Window.partitionBy(entity, "_slice").orderBy(F.col(time).desc(), F.col("_is_stream").desc()).rowsBetween(Window.unboundedPreceding, 0)
        both = both.withColumn("_a", F.last("_hit", True).over(ahead))
        b, a = F.col("_b"), F.col("_a")
        hit = F.when(a.isNull() | (b.isNotNull() & (F.col(time) - b["s"] <= a["s"] - F.col(time))), b).otherwise(a)
    out = both.where(~F.col("_is_stream")).withColumn("_h", hit)
    near = F.coalesce(F.abs(F.col(time) - F.col("_h.s")) <= tolerance, F.lit(False)) & F.col(entity).isNotNull() & is_finite(F.col(time))
    out = out.withColumn(value, F.when(near, F.col("_h.v"))).withColumn("matched", near)
    return out.drop("_slice", "_is_stream", "_hit", "_b", "_a", "_h")


def increasing(timeline: DataFrame, entity: str, time: str) -> DataFrame:
    """Per entity whether its times are finite and differ (a timeline must be strictly increasing once sorted)."""
    n: Column = F.count(F.lit(1))
    return timeline.groupBy(entity).agg(((F.min(is_finite(F.col(time)))) & (n == F.count_distinct(time))).alias("usable"))
