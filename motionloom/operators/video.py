"""Video intervals without decoding: overlaps, frame counts, spacing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLACK = 1e-3
EARLY = 1e-4


def overlaps(refs: DataFrame) -> DataFrame:
    """Intervals of one file that begin before an earlier one ends."""
    earlier = Window.partitionBy("file").orderBy("start", "episode_index").rowsBetween(Window.unboundedPreceding, -1)
    return refs.withColumn("_end", F.max("end").over(earlier)).where(F.col("_end") > F.col("start") + SLACK).drop("_end")


def frames_in_intervals(refs: DataFrame, stamps: DataFrame, span: float = 60.0) -> DataFrame:
    """Decoded frames per interval: a range join on file and time slices of ``span`` seconds."""
    slot = lambda c: F.floor(c / span)
    r = refs.withColumn("_slice", F.explode(F.sequence(slot(F.col("start") - EARLY), slot(F.col("end") - EARLY))))
    s = stamps.select("file", F.col("pts").alias("_pts"), slot(F.col("pts")).alias("_slice"))
    hit = r.join(s, ["file", "_slice"]).where((F.col("_pts") >= F.col("start") - EARLY) & (F.col("_pts") < F.col("end") - EARLY))
    counted = hit.groupBy("episode_index", "key").agg(F.count(F.lit(1)).alias("decoded"))
    return refs.select("episode_index", "key").join(counted, ["episode_index", "key"], "left").withColumn("decoded", F.coalesce("decoded", F.lit(0)))


def counts_agree(decoded: DataFrame, lengths: DataFrame, tolerance: int = 0) -> DataFrame:
    """Per episode and view whether as many frames were decoded as there are rows."""
    return decoded.join(lengths.select("episode_index", "n_rows"), "episode_index").withColumn("passed", F.abs(F.col("decoded") - F.col("n_rows")) <= tolerance)


def covered(rows: DataFrame, refs: DataFrame) -> DataFrame:
    """Rows whose time lies outside the length of one of their episode's intervals."""
    r = refs.withColumn("_length", F.col("end") - F.col("start")).select("episode_index", "key", "_length")
    return rows.select("episode_index", "pos", "t").join(r, "episode_index").where(~F.coalesce(F.col("t") < F.col("_length") + SLACK, F.lit(False))).select("episode_index", "pos", "key")
