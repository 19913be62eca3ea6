"""Continuous audit of arriving frames with Structured Streaming.

Frames sent again are dropped within the watermark; per day of arrival and episode the stream counts frames and
frames with missing or non-finite components. State is bounded by the watermark, and the checkpoint folder makes
the query restartable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from motionloom.functions.vectors import all_finite


def frame_stream(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    """New parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def finite_counts(frames: DataFrame, late: str = "7 days", window: str = "1 day") -> DataFrame:
    """Per window of arrival and episode: frames, and those with a missing or non-finite component."""
    f = frames.withColumn("received_at", F.col("received_at").cast("timestamp")).where(F.col("global_index").isNotNull())
    once = f.withWatermark("received_at", late).dropDuplicatesWithinWatermark(["global_index"])
    bad = ~(all_finite(F.col("state")) & all_finite(F.col("action")))
    out = once.groupBy(F.window("received_at", window), "episode_index").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(bad.cast("long")).alias("bad_rows"))
    return out.select(F.col("window.start").alias("day"), "episode_index", "n_rows", "bad_rows")
