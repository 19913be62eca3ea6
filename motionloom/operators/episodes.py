"""Frames joined to what is known of their episode, by ``(episode_index, chunk)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motionloom.operators.chunks import CHUNK_ROWS, chunk_sizes
from motionloom.session import bounded_broadcast

#: Robots and their settings are small reference tables; above this many rows their joins shuffle.
MAX_ROBOT_ROWS = 10_000


def one_row_per_episode(episodes: DataFrame) -> DataFrame:
    """``episode_index, robot_id, fps``: repeated rows count once; of differing rows the smallest (robot, fps) holds."""
    e = episodes.where(F.col("episode_index").isNotNull())
    return (
        e.groupBy("episode_index")
        .agg(F.min(F.struct("robot_id", "fps")).alias("_e"))
        .select("episode_index", F.col("_e.robot_id").alias("robot_id"), F.col("_e.fps").alias("episode_fps"))
    )


def episode_settings(episodes: DataFrame, robots: DataFrame | None = None, thresholds: DataFrame | None = None, columns: tuple[str, ...] = ()) -> DataFrame:
    """Episodes with ``fps`` (their own, else the robot's) and the named threshold columns of their robot."""
    out = one_row_per_episode(episodes)
    if robots is not None:
        r = robots.where(F.col("robot_id").isNotNull()).groupBy("robot_id").agg(F.max("fps").alias("_robot_fps"))
        out = out.join(bounded_broadcast(r, MAX_ROBOT_ROWS), "robot_id", "left").withColumn("fps", F.coalesce("episode_fps", "_robot_fps")).drop("_robot_fps")
    else:
        out = out.withColumn("fps", F.col("episode_fps"))
    out = out.drop("episode_fps")
    if thresholds is not None:
        q = thresholds.where(F.col("robot_id").isNotNull()).groupBy("robot_id").agg(F.min(F.struct(*columns)).alias("_q")).select("robot_id", *[F.col(f"_q.{c}").alias(c) for c in columns])
        out = out.join(bounded_broadcast(q, MAX_ROBOT_ROWS), "robot_id")
    return out


def chunk_table(frames: DataFrame, settings: DataFrame, width: int = CHUNK_ROWS, **aggs: Column) -> DataFrame:
    """The ``(episode_index, chunk)`` pairs that have frames, with their episode's settings; frames' other episodes drop out."""
    return chunk_sizes(frames, "episode_index", "global_index", width, **aggs).join(settings, "episode_index")
