"""The ordered view of frames that checks and transforms work on.

One row per frame of a known episode, sent again rows dropped, with source position, rate, time and double vectors.
Rows are cut by ``(episode_index, chunk)``; ``halo`` rows before and after a slice come again with ``is_halo``, so
``lag`` and ``lead`` up to that distance are right in every slice and an episode of any length is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from motionloom.functions.vectors import vector
from motionloom.operators.chunks import CHUNK_ROWS, with_halo
from motionloom.operators.episodes import chunk_table, episode_settings


def in_order() -> WindowSpec:
    """Rows of one slice in order."""
    return Window.partitionBy("episode_index", "chunk").orderBy("global_index")


def before(c: str, rows: int = 1) -> Column:
    """The value some rows earlier in the episode (needs a halo of that many rows)."""
    return F.lag(c, rows).over(in_order())


def trajectory(frames: DataFrame, episodes: DataFrame, robots: DataFrame | None = None, thresholds: DataFrame | None = None, columns: tuple[str, ...] = (), width: int = 8, halo: int = 3, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Frames as trajectory rows; ``columns`` of the robot's thresholds are added.

    A null ``t`` becomes position over rate. Rows without ``global_index`` or of episodes that are not registered are
    not part of a trajectory.
    """
    settings = episode_settings(episodes, robots, thresholds, columns)
    chunks = chunk_table(frames, settings, chunk_rows, _lo=F.min("global_index"))
    chunks = chunks.withColumn("first_index", F.min("_lo").over(Window.partitionBy("episode_index"))).drop("_lo", "n_rows")
    keep = ("global_index", "episode_index", "frame_index", "t", "task_index", "state", "action", "received_at")
    rows = with_halo(frames.where(F.col("global_index").isNotNull()).select(*keep), "global_index", halo, chunk_rows)
    rows = rows.join(chunks, ["episode_index", "chunk"])
    arrived = Window.partitionBy("episode_index", "chunk").orderBy("global_index", "received_at")
    rows = rows.withColumn("_again", F.lag("global_index").over(arrived).eqNullSafe(F.col("global_index"))).where(~F.col("_again")).drop("_again")
    pos = F.col("global_index") - F.col("first_index")
    return rows.select(
        "episode_index", "chunk", "is_halo", "global_index", "first_index", pos.alias("pos"), "robot_id", "fps", "frame_index", "task_index", "received_at",
        F.col("t").alias("raw_t"), F.coalesce(F.col("t"), F.try_divide(pos.cast("double"), F.col("fps"))).alias("t"),
        vector(F.col("state"), width).alias("state"), vector(F.col("action"), width).alias("action"), *columns,
    )


def own(rows: DataFrame) -> DataFrame:
    """Without the halo rows."""
    return rows.where(~F.col("is_halo"))
