"""Review heuristics per episode: still stretches, action jumps, jitter, duration, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from motionloom.functions.vectors import all_finite, largest
from motionloom.operators.transforms import with_carried
from motionloom.operators.trajectory import before, own

EPISODE = "episode_index"
FIRST = 20


def review(rows: DataFrame, static_epsilon: float = 1e-4, static_seconds: float = 3.0, jump: float = 0.5, jitter_step: float = 0.1, jitter_fraction: float = 0.25, min_seconds: float = 2.0, max_seconds: float = 120.0) -> DataFrame:
    """Per episode with finite values its measures and flags; rows need a halo of two."""
    minus = lambda c: F.zip_with(F.col(c), before(c), lambda a, b: a - b)
    r = rows.withColumn("_ds", largest(minus("state"))).withColumn("_da", minus("action"))
    r = r.withColumn("_pa", before("_da"))
    flips = F.zip_with("_da", "_pa", lambda a, b: (a * b < 0) & (F.abs(a) > jitter_step) & (F.abs(b) > jitter_step))
    r = own(r.withColumn("_jit", F.exists(flips, lambda x: F.coalesce(x, F.lit(False)))).withColumn("_jump", largest(F.col("_da"))))
    r = r.withColumn("_still", F.col("_ds") <= static_epsilon).select(EPISODE, "chunk", "global_index", "pos", "fps", "_still", "_jit", "_jump", "_pa", (all_finite(F.col("state")) & all_finite(F.col("action"))).alias("_ok"))
    r = with_carried(r, F.when(~F.coalesce("_still", F.lit(False)), F.col("pos")), "_break")
    n = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("long"))
    first = lambda c: F.slice(F.array_sort(c), 1, FIRST)
    parts = r.groupBy(EPISODE, "chunk").agg(
        F.count(F.lit(1)).alias("n"), F.min("_ok").alias("ok"), F.max("fps").alias("fps"), n(F.col("_still")).alias("still"), F.max(F.col("pos") - F.col("_break")).alias("run"), n(F.col("_jump") > jump).alias("jumps"),
        F.max("_jump").alias("top"), n(F.col("_jit")).alias("jitter"), F.count("_pa").alias("pairs"), first(F.collect_list(F.when(F.col("_jump") > jump, F.col("pos")))).alias("at"),
    )
    e = parts.groupBy(EPISODE).agg(
        F.sum("n").alias("n_rows"), F.min("ok").alias("ok"), F.max("fps").alias("fps"), F.sum("still").alias("still"), F.max("run").alias("run"), F.sum("jumps").alias("action_jumps"), F.max("top").alias("max_action_step"),
        F.sum("jitter").alias("jitter"), F.sum("pairs").alias("pairs"), first(F.flatten(F.collect_list("at"))).alias("jump_positions"),
    )
    e = e.where("ok").withColumn("seconds", F.try_divide(F.col("n_rows").cast("double"), F.col("fps")))
    e = e.withColumn("static_fraction", F.coalesce(F.try_divide(F.col("still").cast("double"), F.col("n_rows") - 1), F.lit(0.0))).withColumn("longest_static_seconds", F.try_divide(F.col("run").cast("double"), F.col("fps")))
    e = e.withColumn("jitter_fraction", F.coalesce(F.try_divide(F.col("jitter").cast("double"), F.col("pairs")), F.lit(0.0))).withColumn("max_action_step", F.coalesce("max_action_step", F.lit(0.0)))
    say = lambda test, name: F.when(F.coalesce(test, F.lit(False)), F.lit(name))
    # Names of the flags.
    flags = F.array_compact(
        F.array(
            say(F.col("longest_static_seconds") >= static_seconds, "long_static_state"), say(F.col("action_jumps") > 0, "action_step_candidate"),
            say(F.col("jitter_fraction") > jitter_fraction, "action_jitter_candidate"), say(~F.col("seconds").between(min_seconds, max_seconds), "duration_candidate"),
        )
    )
    return e.select(EPISODE, "n_rows", "seconds", "static_fraction", "longest_static_seconds", "action_jumps", "max_action_step", "jitter_fraction", F.array_join(F.transform("jump_positions", lambda x: x.cast("string")), ",").alias("jump_positions"), F.array_join(flags, ",").alias("flags"))


def duplicates(rows: DataFrame) -> DataFrame:
    """Episodes whose states and actions equal those of an earlier episode, and which one."""
    r = own(rows).select(EPISODE, F.xxhash64("pos", "state", "action").alias("_a"), F.xxhash64(F.lit(7), "action", "pos", "state").alias("_b"), (all_finite(F.col("state")) & all_finite(F.col("action"))).alias("_ok"))
    e = r.groupBy(EPISODE).agg(F.count(F.lit(1)).alias("_n"), F.bit_xor("_a").alias("_x"), F.sum(F.col("_b").cast("decimal(20,0)")).alias("_s"), F.min("_ok").alias("_ok")).where("_ok")
    first = F.min(EPISODE).over(Window.partitionBy("_n", "_x", "_s"))
    return e.withColumn("duplicate_of", first).where(F.col("duplicate_of") < F.col(EPISODE)).select(EPISODE, "duplicate_of")
