"""Writing a dataset and publishing it whole or not at all.

Rows are written by Spark into a hidden sibling folder, read back and checked, and only then renamed into place.
"""

from __future__ import annotations

import hashlib
import json
import math
import os
import shutil
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motionloom.functions.vectors import all_finite
from motionloom.operators.transforms import reindexed
from motionloom.session import bounded_broadcast
from motionloom.sources.datasets import Dataset, DatasetError, read_sharded

#: Task tables up to this many rows are broadcast.
MAX_TASKS = 100_000


def plain_json(value: object) -> object:
    """Numbers that JSON lacks become null."""
    if isinstance(value, float) and not math.isfinite(value):
        return None
    if isinstance(value, dict):
        return {str(k): plain_json(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [plain_json(v) for v in value]
    return value


def write_json(path: Path, value: object) -> None:
    """A JSON file that appears complete."""
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(path.name + ".part")
    part.write_text(json.dumps(plain_json(value), ensure_ascii=False, indent=1, sort_keys=True, allow_nan=False), "utf-8")
    os.replace(part, path)


def copy_verified(source: Path, target: Path) -> str:
    """Copy a file and compare checksums."""
    digest = lambda p: hashlib.file_digest(p.open("rb"), "sha256").hexdigest()
    target.parent.mkdir(parents=True, exist_ok=True)
    shutil.copyfile(source, target)
    if (d := digest(source)) != digest(target):
        raise OSError(f"{target}: differs from its source")
    return d


def build_dataset(kept: DataFrame, tasks: DataFrame) -> DataFrame:
    """Frames with rebuilt identity, of trajectory rows to keep (K1-K4).

    A task index that does not stand for exactly one text becomes null.
    """
    r = reindexed(kept)
    texts = tasks.where(F.col("task").isNotNull()).groupBy("task_index").agg(F.count_distinct("task").alias("_n")).where(F.col("_n") == 1)
    r = r.join(bounded_broadcast(texts.select("task_index", F.lit(True).alias("_known")), MAX_TASKS), "task_index", "left").withColumn("task_index", F.when(F.col("_known"), F.col("task_index")))
    frames = r.select(F.col("new_global").alias("index"), F.col("new_episode").alias("episode_index"), F.col("new_index").alias("frame_index"), F.col("new_t").alias("timestamp"), "task_index", F.col("state").alias("observation.state"), "action", F.col("episode_index").alias("source_episode"), F.col("pos").alias("source_position"))
    return frames


def episode_table(frames: DataFrame) -> DataFrame:
    """Length, offsets and source of each episode of written frames."""
    return frames.groupBy("episode_index").agg(F.count(F.lit(1)).alias("length"), F.min("index").alias("dataset_from_index"), (F.max("index") + 1).alias("dataset_to_index"), F.min("source_episode").alias("source_episode"))


def publish(target: str, frames: DataFrame, tasks: DataFrame, info: dict, reports: dict[str, object] | None = None, audit: Callable[[Dataset], list[str]] | None = None) -> Dataset:
    """Write, read back, check, and rename into place; an existing target is refused."""
    spark, out = frames.sparkSession, Path(target)
    if out.exists():
        raise FileExistsError(target)
    part = out.with_name(f".{out.name}.partial")
    shutil.rmtree(part, ignore_errors=True)
    frames.repartitionByRange("index").sortWithinPartitions("index").write.parquet(str(part / "data"))
    written = spark.read.parquet(str(part / "data"))
    if written.where(~all_finite(F.col("`observation.state`")) | ~all_finite(F.col("action"))).limit(1).count():
        shutil.rmtree(part)
        raise DatasetError("non-finite values are left")
    episode_table(written).write.parquet(str(part / "meta/episodes"))
    tasks.write.parquet(str(part / "meta/tasks.parquet"))
    write_json(part / "meta/info.json", {"codebase_version": "v3.0", **info})
    for name, value in (reports or {}).items():
        write_json(part / "reports" / f"{name}.json", value)
    d = read_sharded(spark, str(part))
    problems = [f"{r[0]}: {r[1]}" for r in d.problems().limit(100).collect()] + (audit(d) if audit else [])
    if problems:
        shutil.rmtree(part)
        raise DatasetError("; ".join(problems))
    write_json(part / "COMPLETE.json", {"frames": d.frames.count(), "episodes": d.episodes.count()})
    os.rename(part, out)
    return read_sharded(spark, target)
