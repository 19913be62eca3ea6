"""Readers of dataset folders: shared-shard layout and one-file-per-episode layout.

Both give the same bundle of DataFrames; nothing is converted on disk. Small metadata files are read by the driver.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EPISODE_RANGE = 4096
IDENTITY = ("index", "frame_index", "episode_index", "timestamp", "task_index")


class DatasetError(ValueError):
    """A dataset folder that breaks its contract; all problems found are in the message."""


@dataclass(frozen=True)
class Dataset:
    """Frames, episodes and tasks of one dataset, and its declared facts."""

    root: str
    info: dict
    frames: DataFrame
    episodes: DataFrame
    tasks: DataFrame

    def rows(self, start: int, stop: int) -> DataFrame:
        """Frames of a range of global indices."""
        return self.frames.where((F.col("index") >= start) & (F.col("index") < stop))

    def episode(self, number: int) -> DataFrame:
        """Frames of one episode (S3)."""
        return self.frames.where(F.col("episode_index") == number)

    def problems(self) -> DataFrame:
        """Episodes whose rows, range or place after the previous episode do not fit."""
        counted = self.frames.groupBy("episode_index").agg(F.count(F.lit(1)).alias("rows"), F.min("index").alias("first"), F.max("index").alias("last"))
        e = self.episodes.join(counted, "episode_index", "full")
        e = e.withColumn("_range", F.floor(F.col("episode_index") / EPISODE_RANGE))
        ends = e.groupBy("_range").agg(F.max_by(F.struct("dataset_to_index"), "episode_index").alias("_end"))  # one row per EPISODE_RANGE episodes
        ends = ends.select("_range", F.lag("_end").over(Window.orderBy("_range"))["dataset_to_index"].alias("_before"))
        near = Window.partitionBy("_range").orderBy("episode_index")
        e = e.join(ends, "_range", "left").withColumn("_previous", F.when(F.row_number().over(near) == 1, F.col("_before")).otherwise(F.lag("dataset_to_index").over(near)))
        e = e.withColumn("_gap", F.col("_previous") != F.col("dataset_from_index"))
        say = lambda test, text: F.when(F.coalesce(test, F.lit(False)), F.lit(text))
        wrong = F.array_compact(
            F.array(
                say(F.col("rows").isNull(), "no rows"), say(F.col("length").isNull(), "not registered"), say(F.col("rows") != F.col("length"), "length differs"),
                say((F.col("first") != F.col("dataset_from_index")) | (F.col("last") + 1 != F.col("dataset_to_index")), "range differs"), say(F.col("_gap"), "gap before"),
            )
        )
        return e.select("episode_index", F.array_join(wrong, "; ").alias("problems")).where(F.size(wrong) > 0)

    def video_references(self) -> DataFrame:
        """Long form ``(episode_index, key, chunk, file, start, end)`` of the episodes' video intervals."""
        keys = sorted({c.split("/")[1] for c in self.episodes.columns if c.startswith("videos/")})
        parts = F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(k).alias("key"), F.col(f"`videos/{k}/chunk_index`").alias("chunk"), F.col(f"`videos/{k}/file_index`").alias("file"),
                        F.col(f"`videos/{k}/from_timestamp`").cast("double").alias("start"), F.col(f"`videos/{k}/to_timestamp`").cast("double").alias("end"),
                    )
                    for k in keys
                ]
            )
        )
        if not keys:
            return self.episodes.sparkSession.createDataFrame([], "episode_index long, key string, chunk long, file long, start double, end double")
        return self.episodes.select("episode_index", parts.alias("v")).select("episode_index", "v.*")


def inside(root: str | Path, relative: str) -> Path:
    """A path under the root; anything that leads outside is refused."""
    base = Path(root).resolve()
    path = (base / relative).resolve()
    if not path.is_relative_to(base):
        raise DatasetError(f"{relative}: outside the dataset")
    return path


def fingerprint(root: str | Path) -> str:
    """Hash of the files' paths, sizes and times, and of the metadata's bytes."""
    h = hashlib.sha256()
    for p in sorted(x for x in Path(root).rglob("*") if x.is_file()):
        s = p.stat()
        h.update(f"{p.relative_to(root)}\0{s.st_size}\0{s.st_mtime_ns}\n".encode())
        if p.suffix in (".json", ".jsonl"):
            h.update(p.read_bytes())
    return h.hexdigest()


def _info(root: Path, needed: list[str]) -> dict:
    missing = [n for n in needed if not (root / n).exists()]
    if missing:
        raise DatasetError("missing: " + ", ".join(missing))
    info = json.loads((root / "meta/info.json").read_text("utf-8"))
    fps = info.get("fps")
    if isinstance(fps, bool) or not isinstance(fps, (int, float)) or not 0 < fps < float("inf"):
        raise DatasetError("meta/info.json: fps must be a positive number")
    return info


def read_sharded(spark: SparkSession, root: str) -> Dataset:
    """The layout with shared data shards and parquet metadata."""
    base = Path(root)
    info = _info(base, ["meta/info.json", "meta/tasks.parquet", "meta/episodes", "data"])
    frames = spark.read.option("recursiveFileLookup", "true").parquet(str(base / "data"))
    if absent := [c for c in IDENTITY if c not in frames.columns]:
        raise DatasetError("data: missing " + ", ".join(absent))
    tasks = spark.read.parquet(str(base / "meta/tasks.parquet"))
    text = next((c for c in ("task", "__index_level_0__") if c in tasks.columns), None)
    if text is None:
        raise DatasetError("meta/tasks.parquet: no text column")
    episodes = spark.read.option("recursiveFileLookup", "true").parquet(str(base / "meta/episodes"))
    return Dataset(root, info, frames, episodes, tasks.select("task_index", F.col(f"`{text}`").alias("task")))


def read_per_episode(spark: SparkSession, root: str) -> Dataset:
    """The older layout: one parquet file per episode, JSON lines as metadata."""
    base = Path(root)
    info = _info(base, ["meta/info.json", "meta/episodes.jsonl", "meta/tasks.jsonl", "data"])
    frames = spark.read.option("recursiveFileLookup", "true").parquet(str(base / "data"))
    episodes = spark.read.schema("episode_index long, tasks array<string>, length long").json(str(base / "meta/episodes.jsonl"))
    span = frames.groupBy("episode_index").agg(F.min("index").alias("dataset_from_index"), (F.max("index") + 1).alias("dataset_to_index"))
    tasks = spark.read.schema("task_index long, task string").json(str(base / "meta/tasks.jsonl"))
    return Dataset(root, info, frames, episodes.join(span, "episode_index", "left"), tasks)


def read_dataset(spark: SparkSession, root: str) -> Dataset:
    """Either layout, told by ``codebase_version``."""
    version = str(_info(Path(root), ["meta/info.json"]).get("codebase_version", ""))
    if version.startswith("v3"):
        return read_sharded(spark, root)
    if version.startswith("v2"):
        return read_per_episode(spark, root)
    raise DatasetError(f"unknown codebase_version {version!r}")


def problem_table(spark: SparkSession, root: str) -> DataFrame:
    """All problems of a dataset folder at once (S23): ``(episode_index, problem)``, without episode for the whole dataset's."""
    schema = "episode_index long, problem string"
    try:
        d = read_dataset(spark, root)
    except (DatasetError, OSError, json.JSONDecodeError) as e:
        return spark.createDataFrame([(None, str(e))], schema)
    whole = spark.createDataFrame([(None, p) for p in _declared_problems(d)], schema)
    return d.problems().select(F.col("episode_index").cast("long").alias("episode_index"), F.col("problems").alias("problem")).unionByName(whole)


def validate(spark: SparkSession, root: str) -> list[str]:
    """The lines of :func:`problem_table`, those of episodes first; every one of them goes to the driver."""
    return [problem_line(*r) for r in problem_table(spark, root).orderBy(F.asc_nulls_last("episode_index")).collect()]


def problem_line(episode: int | None, problem: str) -> str:
    """How a problem is printed."""
    return problem if episode is None else f"episode {episode}: {problem}"


def _declared_problems(d: Dataset) -> list[str]:
    out = []
    declared = d.info.get("features", {})
    for name, spec in declared.items():
        if spec.get("dtype") not in ("video",) and name not in d.frames.columns:
            out.append(f"{name}: declared but not stored")
        elif name in d.frames.columns and len(spec.get("shape", [])) == 1 and dict(d.frames.dtypes)[name].startswith("array") and spec["shape"][0] > 0:
            bad = d.frames.where(F.col(f"`{name}`").isNotNull() & (F.size(F.col(f"`{name}`")) != spec["shape"][0])).limit(1).count()
            out += [f"{name}: stored width differs from {spec['shape'][0]}"] * bad
    return out


def inspect(d: Dataset) -> dict:
    """Episodes, frames, lengths and tasks of a dataset."""
    n = d.frames.groupBy("episode_index").agg(F.count(F.lit(1)).alias("n"))
    r = n.agg(F.count(F.lit(1)).alias("episodes"), F.sum("n").alias("frames"), F.min("n").alias("shortest"), F.max("n").alias("longest"), F.avg("n").alias("mean")).first()
    return {**r.asDict(), "fps": d.info["fps"], "tasks": d.tasks.count()}
