"""Command line: inspect, check, audit and clean dataset folders (section 2.16)."""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from motionloom.plans.clean import CleanConfig, clean, plan
from motionloom.operators.trajectory import trajectory
from motionloom.session import checkpointed
from motionloom.sources.datasets import Dataset, inspect, problem_line, problem_table, read_dataset
from motionloom.sources.publish import build_dataset, plain_json, publish

#: Rows printed of a table that is written to a folder.
EXCERPT_ROWS = 1000


def report(table: DataFrame, output: str | None, line: Callable[[Row], str]) -> int:
    """Print a table's rows by episode and return their number; with a folder all are written there and an excerpt is printed."""
    if output is None:
        rows = checkpointed(table)
    else:
        table.write.parquet(output)
        rows = table.sparkSession.read.parquet(output)
    n = rows.count()
    ordered = rows.orderBy(F.asc_nulls_last("episode_index"))
    for r in ordered.toLocalIterator() if output is None else ordered.limit(EXCERPT_ROWS).collect():
        print(line(r))
    if output is not None:
        print(f"{min(n, EXCERPT_ROWS)} of {n} rows printed, all written to {output}")
    return n


def as_frames(d: Dataset):  # noqa: ANN201
    """A dataset's frames and episodes under the canonical column names."""
    f = d.frames.select(
        F.col("index").alias("global_index"), "episode_index", "frame_index", F.col("timestamp").cast("double").alias("t"), "task_index", F.col("`observation.state`").alias("state"), "action", F.lit(None).cast("timestamp").alias("received_at")
    )
    e = d.episodes.select("episode_index", F.lit(None).cast("string").alias("robot_id"), F.lit(float(d.info["fps"])).alias("fps"), "length", "dataset_from_index", "dataset_to_index")
    return f, e


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="motionloom")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("inspect", "check", "audit", "clean"):
        c = sub.add_parser(name)
        c.add_argument("root")
        if name == "clean":
            c.add_argument("output")
        if name in ("check", "audit"):
            c.add_argument("--output", help="new folder for all rows; without it all are printed")
        if name in ("audit", "clean"):
            c.add_argument("--width", type=int, required=True)
            c.add_argument("--nonfinite", choices=("drop", "interpolate", "error"), default="drop")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("motionloom").getOrCreate()
    try:
        if a.command in ("check", "audit") and a.output is not None and Path(a.output).exists():
            raise FileExistsError(f"{a.output} exists")
        if a.command == "check":
            n = report(problem_table(spark, a.root), a.output, lambda r: problem_line(*r))
            print(f"{n} problems" if n else "no problems")
            return int(n > 0)
        d = read_dataset(spark, a.root)
        if a.command == "inspect":
            print(json.dumps(plain_json(inspect(d)), indent=1))
            return 0
        config = CleanConfig(width=a.width, nonfinite=a.nonfinite)
        f, e = as_frames(d)
        if a.command == "audit":
            n = report(plan(trajectory(f, e, width=a.width), config), a.output, lambda r: json.dumps(plain_json(r.asDict())))
            print(f"{n} episodes")
            return 0
        planned, kept = clean(f, e, None, config)
        frames = build_dataset(kept, d.tasks)
        info = {k: v for k, v in d.info.items() if k not in ("codebase_version", "features")}
        publish(a.output, frames, d.tasks, info, {"plan": planned.groupBy("keep").count().toPandas().to_dict("records")})
    except (ValueError, OSError) as error:
        print(error, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
