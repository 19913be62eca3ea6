"""Pixel measures of image cells given as raw bytes with their shape.

Encoded images need a decoder, which is passed in; the measures themselves run on Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Weights of red, green and blue in brightness.
GRAY = np.array([0.299, 0.587, 0.114])
SCHEMA = "id long, black_share double, brightness double, blur double"


def gray(rgb: np.ndarray) -> np.ndarray:
    """Brightness of every pixel as float."""
    return rgb.astype(np.float64) @ GRAY if rgb.ndim == 3 else rgb.astype(np.float64)


def measures(rgb: np.ndarray, black_level: float = 16.0) -> tuple[float, float, float]:
    """Share of dark pixels, mean brightness, and variance of the Laplacian."""
    g = gray(rgb)
    lap = -4 * g[1:-1, 1:-1] + g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:]
    return float((g <= black_level).mean()), float(g.mean()), float(lap.var()) if lap.size else 0.0


def image_measures(images: DataFrame, shape: tuple[int, int, int], black_level: float = 16.0, decode: Callable[[bytes], np.ndarray] | None = None) -> DataFrame:
    """Measures of ``(id, bytes)``; null or unreadable images give null measures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for data in b.column("bytes").to_pylist():
                try:
                    rgb = decode(data) if decode else np.frombuffer(data, np.uint8).reshape(shape)
                    out.append(measures(rgb, black_level))
                except (ValueError, TypeError):
                    out.append((None, None, None))
            cols = [pa.array([r[i] for r in out], pa.float64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([b.column("id"), *cols], names=["id", "black_share", "brightness", "blur"])

    return images.select(F.col("id").cast("long").alias("id"), "bytes").mapInArrow(run, SCHEMA)


def visual_checks(measured: DataFrame, by: str, black_share: float = 0.98, max_black: float = 0.5, min_blur: float = 100.0, max_blurred: float = 0.5, low: float = 10.0, high: float = 245.0) -> DataFrame:
    """Per group the shares of black and blurred samples and the verdicts."""
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    out = measured.groupBy(by).agg(
        F.count(F.lit(1)).alias("samples"), F.min(F.col("brightness").isNotNull()).alias("evaluated"), share(F.col("black_share") >= black_share).alias("black_ratio"), share(F.col("blur") < min_blur).alias("blur_ratio"), F.min(F.col("brightness").between(low, high)).alias("bright_ok")
    )
    e = F.col("evaluated")
    return out.withColumn("black_passed", e & (F.col("black_ratio") <= max_black)).withColumn("blur_passed", e & (F.col("blur_ratio") <= max_blurred)).withColumn("brightness_passed", e & F.coalesce("bright_ok", F.lit(False))).drop("bright_ok")
