"""Parquet tables by name under one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """``folder/name.parquet`` as a DataFrame (one file or a directory of files)."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
