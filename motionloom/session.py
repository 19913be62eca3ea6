"""Session helpers: defaults for local work, size-checked broadcasts and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "*", partitions: int = 8, app: str = "motionloom") -> SparkSession:
    """A session for tests and benches; on a cluster the caller's own session is used."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only after counting that the side has at most ``max_rows`` rows.

    Beyond the bound the frame is returned unhinted, so the join shuffles instead.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the cluster's shared folder.

    The folder in ``spark.checkpoint.dir`` is used; only a session without one (tests) gets a temporary folder.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="motionloom-"))
    return df.checkpoint()
