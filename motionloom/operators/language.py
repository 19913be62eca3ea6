"""Task texts: resolution against the task table, integrity errors and warnings.

A sample's text is that of the task table, else its own. Index issues count per sample, text issues per distinct
``(source, text, index)`` of an episode; errors fail an episode, warnings never do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPISODE = "episode_index"
# Texts that stand for no task.
PLACEHOLDERS = ("n/a", "unknown", "task")
TEXT_ERRORS = ("null_task_text", "empty_task_text")
INDEX_ISSUES = ("missing_task_index", "task_index_out_of_range", "unresolved_task_index", "ambiguous_task_index")


def stripped(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def text_error(c: Column) -> Column:
    """``null_task_text``, ``empty_task_text`` or null."""
    return F.when(c.isNull(), F.lit("null_task_text")).when(stripped(c) == "", F.lit("empty_task_text"))


def text_warnings(c: Column, shortest: int = 2, longest: int = 4096, placeholders: tuple[str, ...] = PLACEHOLDERS) -> Column:
    """Names of the heuristics a valid text meets."""
    say = lambda test, name: F.when(F.coalesce(test, F.lit(False)), F.lit(name))
    return F.array_compact(
        F.array(
            say(F.char_length(c) < shortest, "short_task"), say(F.char_length(c) > longest, "long_task"), say(c.rlike(r"[\p{Cc}\p{Cf}]"), "control_characters"),
            say(stripped(c).rlike(r"^\p{N}+$"), "numeric_task"), say(F.lower(stripped(c)).isin(*[p.lower() for p in placeholders]), "placeholder_task"),
        )
    )


def catalog(tasks: DataFrame) -> DataFrame:
    """One row per task index: number of differing texts and the text where there is one."""
    t = tasks.where(F.col("task_index").isNotNull()).select("task_index", F.col("task").alias("table_text")).distinct()
    return t.groupBy("task_index").agg(F.count(F.lit(1)).alias("n_texts"), F.min("table_text").alias("table_text"))


def resolved(samples: DataFrame, tasks: DataFrame) -> DataFrame:
    """Samples with ``issue``, ``table_text``, ``text`` and ``inconsistent`` (own text differs from the table's)."""
    c = catalog(tasks).withColumnRenamed("task_index", "_k")
    s = samples.where(F.col(EPISODE).isNotNull()).distinct()
    s = s.join(c, s["task_index"] == c["_k"], "left")
    issue = (
        F.when(F.col("task_index").isNull(), F.lit("missing_task_index")).when(F.col("task_index") < 0, F.lit("task_index_out_of_range"))
        .when(F.col("_k").isNull(), F.lit("unresolved_task_index")).when(F.col("n_texts") > 1, F.lit("ambiguous_task_index"))
    )
    valid = text_error(F.col("task_text")).isNull()
    table_ok = issue.isNull() & text_error(F.col("table_text")).isNull()
    return s.withColumn("issue", issue).withColumn("inconsistent", table_ok & valid & (F.col("task_text") != F.col("table_text"))).withColumn("text", F.when(table_ok, F.col("table_text")).otherwise(F.col("task_text"))).drop("_k")


def language_check(samples: DataFrame, tasks: DataFrame, allow_changes: bool = False) -> DataFrame:
    """Per episode sample counts, error counts by code, warnings and the verdict."""
    r = resolved(samples, tasks)
    n = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("long"))
    per = r.groupBy(EPISODE).agg(
        F.count(F.lit(1)).alias("samples"), n(text_error(F.col("text")).isNull()).alias("with_task"), F.count_distinct(F.when(text_error(F.col("text")).isNull(), F.col("text"))).alias("tasks"),
        *[n(F.col("issue") == i).alias(i) for i in INDEX_ISSUES], n(F.col("inconsistent")).alias("inconsistent_mapping"),
    )
    once = r.select(EPISODE, "task_source", "text", "task_index").distinct()
    texts = once.groupBy(EPISODE).agg(*[n(text_error(F.col("text")) == e).alias(e) for e in TEXT_ERRORS], F.sum(F.when(text_error(F.col("text")).isNull(), F.size(text_warnings(F.col("text")))).otherwise(0)).cast("long").alias("warnings"))
    out = per.join(texts, EPISODE)
    errors = sum((F.col(c) for c in (*INDEX_ISSUES, "inconsistent_mapping", *TEXT_ERRORS)), F.lit(0))
    passed = (errors == 0) & (F.col("with_task") > 0)
    return out.withColumn("passed", passed if allow_changes else passed & (F.col("tasks") <= 1))


def language_summary(samples: DataFrame, tasks: DataFrame) -> DataFrame:
    """Per resolved text: episodes and samples that carry it."""
    r = resolved(samples, tasks).where(text_error(F.col("text")).isNull())
    return r.groupBy("text").agg(F.count_distinct(EPISODE).alias("episodes"), F.count(F.lit(1)).alias("samples"), F.max(F.char_length("text")).alias("length"))


def task_table_check(tasks: DataFrame) -> DataFrame:
    """Whether indices run from zero without gaps and all texts are given (Q31)."""
    d = tasks.distinct()
    return d.agg(F.count_distinct("task_index").alias("indices"), F.min("task_index").alias("first"), F.max("task_index").alias("last"), F.sum(text_error(F.col("task")).isNotNull().cast("long")).alias("bad_texts")).withColumn(
        "passed", (F.col("first") == 0) & (F.col("last") == F.col("indices") - 1) & (F.col("bad_texts") == 0)
    )
