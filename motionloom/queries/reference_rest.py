"""Queries of transforms, alignment, statistics, language, review and policy, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionloom.functions.vectors import binarized, changed_values, clipped, feature, take
from motionloom.operators import alignment, checks, groups, language, review, statistics, transforms
from motionloom.operators.trajectory import own
from motionloom.plans import policy as pol
from motionloom.queries.reference_checks import TRAJECTORY, rounded, rows_of, with_double_counts
from motionloom.queries.reference_rest_sql import SQL as _SQL
from motionloom.sources.tables import table

EPISODE = "episode_index"
HORIZON = 50
POLICY = pol.Policy(rules={"joint_limits": pol.Rule("reject_episode", "warn"), "groups/arm/velocity": pol.Rule("warn", "reject_episode"), "velocity": pol.Rule("report", "report"), "finite": pol.Rule("abort", "warn")})


def _rows(s: SparkSession, d: str, columns: tuple[str, ...] = ()) -> DataFrame:
    return rows_of(s, d, columns, 0)


def _mask(s: SparkSession, d: str) -> DataFrame:
    r = rows_of(s, d, halo=1)
    return transforms.keep_mask(r, checks.static_edges(r), drop_nonfinite=True)


def keep_rows(s: SparkSession, d: str) -> DataFrame:
    """Rows per episode that survive trimming and the finite filter."""
    return transforms.too_short(_mask(s, d), 30)


def drop_static(s: SparkSession, d: str) -> DataFrame:
    return transforms.keep_mask(rows_of(s, d, halo=1), epsilon=0.002).where(~F.col("keep")).select(EPISODE, "pos")


def interpolate(s: SparkSession, d: str) -> DataFrame:
    r = transforms.interpolated(_rows(s, d), F.col("state")[0])
    return rounded(r.where(F.isnan(F.col("state")[0])).select("global_index", "filled"), "filled")


def forward_fill(s: SparkSession, d: str) -> DataFrame:
    r = transforms.forward_filled(_rows(s, d), F.col("action")[0])
    return r.where(F.isnan(F.col("action")[0])).select("global_index", "filled")


def clip_changes(s: SparkSession, d: str) -> DataFrame:
    """Values per episode that clipping to the joint limits changes."""
    r = transforms.clip_to(_rows(s, d, ("joint_low", "joint_high")), "state", F.col("joint_low"), F.col("joint_high"))
    return r.groupBy(EPISODE).agg(F.sum(changed_values(F.col("state"), F.col("clipped"))).alias("changed"))


def percentile_clip(s: SparkSession, d: str) -> DataFrame:
    """Values per component moved by clipping to the dataset's percentiles."""
    r = _rows(s, d)
    bounds = transforms.sampled_bounds(r, "action", 8)
    both = own(r).join(F.broadcast(bounds))  # one row
    moved = F.transform(F.zip_with("action", clipped(F.col("action"), F.col("lows"), F.col("highs")), lambda a, b: ~a.eqNullSafe(b)), lambda x: x.cast("long"))
    return both.select(F.posexplode(moved).alias("component", "x")).groupBy("component").agg(F.sum("x").alias("changed")).select(F.col("component").cast("long").alias("component"), "changed")


def binarize(s: SparkSession, d: str) -> DataFrame:
    """Closed rows per episode under both threshold conventions."""
    x = F.col("state")[7]
    return _rows(s, d).where(~F.isnan(x)).groupBy(EPISODE).agg(F.sum(binarized(x, 0.5)).alias("at_least"), F.sum(binarized(x, 0.5, inclusive=False)).alias("above"))


def reindex(s: SparkSession, d: str) -> DataFrame:
    kept = own(_mask(s, d).where("keep"))
    return transforms.reindexed(kept).select("global_index", "new_episode", "new_index", "new_global", F.round("new_t", 6).alias("new_t"))


def pad(s: SparkSession, d: str) -> DataFrame:
    return rounded(transforms.padded(_rows(s, d).where(F.col("fps").isNotNull()), 40).where(~F.col("valid")).select(EPISODE, "pos", "t", F.col("action")[0].alias("action0")), "t")


def chunks(s: SparkSession, d: str) -> DataFrame:
    r = _rows(s, d)
    c = transforms.chunk_indices(r, checks.length_check(r), HORIZON)
    return c.groupBy(EPISODE).agg(F.sum(F.aggregate("action_positions", F.lit(0).cast("long"), lambda a, x: a + x)).alias("position_sum"), F.sum(F.size(F.filter("is_padding", lambda x: x)).cast("long")).alias("padding"))


def chunk_stats(s: SparkSession, d: str) -> DataFrame:
    return rounded(statistics.chunk_statistics(checks.length_check(_rows(s, d)), HORIZON), "padding_ratio", "sample_padding_ratio")


def chunk_summary(s: SparkSession, d: str) -> DataFrame:
    out = statistics.chunk_summary(statistics.chunk_statistics(checks.length_check(_rows(s, d)), HORIZON), HORIZON)
    return rounded(out, "slot_ratio", "mean_ratio", "median_ratio", "p95_ratio")


def _streams(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    r = table(s, d, "sensor_readings").where(F.col(EPISODE).isNotNull())
    seconds = (F.unix_micros(F.col("read_at").cast("timestamp")) / F.lit(1e6)).alias("ts")
    left = r.where(F.col("representation") == "joint_position").select(EPISODE, seconds, F.col("reading_id").alias("left_id")).distinct()
    right = r.where(F.col("representation") == "joint_velocity").select(EPISODE, seconds, F.col("reading_id").alias("right_id")).distinct()
    return left, right


def _align(policy: str):  # noqa: ANN202
    def run(s: SparkSession, d: str) -> DataFrame:
        left, right = _streams(s, d)
        return alignment.aligned(left, right, EPISODE, "ts", "right_id", policy, None if policy == "exact" else 3600.0).select("left_id", "right_id", "matched")

    return run


def stats(source: str, *keys: str, quantiles: bool = True):  # noqa: ANN201
    def run(s: SparkSession, d: str) -> DataFrame:
        r = _rows(s, d)
        r = statistics.relative(r) if source == "delta" else r
        out = statistics.moments(r, source, *keys, quantiles=quantiles)
        return rounded(out.withColumn("component", F.col("component").cast("long")), *[c for c, t in out.dtypes if t == "double"])

    return run


def numeric_summary(s: SparkSession, d: str) -> DataFrame:
    return statistics.numeric_summary(_rows(s, d), "state").withColumn("component", F.col("component").cast("long"))


def calibrate(s: SparkSession, d: str) -> DataFrame:
    """Robust velocity thresholds per robot from one peak per episode."""
    r = rows_of(s, d)
    peaks = checks.derivative_check(r, 1).join(r.select(EPISODE, "robot_id").distinct(), EPISODE)
    return rounded(statistics.robust_threshold(peaks.withColumn("peak", F.coalesce("peak", F.lit(float("nan")))), "peak", "robot_id", min_samples=5), "median", "mad", "threshold")


def task_summary(s: SparkSession, d: str) -> DataFrame:
    return statistics.dataset_summary(_rows(s, d))


def language_check(s: SparkSession, d: str) -> DataFrame:
    return language.language_check(table(s, d, "task_info").drop("noted_at", "info_id"), table(s, d, "tasks"))


def language_summary(s: SparkSession, d: str) -> DataFrame:
    return language.language_summary(table(s, d, "task_info").drop("noted_at", "info_id"), table(s, d, "tasks"))


def task_join(s: SparkSession, d: str) -> DataFrame:
    """Frames per index issue of their task reference."""
    f = own(_rows(s, d)).select(EPISODE, "global_index", "task_index", F.lit(None).cast("string").alias("task_text"))
    return language.resolved(f, table(s, d, "tasks")).groupBy(F.coalesce("issue", F.lit("resolved")).alias("issue")).agg(F.count(F.lit(1)).alias("n"))


def review_query(s: SparkSession, d: str) -> DataFrame:
    return rounded(review.review(rows_of(s, d, halo=2), static_epsilon=1e-3, static_seconds=0.5), "seconds", "static_fraction", "longest_static_seconds", "max_action_step", "jitter_fraction")


def _found(s: SparkSession, d: str) -> DataFrame:
    return groups.audit(rows_of(s, d, ("joint_low", "joint_high"), 3), [groups.QualityGroup("arm", "state", tuple(range(8)), velocity=5.0)], limits=("joint_low", "joint_high"))


ALL_GROUPS = [
    groups.QualityGroup("arm", "state", tuple(range(8)), velocity=5.0, acceleration=100.0, jerk=2000.0, zscore=3.0, velocity_zscore=3.0, acceleration_zscore=3.0, static_epsilon=1e-3, static_ratio=0.2),
]


def group_findings(s: SparkSession, d: str) -> DataFrame:
    """Nine checks of a group in one pass over the rows."""
    return rounded(groups.audit(rows_of(s, d), ALL_GROUPS, min_rows=30), "value")


def calibrate_groups(s: SparkSession, d: str) -> DataFrame:
    """Robust thresholds of five measures of a group."""
    return rounded(groups.calibrate_groups(rows_of(s, d), {"arm": ("state", tuple(range(8)))}, digits=6), "median", "mad", "threshold")


def policy_summary(s: SparkSession, d: str) -> DataFrame:
    """Findings that call for something, by path, reason and action."""
    return pol.decisions(_found(s, d), POLICY).groupBy("path", "reason", "action").agg(F.count(F.lit(1)).alias("episodes"))


def interpolate_rows(s: SparkSession, d: str) -> DataFrame:
    """Gaps filled by row position instead of time."""
    r = transforms.interpolated(_rows(s, d), F.col("state")[0], by_time=False)
    return rounded(r.where(F.isnan(F.col("state")[0])).select("global_index", "filled"), "filled")


def planted_duplicates(s: SparkSession, d: str) -> DataFrame:
    """Duplicates when every episode comes again under another number."""
    r = _rows(s, d).select(EPISODE, "is_halo", "pos", "state", "action")
    return review.duplicates(r.unionByName(r.withColumn(EPISODE, F.col(EPISODE) + COPY)))


def alias_sync(s: SparkSession, d: str) -> DataFrame:
    """Values per episode that change when a stored copy is made to agree with its source."""
    r = transforms.synchronized(_rows(s, d).withColumn("copy", take(F.col("state"), [0, 1])), "copy", "action", 0, 2)
    return r.groupBy(EPISODE).agg(F.sum("_changed").alias("changed"))


def chunk_values(s: SparkSession, d: str) -> DataFrame:
    """Sums of the first component over the next actions, and padding."""
    r = transforms.chunk_actions(rows_of(s, d, halo=CHUNK - 1), CHUNK)
    total = F.aggregate("actions", F.lit(0.0), lambda a, x: a + x[0])
    return rounded(r.select("global_index", F.when(~F.isnan(total), total).alias("total"), F.size(F.filter("is_padding", lambda x: x)).cast("long").alias("padding")), "total")


def failed_episodes(s: SparkSession, d: str) -> DataFrame:
    """Episodes with frames by the success their first registration states."""
    e = table(s, d, "episodes").where(F.col(EPISODE).isNotNull()).groupBy(EPISODE).agg(F.min("is_episode_successful").alias("successful"))
    return table(s, d, "frames").select(EPISODE).distinct().join(e, EPISODE).groupBy("successful").agg(F.count(F.lit(1)).alias("episodes"))


def strided_bounds(s: SparkSession, d: str) -> DataFrame:
    out = statistics.strided_bounds(_rows(s, d), "action", target_rows=20_000)
    return rounded(out.withColumn("component", F.col("component").cast("long")), "low", "high")


COPY, CHUNK = 100_000_000, 8


def features(s: SparkSession, d: str) -> DataFrame:
    """Named slices put together and a selection in schema order."""
    r = _rows(s, d)
    f = feature([(F.col("state"), 0, 3), (F.col("action"), 7, 8)])
    return r.select("global_index", F.round(F.aggregate(f, F.lit(0.0), lambda a, x: a + x), 6).alias("mapped_sum"), take(F.col("state"), [1, 6])[1].alias("picked"))


def missing_episodes(s: SparkSession, d: str) -> DataFrame:
    """Episodes registered without frames and frames without a registered episode (set differences)."""
    f = table(s, d, "frames").select(EPISODE).distinct()
    e = table(s, d, "episodes").select(EPISODE).distinct()
    return e.exceptAll(f).withColumn("side", F.lit("no_frames")).unionByName(f.exceptAll(e).withColumn("side", F.lit("not_registered")))


QUERIES = {
    "transform_keep_rows": keep_rows, "transform_drop_static": drop_static, "transform_interpolate": interpolate, "transform_forward_fill": forward_fill, "transform_clip": clip_changes,
    "transform_percentile_clip": percentile_clip, "transform_binarize": binarize, "transform_reindex": reindex, "pad_episodes": pad, "action_chunks": chunks, "chunk_statistics": chunk_stats, "chunk_summary": chunk_summary,
    "align_exact": _align("exact"), "align_backward": _align("backward"), "align_nearest": _align("nearest"), "stats_state": stats("state"), "stats_relative": stats("delta"), "stats_by_episode": stats("state", EPISODE, quantiles=False),
    "numeric_summary": numeric_summary, "calibrate_velocity": calibrate, "task_summary": task_summary, "language_check": language_check, "language_summary": language_summary, "task_join": task_join,
    "review_episodes": review_query, "duplicate_episodes": lambda s, d: review.duplicates(_rows(s, d)), "policy_decisions": lambda s, d: pol.decisions(_found(s, d), POLICY), "policy_verdicts": lambda s, d: pol.verdicts(_found(s, d), POLICY),
    "group_findings": group_findings, "calibrate_groups": calibrate_groups, "policy_summary": policy_summary, "rule_counters": lambda s, d: groups.rule_counters(groups.audit(rows_of(s, d), ALL_GROUPS, min_rows=30)), "transform_interpolate_rows": interpolate_rows, "duplicates_planted": planted_duplicates,
    "alias_sync": alias_sync, "chunk_values": chunk_values, "failed_episodes": failed_episodes, "strided_bounds": strided_bounds, "check_nonfinite_rows": lambda s, d: checks.nonfinite_positions(_rows(s, d)),
    "check_velocity_periodic": lambda s, d: rounded(checks.derivative_check(rows_of(s, d), 1, 5.0, period=0.5).withColumn("intervals_beyond", F.col("intervals_beyond").cast("double")), "peak"),
    "feature_mapping": features, "missing_episodes": missing_episodes, "task_table": lambda s, d: language.task_table_check(table(s, d, "tasks")),
}
COUNTS = {n: ("right_id",) for n in ("align_exact", "align_backward", "align_nearest")}
QUERIES, SQL = with_double_counts(QUERIES, _SQL, COUNTS)
