"""Queries of the language-model problems over the test tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionloom.llm.leakage import SPAN, leaked_passages
from motionloom.llm.mixing import Mix
from motionloom.llm.quantiles import percentile_bounds, rank_bounds_kept
from motionloom.llm.residue import residue
from motionloom.llm.runs import collapse_runs
from motionloom.operators.episodes import chunk_table, episode_settings
from motionloom.sources.tables import table

ACTION_WIDTH = 8
#: Seconds between facing events that end a stretch in p2_gaps and p2_similar.
MAX_GAP = 0.5
CHARACTER_BLOCK = 2048


def _events(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    frames = table(spark, folder, "frames")
    settings = episode_settings(table(spark, folder, "episodes"), None, table(spark, folder, "quality_thresholds"), ("static_epsilon", "min_kept_frames"))
    return frames, chunk_table(frames, settings).withColumnsRenamed({"static_epsilon": "max_step", "min_kept_frames": "min_kept"})


def p2_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Every stretch of near-equal actions once, where its episode keeps enough rows."""
    frames, limits = _events(spark, folder)
    return collapse_runs(frames, limits, ACTION_WIDTH).where(F.col("kept_rows") >= F.col("min_kept")).select("episode_index", "first_index", "last_index", "n_rows", "duration")


def p2_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Stretches of near-equal actions that an interruption of the clock by half a second ends too, with their rows."""
    frames, limits = _events(spark, folder)
    return collapse_runs(frames, limits, ACTION_WIDTH, max_gap=MAX_GAP).select("episode_index", "first_index", "last_index", "n_rows", "kept_rows")


def p2_similar(spark: SparkSession, folder: str) -> DataFrame:
    """Stretches whose mean actions stay within the limit: centroid linkage, the most similar neighbours merged first."""
    frames, limits = _events(spark, folder)
    return collapse_runs(frames, limits, ACTION_WIDTH, linkage="centroid", max_gap=MAX_GAP).select("episode_index", "first_index", "last_index", "n_rows", "kept_rows")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """First and last row of each stretch."""
    return p2_runs(spark, folder).select("episode_index", "first_index", "last_index")


def p4_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Median and bounds of each action component per robot and day, and over all days."""
    frames = table(spark, folder, "frames")
    settings = episode_settings(table(spark, folder, "episodes"), None, table(spark, folder, "quality_thresholds"), ("quantile",))
    return percentile_bounds(frames, chunk_table(frames, settings), ACTION_WIDTH).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def p4_rank_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """With buffers of 64 values, which collapse many times: whether every stated error holds, by counting all values."""
    frames = table(spark, folder, "frames")
    sources = chunk_table(frames, episode_settings(table(spark, folder, "episodes"), None, table(spark, folder, "quality_thresholds"), ("quantile",)))
    return rank_bounds_kept(frames, sources, percentile_bounds(frames, sources, ACTION_WIDTH, k=64), ACTION_WIDTH)


def p7_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with passages of evaluation items, equal or with few substitutions."""
    return leaked_passages(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that contain twelve successive words of an item."""
    return p7_passages(spark, folder).where(F.col("exact_words") >= SPAN).select("doc_id", "item_id")


def _mix(spark: SparkSession, folder: str) -> Mix:
    return Mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))


def p8_report(spark: SparkSession, folder: str) -> DataFrame:
    """Target and reached share of each source."""
    return _mix(spark, folder).report()


def p8_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The mix itself: slots and the token ranges that fill them."""
    return _mix(spark, folder).pieces()


def p8_characters(spark: SparkSession, folder: str) -> DataFrame:
    """The report of a mix by code points: slots of the schedule, sizes mixed, shortness."""
    report = Mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets"), CHARACTER_BLOCK, vocabulary=None).report()
    return report.select("source", "slots", "tokens_available", "tokens_possible", "tokens_mixed", F.round("actual_share", 6).alias("actual_share"), F.round("share_of_total", 6).alias("share_of_total"), "short")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Sources that cannot reach their share."""
    return p8_report(spark, folder).where("short").select("source")


def p9_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every document (null: it stays in the corpus)."""
    return residue(table(spark, folder, "documents"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents to leave out of the corpus."""
    return p9_verdicts(spark, folder).where(F.col("verdict").isNotNull()).select("doc_id").distinct()


QUERIES = {"p2_found": p2_found, "p2_runs": p2_runs, "p2_gaps": p2_gaps, "p2_similar": p2_similar, "p4_percentiles": p4_percentiles, "p4_rank_bounds": p4_rank_bounds, "p7_found": p7_found, "p7_passages": p7_passages, "p8_found": p8_found, "p8_report": p8_report, "p8_characters": p8_characters, "p8_mix": p8_mix, "p9_found": p9_found, "p9_verdicts": p9_verdicts}

_P2_FRAME = """WITH f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY global_index ORDER BY received_at) AS _rn FROM frames) WHERE _rn = 1),
e AS (SELECT episode_index, min(robot_id) AS robot_id FROM episodes GROUP BY episode_index),
q AS (SELECT robot_id, min(static_epsilon) AS eps, min(min_kept_frames) AS min_kept FROM quality_thresholds GROUP BY robot_id),
r AS (SELECT f.episode_index, f.global_index, f.t, q.eps, q.min_kept, f.action AS a,
  lag(f.action) OVER w AS p, abs(f.t - lag(f.t) OVER w) AS dt FROM f JOIN e USING (episode_index) JOIN q USING (robot_id) WINDOW w AS (PARTITION BY f.episode_index ORDER BY f.global_index)),
d AS (SELECT *, CASE WHEN {gap}a IS NULL OR p IS NULL OR len(list_filter(list_concat(a, p), lambda x: x IS NULL OR NOT isfinite(x))) > 0 THEN 1
  WHEN list_max(list_transform(list_zip(a, p), lambda z: abs(CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE)))) <= eps THEN 0 ELSE 1 END AS brk FROM r),
i AS (SELECT *, sum(brk) OVER (PARTITION BY episode_index ORDER BY global_index) AS run FROM d),
g AS (SELECT episode_index, run, min(global_index) AS first_index, max(global_index) AS last_index, count(*) AS n_rows, max(t) - min(t) AS duration, max(min_kept) AS min_kept FROM i GROUP BY episode_index, run),
k AS (SELECT *, sum(n_rows) OVER (PARTITION BY episode_index) - sum(CASE WHEN n_rows >= 3 THEN n_rows - 1 ELSE 0 END) OVER (PARTITION BY episode_index) AS kept FROM g)
"""

_P2 = _P2_FRAME.replace("{gap}", "")
_P2_GAPS = _P2_FRAME.replace("{gap}", f"dt IS NULL OR NOT dt <= {MAX_GAP} OR ")

_WORDS = "list_filter(string_split_regex(lower(strip_accents(replace(regexp_replace(replace({}, chr(65279), ''), '</?[A-Za-z][^<>]*>', ' ', 'g'), 'ß', 'ss'))), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"
_P7 = f"""WITH d AS (SELECT DISTINCT doc_id, {_WORDS.format("text")} AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT item_id, {_WORDS.format("item_text")} AS w FROM eval_items),
dg AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 10), lambda k: array_to_string(w[k:k + 11], ' '))) AS g FROM d WHERE len(w) >= 12),
ig AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 10), lambda k: array_to_string(w[k:k + 11], ' '))) AS g FROM i WHERE len(w) >= 12)
"""

_P4 = """WITH f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY global_index ORDER BY received_at) AS _rn FROM frames) WHERE _rn = 1),
e AS (SELECT episode_index, min(robot_id) AS robot_id FROM episodes GROUP BY episode_index),
q AS (SELECT robot_id, min(quantile) AS quantile FROM quality_thresholds GROUP BY robot_id),
v AS (SELECT e.robot_id, q.quantile, strftime(f.received_at, '%Y-%m-%d') AS day, unnest(range(0, 8)) AS component, unnest(f.action) AS x FROM f JOIN e USING (episode_index) JOIN q USING (robot_id) WHERE f.action IS NOT NULL),
w AS (SELECT robot_id, quantile, day, component, CAST(x AS DOUBLE) AS x FROM v WHERE x IS NOT NULL AND isfinite(x)),
g AS (SELECT robot_id, quantile, day, component, x FROM w UNION ALL SELECT robot_id, quantile, NULL, component, x FROM w),
k AS (SELECT *, row_number() OVER (PARTITION BY robot_id, day, component ORDER BY x) AS r, count(*) OVER (PARTITION BY robot_id, day, component) AS n FROM g)
"""
_P4_FOUND = """SELECT robot_id, day, component, n, min(x) FILTER (WHERE r >= (1 - quantile) * n) AS low, min(x) FILTER (WHERE r >= 0.5 * n) AS median, min(x) FILTER (WHERE r >= quantile * n) AS high, 0.0::DOUBLE AS rank_error
FROM k GROUP BY robot_id, day, component, n"""

_PLAIN_SOURCE = "nullif(lower(regexp_replace(regexp_replace(source, '^[\\s_-]+|[\\s_-]+$', '', 'g'), '[\\s_-]+', '_', 'g')), '')"
_P8 = f"""WITH t AS (SELECT {_PLAIN_SOURCE} AS source, max(target_share) AS share, max(max_repeats) AS repeats FROM mix_targets WHERE target_share > 0 GROUP BY 1),
d AS (SELECT {_PLAIN_SOURCE} AS source, sum(length(text)) AS n FROM (SELECT DISTINCT * FROM documents) GROUP BY 1),
a AS (SELECT t.*, CAST(coalesce(n, 0) AS BIGINT) AS n FROM t LEFT JOIN d USING (source)),
z AS (SELECT CAST(sum(n) AS BIGINT) AS total, CAST(ceil(sum(n) / {CHARACTER_BLOCK}.0) AS BIGINT) AS slots FROM a),
c AS (SELECT source, coalesce(sum(share) OVER (ORDER BY source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / sum(share) OVER () AS lo, sum(share) OVER (ORDER BY source) / sum(share) OVER () AS hi FROM a),
p AS (SELECT CAST((((i + 1)::HUGEINT * 11400714819323198485) % 18446744073709551616::HUGEINT) // 2048 AS DOUBLE) / 9007199254740992.0 AS x FROM (SELECT unnest(range(0, slots)) AS i FROM z)),
s AS (SELECT c.source, count(p.x) AS slots FROM c LEFT JOIN p ON p.x >= c.lo AND p.x < c.hi GROUP BY c.source),
m AS (SELECT a.*, s.slots, least(s.slots * {CHARACTER_BLOCK}, n * repeats) AS mixed FROM a JOIN s USING (source))
SELECT source, m.slots, n AS tokens_available, n * repeats AS tokens_possible, mixed AS tokens_mixed, round(mixed::DOUBLE / sum(mixed) OVER (), 6) AS actual_share, round(mixed::DOUBLE / total, 6) AS share_of_total, n * repeats < share * total AS short FROM m, z"""

SQL = {
    "p8_characters": _P8,
    "p4_percentiles": _P4 + _P4_FOUND,
    "p4_rank_bounds": _P4 + "SELECT robot_id, day, component, max(n) AS n, true AS low_kept, true AS median_kept, true AS high_kept FROM k GROUP BY robot_id, day, component",
    "p7_found": _P7 + "SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g)",
    "p2_found": _P2 + "SELECT episode_index, first_index, last_index FROM k WHERE n_rows >= 3 AND kept >= min_kept",
    "p2_gaps": _P2_GAPS + "SELECT episode_index, first_index, last_index, n_rows, CAST(kept AS BIGINT) AS kept_rows FROM k WHERE n_rows >= 3",
    "p2_runs": _P2 + "SELECT episode_index, first_index, last_index, n_rows, duration FROM k WHERE n_rows >= 3 AND kept >= min_kept",
}
