"""SQL counterparts of the queries in ``reference_rest``."""

from __future__ import annotations

from motionloom.queries.reference_checks import SQL as _CHECKS
from motionloom.queries.reference_checks import _STEPS, _W, TRAJECTORY, _all_ok, _derivative_ctes

_FIN = "(t IS NOT NULL AND isfinite(t))"
_T = f"WITH {TRAJECTORY}"
_EDGES = f"""{_STEPS},
ea AS (SELECT episode_index, count(*) AS n, bool_and({_all_ok("action")}) AS ev, min(pos - 1) FILTER (WHERE ma >= 0.002) AS a, max(pos + 1) FILTER (WHERE ma >= 0.002) AS b FROM s GROUP BY episode_index),
ed AS (SELECT *, ev AND a IS NOT NULL AND b - a >= 2 AND (a > 0 OR b < n) AS trim FROM ea),
km AS (SELECT tr.*, (NOT ed.trim OR (pos >= ed.a AND pos < ed.b)) AND {_all_ok("state")} AND {_all_ok("action")} AS keep FROM tr JOIN ed USING (episode_index))"""
_LEN = "ln AS (SELECT episode_index, count(*) AS n FROM tr GROUP BY episode_index)"
_PADDED = "CAST(CASE WHEN n >= 50 THEN 50 * 49 / 2 ELSE n * 50 - n * (n + 1) / 2 END AS BIGINT)"
_STREAM = """l AS (SELECT DISTINCT episode_index, epoch_us(read_at) / 1e6 AS ts, reading_id AS left_id FROM sensor_readings WHERE representation = 'joint_position' AND episode_index IS NOT NULL),
r AS (SELECT episode_index, epoch_us(read_at) / 1e6 AS ts, min(reading_id) AS right_id FROM sensor_readings WHERE representation = 'joint_velocity' AND episode_index IS NOT NULL GROUP BY ALL)"""


def _align(pick: str) -> str:
    return f"""WITH {_STREAM}, c AS (SELECT l.left_id, r.right_id, row_number() OVER (PARTITION BY l.left_id ORDER BY {pick}) AS k FROM l JOIN r ON r.episode_index = l.episode_index AND {"r.ts <= l.ts AND " if "DESC" in pick else ""}abs(l.ts - r.ts) <= 3600)
SELECT l.left_id, CAST(c.right_id AS DOUBLE) AS right_id, c.right_id IS NOT NULL AS matched FROM l LEFT JOIN c ON c.left_id = l.left_id AND c.k = 1"""


def _moments(source: str, keys: str = "", quantiles: bool = True) -> str:
    x = "list_transform(list_zip(action, state), lambda z: z[1] - z[2])" if source == "delta" else source
    qs = ", ".join(f"round(quantile_cont(x, {q}), 6) AS q{int(q * 100):02d}" for q in (0.01, 0.1, 0.5, 0.9, 0.99)) if quantiles else ""
    return f"""{_T}, u AS (SELECT {keys} unnest(range(0, 8)) AS component, unnest({x}) AS x FROM tr)
SELECT {keys} component, count(*) AS n, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, round(min(x), 6) AS minimum, round(max(x), 6) AS maximum{", " + qs if qs else ""} FROM u WHERE isfinite(x) GROUP BY {keys} component"""


_CLIP = "CASE WHEN isnan(z[1]) THEN z[1] ELSE greatest(least(z[1], z[3]), z[2]) END"
_BLANK = r"regexp_replace(regexp_replace({}, '^[\s ]+', ''), '[\s ]+$', '')"
_BAD = f"({{0}} IS NULL OR {_BLANK.format('{0}')} = '')"
_LANG = f"""cat AS (SELECT task_index AS k, count(*) AS n_texts, min(task) AS table_text FROM (SELECT DISTINCT task_index, task FROM tasks WHERE task_index IS NOT NULL) GROUP BY task_index),
sm AS (SELECT DISTINCT episode_index, sample_index, task_index, task_text, task_source FROM task_info WHERE episode_index IS NOT NULL),
rs AS (SELECT sm.*, cat.table_text, CASE WHEN task_index IS NULL THEN 'missing_task_index' WHEN task_index < 0 THEN 'task_index_out_of_range' WHEN k IS NULL THEN 'unresolved_task_index' WHEN n_texts > 1 THEN 'ambiguous_task_index' END AS issue FROM sm LEFT JOIN cat ON cat.k = sm.task_index),
r2 AS (SELECT *, issue IS NULL AND NOT {_BAD.format("table_text")} AS table_ok FROM rs),
r3 AS (SELECT *, CASE WHEN table_ok THEN table_text ELSE task_text END AS text, table_ok AND NOT {_BAD.format("task_text")} AND task_text <> table_text AS inconsistent FROM r2),
r4 AS (SELECT *, NOT {_BAD.format("text")} AS valid FROM r3)"""
_ISSUES = ("missing_task_index", "task_index_out_of_range", "unresolved_task_index", "ambiguous_task_index")
_FOUND = f"""{_STEPS}, {_derivative_ctes(1)},
lim AS (SELECT tr.episode_index, tr.state AS x, q.joint_low AS lo, q.joint_high AS hi FROM tr JOIN quality_thresholds q USING (robot_id)),
fi AS (SELECT episode_index, 'finite' AS path, bool_and({_all_ok("state")} AND {_all_ok("action")} AND {_FIN}) AS passed, true AS evaluated FROM tr GROUP BY episode_index),
jl AS (SELECT episode_index, 'joint_limits' AS path, count(*) FILTER (WHERE len(list_filter(list_zip(x, lo, hi), lambda z: isfinite(z[1]) AND (z[1] < z[2] OR z[1] > z[3]))) > 0) = 0 AS passed, true AS evaluated FROM lim GROUP BY episode_index),
pk AS (SELECT *, list_max(list_transform(x1, lambda v: abs(v))) AS peak FROM d1),
va AS (SELECT episode_index, count(*) > 1 AND bool_and({_FIN}) AND bool_and(coalesce(dt > 0, dt IS NULL)) AND bool_and({_all_ok("state")}) AND coalesce(isfinite(max(peak)), false) AS evaluated, count(*) FILTER (WHERE peak > 5.0) AS b FROM pk GROUP BY episode_index),
fo AS (SELECT * FROM fi UNION ALL SELECT * FROM jl UNION ALL SELECT episode_index, 'groups/arm/velocity', evaluated AND b = 0, evaluated FROM va),
de AS (SELECT episode_index, path, CASE WHEN evaluated THEN 'failed' ELSE 'not_evaluated' END AS reason, CASE path WHEN 'finite' THEN CASE WHEN evaluated THEN 'abort' ELSE 'warn' END WHEN 'joint_limits' THEN CASE WHEN evaluated THEN 'reject_episode' ELSE 'warn' END
  ELSE CASE WHEN evaluated THEN 'warn' ELSE 'reject_episode' END END AS action FROM fo WHERE NOT passed OR NOT evaluated)"""

SQL = {
    "transform_keep_rows": f"{_T}, {_EDGES}, a AS (SELECT episode_index, count(*) AS n_rows, count(*) FILTER (WHERE keep) AS kept FROM km GROUP BY episode_index) SELECT *, kept < 30 AS rejected FROM a",
    "transform_drop_static": f"{_T}, {_STEPS} SELECT episode_index, pos FROM s WHERE ma < 0.002",
    "transform_interpolate": f"""{_T}, b AS (SELECT episode_index, global_index, t, state[1] AS x, CASE WHEN isfinite(state[1]) THEN {{'t': t, 'x': state[1]}} END AS g FROM tr),
c AS (SELECT *, last_value(g IGNORE NULLS) OVER (PARTITION BY episode_index ORDER BY global_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p, first_value(g IGNORE NULLS) OVER (PARTITION BY episode_index ORDER BY global_index ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS n FROM b)
SELECT global_index, round(CASE WHEN p IS NULL THEN n.x WHEN n IS NULL THEN p.x ELSE p.x + (n.x - p.x) * ((t - p.t) / nullif(n.t - p.t, 0)) END, 6) AS filled FROM c WHERE isnan(x)""",
    "transform_forward_fill": f"""{_T}, c AS (SELECT global_index, action[1] AS x, last_value(CASE WHEN isfinite(action[1]) THEN action[1] END IGNORE NULLS) OVER (PARTITION BY episode_index ORDER BY global_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM tr)
SELECT global_index, filled FROM c WHERE isnan(x)""",
    "transform_clip": f"""{_T} SELECT tr.episode_index, CAST(sum(len(list_filter(list_zip(tr.state, q.joint_low, q.joint_high), lambda z: NOT isnan(z[1]) AND {_CLIP.replace("z[1], z[3]", "z[1], z[3]")} <> z[1]))) AS BIGINT) AS changed
FROM tr JOIN quality_thresholds q USING (robot_id) GROUP BY tr.episode_index""",
    "transform_percentile_clip": f"""{_T}, u AS (SELECT unnest(range(0, 8)) AS component, unnest(action) AS x FROM tr WHERE {_all_ok("action")}), b AS (SELECT component, quantile_cont(x, 0.01) AS lo, quantile_cont(x, 0.99) AS hi FROM u GROUP BY component),
v AS (SELECT unnest(range(0, 8)) AS component, unnest(action) AS x FROM tr) SELECT component, count(*) FILTER (WHERE NOT isnan(x) AND (x < lo OR x > hi)) AS changed FROM v JOIN b USING (component) GROUP BY component""",
    "transform_binarize": f"{_T} SELECT episode_index, CAST(count(*) FILTER (WHERE state[8] >= 0.5) AS DOUBLE) AS at_least, CAST(count(*) FILTER (WHERE state[8] > 0.5) AS DOUBLE) AS above FROM tr WHERE NOT isnan(state[8]) GROUP BY episode_index",
    "transform_reindex": f"""{_T}, {_EDGES}, k AS (SELECT *, dense_rank() OVER (ORDER BY episode_index) - 1 AS new_episode, row_number() OVER (PARTITION BY episode_index ORDER BY global_index) - 1 AS new_index, row_number() OVER (ORDER BY episode_index, global_index) - 1 AS new_global FROM km WHERE keep)
SELECT global_index, new_episode, new_index, new_global, round(new_index / fps, 6) AS new_t FROM k""",
    "pad_episodes": f"""{_T}, {_LEN}, l AS (SELECT tr.episode_index, ln.n, arg_max(t, global_index) AS t, max(fps) AS fps, arg_max(action, global_index) AS a FROM tr JOIN ln USING (episode_index) WHERE ln.n < 40 AND fps IS NOT NULL GROUP BY ALL),
p AS (SELECT *, unnest(range(n, 40)) AS pos FROM l) SELECT episode_index, pos, round(t + (pos - n + 1) / fps, 6) AS t, a[1] AS action0 FROM p""",
    "action_chunks": f"{_T}, {_LEN}, u AS (SELECT tr.episode_index, pos, n, unnest(range(0, 50)) AS i FROM tr JOIN ln USING (episode_index)) SELECT episode_index, CAST(sum(least(pos + i, n - 1)) AS BIGINT) AS position_sum, count(*) FILTER (WHERE pos + i >= n) AS padding FROM u GROUP BY episode_index",
    "chunk_statistics": f"{_T}, {_LEN} SELECT episode_index, n AS n_rows, {_PADDED} AS padded, round({_PADDED} / (n * 50), 6) AS padding_ratio, round(least(n, 49) / n, 6) AS sample_padding_ratio FROM ln",
    "chunk_summary": f"""{_T}, {_LEN}, c AS (SELECT n, {_PADDED} AS p, {_PADDED} / (n * 50) AS r FROM ln)
SELECT count(*) AS episodes, round(sum(p) / (sum(n) * 50), 6) AS slot_ratio, round(avg(r), 6) AS mean_ratio, round(quantile_cont(r, 0.5), 6) AS median_ratio, round(quantile_cont(r, 0.95), 6) AS p95_ratio, count(*) FILTER (WHERE r > 0.25) AS over_25, count(*) FILTER (WHERE r > 0.5) AS over_50, count(*) FILTER (WHERE r > 0.75) AS over_75 FROM c""",
    "align_exact": f"WITH {_STREAM} SELECT l.left_id, CAST(r.right_id AS DOUBLE) AS right_id, r.right_id IS NOT NULL AS matched FROM l LEFT JOIN r USING (episode_index, ts)",
    "align_backward": _align("r.ts DESC"),
    "align_nearest": _align("abs(l.ts - r.ts), r.ts"),
    "stats_state": _moments("state"),
    "stats_relative": _moments("delta"),
    "stats_by_episode": _moments("state", "episode_index,", False),
    "numeric_summary": f"""{_T}, u AS (SELECT unnest(range(0, 8)) AS component, unnest(state) AS x FROM tr), a AS (SELECT component, count(*) FILTER (WHERE NOT isfinite(x)) AS nonfinite, min(x) FILTER (WHERE isfinite(x)) AS lo, max(x) FILTER (WHERE isfinite(x)) AS hi FROM u GROUP BY component)
SELECT component, nonfinite, CASE WHEN nonfinite = 0 THEN lo END AS minimum, CASE WHEN nonfinite = 0 THEN hi END AS maximum FROM a""",
    "calibrate_velocity": f"""{_T}, {_derivative_ctes(1)}, pk AS (SELECT *, list_max(list_transform(x1, lambda v: abs(v))) AS p FROM d1),
va AS (SELECT episode_index, CASE WHEN count(*) > 1 AND bool_and({_FIN}) AND bool_and(coalesce(dt > 0, dt IS NULL)) AND bool_and({_all_ok("state")}) AND coalesce(isfinite(max(p)), false) THEN max(p) END AS peak FROM pk GROUP BY episode_index),
x AS (SELECT DISTINCT va.episode_index, tr.robot_id, va.peak FROM va JOIN tr USING (episode_index)), g AS (SELECT robot_id, count(peak) AS samples, count(*) - count(peak) AS excluded, median(peak) AS m, quantile_cont(peak, 0.995) AS q FROM x GROUP BY robot_id),
h AS (SELECT g.robot_id, samples, excluded, m, q, median(abs(x.peak - m)) AS mad FROM g JOIN x USING (robot_id) GROUP BY ALL), t AS (SELECT *, CASE WHEN samples >= 5 THEN greatest(q, m + 8.0 * 1.4826 * mad, 1e-12) END AS th FROM h)
SELECT robot_id, samples, excluded, CASE WHEN samples < 5 THEN 'insufficient_samples' ELSE 'ready' END AS status, round(m, 6) AS median, round(mad, 6) AS mad, round(th, 6) AS threshold, count(*) FILTER (WHERE x.peak > th) AS samples_beyond FROM t JOIN x USING (robot_id) GROUP BY ALL""",
    "task_summary": f"{_T}, c AS (SELECT task_index, episode_index, count(*) AS n FROM tr WHERE task_index IS NOT NULL GROUP BY ALL) SELECT task_index, count(*) AS episodes, CAST(sum(n) AS BIGINT) AS n_rows, min(n) AS shortest, max(n) AS longest, quantile_cont(n, 0.5)::DOUBLE AS median_length FROM c GROUP BY task_index",
    "language_check": f"""WITH {_LANG}, p AS (SELECT episode_index, count(*) AS samples, count(*) FILTER (WHERE valid) AS with_task, count(DISTINCT text) FILTER (WHERE valid) AS tasks, {", ".join(f"count(*) FILTER (WHERE issue = '{i}') AS {i}" for i in _ISSUES)}, count(*) FILTER (WHERE inconsistent) AS inconsistent_mapping FROM r4 GROUP BY episode_index),
o AS (SELECT DISTINCT episode_index, task_source, text, task_index, valid FROM r4), w AS (SELECT episode_index, count(*) FILTER (WHERE text IS NULL) AS null_task_text, count(*) FILTER (WHERE text IS NOT NULL AND NOT valid) AS empty_task_text,
CAST(coalesce(sum(CASE WHEN valid THEN (length(text) < 2)::INT + (length(text) > 4096)::INT + regexp_matches(text, '[\\p{{Cc}}\\p{{Cf}}]')::INT + regexp_matches(trim(text), '^\\p{{N}}+$')::INT + (lower(trim(text)) IN ('n/a', 'unknown', 'task'))::INT END), 0) AS BIGINT) AS warnings FROM o GROUP BY episode_index)
SELECT *, {" + ".join(_ISSUES)} + inconsistent_mapping + null_task_text + empty_task_text = 0 AND with_task > 0 AND tasks <= 1 AS passed FROM p JOIN w USING (episode_index)""",
    "language_summary": f"WITH {_LANG} SELECT text, count(DISTINCT episode_index) AS episodes, count(*) AS samples, max(length(text)) AS length FROM r4 WHERE valid GROUP BY text",
    "task_join": f"""{_T}, c AS (SELECT task_index AS k, count(*) AS n_texts FROM (SELECT DISTINCT task_index, task FROM tasks WHERE task_index IS NOT NULL) GROUP BY task_index)
SELECT CASE WHEN task_index IS NULL THEN 'missing_task_index' WHEN task_index < 0 THEN 'task_index_out_of_range' WHEN k IS NULL THEN 'unresolved_task_index' WHEN n_texts > 1 THEN 'ambiguous_task_index' ELSE 'resolved' END AS issue, count(*) AS n FROM tr LEFT JOIN c ON k = task_index GROUP BY 1""",
    "review_episodes": f"""{_T}, {_STEPS}, da AS (SELECT episode_index, global_index, pos, fps, ms, ma, {_all_ok("state")} AND {_all_ok("action")} AS ok, list_transform(list_zip(action, lag(action) OVER w), lambda z: z[1] - z[2]) AS d, is_first FROM s {_W}),
db AS (SELECT *, CASE WHEN is_first THEN NULL ELSE d END AS d0, lag(CASE WHEN is_first THEN NULL ELSE d END) OVER w AS pd, max(CASE WHEN is_first OR NOT ms <= 1e-3 THEN pos END) OVER (PARTITION BY episode_index ORDER BY global_index) AS brk FROM da {_W}),
e AS (SELECT episode_index, count(*) AS n, bool_and(ok) AS ok, max(fps) AS fps, count(*) FILTER (WHERE NOT is_first AND ms <= 1e-3) AS still, max(pos - brk) AS run, count(*) FILTER (WHERE NOT is_first AND ma > 0.5) AS jumps, max(CASE WHEN NOT is_first THEN ma END) AS top,
 count(*) FILTER (WHERE pd IS NOT NULL AND len(list_filter(list_zip(d0, pd), lambda z: z[1] * z[2] < 0 AND abs(z[1]) > 0.1 AND abs(z[2]) > 0.1)) > 0) AS jit, count(pd) AS pairs, list_sort(list(pos) FILTER (WHERE NOT is_first AND ma > 0.5))[1:20] AS pp FROM db GROUP BY episode_index),
f AS (SELECT *, n / fps AS seconds, run / fps AS ls, coalesce(jit / nullif(pairs, 0), 0) AS jf FROM e WHERE ok)
SELECT episode_index, n AS n_rows, round(seconds, 6) AS seconds, round(coalesce(still / nullif(n - 1, 0), 0), 6) AS static_fraction, round(ls, 6) AS longest_static_seconds, jumps AS action_jumps, round(coalesce(top, 0), 6) AS max_action_step, round(jf, 6) AS jitter_fraction, coalesce(array_to_string(pp, ','), '') AS jump_positions,
concat_ws(',', CASE WHEN ls >= 0.5 THEN 'long_static_state' END, CASE WHEN jumps > 0 THEN 'action_step_candidate' END, CASE WHEN jf > 0.25 THEN 'action_jitter_candidate' END, CASE WHEN NOT seconds BETWEEN 2.0 AND 120.0 THEN 'duration_candidate' END) AS flags FROM f""",
    "duplicate_episodes": f"""{_T}, h AS (SELECT episode_index, list({{'p': pos, 's': state, 'a': action}} ORDER BY pos) AS k, bool_and({_all_ok("state")} AND {_all_ok("action")}) AS ok FROM tr GROUP BY episode_index), m AS (SELECT episode_index, min(episode_index) OVER (PARTITION BY k) AS duplicate_of FROM h WHERE ok)
SELECT episode_index, duplicate_of FROM m WHERE duplicate_of < episode_index""",
    "policy_decisions": f"{_T}, {_FOUND} SELECT episode_index, path, reason, action FROM de",
    "policy_verdicts": f"{_T}, {_FOUND}, v AS (SELECT fo.episode_index, bool_or(de.action = 'reject_episode') AS r, bool_or(de.action = 'abort') AS a FROM (SELECT DISTINCT episode_index FROM fo) fo LEFT JOIN de USING (episode_index) GROUP BY ALL) SELECT episode_index, NOT coalesce(r, false) AND NOT coalesce(a, false) AS keep, coalesce(a, false) AS abort FROM v",
    "feature_mapping": f"{_T} SELECT global_index, round(0.0 + state[1] + state[2] + state[3] + action[8], 6) AS mapped_sum, state[7] AS picked FROM tr",
    "missing_episodes": "SELECT episode_index, 'no_frames' AS side FROM (SELECT DISTINCT episode_index FROM episodes EXCEPT SELECT DISTINCT episode_index FROM frames) UNION ALL SELECT episode_index, 'not_registered' FROM (SELECT DISTINCT episode_index FROM frames EXCEPT SELECT DISTINCT episode_index FROM episodes)",
    "task_table": f"WITH d AS (SELECT DISTINCT * FROM tasks), a AS (SELECT count(DISTINCT task_index) AS indices, min(task_index) AS first, max(task_index) AS last, count(*) FILTER (WHERE {_BAD.format('task')}) AS bad_texts FROM d) SELECT *, first = 0 AND last = indices - 1 AND bad_texts = 0 AS passed FROM a",
}

_PATHS = {
    "groups/arm/velocity": ("check_velocity", "peak"), "groups/arm/acceleration": ("check_acceleration", "peak"), "groups/arm/jerk": ("check_jerk", "peak"), "groups/arm/zscore": ("check_zscore", "max_zscore"),
    "groups/arm/velocity_zscore": ("check_velocity_zscore", "max_zscore"), "groups/arm/acceleration_zscore": ("check_acceleration_zscore", "max_zscore"), "groups/arm/static_ratio": ("check_static_ratio", "static_ratio"),
}
_GROUP = " UNION ALL ".join(f"SELECT episode_index, '{path}' AS path, passed, evaluated, {value} AS value FROM ({_CHECKS[name]})" for path, (name, value) in _PATHS.items())
_GROUP += f""" UNION ALL SELECT episode_index, 'episode_length', n >= 30, true, CAST(n AS DOUBLE) FROM ({_T} SELECT episode_index, count(*) AS n FROM tr GROUP BY episode_index)
UNION ALL SELECT episode_index, 'finite', n = 0, true, CAST(n AS DOUBLE) FROM ({_T} SELECT episode_index, count(*) FILTER (WHERE NOT ({_all_ok("state")} AND {_all_ok("action")} AND {_FIN})) AS n FROM tr GROUP BY episode_index)"""
_SAMPLED = ", ".join(f"'groups/arm/{m}'" for m in ("velocity", "acceleration", "jerk", "velocity_zscore", "acceleration_zscore"))

SQL |= {
    "group_findings": _GROUP,
    "rule_counters": f"SELECT path, count(*) AS runs, count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE evaluated AND NOT passed) AS failed, count(*) FILTER (WHERE NOT evaluated) AS not_evaluated FROM ({_GROUP}) GROUP BY path",
    "calibrate_groups": f"""WITH x AS (SELECT path, value AS peak FROM ({_GROUP}) WHERE path IN ({_SAMPLED})), g AS (SELECT path, count(peak) AS samples, count(*) - count(peak) AS excluded, median(peak) AS m, quantile_cont(peak, 0.995) AS q FROM x GROUP BY path),
h AS (SELECT g.path, samples, excluded, m, q, median(abs(x.peak - m)) AS mad FROM g JOIN x USING (path) GROUP BY ALL), t AS (SELECT *, CASE WHEN samples >= 20 THEN greatest(q, m + 8.0 * 1.4826 * mad, 1e-12) END AS th FROM h)
SELECT path, samples, excluded, CASE WHEN samples < 20 THEN 'insufficient_samples' ELSE 'ready' END AS status, round(m, 6) AS median, round(mad, 6) AS mad, round(th, 6) AS threshold, count(*) FILTER (WHERE x.peak > th) AS samples_beyond FROM t JOIN x USING (path) GROUP BY ALL""",
    "policy_summary": f"{_T}, {_FOUND} SELECT path, reason, action, count(*) AS episodes FROM de GROUP BY ALL",
    "transform_interpolate_rows": f"""{_T}, b AS (SELECT episode_index, global_index, pos, state[1] AS x, CASE WHEN isfinite(state[1]) THEN {{'t': pos, 'x': state[1]}} END AS g FROM tr),
c AS (SELECT *, last_value(g IGNORE NULLS) OVER (PARTITION BY episode_index ORDER BY global_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p, first_value(g IGNORE NULLS) OVER (PARTITION BY episode_index ORDER BY global_index ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS n FROM b)
SELECT global_index, round(CASE WHEN p IS NULL AND n IS NULL THEN 0.0 WHEN p IS NULL THEN n.x WHEN n IS NULL THEN p.x ELSE p.x + (n.x - p.x) * ((pos - p.t) / nullif(n.t - p.t, 0)) END, 6) AS filled FROM c WHERE isnan(x)""",
    "duplicates_planted": f"""{_T}, h AS (SELECT episode_index, list({{'p': pos, 's': state, 'a': action}} ORDER BY pos) AS k, bool_and({_all_ok("state")} AND {_all_ok("action")}) AS ok FROM tr GROUP BY episode_index), m AS (SELECT episode_index, min(episode_index) OVER (PARTITION BY k) AS duplicate_of FROM h WHERE ok)
SELECT episode_index, duplicate_of FROM m WHERE duplicate_of < episode_index UNION ALL SELECT episode_index + 100000000, duplicate_of FROM m""",
    "alias_sync": f"{_T} SELECT episode_index, CAST(sum(CAST(state[1] IS DISTINCT FROM action[1] AS INT) + CAST(state[2] IS DISTINCT FROM action[2] AS INT)) AS BIGINT) AS changed FROM tr GROUP BY episode_index",
    "chunk_values": f"""{_T}, l AS (SELECT global_index, list(action[1]) OVER (PARTITION BY episode_index ORDER BY global_index ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS l FROM tr), v AS (SELECT global_index, list_sum(l) + (8 - len(l)) * l[len(l)] AS total, 8 - len(l) AS padding FROM l)
SELECT global_index, round(CASE WHEN NOT isnan(total) THEN total END, 6) AS total, padding FROM v""",
    "failed_episodes": "WITH e AS (SELECT episode_index, min(is_episode_successful) AS successful FROM episodes WHERE episode_index IS NOT NULL GROUP BY episode_index) SELECT successful, count(*) AS episodes FROM (SELECT DISTINCT episode_index FROM frames) JOIN e USING (episode_index) GROUP BY successful",
    "strided_bounds": f"""{_T}, z AS (SELECT greatest(1, 20000 // count(DISTINCT episode_index)) AS per FROM tr), y AS (SELECT *, count(*) OVER (PARTITION BY episode_index) AS n FROM tr),
u AS (SELECT unnest(range(0, 8)) AS component, unnest(action) AS x FROM y, z WHERE pos % greatest(1, n // per + 1) = 0)
SELECT component, round(coalesce(quantile_cont(x, 0.01) FILTER (WHERE isfinite(x)), '-inf'::DOUBLE), 6) AS low, round(coalesce(quantile_cont(x, 0.99) FILTER (WHERE isfinite(x)), 'inf'::DOUBLE), 6) AS high FROM u GROUP BY component""",
    "check_nonfinite_rows": f"{_T} SELECT episode_index, 'state' AS \"column\", pos FROM tr WHERE NOT {_all_ok('state')} UNION ALL SELECT episode_index, 'action', pos FROM tr WHERE NOT {_all_ok('action')}",
    "check_velocity_periodic": f"""{_T}, q AS (SELECT *, t - lag(t) OVER w AS dt, lag(state) OVER w AS ps FROM tr {_W}),
p AS (SELECT *, CASE WHEN ps IS NOT NULL AND dt <> 0 THEN list_max(list_transform(list_zip(state, ps), lambda z: abs(((z[1] - z[2] + 0.25) - floor((z[1] - z[2] + 0.25) / 0.5) * 0.5 - 0.25) / dt))) END AS peak FROM q),
a AS (SELECT episode_index, count(*) AS n, bool_and({_FIN}) AND bool_and(coalesce(dt > 0, dt IS NULL)) AND bool_and({_all_ok("state")}) AS ok, max(peak) AS mx, count(*) FILTER (WHERE peak > 5.0) AS b FROM p GROUP BY episode_index),
v AS (SELECT *, n > 1 AND ok AND coalesce(isfinite(mx), false) AS ev FROM a)
SELECT episode_index, ev AS evaluated, round(CASE WHEN ev THEN mx END, 6) AS peak, CAST(CASE WHEN ev THEN b END AS DOUBLE) AS intervals_beyond, ev AND b = 0 AS passed FROM v""",
}
