"""Queries of the per-episode checks over frames and episodes, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionloom.functions.vectors import take
from motionloom.operators import checks
from motionloom.operators.trajectory import trajectory
from motionloom.sources.tables import table

LIMITS = ("joint_low", "joint_high")


def rows_of(spark: SparkSession, folder: str, columns: tuple[str, ...] = (), halo: int = 3) -> DataFrame:
    """The trajectory rows of the test tables."""
    t = lambda n: table(spark, folder, n)
    return trajectory(t("frames"), t("episodes"), t("robots"), t("quality_thresholds") if columns else None, columns, halo=halo)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles that engines may sum in another order, to six places."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _derivative(order: int, threshold: float):  # noqa: ANN202
    return lambda s, d: rounded(checks.derivative_check(rows_of(s, d), order, threshold), "peak")


def _zscore(order: int):  # noqa: ANN202
    return lambda s, d: rounded(checks.zscore_check(rows_of(s, d), order), "max_zscore")


THRESHOLDS = {1: 5.0, 2: 100.0, 3: 2000.0}

QUERIES = {
    "check_finite": lambda s, d: checks.finite_check(rows_of(s, d, halo=1)),
    "check_timestamp": lambda s, d: rounded(checks.timestamp_check(rows_of(s, d, halo=1)), "mean_step"),
    "check_clock_variation": lambda s, d: checks.clock_check(rows_of(s, d, halo=1)),
    "check_structure": lambda s, d: checks.structure_check(rows_of(s, d, halo=1), table(s, d, "episodes")),
    "check_length": lambda s, d: rounded(checks.length_check(rows_of(s, d, halo=0), min_frames=30, max_seconds=8.0), "seconds"),
    "check_velocity": _derivative(1, THRESHOLDS[1]),
    "check_acceleration": _derivative(2, THRESHOLDS[2]),
    "check_jerk": _derivative(3, THRESHOLDS[3]),
    "check_zscore": _zscore(0),
    "check_velocity_zscore": _zscore(1),
    "check_acceleration_zscore": _zscore(2),
    "check_joint_limits": lambda s, d: checks.limits_check(rows_of(s, d, LIMITS, 0)),
    "check_percentile_outlier": lambda s, d: checks.limits_check(rows_of(s, d, ("percentile_low", "percentile_high"), 0), "percentile_low", "percentile_high", "action"),
    "check_static_ratio": lambda s, d: rounded(checks.static_check(rows_of(s, d, halo=1), 1e-3, 0.2), "static_ratio"),
    "check_joint_static_ratio": lambda s, d: rounded(checks.joint_static_check(rows_of(s, d, halo=1), 0.01, 0.01, 0.5), "static_ratio"),
    "check_static_edges": lambda s, d: checks.static_edges(rows_of(s, d, halo=1)),
    "check_gripper": lambda s, d: checks.gripper_check(rows_of(s, d, halo=0)),
    "check_gripper_binary": lambda s, d: checks.gripper_check(rows_of(s, d, halo=0), mode="binary_01"),
    "check_alias": lambda s, d: checks.alias_check(rows_of(s, d, halo=0), take(F.col("state"), [0, 1]), take(F.col("action"), [0, 1])),
}

#: Counts that are null where a check was not evaluated; given as doubles, which every client shows alike.
COUNTS = {
    **{f"check_{n}": ("intervals_beyond",) for n in ("velocity", "acceleration", "jerk")},
    **{f"check_{n}": ("rows_beyond",) for n in ("zscore", "velocity_zscore", "acceleration_zscore")},
    **{f"check_{n}": ("violating_rows",) for n in ("joint_limits", "percentile_outlier", "gripper", "gripper_binary")},
    "check_static_ratio": ("static_transitions",),
    "check_joint_static_ratio": ("static_transitions", "state_static", "action_static"),
    "check_static_edges": ("trim_start", "trim_end", "static_rows"),
}


def with_double_counts(queries: dict, sql: dict, counts: dict) -> tuple[dict, dict]:
    """The queries and SQL with the named columns as doubles."""

    def cast(f, names):  # noqa: ANN001, ANN202
        return lambda s, d: (df := f(s, d)).withColumns({c: df[c].cast("double") for c in names})

    def recast(text: str, names: tuple[str, ...]) -> str:
        return f"SELECT * REPLACE ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in names)}) FROM ({text})"

    return {n: cast(f, counts[n]) if n in counts else f for n, f in queries.items()}, {n: recast(q, counts[n]) if n in counts else q for n, q in sql.items()}


#: Trajectory rows in SQL: frames of registered episodes, sent again rows dropped.
TRAJECTORY = """e0 AS (SELECT episode_index, min(robot_id) AS robot_id, min(fps) AS fps FROM episodes GROUP BY episode_index),
er AS (SELECT e0.episode_index, e0.robot_id, coalesce(e0.fps, r.fps) AS fps FROM e0 LEFT JOIN (SELECT robot_id, max(fps) AS fps FROM robots GROUP BY robot_id) r USING (robot_id)),
f0 AS (SELECT * FROM frames WHERE global_index IS NOT NULL QUALIFY row_number() OVER (PARTITION BY global_index ORDER BY received_at) = 1),
f1 AS (SELECT f0.*, er.robot_id, er.fps, min(global_index) OVER (PARTITION BY f0.episode_index) AS first_index FROM f0 JOIN er USING (episode_index)),
tr AS (SELECT episode_index, global_index, first_index, global_index - first_index AS pos, robot_id, fps, frame_index, task_index, received_at, t AS raw_t, coalesce(t, (global_index - first_index) / fps) AS t,
  CASE WHEN state IS NULL THEN list_transform(range(8), lambda x: 'nan'::DOUBLE) ELSE list_transform(state, lambda x: coalesce(x::DOUBLE, 'nan'::DOUBLE)) END AS state,
  CASE WHEN action IS NULL THEN list_transform(range(8), lambda x: 'nan'::DOUBLE) ELSE list_transform(action, lambda x: coalesce(x::DOUBLE, 'nan'::DOUBLE)) END AS action FROM f1)"""
_W = "WINDOW w AS (PARTITION BY episode_index ORDER BY global_index)"
_FIN = "(t IS NOT NULL AND isfinite(t))"


def _all_ok(c: str) -> str:
    return f"(len(list_filter({c}, lambda x: NOT isfinite(x))) = 0)"


def _move(a: str, b: str) -> str:
    return f"list_max(list_transform(list_zip({a}, {b}), lambda z: abs(z[1] - z[2])))"


def _derivative_ctes(order: int) -> str:
    out = f"d0 AS (SELECT episode_index, global_index, t, state, t - lag(t) OVER w AS dt, t AS m0, state AS x0 FROM tr {_W})"
    for k in range(1, order + 1):
        p = k - 1
        out += f""", q{k} AS (SELECT *, lag(x{p}) OVER w AS px, lag(m{p}) OVER w AS pm FROM d{p} {_W}),
d{k} AS (SELECT * EXCLUDE (px, pm), CASE WHEN x{p} IS NOT NULL AND px IS NOT NULL AND m{p} - pm <> 0 THEN list_transform(list_zip(x{p}, px), lambda z: (z[1] - z[2]) / (m{p} - pm)) END AS x{k}, (m{p} + pm) / 2 AS m{k} FROM q{k})"""
    return out


def _derivative_sql(order: int) -> str:
    return f"""WITH {TRAJECTORY}, {_derivative_ctes(order)},
p AS (SELECT *, list_max(list_transform(x{order}, lambda v: abs(v))) AS peak FROM d{order}),
a AS (SELECT episode_index, count(*) AS n, bool_and({_FIN}) AND bool_and(coalesce(dt > 0, dt IS NULL)) AND bool_and({_all_ok("state")}) AS ok, max(peak) AS mx, count(*) FILTER (WHERE peak > {THRESHOLDS[order]}) AS b FROM p GROUP BY episode_index),
v AS (SELECT *, n > {order} AND ok AND coalesce(isfinite(mx), false) AS ev FROM a)
SELECT episode_index, ev AS evaluated, round(CASE WHEN ev THEN mx END, 6) AS peak, CASE WHEN ev THEN b END AS intervals_beyond, ev AND b = 0 AS passed FROM v"""


def _zscore_sql(order: int) -> str:
    usable = f"bool_and({_all_ok('state')})" + (f" AND bool_and({_FIN}) AND bool_and(coalesce(dt > 0, dt IS NULL))" if order else "")
    least = "64 * 2.220446049250313e-16 * greatest(1.0, ax)" if order else "0"
    return f"""WITH {TRAJECTORY}, {_derivative_ctes(order)},
g AS (SELECT episode_index, count(*) AS n, {usable} AS ok FROM d{order} GROUP BY episode_index),
u AS (SELECT d.episode_index, d.global_index, unnest(range(0, 8)) AS c, unnest(d.x{order}) AS x FROM d{order} d JOIN g USING (episode_index) WHERE g.ok AND d.x{order} IS NOT NULL),
z AS (SELECT *, avg(x) OVER k AS mx, stddev_pop(x) OVER k AS sx, max(abs(x)) OVER k AS ax FROM u WINDOW k AS (PARTITION BY episode_index, c)),
r AS (SELECT episode_index, global_index, max(CASE WHEN sx > {least} THEN abs(x - mx) / sx ELSE 0 END) AS z FROM z GROUP BY ALL),
m AS (SELECT episode_index, max(z) AS mz, count(*) FILTER (WHERE z > 3.0) AS b FROM r GROUP BY episode_index),
v AS (SELECT g.episode_index, n > {order} AND ok AND mz IS NOT NULL AS ev, mz, b FROM g LEFT JOIN m USING (episode_index))
SELECT episode_index, ev AS evaluated, round(CASE WHEN ev THEN mz END, 6) AS max_zscore, CASE WHEN ev THEN b END AS rows_beyond, ev AND b = 0 AS passed FROM v"""


def _limits_sql(low: str, high: str, source: str) -> str:
    return f"""WITH {TRAJECTORY}, l AS (SELECT tr.episode_index, tr.{source} AS x, q.{low} AS lo, q.{high} AS hi FROM tr JOIN quality_thresholds q USING (robot_id)),
a AS (SELECT episode_index, bool_or(lo IS NOT NULL AND hi IS NOT NULL) AS ev, count(*) FILTER (WHERE lo IS NOT NULL AND len(list_filter(list_zip(x, lo, hi), lambda z: isfinite(z[1]) AND (z[1] < z[2] OR z[1] > z[3]))) > 0) AS n FROM l GROUP BY episode_index)
SELECT episode_index, ev AS evaluated, CASE WHEN ev THEN n END AS violating_rows, ev AND n = 0 AS passed FROM a"""


def _gripper_sql(valid: str) -> str:
    return f"""WITH {TRAJECTORY}, a AS (SELECT episode_index, bool_and(isfinite(state[8])) AS ev, count(*) FILTER (WHERE NOT ({valid})) AS n FROM tr GROUP BY episode_index)
SELECT episode_index, ev AS evaluated, CASE WHEN ev THEN n END AS violating_rows, ev AND n = 0 AS passed FROM a"""


_STEPS = f"""s AS (SELECT *, t - lag(t) OVER w AS dt, {_move("state", "lag(state) OVER w")} AS ms, {_move("action", "lag(action) OVER w")} AS ma, lag(state) OVER w IS NULL AS is_first,
  lag(global_index) OVER w AS pg, lag(frame_index) OVER w AS pf FROM tr {_W})"""

SQL = {
    "check_finite": f"""WITH {TRAJECTORY}, a AS (SELECT episode_index, count(*) FILTER (WHERE len(list_filter(state, lambda x: isnan(x))) > 0) AS state_nan_rows, count(*) FILTER (WHERE len(list_filter(state, lambda x: isinf(x))) > 0) AS state_inf_rows,
count(*) FILTER (WHERE len(list_filter(action, lambda x: isnan(x))) > 0) AS action_nan_rows, count(*) FILTER (WHERE len(list_filter(action, lambda x: isinf(x))) > 0) AS action_inf_rows, count(*) FILTER (WHERE NOT {_FIN}) AS bad_times FROM tr GROUP BY episode_index)
SELECT *, state_nan_rows + state_inf_rows + action_nan_rows + action_inf_rows + bad_times = 0 AS passed FROM a""",
    "check_timestamp": f"""WITH {TRAJECTORY}, {_STEPS},
a AS (SELECT episode_index, count(*) AS n_rows, bool_and({_FIN}) AS finite, bool_and(coalesce(dt > 0, dt IS NULL)) AS increasing, bool_and(coalesce(abs(dt - 1.0 / fps) <= (1.0 / fps) * 0.2, dt IS NULL)) AS uniform,
 bool_or(abs(t) <= (1.0 / fps) * 0.2) FILTER (WHERE pos = 0) AS start_ok, max(fps) AS fps, (max(t) - min(t)) / nullif(count(*) - 1, 0) AS m FROM s GROUP BY episode_index)
SELECT episode_index, n_rows, finite, increasing, uniform, start_ok, round(CASE WHEN finite AND increasing AND n_rows > 1 THEN m END, 6) AS mean_step,
 finite AND increasing AND (n_rows < 2 OR coalesce(abs(m - 1 / fps) <= 0.2 / fps, false)) AND coalesce(start_ok, false) AND uniform AS passed FROM a""",
    "check_clock_variation": f"""WITH {TRAJECTORY}, {_STEPS}, a AS (SELECT episode_index, count(dt) AS steps, bool_and(coalesce(dt > 0, dt IS NULL)) AS increasing, avg(dt) AS m, stddev_pop(dt) AS s, max(fps) AS fps FROM s GROUP BY episode_index)
SELECT episode_index, steps, increasing, round(m, 6) AS mean_step, round(s / nullif(m, 0), 6) AS variation, coalesce(increasing AND abs(m * fps - 1) <= 0.2 AND s / nullif(m, 0) <= 0.25, false) AS passed FROM a""",
    "check_structure": f"""WITH {TRAJECTORY}, {_STEPS},
m AS (SELECT episode_index, min({{'a': length, 'b': dataset_from_index, 'c': dataset_to_index}}) AS m FROM episodes GROUP BY episode_index),
a AS (SELECT episode_index, count(*) AS n, bool_and(coalesce(CASE WHEN pg IS NULL THEN frame_index = 0 ELSE frame_index = pf + 1 END, false)) AS fr, bool_and(pg IS NULL OR global_index = pg + 1) AS gl, min(first_index) AS f FROM s GROUP BY episode_index)
SELECT a.episode_index, n AS n_rows, NOT fr AS frame_gap, NOT gl AS index_gap, coalesce(m.b IS NOT NULL AND (NOT gl OR m.b <> f), false) AS start_differs, coalesce(m.a <> n, false) AS length_differs, coalesce(m.c - m.b <> n, false) AS span_differs,
 fr AND gl AND coalesce(m.b = f, true) AND coalesce(m.a = n, true) AND coalesce(m.c - m.b = n, true) AS passed
FROM a LEFT JOIN (SELECT episode_index, m.a, m.b, m.c FROM m) m USING (episode_index)""",
    "check_length": f"WITH {TRAJECTORY}, a AS (SELECT episode_index, count(*) AS n_rows, count(*) / max(fps) AS s FROM tr GROUP BY episode_index) SELECT episode_index, n_rows, round(s, 6) AS seconds, coalesce(n_rows >= 30 AND s <= 8.0, false) AS passed FROM a",
    "check_velocity": _derivative_sql(1),
    "check_acceleration": _derivative_sql(2),
    "check_jerk": _derivative_sql(3),
    "check_zscore": _zscore_sql(0),
    "check_velocity_zscore": _zscore_sql(1),
    "check_acceleration_zscore": _zscore_sql(2),
    "check_joint_limits": _limits_sql("joint_low", "joint_high", "state"),
    "check_percentile_outlier": _limits_sql("percentile_low", "percentile_high", "action"),
    "check_static_ratio": f"""WITH {TRAJECTORY}, {_STEPS}, a AS (SELECT episode_index, count(*) AS n, count(*) FILTER (WHERE ms <= 1e-3 AND NOT is_first) AS b, bool_and({_all_ok("state")}) AS ok FROM s GROUP BY episode_index),
v AS (SELECT *, n > 1 AND ok AS ev, CASE WHEN n > 1 AND ok THEN b / (n - 1) END AS r FROM a) SELECT episode_index, ev AS evaluated, CASE WHEN ev THEN b END AS static_transitions, round(r, 6) AS static_ratio, ev AND coalesce(r <= 0.2, false) AS passed FROM v""",
    "check_joint_static_ratio": f"""WITH {TRAJECTORY}, {_STEPS}, a AS (SELECT episode_index, count(*) AS n, count(*) FILTER (WHERE ms < 0.01 AND ma < 0.01) AS b, count(*) FILTER (WHERE ms < 0.01) AS st, count(*) FILTER (WHERE ma < 0.01) AS ac, bool_and({_all_ok("state")} AND {_all_ok("action")}) AS ok FROM s GROUP BY episode_index),
v AS (SELECT *, n > 1 AND ok AS ev, CASE WHEN n > 1 AND ok THEN b / (n - 1) END AS r FROM a)
SELECT episode_index, ev AS evaluated, CASE WHEN ev THEN b END AS static_transitions, CASE WHEN ev THEN st END AS state_static, CASE WHEN ev THEN ac END AS action_static, round(r, 6) AS static_ratio, ev AND coalesce(r <= 0.5, false) AS passed FROM v""",
    "check_static_edges": f"""WITH {TRAJECTORY}, {_STEPS},
a AS (SELECT episode_index, count(*) AS n, bool_and({_all_ok("action")}) AS ev, min(pos - 1) FILTER (WHERE ma >= 0.002) AS a, max(pos + 1) FILTER (WHERE ma >= 0.002) AS b, count(*) FILTER (WHERE ma < 0.002) AS still FROM s GROUP BY episode_index),
v AS (SELECT *, coalesce(a, 0) AS st, coalesce(b, n) AS sp, a IS NOT NULL AS moves FROM a), t AS (SELECT *, moves AND sp - st >= 2 AND (st > 0 OR sp < n) AS trim FROM v)
SELECT episode_index, ev AS evaluated, ev AND NOT moves AS all_static, ev AND trim AS should_trim, CASE WHEN ev THEN st END AS trim_start, CASE WHEN ev THEN sp END AS trim_end, CASE WHEN ev THEN still END AS static_rows, ev AND moves AND NOT trim AS passed FROM t""",
    "check_gripper": _gripper_sql("state[8] >= 0.0 - 1e-6 AND state[8] <= 1.0 + 1e-6"),
    "check_gripper_binary": _gripper_sql("abs(state[8] - 0.0) <= 1e-6 OR abs(state[8] - 1.0) <= 1e-6"),
    "check_alias": f"""WITH {TRAJECTORY}, a AS (SELECT episode_index, count(*) FILTER (WHERE len(list_filter(list_zip(state[1:2], action[1:2]), lambda z: NOT coalesce((isnan(z[1]) AND isnan(z[2])) OR abs(z[1] - z[2]) <= 1e-8 + 1e-5 * abs(z[2]), false))) > 0) AS mismatching_rows FROM tr GROUP BY episode_index)
SELECT *, mismatching_rows = 0 AS passed FROM a""",
}

QUERIES, SQL = with_double_counts(QUERIES, SQL, COUNTS)
