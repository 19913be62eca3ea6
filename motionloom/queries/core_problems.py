"""Queries of the general problems 1, 3, 5 and 6 over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionloom.operators.episodes import chunk_table, episode_settings
from motionloom.operators import orphans
from motionloom.operators.regular_grid import regular_grid
from motionloom.operators.spikes import implausible_readings
from motionloom.operators.units import CONTROL_QUANTITY, SPELLINGS, UNITS, common_units
from motionloom.session import checkpointed
from motionloom.sources.tables import table

STATE_WIDTH = 8
JOINTS = 7


def p1_grid(spark: SparkSession, folder: str) -> DataFrame:
    """The regular series of every episode whose robot asks for a uniform clock, one column per component of the state."""
    series = [F.round(F.get("series", F.lit(i)), 6).alias(f"v{i}") for i in range(STATE_WIDTH)]
    return _p1_cells(spark, folder, STATE_WIDTH).select("episode_index", "slot", "n_readings", F.round("coverage", 6).alias("coverage"), "status", *series)


def _p1_cells(spark: SparkSession, folder: str, width: int) -> DataFrame:
    settings = episode_settings(table(spark, folder, "episodes"), table(spark, folder, "robots"), table(spark, folder, "quality_thresholds"), ("require_uniform_dt",))
    return regular_grid(table(spark, folder, "frames"), settings.where("require_uniform_dt"), width=width)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """The cells that no reading fills."""
    return _p1_cells(spark, folder, 0).where(F.col("n_readings") == 0).select("episode_index", "slot")


def p1_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Per episode: cells, observed cells, readings and the mean covered fraction."""
    g = _p1_cells(spark, folder, 0)
    return g.groupBy("episode_index").agg(
        F.count(F.lit(1)).alias("n_slots"),
        F.sum((F.col("n_readings") > 0).cast("long")).alias("n_observed"),
        F.sum("n_readings").alias("n_readings"),
        F.round(F.avg("coverage"), 6).alias("coverage"),
    )


def p3_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Every implausible reading with its score and reason."""
    frames = table(spark, folder, "frames")
    settings = episode_settings(table(spark, folder, "episodes"), None, table(spark, folder, "quality_thresholds"), ("joint_low", "joint_high"))
    return implausible_readings(frames, chunk_table(frames, settings), STATE_WIDTH, JOINTS)


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """The implausible readings by row, field and component."""
    return p3_flags(spark, folder).select(F.col("record_id").alias("global_index"), "field", "component").distinct()


def _p5_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """References, targets and, over the stored rows, the number of references of each key."""
    f, info = table(spark, folder, "frames"), table(spark, folder, "task_info")
    fields = ("task_index", "episode_index")
    once = f.groupBy("global_index").agg(F.min("received_at").alias("at"), *[F.min_by(c, "received_at").alias(c) for c in fields])
    refs = orphans.references(once, "frames", "global_index", fields, "at").unionByName(orphans.references(info.distinct(), "task_info", "info_id", fields, "noted_at"))
    targets = orphans.parents(table(spark, folder, "tasks"), "task_index", "created_at", "deleted_at").unionByName(orphans.parents(table(spark, folder, "episodes"), "episode_index", "registered_at", "withdrawn_at"))
    stored = orphans.references(f, "frames", "global_index", fields, "received_at").unionByName(orphans.references(info, "task_info", "info_id", fields, "noted_at"))
    return refs, targets, orphans.key_sizes(stored)


def _p5_state(spark: SparkSession, folder: str) -> orphans.OrphanState:
    return orphans.advance(None, *_p5_tables(spark, folder))


def p5_advanced(spark: SparkSession, folder: str) -> DataFrame:
    """The orphans after two batches: what is known by the middle of the time, then the rest; the same as in one."""
    refs, targets, _ = _p5_tables(spark, folder)
    span = refs.agg(F.min("at").alias("a"), F.max("at").alias("b")).first()
    middle = F.lit(span["a"] + (span["b"] - span["a"]) / 2 if span["a"] else None).cast("timestamp")
    early = lambda c: F.coalesce(F.col(c) < middle, F.lit(True))
    first = orphans.advance(None, refs.where(early("at")), targets.where(early("begins")))
    first = orphans.OrphanState(*[checkpointed(x) for x in (first.targets, first.refs, first.pending)])
    return orphans.advance(first, refs.where(~early("at")), targets.where(~early("begins"))).pending.select("ref_table", "ref_field", "record_id", "kind", "resolved_at")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Orphan references of frames and task_info."""
    return _p5_state(spark, folder).pending.select("ref_table", "ref_field", "record_id", "kind")


def p5_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Orphans per table, field and month."""
    s = orphans.snapshots(_p5_state(spark, folder).pending)
    return s.withColumn("month", F.date_format("month", "yyyy-MM"))


def p6_units(spark: SparkSession, folder: str) -> DataFrame:
    """Every sensor reading with its unit and its value in the common unit."""
    out = common_units(table(spark, folder, "sensor_readings"), table(spark, folder, "physical_semantics"))
    return out.withColumns({"number": F.round("number", 10), "common_value": F.round("common_value", 10)})


def p6_masked(spark: SparkSession, folder: str) -> DataFrame:
    """How well the level alone tells the unit: an eighth of the readings is stripped of all statements and decoded, and compared with what was stated."""
    readings, semantics = table(spark, folder, "sensor_readings"), table(spark, folder, "physical_semantics")
    hidden = F.pmod(F.xxhash64("reading_id"), F.lit(8)) == 0
    bare = {"unit": F.when(~hidden, F.col("unit")), "note": F.when(~hidden, F.col("note")), "value_text": F.when(hidden, F.regexp_extract("value_text", r"[-+−]?\d[\d.,]*", 0)).otherwise(F.col("value_text"))}
    decoded = common_units(readings.withColumns(bare), semantics.where(F.lit(False)))
    truth = common_units(readings, semantics).select("reading_id", F.col("unit").alias("recorded"))
    both = decoded.where((F.col("stated_by") == "level") & hidden & (F.col("common_value") != 0)).select("reading_id", "quantity", "unit").join(truth, "reading_id")
    return both.groupBy("quantity", "recorded").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("unit") == F.col("recorded")).alias("right"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Readings with a number that were recorded in another than the common unit."""
    common = [next(iter(codes)) for codes in UNITS.values()]
    return p6_units(spark, folder).where(F.col("number").isNotNull() & ~F.col("unit").isin(common)).select("reading_id", "unit").distinct()


QUERIES = {"p1_found": p1_found, "p1_grid": p1_grid, "p1_coverage": p1_coverage, "p3_found": p3_found, "p3_flags": p3_flags, "p5_found": p5_found, "p5_snapshots": p5_snapshots, "p5_advanced": p5_advanced, "p6_found": p6_found, "p6_units": p6_units, "p6_masked": p6_masked}

_DEDUP = """
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY global_index ORDER BY received_at) AS _rn FROM frames) WHERE _rn = 1),
e AS (SELECT episode_index, min(robot_id) AS robot_id, min(fps) AS fps FROM episodes GROUP BY episode_index),
er AS (SELECT e.episode_index, e.robot_id, coalesce(e.fps, r.fps) AS fps FROM e LEFT JOIN (SELECT robot_id, max(fps) AS fps FROM robots GROUP BY robot_id) r USING (robot_id))
"""

_P1 = f"""WITH {_DEDUP},
u AS (SELECT er.* FROM er JOIN (SELECT DISTINCT robot_id FROM quality_thresholds WHERE require_uniform_dt) q USING (robot_id)),
b AS (SELECT f.episode_index, f.global_index, f.t, u.fps, min(f.t) OVER (PARTITION BY f.episode_index) AS t0 FROM f JOIN u USING (episode_index) WHERE f.t IS NOT NULL AND isfinite(f.t)),
s AS (SELECT episode_index, CAST(round_even((t - t0) * fps, 0) AS BIGINT) AS slot, count(*) AS n FROM b GROUP BY ALL),
g AS (SELECT episode_index, unnest(range(0, max(slot) + 1)) AS slot FROM s GROUP BY episode_index),
c AS (SELECT g.episode_index, g.slot, coalesce(s.n, 0) AS n_readings FROM g LEFT JOIN s USING (episode_index, slot))
"""

_WEIGHED = [f"round(sum(wt * x{i}) FILTER (WHERE wt > 0 AND isfinite(x{i})) / sum(wt) FILTER (WHERE wt > 0 AND isfinite(x{i})), 6) AS v{i}" for i in range(STATE_WIDTH)]
_P1_CELLS = f"""WITH {_DEDUP},
u AS (SELECT er.* FROM er JOIN (SELECT DISTINCT robot_id FROM quality_thresholds WHERE require_uniform_dt) q USING (robot_id)),
b AS (SELECT f.episode_index, f.global_index, f.state, (f.t - min(f.t) OVER (PARTITION BY f.episode_index)) * u.fps AS tau FROM f JOIN u USING (episode_index) WHERE f.t IS NOT NULL AND isfinite(f.t)),
i AS (SELECT *, CAST(round_even(tau, 0) AS BIGINT) AS own, CAST(round_even(max(tau) OVER (PARTITION BY episode_index), 0) AS BIGINT) AS final,
  least(coalesce(lead(tau) OVER (PARTITION BY episode_index ORDER BY tau, global_index), tau + 2), tau + 2) AS til FROM b),
c AS (SELECT episode_index, tau, til, own, state, unnest(range(own, greatest(own, least(final, CAST(ceil(til - 0.5) AS BIGINT))) + 1)) AS slot FROM i),
w AS (SELECT *, greatest(least(til, slot + 0.5) - greatest(tau, slot - 0.5), 0) AS wt, {", ".join(f"CAST(state[{i + 1}] AS DOUBLE) AS x{i}" for i in range(STATE_WIDTH))} FROM c),
s AS (SELECT episode_index, slot, count(*) FILTER (WHERE own = slot) AS n, least(sum(wt), 1.0) AS cover, {", ".join(_WEIGHED)} FROM w GROUP BY ALL),
g AS (SELECT episode_index, unnest(range(0, max(final) + 1)) AS slot FROM i GROUP BY episode_index),
k AS (SELECT g.episode_index, g.slot, coalesce(s.n, 0) AS n_readings, coalesce(s.cover, 0.0) AS cover, {", ".join(f"s.v{i}" for i in range(STATE_WIDTH))} FROM g LEFT JOIN s USING (episode_index, slot))
"""

_P5 = """WITH fr AS (SELECT DISTINCT global_index, received_at AS ts, task_index, episode_index FROM frames QUALIFY row_number() OVER (PARTITION BY global_index ORDER BY received_at) = 1),
ti AS (SELECT DISTINCT * FROM task_info),
r AS (SELECT 'frames' AS ref_table, 'task_index' AS ref_field, task_index AS key, global_index AS record_id, ts FROM fr
  UNION ALL SELECT 'frames', 'episode_index', episode_index, global_index, ts FROM fr
  UNION ALL SELECT 'task_info', 'task_index', task_index, info_id, noted_at FROM ti
  UNION ALL SELECT 'task_info', 'episode_index', episode_index, info_id, noted_at FROM ti),
p AS (SELECT DISTINCT 'task_index' AS ref_field, task_index AS key, created_at AS b, deleted_at AS d FROM tasks
  UNION SELECT DISTINCT 'episode_index', episode_index, registered_at, withdrawn_at FROM episodes),
j AS (SELECT r.ref_table, r.ref_field, r.key, r.record_id, r.ts, count(p.key) AS known,
  count(*) FILTER (WHERE p.b <= r.ts AND (p.d IS NULL OR p.d > r.ts)) AS live, count(*) FILTER (WHERE p.d <= r.ts) AS ended, min(p.b) FILTER (WHERE p.b > r.ts) AS resolved_at
  FROM r LEFT JOIN p ON p.ref_field = r.ref_field AND p.key = r.key WHERE r.key IS NOT NULL AND r.ts IS NOT NULL GROUP BY ALL),
o AS (SELECT *, CASE WHEN known = 0 THEN 'missing' WHEN ended > 0 THEN 'deleted' ELSE 'late' END AS kind FROM j WHERE live = 0)
"""

def _ahead(k: int) -> str:
    return f"lead(x, {k}) OVER w" if k > 0 else "x" if k == 0 else f"lag(x, {-k}) OVER w"


def _leaves(rows: int) -> str:
    """Whether a departure of some rows begins at this row: away from the course by far more than the normal step, and resumed."""
    away = ", ".join(f"abs(x{k} - (xb + (x{rows} - xb) * {k + 1} / {rows + 1}.0))" for k in range(rows))
    return f"least({away}) > 5 * scale AND abs(x{rows} - xb) < 0.5 * least({away})"


_P3 = f"""WITH {_DEDUP.split("er AS")[0].rstrip().rstrip(",")},
q AS (SELECT robot_id, min(joint_low) AS lo, min(joint_high) AS hi FROM quality_thresholds GROUP BY robot_id),
c AS (SELECT unnest(range(0, 8)) AS component), s AS (SELECT unnest(['state', 'action']) AS field),
v AS (SELECT f.global_index, f.episode_index, e.robot_id, s.field, c.component, CAST(CASE s.field WHEN 'state' THEN f.state ELSE f.action END[c.component + 1] AS DOUBLE) AS x, q.lo[c.component + 1] AS lo, q.hi[c.component + 1] AS hi
  FROM f JOIN e USING (episode_index) JOIN q USING (robot_id), c, s),
b AS (SELECT *, x IS NULL OR isnan(x) AS absent, coalesce(NOT isnan(x) AND (isinf(x) OR x < lo OR x > hi), false) AS beyond FROM v),
o AS (SELECT *, {", ".join(f"{_ahead(k)} AS x{'b' if k < 0 else k}" for k in (-1, 0, 1, 2, 3))} FROM b WHERE NOT absent AND NOT beyond AND component < 7 WINDOW w AS (PARTITION BY episode_index, field, component ORDER BY global_index)),
m AS (SELECT robot_id, field, component, quantile_cont(abs(x - xb), 0.9) AS scale FROM o WHERE xb IS NOT NULL AND x <> xb GROUP BY ALL),
h AS (SELECT o.*, {", ".join(f"coalesce({_leaves(k)}, false) AS h{k}" for k in (1, 2, 3))} FROM o JOIN m USING (robot_id, field, component)),
spikes AS (SELECT global_index, field, component, h1 OR h2 OR h3 OR coalesce(lag(h2 OR h3) OVER w, false) OR coalesce(lag(h3, 2) OVER w, false) AS hit FROM h WINDOW w AS (PARTITION BY episode_index, field, component ORDER BY global_index)),
z AS (SELECT *, CASE WHEN absent OR lag(absent) OVER w OR x <> lag(x) OVER w THEN 1 ELSE 0 END AS brk FROM b WHERE field = 'state' AND component < 7 WINDOW w AS (PARTITION BY episode_index, component ORDER BY global_index)),
y AS (SELECT *, sum(brk) OVER (PARTITION BY episode_index, component ORDER BY global_index) AS run FROM z),
frozen AS (SELECT *, count(*) OVER (PARTITION BY episode_index, component, run) AS n, row_number() OVER (PARTITION BY episode_index, component, run ORDER BY global_index) AS k FROM y)
"""
_P3_FOUND = """SELECT global_index, field, component FROM b WHERE beyond
UNION SELECT global_index, field, component FROM spikes WHERE hit
UNION SELECT global_index, field, component FROM frozen WHERE n >= 8 AND k > 1 AND NOT absent"""

_SPELT = ", ".join(f"('{s}', '{code}', '{q}')" for q, codes in UNITS.items() for code in codes for s in SPELLINGS[code])
_CONTROL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CONTROL_QUANTITY.items())
_QUANTITY = f"coalesce(representation, CASE control_type {_CONTROL} ELSE control_type END)"
_PLAIN = "rtrim(regexp_replace(lower(coalesce({}, '')), '[\\s·*]', '', 'g'), '.')"
_FACTOR = "CASE unit " + " ".join(f"WHEN '{c}' THEN {f!r}" for codes in UNITS.values() for c, f in codes.items()) + " END"
_P6_UNITS = f""", n AS (SELECT *, CASE WHEN value IS NOT NULL AND isfinite(value) THEN value ELSE CAST(CASE WHEN t LIKE '%,%' AND strpos(reverse(t), ',') < strpos(reverse('.' || t), '.') THEN replace(replace(t, '.', ''), ',', '.') ELSE replace(t, ',', '') END AS DOUBLE) END AS x
  FROM (SELECT *, nullif(rtrim(replace(regexp_extract(value_text, '[-+−]?[0-9][0-9.,]*', 0), '−', '-'), '.,'), '') AS t FROM u))
SELECT reading_id, robot_id, quantity, unit, stated_by, CAST(NULL AS VARCHAR) AS overruled, round(x, 10) AS number, round(x * ({_FACTOR}), 10) AS common_value FROM n WHERE quantity IN ({", ".join(f"'{q}'" for q in UNITS)})"""
_P6 = f"""WITH spelt(s, code, quantity) AS (VALUES {_SPELT}),
r AS (SELECT *, {_QUANTITY} AS quantity FROM (SELECT DISTINCT * FROM sensor_readings)),
d AS (SELECT robot_id, {_QUANTITY} AS quantity, min(unit) AS declared FROM physical_semantics WHERE modality = 'sensor' GROUP BY ALL),
x AS (SELECT r.*, d.declared, regexp_extract(note, '^(?:.*[^a-zA-Z])?(?:logged in|sensor card prints|valores en|raw channel is|all numbers|value given in|Werte in|unit:|operator confirms) +(.+?)(?: here|[)]|, not .*)?$', 1) AS n,
  regexp_extract(value_text, '[0-9][.,0-9]* *([^0-9]?.*)$', 1) AS vt,
  (value IS NOT NULL AND isfinite(value)) OR regexp_matches(value_text, '[0-9]') AS has_number FROM r LEFT JOIN d USING (robot_id, quantity)),
u AS (SELECT x.reading_id, x.robot_id, x.has_number, x.quantity, x.value, x.value_text, coalesce(a.code, b.code, c.code, e.code) AS unit,
  CASE WHEN a.code IS NOT NULL THEN 'note' WHEN b.code IS NOT NULL THEN 'value_text' WHEN c.code IS NOT NULL THEN 'unit' WHEN e.code IS NOT NULL THEN 'declaration' ELSE 'level' END AS stated_by FROM x
  LEFT JOIN spelt a ON a.quantity = x.quantity AND a.s = {_PLAIN.format("n")}
  LEFT JOIN spelt b ON b.quantity = x.quantity AND b.s = {_PLAIN.format("vt")}
  LEFT JOIN spelt c ON c.quantity = x.quantity AND c.s = {_PLAIN.format("unit")}
  LEFT JOIN spelt e ON e.quantity = x.quantity AND e.s = {_PLAIN.format("declared")})
"""

SQL = {
    "p3_found": _P3 + _P3_FOUND,
    "p6_units": _P6 + _P6_UNITS,
    "p6_found": _P6 + "SELECT DISTINCT reading_id, unit FROM u WHERE has_number AND unit NOT IN ('rad', 'rad/s', 'Nm', 'm', 'dimensionless')",
    "p5_found": _P5 + "SELECT ref_table, ref_field, record_id, kind FROM o",
    "p5_advanced": _P5 + "SELECT ref_table, ref_field, record_id, kind, resolved_at FROM o",
    "p5_snapshots": _P5 + """, ev AS (SELECT ref_table, ref_field, strftime(ts, '%Y-%m') AS month, kind, 1 AS n, 0 AS r FROM o
  UNION ALL SELECT ref_table, ref_field, strftime(resolved_at, '%Y-%m'), kind, 0, 1 FROM o WHERE resolved_at IS NOT NULL),
a AS (SELECT ref_table, ref_field, month, CAST(coalesce(sum(n) FILTER (WHERE kind = 'missing'), 0) AS BIGINT) AS missing, CAST(coalesce(sum(n) FILTER (WHERE kind = 'deleted'), 0) AS BIGINT) AS deleted,
  CAST(coalesce(sum(n) FILTER (WHERE kind = 'late'), 0) AS BIGINT) AS late, CAST(sum(r) AS BIGINT) AS resolved FROM ev GROUP BY ALL)
SELECT *, CAST(sum(missing + deleted + late - resolved) OVER (PARTITION BY ref_table, ref_field ORDER BY month) AS BIGINT) AS pending FROM a""",
    "p1_found": _P1 + "SELECT episode_index, slot FROM c WHERE n_readings = 0",
    "p1_grid": _P1_CELLS + f"SELECT episode_index, slot, n_readings, round(cover, 6) AS coverage, CASE WHEN n_readings > 0 THEN 'observed' WHEN cover > 0 THEN 'held' ELSE 'missing' END AS status, {', '.join(f'v{i}' for i in range(STATE_WIDTH))} FROM k",
    "p1_coverage": _P1_CELLS + "SELECT episode_index, count(*) AS n_slots, count(*) FILTER (WHERE n_readings > 0) AS n_observed, CAST(sum(n_readings) AS BIGINT) AS n_readings, round(avg(cover), 6) AS coverage FROM k GROUP BY episode_index",
}
