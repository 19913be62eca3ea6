"""Read-only checks per episode with three outcomes: passed, failed, not evaluated (Q1-Q13, Q19, Q23).

Each check adds columns to the trajectory rows and names aggregates over an episode; aggregates combine partially
before the shuffle by episode. Missing or non-finite input never passes silently: ``evaluated`` is then false.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionloom.functions.vectors import INF, all_finite, close, difference, is_finite, largest, outside
from motionloom.operators.trajectory import before, own

EPISODE = "episode_index"
#: Variation up to this share of the largest value counts as none.
RESIDUE = 64 * 2.220446049250313e-16


def _n(c: Column) -> Column:
    return F.sum(F.when(c, 1).otherwise(0))


def _every(c: Column) -> Column:
    return F.min(F.coalesce(c, F.lit(False)))


def finite_check(rows: DataFrame) -> DataFrame:
    """Rows with NaN and with infinite components, and times that are not finite (Q1)."""
    nan = lambda c: F.exists(c, lambda x: F.isnan(x))
    inf = lambda c: F.exists(c, lambda x: F.abs(x) == INF)
    counts = {f"{s}_{k}_rows": _n(f(F.col(s))) for s in ("state", "action") for k, f in (("nan", nan), ("inf", inf))}
    out = own(rows).groupBy(EPISODE).agg(*[v.alias(k) for k, v in counts.items()], _n(~is_finite(F.col("t"))).alias("bad_times"))
    total = sum((F.col(k) for k in counts), F.col("bad_times"))
    return out.withColumn("passed", total == 0)


def timestamp_check(rows: DataFrame, tolerance: float = 0.2, uniform: bool = True, zero_start: bool = True) -> DataFrame:
    """Finite, increasing, mean and single steps near ``1 / fps``, start near zero (Q2, C4)."""
    r = own(rows.withColumn("_dt", F.col("t") - before("t")))
    period = F.lit(1.0) / F.col("fps")
    slack = period * tolerance
    steps = F.col("_dt").isNull() | (F.abs(F.col("_dt") - period) <= slack)
    out = r.groupBy(EPISODE).agg(
        F.count(F.lit(1)).alias("n_rows"), _every(is_finite(F.col("t"))).alias("finite"), _every(F.col("_dt").isNull() | (F.col("_dt") > 0)).alias("increasing"), _every(steps).alias("uniform"),
        F.max(F.when(F.col("pos") == 0, F.abs(F.col("t")) <= slack)).alias("start_ok"), F.max("fps").alias("_fps"), F.min("t").alias("_a"), F.max("t").alias("_b"),
    )
    mean = (F.col("_b") - F.col("_a")) / (F.col("n_rows") - 1)
    mean_ok = F.when(F.col("n_rows") < 2, F.lit(True)).otherwise(F.coalesce(F.abs(mean - 1 / F.col("_fps")) <= tolerance / F.col("_fps"), F.lit(False)))
    out = out.withColumn("mean_step", F.when(F.col("finite") & F.col("increasing") & (F.col("n_rows") > 1), mean))
    passed = F.col("finite") & F.col("increasing") & mean_ok
    if zero_start:
        passed = passed & F.coalesce(F.col("start_ok"), F.lit(False))
    if uniform:
        passed = passed & F.col("uniform")
    return out.withColumn("passed", passed).drop("_fps", "_a", "_b")


def structure_check(rows: DataFrame, episodes: DataFrame) -> DataFrame:
    """Row and global indices without gaps, and agreement with the episode's registered offsets (Q3, C5): one flag for each."""
    meta = episodes.where(F.col(EPISODE).isNotNull()).groupBy(EPISODE).agg(F.min(F.struct("length", "dataset_from_index", "dataset_to_index")).alias("_m"))
    meta = meta.select(EPISODE, F.col("_m.length").alias("_length"), F.col("_m.dataset_from_index").alias("_from"), F.col("_m.dataset_to_index").alias("_to"))
    r = own(rows.withColumn("_g", before("global_index")).withColumn("_f", before("frame_index")))
    counted = F.when(F.col("_g").isNull(), F.col("frame_index") == 0).otherwise(F.col("frame_index") == F.col("_f") + 1)
    out = r.groupBy(EPISODE).agg(F.count(F.lit(1)).alias("n_rows"), _every(counted).alias("_frames"), _every(F.col("_g").isNull() | (F.col("global_index") == F.col("_g") + 1)).alias("_globals"), F.min("first_index").alias("_first"))
    out = out.join(meta, EPISODE, "left")
    broken = {
        "frame_gap": ~F.col("_frames"), "index_gap": ~F.col("_globals"), "start_differs": F.col("_from").isNotNull() & (~F.col("_globals") | (F.col("_from") != F.col("_first"))),
        "length_differs": F.col("_length") != F.col("n_rows"), "span_differs": F.col("_to") - F.col("_from") != F.col("n_rows"),
    }
    out = out.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in broken.items()})
    any_broken = F.greatest(*[F.col(k) for k in broken])
    return out.select(EPISODE, "n_rows", *broken, (~any_broken).alias("passed"))


def length_check(rows: DataFrame, min_frames: int = 1, max_frames: int | None = None, min_seconds: float | None = None, max_seconds: float | None = None) -> DataFrame:
    """Number of frames and seconds within inclusive bounds (Q4, Q24)."""
    out = own(rows).groupBy(EPISODE).agg(F.count(F.lit(1)).alias("n_rows"), F.max("fps").alias("_fps")).withColumn("seconds", F.try_divide(F.col("n_rows").cast("double"), F.col("_fps")))
    tests = [F.col("n_rows") >= min_frames]
    tests += [F.col("n_rows") <= max_frames] if max_frames is not None else []
    tests += [F.col("seconds") >= min_seconds] if min_seconds is not None else []
    tests += [F.col("seconds") <= max_seconds] if max_seconds is not None else []
    passed = tests[0]
    for t in tests[1:]:
        passed = passed & t
    return out.withColumn("passed", F.coalesce(passed, F.lit(False))).drop("_fps")


def with_derivative(rows: DataFrame, order: int, source: str = "state", period: float | None = None, width: int = 8) -> DataFrame:
    """Add ``_c0`` to ``_c{width-1}``: divided differences of an order at midpoint times, null in the first rows.

    Components are plain columns, so the whole chain stays in generated code.
    """
    comps = [f"_c{i}" for i in range(width)]
    out = rows.withColumns({c: F.get(source, F.lit(i)) for i, c in enumerate(comps)}).withColumn("_m", F.col("t"))
    for level in range(order):
        out = out.withColumns({f"_p{c}": before(c) for c in (*comps, "_m")})
        step = F.col("_m") - F.col("_p_m")
        circle = period if level == 0 else None
        delta = lambda c: F.col(c) - F.col(f"_p{c}") if circle is None else F.pmod(F.col(c) - F.col(f"_p{c}") + circle / 2, F.lit(circle)) - circle / 2  # noqa: E731, B023
        out = out.withColumns({**{c: F.try_divide(delta(c), step) for c in comps}, "_m": (F.col("_m") + F.col("_p_m")) / 2})
        out = out.drop(*[f"_p{c}" for c in (*comps, "_m")])
    return out


def _peak(width: int) -> Column:
    return F.greatest(*[F.abs(F.col(f"_c{i}")) for i in range(width)]) if width > 1 else F.abs(F.col("_c0"))


def _usable(source: str) -> list[Column]:
    return [F.count(F.lit(1)).alias("n_rows"), _every(is_finite(F.col("t"))).alias("_t"), _every(F.col("_dt").isNull() | (F.col("_dt") > 0)).alias("_up"), _every(all_finite(F.col(source))).alias("_ok")]


def derivative_check(rows: DataFrame, order: int, threshold: float | None = None, source: str = "state", period: float | None = None, width: int = 8) -> DataFrame:
    """Largest derivative and intervals beyond the threshold (Q5): velocity, acceleration, jerk are orders 1, 2, 3."""
    if order not in (1, 2, 3) or (threshold is not None and not 0 < threshold < INF):
        raise ValueError("order is 1, 2 or 3 and a threshold positive")
    r = with_derivative(rows.withColumn("_dt", F.col("t") - before("t")), order, source, period, width).withColumn("_peak", _peak(width))
    beyond = _n(F.col("_peak") > threshold) if threshold is not None else F.sum(F.lit(0))
    out = own(r).groupBy(EPISODE).agg(*_usable(source), F.max("_peak").alias("_max"), beyond.alias("_beyond"))
    evaluated = (F.col("n_rows") > order) & F.col("_t") & F.col("_up") & F.col("_ok") & is_finite(F.col("_max"))
    return out.select(
        EPISODE, evaluated.alias("evaluated"), F.when(evaluated, F.col("_max")).alias("peak"), F.when(evaluated, F.col("_beyond")).alias("intervals_beyond"), (evaluated & (F.col("_beyond") == 0)).alias("passed")
    )


def episode_moments(rows: DataFrame, comps: list[str], flags: list[Column]) -> DataFrame:
    """Per ``(episode, chunk)`` the whole episode's ``m`` mean, ``s`` deviation and ``a`` largest size of each component, and its flags.

    Slices are summed up first and their moments then put together, so no episode is one task.
    """
    names = ["n_rows", "_t", "_up", "_ok"]
    parts = rows.groupBy(EPISODE, "chunk").agg(*flags, *[f(c).alias(f"{k}{c}") for c in comps for k, f in (("n", F.count), ("m", F.avg), ("v", F.var_pop), ("a", lambda c: F.max(F.abs(F.col(c)))))])
    whole = Window.partitionBy(EPISODE)
    over = {"n_rows": F.sum("n_rows").over(whole), **{f: F.min(f).over(whole) for f in names[1:]}}
    for c in comps:
        same = F.min(f"m{c}").over(whole) == F.max(f"m{c}").over(whole)
        mean = F.try_divide(F.sum(F.col(f"m{c}") * F.col(f"n{c}")).over(whole), F.sum(f"n{c}").over(whole))
        over |= {f"_N{c}": F.sum(f"n{c}").over(whole), f"_M{c}": F.when(same, F.min(f"m{c}").over(whole)).otherwise(mean), f"a{c}": F.max(f"a{c}").over(whole)}
    parts = parts.withColumns(over)
    spread = {f"s{c}": F.sqrt(F.try_divide(F.sum(F.col(f"n{c}") * (F.col(f"v{c}") + (F.col(f"m{c}") - F.col(f"_M{c}")) ** 2)).over(whole), F.col(f"_N{c}"))) for c in comps}
    return parts.withColumns(spread).select(EPISODE, "chunk", *names, *[F.col(f"_M{c}").alias(f"m{c}") for c in comps], *spread, *[f"a{c}" for c in comps])


def zscore_check(rows: DataFrame, order: int = 0, threshold: float = 3.0, source: str = "state", width: int = 8, period: float | None = None) -> DataFrame:
    """Within-episode, per-component population z-scores of values (order 0, Q7) or derivatives (1, 2, Q6)."""
    r = own(with_derivative(rows.withColumn("_dt", F.col("t") - before("t")), order, source, period, width))
    comps = [f"_c{i}" for i in range(width)]
    stats = episode_moments(r, comps, _usable(source))
    least = lambda c: F.lit(RESIDUE) * F.greatest(F.lit(1.0), F.col(f"a{c}")) if order else F.lit(0.0)
    r = r.select(EPISODE, "chunk", *comps).join(stats, [EPISODE, "chunk"])  # by slice, as the rows lie
    z = F.array(*[F.when(F.col(f"s{c}") > least(c), F.abs(F.col(c) - F.col(f"m{c}")) / F.col(f"s{c}")).when(F.col(c).isNotNull(), F.lit(0.0)) for c in comps])
    r = r.withColumn("_z", F.array_max(z))
    flags = ["n_rows", "_t", "_up", "_ok"]
    out = r.groupBy(EPISODE).agg(*[F.max(c).alias(c) for c in flags], F.max("_z").alias("_max"), _n(F.col("_z") > threshold).alias("_beyond"))
    evaluated = (F.col("n_rows") > order) & F.col("_ok") & F.coalesce(is_finite(F.col("_max")), F.lit(False))
    if order:
        evaluated = evaluated & F.col("_t") & F.col("_up")
    return out.select(EPISODE, evaluated.alias("evaluated"), F.when(evaluated, F.col("_max")).alias("max_zscore"), F.when(evaluated, F.col("_beyond")).alias("rows_beyond"), (evaluated & (F.col("_beyond") == 0)).alias("passed"))


def limits_check(rows: DataFrame, low: str = "joint_low", high: str = "joint_high", source: str = "state") -> DataFrame:
    """Rows with a finite component outside its bounds (Q8, and Q9 with percentile bounds); no bounds: not evaluated."""
    known = F.col(low).isNotNull() & F.col(high).isNotNull()
    out = own(rows).groupBy(EPISODE).agg(F.max(known).alias("evaluated"), _n(known & outside(F.col(source), F.col(low), F.col(high))).alias("_n"))
    return out.select(EPISODE, "evaluated", F.when(F.col("evaluated"), F.col("_n")).alias("violating_rows"), (F.col("evaluated") & (F.col("_n") == 0)).alias("passed"))


def _moves(rows: DataFrame, source: str, name: str) -> DataFrame:
    return rows.withColumn(name, largest(difference(F.col(source), before(source))))


def static_check(rows: DataFrame, epsilon: float = 1e-4, threshold: float | None = None, source: str = "state") -> DataFrame:
    """Share of transitions that move no component by more than ``epsilon`` (Q10)."""
    r = own(_moves(rows, source, "_move"))
    out = r.groupBy(EPISODE).agg(F.count(F.lit(1)).alias("_n"), _every(all_finite(F.col(source))).alias("_ok"), _n(F.col("_move") <= epsilon).alias("_still"))
    evaluated = (F.col("_n") > 1) & F.col("_ok")
    ratio = F.when(evaluated, F.col("_still") / (F.col("_n") - 1))
    passed = evaluated if threshold is None else evaluated & (ratio <= threshold)
    return out.select(EPISODE, evaluated.alias("evaluated"), F.when(evaluated, F.col("_still")).alias("static_transitions"), ratio.alias("static_ratio"), passed.alias("passed"))


def joint_static_check(rows: DataFrame, state_epsilon: float, action_epsilon: float, threshold: float = 0.95) -> DataFrame:
    """Share of transitions in which state and action both move by less than their limits (Q11)."""
    r = own(_moves(_moves(rows, "state", "_s"), "action", "_a"))
    s, a = F.col("_s") < state_epsilon, F.col("_a") < action_epsilon
    out = r.groupBy(EPISODE).agg(F.count(F.lit(1)).alias("_n"), _every(all_finite(F.col("state")) & all_finite(F.col("action"))).alias("_ok"), _n(s & a).alias("_both"), _n(s).alias("_st"), _n(a).alias("_ac"))
    evaluated = (F.col("_n") > 1) & F.col("_ok")
    ratio = F.when(evaluated, F.col("_both") / (F.col("_n") - 1))
    pick = lambda c: F.when(evaluated, F.col(c))
    return out.select(EPISODE, evaluated.alias("evaluated"), pick("_both").alias("static_transitions"), pick("_st").alias("state_static"), pick("_ac").alias("action_static"), ratio.alias("static_ratio"), (evaluated & (ratio <= threshold)).alias("passed"))


def static_edges(rows: DataFrame, epsilon: float = 0.002, min_kept: int = 2, source: str = "action") -> DataFrame:
    """First and last moving transition and the trim they suggest (Q12, C3); rows ``[trim_start, trim_end)`` stay."""
    r = own(_moves(rows, source, "_move"))
    moving = F.col("_move") >= epsilon
    out = r.groupBy(EPISODE).agg(F.count(F.lit(1)).alias("_n"), _every(all_finite(F.col(source))).alias("evaluated"), F.min(F.when(moving, F.col("pos") - 1)).alias("_a"), F.max(F.when(moving, F.col("pos") + 1)).alias("_b"), _n(F.col("_move") < epsilon).alias("_still"))
    some = F.col("_a").isNotNull()
    start, stop = F.when(some, F.col("_a")).otherwise(0), F.when(some, F.col("_b")).otherwise(F.col("_n"))
    trim = some & (stop - start >= min_kept) & ((start > 0) | (stop < F.col("_n")))
    e = F.col("evaluated")
    return out.select(
        EPISODE, "evaluated", (e & ~some).alias("all_static"), (e & trim).alias("should_trim"), F.when(e, start).cast("long").alias("trim_start"), F.when(e, stop).cast("long").alias("trim_end"),
        F.when(e, F.col("_still")).alias("static_rows"), (e & some & ~trim).alias("passed"),
    )


def gripper_check(rows: DataFrame, position: int = 7, source: str = "state", mode: str = "continuous", low: float = 0.0, high: float = 1.0, tolerance: float = 1e-6) -> DataFrame:
    """Gripper values follow the chosen convention (Q13): a range, or one of two values."""
    x = F.get(source, F.lit(position))
    if mode == "continuous":
        valid = (x >= low - tolerance) & (x <= high + tolerance)
    else:
        first = 0.0 if mode == "binary_01" else -1.0
        valid = (F.abs(x - first) <= tolerance) | (F.abs(x - 1.0) <= tolerance)
    out = own(rows).groupBy(EPISODE).agg(_every(is_finite(x)).alias("evaluated"), _n(~valid).alias("_bad"))
    return out.select(EPISODE, "evaluated", F.when(F.col("evaluated"), F.col("_bad")).alias("violating_rows"), (F.col("evaluated") & (F.col("_bad") == 0)).alias("passed"))


def alias_check(rows: DataFrame, a: Column, b: Column) -> DataFrame:
    """Rows in which a column stored twice does not agree with its source (Q19)."""
    return own(rows).groupBy(EPISODE).agg(_n(~close(a, b)).alias("mismatching_rows")).withColumn("passed", F.col("mismatching_rows") == 0)


def clock_check(rows: DataFrame, tolerance: float = 0.2, max_variation: float = 0.25) -> DataFrame:
    """The older clock rule: increasing, mean step near ``1 / fps``, coefficient of variation of steps (Q23)."""
    r = own(rows.withColumn("_dt", F.col("t") - before("t")))
    out = r.groupBy(EPISODE).agg(F.count("_dt").alias("steps"), _every(F.col("_dt").isNull() | (F.col("_dt") > 0)).alias("increasing"), F.avg("_dt").alias("_mean"), F.stddev_pop("_dt").alias("_std"), F.max("fps").alias("_fps"))
    variation = F.try_divide(F.col("_std"), F.col("_mean"))
    near = F.abs(F.col("_mean") * F.col("_fps") - 1) <= tolerance
    return out.select(EPISODE, "steps", "increasing", F.round("_mean", 6).alias("mean_step"), F.round(variation, 6).alias("variation"), F.coalesce(F.col("increasing") & near & (variation <= max_variation), F.lit(False)).alias("passed"))


def nonfinite_positions(rows: DataFrame, columns: tuple[str, ...] = ("state", "action")) -> DataFrame:
    """Rows and vector columns with a component that is not finite: ``(episode_index, column, pos)``."""
    bad = F.array_compact(F.array(*[F.when(~F.coalesce(F.forall(c, is_finite), F.lit(False)), F.lit(c)) for c in columns]))
    return own(rows).select(EPISODE, F.explode(bad).alias("column"), "pos")
