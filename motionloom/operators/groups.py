"""Quality groups: many checks of named component groups in one pass over the rows.

All row measures of all groups are columns of one scan over the slices, and one partial aggregate per episode gives
every finding, so an audit has a single exchange of the rows. Paths are ``groups/<group>/<check>``; a group with an
empty name gives the plain ``<check>``.

Defined results: a check of a group is not evaluated if the episode has too few rows, or a time or component of the
group that is not finite; it then has no value and does not pass. Empty rows give no findings.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motionloom.functions.vectors import INF, is_finite, outside
from motionloom.operators.checks import EPISODE, RESIDUE, _every, _n
from motionloom.operators.statistics import robust_threshold
from motionloom.operators.trajectory import before, own

#: Names of the derivative checks by order.
DERIVATIVES = ("", "velocity", "acceleration", "jerk")


class GroupError(ValueError):
    """Groups that contradict each other or the rows."""


@dataclass(frozen=True)
class QualityGroup:
    """Components of one vector and the limits they are held to; a check without a limit is left out."""

    name: str
    source: str
    components: tuple[int, ...]
    velocity: float | None = None
    acceleration: float | None = None
    jerk: float | None = None
    zscore: float | None = None
    velocity_zscore: float | None = None
    acceleration_zscore: float | None = None
    static_epsilon: float | None = None
    static_ratio: float | None = None
    low: tuple[float, ...] | None = None
    high: tuple[float, ...] | None = None
    period: float | None = None

    def check(self, width: int) -> None:
        """Refuse components beyond the vector, repeated ones, limits that are not positive, bounds of another width (Q29)."""
        if not self.components or len(set(self.components)) != len(self.components) or not all(0 <= i < width for i in self.components):
            raise GroupError(f"{self.name}: components must be different and below {width}")
        for limit in (*DERIVATIVES[1:], "zscore", "velocity_zscore", "acceleration_zscore"):
            if (v := getattr(self, limit)) is not None and not 0 < v < INF:
                raise GroupError(f"{self.name}.{limit}: must be positive and finite")
        if (self.low is None) != (self.high is None) or (self.low is not None and not len(self.low) == len(self.high) == len(self.components)):
            raise GroupError(f"{self.name}: bounds need one low and one high value per component")
        if self.low is not None and any(a > b for a, b in zip(self.low, self.high)):
            raise GroupError(f"{self.name}: a low bound exceeds its high bound")

    def path(self, check: str) -> str:
        return f"groups/{self.name}/{check}" if self.name else check


def check_groups(groups: list[QualityGroup], width: int, aliases: dict[str, str] | None = None) -> None:
    """Refuse groups of one name, groups that do not fit, and aliases of aliases (Q32)."""
    names = [g.name for g in groups]
    if len(set(names)) != len(names):
        raise GroupError("group names must differ")
    for g in groups:
        g.check(width)
    for alias, source in (aliases or {}).items():
        if source in (aliases or {}) or source == alias:
            raise GroupError(f"{alias}: its source {source} is an alias itself")


def _with_levels(rows: DataFrame, source: str, at: list[int], orders: int, period: float | None, tag: str) -> DataFrame:
    """Add ``_{tag}_{order}_{i}``: the components and their divided differences at midpoint times."""
    out = rows.withColumns({f"_{tag}_0_{i}": F.get(source, F.lit(i)) for i in at}).withColumn(f"_{tag}_m0", F.col("t"))
    for k in range(1, orders + 1):
        prev = {c: f"_{tag}_{k - 1}_{i}" if i is not None else f"_{tag}_m{k - 1}" for i in (*at, None) for c in (i,)}
        out = out.withColumns({f"_b_{i}": before(c) for i, c in prev.items()})
        step = F.col(prev[None]) - F.col("_b_None")
        circle = period if k == 1 else None
        delta = lambda i: F.col(prev[i]) - F.col(f"_b_{i}") if circle is None else F.pmod(F.col(prev[i]) - F.col(f"_b_{i}") + circle / 2, F.lit(circle)) - circle / 2  # noqa: E731, B023
        out = out.withColumns({**{f"_{tag}_{k}_{i}": F.try_divide(delta(i), step) for i in at}, f"_{tag}_m{k}": (F.col(prev[None]) + F.col("_b_None")) / 2})
        out = out.drop(*[f"_b_{i}" for i in prev])
    return out


def _largest(columns: list[str]) -> Column:
    return F.greatest(*[F.abs(F.col(c)) for c in columns]) if len(columns) > 1 else F.abs(F.col(columns[0]))


def audit(rows: DataFrame, groups: list[QualityGroup], finite: bool = True, timestamp: float | None = None, limits: tuple[str, str] | None = None, min_rows: int | None = None, width: int = 8) -> DataFrame:
    """Findings ``(episode_index, path, passed, evaluated, value)`` of all checks.

    ``finite`` adds the check of all components and times, ``timestamp`` (a share of the period) that of the clock,
    ``limits`` (two columns) that of ``state`` against bounds of the row's robot, ``min_rows`` that of the length. Rows
    need a halo of three.
    """
    check_groups(groups, width)
    r = rows.withColumn("_dt", F.col("t") - before("t"))
    aggs: dict[str, Column] = {"_rows": F.count(F.lit(1)), "_tf": _every(is_finite(F.col("t"))), "_up": _every(F.col("_dt").isNull() | (F.col("_dt") > 0))}
    found: dict[str, tuple[Column, Column]] = {}
    values: dict[str, Column] = {}
    scored: dict[str, Column] = {}

    def add(path: str, evaluated: Column, passed: Column, value: Column) -> None:
        found[path] = (evaluated, passed)
        values[path] = value.cast("double")

    if finite:
        bad = lambda c: ~F.coalesce(F.forall(c, is_finite), F.lit(False))
        aggs["_bad"] = _n(bad("state") | bad("action") | ~is_finite(F.col("t")))
        add("finite", F.lit(True), F.col("_bad") == 0, F.col("_bad"))
    if timestamp is not None:
        period = F.lit(1.0) / F.col("fps")
        aggs |= {"_even": _every(F.col("_dt").isNull() | (F.abs(F.col("_dt") - period) <= period * timestamp)), "_zero": F.max(F.when(F.col("pos") == 0, F.abs(F.col("t")) <= period * timestamp)), "_fps": F.max("fps"), "_a": F.min("t"), "_b": F.max("t")}
        mean = (F.col("_b") - F.col("_a")) / (F.col("_rows") - 1)
        near = (F.col("_rows") < 2) | F.coalesce(F.abs(mean - 1 / F.col("_fps")) <= timestamp / F.col("_fps"), F.lit(False))
        add("timestamp", F.lit(True), F.col("_tf") & F.col("_up") & near & F.coalesce("_zero", F.lit(False)) & F.col("_even"), mean)
    if limits is not None:
        known = F.col(limits[0]).isNotNull() & F.col(limits[1]).isNotNull()
        aggs |= {"_lk": F.max(known), "_ln": _n(known & outside(F.col("state"), F.col(limits[0]), F.col(limits[1])))}
        add("joint_limits", F.col("_lk"), F.col("_ln") == 0, F.col("_ln"))
    if min_rows is not None:
        add("episode_length", F.lit(True), F.col("_rows") >= min_rows, F.col("_rows"))

    for k, g in enumerate(groups):
        at, tag = list(g.components), f"g{k}"
        orders = max((o for o, n in enumerate(DERIVATIVES) if n and getattr(g, n) is not None), default=0)
        orders = max(orders, 1 if g.velocity_zscore is not None else 0, 2 if g.acceleration_zscore is not None else 0)
        r = _with_levels(r, g.source, at, orders, g.period, tag)
        cols = {o: [f"_{tag}_{o}_{i}" for i in at] for o in range(orders + 1)}
        fine = F.lit(True)
        for c in cols[0]:
            fine = fine & is_finite(F.col(c))
        aggs[f"_{tag}_ok"] = _every(fine)
        usable = F.col(f"_{tag}_ok") & F.col("_tf") & F.col("_up")
        for o in range(1, orders + 1):
            if (limit := getattr(g, DERIVATIVES[o])) is not None:
                aggs[f"_{tag}_p{o}"] = F.max(_largest(cols[o]))
                peak = F.col(f"_{tag}_p{o}")
                add(g.path(DERIVATIVES[o]), usable & (F.col("_rows") > o) & is_finite(peak), peak <= limit, peak)
        for o, name in ((0, "zscore"), (1, "velocity_zscore"), (2, "acceleration_zscore")):
            if (limit := getattr(g, name)) is None:
                continue
            scores = []
            for i, c in zip(at, cols[o]):
                q = f"_{tag}_{o}_{i}"
                aggs |= {f"{q}_m": F.avg(c), f"{q}_s": F.stddev_pop(c), f"{q}_l": F.min(c), f"{q}_h": F.max(c)}
                lo, hi, m, s = (F.col(f"{q}_{x}") for x in "lhms")
                least = F.lit(RESIDUE) * F.greatest(F.lit(1.0), F.abs(lo), F.abs(hi)) if o else F.lit(0.0)
                scored[f"{q}_z"] = F.when(s > least, F.greatest(hi - m, m - lo) / s).when(m.isNotNull(), F.lit(0.0))
                scores.append(F.col(f"{q}_z"))
            scored[f"_{tag}_{o}_z"] = F.greatest(*scores) if len(scores) > 1 else scores[0]
            top = F.col(f"_{tag}_{o}_z")
            add(g.path(name), (usable if o else F.col(f"_{tag}_ok")) & (F.col("_rows") > o) & F.coalesce(is_finite(top), F.lit(False)), top <= limit, top)
        if g.low is not None:
            beyond = F.lit(False)
            for c, a, b in zip(cols[0], g.low, g.high):
                beyond = beyond | (is_finite(F.col(c)) & ((F.col(c) < a) | (F.col(c) > b)))
            aggs[f"_{tag}_out"] = _n(beyond)
            add(g.path("bounds"), F.lit(True), F.col(f"_{tag}_out") == 0, F.col(f"_{tag}_out"))
        if g.static_epsilon is not None:
            r = r.withColumns({f"_{tag}_d{i}": F.col(c) - before(c) for i, c in zip(at, cols[0])})
            aggs[f"_{tag}_still"] = _n(_largest([f"_{tag}_d{i}" for i in at]) <= g.static_epsilon)
            ratio = F.try_divide(F.col(f"_{tag}_still").cast("double"), F.col("_rows") - 1)
            add(g.path("static_ratio"), F.col(f"_{tag}_ok") & (F.col("_rows") > 1), F.lit(True) if g.static_ratio is None else ratio <= g.static_ratio, ratio)
    e = own(r).groupBy(EPISODE).agg(*[c.alias(n) for n, c in aggs.items()])
    for part in (False, True):  # scores of components, then the largest of each check
        e = e.withColumns({n: c for n, c in scored.items() if (n.count("_") == 3) == part})
    kept = {f"_v{k}": (path, *found[path]) for k, path in enumerate(values)}
    e = e.withColumns({name: values[path] for name, (path, _, _) in kept.items()})
    structs = [F.struct(F.lit(path).alias("path"), F.coalesce(ev & ok, F.lit(False)).alias("passed"), ev.alias("evaluated"), F.when(ev, F.col(name)).alias("value")) for name, (path, ev, ok) in kept.items()]
    out = e.select(EPISODE, F.array(*structs).alias("_all"))
    return out.select(EPISODE, F.explode("_all").alias("_f")).select(EPISODE, "_f.*")


def rule_counters(findings: DataFrame) -> DataFrame:
    """How often each check ran, passed, failed and was not evaluated."""
    return findings.groupBy("path").agg(F.count(F.lit(1)).alias("runs"), F.count_if("passed").alias("passed"), F.count_if(F.col("evaluated") & ~F.col("passed")).alias("failed"), F.count_if(~F.col("evaluated")).alias("not_evaluated"))


#: Limits so high that nothing fails: only the values are asked for.
_ANY = 1e300


def calibrate_groups(rows: DataFrame, groups: dict[str, tuple[str, tuple[int, ...]]], min_samples: int = 20, quantile: float = 0.995, digits: int | None = None) -> DataFrame:
    """Robust thresholds of five measures for each group from one peak per episode (A10).

    ``groups`` names a vector and its components. Result ``(path, samples, excluded, status, median, mad, threshold,
    samples_beyond)``; episodes in which a measure is not evaluated are counted as excluded.
    """
    asked = [QualityGroup(n, s, c, velocity=_ANY, acceleration=_ANY, jerk=_ANY, velocity_zscore=_ANY, acceleration_zscore=_ANY) for n, (s, c) in groups.items()]
    value = F.coalesce("value", F.lit(float("nan")))
    samples = audit(rows, asked, finite=False).select("path", (value if digits is None else F.round(value, digits)).alias("value"))
    return robust_threshold(samples, "value", "path", quantile=quantile, min_samples=min_samples)
