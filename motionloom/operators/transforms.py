"""Edits on trajectory rows: selections, numeric repairs, padding, reindexing.

All positions are source positions in the episode; selections of several kinds meet in one keep mask, numeric edits
run on the rows that are kept, and identity columns are rebuilt last. Rows come from ``trajectory`` with ``halo=0``
unless a function says otherwise. Functions that look along a whole episode (fill, interpolation, renumbering) work
per ``(episode_index, chunk)`` and take what they need from the other chunks through one summary row per chunk.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionloom.functions.vectors import all_finite, binarized, changed_values, clipped, is_finite, largest
from motionloom.operators.statistics import components, exact_quantiles
from motionloom.operators.trajectory import before, in_order, own
from motionloom.session import checkpointed

EPISODE = "episode_index"


def with_all_carried(rows: DataFrame, values: dict[str, Column], forward: bool = True) -> DataFrame:
    """The last (or, backward, the next) non-null value of the episode at each row, itself included, for many values."""
    w = in_order().rowsBetween(Window.unboundedPreceding, 0) if forward else in_order().rowsBetween(0, Window.unboundedFollowing)
    pick, best = (F.last, F.max_by) if forward else (F.first, F.min_by)
    rows = rows.withColumns({f"_v{n}": v for n, v in values.items()})
    edge = rows.groupBy(EPISODE, "chunk").agg(*[best(f"_v{n}", F.when(F.col(f"_v{n}").isNotNull(), F.col("global_index"))).alias(f"_e{n}") for n in values])
    by = Window.partitionBy(EPISODE).orderBy("chunk")
    beyond = by.rowsBetween(Window.unboundedPreceding, -1) if forward else by.rowsBetween(1, Window.unboundedFollowing)
    carry = edge.select(EPISODE, "chunk", *[pick(f"_e{n}", True).over(beyond).alias(f"_c{n}") for n in values])
    rows = rows.withColumns({n: pick(f"_v{n}", True).over(w) for n in values}).join(carry, [EPISODE, "chunk"], "left")
    return rows.withColumns({n: F.coalesce(n, f"_c{n}") for n in values}).drop(*[f"_{k}{n}" for k in "vc" for n in values])


def with_carried(rows: DataFrame, value: Column, name: str, forward: bool = True) -> DataFrame:
    """:func:`with_all_carried` for one value."""
    return with_all_carried(rows, {name: value}, forward)


def renumbered(rows: DataFrame, name: str = "new_index") -> DataFrame:
    """Add the row's number in its episode from zero."""
    sizes = rows.groupBy(EPISODE, "chunk").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(EPISODE).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(EPISODE, "chunk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    return rows.withColumn("_k", F.row_number().over(in_order())).join(offsets, [EPISODE, "chunk"]).withColumn(name, F.col("_k") - 1 + F.col("_off")).drop("_k", "_off")


def reindexed(rows: DataFrame) -> DataFrame:
    """New episode numbers by order of the source, row numbers, global numbers and a uniform clock.

    Episode numbers and offsets are running sums over the episode table in ranges of 4096 source numbers.
    """
    rows = renumbered(rows)
    e = rows.groupBy(EPISODE).agg(F.count(F.lit(1)).alias("_n")).withColumn("_range", F.floor(F.col(EPISODE) / 4096))
    upto = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = e.groupBy("_range").agg(F.count(F.lit(1)).alias("_e"), F.sum("_n").alias("_r"))
    ranges = ranges.select("_range", F.coalesce(F.sum("_e").over(upto), F.lit(0)).alias("_e0"), F.coalesce(F.sum("_r").over(upto), F.lit(0)).alias("_r0"))  # one row per 4096 episodes
    within = Window.partitionBy("_range").orderBy(EPISODE).rowsBetween(Window.unboundedPreceding, 0)
    e = e.withColumn("_ke", F.row_number().over(within)).withColumn("_kr", F.sum("_n").over(within)).join(ranges, "_range")
    e = e.select(EPISODE, (F.col("_e0") + F.col("_ke") - 1).alias("new_episode"), (F.col("_r0") + F.col("_kr") - F.col("_n")).alias("_start"))
    rows = rows.join(e, EPISODE)
    return rows.withColumn("new_global", F.col("_start") + F.col("new_index")).withColumn("new_t", F.try_divide(F.col("new_index").cast("double"), F.col("fps"))).drop("_start")


def keep_mask(rows: DataFrame, edges: DataFrame | None = None, epsilon: float | None = None, drop_nonfinite: bool = False, source: str = "action", listed: DataFrame | None = None) -> DataFrame:
    """Add ``keep``: trimmed edges, dropped static rows, non-finite rows and listed positions in one mask.

    ``edges`` is the result of ``static_edges``; static rows need a halo of one row.
    """
    keep = F.lit(True)
    if edges is not None:
        rows = rows.join(edges.select(EPISODE, "should_trim", "trim_start", "trim_end"), EPISODE, "left")
        keep = keep & (~F.coalesce("should_trim", F.lit(False)) | ((F.col("pos") >= F.col("trim_start")) & (F.col("pos") < F.col("trim_end"))))
    if epsilon is not None:
        d = F.zip_with(F.col(source), before(source), lambda a, b: a - b)
        rows = rows.withColumn("_still", F.coalesce(largest(d) < epsilon, F.lit(False)))
        keep = keep & ~F.col("_still")
    if drop_nonfinite:
        keep = keep & all_finite(F.col("state")) & all_finite(F.col("action"))
    if listed is not None:
        rows = rows.join(listed.select(EPISODE, "pos").distinct().withColumn("_listed", F.lit(True)), [EPISODE, "pos"], "left")
        keep = keep & F.col("_listed").isNull()
    return own(rows.withColumn("keep", keep)).drop("_still", "_listed", "should_trim", "trim_start", "trim_end")


def static_trim(rows: DataFrame, mode: str = "trim_edges", threshold: float = 1e-4, rotations: tuple[int, ...] = (), rotation_degrees: float | None = None, min_kept: int = 2, source: str = "action", width: int = 8) -> DataFrame:
    """Add ``keep`` by the older trim (X18): still edges, or with ``drop_static_frames`` every still row but the first.

    A row is still if no component moved by the threshold since the row before; the ``rotations`` components have a
    threshold of their own in degrees, or none. An episode of at most ``min_kept`` rows, or of which fewer would stay,
    is left whole. Rows need a halo of one row.
    """
    if mode not in ("trim_edges", "drop_static_frames"):
        raise ValueError(f"unknown mode {mode!r}")
    move = lambda cols: F.coalesce(F.greatest(F.lit(0.0), *[F.abs(F.get(source, F.lit(i)) - F.get(before(source), F.lit(i))) for i in cols]), F.lit(0.0)) if cols else F.lit(0.0)
    still = move([i for i in range(width) if i not in rotations]) < threshold
    if rotation_degrees is not None:
        still = still & (move([i for i in rotations if i < width]) < math.radians(rotation_degrees))
    r = own(rows.withColumn("_still", still))
    if mode == "trim_edges":
        e = r.groupBy(EPISODE).agg(F.min(F.when(~F.col("_still"), F.col("pos"))).alias("_a"), F.max(F.when(~F.col("_still"), F.col("pos"))).alias("_b"))
        r = r.join(e, EPISODE).withColumn("keep", F.coalesce(F.col("pos").between(F.col("_a"), F.col("_b")), F.lit(False))).drop("_a", "_b")
    else:
        r = r.withColumn("keep", ~F.col("_still") | (F.col("pos") == 0))
    whole = too_short(r, min_kept).select(EPISODE, (F.col("rejected") | (F.col("n_rows") <= min_kept)).alias("_whole"))
    return r.join(whole, EPISODE).withColumn("keep", F.col("keep") | F.col("_whole")).drop("_whole", "_still")


def gripper_binarized(rows: DataFrame, source: str, targets: dict[str, tuple[int, int]], threshold: float = 0.5, thresholds: dict[str, float] | None = None, low: float = 0.0, skip_binary: bool = True) -> DataFrame:
    """Add ``binarized``: the named ranges of components set to one above their threshold, else ``low``.

    ``thresholds`` has those of single targets. A target that holds only the two values in all of an episode stays.
    """
    covered = [i for a, b in targets.values() for i in range(a, b)]
    if len(covered) != len(set(covered)):
        raise ValueError("targets overlap")
    r = own(rows)
    part = lambda a, b: F.slice(F.col(source), a + 1, b - a)
    binary = {n: F.every(F.forall(part(*at), lambda x: (x == low) | (x == 1.0))).alias(f"_b{k}") for k, (n, at) in enumerate(targets.items())}
    if skip_binary and binary:
        r = r.join(r.groupBy(EPISODE).agg(*binary.values()), EPISODE)
    out = F.col(source)
    for k, (n, (a, b)) in enumerate(targets.items()):
        at = (thresholds or {}).get(n, threshold)
        new = F.transform(out, lambda x, i: F.when((i >= a) & (i < b), F.when(F.isnan(x), F.lit(low)).otherwise(binarized(x, at, low, inclusive=False))).otherwise(x))  # built at once, so a, b and at hold
        out = F.when(F.col(f"_b{k}"), out).otherwise(new) if skip_binary else new
    return r.withColumn("binarized", out).drop(*[f"_b{k}" for k in range(len(targets))])


def too_short(masked: DataFrame, minimum: int) -> DataFrame:
    """Episodes that keep fewer rows than the minimum."""
    return masked.groupBy(EPISODE).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("keep").cast("long")).alias("kept")).withColumn("rejected", F.col("kept") < minimum)


def interpolated(rows: DataFrame, x: Column, by_time: bool = True) -> DataFrame:
    """Add ``filled``: gaps of one component filled linearly, edges with the nearest value.

    ``by_time`` interpolates at source times; the older form uses row positions and fills an empty episode with zero.
    """
    return all_interpolated(rows, {"filled": x}, by_time)


def all_interpolated(rows: DataFrame, components: dict[str, Column], by_time: bool = True) -> DataFrame:
    """:func:`interpolated` for many components, each under its name, in one pass."""
    at = F.col("t") if by_time else F.col("pos").cast("double")
    good = {n: F.when(is_finite(x), F.struct(at.alias("t"), x.alias("x"))) for n, x in components.items()}
    out = with_all_carried(rows, {f"_p{n}": g for n, g in good.items()})
    out = with_all_carried(out, {f"_n{n}": g for n, g in good.items()}, forward=False)
    empty = F.lit(None).cast("double") if by_time else F.lit(0.0)
    filled = {}
    for n, x in components.items():
        p, q = F.col(f"_p{n}"), F.col(f"_n{n}")
        between = p["x"] + (q["x"] - p["x"]) * F.try_divide(at - p["t"], q["t"] - p["t"])
        filled[n] = F.when(is_finite(x), x).when(p.isNull() & q.isNull(), empty).when(p.isNull(), q["x"]).when(q.isNull(), p["x"]).otherwise(between)
    return out.withColumns(filled).drop(*[f"_{k}{n}" for k in "pn" for n in components])


def forward_filled(rows: DataFrame, x: Column) -> DataFrame:
    """Add ``filled``: the last finite value, never one from later rows."""
    return with_carried(rows, F.when(is_finite(x), x), "filled")


def clip_to(rows: DataFrame, source: str, low: Column, high: Column) -> DataFrame:
    """Add ``clipped`` (X9); rows without bounds keep their values."""
    return rows.withColumn("clipped", F.coalesce(clipped(F.col(source), low, high), F.col(source)))


def sampled_bounds(rows: DataFrame, source: str, width: int, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """One row of percentile bounds over rows finite in all components (A7): ``lows`` and ``highs``."""
    c = checkpointed(components(own(rows).where(all_finite(F.col(source))), source))
    q = exact_quantiles(c, ["component"], (low, high))
    ends = q.groupBy("component").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    pick = lambda k: F.transform(F.array_sort(F.collect_list(F.struct("component", k))), lambda s: s[k])
    return ends.where(F.col("component") < width).agg(pick("lo").alias("lows"), pick("hi").alias("highs"))


def synchronized(rows: DataFrame, alias: str, source: str, start: int, stop: int) -> DataFrame:
    """Rows whose stored copy ``alias`` is again the slice of its source, with ``_changed`` values of each row (X11)."""
    part = F.slice(F.col(source), start + 1, stop - start)
    return rows.withColumn("_changed", F.coalesce(changed_values(F.col(alias), part), F.lit(stop - start))).withColumn(alias, part)


def padded(rows: DataFrame, to: int, mode: str = "edge") -> DataFrame:
    """Episodes shorter than ``to`` rows continued at their rate, with ``valid``.

    ``mode`` is ``edge`` (last row), ``zero`` or ``nan``; padding rows have no source index.
    """
    last = rows.groupBy(EPISODE).agg(F.count(F.lit(1)).alias("_n"), F.max_by(F.struct("t", "fps", "state", "action"), "global_index").alias("_l"))
    last = last.where(F.col("_n") < to).select(EPISODE, "_n", "_l.*").withColumn("pos", F.explode(F.sequence(F.col("_n"), F.lit(to - 1).cast("long"))))
    fill = {"edge": lambda c: F.col(c), "zero": lambda c: F.array_repeat(F.lit(0.0), F.size(c)), "nan": lambda c: F.array_repeat(F.lit(float("nan")), F.size(c))}[mode]
    pad = last.select(EPISODE, "pos", F.lit(None).cast("long").alias("global_index"), (F.col("t") + (F.col("pos") - F.col("_n") + 1) / F.col("fps")).alias("t"), fill("state").alias("state"), fill("action").alias("action"), F.lit(False).alias("valid"))
    return rows.select(EPISODE, "pos", "global_index", "t", "state", "action", F.lit(True).alias("valid")).unionByName(pad)


def chunk_indices(rows: DataFrame, lengths: DataFrame, horizon: int) -> DataFrame:
    """Per row the positions of the next ``horizon`` actions, clipped to the episode, and which are padding."""
    r = rows.join(lengths.select(EPISODE, "n_rows"), EPISODE)
    steps = F.sequence(F.lit(0), F.lit(horizon - 1))
    return r.select(EPISODE, "pos", F.transform(steps, lambda i: F.least(F.col("pos") + i, F.col("n_rows") - 1)).alias("action_positions"), F.transform(steps, lambda i: F.col("pos") + i >= F.col("n_rows")).alias("is_padding"))


def chunk_actions(rows: DataFrame, horizon: int) -> DataFrame:
    """Per row the next ``horizon`` actions, the last one repeated beyond the episode's end, and which are padding.

    Rows need a halo of ``horizon - 1`` rows.
    """
    ahead = in_order().rowsBetween(0, horizon - 1)
    r = own(rows.withColumn("_next", F.collect_list("action").over(ahead)))
    missing = F.lit(horizon) - F.size("_next")
    full = F.concat("_next", F.array_repeat(F.element_at("_next", -1), missing))
    return r.select(EPISODE, "global_index", "pos", full.alias("actions"), F.transform(F.sequence(F.lit(0), F.lit(horizon - 1)), lambda i: i >= F.size("_next")).alias("is_padding"))
