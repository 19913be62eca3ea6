"""Repeated consecutive events in sequences (problem 2).

Adjacent agglomeration: the events of an entity form a doubly linked list in order; a priority queue holds the
distance of each pair of neighbouring runs, and the most similar pair within the similarity and gap limits is
merged until none is left. Linkage ``boundary`` compares the last event of the left run with the first of the
right one (a run is then a longest stretch whose successive events differ by at most the limit; a merge leaves the
distances to the neighbours as they are); ``centroid`` compares the runs' mean vectors, so the distances of a merged
run to its neighbours are queued anew. ``max_gap`` is the largest time between facing events.

Entities are cut into slices of ``chunk_rows`` order keys; each slice is agglomerated on its own and the runs at
slice edges are then joined where their facing events are within the limits (for ``centroid`` this stitching
compares the facing events too). Only the edge runs, two per slice, meet in one window; totals per entity come from
sums per slice.

Defined results: rows without entity or order key are ignored; a repeated order key counts once, the earliest
``received_at`` first; an event whose vector is null or has a null, NaN or infinite component is a run of its own
and neither continues nor is continued; under a gap limit an event without finite time neither; ties are merged in
order; an empty input gives no runs; a run without any finite time has a null duration; columns other than those
named are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from motionloom.operators.chunks import CHUNK_ROWS, chunk_of, floats, group_starts, in_slices, ints, matrix, whole_groups
from motionloom.session import checkpointed

RUN_SCHEMA = "entity long, first_index long, last_index long, n_rows long, t_first double, t_last double, min_kept long, max_step double, chunk_rows long, at_start boolean, at_end boolean, head array<double>, tail array<double>, t_head double, t_tail double, chunk long"


def step_distances(vectors: np.ndarray) -> np.ndarray:
    """Largest component difference of each event from the one before it; infinite where either is not finite."""
    d = np.full(len(vectors), np.inf)
    ok = np.isfinite(vectors).all(axis=1)
    if len(vectors) > 1:
        both = ok[1:] & ok[:-1]
        safe = np.where(ok[:, None], vectors, 0.0)
        d[1:] = np.where(both, np.abs(safe[1:] - safe[:-1]).max(axis=1), np.inf)
    return d


def agglomerate(vectors: np.ndarray, limit: float, times: np.ndarray | None = None, max_gap: float = np.inf, linkage: str = "boundary") -> np.ndarray:
    """Start positions of the runs of one ordered entity."""
    n = len(vectors)
    if not n:
        return np.zeros(0, np.int64)
    dist = apart(step_distances(vectors), times, max_gap)
    return _merge(dist, vectors, np.zeros(n, bool), np.full(n, limit), linkage)


def apart(dist: np.ndarray, times: np.ndarray | None, max_gap: float) -> np.ndarray:
    """Distances, infinite where the time from the event before is above the gap limit or unknown."""
    if times is not None and np.isfinite(max_gap):
        with np.errstate(invalid="ignore"):
            dist[1:] = np.where(np.abs(np.diff(times)) <= max_gap, dist[1:], np.inf)
    return dist


def _merge(dist: np.ndarray, vectors: np.ndarray, closed: np.ndarray, limit: np.ndarray, linkage: str) -> np.ndarray:
    """Merge runs of many entities at once: ``closed`` rows begin an entity and are never merged to the left."""
    if linkage not in ("boundary", "centroid"):
        raise ValueError("linkage is boundary or centroid")
    n = len(dist)
    barrier = closed | ~np.isfinite(dist)
    barrier[0] = True
    able = np.flatnonzero((dist <= limit) & ~barrier)
    heap = list(zip(dist[able].tolist(), able.tolist(), [0] * len(able)))
    heapq.heapify(heap)
    # A run is known by its first event: left and right link it to its neighbours, size and total describe it.
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    alive = np.ones(n, bool)
    moving = linkage == "centroid"
    size, version = [1] * n, [0] * n
    total = vectors.astype(np.float64) if moving else None
    while heap:
        _, i, v = heapq.heappop(heap)
        if not alive[i] or version[i] != v:
            continue
        p, q = left[i], right[i]
        size[p] += size[i]
        alive[i] = False
        right[p] = q
        if q < n:
            left[q] = p
        if not moving:
            continue  # the events that face each other at p and at q are the same as before
        total[p] = total[p] + total[i]
        for j in (p, q):
            if j < n and not barrier[j]:
                version[j] += 1
                d = float(np.abs(total[j] / size[j] - total[left[j]] / size[left[j]]).max())
                if d <= limit[j]:
                    heapq.heappush(heap, (d, j, version[j]))
    return np.flatnonzero(alive)


def _slice_runs(batches: Iterator[pa.RecordBatch], width: int, linkage: str, max_gap: float, keep_rows: int) -> Iterator[pa.RecordBatch]:
    for t in whole_groups(batches, ["entity", "chunk"]):
        yield from _table_runs(t, width, linkage, max_gap, keep_rows).to_batches()


def _table_runs(t: pa.Table, width: int, linkage: str, max_gap: float, keep_rows: int) -> pa.Table:
    ent, chk, order = ints(t, "entity"), ints(t, "chunk"), ints(t, "ord")
    n = len(ent)
    vec = matrix(t, "vec", width)
    starts = group_starts(t, ["entity", "chunk"])
    closed = np.zeros(n, bool)
    closed[starts] = True
    time = floats(t, "t")
    run = _merge(apart(step_distances(vec), time, max_gap), vec, closed, floats(t, "limit"), linkage)
    stop = np.append(run[1:], n)
    count = stop - run
    group_end = np.zeros(n + 1, bool)
    group_end[starts] = True
    group_end[n] = True
    at_start, at_end = closed[run], group_end[stop]
    sizes = np.diff(np.append(starts, n))
    of = np.cumsum(closed) - 1
    several = t.column("several").combine_chunks().to_numpy(zero_copy_only=False).astype(bool)[run]
    # Every group reports its first run (it carries the group's number of rows), long runs, and edge runs where a neighbouring slice exists.
    keep = at_start | (count >= keep_rows) | (several & at_end)
    run, stop, count, at_start, at_end, several = (x[keep] for x in (run, stop, count, at_start, at_end, several))
    seen = np.where(np.isfinite(time), time, np.nan)
    t_first, t_last = np.full(len(run), np.nan), np.full(len(run), np.nan)
    for k, (a, b) in enumerate(zip(run.tolist(), stop.tolist())):
        if b - a == 1:
            t_first[k] = t_last[k] = seen[a]
        else:
            w = seen[a:b]
            w = w[~np.isnan(w)]
            if len(w):
                t_first[k], t_last[k] = w.min(), w.max()
    limits, kept_min = floats(t, "limit"), ints(t, "min_kept")
    vectors = lambda rows, flag: pa.array([v.tolist() if f else None for v, f in zip(vec[rows], flag)], pa.list_(pa.float64()))
    return pa.table(
        {
            "entity": ent[run], "first_index": order[run], "last_index": order[stop - 1], "n_rows": count,
            "t_first": pa.array(t_first, from_pandas=True), "t_last": pa.array(t_last, from_pandas=True),
            "min_kept": kept_min[run], "max_step": limits[run],
            "chunk_rows": np.where(at_start, sizes[of[run]], 0), "at_start": at_start & several, "at_end": at_end & several,
            "head": vectors(run, at_start & several), "tail": vectors(stop - 1, at_end & several),
            "t_head": pa.array(seen[run], from_pandas=True), "t_tail": pa.array(seen[stop - 1], from_pandas=True), "chunk": chk[run],
        }
    )


def collapse_runs(
    events: DataFrame,
    limits: DataFrame,
    width: int,
    keep_rows: int = 3,
    linkage: str = "boundary",
    max_gap: float = float("inf"),
    chunk_rows: int = CHUNK_ROWS,
    entity: str = "episode_index",
    order: str = "global_index",
    vector: str = "action",
    time: str = "t",
    received: str = "received_at",
) -> DataFrame:
    """Runs of ``keep_rows`` or more events: ``(entity, first_index, last_index, n_rows, duration, kept_rows, min_kept)``.

    ``limits`` has per ``(entity, chunk)`` the similarity limit ``max_step`` and ``min_kept``. ``kept_rows`` is what the
    entity keeps when each of its runs is reduced to one event; a caller respects ``min_kept`` by
    ``kept_rows >= min_kept``.
    """
    several = F.count(F.lit(1)).over(Window.partitionBy(entity)) > 1
    known = limits.where(F.col("max_step").isNotNull()).select(F.col(entity).alias("entity"), "chunk", F.col("max_step").cast("double").alias("limit"), F.coalesce(F.col("min_kept").cast("long"), F.lit(0).cast("long")).alias("min_kept"), several.alias("several"))
    rows = events.where(F.col(entity).isNotNull() & F.col(order).isNotNull()).select(
        F.col(entity).cast("long").alias("entity"), chunk_of(F.col(order), chunk_rows).alias("chunk"), F.col(order).cast("long").alias("ord"), F.col(received).alias("rec"), F.col(time).cast("double").alias("t"), F.col(vector).alias("vec")
    )
    rows = in_slices(rows.join(known, ["entity", "chunk"]), "entity", "chunk")
    runs = checkpointed(rows.mapInArrow(lambda it: _slice_runs(it, width, linkage, max_gap, keep_rows), RUN_SCHEMA))

    edge = F.col("at_start") | F.col("at_end")
    by_entity = Window.partitionBy("entity").orderBy("first_index")
    prev_tail, prev_end = F.lag("tail").over(by_entity), F.lag("at_end").over(by_entity)
    step = F.array_max(F.zip_with(prev_tail, F.col("head"), lambda a, b: F.abs(a - b)))
    usable = F.forall(F.concat(prev_tail, F.col("head")), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    near = F.abs(F.col("t_head") - F.lag("t_tail").over(by_entity)) <= max_gap if np.isfinite(max_gap) else F.lit(True)
    linked = F.coalesce(F.col("at_start") & prev_end & usable & (step <= F.col("max_step")) & near, F.lit(False))
    joined = runs.where(edge).withColumn("_new", F.when(linked, 0).otherwise(1))
    joined = joined.withColumn("_run", F.sum("_new").over(by_entity.rowsBetween(Window.unboundedPreceding, 0)))
    # Times of a stitched run: its parts' extremes; the chunk is that of its first part.
    joined = joined.groupBy("entity", "_run").agg(
        F.min_by("chunk", "first_index").alias("chunk"), F.min("first_index").alias("first_index"), F.max("last_index").alias("last_index"), F.sum("n_rows").alias("n_rows"),
        F.min("t_first").alias("t_first"), F.max("t_last").alias("t_last"), F.max("min_kept").alias("min_kept"), F.sum("chunk_rows").alias("chunk_rows"),
    ).drop("_run")
    whole = runs.where(~edge).select(*joined.columns).unionByName(joined)
    long = F.col("n_rows") >= keep_rows
    kept = whole.groupBy("entity").agg((F.sum("chunk_rows") - F.sum(F.when(long, F.col("n_rows") - 1).otherwise(0))).alias("kept_rows"))
    slices = whole.where(long).groupBy("entity", "chunk").agg(F.count(F.lit(1)).alias("_n")).drop("_n").join(kept, "entity")  # one row per slice, so no entity's runs meet in one task
    return whole.where(long).join(slices, ["entity", "chunk"]).select(
        F.col("entity").alias(entity), "first_index", "last_index", "n_rows", (F.col("t_last") - F.col("t_first")).alias("duration"), "kept_rows", "min_kept"
    )
