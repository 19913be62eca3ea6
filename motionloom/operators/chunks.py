"""Ordered work per entity without one task per entity.

An entity (an episode, a sensor) may hold a third of all rows. Ordered operators therefore work on
``(entity, chunk)`` where ``chunk`` is a fixed-width slice of the order key. The rows of the entity before and after
a slice are also sent to it as halo rows, however far away their keys are, so each slice can be processed on its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionloom.session import bounded_broadcast

CHUNK_ROWS = 1 << 16
#: Above this many rows the entities with gaps and their far halo keys are joined by shuffle.
MAX_FAR_ROWS = 10_000


def chunk_of(order: Column, width: int = CHUNK_ROWS) -> Column:
    """Slice number of an integer order key."""
    return F.floor(order / F.lit(width)).cast("long")


def chunk_sizes(rows: DataFrame, entity: str, order: str, width: int = CHUNK_ROWS, **aggs: Column) -> DataFrame:
    """One row per ``(entity, chunk)`` that has rows: ``n_rows`` and the given aggregates (partially aggregated)."""
    keyed = rows.where(F.col(entity).isNotNull() & F.col(order).isNotNull())
    return keyed.groupBy(entity, chunk_of(F.col(order), width).alias("chunk")).agg(
        F.count(F.lit(1)).alias("n_rows"), *[c.alias(k) for k, c in aggs.items()]
    )


def far_halo(rows: DataFrame, entity: str, order: str, halo: int, width: int = CHUNK_ROWS) -> DataFrame | None:
    """``(entity, order, chunk)`` of halo rows whose keys are more than ``halo`` away from the slice; None without gaps.

    A slice needs none if the keys next to its edges are all there, which one bit per key tells; only entities with a
    gap at an edge are looked at row by row.
    """
    keys = rows.where(F.col(entity).isNotNull() & F.col(order).isNotNull()).select(entity, F.col(order).cast("long").alias("_o"), chunk_of(F.col(order), width).alias("chunk"))
    at = F.col("_o") - F.col("chunk") * width
    bit = lambda place: F.when(place.between(0, min(halo, 64) - 1), F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int")))
    edges = keys.groupBy(entity, "chunk").agg(F.min(at).alias("_lo"), F.max(at).alias("_hi"), F.bit_or(bit(at)).alias("_head"), F.bit_or(bit(width - 1 - at)).alias("_tail"))
    by = Window.partitionBy(entity).orderBy("chunk")
    full = F.lit(-1 if halo >= 64 else (1 << halo) - 1) if halo <= 64 else F.lit(None).cast("long")
    beside = {"before": (F.lag, -1, "_tail", F.col("_lo") >= width - halo), "after": (F.lead, 1, "_head", F.col("_hi") < halo)}
    edges = edges.withColumns({f"_outer_{k}": F.coalesce(F.col(bits) == full, F.lit(False)) | (look("chunk").over(by).isNull() & all_near) for k, (look, _, bits, all_near) in beside.items()})
    near = [look("chunk").over(by).isNull() | ((look("chunk").over(by) == F.col("chunk") + step) & look(f"_outer_{k}").over(by)) for k, (look, step, _, _) in beside.items()]
    gaps = edges.withColumn("_near", near[0] & near[1]).where(~F.col("_near")).select(entity).distinct()
    if gaps.isEmpty():
        return None
    k = keys.join(bounded_broadcast(gaps, MAX_FAR_ROWS), entity).distinct()
    slices = Window.partitionBy(entity, "chunk")
    k = k.withColumn("_first", F.row_number().over(slices.orderBy("_o"))).withColumn("_last", F.row_number().over(slices.orderBy(F.desc("_o"))))
    ends = k.groupBy(entity, "chunk").agg(F.collect_list(F.when(F.col("_first") <= halo, F.col("_o"))).alias("_head"), F.collect_list(F.when(F.col("_last") <= halo, F.col("_o"))).alias("_tail"))
    before = F.slice(F.sort_array(F.flatten(F.collect_list("_tail").over(by.rowsBetween(-halo, -1))), False), 1, halo)
    after = F.slice(F.sort_array(F.flatten(F.collect_list("_head").over(by.rowsBetween(1, halo)))), 1, halo)
    far = ends.select(entity, "chunk", F.concat(before, after).alias("_around")).select(entity, "chunk", F.explode("_around").alias(order))
    return far.where(~F.col("chunk").between(chunk_of(F.col(order) - halo, width), chunk_of(F.col(order) + halo, width)))


def with_halo(rows: DataFrame, order: str, halo: int, width: int = CHUNK_ROWS, entity: str = "episode_index") -> DataFrame:
    """Add ``chunk``; the entity's ``halo`` rows before and after a slice come again for it with ``is_halo``.

    Rows count once for each order key; a slice with fewer rows than ``halo`` passes those of the slices beyond it on.
    """
    o = F.col(order)
    own = chunk_of(o, width)
    if halo <= 0:
        return rows.withColumn("chunk", own).withColumn("is_halo", F.lit(False))
    chunks = F.sequence(chunk_of(o - F.lit(halo), width), chunk_of(o + F.lit(halo), width))
    near = rows.withColumn("_own", own).withColumn("chunk", F.explode(chunks)).withColumn("is_halo", F.col("chunk") != F.col("_own")).drop("_own")
    far = far_halo(rows, entity, order, halo, width)
    if far is None:
        return near
    return near.unionByName(rows.join(bounded_broadcast(far, MAX_FAR_ROWS), [entity, order]).withColumn("is_halo", F.lit(True)))


def in_slices(rows: DataFrame, *keys: str, order: str = "ord", arrival: str = "rec") -> DataFrame:
    """Rows clustered by ``keys`` and sorted by ``order``, of equal order keys only the one that arrived first.

    For batch functions that need whole slices in order. The window states both needs to the planner, which a bare
    ``repartition`` behind a join does not: it is taken out as redundant and the join below may then be run without
    its shuffle.
    """
    by = Window.partitionBy(*keys).orderBy(order, F.col(arrival).asc_nulls_last())
    return rows.withColumn("_again", F.lag(order).over(by).eqNullSafe(F.col(order))).where(~F.col("_again")).drop("_again", arrival)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], min_rows: int = 20_000) -> Iterator[pa.Table]:
    """Regroup sorted batches so that no group of equal integer keys is cut; many groups share a table."""
    pending: list[pa.RecordBatch] = []
    held = 0
    for b in batches:
        if not b.num_rows:
            continue
        pending.append(b)
        held += b.num_rows
        if held < min_rows:
            continue
        t = pa.Table.from_batches(pending)
        starts = group_starts(t, keys)
        cut = int(starts[-1])
        if cut:
            yield t.slice(0, cut)
            pending = t.slice(cut).combine_chunks().to_batches()
            held = t.num_rows - cut
    if pending:
        yield pa.Table.from_batches(pending)


def ints(t: pa.Table, name: str) -> np.ndarray:
    """An integer column as int64; null becomes the smallest int64."""
    return t.column(name).cast(pa.int64()).fill_null(np.iinfo(np.int64).min).combine_chunks().to_numpy(zero_copy_only=False)


def floats(t: pa.Table, name: str) -> np.ndarray:
    """A numeric column as float64; null becomes NaN."""
    return t.column(name).cast(pa.float64()).fill_null(float("nan")).combine_chunks().to_numpy(zero_copy_only=False)


def group_starts(t: pa.Table, keys: list[str]) -> np.ndarray:
    """Index of the first row of each group of equal keys."""
    n = t.num_rows
    new = np.zeros(n, bool)
    if n:
        new[0] = True
    for k in keys:
        v = ints(t, k)
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def matrix(t: pa.Table, name: str, width: int) -> np.ndarray:
    """A list column as ``[rows, width]`` float64; null cells, null elements and missing positions become NaN."""
    col = t.column(name).combine_chunks()
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], t.schema.field(name).type)
    n = len(col)
    out = np.full((n, width), np.nan)
    if not n:
        return out
    lengths = col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = col.flatten().cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return flat.reshape(n, width).astype(np.float64)
    ends = np.cumsum(lengths)
    row = np.repeat(np.arange(n), lengths)
    pos = np.arange(len(flat)) - np.repeat(ends - lengths, lengths)
    keep = pos < width
    out[row[keep], pos[keep]] = flat[keep]
    return out
