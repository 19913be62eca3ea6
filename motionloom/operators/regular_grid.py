"""Irregular readings onto a regular grid (problem 1).

Every reading becomes a step-function interval: it holds from its time until the next reading of the same
entity, at most ``hold`` periods. The intervals are intersected with the grid cells (cell ``k`` reaches from
``k - 1/2`` to ``k + 1/2`` periods after the entity's first reading), which gives per cell the time-weighted
average of each component, the covered fraction, and the number of intervals that begin in it.

Entities are cut into blocks of ``BLOCK_SLOTS`` cells; readings of the last ``ceil(hold) + 1`` cells of a block
are also sent to the next block, so a block is computed on its own and no entity is a single task.

Defined results: readings without entity, order key or finite time are ignored; an entity without a positive
finite rate gives no cells; an empty input gives no cells; a repeated order key counts once, the one received first; readings at one
instant share it (all but the last have an empty interval, which still fills the cell); null, NaN and infinite
components have no weight in their average, and an average without weight is null. Columns other than those
named are not read, so extra or clashing columns do no harm.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionloom.operators.chunks import CHUNK_ROWS, chunk_of, chunk_sizes

BLOCK_SLOTS = 4096


def finite(c: Column) -> Column:
    """True for a value that is neither null, NaN nor infinite."""
    return F.coalesce(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), F.lit(False))


def regular_grid(
    readings: DataFrame,
    rates: DataFrame,
    width: int = 0,
    hold: float = 2.0,
    block_slots: int = BLOCK_SLOTS,
    chunk_rows: int = CHUNK_ROWS,
    entity: str = "episode_index",
    order: str = "global_index",
    time: str = "t",
    values: str = "state",
    rate: str = "fps",
    received: str = "received_at",
) -> DataFrame:
    """Cells ``(entity, slot, n_readings, coverage, status, series)`` from 0 to each entity's last filled cell.

    ``rates`` has one row per entity to be gridded, with its rate in cells per second. ``status`` is
    ``observed`` (a reading begins in the cell), ``held`` (an earlier reading covers part of it) or ``missing``.
    ``series`` holds the time-weighted averages of the first ``width`` components.
    """
    if hold <= 0 or block_slots <= math.ceil(hold) + 1:
        raise ValueError("hold must be positive and shorter than a block")
    halo = math.ceil(hold) + 1
    comps = [f"_v{i}" for i in range(width)]
    vals = [F.get(F.col(values), F.lit(i)).cast("double").alias(c) for i, c in enumerate(comps)]
    r = readings.where(F.col(entity).isNotNull() & F.col(order).isNotNull() & finite(F.col(time)))
    r = r.select(F.col(entity).alias("_e"), F.col(order).alias("_o"), F.col(time).cast("double").alias("_t"), F.col(received).alias("_rec"), *vals)
    known = rates.where(finite(F.col(rate)) & (F.col(rate) > 0)).select(F.col(entity).alias("_e"), F.col(rate).cast("double").alias("_rate"))

    whole = Window.partitionBy("_e")
    spans = chunk_sizes(r, "_e", "_o", chunk_rows, lo=F.min("_t"), hi=F.max("_t")).join(known, "_e")
    spans = spans.withColumn("_t0", F.min("lo").over(whole))
    spans = spans.withColumn("_last", F.rint((F.max("hi").over(whole) - F.col("_t0")) * F.col("_rate")).cast("long"))

    tau = (F.col("_t") - F.col("_t0")) * F.col("_rate")
    rows = (
        r.withColumn("chunk", chunk_of(F.col("_o"), chunk_rows))
        .join(spans.select("_e", "chunk", "_t0", "_rate", "_last"), ["_e", "chunk"])
        .select("_e", "_o", "_last", tau.alias("_tau"), F.rint(tau).cast("long").alias("_slot"), "_rec", *comps)
    )
    own = F.floor(F.col("_slot") / F.lit(block_slots)).cast("long")
    late = F.col("_slot") - own * F.lit(block_slots) >= block_slots - halo
    more = own < F.floor(F.col("_last") / F.lit(block_slots))
    rows = rows.withColumn("_block", F.explode(F.when(late & more, F.array(own, own + 1)).otherwise(F.array(own)))).withColumn("_edge", F.lit(False))
    edges = (
        spans.where(F.col("_last").isNotNull())
        .select("_e", "_last")
        .distinct()
        .select("_e", F.lit(None).cast("long").alias("_o"), "_last", F.lit(None).cast("double").alias("_tau"), F.lit(None).cast("long").alias("_slot"), F.lit(None).cast(dict(readings.dtypes)[received]).alias("_rec"), *[F.lit(None).cast("double").alias(c) for c in comps], F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("_last") / F.lit(block_slots)).cast("long"))).alias("_block"))
        .withColumn("_edge", F.lit(True))
    )
    rows = rows.unionByName(edges).repartition("_e", "_block")

    in_time = Window.partitionBy("_e", "_block").orderBy("_edge", "_tau", "_o", F.col("_rec").asc_nulls_last())
    rows = rows.withColumn("_same", F.lag("_o").over(in_time).eqNullSafe(F.col("_o")) & ~F.col("_edge"))
    rows = rows.where(~F.col("_same")).withColumn("_next", F.lead("_tau").over(in_time))  # of rows that count, so a repeated row ends no interval
    first = F.col("_block") * F.lit(block_slots)
    final = F.least(first + F.lit(block_slots - 1), F.col("_last"))
    until = F.least(F.coalesce(F.col("_next"), F.lit(float("inf"))), F.col("_tau") + F.lit(float(hold)))
    reached = F.least(F.greatest(F.ceil(until - F.lit(0.5)).cast("long"), F.col("_slot")), final)
    touched = F.when(F.col("_edge"), F.array_distinct(F.array(first, final))).when(reached >= F.greatest(F.col("_slot"), first), F.sequence(F.greatest(F.col("_slot"), first), reached))
    cells = rows.withColumn("_until", until).select("_e", "_block", "_edge", "_tau", "_slot", "_until", *comps, F.explode(touched).alias("slot"))
    half = F.lit(0.5)
    weight = F.greatest(F.least(F.col("_until"), F.col("slot") + half) - F.greatest(F.col("_tau"), F.col("slot") - half), F.lit(0.0))
    cells = cells.withColumn("_w", F.when(F.col("_edge"), F.lit(0.0)).otherwise(weight))
    begins = F.when(~F.col("_edge") & (F.col("_slot") == F.col("slot")), 1).otherwise(0)
    weighed = [F.when(finite(F.col(c)) & (F.col("_w") > 0), F.col("_w")) for c in comps]
    cells = cells.groupBy("_e", "_block", "slot").agg(
        F.sum(begins).alias("n_readings"),
        F.least(F.sum("_w"), F.lit(1.0)).alias("coverage"),
        *[F.try_divide(F.sum(w * F.col(c)), F.sum(w)).alias(c) for c, w in zip(comps, weighed)],
    )
    in_block = Window.partitionBy("_e", "_block").orderBy("slot")
    until_next = F.coalesce(F.lead("slot").over(in_block), F.col("slot") + 1) - 1
    cells = cells.withColumn("_to", until_next).withColumn("_at", F.explode(F.sequence("slot", "_to")))
    hit = F.col("_at") == F.col("slot")
    n = F.when(hit, F.col("n_readings")).otherwise(F.lit(0)).cast("long")
    cover = F.when(hit, F.col("coverage")).otherwise(F.lit(0.0))
    status = F.when(n > 0, F.lit("observed")).when(cover > 0, F.lit("held")).otherwise(F.lit("missing"))
    series = F.array(*[F.when(hit, F.col(c)) for c in comps]) if comps else F.array().cast("array<double>")
    return cells.select(F.col("_e").alias(entity), F.col("_at").alias("slot"), n.alias("n_readings"), cover.alias("coverage"), status.alias("status"), series.alias("series"))
