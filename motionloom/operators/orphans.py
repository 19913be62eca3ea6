"""References to records that do not exist (problem 5).

Keyed pending-orphan state: per key the parent events (begin, end) and the references are folded in time order.
The fold carries how many parents of the key live, whether one has ended and whether the key is known at all; a
reference met while none lives becomes a pending orphan, a later begin resolves it, an end lets later references
become orphans again. A key with more than ``FOLD_ROWS`` references is spread over as many folds as its number asks for,
each with a copy of the key's few parent events, so a key that holds a third of all references is not one task.

``advance`` keeps the state between batches: new references are probed against the parent index, and only the
references of keys whose parents changed are probed again (arrivals resolve, deletions reopen).

Kinds: ``missing`` (no parent with that key is known), ``deleted`` (one ended at or before the reference's time),
``late`` (all known ones begin later). A parent lives from its begin (inclusive) to its end (exclusive, null: no
end).

Defined results: references with a null key, record or time are ignored; parents with a null key are ignored; a
null begin counts as the earliest time; a parent that ends no later than it begins never lives but counts as ended;
repeated parent rows count once; an empty parent table makes every reference ``missing``; empty references give
no rows; extra columns of either side are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionloom.session import bounded_broadcast, checkpointed

FOLD_ROWS = 100_000
#: Keys of more than ``FOLD_ROWS`` references are broadcast up to this many.
MAX_HOT_KEYS = 100_000
_KEY = ["ref_field", "key"]


def references(rows: DataFrame, name: str, record: str, fields: tuple[str, ...], at: str) -> DataFrame:
    """Long form ``(ref_table, ref_field, key, record_id, at)`` of the reference columns of one table."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("ref_field"), F.col(f).cast("long").alias("key")) for f in fields]))
    out = rows.select(F.lit(name).alias("ref_table"), pairs.alias("_p"), F.col(record).cast("long").alias("record_id"), F.col(at).cast("timestamp").alias("at"))
    return out.select("ref_table", "_p.ref_field", "_p.key", "record_id", "at").where(F.col("key").isNotNull() & F.col("record_id").isNotNull() & F.col("at").isNotNull())


def parents(rows: DataFrame, field: str, begins: str, ends: str) -> DataFrame:
    """Distinct ``(ref_field, key, begins, ends)`` of one target table."""
    return rows.where(F.col(field).isNotNull()).select(F.lit(field).alias("ref_field"), F.col(field).cast("long").alias("key"), F.col(begins).cast("timestamp").alias("begins"), F.col(ends).cast("timestamp").alias("ends")).distinct()


def _event(at: Column, rank: int, alive: Column, ended: int) -> Column:
    return F.struct(at.alias("at"), F.lit(rank).alias("rank"), alive.alias("alive"), F.lit(ended).alias("ended"))


def key_sizes(refs: DataFrame) -> DataFrame:
    """Number of references of each key; a caller that has them cheaper may pass its own, also with repeated rows counted."""
    return refs.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n"))


def with_folds(rows: DataFrame, hot: DataFrame | None, fold_rows: int) -> DataFrame:
    """Add ``folds``: over how many folds a row's key is spread."""
    if hot is None:
        return rows.withColumn("folds", F.lit(1))
    return rows.join(bounded_broadcast(hot.select(*_KEY, F.ceil(F.col("n") / F.lit(fold_rows)).cast("int").alias("_f")), MAX_HOT_KEYS), _KEY, "left").withColumn("folds", F.coalesce("_f", F.lit(1))).drop("_f")


def probe(refs: DataFrame, targets: DataFrame, sizes: DataFrame | None = None, fold_rows: int = FOLD_ROWS) -> DataFrame:
    """Pending orphans ``(ref_table, ref_field, key, record_id, at, kind, resolved_at)`` of the references."""
    hot = checkpointed((key_sizes(refs) if sizes is None else sizes).where(F.col("n") > fold_rows))  # counted once, few rows
    hot = None if hot.isEmpty() else hot
    first = F.timestamp_micros(F.lit(-62135596800000000))
    begins = F.coalesce("begins", first)
    lives = F.col("ends").isNull() | (F.col("ends") > begins)
    one, none = F.lit(1), F.lit(0)
    events = F.array(
        _event(F.lit(None).cast("timestamp"), 0, none, 0),  # sorts first: the key is known
        _event(begins, 1, F.when(lives, one).otherwise(none), 0),
        F.when(F.col("ends").isNotNull(), _event(F.col("ends"), 1, F.when(lives, -one).otherwise(none), 1)),
    )
    known = with_folds(targets, hot, fold_rows).withColumn("_e", F.explode(F.array_compact(events))).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("folds") - 1)))
    known = known.select(*_KEY, "salt", "_e.at", "_e.rank", "_e.alive", "_e.ended", F.lit(None).cast("long").alias("record_id"), F.lit(None).cast("string").alias("ref_table"))
    asked = with_folds(refs, hot, fold_rows).select(*_KEY, F.pmod(F.xxhash64("record_id"), F.col("folds")).cast("int").alias("salt"), "at", F.lit(2).alias("rank"), none.alias("alive"), F.lit(0).alias("ended"), "record_id", "ref_table")
    fold = Window.partitionBy(*_KEY, "salt").orderBy("at", "rank").rowsBetween(Window.unboundedPreceding, 0)
    rest = Window.partitionBy(*_KEY, "salt").orderBy(F.col("at").desc(), F.col("rank").desc()).rowsBetween(Window.unboundedPreceding, 0)
    rows = known.unionByName(asked)
    rows = rows.withColumn("_live", F.sum("alive").over(fold)).withColumn("_ended", F.max("ended").over(fold)).withColumn("_known", F.max(F.when(F.col("rank") == 0, 1).otherwise(0)).over(fold))
    rows = rows.withColumn("resolved_at", F.min(F.when(F.col("alive") == 1, F.col("at"))).over(rest))
    kind = F.when(F.col("_known") == 0, F.lit("missing")).when(F.col("_ended") == 1, F.lit("deleted")).otherwise(F.lit("late"))
    return rows.where((F.col("rank") == 2) & (F.col("_live") <= 0)).select("ref_table", *_KEY, "record_id", "at", kind.alias("kind"), "resolved_at")


@dataclass(frozen=True)
class OrphanState:
    """Parent index, references seen, and the orphans pending among them."""

    targets: DataFrame
    refs: DataFrame
    pending: DataFrame


def advance(state: OrphanState | None, new_refs: DataFrame, new_targets: DataFrame, sizes: DataFrame | None = None, fold_rows: int = FOLD_ROWS) -> OrphanState:
    """The state after a batch.

    ``new_targets`` has the parents that arrived or changed; a changed parent replaces those of the same key and
    begin. The caller stores the state's frames (a table, or a checkpoint) between batches.
    """
    if state is None:
        return OrphanState(new_targets, new_refs, probe(new_refs, new_targets, sizes, fold_rows))
    replaced = new_targets.select(*_KEY, "begins").distinct()
    on = [state.targets[c].eqNullSafe(replaced[c]) for c in (*_KEY, "begins")]
    targets = state.targets.join(replaced, on, "left_anti").unionByName(new_targets)
    changed = new_targets.select(*_KEY).distinct()
    again = state.refs.join(changed, _KEY, "left_semi").unionByName(new_refs)
    asked = again.select(*_KEY).distinct()
    pending = state.pending.join(changed, _KEY, "left_anti").unionByName(probe(again, targets.join(asked, _KEY, "left_semi"), None, fold_rows))
    return OrphanState(targets, state.refs.unionByName(new_refs), pending)


def snapshots(pending: DataFrame) -> DataFrame:
    """Per table, field and month of the record's time: orphans opened by kind, resolved, and pending at its end."""
    month = lambda c: F.date_trunc("month", F.col(c))
    opened = pending.select("ref_table", "ref_field", month("at").alias("month"), "kind", F.lit(1).alias("_n"), F.lit(0).alias("_r"))
    closed = pending.where(F.col("resolved_at").isNotNull()).select("ref_table", "ref_field", month("resolved_at").alias("month"), "kind", F.lit(0).alias("_n"), F.lit(1).alias("_r"))
    count = lambda k: F.sum(F.when(F.col("kind") == k, F.col("_n")).otherwise(0))
    per = opened.unionByName(closed).groupBy("ref_table", "ref_field", "month").agg(count("missing").alias("missing"), count("deleted").alias("deleted"), count("late").alias("late"), F.sum("_r").alias("resolved"))
    upto = Window.partitionBy("ref_table", "ref_field").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    balance = F.col("missing") + F.col("deleted") + F.col("late") - F.col("resolved")
    return per.withColumn("pending", F.sum(balance).over(upto))
