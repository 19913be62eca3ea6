"""Mixing sources to target weights (problem 8).

Low-discrepancy schedule: slot ``i`` of the mix has the golden-ratio point ``frac((i + 1) / phi)``, which the
cumulative target shares map to a source; a source's slots are numbered in order, and its ``r``-th slot takes
tokens ``r * block`` to ``(r + 1) * block`` of the source's shuffled token stream, repeated ``max_repeats`` times at
most. So every prefix of the mix holds the shares up to a few blocks. Slots beyond what a source can give stay
empty and show in the report.

A source is reported short if its scheduled slots, give or take the schedule's discrepancy, need more than the source can
give, and the exact token counts confirm it.

Tokens are counted where the documents lie and once; repeated rows are then told by 128 bits of hash of their whole
content, so no text is shuffled. Ranks and token positions are prefix sums in two levels (chunks of slots, hash ranges of documents), so neither a
large source nor the schedule is one task.

Defined results: repeated rows count once; documents with a null or blank source, or one without a target, take no
part; null and empty texts have no tokens; a source without documents or with ``max_repeats`` null or below one
gives nothing; shares that do not add up to one are scaled; empty tables give an empty mix; extra columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionloom.llm.tokens import VOCABULARY, with_token_counts
from motionloom.session import checkpointed

BLOCK_TOKENS = 1024
SLOTS_PER_CHUNK = 1 << 16
HASH_RANGES = 1024
#: The schedule gives a source its share of the first n slots up to log2(n) + DISCREPANCY slots.
DISCREPANCY = 3
#: The target table is read by the driver; more sources than this are refused.
MAX_SOURCES = 100_000
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)  # 2**64 / phi


def plain_source(c: Column) -> Column:
    """A source name in plain form: trimmed, lower case, one underscore between words."""
    return F.nullif(F.lower(F.regexp_replace(F.regexp_replace(c, r"(?U)^[\s_-]+|[\s_-]+$", ""), r"(?U)[\s_-]+", "_")), F.lit(""))


def sources_of_slots(chunk: int, total: int, cumulative: np.ndarray) -> np.ndarray:
    """Source number of each slot of a chunk of the schedule."""
    first = chunk * SLOTS_PER_CHUNK
    i = np.arange(first, min(first + SLOTS_PER_CHUNK, total), dtype=np.uint64)
    points = ((i + np.uint64(1)) * _GOLDEN >> np.uint64(11)).astype(np.float64) / 2.0**53
    return np.minimum(np.searchsorted(cumulative, points, "right"), len(cumulative) - 1)


class Mix:
    """A planned mix: ``report()`` and ``pieces()``."""

    def __init__(self, documents: DataFrame, targets: DataFrame, block: int = BLOCK_TOKENS, seed: int = 11, vocabulary: str | None = VOCABULARY) -> None:
        """``vocabulary`` is the tokenizer's file; with None sizes are counted in code points."""
        self.spark, self.block, self.seed = documents.sparkSession, block, seed
        row = [F.xxhash64(*[F.col(f"`{c}`") for c in documents.columns]), F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in reversed(documents.columns)])]
        docs = documents.where(F.col("doc_id").isNotNull())
        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), plain_source(F.col("source")).alias("source"), "text", F.array(*row).alias("row"))
        per_source = targets.where(F.col("target_share").isNotNull() & (F.col("target_share") > 0)).select(plain_source(F.col("source")).alias("source"), F.col("target_share").cast("double").alias("target_share"), F.coalesce(F.greatest(F.col("max_repeats"), F.lit(0)), F.lit(0)).cast("long").alias("max_repeats"))
        per_source = per_source.where(F.col("source").isNotNull()).groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
        found = per_source.limit(MAX_SOURCES + 1).collect()
        if len(found) > MAX_SOURCES:
            raise ValueError(f"more than {MAX_SOURCES} sources with a target")
        self.targets = sorted((r["source"], r["target_share"], r["max_repeats"]) for r in found)
        names = [t[0] for t in self.targets]
        small = self.spark.createDataFrame([(n,) for n in names], "source string")
        docs = docs.join(F.broadcast(small), "source", "left_semi")  # at most MAX_SOURCES rows
        counted = docs.select("doc_id", "source", "row", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_tokens")) if vocabulary is None else with_token_counts(docs, ("row",), path=vocabulary)
        self.sizes = checkpointed(counted.groupBy("doc_id", "row").agg(F.first("source").alias("source"), F.first("n_tokens").alias("n_tokens")).drop("row"))
        self.available = {r["source"]: r["n"] for r in self.sizes.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()} if names else {}
        self.total = sum(self.available.values())
        self.slots = -(-self.total // block)
        shares = np.array([t[1] for t in self.targets])
        self.cumulative = np.cumsum(shares / shares.sum()) if len(shares) else shares

    def _chunks(self, schema: str, rows) -> DataFrame:  # noqa: ANN001
        names, total, cumulative = [t[0] for t in self.targets], self.slots, self.cumulative

        def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for chunk in b.column(0).to_pylist():
                    yield rows(chunk, sources_of_slots(chunk, total, cumulative), names)

        n = -(-self.slots // SLOTS_PER_CHUNK)
        return self.spark.range(0, n, 1, max(1, min(n, 1000))).mapInArrow(generate, schema)

    def scheduled(self) -> DataFrame:
        """Slots per chunk of the schedule and source."""

        def rows(chunk: int, of: np.ndarray, names: list[str]) -> pa.RecordBatch:
            n = np.bincount(of, minlength=len(names))
            at = np.flatnonzero(n)
            return pa.RecordBatch.from_pydict({"chunk": pa.array(np.full(len(at), chunk, np.int64)), "source": pa.array([names[k] for k in at], pa.string()), "n": pa.array(n[at].astype(np.int64))})

        return self._chunks("chunk long, source string, n long", rows)

    def ranked(self) -> DataFrame:
        """Every slot with its source and its rank among the source's slots."""

        def rows(chunk: int, of: np.ndarray, names: list[str]) -> pa.RecordBatch:
            by = np.argsort(of, kind="stable")
            first = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(names)))[:-1]])
            rank = np.empty(len(of), np.int64)
            rank[by] = np.arange(len(of)) - first[of[by]]
            slot = chunk * SLOTS_PER_CHUNK + np.arange(len(of), dtype=np.int64)
            return pa.RecordBatch.from_pydict({"chunk": pa.array(np.full(len(of), chunk, np.int64)), "slot": pa.array(slot), "source": pa.array(np.array(names, object)[of], pa.string()), "_local": pa.array(rank)})

        before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
        offsets = self.scheduled().withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
        slots = self._chunks("chunk long, slot long, source string, _local long", rows)
        return slots.join(offsets, ["chunk", "source"]).select("slot", "source", (F.col("_local") + F.col("_before")).alias("rank"))

    def limits(self) -> list[tuple]:
        """Per source: share, repeats, tokens available, possible and needed."""
        return [(s, share, reps, self.available.get(s, 0), self.available.get(s, 0) * reps, share * self.total) for s, share, reps in self.targets]

    def report(self) -> DataFrame:
        """Per source with a target what was wanted, what is possible, and the shares reached by the schedule."""
        known = self.spark.createDataFrame(self.limits(), "source string, target_share double, max_repeats long, tokens_available long, tokens_possible long, tokens_needed double")
        slots = self.scheduled().groupBy("source").agg(F.sum("n").alias("slots"))
        out = known.join(slots, "source", "left").withColumn("slots", F.coalesce("slots", F.lit(0)))
        out = out.withColumn("tokens_mixed", F.least(F.col("slots") * self.block, F.col("tokens_possible")))
        out = out.withColumn("actual_share", F.try_divide(F.col("tokens_mixed").cast("double"), F.sum("tokens_mixed").over(Window.partitionBy(F.lit(1)))))  # one row per source
        out = out.withColumn("share_of_total", F.try_divide(F.col("tokens_mixed").cast("double"), F.lit(float(self.total))))
        most = (F.col("slots") + F.ceil(F.log2(F.lit(float(self.slots + 1)))) + DISCREPANCY) * self.block
        return out.withColumn("short", (most > F.col("tokens_possible")) & (F.col("tokens_possible") < F.col("tokens_needed")))

    def streams(self) -> DataFrame:
        """Documents with their token interval ``[start, stop)`` in their source's shuffled stream."""
        h = F.xxhash64(F.lit(self.seed), F.col("doc_id"))
        d = self.sizes.where(F.col("n_tokens") > 0).withColumn("_h", h).withColumn("_range", F.pmod(F.shiftrightunsigned("_h", 40), F.lit(HASH_RANGES)))
        earlier = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        offsets = d.groupBy("source", "_range").agg(F.sum("n_tokens").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
        within = Window.partitionBy("source", "_range").orderBy("_h", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
        d = d.withColumn("_upto", F.sum("n_tokens").over(within)).join(offsets, ["source", "_range"])
        stop = F.col("_before") + F.col("_upto")
        return d.select("source", "doc_id", (stop - F.col("n_tokens")).alias("start"), stop.alias("stop"))

    def pieces(self) -> DataFrame:
        """The mix: per slot the documents' token ranges ``(slot, source, repeat, doc_id, from_token, to_token)``."""
        per = self.spark.createDataFrame([(s, n, r) for s, _, r, n, _, _ in self.limits() if n and r], "source string, _length long, _repeats long")
        slots = self.scheduled().groupBy("source").agg(F.sum("n").alias("_slots"))
        per = per.join(slots, "source").withColumn("_epochs", F.least(F.col("_repeats"), F.ceil(F.col("_slots") * self.block / F.col("_length")))).select("source", "_length", "_epochs")
        b = F.lit(self.block)
        p = self.streams().join(F.broadcast(per), "source")  # at most MAX_SOURCES rows
        p = p.withColumn("repeat", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_epochs") - 1)))
        p = p.withColumn("_from", F.col("repeat") * F.col("_length") + F.col("start")).withColumn("_to", F.col("_from") + F.col("stop") - F.col("start"))
        p = p.withColumn("rank", F.explode(F.sequence(F.floor(F.col("_from") / b), F.floor((F.col("_to") - 1) / b))))
        p = p.join(self.ranked(), ["source", "rank"])
        begin = F.greatest(F.col("_from"), F.col("rank") * b)
        end = F.least(F.col("_to"), (F.col("rank") + 1) * b)
        return p.select("slot", "source", "repeat", "doc_id", (begin - F.col("_from")).alias("from_token"), (end - F.col("_from")).alias("to_token"))
