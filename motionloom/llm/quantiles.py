"""Percentiles of very large numeric columns (problem 4).

Deterministic buffer collapsing: values fill buffers of ``k`` sorted values of weight one; two full buffers of
weight ``w`` are merged and every second value becomes a buffer of weight ``2 w`` (first the odd, then the even
positions in turn). Buffers combine like the digits of a binary counter, so a summary of ``n`` values has at most
one full buffer per level, and each collapse of weight ``w`` moves any rank by at most ``w``; the sum of these is
kept, and is at most ``n log2(n / k) / (2 k)``. Summaries of partitions and days merge by the same rule, so the
whole is obtained from the days, with its own stated bound.

Rows are summarised where they lie, per source and day, before anything is shuffled by source. Partial summaries are
merged per ``(source, day, salt)``; then per source and span of ``SPAN_DAYS`` days, which gives the days' results and
one summary of the span; then the spans per source. Each merge is a stream with one or two summaries in memory, so the
largest task reads ``SPAN_DAYS * SALTS`` summaries of bounded size. Summaries carry the first slice they were made
from and are merged in its order, so equal inputs give equal results.

Defined results: null, NaN and infinite components are not counted; a repeated order key counts once, the earliest
``received_at`` first, whose day (UTC) it gets; rows without entity, order key, time or source are ignored; a
component without finite values gives no row; with fewer than ``k`` values results are exact; a quantile is the
smallest value whose rank reaches ``q n``; an empty input gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motionloom.operators.chunks import CHUNK_ROWS, chunk_of, floats, in_slices, ints, matrix, whole_groups
from motionloom.session import checkpointed

K = 4096
SALTS = 16
SPAN_DAYS = 16
#: Values a task holds before it hands its summaries on.
HELD_VALUES = 4_000_000


class Buffers:
    """A mergeable summary of one column."""

    def __init__(self, k: int = K) -> None:
        self.k, self.n, self.error = k, 0, 0
        self.raw: list[np.ndarray] = []
        self.raw_n = 0
        self.full: dict[int, list[np.ndarray]] = {}
        self.odd: dict[int, int] = {}

    def add(self, values: np.ndarray) -> None:
        """Count values (all finite)."""
        if len(values):
            self.n += len(values)
            self._take(values)

    def _take(self, values: np.ndarray) -> None:
        self.raw.append(values)
        self.raw_n += len(values)
        if self.raw_n >= self.k:
            v = np.concatenate(self.raw)
            cut = len(v) // self.k * self.k
            self.full.setdefault(0, []).extend(np.sort(b) for b in v[:cut].reshape(-1, self.k))
            self.raw, self.raw_n = [v[cut:]], len(v) - cut
            self._collapse()

    def _collapse(self) -> None:
        level = 0
        while level <= max(self.full, default=-1):
            here = self.full.get(level, [])
            while len(here) >= 2:
                both = np.sort(np.concatenate([here.pop(0), here.pop(0)]), kind="stable")
                first = self.odd.get(level, 1)
                self.odd[level] = 1 - first
                self.full.setdefault(level + 1, []).append(both[first::2])
                self.error += 1 << level
            level += 1

    def merge(self, other: Buffers) -> None:
        """Take up another summary."""
        self.n += other.n
        self.error += other.error
        for level, buffers in other.full.items():
            self.full.setdefault(level, []).extend(buffers)
        for v in other.raw:
            if len(v):
                self._take(v)
        self._collapse()

    def quantiles(self, qs: list[float]) -> list[float]:
        """Values at the given shares of all counted values."""
        parts = [(v, 1) for v in self.raw] + [(b, 1 << level) for level, bs in self.full.items() for b in bs]
        values = np.concatenate([v for v, _ in parts])
        weights = np.concatenate([np.full(len(v), w, np.int64) for v, w in parts])
        by = np.argsort(values, kind="stable")
        cum = np.cumsum(weights[by])
        at = np.minimum(np.searchsorted(cum, [max(q * self.n, 1) for q in qs], "left"), len(by) - 1)
        return [float(values[by[i]]) for i in at]

    def dump(self, dtype: str) -> tuple[list[int], list[np.ndarray]]:
        """Header numbers and value arrays."""
        raw = np.concatenate(self.raw) if self.raw else np.zeros(0)
        levels = sorted(level for level, bs in self.full.items() if bs)
        head = [self.n, self.error, len(raw), len(levels)]
        for level in levels:
            head += [level, len(self.full[level]), self.odd.get(level, 1)]
        return head, [raw.astype(dtype), *[b.astype(dtype) for level in levels for b in self.full[level]]]


def pack(summaries: list[Buffers], dtype: str) -> bytes:
    """Several summaries as bytes."""
    heads, arrays = [], []
    for s in summaries:
        h, a = s.dump(dtype)
        heads += h
        arrays += a
    return np.array([len(heads), *heads], np.int64).tobytes() + (np.concatenate(arrays).tobytes() if arrays else b"")


def unpack(data: bytes, width: int, dtype: str, k: int) -> list[Buffers]:
    """The summaries of :func:`pack`."""
    n = int(np.frombuffer(data, np.int64, 1)[0])
    head = np.frombuffer(data, np.int64, n, 8).tolist()
    values = np.frombuffer(data, dtype, -1, 8 * (n + 1))
    out, h, v = [], 0, 0
    for _ in range(width):
        s = Buffers(k)
        s.n, s.error, raw, levels = head[h : h + 4]
        h += 4
        s.raw, s.raw_n = [values[v : v + raw]], raw
        v += raw
        for _ in range(levels):
            level, count, s.odd[level] = head[h : h + 3]
            h += 3
            s.full[level] = [values[v + i * k : v + (i + 1) * k] for i in range(count)]
            v += count * k
        out.append(s)
    return out


_SUMMARY = "source string, day int, salt int, entity long, chunk long, quantile double, summary binary"
_SUMMARY_TYPES = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.binary())
_SUMMARY_NAMES = tuple(f.split()[0] for f in _SUMMARY.split(", "))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_SUMMARY_TYPES)], names=list(_SUMMARY_NAMES))


def _summarise(batches: Iterator[pa.RecordBatch], width: int, dtype: str, k: int) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, int, float], list[Buffers]] = {}
    n, first = 0, None

    def out() -> Iterator[pa.RecordBatch]:
        rows = [(src, day, (day + 7 * first[0] + first[1]) % SALTS, *first, q, pack(s, dtype)) for (src, day, q), s in held.items()]
        for a in range(0, len(rows), 200):
            yield _batch(rows[a : a + 200])

    for t in whole_groups(batches, ["entity", "chunk"]):
        first = first or (int(ints(t, "entity")[0]), int(ints(t, "chunk")[0]))
        vec, day, q = matrix(t, "vec", width), ints(t, "day"), floats(t, "quantile")
        code = t.column("source").combine_chunks().dictionary_encode()
        code = code.combine_chunks() if isinstance(code, pa.ChunkedArray) else code
        names, src = code.dictionary.to_pylist(), code.indices.to_numpy(zero_copy_only=False)
        by = np.lexsort((day, src))
        vec, day, q, src = vec[by], day[by], q[by], src[by]
        cuts = np.flatnonzero(np.concatenate([[True], (day[1:] != day[:-1]) | (src[1:] != src[:-1])])).tolist() + [len(by)]
        for a, b in zip(cuts, cuts[1:]):
            key = (names[src[a]], int(day[a]), float(q[a]))
            s = held.get(key)
            if s is None:
                s = held[key] = [Buffers(k) for _ in range(width)]
            part = vec[a:b]
            ok = np.isfinite(part)
            for c in range(width):
                s[c].add(part[ok[:, c], c])
        n += len(by) * width
        if n > HELD_VALUES:
            yield from out()
            held, n, first = {}, 0, None
    yield from out()


def _streams(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], width: int, dtype: str, k: int) -> Iterator[tuple[tuple, list[Buffers]]]:
    """First row and merged summaries of each key of a sorted stream."""
    now, kept, total = None, None, None
    at = [_SUMMARY_NAMES.index(c) for c in keys]
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in _SUMMARY_NAMES)):
            key, parts = tuple(row[i] for i in at), unpack(row[-1], width, dtype, k)
            if key != now:
                if total is not None:
                    yield kept, total
                now, kept, total = key, row, parts
            else:
                for s, p in zip(total, parts):
                    s.merge(p)
    if total is not None:
        yield kept, total


def _merged(batches: Iterator[pa.RecordBatch], width: int, dtype: str, k: int) -> Iterator[pa.RecordBatch]:
    """Summaries per source, day and salt."""
    for row, total in _streams(batches, ("source", "day", "salt"), width, dtype, k):
        yield _batch([(*row[:-1], pack(total, dtype))])


RESULT = "source string, day int, component long, n long, low double, median double, high double, rank_error double"
_SPANS = f"{RESULT}, span int, quantile double, summary binary"


def _found(row: tuple, summaries: list[Buffers], day: int | None, extra: tuple = ()) -> pa.RecordBatch:
    """Result rows of one source and day (null: all days), and a row for what is to be merged further."""
    source, q = row[0], row[5]
    rows = [] if day is None and extra else [(source, day, c, s.n, *s.quantiles([1 - q, 0.5, q]), s.error / s.n) for c, s in enumerate(summaries) if s.n]
    types = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    fields = [f.split() for f in (_SPANS if extra is not None else RESULT).split(", ")]
    rows = [(*r, *[None] * (len(fields) - len(r))) for r in rows] + ([(source, *[None] * 7, *extra)] if extra else [])
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], types[t]) for i, (_, t) in enumerate(fields)], names=[f for f, _ in fields])


def _days(batches: Iterator[pa.RecordBatch], width: int, dtype: str, k: int) -> Iterator[pa.RecordBatch]:
    """Results of each day, and the summary of each span of days, of a stream sorted by source and day."""
    now, first, whole = None, None, []
    for row, total in _streams(batches, ("source", "day"), width, dtype, k):
        yield _found(row, total, row[1])
        span = (row[0], row[1] // SPAN_DAYS)
        if span != now:
            if now is not None:
                yield _found(first, whole, None, (now[1], first[5], pack(whole, dtype)))
            now, first, whole = span, row, [Buffers(k) for _ in range(width)]
        for s, p in zip(whole, total):
            s.merge(p)
    if now is not None:
        yield _found(first, whole, None, (now[1], first[5], pack(whole, dtype)))


def _wholes(batches: Iterator[pa.RecordBatch], width: int, dtype: str, k: int) -> Iterator[pa.RecordBatch]:
    """Results of all days of each source, from its spans in order."""
    for row, total in _streams(batches, ("source",), width, dtype, k):
        yield _found(row, total, None, None)


def percentile_bounds(
    rows: DataFrame,
    sources: DataFrame,
    width: int,
    k: int = K,
    chunk_rows: int = CHUNK_ROWS,
    entity: str = "episode_index",
    order: str = "global_index",
    vector: str = "action",
    received: str = "received_at",
    source: str = "robot_id",
    quantile: str = "quantile",
) -> DataFrame:
    """Median and bounds per source, component and day, and over all days (``day`` null), with ``rank_error``.

    ``sources`` has per ``(entity, chunk)`` the source and its quantile; ``rank_error`` is the guaranteed largest
    error of a rank as a share of ``n``.
    """
    dtype = "<f4" if "array<float>" in dict(rows.dtypes)[vector] else "<f8"
    known = sources.where(F.col(source).isNotNull()).select(F.col(entity).cast("long").alias("entity"), "chunk", F.col(source).alias("source"), F.coalesce(F.col(quantile), F.lit(0.99)).cast("double").alias("quantile"))
    r = rows.where(F.col(entity).isNotNull() & F.col(order).isNotNull() & F.col(received).isNotNull())
    r = r.select(F.col(entity).cast("long").alias("entity"), chunk_of(F.col(order), chunk_rows).alias("chunk"), F.col(order).cast("long").alias("ord"), F.col(received).alias("rec"), F.unix_date(F.col(received).cast("date")).alias("day"), F.col(vector).alias("vec"))
    r = in_slices(r.join(known, ["entity", "chunk"]), "entity", "chunk")
    parts = r.mapInArrow(lambda it: _summarise(it, width, dtype, k), _SUMMARY)
    by = ("source", "day", "salt")
    parts = parts.repartition(*by).sortWithinPartitions(*by, "entity", "chunk").mapInArrow(lambda it: _merged(it, width, dtype, k), _SUMMARY)
    parts = parts.repartition("source", F.floor(F.col("day") / SPAN_DAYS)).sortWithinPartitions("source", "day", "salt")
    days = checkpointed(parts.mapInArrow(lambda it: _days(it, width, dtype, k), _SPANS))
    none = F.lit(0)
    spans = days.where(F.col("span").isNotNull()).select("source", F.col("span").alias("day"), none.alias("salt"), none.cast("long").alias("entity"), none.cast("long").alias("chunk"), "quantile", "summary")
    whole = spans.repartition("source").sortWithinPartitions("source", "day").mapInArrow(lambda it: _wholes(it, width, dtype, k), RESULT)
    out = days.where(F.col("span").isNull()).select(*whole.columns).unionByName(whole)
    return out.select(F.col("source").alias(source), F.date_from_unix_date("day").alias("day"), "component", "n", "low", "median", "high", "rank_error")


def rank_bounds_kept(rows: DataFrame, sources: DataFrame, bounds: DataFrame, width: int, entity: str = "episode_index", order: str = "global_index", vector: str = "action", received: str = "received_at", source: str = "robot_id", quantile: str = "quantile", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """For each row of ``bounds`` whether the true ranks of its three values lie within its stated error, by counting all values."""
    known = sources.where(F.col(source).isNotNull()).select(F.col(entity).alias("_e"), F.col("chunk").alias("_c"), F.col(source).alias("_source"), F.col(quantile).alias("_q"))
    once = rows.where(F.col(received).isNotNull()).groupBy(F.col(entity).alias("_e"), F.col(order).alias("_o")).agg(F.min_by(vector, received).alias("_v"), F.date_format(F.min(received), "yyyy-MM-dd").alias("_day"))
    x = once.withColumn("_c", chunk_of(F.col("_o"), chunk_rows)).join(known, ["_e", "_c"])
    x = x.select("_source", "_q", F.explode(F.array("_day", F.lit("all"))).alias("_d"), F.posexplode(F.slice("_v", 1, width)).alias("_k", "_x")).where(~F.isnan("_x") & (F.abs("_x") != float("inf")))
    b = bounds.select(F.col(source).alias("_source"), F.coalesce(F.col("day").cast("string"), F.lit("all")).alias("_d"), F.col("component").cast("int").alias("_k"), "low", "median", "high", "rank_error")
    counts = [F.count_if(test).alias(f"_{side}_{v}") for v in ("low", "median", "high") for side, test in (("below", F.col("_x") < F.col(v)), ("upto", F.col("_x") <= F.col(v)))]
    on = ["_source", "_d", "_k"]
    c = x.join(b, on).groupBy(*on, "_q", "rank_error").agg(F.count(F.lit(1)).alias("n"), *counts)
    share = {"low": 1 - F.col("_q"), "median": F.lit(0.5), "high": F.col("_q")}
    slack = F.col("rank_error") * F.col("n") + F.lit(1)
    kept = [((F.col(f"_below_{v}") <= q * F.col("n") + slack) & (F.col(f"_upto_{v}") >= q * F.col("n") - slack)).alias(f"{v}_kept") for v, q in share.items()]
    return c.select(F.col("_source").alias(source), F.when(F.col("_d") != "all", F.col("_d")).alias("day"), F.col("_k").cast("long").alias("component"), "n", *kept)
