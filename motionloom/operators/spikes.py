"""Implausible spikes, frozen channels and unreachable values (problem 3).

Two passes over the frames, both cut by ``(episode, chunk)`` with ``HALO`` rows of overlap:

1. Per source and channel (field and component) a histogram of step sizes over all rows gives the source's
   normal motion (the ``SCALE_QUANTILE`` of its steps), and rows drawn by hash give a bounded sample of readings.
   An isolation forest per source is fitted on four features of that sample: ``level`` within the limits,
   ``difference`` (the smaller step to its two neighbours), ``seasonal`` (how far the reading leaves the course of
   the rows around it, where that course is resumed within ``MAX_SPIKE_ROWS`` rows) and ``run length``.
2. Every reading is scored. Reported are readings beyond the physical limits or infinite (``limit``), members of
   a run of ``FREEZE_ROWS`` or more equal values after its first (``frozen``, fields named in ``frozen_fields``),
   and readings off a resumed course whose forest score is at or above the source's cut (``spike``). How large a
   departure has to be is decided by the score alone: the cut is the score that a typical reading of the source would
   have if it left its course by ``SPIKE_RATIO`` normal steps.

Cuts of the trees may lie beyond the sample, up to ``ROOM`` cells above its largest value, so a reading further out
than any sampled one is isolated earlier the further out it lies. ``WEIGHTS`` says how often a feature is cut.
Features are put on a coarse grid before fitting and scoring, so a worker sends each distinct feature cell of a
source through the trees once and looks the score up afterwards.

Sources are surveyed and fitted together; models are taken to the tasks in buckets of about ``SOURCES_AT_ONCE``.

Defined results: rows without entity or order key are ignored; a repeated order key counts once, the earliest
``received_at`` first; null and NaN components are missing and no cases, and the rows around them are compared
across the gap; sources without limits have only infinite values as ``limit`` cases; an empty input gives no rows;
columns other than those named are not read. Rows more than ``HALO`` rows away in a neighbouring chunk are not
looked at, so a gap of missing values longer than that ends the course.
"""

from __future__ import annotations

import hashlib
import pickle
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motionloom.operators.chunks import CHUNK_ROWS, group_starts, in_slices, ints, matrix, whole_groups, with_halo
from motionloom.session import bounded_broadcast, checkpointed

HALO = 64
FREEZE_ROWS = 8
MAX_SPIKE_ROWS = 3
#: Departure, in normal steps, at which a typical reading reaches the cut.
SPIKE_RATIO = 5.7
#: The course counts as resumed if its ends differ by less than this share of the departure.
RESUME_RATIO = 0.5
SCALE_QUANTILE = 0.9
#: Readings per source the forest is fitted on (a bound, not a share of the data).
SAMPLE_READINGS = 4096
TREES, TREE_SAMPLE = 64, 256
#: Models that go to the tasks at once.
SOURCES_AT_ONCE = 500
MAX_BROADCAST_SOURCES = 100_000
#: Per feature (level, difference, seasonal, run length): how often it is cut, and how far above the sample.
WEIGHTS = (0.1, 0.1, 0.7, 0.1)
ROOM = (1.0, 16.0, 16.0, 1.0)
SEASONAL = 2
#: Share of the sample, its largest departures, that is left out of the fit, so that spikes cannot vouch for themselves.
TRIM = 0.005
STEP_BINS_PER_OCTAVE, STEP_BIN_LOW, STEP_BINS = 8, -40 * 8, 80 * 8


# --- isolation forest on gridded features -------------------------------------------------------------------


def fit_forest(x: np.ndarray, rng: np.random.Generator, trees: int = TREES, sample: int = TREE_SAMPLE) -> dict:
    """Trees as flat arrays: split feature (-1 in a leaf), threshold, and path length credited in a leaf."""
    depth = int(np.ceil(np.log2(max(2, min(sample, len(x))))))
    nodes = 2 ** (depth + 1) - 1
    feature = np.full((trees, nodes), -1, np.int8)
    cut = np.zeros((trees, nodes), np.float32)
    length = np.zeros((trees, nodes), np.float32)
    room = np.array(ROOM)
    for k in range(trees):
        chosen, place = rng.choice(len(WEIGHTS), nodes, p=WEIGHTS), rng.random(nodes)
        rows = rng.choice(len(x), min(sample, len(x)), replace=False)
        stack = [(0, 0, x[rows])]
        while stack:
            node, d, part = stack.pop()
            if d == depth or not len(part):
                length[k, node] = d + average_path(len(part))
                continue
            f = chosen[node]
            x_f = part[:, f]
            lo = x_f.min()
            c = lo + place[node] * (x_f.max() + room[f] - lo)
            feature[k, node], cut[k, node] = f, c
            right = x_f > c
            stack.append((2 * node + 1, d + 1, part[~right]))
            stack.append((2 * node + 2, d + 1, part[right]))
    return {"feature": feature, "cut": cut, "length": length, "depth": depth, "norm": max(average_path(min(sample, len(x))), 1e-9)}


def average_path(n: int) -> float:
    """Mean path of an unsuccessful search in a binary search tree of n entries."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def score_forest(forest: dict, x: np.ndarray) -> np.ndarray:
    """Anomaly score in (0, 1]; higher is more isolated."""
    trees, nodes = forest["feature"].shape
    feature, cut, length = forest["feature"].ravel(), forest["cut"].ravel(), forest["length"].ravel()
    flat, width = np.ascontiguousarray(x, np.float32).ravel(), x.shape[1]
    total = np.zeros(len(x))
    for at in range(0, len(x), 4096):
        n = min(4096, len(x) - at)
        root = (np.arange(trees) * nodes)[:, None]
        row = (np.arange(at, at + n) * width)[None, :]
        node = np.zeros((trees, n), np.int64)
        for _ in range(forest["depth"]):
            f = feature[root + node]
            right = flat[row + np.maximum(f, 0)] > cut[root + node]
            node = np.where(f >= 0, 2 * node + 1 + right, node)
        total[at : at + n] = length[root + node].sum(axis=0)
    return np.exp2(-total / trees / forest["norm"])


#: Cells of the feature grid: level, difference, seasonal, run length.
GRID = (18, 41, 41, 13)
_KNOWN_SCORES: OrderedDict[str, np.ndarray] = OrderedDict()
_MOST_KNOWN = 64


def cell_scores(forest: dict, x: np.ndarray) -> np.ndarray:
    """Scores of gridded readings; a worker sends each cell of the grid through a source's trees once."""
    known = _KNOWN_SCORES.get(forest["id"])
    if known is None:
        known = _KNOWN_SCORES[forest["id"]] = np.full(int(np.prod(GRID)), np.nan, np.float32)
        if len(_KNOWN_SCORES) > _MOST_KNOWN:
            _KNOWN_SCORES.popitem(last=False)
    else:
        _KNOWN_SCORES.move_to_end(forest["id"])
    code = np.ravel_multi_index(tuple(x.T.astype(np.int64)), GRID)
    out = known[code]
    new = np.flatnonzero(np.isnan(out))
    if len(new):
        cells, first = np.unique(code[new], return_index=True)
        known[cells] = score_forest(forest, x[new[first]])
        out = known[code]
    return out.astype(np.float64)


# --- features of one channel --------------------------------------------------------------------------------


def run_lengths(y: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Length of the run of equal values each row belongs to, and whether the row is the run's first."""
    first = new.copy()
    first[1:] |= y[1:] != y[:-1]
    starts = np.flatnonzero(first)
    return np.repeat(np.diff(np.append(starts, len(y))), np.diff(np.append(starts, len(y)))), first


def smaller_steps(y: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The smaller of the steps from the row before and to the row after; zero for a row alone."""
    step = np.full(len(y) + 1, np.inf)
    step[1:-1] = np.where(new[1:], np.inf, np.abs(np.diff(y)))
    out = np.minimum(step[:-1], step[1:])
    return np.where(np.isinf(out), 0.0, out)


def departures(y: np.ndarray, group: np.ndarray) -> np.ndarray:
    """How far each row leaves the course of the rows around it that is resumed within ``MAX_SPIKE_ROWS`` rows, else zero."""
    n = len(y)
    out = np.zeros(n)
    for rows in range(1, MAX_SPIKE_ROWS + 1):
        if n < rows + 2:
            break
        before, after = y[: n - rows - 1], y[rows + 1 :]
        away = np.full(n - rows - 1, np.inf)
        for k in range(1, rows + 1):
            course = before + (after - before) * (k / (rows + 1))
            away = np.minimum(away, np.abs(y[k : n - rows - 1 + k] - course))
        hit = (group[: n - rows - 1] == group[rows + 1 :]) & (np.abs(after - before) < RESUME_RATIO * away)
        away = np.where(hit, away, 0.0)
        for k in range(1, rows + 1):
            np.maximum(out[k : n - rows - 1 + k], away, out=out[k : n - rows - 1 + k])
    return out


def on_grid(ratio: np.ndarray) -> np.ndarray:
    """Half octaves of a ratio to the normal step, from 0 (tiny) to 40."""
    with np.errstate(divide="ignore"):
        return np.clip(np.floor(2 * np.log2(np.maximum(ratio, 1e-12))) + 10, 0, 40)


def gridded(y: np.ndarray, step: np.ndarray, away: np.ndarray, length: np.ndarray, low: np.ndarray, high: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """The features of readings as cells of the grid."""
    span = np.where(high > low, high - low, 1.0)
    with np.errstate(invalid="ignore"):
        level = np.clip(np.floor(np.nan_to_num((y - low) / span, nan=0.5) * 16), -1, 16) + 1
    return np.stack([level, on_grid(step / scale), on_grid(away / scale), np.minimum(np.floor(np.log2(np.maximum(length, 1))), 12)], axis=1)


# --- passes over slices -------------------------------------------------------------------------------------


class _Slices:
    """Slices of one Arrow table: dictionary-coded sources, channels as matrices."""

    def __init__(self, t: pa.Table, fields: tuple[str, ...], width: int) -> None:
        self.table, self.order = t, ints(t, "ord")
        starts = group_starts(t, ["entity", "chunk"])
        self.group = np.zeros(t.num_rows, np.int64)
        self.group[starts[1:]] = 1
        self.group = np.cumsum(self.group)
        self.own = ~t.column("is_halo").combine_chunks().to_numpy(zero_copy_only=False).astype(bool)
        code = t.column("source").combine_chunks().dictionary_encode()
        code = code.combine_chunks() if isinstance(code, pa.ChunkedArray) else code
        self.sources = code.dictionary.to_pylist()
        self.source = code.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.values = {f: matrix(t, f, width) for f in fields}
        self.low, self.high = matrix(t, "low", width), matrix(t, "high", width)


def step_bin(step: np.ndarray) -> np.ndarray:
    """Histogram bin of a positive step: eighths of octaves."""
    return np.clip(np.floor(np.log2(step) * STEP_BINS_PER_OCTAVE), STEP_BIN_LOW, STEP_BIN_LOW + STEP_BINS - 1).astype(np.int64) - STEP_BIN_LOW


def _hash01(keys: np.ndarray) -> np.ndarray:
    """A uniform number in [0, 1) of each integer key (multiply-shift mixing)."""
    x = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return (x >> np.uint64(11)).astype(np.float64) / 2.0**53


STATS_SCHEMA = "source string, channel int, bin int, n long, reading array<double>"


def _survey(batches: Iterator[pa.RecordBatch], fields: tuple[str, ...], width: int) -> Iterator[pa.RecordBatch]:
    """Step histograms by source and channel, and sampled readings with the rows around them."""
    hist: dict[tuple[str, int], np.ndarray] = {}
    for t in whole_groups(batches, ["entity", "chunk"]):
        s = _Slices(t, fields, width)
        rate = s.table.column("rate").combine_chunks().to_numpy(zero_copy_only=False)
        src_out, ch_out, reading_out = [], [], []
        for fi, f in enumerate(fields):
            for c in range(width):
                x = s.values[f][:, c]
                with np.errstate(invalid="ignore"):
                    ok = np.flatnonzero(np.isfinite(x) & ~((x < s.low[:, c]) | (x > s.high[:, c])))
                if len(ok) < 2:
                    continue
                y, g, src = x[ok], s.group[ok], s.source[ok]
                step = np.abs(np.diff(y))
                use = (g[1:] == g[:-1]) & s.own[ok][1:] & (step > 0)
                key = src[1:][use] * STEP_BINS + step_bin(step[use])
                counts = np.bincount(key, minlength=len(s.sources) * STEP_BINS).reshape(-1, STEP_BINS)
                for k, name in enumerate(s.sources):
                    if counts[k].any():
                        hist[name, fi * width + c] = hist.get((name, fi * width + c), 0) + counts[k]
                drawn = np.flatnonzero(s.own[ok] & (_hash01(s.order[ok] * 64 + fi * width + c) < rate[ok]))
                if not len(drawn):
                    continue
                new = np.ones(len(y), bool)
                new[1:] = g[1:] != g[:-1]
                length, _ = run_lengths(y, new)
                seen = np.stack([y, smaller_steps(y, new), departures(y, g), length, s.low[ok, c], s.high[ok, c]], axis=1)[drawn]
                src_out += [s.sources[k] for k in src[drawn]]
                ch_out += [fi * width + c] * len(drawn)
                reading_out += seen.tolist()
        if src_out:
            yield pa.RecordBatch.from_pydict({"source": pa.array(src_out, pa.string()), "channel": pa.array(ch_out, pa.int32()), "bin": pa.nulls(len(src_out), pa.int32()), "n": pa.array(np.ones(len(src_out), np.int64)), "reading": pa.array(reading_out, pa.list_(pa.float64()))})
    src, ch, bins, n = [], [], [], []
    for (name, channel), counts in hist.items():
        at = np.flatnonzero(counts)
        src += [name] * len(at)
        ch += [channel] * len(at)
        bins += at.tolist()
        n += counts[at].tolist()
    if src:
        yield pa.RecordBatch.from_pydict({"source": pa.array(src, pa.string()), "channel": pa.array(ch, pa.int32()), "bin": pa.array(bins, pa.int32()), "n": pa.array(n, pa.int64()), "reading": pa.nulls(len(src), pa.list_(pa.float64()))})


def cut_of(forest: dict, x: np.ndarray) -> float:
    """The score of a typical reading of the sample, had it left its course by ``SPIKE_RATIO`` normal steps."""
    probe = x.copy()
    probe[:, SEASONAL] = on_grid(np.array([SPIKE_RATIO]))[0]
    return float(np.median(score_forest(forest, probe).astype(np.float32)))


def _fit_source(pdf: pd.DataFrame, channels: int, seed: int) -> pd.DataFrame:
    """The model of one source from its histograms and sampled readings."""
    source = pdf["source"].iloc[0]
    scale = np.full(channels, np.nan)
    hist = pdf[pdf["bin"].notna()]
    for ch, h in hist.groupby("channel"):
        h = h.sort_values("bin")
        cum = h["n"].cumsum().to_numpy()
        b = h["bin"].to_numpy()[np.searchsorted(cum, SCALE_QUANTILE * cum[-1])]
        scale[int(ch)] = 2.0 ** ((b + STEP_BIN_LOW + 0.5) / STEP_BINS_PER_OCTAVE)
    known = scale[~np.isnan(scale)]
    scale = np.where(np.isnan(scale), known.max() if len(known) else 1.0, scale)
    drawn = pdf[pdf["reading"].notna()]
    if len(drawn):
        times = drawn["n"].to_numpy().astype(np.int64)
        ch = np.repeat(drawn["channel"].to_numpy(), times)
        r = np.repeat(np.array(drawn["reading"].tolist(), float), times, axis=0)
        x = gridded(*r.T, scale[ch])
        x = x[np.lexsort((*np.delete(x, SEASONAL, axis=1).T, x[:, SEASONAL]))]
        x = x[: max(1, len(x) - int(np.ceil(TRIM * len(x))))]
    else:
        x = np.zeros((1, 4))
    forest = fit_forest(x, np.random.default_rng(seed))
    forest["scale"] = scale
    forest["at"] = cut_of(forest, x)
    forest["id"] = hashlib.sha256(pickle.dumps((source, forest))).hexdigest()
    return pd.DataFrame({"source": [source], "model": [pickle.dumps(forest)]})


FOUND_SCHEMA = "source string, record_id long, field string, component long, score double, reason string"


def _score(batches: Iterator[pa.RecordBatch], fields: tuple[str, ...], frozen_fields: tuple[str, ...], width: int, joints: int, models: dict[str, dict]) -> Iterator[pa.RecordBatch]:
    empty = {"scale": np.ones(len(fields) * width), "at": np.inf, "id": "empty", **fit_forest(np.zeros((1, 4)), np.random.default_rng(0))}
    for t in whole_groups(batches, ["entity", "chunk"]):
        s = _Slices(t, fields, width)
        scales = np.stack([models.get(n, empty)["scale"] for n in s.sources])
        cuts = np.array([models.get(n, empty)["at"] for n in s.sources])
        for fi, f in enumerate(fields):
            for c in range(width):
                x = s.values[f][:, c]
                with np.errstate(invalid="ignore"):
                    beyond = np.isinf(x) | (x < s.low[:, c]) | (x > s.high[:, c])
                present = np.flatnonzero(~np.isnan(x))
                if not len(present):
                    continue
                reason = np.full(len(x), "", object)
                score = np.zeros(len(x))
                ok = present[~beyond[present]]
                y, g = x[ok], s.group[ok]
                sc = scales[s.source[ok], fi * width + c]
                if len(ok):
                    new = np.ones(len(y), bool)
                    new[1:] = g[1:] != g[:-1]
                    away = departures(y, g)
                    feats = gridded(y, smaller_steps(y, new), away, run_lengths(y, new)[0], s.low[ok, c], s.high[ok, c], sc)
                    for k, name in enumerate(s.sources):
                        of = np.flatnonzero(s.source[ok] == k)
                        if len(of):
                            score[ok[of]] = cell_scores(models.get(name, empty), feats[of])
                    if c < joints:
                        spike = (away > 0) & (score[ok] >= cuts[s.source[ok]])
                        reason[ok[spike]] = "spike"
                if f in frozen_fields and c < joints:
                    new = np.ones(len(x), bool)
                    new[1:] = s.group[1:] != s.group[:-1]
                    length, first = run_lengths(x, new)  # NaN differs from NaN, so missing values end a run
                    reason[(length >= FREEZE_ROWS) & ~first & ~np.isnan(x)] = "frozen"
                reason[beyond] = "limit"
                score[beyond] = 1.0
                out = np.flatnonzero((reason != "") & s.own)
                if len(out):
                    yield pa.RecordBatch.from_pydict(
                        {
                            "source": pa.array([s.sources[k] for k in s.source[out]], pa.string()),
                            "record_id": pa.array(s.order[out]),
                            "field": pa.array([f] * len(out), pa.string()),
                            "component": pa.array(np.full(len(out), c, np.int64)),
                            "score": pa.array(score[out]),
                            "reason": pa.array(reason[out].tolist(), pa.string()),
                        }
                    )


def implausible_readings(
    rows: DataFrame,
    chunks: DataFrame,
    width: int,
    joints: int,
    fields: tuple[str, ...] = ("state", "action"),
    frozen_fields: tuple[str, ...] = ("state",),
    chunk_rows: int = CHUNK_ROWS,
    entity: str = "episode_index",
    order: str = "global_index",
    source: str = "robot_id",
    low: str = "joint_low",
    high: str = "joint_high",
    received: str = "received_at",
    sample_readings: int = SAMPLE_READINGS,
    seed: int = 17,
) -> DataFrame:
    """Flagged readings ``(source, record_id, field, component, score, reason)``.

    ``chunks`` has per ``(entity, chunk)`` the number of rows ``n_rows``, the source and its limits. The first
    ``joints`` of ``width`` components can spike or freeze; all have limits.
    """
    spark = rows.sparkSession
    readings = len(fields) * width
    named = chunks.where(F.col(source).isNotNull())
    rates = named.groupBy(F.col(source).alias("source")).agg(F.least(F.lit(1.0), F.lit(float(sample_readings)) / (F.greatest(F.sum("n_rows"), F.lit(1)) * readings)).alias("rate"))
    side = named.select(F.col(entity).cast("long").alias("entity"), "chunk", F.col(source).alias("source"), F.col(low).alias("low"), F.col(high).alias("high"))
    plain = rows.where(F.col(entity).isNotNull() & F.col(order).isNotNull()).select(F.col(entity).cast("long").alias("entity"), F.col(order).cast("long").alias("ord"), F.col(received).alias("rec"), *fields)
    halo = with_halo(plain, "ord", HALO, chunk_rows, "entity")

    def sliced(side: DataFrame) -> DataFrame:
        return in_slices(halo.join(side, ["entity", "chunk"]), "entity", "chunk")

    stats = sliced(side.join(bounded_broadcast(rates, MAX_BROADCAST_SOURCES), "source")).mapInArrow(lambda it: _survey(it, fields, width), STATS_SCHEMA)
    stats = stats.groupBy("source", "channel", "bin", "reading").agg(F.sum("n").alias("n"))
    # A number of partitions is asked for, so that small inputs are not put together and fitted one after the other.
    stats = stats.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "source")
    models = checkpointed(stats.groupBy("source").applyInPandas(lambda pdf: _fit_source(pdf, readings, seed), "source string, model binary"))
    buckets = max(1, -(-models.count() // SOURCES_AT_ONCE))
    bucket = F.pmod(F.xxhash64("source"), F.lit(buckets))
    out = None
    for b in range(buckets):
        here = {r[0]: pickle.loads(r[1]) for r in models.where(bucket == b).collect()}  # about SOURCES_AT_ONCE models of a fixed size
        shared = spark.sparkContext.broadcast(here)
        found = sliced(side.where(bucket == b)).mapInArrow(lambda it, m=shared: _score(it, fields, frozen_fields, width, joints, m.value), FOUND_SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out
