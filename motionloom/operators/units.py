"""Quantities recorded in different units (problem 6).

Two hidden Markov models per device (robot and quantity), both decoded by Viterbi against a smooth level, the running
median of the device's log magnitudes in the common unit:

* Readings that say something: the states are "as stated" and, per unit, "in this unit whatever is stated". A note about
  the value or a unit beside its number belongs to the reading itself and holds in every state. A bare unit field or the
  device's declaration is weaker: it costs ``UNIT_WEIGHT`` or ``DECLARED_WEIGHT`` a reading to go against it and ``ENTER``
  to begin, while a reading that does not fit the level costs up to ``FLOOR``. So a statement is overruled where the level
  jumps for a stretch of readings and another unit fits them, and never by a single reading; ``overruled`` names it.
* Readings about whose unit nothing is said at all: the states are the units, transitions are sticky, and the log jumps
  against the level decide.

How far a magnitude may lie from the level is taken from the device's own spread.

Devices are cut into blocks of about ``BLOCK_READINGS`` readings by time, each with a short lead-in from the block
before, so a device that holds a third of all readings is not one task. What the texts say is looked up once for each
distinct text of a block.

Defined results: repeated rows count once; a reading without a number in ``value`` or ``value_text`` (null, NaN,
infinite, no digits) has a null common value; a reading whose quantity is unknown is left out; readings without a
robot form a device of their own without declaration; zero values carry no level; statements that name a unit of
another quantity, or a number with a unit inside a remark, say nothing; a device without any statement has no level and
its readings count as recorded in the common unit; an empty input gives no rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motionloom.operators.chunks import floats, group_starts, whole_groups
from motionloom.session import bounded_broadcast

# Quantity -> code -> factor to the common unit (the first code).
UNITS: dict[str, dict[str, float]] = {
    "joint_position": {"rad": 1.0, "deg": math.pi / 180, "mrad": 1e-3},
    "joint_velocity": {"rad/s": 1.0, "deg/s": math.pi / 180, "rpm": 2 * math.pi / 60},
    "joint_torque": {"Nm": 1.0, "mNm": 1e-3, "Ncm": 1e-2},
    "cartesian_position": {"m": 1.0, "mm": 1e-3, "cm": 1e-2, "in": 0.0254},
    "gripper_position": {"dimensionless": 1.0, "percent": 1e-2},
}
# Spellings after case folding, without spaces, middle dots, asterisks and a closing dot.
SPELLINGS: dict[str, tuple[str, ...]] = {
    "rad": ("rad", "radian", "radians", "radiant", "radianes"),
    "deg": ("deg", "degree", "degrees", "grad", "grados", "°"),
    "mrad": ("mrad", "milliradian", "milliradians", "milli-rad"),
    "rad/s": ("rad/s", "rad/sec", "rads^-1", "radianspersecond", "radians/s"),
    "deg/s": ("deg/s", "deg/sec", "degrees/s", "degreespersecond", "dps", "°/s"),
    "rpm": ("rpm", "rev/min", "r/min", "u/min"),
    "Nm": ("nm", "newtonmetre", "newtonmeter", "newtonmetres", "newtonmeters"),
    "mNm": ("mnm", "millinewtonmetre", "millinewtonmeter"),
    "Ncm": ("ncm", "newtoncentimetre", "newtoncentimeter"),
    "m": ("m", "meter", "metre", "meters", "metres", "metros"),
    "mm": ("mm", "millimeter", "millimetre", "millimeters", "millimetres"),
    "cm": ("cm", "centimeter", "centimetre", "centimeters", "centimetres"),
    "in": ("in", "inch", "inches", "zoll", "pulgadas"),
    "dimensionless": ("dimensionless", "ratio", "fraction", "1", "-"),
    "percent": ("percent", "pct", "%", "prozent", "porcentaje"),
}
# Words after which a note names the unit of the value.
CUES = ("in", "en", "is", "are", "prints", "numbers", "confirms", "unit:", "units:", "einheit:", "unidad:", "unit", "ist", "es")
# Control types that tell another quantity than their own name.
CONTROL_QUANTITY = {"delta_joint_position": "joint_position", "eef_pose": "cartesian_position"}

_CODE = {s: code for code, spellings in SPELLINGS.items() for s in spellings}
_NUMBER = re.compile(r"[-+−]?\d[\d.,]*(?:[eE][-+]?\d+)?")
_CUE = re.compile(r"(?<![\w])(?:" + "|".join(re.escape(c) for c in sorted(CUES, key=len, reverse=True)) + r")\s+(?=(\S.*))", re.S)

BLOCK_READINGS = 50_000
LEAD_IN = 64
MAX_DEVICES = 100_000
#: Costs in nats: of leaving "as stated", of returning to it, of a change between units, of going against a statement,
#: and the most that a magnitude off the level costs.
ENTER, RETURN, SWITCH, UNIT_WEIGHT, DECLARED_WEIGHT, FLOOR = 24.0, 4.0, 4.0, 2.5, 1.0, 6.0
#: The level is the median of so many readings on both sides, taken every so many readings.
LEVEL_SIDE, LEVEL_STEP = 512, 64
LEAST_SPREAD, MOST_SPREAD = 0.5, 2.0


@lru_cache(maxsize=100_000)
def unit_code(text: str | None, quantity: str) -> str | None:
    """The code a spelling stands for, if it is a unit of the quantity."""
    if text is None:
        return None
    plain = re.sub(r"[\s·*⋅]", "", unicodedata.normalize("NFKC", text).lower()).rstrip(".")
    code = _CODE.get(plain)
    return code if code in UNITS.get(quantity, ()) else None


@lru_cache(maxsize=100_000)
def note_code(note: str | None, quantity: str) -> str | None:
    """The unit of the value that a note states: a unit right after a cue word and before the phrase's end."""
    if not note:
        return None
    for m in _CUE.finditer(note):
        words = re.split(r"[,;()\n]", m[1], maxsplit=1)[0].split()
        for n in range(min(len(words), 4), 0, -1):
            if (code := unit_code(" ".join(words[:n]), quantity)) and (n == len(words) or words[n].lower() in ("here", "hier", "aquí", "not", "by", "for")):
                return code
    return None


def number_of(text: str | None) -> float | None:
    """The first number of a text; the last of ``.`` and ``,`` is the decimal sign."""
    m = _NUMBER.search(text or "")
    if not m:
        return None
    raw = m[0].replace("−", "-").rstrip(".,")
    if "," in raw and raw.rfind(",") > raw.rfind("."):
        raw = raw.replace(".", "").replace(",", ".")
    else:
        raw = raw.replace(",", "")
    try:
        return float(raw)
    except ValueError:
        return None


def text_code(text: str | None, quantity: str) -> str | None:
    """The unit written after the number of a number text."""
    m = _NUMBER.search(text or "")
    return unit_code(text[m.end() :], quantity) if m else None


def smooth_level(logs: np.ndarray) -> tuple[np.ndarray, float]:
    """Running median of log magnitudes (NaN: none) and their robust spread around it."""
    n = len(logs)
    seen = np.isfinite(logs)
    if not seen.any():
        return np.full(n, np.nan), 1.0
    where = np.flatnonzero(seen)
    centres = where[np.unique(np.append(np.arange(0, len(where), LEVEL_STEP), len(where) - 1))]
    rank = np.searchsorted(where, centres)
    medians = [np.median(logs[where[max(0, r - LEVEL_SIDE) : r + LEVEL_SIDE + 1]]) for r in rank.tolist()]
    level = np.interp(np.arange(n), centres, medians)
    spread = 1.4826 * float(np.median(np.abs(logs[where] - level[where])))
    return level, min(max(spread, LEAST_SPREAD), MOST_SPREAD)


def viterbi(emit: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Best state sequence for log emissions ``[n, k]`` and log transitions ``[k, k]``."""
    n, k = emit.shape
    back = np.zeros((n, k), np.int64)
    best = emit[0] + (move[0] if n else 0.0)
    for i in range(1, n):
        through = best[:, None] + move
        back[i] = through.argmax(axis=0)
        best = through.max(axis=0) + emit[i]
    path = np.zeros(n, np.int64)
    path[-1] = best.argmax()
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def decode(logs: np.ndarray, own: np.ndarray, weak: np.ndarray, declared: np.ndarray, shifts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit of each reading of one block, and which readings' statements were overruled.

    ``logs`` are log magnitudes as recorded (NaN: none); ``own`` is the unit a reading itself states, ``weak`` the one its
    unit field or declaration names (-1: none), ``declared`` tells which of the latter are declarations.
    """
    n, k = len(logs), len(shifts)
    stated = np.where(own >= 0, own, weak)
    level, spread = smooth_level(np.where(stated >= 0, logs + shifts[np.maximum(stated, 0)], np.nan))
    with np.errstate(invalid="ignore"):
        fit = np.maximum(-FLOOR, -0.5 * ((logs[:, None] + shifts[None, :] - level[:, None]) / spread) ** 2)
    fit = np.where(np.isnan(fit), 0.0, fit)
    unit, overruled = stated.copy(), np.zeros(n, bool)

    told = np.flatnonzero((own < 0) & (weak >= 0))
    if len(told):
        as_said = fit[told, weak[told]]
        against = np.where(declared[told], DECLARED_WEIGHT, UNIT_WEIGHT)[:, None] * (np.arange(k)[None, :] != weak[told][:, None])
        other = fit[told] - against
        # No stretch can pay for leaving "as stated" unless the best gain over a stretch reaches the costs of leaving it.
        gain = np.concatenate([[0.0], np.cumsum(other.max(axis=1) - as_said)])
        if (gain - np.minimum.accumulate(gain)).max() > ENTER:
            move = np.full((k + 1, k + 1), -SWITCH)
            np.fill_diagonal(move, 0.0)
            move[0, 1:], move[1:, 0] = -ENTER, -RETURN
            path = viterbi(np.concatenate([as_said[:, None], other], axis=1), move)
            gone = path > 0
            overruled[told[gone]] = weak[told[gone]] != path[gone] - 1
            unit[told[gone]] = path[gone] - 1

    silent = np.flatnonzero(stated < 0)
    if len(silent):
        move = np.full((k, k), -SWITCH)
        np.fill_diagonal(move, 0.0)
        unit[silent] = viterbi(fit[silent], move)
    return unit, overruled


UNIT_SCHEMA = "reading_id long, robot_id string, quantity string, unit string, stated_by string, overruled string, number double, common_value double"


def _looked_up(column: pa.ChunkedArray, look: Callable[[str | None], float]) -> np.ndarray:
    """A function of the texts of a column, called once for each distinct text."""
    code = column.combine_chunks().dictionary_encode()
    code = code.combine_chunks() if isinstance(code, pa.ChunkedArray) else code
    table = np.array([look(v) for v in code.dictionary.to_pylist()] + [look(None)], float)
    return table[code.indices.fill_null(len(table) - 1).to_numpy(zero_copy_only=False)]


def _decode_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in whole_groups(batches, ["gid"], 5_000):
        starts = group_starts(t, ["gid"]).tolist() + [t.num_rows]
        for a, b in zip(starts, starts[1:]):
            yield _decode_block(t.slice(a, b - a))


def _decode_block(t: pa.Table) -> pa.RecordBatch:
    quantity = t.column("quantity")[0].as_py()
    codes = list(UNITS[quantity])
    factors = np.array(list(UNITS[quantity].values()))
    number_or_nan = lambda text: math.nan if (x := number_of(text)) is None else x
    value = floats(t, "value")
    x = np.where(np.isfinite(value), value, _looked_up(t.column("value_text"), number_or_nan))
    place = lambda code: -1 if code is None else codes.index(code)
    looks = {"note": note_code, "value_text": text_code, "unit": unit_code, "declared": unit_code}
    note, text, field, declared = (_looked_up(t.column(c), lambda v, f=f: place(f(v, quantity))).astype(np.int64) for c, f in looks.items())
    own = np.where(note >= 0, note, text)
    weak = np.where(field >= 0, field, declared)
    with np.errstate(divide="ignore", invalid="ignore"):
        logs = np.where(x != 0, np.log(np.abs(x)), np.nan)
    unit, overruled = decode(logs, own, weak, field < 0, np.log(factors))
    unit = np.maximum(unit, 0)
    by = np.select([note >= 0, text >= 0, overruled, field >= 0, declared >= 0], ["note", "value_text", "level", "unit", "declaration"], "level")
    names = np.array([*codes, None], object)
    keep = ~t.column("lead_in").combine_chunks().to_numpy(zero_copy_only=False).astype(bool)
    out = {
        "reading_id": t.column("reading_id").combine_chunks(), "robot_id": t.column("robot_id").combine_chunks(), "quantity": pa.array([quantity] * len(x), pa.string()), "unit": pa.array(names[unit], pa.string()), "stated_by": pa.array(by.tolist(), pa.string()),
        "overruled": pa.array(names[np.where(overruled, weak, len(codes))], pa.string()), "number": pa.array(x, from_pandas=True), "common_value": pa.array(x * factors[unit], from_pandas=True),
    }
    return pa.RecordBatch.from_pydict(out).filter(pa.array(keep))


def _quantity(representation: str, control_type: str):  # noqa: ANN202
    told = F.col(control_type)
    for name, quantity in CONTROL_QUANTITY.items():
        told = F.when(F.col(control_type) == name, F.lit(quantity)).otherwise(told)
    return F.coalesce(F.col(representation), told)


def common_units(readings: DataFrame, semantics: DataFrame, block_readings: int = BLOCK_READINGS) -> DataFrame:
    """Readings with decoded unit and common value: ``(reading_id, robot_id, quantity, unit, stated_by, overruled, number, common_value)``."""
    known = list(UNITS)
    quantity = _quantity("representation", "control_type")
    r = readings.select("reading_id", "robot_id", "episode_index", "unit", "value", "value_text", "note", F.col("read_at").cast("timestamp").alias("read_at"), quantity.alias("quantity"), "representation", "control_type")
    r = r.distinct().drop("episode_index", "representation", "control_type").where(F.col("quantity").isin(known))
    s = semantics.where(F.col("modality") == "sensor").select("robot_id", quantity.alias("quantity"), "unit").where(F.col("robot_id").isNotNull() & F.col("unit").isNotNull() & F.col("quantity").isin(known))
    s = s.groupBy("robot_id", "quantity").agg(F.min("unit").alias("declared"))
    micros = F.unix_micros("read_at")
    devices = r.groupBy("robot_id", "quantity").agg(F.count(F.lit(1)).alias("_n"), F.min(micros).alias("_from"), F.max(micros).alias("_to"))
    devices = devices.join(bounded_broadcast(s, MAX_DEVICES), ["robot_id", "quantity"], "left")
    blocks = F.ceil(F.col("_n") / F.lit(block_readings))
    devices = devices.withColumn("_width", F.greatest((F.col("_to") - F.col("_from") + 1) / blocks, F.lit(1.0))).withColumn("_lead", F.col("_width") * LEAD_IN / F.least(F.col("_n"), F.lit(block_readings)))
    devices = devices.select(F.col("robot_id").alias("_robot"), F.col("quantity").alias("_quantity"), "_from", "_to", "_width", "_lead", "declared")
    r = r.join(bounded_broadcast(devices, MAX_DEVICES), F.col("robot_id").eqNullSafe(F.col("_robot")) & (F.col("quantity") == F.col("_quantity")))
    off = micros - F.col("_from")
    own = F.coalesce(F.floor(off / F.col("_width")), F.lit(-1)).cast("long")
    tail = (off - own * F.col("_width") >= F.col("_width") - F.col("_lead")) & ((own + 1) * F.col("_width") <= F.col("_to") - F.col("_from"))
    r = r.withColumn("_own", own).withColumn("_block", F.explode(F.when(F.coalesce(tail, F.lit(False)), F.array(own, own + 1)).otherwise(F.array(own))))
    r = r.withColumn("lead_in", F.col("_block") != F.col("_own")).withColumn("gid", F.xxhash64("robot_id", "quantity", "_block"))
    cols = ("gid", "reading_id", "robot_id", "quantity", "unit", "value", "value_text", "note", "declared", "lead_in")
    r = r.repartition("gid").sortWithinPartitions("gid", "read_at", "reading_id").select(*cols)
    return r.mapInArrow(_decode_blocks, UNIT_SCHEMA)
