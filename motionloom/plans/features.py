"""Named features over vector columns, compiled to Column expressions (P3-P10, P15-P17, P19, section 1.3).

A layout lists, for state and action, named features as ordered slices of stored vectors. It is resolved once on the
driver against the declared widths; rows never pass through Python.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motionloom.functions.vectors import PERIODS, feature


class Unit(str, Enum):
    """Units a feature may declare."""

    RAD = "rad"
    DEG = "deg"
    M = "m"
    RAD_S = "rad/s"
    DEG_S = "deg/s"
    M_S = "m/s"
    NM = "N*m"
    N = "N"
    NORMALIZED = "normalized"
    DIMENSIONLESS = "dimensionless"
    UNKNOWN = "unknown"


#: Representations whose components cannot be subtracted one by one.
NOT_SUBTRACTABLE = frozenset({"pose", "delta_pose", "quaternion", "rotation_matrix", "eef_pose"})


class LayoutError(ValueError):
    """A layout that does not fit the declared columns."""


@dataclass(frozen=True)
class Piece:
    """A slice ``[start, stop)`` of a stored vector; open ends mean its borders."""

    column: str
    start: int | None = None
    stop: int | None = None

    def bound(self, widths: dict[str, int], wrap: bool = False) -> Piece:
        """The slice with definite ends. ``wrap`` lets negative ends count from the back, as Python slices do."""
        width = widths.get(self.column)
        if width is None:
            raise LayoutError(f"{self.column}: no such vector column")
        for end in (self.start, self.stop):
            if end is not None and (isinstance(end, bool) or not isinstance(end, int)):
                raise LayoutError(f"{self.column}: slice ends must be whole numbers")
        if wrap:
            a, b, _ = slice(self.start, self.stop).indices(width)
        else:
            a = 0 if self.start is None else self.start
            b = width if self.stop is None else self.stop
            if not (0 <= a <= width and 0 <= b <= width):
                raise LayoutError(f"{self.column}: [{self.start}:{self.stop}] does not fit width {width}")
        if a >= b:
            raise LayoutError(f"{self.column}: [{self.start}:{self.stop}] is empty")
        return Piece(self.column, a, b)


@dataclass(frozen=True)
class Feature:
    """A named feature: pieces in order, and what its numbers mean."""

    name: str
    modality: str
    pieces: tuple[Piece, ...]
    unit: str = "unknown"
    representation: str = "unknown"
    periodic: bool = False
    dimension: int | None = None

    @property
    def width(self) -> int:
        return sum(p.stop - p.start for p in self.pieces)

    def period(self) -> float | None:
        """Length of the circle for a periodic angle, None for a line."""
        if self.representation in NOT_SUBTRACTABLE:
            raise LayoutError(f"{self.name}: a {self.representation} cannot be subtracted component by component")
        if not self.periodic:
            return None
        if self.unit not in PERIODS:
            raise LayoutError(f"{self.name}: a periodic feature needs rad or deg")
        return PERIODS[self.unit]

    def column(self) -> Column:
        """The feature's vector."""
        return feature([(F.col(f"`{p.column}`"), p.start, p.stop) for p in self.pieces])


@dataclass(frozen=True)
class Layout:
    """Features of state and action in order. ``raw`` keeps the stored vector, with gaps, instead of packing."""

    features: tuple[Feature, ...]
    raw: bool = False
    paired: dict[str, str] = field(default_factory=dict)

    def resolve(self, widths: dict[str, int], wrap: bool = False) -> Layout:
        """Check names, modalities, ends and dimensions against the stored widths."""
        seen: set[str] = set()
        out = []
        for f in self.features:
            if not f.name.strip() or f.name in seen:
                raise LayoutError(f"feature name {f.name!r} is blank or repeated")
            seen.add(f.name)
            if f.modality not in ("state", "action") or not f.pieces:
                raise LayoutError(f"{f.name}: needs a modality and at least one source")
            Unit(f.unit)
            g = Feature(f.name, f.modality, tuple(p.bound(widths, wrap) for p in f.pieces), f.unit, f.representation, f.periodic, f.dimension)
            if f.dimension is not None and f.dimension != g.width:
                raise LayoutError(f"{f.name}: {g.width} components, {f.dimension} expected")
            out.append(g)
        for a, s in self.paired.items():
            pair = {f.name: f for f in out}
            if a not in pair or s not in pair or pair[a].width != pair[s].width or (pair[a].modality, pair[s].modality) != ("action", "state"):
                raise LayoutError(f"{a}: its paired state {s} must exist with equal width")
        return Layout(tuple(out), self.raw, dict(self.paired))

    def of(self, modality: str) -> tuple[Feature, ...]:
        return tuple(f for f in self.features if f.modality == modality)

    def select(self, names: list[str]) -> tuple[str, list[int]]:
        """Modality and component positions of named features, in the layout's order whatever the request's."""
        if not names or len(set(names)) != len(names):
            raise LayoutError("a selection is a list of different names")
        known = {f.name: f for f in self.features}
        if missing := [n for n in names if n not in known]:
            raise LayoutError(f"no such feature: {missing[0]}")
        kinds = {known[n].modality for n in names}
        if len(kinds) > 1:
            raise LayoutError("state and action features cannot be selected together")
        kind, at, out = kinds.pop(), 0, []
        for f in self.of(kind):
            if f.name in names:
                new = [i for p in f.pieces for i in range(p.start, p.stop)] if self.raw else list(range(at, at + f.width))
                if set(new) & set(out):
                    raise LayoutError(f"{f.name}: components are already selected")
                out += new
            at += f.width
        return kind, out

    def project(self, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """``state`` and ``action`` vectors, and one column per feature."""
        cols = [f.column().alias(f.name) for f in self.features]
        both = [F.concat(*[f.column() for f in self.of(m)]).alias(m) for m in ("state", "action") if self.of(m)]
        return df.select(*[F.col(f"`{c}`") for c in keep], *both, *cols)

    def deltas(self, df: DataFrame) -> DataFrame:
        """Add ``delta.<action>``: an action less its paired state."""
        known = {f.name: f for f in self.features}
        return df.withColumns({f"delta.{a}": F.zip_with(known[a].column(), known[s].column(), lambda x, y: x - y) for a, s in self.paired.items()})


def parse_layout(document: dict) -> Layout:
    """A layout from ``{"canonical": {"state": {name: source}, "action": {...}}}``.

    A source is a column name, ``{source, start, end}``, a list of these, or ``{sources: [...], dimension: n}``; unit,
    representation and periodic may stand beside it.
    """
    if not isinstance(document, dict) or set(document) != {"canonical"} or not isinstance(document["canonical"], dict):
        raise LayoutError("a mapping has the one key canonical")
    features = []
    for modality, entries in document["canonical"].items():
        if modality not in ("state", "action") or not isinstance(entries, dict):
            raise LayoutError(f"{modality}: expected state or action with named targets")
        for name, entry in entries.items():
            meaning, dimension = {}, None
            if isinstance(entry, dict):
                meaning = {k: entry[k] for k in ("unit", "representation", "periodic") if k in entry}
                entry = {k: v for k, v in entry.items() if k not in meaning}
                if "sources" in entry:
                    if extra := set(entry) - {"sources", "dimension"}:
                        raise LayoutError(f"{name}: unknown keys {sorted(extra)}")
                    dimension, entry = entry.get("dimension"), entry["sources"]
            items = entry if isinstance(entry, list) else [entry]
            pieces = []
            for item in items:
                if isinstance(item, str):
                    item = {"source": item}
                if not isinstance(item, dict) or "source" not in item or set(item) - {"source", "start", "end"}:
                    raise LayoutError(f"{name}: a source has a column and optional start and end")
                pieces.append(Piece(item["source"], item.get("start"), item.get("end")))
            full = str(name) if str(name).startswith(f"{modality}.") else f"{modality}.{name}"
            features.append(Feature(full, modality, tuple(pieces), dimension=dimension, **meaning))
    if not features:
        raise LayoutError("a mapping needs at least one feature")
    return Layout(tuple(features))


def padded_layout(layout: Layout, capacities: dict[str, int]) -> list[bool]:
    """Which positions of a fixed-capacity vector are filled, feature by feature (R2)."""
    out: list[bool] = []
    for f in layout.features:
        room = capacities.get(f.name, f.width)
        if f.width > room:
            raise LayoutError(f"{f.name}: {f.width} components exceed the capacity {room}")
        out += [True] * f.width + [False] * (room - f.width)
    return out


def delta_timestamps(horizon: int, fps: float) -> list[float]:
    """Time offsets of an action chunk."""
    if horizon < 1 or not (math.isfinite(fps) and fps > 0):
        raise ValueError("a horizon of at least one and a positive rate are needed")
    return [i / fps for i in range(horizon)]
