"""Column expressions over vectors: missing cells, slices, differences, comparisons and edits (P1-P4, P19, section 2.10)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

NAN = float("nan")
INF = float("inf")
#: Periods of angular units.
PERIODS = {"rad": 2 * math.pi, "deg": 360.0}


def is_finite(x: Column) -> Column:
    """Neither null, NaN nor infinite."""
    return F.coalesce(~F.isnan(x) & (F.abs(x) != F.lit(INF)), F.lit(False))


def vector(c: Column, width: int) -> Column:
    """A double vector; a missing cell becomes NaN in every position, a null element NaN."""
    full = F.transform(c, lambda x: F.coalesce(x.cast("double"), F.lit(NAN)))
    return F.when(c.isNull(), F.array_repeat(F.lit(NAN), width)).otherwise(full)


def feature(parts: list[tuple[Column, int, int]]) -> Column:
    """Ordered slices ``(vector, start, stop)`` put together."""
    return F.concat(*[F.slice(c, start + 1, stop - start) for c, start, stop in parts])


def take(c: Column, positions: list[int]) -> Column:
    """The named positions of a vector, in the order given."""
    return F.array(*[F.get(c, F.lit(i)) for i in positions])


def all_finite(c: Column) -> Column:
    """Every component is finite; a null vector is not."""
    return F.coalesce(F.forall(c, is_finite), F.lit(False))


def difference(a: Column, b: Column, period: float | None = None) -> Column:
    """Component-wise ``a - b``; on a circle the shortest difference."""
    if period is None:
        return F.zip_with(a, b, lambda x, y: x - y)
    half = F.lit(period / 2)
    return F.zip_with(a, b, lambda x, y: F.pmod(x - y + half, F.lit(period)) - half)


def largest(c: Column) -> Column:
    """Largest absolute component."""
    return F.array_max(F.transform(c, lambda x: F.abs(x)))


def over(c: Column, by: Column) -> Column:
    """A vector divided by a scalar; null where the scalar is zero or null."""
    return F.when(by != 0, F.transform(c, lambda x: F.try_divide(x, by)))


def outside(c: Column, low: Column, high: Column) -> Column:
    """Some finite component lies outside its bounds (Q8)."""
    bad = F.zip_with(c, F.arrays_zip(low.alias("lo"), high.alias("hi")), lambda x, b: is_finite(x) & ((x < b["lo"]) | (x > b["hi"])))
    return F.coalesce(F.exists(bad, lambda x: F.coalesce(x, F.lit(False))), F.lit(False))


def clipped(c: Column, low: Column, high: Column) -> Column:
    """Components moved into their bounds; NaN stays."""
    b = F.arrays_zip(low.alias("lo"), high.alias("hi"))
    return F.zip_with(c, b, lambda x, y: F.when(F.isnan(x), x).otherwise(F.greatest(F.least(x, y["hi"]), y["lo"])))


def binarized(x: Column, threshold: float, low: float = 0.0, inclusive: bool = True) -> Column:
    """One at the threshold and above (or strictly above), else the low value."""
    high = x >= threshold if inclusive else x > threshold
    return F.when(high, F.lit(1.0)).otherwise(F.lit(low))


def close(a: Column, b: Column, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """All components agree within tolerances; NaN agrees with NaN (Q19)."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce((F.isnan(x) & F.isnan(y)) | (F.abs(x - y) <= atol + rtol * F.abs(y)), F.lit(False)))
    return F.coalesce((F.size(a) == F.size(b)) & F.forall(same, lambda x: x), F.lit(False))


def changed_values(a: Column, b: Column) -> Column:
    """Number of components that differ; NaN equals NaN."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y)), lambda x: x))
