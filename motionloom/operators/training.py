"""Training readiness: dimensions, cameras, chunks, token counts, norm statistics."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motionloom.operators.statistics import chunk_statistics, chunk_summary
from motionloom.plans.features import Layout, LayoutError, padded_layout


@dataclass(frozen=True)
class Contract:
    """What a trainer expects of each sample."""

    state_dim: int = 32
    action_dim: int = 32
    horizon: int = 50
    max_tokens: int = 48
    cameras: tuple[str, ...] = ()

    def findings(self, layout: Layout, cameras: set[str], capacities: dict[str, int] | None = None) -> list[str]:
        """What keeps a dataset with this layout from being used."""
        out = []
        for kind, room in (("state", self.state_dim), ("action", self.action_dim)):
            part = Layout(layout.of(kind))
            try:
                used = len(padded_layout(part, capacities or {}))
            except LayoutError as e:
                out.append(str(e))
                continue
            if not part.features:
                out.append(f"no {kind} features")
            if used > room:
                out.append(f"{kind}: {used} components exceed {room}")
        return out + [f"camera missing: {c}" for c in self.cameras if c not in cameras]


def readiness(lengths: DataFrame, contract: Contract) -> DataFrame:
    """One row of chunk padding figures over all episodes."""
    return chunk_summary(chunk_statistics(lengths, contract.horizon), contract.horizon)


def token_check(samples: DataFrame, count: Callable[[list[str]], list[int]], contract: Contract, prefix: str = "<bos>") -> DataFrame:
    """Per distinct text its prompt's token count, samples and whether it is cut."""

    def run(batches):  # noqa: ANN001, ANN202
        for p in batches:
            prompts = [t if t.startswith(prefix) else f"{prefix}{t}" for t in p["text"]]
            yield pd.DataFrame({"text": p["text"], "samples": p["samples"], "tokens": count([t if t.endswith("\n") else t + "\n" for t in prompts])})

    distinct = samples.where(F.col("text").isNotNull()).groupBy("text").agg(F.count(F.lit(1)).alias("samples"))
    return distinct.mapInPandas(run, "text string, samples long, tokens long").withColumn("cut", F.col("tokens") > contract.max_tokens)


def norm_problems(stats: dict[str, dict[str, list[float]]], widths: dict[str, int]) -> list[str]:
    """Errors of a norm-statistics table: missing keys, lengths, order of quantiles, finite numbers."""
    out = []
    for name, width in widths.items():
        s = stats.get(name, {})
        for key in ("mean", "std", "q01", "q99"):
            v = s.get(key)
            if v is None or len(v) != width or not all(math.isfinite(x) for x in v):
                out.append(f"{name}.{key}: needs {width} finite numbers")
        if not any(o.startswith(f"{name}.q") for o in out) and any(a > b for a, b in zip(s["q01"], s["q99"])):
            out.append(f"{name}: q01 above q99")
    return out
