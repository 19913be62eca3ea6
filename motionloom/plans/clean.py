"""Audit, plan and execution as separate stages (X14, C8, section 3).

The plan is a table with one row per episode; executing it on the same source gives the cleaned rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motionloom.operators import checks, groups
from motionloom.operators.groups import DERIVATIVES, QualityGroup
from motionloom.operators.trajectory import own, trajectory
from motionloom.operators.transforms import EPISODE, all_interpolated, keep_mask, too_short
from motionloom.plans.policy import Policy, verdicts
from motionloom.session import checkpointed


#: Checks a group can have.
GROUP_CHECKS = (*DERIVATIVES[1:], "zscore", "velocity_zscore", "acceleration_zscore", "bounds", "static_ratio")


@dataclass(frozen=True)
class CleanConfig:
    """What may be changed, and the policy for findings."""

    width: int = 8
    trim_edges: bool = True
    epsilon: float = 0.002
    min_kept: int = 2
    nonfinite: str = "drop"  # drop, interpolate or error
    minimum: int = 2
    velocity: float | None = None
    policy: Policy = Policy()
    groups: tuple[QualityGroup, ...] = ()


def audit(rows: DataFrame, config: CleanConfig) -> DataFrame:
    """Findings of the configured checks, in one pass over the rows."""
    group = QualityGroup("", "state", tuple(range(config.width)), velocity=config.velocity or 1e300, static_epsilon=1e-4)
    config.policy.check({"finite", "timestamp", "velocity", "static_ratio", *[g.path(c) for g in config.groups for c in GROUP_CHECKS]})
    return groups.audit(rows, [group, *config.groups], timestamp=0.2, width=config.width)


def plan(rows: DataFrame, config: CleanConfig) -> DataFrame:
    """Per episode: trim, kept rows, and whether it is kept or calls for a stop."""
    edges = checks.static_edges(rows, config.epsilon, config.min_kept)
    masked = keep_mask(rows, edges if config.trim_edges else None, drop_nonfinite=config.nonfinite == "drop")
    size = too_short(masked, config.minimum)
    v = verdicts(audit(rows, config), config.policy)
    out = size.join(v, EPISODE).join(edges.select(EPISODE, "should_trim", "trim_start", "trim_end"), EPISODE)
    return out.select(EPISODE, "n_rows", F.col("kept").alias("kept_rows"), "should_trim", "trim_start", "trim_end", (F.col("keep") & ~F.col("rejected")).alias("keep"), "abort")


def execute(rows: DataFrame, planned: DataFrame, config: CleanConfig) -> DataFrame:
    """The rows the plan keeps, repaired."""
    edges = planned.select(EPISODE, "should_trim", "trim_start", "trim_end")
    kept = keep_mask(rows, edges if config.trim_edges else None, drop_nonfinite=config.nonfinite == "drop").where("keep").drop("keep")
    kept = kept.join(planned.where("keep").select(EPISODE), EPISODE)
    if config.nonfinite == "interpolate":
        names = {f"_f{name}{i}": F.get(F.col(name), F.lit(i)) for name in ("state", "action") for i in range(config.width)}
        kept = all_interpolated(kept, names)
        kept = kept.withColumns({name: F.array(*[F.col(f"_f{name}{i}") for i in range(config.width)]) for name in ("state", "action")}).drop(*names)
    return own(kept)


def clean(frames: DataFrame, episodes: DataFrame, robots: DataFrame | None = None, config: CleanConfig = CleanConfig()) -> tuple[DataFrame, DataFrame]:
    """Plan and cleaned rows of a source; a finding that aborts stops before any row is produced.

    Rows and plan are read by many steps, so both are checkpointed once in the shared folder.
    """
    rows = checkpointed(trajectory(frames, episodes, robots, width=config.width, halo=3))
    planned = checkpointed(plan(rows, config))
    if stop := planned.where("abort").select(EPISODE).limit(5).collect():
        raise ValueError(f"the policy aborts on episodes {[r[0] for r in stop]}")
    return planned, execute(rows, planned, config)
