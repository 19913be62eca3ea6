"""Policy: what a finding leads to."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTIONS = ("report", "warn", "reject_episode", "abort")
EPISODE = "episode_index"


@dataclass(frozen=True)
class Rule:
    """Actions on a failed and on an unevaluated finding."""

    on_fail: str = "warn"
    on_unevaluated: str = "warn"

    def __post_init__(self) -> None:
        if self.on_fail not in ACTIONS or self.on_unevaluated not in ACTIONS:
            raise ValueError(f"actions are {', '.join(ACTIONS)}")


@dataclass(frozen=True)
class Policy:
    """Rules by finding path or by its last segment, a default, and what an output audit does."""

    default: Rule = Rule()
    rules: dict[str, Rule] = field(default_factory=dict)
    output_on_fail: str = "report"
    reject: tuple[int, ...] = ()

    def check(self, paths: set[str]) -> None:
        """Refuse rules for findings that no check produces."""
        known = paths | {p.rsplit("/", 1)[-1] for p in paths}
        if unknown := sorted(set(self.rules) - known):
            raise ValueError(f"no such check: {', '.join(unknown)}")

    def action(self, path: Column, failed: bool) -> Column:
        """The action for a finding path: its own rule, that of its last segment, the default."""
        pick = (lambda r: r.on_fail) if failed else (lambda r: r.on_unevaluated)
        last = F.element_at(F.split(path, "/"), -1)
        out = F.lit(pick(self.default))
        for name, rule in self.rules.items():
            out = F.when(last == name, F.lit(pick(rule))).otherwise(out)
        for name, rule in self.rules.items():
            out = F.when(path == name, F.lit(pick(rule))).otherwise(out)
        return out


def findings(checks: dict[str, DataFrame]) -> DataFrame:
    """Long form ``(episode_index, path, passed, evaluated)`` of check results by path."""
    out = None
    for path, df in checks.items():
        e = F.col("evaluated") if "evaluated" in df.columns else F.lit(True)
        part = df.select(EPISODE, F.lit(path).alias("path"), "passed", e.alias("evaluated"))
        out = part if out is None else out.unionByName(part)
    return out


def decisions(found: DataFrame, policy: Policy) -> DataFrame:
    """Findings that call for something: those failed or not evaluated, with reason and action."""
    open_ = found.where(~F.col("passed") | ~F.col("evaluated"))
    reason = F.when(F.col("evaluated"), F.lit("failed")).otherwise(F.lit("not_evaluated"))
    action = F.when(F.col("evaluated"), policy.action(F.col("path"), True)).otherwise(policy.action(F.col("path"), False))
    return open_.select(EPISODE, "path", reason.alias("reason"), action.alias("action"))


def verdicts(found: DataFrame, policy: Policy, output_check: bool = False) -> DataFrame:
    """Per episode ``keep`` and ``abort``; an output audit that gates aborts on any decision, and on a rejection."""
    d = decisions(found, policy).where(F.col("action") != "report") if not output_check else decisions(found, policy)
    acts = d.groupBy(EPISODE).agg(F.max(F.col("action") == "reject_episode").alias("_r"), F.max(F.col("action") == "abort").alias("_a"), F.count(F.lit(1)).alias("_n"))
    out = found.select(EPISODE).distinct().join(acts, EPISODE, "left")
    rejected = F.coalesce("_r", F.lit(False)) | F.col(EPISODE).isin(*policy.reject or (-1,))
    abort = F.coalesce("_a", F.lit(False))
    if output_check:
        gate = F.lit(policy.output_on_fail == "abort") & F.col("_n").isNotNull()
        abort = abort | F.coalesce("_r", F.lit(False)) | gate
    return out.select(EPISODE, (~rejected & ~abort).alias("keep"), abort.alias("abort"))
