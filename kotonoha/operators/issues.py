"""Rules as data: each gives at most one issue, issues keep the order of the rules, the worst severity decides."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    code: str
    severity: str  # info, warning or critical
    when: Column
    evidence: dict[str, Column] = field(default_factory=dict)


def issues(rules: Sequence[Rule]) -> Column:
    """array<struct<code, severity, evidence>> of the rules that hold; a condition that is null doesn't."""
    each = []
    for r in rules:
        evidence = F.to_json(F.struct(*[c.alias(k) for k, c in sorted(r.evidence.items())])) if r.evidence else F.lit("{}")
        issue = F.struct(F.lit(r.code).alias("code"), F.lit(r.severity).alias("severity"), evidence.alias("evidence"))
        each.append(F.when(r.when, issue))
    return F.array_compact(F.array(*each))


def decision(found: Column) -> Column:
    """drop for any critical issue, else review for any warning, else pass."""
    worst = lambda s: F.exists(found, lambda i: i["severity"] == s)
    return F.when(worst("critical"), "drop").when(worst("warning"), "review").otherwise("pass")


def codes(found: Column, *, with_info: bool = True) -> Column:
    kept = found if with_info else F.filter(found, lambda i: i["severity"] != "info")
    return F.transform(kept, lambda i: i["code"])


def histogram(df: DataFrame, items: Column, name: str = "code") -> DataFrame:
    """Count of each element of an array column, most frequent first, ties by name."""
    return df.select(F.explode(items).alias(name)).groupBy(name).agg(F.count("*").alias("n")).orderBy(F.desc("n"), name)


def route(df: DataFrame, decision_column: str, wanted: str) -> DataFrame:
    return df.where(F.col(decision_column) == wanted)


def summary(df: DataFrame, decision_column: str, amount: str | None = None, kinds: Sequence[str] = ("pass", "review", "drop", "undecided")) -> DataFrame:
    """One row: number of rows, and count (and amount, null as 0) of each decision."""
    total = F.sum(F.coalesce(F.col(amount), F.lit(0.0))) if amount else None
    aggs = [F.count("*").alias("total")]
    for k in kinds:
        here = F.col(decision_column) == k
        aggs.append(F.count_if(here).alias(f"n_{k}"))
        if total is not None:
            aggs.append(F.sum(F.when(here, F.coalesce(F.col(amount), F.lit(0.0))).otherwise(0.0)).alias(f"amount_{k}"))
    return df.agg(*aggs)


def balanced(summary_row: DataFrame, total: str, parts: Sequence[str]) -> DataFrame:
    """The summary itself; reading it fails if the parts don't add up."""
    ok = F.col(total) == sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
    return summary_row.where(F.when(ok, True).otherwise(F.raise_error(F.lit(f"{' + '.join(parts)} differ from {total}")).cast("boolean")))
