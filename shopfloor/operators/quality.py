"""Data-quality expectations.

An expectation is a named SQL predicate with an action:

* ``fail``: any violating row aborts the job (``assert_true`` inside a filter,
  so column pruning cannot remove the check);
* ``drop``: violating rows are removed;
* ``warn``: rows are kept; violations are only counted.

A NULL predicate result is a violation. Predicates see the dataset's output
(after its body ran), as in the reference. Counting uses ``observe`` on the
pipeline path (metrics arrive with the write, batch or micro-batch) and a
plain aggregate for the quality report (E4), which is the SQL-checkable form.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

FAIL, DROP, WARN = "fail", "drop", "warn"


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    action: str = WARN

    def holds(self) -> Column:
        """TRUE only when the predicate is TRUE (NULL counts as a violation)."""
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def enforce(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """Apply the row effect of the rules: fail raises, drop filters, warn keeps."""
    for rule in rules:
        if rule.action == FAIL:
            msg = f"expectation {rule.name} failed: {rule.predicate}"
            df = df.where(F.assert_true(rule.holds(), F.lit(msg)).isNull())
    drops = [r for r in rules if r.action == DROP]
    if drops:
        keep = drops[0].holds()
        for rule in drops[1:]:
            keep = keep & rule.holds()
        df = df.where(keep)
    return df


def violation_counts(rules: Sequence[Expectation]) -> list[Column]:
    return [F.count_if(~r.holds()).alias(r.name) for r in rules]


def observed(df: DataFrame, dataset: str, rules: Sequence[Expectation]) -> tuple[DataFrame, Observation]:
    """Attach violation counters to the dataset body (before drops). The
    observation is filled when the dataset is written."""
    obs = Observation(f"quality:{dataset}")
    counters = [F.count(F.lit(1)).alias("rows"), *violation_counts(rules)]
    return df.observe(obs, *counters), obs


def report(df: DataFrame, dataset: str, rules: Sequence[Expectation]) -> DataFrame:
    """One aggregate pass over the dataset body: (dataset, rule, action,
    passed, failed) per rule (E4)."""
    return report_many(df, [(dataset, rules, None)])


def report_many(df: DataFrame, parts: Sequence[tuple[str, Sequence[Expectation], Column | None]]) -> DataFrame:
    """Reports of several datasets whose bodies are row subsets of ``df``
    (``None`` = all rows), counted in one aggregate: one scan, however many
    datasets share it."""
    counts, per_rule = [], []
    for j, (dataset, rules, where) in enumerate(parts):
        member = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
        counts.append(F.count_if(member).alias(f"_n{j}"))
        for i, r in enumerate(rules):
            counts.append(F.count_if(member & ~r.holds()).alias(f"_f{j}_{i}"))
            per_rule.append(F.struct(
                F.lit(dataset).alias("dataset"), F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"),
                (F.col(f"_n{j}") - F.col(f"_f{j}_{i}")).alias("passed"), F.col(f"_f{j}_{i}").alias("failed")))
    return (df.agg(*counts).select(F.explode(F.array(*per_rule)).alias("r"))
            .select("r.dataset", "r.rule", "r.action", "r.passed", "r.failed"))


def union_reports(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def metrics_rows(dataset: str, rules: Sequence[Expectation], counts: dict) -> list[tuple]:
    """(dataset, rule, action, passed, failed) from observed counters."""
    rows = counts.get("rows", 0)
    return [(dataset, r.name, r.action, rows - counts.get(r.name, 0), counts.get(r.name, 0)) for r in rules]


REPORT_FIELDS = [("dataset", "string"), ("rule", "string"), ("action", "string"), ("passed", "bigint"),
                 ("failed", "bigint")]
