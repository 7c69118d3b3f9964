"""Frozen rule sets: rules are data, fingerprinted before any content is read."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """`violation` is a SQL condition that is true for a row that breaks the rule."""

    rule_id: str
    violation: str
    reason: str
    version: int = 1

    def broken(self) -> Column:
        """True for a row that breaks the rule; a condition that cannot be decided breaks it."""
        return F.coalesce(F.expr(self.violation), F.lit(True))


@dataclass(frozen=True)
class RuleSet:
    rules: tuple[Rule, ...]
    sha: str

    @staticmethod
    def freeze(rules: list[Rule]) -> RuleSet:
        ordered = tuple(sorted(rules, key=lambda r: r.rule_id))
        if len({r.rule_id for r in ordered}) != len(ordered):
            raise ValueError("rule ids repeat")
        text = json.dumps([asdict(r) for r in ordered], sort_keys=True, ensure_ascii=False)
        return RuleSet(ordered, hashlib.sha256(text.encode()).hexdigest())

    def reasons(self) -> Column:
        """Reason codes of the broken rules."""
        return F.array_compact(F.array(*[F.when(r.broken(), F.lit(r.reason)) for r in self.rules]))

    def apply(self, df: DataFrame, name: str = "reasons") -> DataFrame:
        return df.withColumn(name, self.reasons()).withColumn("rule_sha", F.lit(self.sha))
