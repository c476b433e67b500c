"""Declarative row rules: issues, corrections, rejects, and the resulting status.

A rule is a condition with the message it leaves behind.  Conditions and
messages are kept apart, so a query that needs only the status of a row never
builds a message text: column pruning removes it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tamiz import vocabulary as v

REJECTED, REJECT_REASON = "rejected", "reject_reason"


@dataclass(frozen=True)
class Rule:
    """``message`` applies to rows where ``condition`` holds (NULL = does not)."""

    condition: Column
    message: Column

    @property
    def holds(self) -> Column:
        return F.coalesce(self.condition, F.lit(False))


@dataclass(frozen=True)
class Reject(Rule):
    """A rule whose rows leave the feed; ``kind`` names the error in the log."""

    kind: str

    @property
    def reason(self) -> Column:
        return F.concat(F.lit(f"{self.kind}: "), self.message)


def not_in(category: Column, allowed: Sequence[str]) -> Column:
    return ~F.coalesce(category.isin(*allowed), F.lit(False))


def judged(rows: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, list[Rule]]:
    """``rows`` with a boolean for each rule, and the rules as tests of these booleans:
    a condition that a status and a message both need is looked at once."""
    names = [f"__rule_{place}" for place in range(len(rules))]
    flagged = rows.select("*", *[rule.holds.alias(name) for rule, name in zip(rules, names)])
    return flagged, [Rule(F.col(name), rule.message) for rule, name in zip(rules, names)]


def any_holds(rules: Sequence[Rule]) -> Column:
    return reduce(lambda left, right: left | right, [rule.holds for rule in rules], F.lit(False))


def all_messages(rules: Sequence[Rule]) -> Column:
    """Messages of every rule that holds, in rule order; NULL if none does
    (``concat_ws`` skips the NULL of a rule that does not hold).  The texts are
    named once: code that is generated twice may be too long to be compiled."""
    found = [F.when(rule.holds, rule.message) for rule in rules]
    return F.when(any_holds(rules), F.concat_ws(v.NOTE_SEPARATOR, *found))


def first_reason(rejects: Sequence[Reject]) -> Column:
    """Log text of the first reject rule that holds, else NULL: one per row."""
    return F.coalesce(*[F.when(rule.holds, rule.reason) for rule in rejects])


def with_outcome(rows: DataFrame, rejects: Sequence[Reject]) -> DataFrame:
    """``rows`` with ``rejected`` (never NULL) and the reason, NULL when kept."""
    return rows.select(
        "*",
        any_holds(rejects).alias(REJECTED),
        first_reason(rejects).alias(REJECT_REASON),
    )


def split(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(kept, rejected)``.  The two tests are exact complements: no row is lost.
    They look at the conditions only; the kept half never builds a reason."""
    rejected = F.col(REJECTED)
    return classified.where(~rejected), classified.where(rejected)
