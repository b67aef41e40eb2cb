"""Rule registry: a rule is a named Column predicate with the columns it needs.

All rules of a stage are evaluated in one ``select`` as one array column
(P7): ``concat(when(c1, array('r1')) else array(), when(c2, array('r2')) else array(), ...)``.
A NULL condition leaves the row unflagged.  A rule whose required columns are
absent is *skipped* (P12) and reported with status ``SKIPPED``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    condition: Callable[[], Column]
    requires: tuple[str, ...] = field(default_factory=tuple)
    kind: str = "FAIL"  # FAIL tags the row (quarantine); WARN only counts

    def applies(self, columns: Iterable[str]) -> bool:
        cols = set(columns)
        return all(c in cols for c in self.requires)


def active_rules(rules: Sequence[Rule], columns: Iterable[str]) -> list[Rule]:
    cols = list(columns)
    return [r for r in rules if r.applies(cols)]


def skipped_rules(rules: Sequence[Rule], columns: Iterable[str]) -> list[Rule]:
    cols = list(columns)
    return [r for r in rules if not r.applies(cols)]


def names_where(pairs: Sequence[tuple[str, Column]]) -> Column:
    """Array of the names whose condition is true, in order (NULL -> not named).

    Built by ``concat`` of arrays: ``filter`` over an array has no generated code, and Spark would interpret every
    condition inside it, row by row.
    """
    none = F.array().cast("array<string>")
    return F.concat(none, *[F.when(c, F.array(F.lit(n))).otherwise(none) for n, c in pairs]).cast("array<string>")


def tag_array(rules: Sequence[Rule]) -> Column:
    """Array of the names of the rules whose condition is true (NULL -> not flagged)."""
    return names_where([(r.name, r.condition()) for r in rules])


def add_tags(df: DataFrame, rules: Sequence[Rule], col: str = "dq_issues") -> DataFrame:
    """Append the tags of the applicable rules to array column ``col`` in one projection."""
    new = tag_array(active_rules(rules, df.columns))
    if col in df.columns:
        return df.withColumn(col, F.concat(F.col(col), new))
    return df.withColumn(col, new)


