"""Apply a rule set to a table (DQ-12).

Known columns only; rules for columns the table lacks are ignored, as the
reference ignores unknown keys.  All violation counts come from one
aggregation pass (``count_if`` per rule, partial aggregation map-side).
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.rules import Rule


class RuleViolation(Exception):
    pass


def _ok(df: DataFrame, col: str, rule: Rule):
    return F.coalesce(rule(F.col(col)), F.lit(False))


def violation_counts(df: DataFrame, rules: Mapping[str, Rule]) -> DataFrame:
    """One row: ``<column>_violations`` per known column (a lazy DataFrame)."""
    known = [c for c in rules if c in df.columns]
    return df.agg(*[F.count_if(~_ok(df, c, rules[c])).alias(f"{c}_violations") for c in known])


def flag_rows(df: DataFrame, rules: Mapping[str, Rule]) -> DataFrame:
    """Add ``<column>_ok`` booleans per known column."""
    known = [c for c in rules if c in df.columns]
    return df.select("*", *[_ok(df, c, rules[c]).alias(f"{c}_ok") for c in known])


def check_rules(df: DataFrame, rules: Mapping[str, Rule], mode: str = "report") -> DataFrame:
    """``report``: the counts table; ``flag``: rows with flags;
    ``raise``: raise ``RuleViolation`` naming the failing columns (one job,
    one row to the driver), else return the counts table."""
    if mode == "flag":
        return flag_rows(df, rules)
    counts = violation_counts(df, rules)
    if mode == "raise":
        row = counts.first()
        bad = {k: v for k, v in (row.asDict() if row else {}).items() if v}
        if bad:
            raise RuleViolation(f"rule violations: {bad}")
    elif mode != "report":
        raise ValueError(f"unknown mode {mode}")
    return counts
