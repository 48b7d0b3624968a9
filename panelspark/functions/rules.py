"""Column rules (DQ-1..11), re-aimed from one configuration value to every
value of a table column.

A rule is a function ``Column -> Column`` giving a boolean per row.  Rules
compose (``all_of``, ``any_of``, ``optional``) and are evaluated in one
pass by ``operators.quality.check_rules``.  A null outcome counts as a
violation there (``coalesce(expr, false)``).
"""

from __future__ import annotations

from functools import reduce
from typing import Any, Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType

Rule = Callable[[Column], Column]


def predicate(fn: Callable[[Column], Column]) -> Rule:
    """DQ-1: any user predicate built from Column expressions."""
    return fn


def of_type(type_name: str) -> Rule:
    """DQ-2 for text columns: the value converts to ``type_name``."""
    return lambda c: c.cast("string").try_cast(type_name).isNotNull()


def schema_type_is(field_type: DataType, expected: DataType) -> Rule:
    """DQ-2 for typed columns: a schema fact, the same for every row."""
    return lambda c: F.lit(field_type == expected)


def equals(value: Any) -> Rule:
    """DQ-3: null-safe equality with a value."""
    return lambda c: c.eqNullSafe(F.lit(value))


def in_range(min_: Any = None, max_: Any = None) -> Rule:
    """DQ-4: closed range; a missing end is open."""
    def rule(c: Column) -> Column:
        parts = [F.lit(True)]
        if min_ is not None:
            parts.append(c >= F.lit(min_))
        if max_ is not None:
            parts.append(c <= F.lit(max_))
        return reduce(lambda a, b: a & b, parts)
    return rule


def length_between(min_: int | None = None, max_: int | None = None, kind: DataType | None = None) -> Rule:
    """DQ-5: ``length`` for text, ``size`` for arrays and maps."""
    def rule(c: Column) -> Column:
        n = F.size(c) if isinstance(kind, (ArrayType, MapType)) else F.length(c)
        return in_range(min_, max_)(n)
    return rule


def one_of(choices: Sequence[Any]) -> Rule:
    """DQ-6: value in a list of choices; a ``None`` choice admits null."""
    values = [v for v in choices if v is not None]
    allow_null = len(values) != len(choices)

    def rule(c: Column) -> Column:
        hit = c.isin(values) if values else F.lit(False)
        return (c.isNull() | hit) if allow_null else hit
    return rule


def all_of(*rules: Rule) -> Rule:
    """DQ-7: every rule holds (the reference calls it a union)."""
    return lambda c: reduce(lambda a, b: a & b, [r(c) for r in rules])


def any_of(*rules: Rule) -> Rule:
    """DQ-8: at least one rule holds."""
    return lambda c: reduce(lambda a, b: a | b, [F.coalesce(r(c), F.lit(False)) for r in rules])


def always() -> Rule:
    """DQ-9."""
    return lambda c: F.lit(True)


def must_be_null() -> Rule:
    """DQ-10."""
    return lambda c: c.isNull()


def optional(rule: Rule) -> Rule:
    """DQ-11: null, or the inner rule holds."""
    return lambda c: c.isNull() | F.coalesce(rule(c), F.lit(False))
