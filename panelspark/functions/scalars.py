"""Scalar column functions (SCA-1..5, TOK-1/2, HLD-7/10).

All are built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
# Date patterns, tried in this order (reference: %Y-%m-%d, %Y/%m/%d, %Y%m%d, %Y%m).
DATE_PATTERNS = ["yyyy-M-d", "yyyy/M/d", "yyyyMMdd", "yyyyMM"]
PLAIN_DATE = r"^[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}\z"
OUTPUT_DATE_FORMAT = "yyyy-MM-dd"
# Boolean words (compared after lower-casing).
FALSE_WORDS = ["false", "0", "no", "n", "f"]
TRUE_WORDS = ["true", "1", "yes", "y", "t"]
# Characters not allowed in file names; each becomes "_".
ILLEGAL_FILENAME_CHARS = r'[\\/*?:"<>|]'
# Basket text: "[a, b, c]"; elements joined by ", ".
BASKET_SEP = ", "
ID_WIDTH = 6


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(s: Column | str, strict: bool = False) -> Column:
    """SCA-1: first matching pattern wins; DATE result.

    ``yyyyMMdd`` rejects six digits, so ``202012`` is December 2020 (a
    deliberate fix of the reference's order, see SURVEY 4.1-7).  With
    ``strict`` a value matching no pattern raises, as the reference does;
    otherwise it is null.
    """
    s = F.trim(_c(s).cast("string"))
    # the plain form by a cast, which is faster; whatever it leaves null goes by the patterns
    plain = F.when(s.rlike(PLAIN_DATE), s.try_cast("date"))
    parsed = F.coalesce(plain, F.coalesce(*[F.try_to_timestamp(s, F.lit(p)) for p in DATE_PATTERNS]).cast("date"))
    if strict:
        return F.when(s.isNotNull(), F.coalesce(
            parsed, F.raise_error(F.concat(F.lit("Unsupported date format: "), s)).cast("date")))
    return parsed


def format_date(d: Column | str) -> Column:
    """SCA-2: ``%Y-%m-%d`` text."""
    return F.date_format(_c(d), OUTPUT_DATE_FORMAT)


def sanitize_filename(s: Column | str) -> Column:
    """SCA-3: illegal characters to ``_``, then strip surrounding blanks."""
    replaced = F.regexp_replace(_c(s).cast("string"), ILLEGAL_FILENAME_CHARS, "_")
    return F.regexp_replace(replaced, r"^\s+|\s+$", "")


def str_to_bool(s: Column | str) -> Column:
    """SCA-4: boolean words; anything else is null."""
    low = F.lower(_c(s).cast("string"))
    return (F.when(low.isin(FALSE_WORDS), F.lit(False))
            .when(low.isin(TRUE_WORDS), F.lit(True))
            .otherwise(F.lit(None).cast("boolean")))


def kv_list_to_map(arr: Column | str, last_wins: bool = True) -> Column:
    """SCA-5: ``["a=1", "b=2=3", "a=4"]`` -> ``{a: "4", b: "2=3"}``.

    Split at the first ``=``; values stay text; an item without ``=`` gets a
    null value.  The reference keeps the last value of a repeated key.
    Spark's ``map_from_entries`` raises on a repeated key, so with
    ``last_wins`` only the last entry of each key is kept; with
    ``last_wins=False`` a repeat raises.
    """
    items = F.filter(_c(arr), lambda x: x.isNotNull())
    entries = F.transform(items, lambda x: F.struct(
        F.substring_index(x, "=", 1).alias("key"),
        F.when(F.instr(x, "=") > 0, F.substring(x, F.instr(x, "=") + 1, 1 << 30)).alias("value")))
    if last_wins:
        keys = F.transform(entries, lambda e: e["key"])
        # entry i survives when the last occurrence of its key is at i
        entries = F.filter(entries, lambda e, i: F.size(keys) - F.array_position(F.reverse(keys), e["key"]) == i)
    return F.map_from_entries(entries)


def pad_id(s: Column | str, width: int = ID_WIDTH) -> Column:
    """TOK-2: zero-pad on the left to ``width``; never cut longer text.

    Same result as Python ``str.zfill``: a leading sign stays in front.
    """
    s = _c(s).cast("string")
    signed = s.rlike(r"^[+-]")
    body = F.substring(s, 2, 1 << 30)
    return (F.when(F.length(s) >= width, s)
            .when(signed, F.concat(F.substring(s, 1, 1), F.lpad(body, width - 1, "0")))
            .otherwise(F.lpad(s, width, "0")))


def basket_text(arr: Column | str) -> Column:
    """HLD-7: ``[a, b, c]`` from an array of ids; a missing id is written as
    ``nan``, so text and count agree."""
    return F.concat(F.lit("["), F.array_join(_c(arr), BASKET_SEP, "nan"), F.lit("]"))


def basket_text_count(s: Column | str) -> Column:
    """HLD-10: elements of basket text split on ``", "``; null -> 0.

    Text ``[]`` counts as one element, as in the reference.
    """
    s = _c(s)
    return F.when(s.isNull(), F.lit(0)).otherwise(F.size(F.split(s, BASKET_SEP)))


def parse_basket(s: Column | str) -> Column:
    """TOK-1: basket text to an array of ids (STRING); malformed -> null.

    ``[000001, 600614]`` -> two ids, ``[]`` -> empty array, ``x`` -> null.
    """
    s = F.trim(_c(s))
    inner = F.regexp_extract(s, r"^\[(.*)\]$", 1)
    ok = s.rlike(r"^\[.*\]$")
    items = F.transform(F.split(inner, ","), lambda x: F.trim(x))
    return F.when(~ok | s.isNull(), F.lit(None).cast("array<string>")).when(
        F.trim(inner) == "", F.array().cast("array<string>")).otherwise(items)


def any_of(cols) -> Column:
    return reduce(lambda a, b: a | b, cols)


def all_of(cols) -> Column:
    return reduce(lambda a, b: a & b, cols)
