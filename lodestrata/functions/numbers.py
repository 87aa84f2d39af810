"""Numbers as papers print them. Only plain decimals count: suffixes, hex and words such as nan are no numbers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

DECIMAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
MINUS = "−–—"


def plain_minus(c: Column) -> Column:
    """Typographic minus signs and dashes as a hyphen."""
    return F.translate(c, MINUS, "-" * len(MINUS))


def strict(c: Column) -> Column:
    """A double if the trimmed text is a plain decimal, else null."""
    t = F.trim(c)
    return F.when(t.rlike(DECIMAL), t.try_cast("double"))


def number(c: Column) -> Column:
    """A double from a cell's text: thousands commas dropped, minus signs unified; a dash or nothing is null."""
    return strict(plain_minus(F.replace(F.trim(c), F.lit(","), F.lit(""))))


def ratio(c: Column, n: int = 3) -> Column:
    """The first n parts of ``a:b:c`` as doubles, null where one isn't a number or is absent."""
    parts = F.transform(F.slice(F.split(c, ":"), 1, n), strict)
    return F.slice(F.concat(parts, F.array_repeat(F.lit(None).cast("double"), n)), 1, n)


def normal(c: Column) -> Column:
    """Decimal zeros after a point dropped; nothing is 0."""
    t = F.trim(c)
    short = F.when(t.contains("."), F.regexp_replace(F.regexp_replace(t, "0+$", ""), r"\.$", "")).otherwise(t)
    return F.when(short == "", F.lit("0")).otherwise(short)


def numbers_in(c: Column) -> Column:
    """The distinct numbers of a text, normal."""
    return F.array_distinct(F.transform(F.regexp_extract_all(plain_minus(c), F.lit(r"-?\d+(?:\.\d+)?"), F.lit(0)), normal))


def verified(value: Column, text: Column) -> Column:
    """Whether a number (as text) occurs in a text."""
    return F.coalesce(F.array_contains(numbers_in(text), normal(value)), F.lit(False))


def _formatted(c: Column, form) -> Column:
    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if pd.isna(v) else form(float(v)))

    return run(c)


def shortest(c: Column) -> Column:
    """The shortest text that reads back as the double, with a point."""
    return _formatted(c, repr)


def general(c: Column, digits: int = 6) -> Column:
    """Up to so many significant digits, without trailing zeros."""
    return _formatted(c, lambda v: f"{v:.{digits}g}")


def close(a: Column, b: Column, relative: float = 1e-3, absolute: float = 1e-9) -> Column:
    """Equal within a relative or absolute tolerance."""
    return F.abs(a - b) <= F.greatest(F.lit(relative) * F.greatest(F.abs(a), F.abs(b)), F.lit(absolute))
