"""Column expressions for parsing, ratios and quote units."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

FILE_STAMP = "[0-9]{8}"


def amount(c: Column) -> Column:
    """``'1,400.5'`` -> 1400.5; text that is no number raises."""
    return F.replace(c, F.lit(","), F.lit("")).cast("double")


def try_amount(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit("")).try_cast("double")


def file_stamp(c: Column) -> Column:
    """First run of eight digits, NULL when there is none."""
    return F.regexp_substr(c, F.lit(FILE_STAMP))


def stamp_date(stamp: Column) -> Column:
    """``yyyyMMdd`` -> date; an impossible date raises."""
    return F.to_date(stamp, "yyyyMMdd")


def try_stamp_date(stamp: Column) -> Column:
    return F.try_to_date(stamp, "yyyyMMdd")


def file_date(c: Column) -> Column:
    return stamp_date(file_stamp(c))


def pct_over(a: Column, b: Column) -> Column:
    """``(a / b - 1) * 100``, NULL when b is NULL or 0."""
    return (F.try_divide(a, b) - 1) * 100


def quote_unit(code: Column) -> Column:
    """Codes marked ``(100)`` are quoted per 100 units."""
    return F.when(code.contains("(100)"), 100).otherwise(1)


def plain_code(code: Column) -> Column:
    return F.replace(code, F.lit("(100)"), F.lit(""))


def per_unit(rate: Column, code: Column) -> Column:
    return rate / quote_unit(code)


def settled(x: Column) -> Column:
    """A sum or mean without the noise of the order in which it was added up.

    Rounding a mean that lies on a tie would otherwise depend on how the rows
    are partitioned.
    """
    return F.round(x, 9)
