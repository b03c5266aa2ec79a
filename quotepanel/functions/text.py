"""Column expressions for display text.

``format_number`` rounds the exact binary value half to even, as the
reference's number formatting does; ``format_string('%.2f')`` does not.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Display digits by magnitude of the latest rate.
DIGITS_NULL = 2
DIGITS_BELOW_10 = 4
DIGITS_BELOW_100 = 3
DIGITS_OTHER = 2


def absent(c: Column) -> Column:
    return c.isNull() | F.isnan(c)


def label(code: Column, name: Column) -> Column:
    """``CODE(NAME)``, or the bare code when there is no name."""
    return F.when(F.coalesce(name, F.lit("")) != "", F.concat(code, F.lit("("), name, F.lit(")"))).otherwise(code)


def digits(rate: Column) -> Column:
    return (
        F.when(absent(rate), DIGITS_NULL)
        .when(rate < 10, DIGITS_BELOW_10)
        .when(rate < 100, DIGITS_BELOW_100)
        .otherwise(DIGITS_OTHER)
    )


def _with_digits(x: Column, dec: Column | int) -> Column:
    if isinstance(dec, int):
        return F.format_number(x, dec)
    # Constant patterns per branch, so none is rebuilt from row to row.
    return F.when(dec == 4, F.format_number(x, 4)).when(dec == 3, F.format_number(x, 3)).otherwise(F.format_number(x, 2))


def _plus(text: Column) -> Column:
    return F.when(text.startswith("-"), text).otherwise(F.concat(F.lit("+"), text))


def fmt_num(x: Column, dec: Column | int = 2) -> Column:
    """``1,234.50``; NULL -> ``-``."""
    return F.when(absent(x), "-").otherwise(_with_digits(x, dec))


def fmt_pct(x: Column) -> Column:
    """``+0.12%``; NULL -> ``-``."""
    plain = F.replace(F.format_number(x, 2), F.lit(","), F.lit(""))
    return F.when(absent(x), "-").otherwise(F.concat(_plus(plain), F.lit("%")))


def delta_text(rate: Column, prev: Column, change_pct: Column, dec: Column | int) -> Column:
    """``+1.20 (+0.12%)``, NULL without a previous value."""
    diff = _plus(_with_digits(rate - prev, dec))
    return F.when(~absent(prev), F.concat(diff, F.lit(" ("), fmt_pct(change_pct), F.lit(")")))


def age_text(since: Column, as_of: Column) -> Column:
    """Whole minutes, hours or days between two zone-less timestamps."""
    age = F.greatest(as_of - since, F.expr("INTERVAL '0' SECOND").cast("interval day to second"))
    days, hours, minutes = (F.extract(F.lit(part), age).cast("long") for part in ("DAY", "HOUR", "MINUTE"))
    return (
        F.when(since.isNull(), "unknown")
        .when(days > 0, F.concat(days, F.lit(" days ago")))
        .when(hours > 0, F.concat(hours, F.lit(" hours ago")))
        .otherwise(F.concat(minutes, F.lit(" minutes ago")))
    )


def iso_date(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def month_day(c: Column) -> Column:
    return F.date_format(c, "MM/dd")
