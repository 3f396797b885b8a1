"""Values as people read them: money, shares, multiples and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(amount: Column) -> Column:
    """Whole dollars with thousands separators: $41,091,836, and -$5 below zero."""
    whole = F.format_number(F.abs(F.round(amount, 0)), 0)
    return F.concat(F.when(F.round(amount, 0) < 0, "-$").otherwise("$"), whole)


def percent(share: Column, digits: int = 1) -> Column:
    """A share of one in per cent: 20.0%."""
    return F.concat(F.format_string(f"%.{digits}f", (share.cast("double") * 100)), F.lit("%"))


def multiple(ratio: Column) -> Column:
    """1.44x"""
    return F.concat(F.format_string("%.2f", ratio.cast("double")), F.lit("x"))


def long_date(day: Column) -> Column:
    """17 Jul 2026"""
    return F.date_format(day, "dd MMM yyyy")


def month(day: Column) -> Column:
    """Jul 2026"""
    return F.date_format(day, "MMM yyyy")
