"""Column functions for money: conversion, proration, shares and signs. Products are cast after each step."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Types whose amount leaves the account, income types, types that cross the client's boundary.
DEBITS = ("BUY", "FEE", "TRANSFER_OUT")
INCOME = ("DIVIDEND", "INTEREST")
EXTERNAL = ("TRANSFER_IN", "TRANSFER_OUT")


def signed(amount: Column, kind: Column) -> Column:
    return F.when(kind.isin(*DEBITS), -amount).otherwise(amount)


def to_usd(amount: Column, currency: Column, rate: Column) -> Column:
    """Dollars pass, euros are multiplied by the day's rate, anything else stops the job."""
    euros = (amount * rate).cast("decimal(28,8)")
    wrong = F.raise_error(F.concat(F.lit("no conversion for currency "), currency)).cast("decimal(28,8)")
    return F.when(currency == "USD", amount.cast("decimal(28,8)")).when(currency == "EUR", euros).otherwise(wrong)


def prorated(amount: Column, share: Column) -> Column:
    return (amount * share).cast("decimal(24,2)")


def ratio(part: Column, whole: Column, kind: str = "decimal(9,6)") -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double")).cast(kind)


def tolerant_decimal(text: Column, kind: str = "decimal(24,2)") -> Column:
    """Amounts as people write them: dollar signs and thousands commas go; null where no number is left."""
    return F.regexp_replace(F.trim(text), r"[$,]", "").try_cast(kind)


def quantized(amount: Column, digits: int = 2, half_even: bool = False) -> Column:
    """Rounded to so many digits: halves away from zero, or to the even neighbour."""
    return F.bround(amount, digits) if half_even else F.round(amount, digits)
