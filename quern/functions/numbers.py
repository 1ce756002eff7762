"""Arithmetic that never fails on zero or NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def percentage(numerator: Column, denominator: Column) -> Column:
    return ratio(numerator, denominator) * 100


def whole_quotient(numerator: str, denominator: str) -> Column:
    """Integer division that truncates toward zero; NULL for a zero divisor."""
    return F.expr(f"`{numerator}` div nullif(`{denominator}`, 0)")


def repaired_sales(sales: str, quantity: str, price: str) -> Column:
    """Sales as quantity times absolute price wherever the recorded amount is absent or wrong."""
    amount, computed = F.col(sales), F.col(quantity) * F.abs(F.col(price))
    wrong = amount.isNull() | (amount <= 0) | (amount != computed)
    return F.when(wrong, computed).otherwise(amount)


def repaired_price(sales: str, quantity: str, price: str) -> Column:
    """Price from the recorded (not the repaired) sales wherever it is absent or not positive."""
    unit = F.col(price)
    derived = whole_quotient(sales, quantity).cast("bigint")
    return F.when(unit.isNull() | (unit <= 0), derived).otherwise(unit)
