"""Column expressions used across the operators.

Everything here is a built-in Spark expression, so it stays inside whole-stage
codegen. Division always guards the denominator because ANSI mode raises on /0.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """numerator / denominator as double, NULL for a zero denominator."""
    return _col(numerator).cast("double") / F.nullif(_col(denominator).cast("double"), F.lit(0.0))


def _exact(c: str | Column) -> Column:
    return _col(c).cast("decimal(20,4)")


def rounded_ratio(numerator: str | Column, denominator: str | Column, digits: int = 2, scale: int = 1) -> Column:
    """scale * numerator / denominator, rounded half up as a numeric column would be.

    The quotient is a decimal: as a double, 97.35 / 6 falls just below 16.225 and
    would round to 16.22. Meant for group results, not for every row.
    """
    divisor = F.nullif(_exact(denominator), F.lit(0).cast("decimal(20,4)"))
    return F.round(_exact(numerator) * scale / divisor, digits).cast("double")


def percent(numerator: str | Column, denominator: str | Column, digits: int = 2) -> Column:
    """100 * numerator / denominator, rounded."""
    return rounded_ratio(numerator, denominator, digits, 100)


def is_type(event_type: str, column: str = "event_type") -> Column:
    return F.col(column) == event_type


def count_type(event_type: str) -> Column:
    return F.count_if(is_type(event_type))


def cents(amount: str | Column) -> Column:
    """The amount in whole cents."""
    return F.rint(_col(amount).cast("double") * 100).cast("long")


def money_sum(amount: str | Column) -> Column:
    """Exact sum of an amount in whole cents.

    Adding longs is independent of the order in which partitions arrive and
    stays in the fast hash-aggregate path, unlike wide decimals.
    """
    return F.sum(cents(amount)) / F.lit(100.0)


def money_sum_or_zero(amount: str | Column) -> Column:
    return F.coalesce(F.sum(cents(amount)), F.lit(0).cast("long")) / F.lit(100.0)


def money_avg(amount: str | Column, digits: int = 2) -> Column:
    """Rounded average of an amount."""
    return rounded_ratio(money_sum(amount), F.count(_col(amount)), digits)


def mean(value: str | Column, digits: int = 2, scale: int = 1) -> Column:
    """Rounded average of a whole-number column."""
    return rounded_ratio(F.sum(_col(value)), F.count(_col(value)), digits, scale)


def purchase_amount() -> Column:
    """cart_value on purchase events, NULL elsewhere."""
    return F.when(is_type("purchase"), F.col("cart_value"))


def month_start(c: str | Column) -> Column:
    return F.trunc(_col(c).cast("date"), "month")


def week_start(c: str | Column) -> Column:
    return F.trunc(_col(c).cast("date"), "week")


def pick(index: Column, values: list[str]) -> Column:
    """The value at a zero-based index of a short literal list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))
