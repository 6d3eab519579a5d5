"""Sums that do not depend on the order in which shuffle blocks arrive.

Adding doubles in another order gives another last digit, so a retried task or
a different partition count could change a report. Amounts are added as
decimals instead, where every value of the group is one that a decimal holds
without rounding and the sum fits. Any other group (more than eight decimals,
beyond 1e16, infinite or NaN) is added as plain doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(24,8)"
COUNT = "decimal(10,3)"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def held_exactly(value: Column, type_name: str = AMOUNT) -> Column:
    """The value as a decimal; NULL if the decimal is another number."""
    exact = value.try_cast(type_name)
    return F.when(exact.cast("double") == value.cast("double"), exact)


def _decimal_sum(exact: Column, plain: Column) -> Column:
    """Aggregate: sum as decimal; NULL if a value is missing from ``exact`` or the sum does not fit."""
    return F.when(F.bool_and(exact.isNotNull() | plain.isNull()), F.try_sum(exact))


def decimal_sum(value: Column | str) -> Column:
    """Aggregate: sum of a numeric column as decimal; NULL where only doubles can hold it, or for no values."""
    value = _column(value)
    return _decimal_sum(held_exactly(value), value.cast("double"))


def decimal_sum_product(amount: Column | str, count: Column | str) -> Column:
    """Aggregate: sum of ``amount * count`` as decimal, like ``decimal_sum``."""
    amount, count = _column(amount), _column(count)
    exact = held_exactly(amount) * held_exactly(count, COUNT)
    return _decimal_sum(exact, amount.cast("double") * count.cast("double"))


def exact_sum(value: Column | str) -> Column:
    """Aggregate: sum of a numeric column as double; NULL for no values."""
    value = _column(value)
    return F.coalesce(decimal_sum(value).cast("double"), F.sum(value.cast("double")))


def exact_sum_product(amount: Column | str, count: Column | str) -> Column:
    """Aggregate: sum of ``amount * count`` as double, multiplied without rounding."""
    amount, count = _column(amount), _column(count)
    plain = F.sum(amount.cast("double") * count.cast("double"))
    return F.coalesce(decimal_sum_product(amount, count).cast("double"), plain)


def sum_of_parts(exact: Column | str, plain: Column | str) -> tuple[Column, Column]:
    """Aggregates: total of partial sums, as decimal (NULL if a part has none or it does not fit) and as double.

    ``exact`` holds the parts as decimals where there are any, ``plain`` as doubles.
    """
    exact, plain = _column(exact), _column(plain)
    total = _decimal_sum(exact, plain)
    return total, F.coalesce(total.cast("double"), F.sum(plain))


def exact_avg(value: Column | str, digits: int | None = None) -> Column:
    """Aggregate: mean of the non-NULL values as double, rounded half up if ``digits`` is given."""
    value = _column(value)
    if digits is not None:
        return rounded_ratio(exact_sum(value), F.count(value), digits)
    return exact_sum(value) / F.nullif(F.count(value), F.lit(0))


def rounded_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Ratio of an amount to a whole number as double, rounded half up; NULL for a zero denominator.

    Divides decimals: 70911.24 / 24 is the tie 2954.635, while the doubles give
    2954.6349999999998 and would round down. Amounts that a decimal does not
    hold are divided as doubles.
    """
    bottom = F.nullif(denominator, F.lit(0))
    exact = held_exactly(numerator, "decimal(30,8)") / bottom.cast("decimal(20,0)")
    plain = numerator.cast("double") / bottom.cast("double")
    return F.coalesce(F.round(exact, digits).cast("double"), F.round(plain, digits))
