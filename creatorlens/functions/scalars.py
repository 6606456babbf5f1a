"""NULL-exact arithmetic, fallbacks and classification."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; NULL when either side is NULL or the divisor is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def greatest_strict(*columns: Column) -> Column:
    """``greatest`` that is NULL as soon as one argument is NULL."""
    complete = columns[0].isNotNull()
    for column in columns[1:]:
        complete = complete & column.isNotNull()
    return F.when(complete, F.greatest(*columns))


def first_filled(*columns: Column) -> Column:
    """First argument that is neither NULL nor the empty string."""
    return F.coalesce(*[F.nullif(column, F.lit("")) for column in columns])


def has_text(column: Column) -> Column:
    """True when a character other than Unicode white space occurs."""
    return column.rlike(r"(?U)\S")


def clip(column: Column, limit: int) -> Column:
    """First ``limit`` characters, NULL as the empty string."""
    return F.substring(F.coalesce(column, F.lit("")), 1, limit)


def day(as_of: date | Column | None) -> Column:
    """The reporting day: a date, a column, or today."""
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")


def days_between(as_of: date | Column | None, since: Column) -> Column:
    return F.datediff(day(as_of), since)


def _bands(tests: Iterable[tuple[str, Column]], otherwise: str) -> Column:
    chain = None
    for label, test in tests:
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain.otherwise(otherwise)


def size_tier(subscribers: Column) -> Column:
    return _bands(
        ((label, subscribers >= least) for label, least in fixed.SIZE_TIERS),
        fixed.SIZE_TIER_OTHERWISE,
    )


def duration_category(seconds: Column) -> Column:
    return _bands(
        ((label, seconds < below) for label, below in fixed.DURATION_CATEGORIES),
        fixed.DURATION_CATEGORY_OTHERWISE,
    )


def performance_tier(views_vs_benchmark: Column) -> Column:
    return _bands(
        ((label, views_vs_benchmark >= least) for label, least in fixed.PERFORMANCE_TIERS),
        fixed.PERFORMANCE_TIER_OTHERWISE,
    )


def iso_day(compact: Column) -> Column:
    """``yyyyMMdd`` text as ISO text; empty is NULL, anything else stays as it is."""
    eight_digits = F.when(compact.rlike(r"^\d{8}$"), compact)
    parsed = F.date_format(F.try_to_date(eight_digits, "yyyyMMdd"), "yyyy-MM-dd")
    return F.coalesce(parsed, F.nullif(compact, F.lit("")))
