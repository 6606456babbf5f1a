"""Text shown to people: compact numbers, percentages, durations, labels.

Fixed-point text rounds the exact binary value (an exact half goes up), as
browsers do; ``format_string('%.1f')`` rounds the shortest decimal form instead
and would show 1.45 as ``1.5`` where the value lies just below it.
"""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed


def fixed_point(value: Column, digits: int) -> Column:
    """Text with exactly ``digits`` decimals.

    Where the scaled value shows a fraction of one half, the sign of the exact
    remainder decides: the value is taken apart into a 24-bit head and the rest,
    whose products are both exact.
    """
    value = value.cast("double")
    size = F.abs(value)
    factor = 10**digits
    scaled = size * float(factor)
    whole = F.floor(scaled)
    fraction = scaled - whole
    head = size.cast("float").cast("double")
    remainder = (head * factor - (whole + 0.5)) + (size - head) * factor
    up = (fraction > 0.5) | ((fraction == 0.5) & (remainder >= 0))
    rounded = (whole + F.when(up, 1).otherwise(0)).cast("decimal(18,0)")
    signed = F.when(value < 0, -rounded).otherwise(rounded)
    return (signed * F.lit(Decimal(1).scaleb(-digits))).cast("string")


def round_half_up(value: Column) -> Column:
    """Nearest whole number, halves toward plus infinity."""
    return F.floor(value + 0.5).cast("bigint")


def grouped_number(value: Column) -> Column:
    """Thousands separators and at most three decimals, without trailing zeros."""
    rounded = F.round(value.cast("double"), 3)
    return F.call_function("format_number", rounded, F.lit("#,##0.###"))


def _plain_number(value: Column) -> Column:
    """Shortest text: whole doubles without a fraction."""
    wide = value.cast("double")
    whole = wide == F.floor(wide)
    return F.when(whole, wide.cast("bigint").cast("string")).otherwise(wide.cast("string"))


def compact_number(value: Column, *, guarded: bool = True) -> Column:
    """``1.2B`` / ``3.4M`` / ``5.6K`` or the number itself.

    Guarded text shows NULL and zero as ``0`` and groups thousands of the plain
    number; unguarded text is NULL for NULL.
    """
    wide = value.cast("double")
    units = ((1e9, "B"), (1e6, "M"), (1e3, "K"))
    unit, suffix = F.lit(None).cast("double"), F.lit("")
    for size, letter in reversed(units):
        unit = F.when(wide >= size, F.lit(size)).otherwise(unit)
        suffix = F.when(wide >= size, F.lit(letter)).otherwise(suffix)
    text = F.concat(fixed_point(wide / unit, 1), suffix)
    if guarded:
        return F.when(F.coalesce(wide, F.lit(0.0)) == 0, "0").otherwise(
            F.coalesce(text, grouped_number(wide))
        )
    return F.coalesce(text, _plain_number(value))


def percent(value: Column, *, guarded: bool = True) -> Column:
    """A rate with two decimals, NULL as zero; guarded text shows zero as ``0%``."""
    wide = F.coalesce(value.cast("double"), F.lit(0.0))
    text = F.concat(fixed_point(wide * 100, 2), F.lit("%"))
    if guarded:
        return F.when(wide == 0, "0%").otherwise(text)
    return text


def duration_text(seconds: Column) -> Column:
    """``N/A``, ``M:SS``, or ``Hh Mm`` above sixty minutes."""
    minutes = F.call_function("div", seconds, F.lit(60))
    hours = F.call_function("div", minutes, F.lit(60))
    long_form = F.concat(
        hours.cast("string"), F.lit("h "), (minutes % 60).cast("string"), F.lit("m")
    )
    short_form = F.concat(
        minutes.cast("string"), F.lit(":"), F.lpad((seconds % 60).cast("string"), 2, "0")
    )
    return (
        F.when(F.coalesce(seconds, F.lit(0)) == 0, "N/A")
        .when(minutes > 60, long_form)
        .otherwise(short_form)
    )


def minutes_text(seconds: Column) -> Column:
    """Whole minutes as ``Nm``."""
    minutes = round_half_up(F.coalesce(seconds, F.lit(0)) / 60)
    return F.concat(minutes.cast("string"), F.lit("m"))


def ellipsize(text: Column, limit: int) -> Column:
    """At most ``limit`` characters (code points), then an ellipsis."""
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("…"))
    ).otherwise(text)


def relabel(column: Column, labels: Iterable[tuple[str, str]], otherwise: Column | str) -> Column:
    chain = None
    for value, label in labels:
        test = column == value
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain.otherwise(otherwise)


def region_label(region: Column) -> Column:
    return relabel(region, fixed.REGION_LABELS.items(), fixed.REGION_LABEL_OTHERWISE)


def duration_label(category: Column) -> Column:
    return relabel(category, fixed.DURATION_LABELS, category)


def tier_label(tier: Column) -> Column:
    return relabel(tier, fixed.PERFORMANCE_TIER_SHORT_LABELS.items(), tier)


def day_label(day_of_week: Column) -> Column:
    return F.get(F.array(*[F.lit(name) for name in fixed.DAY_NAMES]), day_of_week - 1)


def spaced(text: Column) -> Column:
    """Underscores as spaces."""
    return F.replace(text, F.lit("_"), F.lit(" "))


def day_text(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def watch_link(video_id: Column) -> Column:
    return F.concat(F.lit(fixed.WATCH_LINK), video_id)


def absolute_url(address: Column) -> Column:
    """Addresses stay; bare ids become watch addresses."""
    return F.when(address.startswith("http"), address).otherwise(
        F.concat(F.lit(fixed.WATCH_URL), address)
    )


def tab_url(channel_url: Column, tab: Column) -> Column:
    """Address of a channel's ``videos`` or ``streams`` tab."""
    return F.concat(channel_url, F.lit("/"), tab)
