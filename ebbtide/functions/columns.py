"""Small column expressions shared by all operators."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: date | str) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def midnight(value: date | str) -> Column:
    """Zone-less timestamp literal at the start of a day."""
    return F.lit(f"{as_date(value).isoformat()} 00:00:00").cast("timestamp_ntz")


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """The value kept inside bounds; NULL stays NULL, unlike with greatest and least."""
    out = value
    if low is not None:
        out = F.when(value < low, F.lit(low)).otherwise(out)
    if high is not None:
        out = F.when(value > high, F.lit(high)).otherwise(out)
    return out


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Whole 24-hour periods between two zone-less timestamps, floored at zero."""
    return clip(F.extract(F.lit("DAY"), later - earlier), low=0)


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 of a zone-less timestamp, in no time zone."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (ts - origin).cast("interval second").cast("decimal(20,6)").cast("double")


def count_if(condition: Column) -> Column:
    """Rows where the condition holds (NULL counts as false)."""
    return F.count_if(F.coalesce(condition, F.lit(False)))


def finite(value: Column) -> Column:
    """The value as a double; NULL when it is no number, NaN or infinite."""
    number = value.cast("double")
    return F.when(
        number.isNotNull() & ~F.isnan(number) & (F.abs(number) < F.lit(float("inf"))), number
    )


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL for a zero denominator, also under ANSI mode."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio0(numerator: Column, denominator: Column) -> Column:
    """Division that gives 0 for a zero denominator."""
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def interval_index(value: Column, bounds: Sequence[Column | float], closed: str = "left") -> Column:
    """How many of the ascending ``bounds`` lie at or below ``value``.

    With ``closed="right"`` a value equal to a bound stays in the lower interval.
    A balanced decision tree: log2(n) comparisons per row, inside codegen.
    """
    limits = [b if isinstance(b, Column) else F.lit(float(b)) for b in bounds]

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        below = value < limits[middle] if closed == "left" else value <= limits[middle]
        return F.when(below, tree(low, middle)).otherwise(tree(middle + 1, high))

    return tree(0, len(limits))


def percent_text(share: Column) -> Column:
    """A share as a whole percentage, ties to even."""
    return F.concat(F.bround(share * 100.0, 0).cast("bigint").cast("string"), F.lit("%"))


def two_decimals(value: Column) -> Column:
    """Two decimals of the exact binary value, ties to even, as C and Python print it.

    ``value * 100`` is split into its rounded product and the exact remainder
    (Dekker), which decides on which side of a half the value really lies.
    """
    size = F.abs(value)
    spread = size * 134217729.0
    high = spread - (spread - size)
    low = size - high
    product = size * 100.0
    rest = (high * 100.0 - product) + low * 100.0
    whole = F.floor(product)
    half = product - whole.cast("double") - 0.5
    up = (half > 0) | ((half == 0) & ((rest > 0) | ((rest == 0) & (whole % 2 == 1))))
    cents = whole + up.cast("bigint")
    return F.concat(
        F.when(value < 0, "-").otherwise(""), F.floor(cents / 100).cast("string"), F.lit("."),
        F.lpad((cents % 100).cast("string"), 2, "0"))


def plain_number(value: Column) -> Column:
    """Up to four decimals without trailing zeros."""
    return F.regexp_replace(F.format_string("%.4f", value), r"\.?0+$", "")


def reasons(*pairs: tuple[Column, Column | str]) -> Column:
    """Array of the texts whose condition holds, in the given order."""
    return F.array_compact(
        F.array(*[F.when(test, F.lit(text) if isinstance(text, str) else text)
                  for test, text in pairs])
    )
