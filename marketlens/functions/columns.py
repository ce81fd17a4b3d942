"""Money, ratio and calendar expressions. All of them stay inside code generation.

Money is summed as decimal and turned into double last, so that a total does not
depend on the order in which partitions are merged. A value keeps six decimals and twelve
digits before them; a larger one stops the job. Sums have ten digits more.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,6)"


def money(column: Column | str) -> Column:
    return _col(column).cast(MONEY)


def money_sum(column: Column | str) -> Column:
    return F.sum(money(column)).cast("double")


def money_mean(column: Column | str) -> Column:
    """Exact decimal sum divided by the number of non-null values."""
    return F.try_divide(money_sum(column), F.count(_col(column)).cast("double"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; null when the denominator is null or zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, null when `whole` is zero."""
    return F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double"))


def percent_true(flag: Column) -> Column:
    """Share of rows whose flag is true, in percent, as an aggregate."""
    return percent(F.count_if(flag), F.count(F.lit(1)))


def or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0.0))


def is_true(condition: Column) -> Column:
    """A comparison as a flag: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def date_key(column: Column | str) -> Column:
    """Calendar day as the integer yyyymmdd; null stays null."""
    c = _col(column)
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def as_timestamp(column: Column | str) -> Column:
    """Zone-free timestamp; text that is no timestamp becomes null."""
    return _col(column).try_cast("timestamp_ntz")


def round_even(column: Column, digits: int) -> Column:
    """Scales, rounds to the nearest integer (halves to even) and scales back."""
    scale = F.lit(10.0**digits)
    return F.rint(column * scale) / scale


def round_up(column: Column, digits: int) -> Column:
    """As `round_even`, halves away from zero."""
    scale = F.lit(10.0**digits)
    return F.round(column * scale) / scale


def decimal_text(name: str) -> Column:
    """The number `name` (column or SQL expression) as text with one decimal, rounded by its exact binary
    value and exact halves to even, as C-style formatting does.

    Spark's own formatter rounds the shortest decimal form half up (56.25 -> 56.3 and
    0.35 -> 0.4, though 0.35 is stored as 0.34999...). The fraction times ten is
    therefore taken with its rounding error (two-product by splitting the factor), which
    decides the cases that look like a half.
    """
    size = f"abs({name})"
    fraction = f"({size} - floor({size}))"
    scaled = f"({fraction} * 10D)"
    high = f"({fraction} * 134217729D - ({fraction} * 134217729D - {fraction}))"
    error = f"({high} * 10D - {scaled} + ({fraction} - {high}) * 10D)"
    looks_half = f"{scaled} - floor({scaled}) = 0.5D and {error} <> 0D"
    tenths = f"if({looks_half}, floor({scaled}) + if({error} > 0D, 1, 0), cast(rint({scaled}) as bigint))"
    total = f"(floor({size}) * 10 + {tenths})"
    return F.expr(
        f"if({name} < 0, '-', '') || cast({total} div 10 as string) || '.' || cast({total} % 10 as string)"
    )


def elapsed_hours(start: Column | str, end: Column | str) -> Column:
    """Elapsed time in hours with two decimals, halves to even."""
    micros = F.timestamp_diff("MICROSECOND", _col(start), _col(end))
    return round_even(micros.cast("double") / F.lit(3_600_000_000.0), 2)


def boundary_hours(start: Column | str, end: Column | str) -> Column:
    """Number of full-hour marks between two instants (10:59 to 11:01 is one)."""
    return F.timestamp_diff("HOUR", F.date_trunc("HOUR", _col(start)), F.date_trunc("HOUR", _col(end)))


def is_weekend(column: Column | str) -> Column:
    return F.weekday(_col(column)) >= 5


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
