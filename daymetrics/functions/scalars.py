"""Column expressions: dates, units, rounding, labels. All built-in, all inside codegen."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymetrics import constants as K


# --- dates -----------------------------------------------------------------------------

def epoch_day(n: Column) -> Column:
    """Days since 1970-01-01 as DATE; a fraction is cut off."""
    return F.date_from_unix_date(n.cast("int"))


def epoch_day_to_iso(n: Column) -> Column:
    """Days since 1970-01-01 as 'YYYY-MM-DD'."""
    return iso(epoch_day(n))


def iso(day: Column) -> Column:
    """DATE as 'YYYY-MM-DD'."""
    return day.cast("string")


def day_column(df: DataFrame, name: str = "local_date") -> Column:
    """The day column as DATE, whether the table publishes it as DATE or as ISO text."""
    col = F.col(name)
    return col if isinstance(df.schema[name].dataType, T.DateType) else col.cast("date")


def month_number(day: Column) -> Column:
    """202403 for a DATE in March 2024."""
    return F.year(day) * 100 + F.month(day)


def day_literal(value: date | str) -> Column:
    return F.lit(value).cast("date")


def weekday_name(day: Column) -> Column:
    """Spanish weekday name; F.weekday has Monday = 0."""
    return F.element_at(F.array(*map(F.lit, K.WEEKDAY_NAMES)), F.weekday(day) + 1)


# --- units -----------------------------------------------------------------------------

def ms_to_hours(ms: Column) -> Column:
    return ms / F.lit(1000.0) / F.lit(3600.0)


def ms_to_minutes(ms: Column) -> Column:
    return ms / F.lit(1000.0) / F.lit(60.0)


def thousandth(x: Column) -> Column:
    """Grams to kilograms, calories to kilocalories."""
    return x / F.lit(1000.0)


# --- sums ------------------------------------------------------------------------------

#: Sizes below this are added without loss, down to a 2^60th.
_EXACT_BELOW = 2.0**32


def exact_sum(x: Column) -> Column:
    """Sum of doubles (an aggregate) that does not depend on the order of rows.

    Each value is split into two whole numbers, multiples of 2^-20 and the rest in multiples of
    2^-60; both are added as such and the total is rounded once. A value that is not finite has
    the sum it has in any order: NaN, or an infinity, or NaN for both of these. Finite values of
    4.3 billion and more, which no reading is, are added as doubles. NULLs are left out.
    """
    plain = F.abs(x) < _EXACT_BELOW  # false for NaN, which is above all numbers
    whole = F.floor(x * 2.0**20)
    rest = ((x * 2.0**20 - whole) * 2.0**40).cast("long")
    high, low = (F.sum(F.when(plain, part).cast("decimal(20,0)")) for part in (whole, rest))
    exact = (high * F.lit(1 << 40).cast("decimal(13,0)") + low).cast("double") / 2.0**60
    others = F.sum(F.when(~plain, x))
    return F.when(others.isNull(), exact).otherwise(others + F.coalesce(exact, F.lit(0.0)))


# --- rounding --------------------------------------------------------------------------

def round_half_away(x: Column, digits: int) -> Column:
    """Scale, round half away from zero, scale back (SQL ROUND on a double).

    Spark's own round would go through a BigDecimal per value. rint and the distance to it
    are exact, so only a tie that rint took down has to be put up.
    """
    scale = F.lit(10.0**digits)
    size = F.abs(x * scale)
    near = F.rint(size)
    whole = F.when(size - near == 0.5, near + 1).otherwise(near)
    return F.when(x < 0, -whole).otherwise(whole) / scale


def round_half_even(x: Column, digits: int) -> Column:
    """Scale, round half to even, scale back (array-library rounding)."""
    scale = F.lit(10.0**digits)
    return F.rint(x * scale) / scale


def round_exact(x: Column, digits: int) -> Column:
    """Round the exact binary value, so 7.35 (stored a little below) gives 7.3, not 7.4.

    Scaling alone can land on a tie that the stored value is not. Splitting x into two
    halves of 26 bits makes both partial products exact, and the sign of their distance to
    the half-way point then decides; only a true tie goes to even.
    """
    if digits == 0:
        return F.rint(x)
    scale = F.lit(10.0**digits)
    spread = x * F.lit(134217729.0)  # 2**27 + 1
    high = spread - (spread - x)
    low = x - high
    product = x * scale
    near = F.rint(product)
    below = F.when(near > product, near - 1).otherwise(near)
    past_half = (high * scale - (below + F.lit(0.5))) + low * scale
    whole = (
        F.when(past_half > 0, below + 1).when(past_half < 0, below).otherwise(near)
    )
    return whole / scale


def to_int(x: Column) -> Column:
    """INTEGER cast that rounds a double half to even instead of cutting it."""
    return F.rint(x.cast("double")).cast("int")


# --- guards ----------------------------------------------------------------------------

def clip01(x: Column) -> Column:
    """Bound to [0, 1]. NULL stays NULL: greatest/least on their own would skip it."""
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)))


def sleep_efficiency(hours: Column, awake_minutes: Column) -> Column:
    """Share of the time in bed not spent awake, three decimals, NULL without stages."""
    in_bed = hours * F.lit(60.0)
    return round_half_even(clip01(F.try_divide(in_bed - awake_minutes, in_bed)), 3)


# --- labels ----------------------------------------------------------------------------

def lookup(key: Column, table: Mapping, default: str) -> Column:
    """Dictionary lookup; an unknown or NULL key gives the default."""
    if not table:
        return F.lit(default)
    pairs = [F.lit(v) for pair in table.items() for v in pair]
    return F.coalesce(F.create_map(*pairs)[key], F.lit(default))


def exercise_label(code: Column, labels: Mapping[int, str] = K.EXERCISE_LABELS) -> Column:
    return lookup(code, labels, K.OTHER_EXERCISE)
