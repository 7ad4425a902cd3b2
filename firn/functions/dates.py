"""Fractional years as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x: Column | str | float) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(float(x))


def days_in_year(year: Column) -> Column:
    return F.datediff(F.make_date(year + 1, F.lit(1), F.lit(1)), F.make_date(year, F.lit(1), F.lit(1)))


def fractional_year(ts: Column | str) -> Column:
    """Date or timestamp to a fractional year, aware of leap years, exact to the microsecond."""
    ts = _col(ts).cast("timestamp_ntz")
    year = F.year(ts)
    seconds = F.timestamp_diff("MICROSECOND", F.make_date(year, F.lit(1), F.lit(1)).cast("timestamp_ntz"), ts) / 1e6
    return year + seconds / (days_in_year(year) * 86_400.0)


def from_fractional_year(x: Column | str) -> Column:
    """Fractional year to a timestamp without zone."""
    x = _col(x)
    year = F.floor(x).cast("int")
    micros = F.round((x - year) * days_in_year(year) * 86_400_000_000.0).cast("bigint")
    return F.timestamp_add("MICROSECOND", micros, F.make_date(year, F.lit(1), F.lit(1)).cast("timestamp_ntz"))


def month_index(x: Column | str) -> Column:
    """Months since year 0, rounded: a key that is safe to compare."""
    return F.rint(_col(x) * 12).cast("int")


def snap_to_month(x: Column | str) -> Column:
    """The nearest start of a month, half a month upwards."""
    return F.floor((_col(x) + 1 / 24) * 12) / 12


def nearest_year(x: Column | str, start: Column | str | float) -> Column:
    """The nearest year boundary at offset `start`; the lower one where both are as near."""
    x, start = _col(x), _col(start)
    low = F.floor(x - start) + start
    return F.when(x - low <= low + 1 - x, low).otherwise(low + 1)


def full_years(low: Column | str, high: Column | str, start: Column | str | float) -> Column:
    """Array of the starts of full years inside [low, high] whose years begin at offset `start`."""
    low, high, start = _col(low), _col(high), _col(start)
    first = F.floor(low).cast("int") - 1
    candidates = F.transform(F.sequence(first, F.greatest(first, F.ceil(high).cast("int"))), lambda y: y + start)
    return F.filter(candidates, lambda s: (s >= low) & (s + 1 <= high))


def distance_to_period(date: Column | str, first: Column | str, last: Column | str, resolution: Column | float = 1 / 12) -> Column:
    """0 inside [first, last), else the distance to it; behind it a step more."""
    date, first, last = _col(date), _col(first), _col(last)
    return F.when(date >= last, date - last + _col(resolution)).when(date < first, first - date).otherwise(0.0)


def three_digits(x: Column | str) -> Column:
    """Rounded to three significant digits, ties to even."""
    x = _col(x)
    scale = F.pow(F.lit(10.0), 2 - F.floor(F.log10(x)))
    return F.when(x > 0, F.rint(x * scale) / scale).otherwise(x)


def parsed_date(text: Column | str) -> Column:
    """dd/MM/yyyy to a date; null where it is none."""
    return F.try_to_timestamp(_col(text), F.lit("dd/MM/yyyy")).cast("date")
