"""Small number, time and text functions used by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000
DAY_SECONDS = 86_400

# Fixed value: the time format of a log file's name.
LOG_NAME_TIME = "yyMMdd_HHmmss"


def seconds(micros: Column) -> Column:
    return micros / F.lit(float(MICROS))


def seconds_between(start: Column, end: Column) -> Column:
    """Wall-clock seconds from one timestamp to another."""
    return seconds(F.unix_micros(end) - F.unix_micros(start))


def whole_days(value: Column) -> Column:
    return F.floor(value / F.lit(DAY_SECONDS)).cast("bigint")


def rest_of_day(value: Column) -> Column:
    """Seconds left after the whole days."""
    return value - whole_days(value) * F.lit(DAY_SECONDS)


def as_interval(value: Column) -> Column:
    """Seconds as a day-to-second interval, for display."""
    return F.make_dt_interval(secs=value.cast("decimal(18,6)"))


def percentage(part: Column, whole: Column) -> Column:
    return F.try_divide(F.lit(100) * part, whole)


def element_count(shape: Column) -> Column:
    """Number of elements of an array of that shape: the product of its sizes."""
    return F.aggregate(shape, F.lit(1).cast("bigint"), lambda total, size: total * size)


def log_name_time(name: Column) -> Column:
    """Time written in a log file's name; NULL where there is none."""
    return F.try_to_timestamp(name, F.lit(LOG_NAME_TIME))


def local_time(moment: Column, zone: str, source: str | None = None) -> Column:
    """Wall-clock time in a named zone; ``source`` is the zone of a timestamp that has none."""
    written = F.lit(source) if source else None
    return F.convert_timezone(written, F.lit(zone), moment.cast("timestamp_ntz"))


def fixed_text(value: Column, digits: int) -> Column:
    """A number with ``digits`` decimals; ``nan`` and ``inf`` in lower case without a sign of plus."""
    plain = F.format_string(f"%.{digits}f", value)
    infinite = F.when(value > 0, "inf").otherwise("-inf")
    finite = F.abs(value) < float("inf")
    return F.when(F.isnan(value), "nan").when(finite | value.isNull(), plain).otherwise(infinite)


def summary_line(label: str, value: Column, unit: str) -> Column:
    """A report line: the label padded to 30 characters, then the value with two decimals."""
    return F.concat(F.rpad(F.lit(label), 30, " "), F.lit(" "), fixed_text(value, 2), F.lit(unit))
