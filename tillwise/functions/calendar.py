"""Date and time expressions that do not depend on the session time zone."""

from pyspark.sql import Column, functions as F


def parse_wall_time(text: Column, pattern: str) -> Column:
    """Parse text to a zone-less timestamp; text that does not fit becomes NULL.

    The text is read as UTC and turned back into wall time by arithmetic, so hours
    skipped by daylight saving in the session zone survive.
    """
    instant = F.try_to_timestamp(F.concat(text, F.lit(" Z")), F.lit(pattern + " X"))
    seconds = (F.unix_micros(instant).cast("decimal(18,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def weekend_flag(day: Column) -> Column:
    return (F.weekday(day) >= 5).cast("int")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def months_between_starts(later: Column, earlier: Column) -> Column:
    """Whole months from one month to another, as an integer."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def period_label(month_name: Column, year: Column) -> Column:
    """'Jan 2011' style label."""
    return F.concat(F.substring(month_name, 1, 3), F.lit(" "), year.cast("string"))
