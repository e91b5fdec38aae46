"""Dates as people write them, read one by one in a single expression.

One regular expression knows all forms and picks a text to pieces: year first, numbers with the
year last, a month by name before or after the day, eight digits; then, if given, the time,
with seconds, a fraction, am or pm, and a zone. The zone is left out: a date is the wall time
that is written down.
"""

from enum import Enum

from pyspark.sql import Column, DataFrame, functions as F


class Order(str, Enum):
    """What ``1/2/2020`` and ``1-2-2020`` begin with. ``1.2.2020`` always begins with the day."""

    MONTH_FIRST = "month first"
    DAY_FIRST = "day first"


MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_MONTH = f"({'|'.join(MONTHS)})[a-z]*\\.?"
_NTH = r"(\d{1,2})(?:st|nd|rd|th)?"

_DATE = "|".join([
    r"(\d{4})([-/.])(\d{1,2})\2(\d{1,2})",  # 1 year, 3 month, 4 day
    r"(\d{1,2})([-/])(\d{1,2})\6(\d{4}|\d{2})",  # 5 first, 6 separator, 7 second, 8 year
    r"(\d{1,2})\.(\d{1,2})\.(\d{4}|\d{2})",  # 9 day, 10 month, 11 year
    rf"{_NTH}[ -]?{_MONTH}[ ,-]*(\d{{4}})",  # 12 day, 13 month, 14 year
    rf"{_MONTH}[ -]*{_NTH}(?:, *| +|-)(\d{{4}})",  # 15 month, 16 day, 17 year
    r"(\d{4})(\d\d)(\d\d)",  # 18 year, 19 month, 20 day
])
# 21 hour, 22 minute, 23 second, 24 fraction, 25 am or pm
_CLOCK = r"(?:[t ]|, ?) *(\d{1,2}):(\d{1,2})(?::(\d{1,2})(?:[.,](\d{1,9}))?)?(?: *([ap])\.?m\.?)?"
# 26 hour, 27 minute, 28 second
_DIGITS = r"[t ]?(\d\d)(\d\d)(\d\d)?"
_ZONE = r"(?: *(?:z|utc|gmt|[+-]\d\d:?(?:\d\d)?))?"
_WEEKDAY = r"(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,? +)?"
_WHOLE = rf"\A\s*{_WEEKDAY}(?:{_DATE})(?:(?:{_CLOCK}|{_DIGITS}){_ZONE})?\s*\z"

# What is made of a text: am or pm, a bar, and the date as a cast reads it. Of the groups for one
# place only one is not empty.
_MADE = "\x01"
_YEAR, _TIME = "$1$8$11$14$17$18", "$21$26:$22$27:$23$28.$24"
_MONTH_DAY = {
    Order.MONTH_FIRST: "$3$5$10$13$15$19-$4$7$9$12$16$20",
    Order.DAY_FIRST: "$3$7$10$13$15$19-$4$5$9$12$16$20",
}

# The most frequent form, day and month as numbers and the time without seconds: it is put together from
# what stands between slashes and the space, without the expression for all forms.
_PLAIN = r"\A\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}\z"

# Two digits of a year from this one on are of the last century, whatever today is.
_PIVOT = 69


def read_date(text: Column, order: Order = Order.MONTH_FIRST) -> Column:
    """The wall time of a text; NULL for another text and for days and times that do not exist."""
    written = F.lit(f"{_MADE}$25|{_YEAR}-{_MONTH_DAY[order]} {_TIME}")
    made = F.regexp_replace(F.lower(text), F.lit(_WHOLE), written)

    def numbered(date: Column) -> Column:
        """Month names as numbers."""
        for i, name in enumerate(MONTHS, 1):
            date = F.replace(date, F.lit(f"-{name}-"), F.lit(f"-{i}-"))
        return date

    def built(m: Column) -> Column:
        date = F.rtrim(F.substring_index(m, "|", -1), F.lit(":. "))
        date = F.when(date.rlike("[a-z]"), numbered(date)).otherwise(date)
        century = F.when(F.substring(date, 1, 2).try_cast("int") < _PIVOT, "20").otherwise("19")
        date = F.when(F.instr(date, "-") == 3, F.concat(century, date)).otherwise(date)
        at = F.when(~date.startswith("0000"), date.try_cast("timestamp_ntz"))
        half = F.substring(m, 2, 1)
        hours = F.make_dt_interval(F.lit(0), F.hour(at) % 12 - F.hour(at) + F.when(half == "p", 12).otherwise(0))
        of_half = F.when(F.hour(at).between(1, 12), at + hours)
        return F.when(m.startswith(_MADE), F.when(half == "|", at).otherwise(of_half))

    # Made once, for all that is read off it.
    any_form = F.get(F.transform(F.array(made), built), F.lit(0))
    day, clock = F.substring_index(text, " ", 1), F.substring_index(text, " ", -1)
    first, second = F.substring_index(day, "/", 1), F.substring_index(F.substring_index(day, "/", 2), "/", -1)
    parts = (first, second) if order == Order.MONTH_FIRST else (second, first)
    plain = F.concat_ws("-", F.substring_index(day, "/", -1), *parts)
    plain = F.when(~plain.startswith("0000"), F.concat_ws(" ", plain, clock).try_cast("timestamp_ntz"))
    return F.when(text.rlike(_PLAIN), plain).otherwise(any_form)


class MixedOrders(ValueError):
    """Days and months cannot be in the same order in all dates."""


def order_of(dates: DataFrame, column: str) -> Order | None:
    """The order of day and month, from numbers above 12 in the whole table; None if there are none.

    A table in which both places hold such numbers was put together from feeds of both
    orders and has to be taken apart by whoever knows which is which.
    """
    first, second = (F.regexp_extract(column, r"\A\s*(\d{1,2})([-/])(\d{1,2})\2\d", i).try_cast("int") for i in (1, 3))
    days_first, days_second = dates.agg(
        F.count(F.when((first > 12) & (second <= 12), 1)), F.count(F.when((second > 12) & (first <= 12), 1))
    ).first()
    if days_first and days_second:
        raise MixedOrders(f"{days_first} dates begin with the day and {days_second} with the month")
    if days_first or days_second:
        return Order.DAY_FIRST if days_first else Order.MONTH_FIRST
    return None
