"""Text renderings of figures, for printing only; result tables keep numbers."""

from pyspark.sql import Column, functions as F


def grouped_number(value: Column, digits: int = 0) -> Column:
    return F.format_number(value, digits)


def percent(value: Column, digits: int = 1) -> Column:
    return F.concat(F.format_number(value * 100, digits), F.lit("%"))


def currency(value: Column, digits: int = 2, sign: str = "£") -> Column:
    return F.concat(F.lit(sign), F.format_number(value, digits))
