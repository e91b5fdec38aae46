"""Money and rounding expressions.

Sums of doubles depend on the order of the rows, so a retried task could give a
total that differs in the last bits. Money is therefore added up as a decimal,
which is exact in any order, and only the finished total becomes a double.
"""

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DecimalType

# Digits kept behind the point, and in all: amounts below 1e30 with eight decimals.
MONEY_SCALE = 8
MONEY_PRECISION = 38


def money(value: Column | str, scale: int = MONEY_SCALE) -> Column:
    """The amount as an exact decimal; an amount that does not fit is an error.

    NULL stays NULL. Without the check a cast would turn infinities and, outside ANSI
    mode, overlong amounts into NULLs, which sums leave out.
    """
    column = F.col(value) if isinstance(value, str) else value
    exact = column.try_cast(exact_type(scale))
    unfit = F.raise_error(F.concat(F.lit("amount does not fit a decimal: "), column.cast("string")))
    return F.when(column.isNotNull() & exact.isNull(), unfit.cast(exact_type(scale))).otherwise(exact)


def exact_type(scale: int = MONEY_SCALE) -> DecimalType:
    return DecimalType(MONEY_PRECISION, scale)


def money_total(value: Column | str, scale: int = MONEY_SCALE) -> Column:
    """Exact sum, still a decimal, for totals that are added up again later."""
    return F.sum(money(value, scale))


def money_sum(value: Column | str, scale: int = MONEY_SCALE) -> Column:
    """Exact sum as a double."""
    return money_total(value, scale).cast("double")


def round_half_up(value: Column, digits: int) -> Column:
    """Round half away from zero, computed on the double itself."""
    factor = float(10**digits)
    return F.signum(value) * F.floor(F.abs(value) * F.lit(factor) + F.lit(0.5)) / F.lit(factor)


def round_half_even(value: Column, digits: int) -> Column:
    """Round half to even, the way pandas rounds a frame for display."""
    factor = float(10**digits)
    return F.rint(value * F.lit(factor)) / F.lit(factor)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as a double; NULL instead of an error when the divisor is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))
