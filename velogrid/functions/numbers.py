"""Numbers from text, rounding and clipping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from velogrid.schemas import SYSTEM_TAG


def thousands_int(text: Column) -> Column:
    """``'1,234'`` -> 1234; anything that is no number -> null."""
    return F.replace(text, F.lit(","), F.lit("")).try_cast("double").try_cast("int")


def decimal_comma(text: Column) -> Column:
    """Decimal point or comma; what is no number, ``NaN`` among it, is null."""
    number = F.replace(text, F.lit(","), F.lit(".")).try_cast("float")
    return F.when(~F.isnan(number), number)


def id_number(text: Column) -> Column:
    """Ids arrive as text: whole, as floats such as ``'12.0'`` or with an exponent. Decimals keep
    long ids exact, and no valid id fails a cast on the way, which would be slow. An id with a fraction is none."""
    exact = text.try_cast("decimal(38,6)")
    return F.when(exact == F.floor(exact), exact).try_cast("bigint")


def strip_tag(text: Column) -> Column:
    return F.replace(text, F.lit(SYSTEM_TAG), F.lit(""))


def half_even(value: Column, digits: int = 0) -> Column:
    return F.bround(value, digits)


def half_up(value: Column) -> Column:
    """Halves go towards plus infinity."""
    return F.floor(value + F.lit(0.5))


def at_least(value: Column, low: float) -> Column:
    """Clip from below; ``greatest`` alone would turn a null into the bound."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(low)))


def between_bounds(value: Column, low: float, high: float) -> Column:
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def share(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return share(part, whole) * 100

