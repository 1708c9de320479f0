"""Casts that turn a bad value into NULL, whether or not the session runs in ANSI mode."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# A cast that fails, try_cast included, raises and catches an exception inside Spark: about a hundred times the price of
# a cast that works. So a pattern first picks the values that a cast can take.

# Characters that may surround a number: white space and control codes.
_PAD = r"[\x00-\x20\x7F]*"
# Whole numbers that always fit an int, maybe with decimals behind the point, which are cut off, not rounded.
_FITS_INT = rf"^{_PAD}[+-]?0*\d{{1,9}}(\.\d*)?{_PAD}$"
# Ten digits, which may fit.
_MAY_FIT_INT = rf"^{_PAD}[+-]?0*[12]\d{{9}}(\.\d*)?{_PAD}$"
# No digit before the point: the whole part is zero.
_ONLY_DECIMALS = rf"^{_PAD}[+-]?\.\d*{_PAD}$"
_DECIMAL = rf"^{_PAD}[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?{_PAD}$"
# Spellings of a double beyond that: names of special values, a type suffix, hexadecimal digits.
_ODD_DOUBLE = r"(?i)nan|inf|\d\.?[df]|0x"
# Texts that may be a date: a year, maybe a month and a day, maybe a time behind it.
_MAY_BE_DATE = rf"^{_PAD}[+-]?\d{{4,7}}(-\d{{1,2}}(-\d{{1,2}}([ T].*)?)?)?{_PAD}$"
_ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"


def lenient_int(c: Column) -> Column:
    """String to int: "3.7" gives 3, " 12 " gives 12, ".5" gives 0, anything else that is no int gives NULL."""
    whole = F.substring_index(c, ".", 1)
    return (
        F.when(c.rlike(_FITS_INT), whole.cast("int"))
        .when(c.rlike(_MAY_FIT_INT), whole.try_cast("int"))
        .when(c.rlike(_ONLY_DECIMALS), F.lit(0))
    )


def lenient_double(c: Column) -> Column:
    """String to double, NULL if it is none."""
    return F.when(c.rlike(_DECIMAL), c.cast("double")).when(c.rlike(_ODD_DOUBLE), c.try_cast("double"))


def lenient_date(c: Column) -> Column:
    """String or timestamp to date; the day of a datetime text is kept."""
    return F.when(c.cast("string").rlike(_MAY_BE_DATE), c.try_cast("date"))


def strict_date(c: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """String to date where the whole text must follow the pattern."""
    if pattern == "yyyy-MM-dd":
        return F.when(c.rlike(_ISO_DATE), c.try_cast("date"))
    return F.try_to_date(c, pattern)


def prefix_int(c: Column, length: int = 8) -> Column:
    """Int made of the first characters of a composite id. Ids that share them become equal."""
    return lenient_int(F.substring(c, 1, length))


def recode(c: Column, labels: Mapping[str, str]) -> Column:
    """Code to label; a code without a label gives NULL."""
    (first, label), *rest = labels.items()
    out = F.when(c == first, label)
    for code, label in rest:
        out = out.when(c == code, label)
    return out
