"""Cosmetic strings; the numeric columns stay the contract."""

from pyspark.sql import Column, functions as F


def counted(x: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(x, 0)


def decimals(x: Column, places=2) -> Column:
    return F.format_string(f"%.{places}f", x.cast("double"))


def money(x: Column, places=2) -> Column:
    return F.concat(F.lit("$"), decimals(x, places))


def rate(x: Column) -> Column:
    return F.concat(money(x), F.lit("/1M"))


def times(x: Column) -> Column:
    return F.concat(decimals(x), F.lit("x"))


def yes_no(x: Column) -> Column:
    return F.when(x, F.lit("Yes")).otherwise(F.lit("No"))
