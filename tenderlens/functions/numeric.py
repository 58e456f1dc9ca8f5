"""Numeric coercion in which NULL is the only missing value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMBER = r"(?i)^[\s\x1c-\x1f]*([+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf|infinity))[\s\x1c-\x1f]*$"

# Digits with a decimal point, as programs write them; too short for the double range to end.
PLAIN_NUMBER = r"^[+-]?[0-9]{1,200}(\.[0-9]{1,200})?([eE][+-]?[0-9]{1,2})?\z"


def null_if_nan(value: Column) -> Column:
    """NaN compares as the largest number in Spark and poisons averages: fold it to NULL."""
    return F.nullif(value, F.lit(float("nan")))


def parse_number(text: Column, keep_overflow: bool = False) -> Column:
    """Plain decimal text to double, anything else to NULL.

    The pattern guards the cast, which would also take Java forms such as ``1f``; what
    does not match gives the empty string and so NULL.
    Texts of finite numbers past the double range give NULL; ``keep_overflow`` admits them
    as infinity.  Plain numbers, the bulk of written tables, are cast as they are.
    """
    short, cast = text.rlike(PLAIN_NUMBER), text.try_cast("double")
    plain = F.regexp_extract(text, _NUMBER, 1)
    number = plain.try_cast("double")
    if keep_overflow:
        return F.when(short, cast).otherwise(number)
    infinite = F.abs(number) == float("inf")
    return F.when(short, cast).when(~infinite | plain.rlike("(?i)inf"), number)


def number_column(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a double without NaN, whatever type the table stores."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return parse_number(F.col(name))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return null_if_nan(F.col(name).cast("double"))
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return F.col(name).cast("double")
    raise ValueError(f"Column '{name}' of type {kind.simpleString()} is not numeric")


def exceeds(df: DataFrame, name: str, bound: Column | float) -> Column:
    """True where column ``name`` is a number above ``bound``.

    Stored numbers are compared as they are, so that the filter reaches the scan.
    """
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return (F.col(name) > bound) & ~F.isnan(name)
    return number_column(df, name) > bound
