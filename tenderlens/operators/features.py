"""Overrun and duration features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlens import schema as S
from tenderlens.functions import duration_days, number_column, parse_number
from tenderlens.functions.numeric import null_if_nan


def _number(name: str) -> Column:
    return null_if_nan(F.col(name).cast("double"))


def overcost_amount(price: str = S.PRICE, award: str = S.AWARD) -> Column:
    """Award minus base price."""
    return _number(award) - _number(price)


def overcost_ratio(price: str = S.PRICE, award: str = S.AWARD) -> Column:
    """Overrun as a share of the base price; 0 where the base is missing or not positive."""
    relative = F.try_divide(overcost_amount(price, award), _number(price))
    return F.when(_number(price) > 0, relative).otherwise(0.0)


def overcost_flag(price: str = S.PRICE, award: str = S.AWARD) -> Column:
    """1 for a positive overrun, else 0."""
    return F.coalesce((overcost_amount(price, award) > 0).cast("int"), F.lit(0))


def _magnitude(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_number(F.col(name), keep_overflow=True)
    return number_column(df, name)


def add_overcost(df: DataFrame, price: str = S.PRICE, award: str = S.AWARD) -> DataFrame:
    """The three overrun columns."""
    return df.withColumns({
        S.OVERCOST: overcost_amount(price, award),
        S.OVERCOST_RATIO: overcost_ratio(price, award),
        S.OVERCOST_FLAG: overcost_flag(price, award),
    })


def add_duration_days(
    df: DataFrame, duration: str = S.DURATION, unit: str = S.DURATION_UNIT
) -> DataFrame:
    """Duration in days; without a unit column the bare number, without a duration nothing."""
    if duration not in df.columns:
        return df
    if unit not in df.columns:
        return df.withColumn(S.DURATION_DAYS, number_column(df, duration))
    return df.withColumn(S.DURATION_DAYS, duration_days(_magnitude(df, duration), F.col(unit)))


def add_features(
    df: DataFrame,
    price: str = S.PRICE,
    award: str = S.AWARD,
    duration: str = S.DURATION,
    unit: str = S.DURATION_UNIT,
) -> DataFrame:
    """All derived columns of the first stage."""
    return add_duration_days(add_overcost(df, price, award), duration, unit)
