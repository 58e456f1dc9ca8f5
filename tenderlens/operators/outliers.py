"""Outliers by quartile fences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlens import schema as S
from tenderlens.functions import exceeds, number_column
from tenderlens.operators.quantiles import exact_quantiles

# Default columns of the outlier table.
INFO_COLUMNS = [
    S.ID, S.REFERENCE, S.ENTITY, S.CITY, S.MODALITY, S.PRICE, S.AWARD, S.DURATION_DAYS,
]


def tukey_bounds(df: DataFrame, value: str, k: float = 1.5, method: str = "narrow") -> DataFrame:
    """One row: quartiles, interquartile range and both fences.  No row without values."""
    return fences(exact_quantiles(
        df, number_column(df, value), {"q1": 0.25, "q3": 0.75}, method=method
    ), k)


def fences(quartiles: DataFrame, k: float = 1.5) -> DataFrame:
    """The row of ``tukey_bounds`` from its quartiles ``q1`` and ``q3``."""
    spread = F.col("q3") - F.col("q1")
    return quartiles.select(
        "q1", "q3", spread.alias("iqr"),
        (F.col("q1") - k * spread).alias("limite_inferior"),
        (F.col("q3") + k * spread).alias("limite_superior"),
    )


def _as_scalar(bounds: DataFrame) -> Column:
    """The fences as one scalar subquery, which runs once."""
    return bounds.select(F.struct("*")).scalar()


def tukey_flags(
    df: DataFrame, value: str, k: float = 1.5, bounds: DataFrame | None = None,
    method: str = "narrow",
) -> DataFrame:
    """Every row with its outlier marks; missing values are no outliers."""
    fence = _as_scalar(bounds if bounds is not None else tukey_bounds(df, value, k, method))
    amount = number_column(df, value)
    above = F.coalesce(amount > fence["limite_superior"], F.lit(False))
    below = F.coalesce(amount < fence["limite_inferior"], F.lit(False))
    return df.select(
        "*", above.alias("atipico_superior"), below.alias("atipico_inferior"),
        (above | below).alias("atipico"),
    )


def tukey_summary(
    df: DataFrame, value: str, k: float = 1.5, bounds: DataFrame | None = None,
    method: str = "narrow",
) -> DataFrame:
    """One row: the fences and how many values lie beyond them."""
    bounds = bounds if bounds is not None else tukey_bounds(df, value, k, method)
    amount = number_column(df, value).alias("value")
    counts = tukey_flags(df.select(amount), "value", k, bounds).agg(
        F.count("value").alias("total_validos"),
        F.count_if("atipico").alias("conteo_outliers"),
        F.count_if("atipico_superior").alias("conteo_outliers_superiores"),
        F.count_if("atipico_inferior").alias("conteo_outliers_inferiores"),
    )
    share = F.try_divide(F.col("conteo_outliers"), F.col("total_validos")) * 100
    fence = _as_scalar(bounds)
    return counts.select(
        *[fence[c].alias(c) for c in ("q1", "q3", "iqr", "limite_inferior", "limite_superior")],
        "total_validos", "conteo_outliers",
        "conteo_outliers_superiores", "conteo_outliers_inferiores",
        F.coalesce(share, F.lit(0.0)).alias("porcentaje_outliers"),
    )


def top_outliers(
    df: DataFrame,
    value: str,
    top_n: int = 10,
    k: float = 1.5,
    info_columns: Sequence[str] = tuple(INFO_COLUMNS),
    tie_break: Sequence[str] = (S.ID,),
    bounds: DataFrame | None = None,
    method: str = "narrow",
) -> DataFrame:
    """The ``top_n`` largest upper outliers with their context, largest first."""
    bounds = bounds if bounds is not None else tukey_bounds(df, value, k, method)
    fence = bounds.select("limite_superior").scalar()  # a plain value reaches the scan
    shown = [c for c in info_columns if c in df.columns]
    shown += [] if value in shown else [value]
    ties = [c for c in tie_break if c in df.columns]
    amount = number_column(df, value)
    return (
        df.where(exceeds(df, value, fence))
        .orderBy(amount.desc(), *ties).limit(top_n).select(*shown)
    )
