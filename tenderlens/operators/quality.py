"""Quality reports and column profiles, each from one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlens import schema as S
from tenderlens.functions import number_column
from tenderlens.operators.cleaning import is_valid_money
from tenderlens.operators.describe import moment_rows
from tenderlens.operators.quantiles import exact_quantiles


def two_decimals(value: Column) -> Column:
    """Round the exact binary value to two decimals, ties to even."""
    return F.translate(F.format_number(value, 2), ",", "").cast("double")


def _report(initial: Column, final: Column, valid: Column) -> list[Column]:
    kept = F.when(initial > 0, two_decimals(final / initial * 100)).otherwise(0.0)
    return [
        initial.alias("filas_iniciales"),
        final.alias("filas_finales"),
        (initial - valid).alias("filas_descartadas_precio_invalido"),
        (valid - final).alias("duplicados_eliminados"),
        kept.alias("porcentaje_retencion"),
    ]


def quality_report(
    df: DataFrame, id_column: str = S.ID, price: str = S.PRICE, award: str = S.AWARD
) -> DataFrame:
    """Row balance of the cleaning, from the table before any filter."""
    valid = is_valid_money(df, price, award)
    unique = F.lit(None).cast("bigint")
    if id_column in df.columns:
        unique = F.count_distinct(F.when(valid, F.col(id_column))) + F.coalesce(
            F.max((valid & F.col(id_column).isNull()).cast("bigint")), F.lit(0)
        )
    totals = df.agg(
        F.count("*").alias("initial"), F.count_if(valid).alias("valid"), unique.alias("unique")
    )
    final = F.coalesce("unique", "valid")
    return totals.select(*_report(F.col("initial"), final, F.col("valid")))


def quality_balance(
    df: DataFrame, clean: DataFrame, price: str = S.PRICE, award: str = S.AWARD
) -> DataFrame:
    """The same report when the clean table is stored: two counts instead of a distinct count."""
    totals = df.agg(F.count("*").alias("initial"), F.count_if(is_valid_money(df, price, award)).alias("valid"))
    final = clean.agg(F.count("*")).scalar()
    return totals.select("*", final.alias("final")).select(
        *_report(F.col("initial"), F.col("final"), F.col("valid"))
    )


def _is_missing(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return F.col(name).isNull() | F.isnan(name)
    return F.col(name).isNull()


def null_counts(df: DataFrame) -> DataFrame:
    """``(columna, nulos)`` for every column.

    Missing categories stay NULL through the cleaning and are counted as such.
    """
    counts = df.agg(*[F.count_if(_is_missing(df, c)).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "columna", "nulos")


def column_profile(df: DataFrame) -> DataFrame:
    """Type, filled and missing values of every column, share of missing in percent."""
    kinds = F.create_map(*[F.lit(part) for pair in df.dtypes for part in pair])
    counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(~_is_missing(df, c)).alias(c) for c in df.columns])
    nulls = F.col("_rows") - F.col("no_nulos")
    return counts.unpivot(["_rows"], df.columns, "columna", "no_nulos").select(
        "columna",
        kinds[F.col("columna")].alias("dtype"),
        "no_nulos",
        nulls.alias("nulos"),
        two_decimals(F.try_divide(nulls, F.col("_rows")) * 100).alias("pct_nulos"),
    )


def overcost_rate(df: DataFrame, flag: str = S.OVERCOST_FLAG) -> DataFrame:
    """Rows, rows with an overrun and their share in percent."""
    return df.agg(
        F.count("*").alias("filas"),
        F.coalesce(F.sum(flag), F.lit(0)).cast("bigint").alias("con_sobrecosto"),
        (F.avg(flag) * 100).alias("tasa_sobrecosto_pct"),
    )


def retention(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Share of raw rows that the cleaning kept in percent; NULL for an empty input."""
    kept = clean.agg(F.count("*")).scalar()
    rows = raw.agg(F.count("*").alias("filas_iniciales")).select("*", kept.alias("filas_finales"))
    share = F.try_divide(F.col("filas_finales"), F.col("filas_iniciales")) * 100
    return rows.select("*", share.alias("tasa_retencion_pct"))


def describe_numeric(
    df: DataFrame, columns: Sequence[str] = tuple(S.DESCRIBED_COLUMNS), method: str = "narrow"
) -> DataFrame:
    """Count, mean, standard deviation, extremes and exact median of every column."""
    present = [c for c in columns if c in df.columns]
    values = df.select(*[number_column(df, c).alias(c) for c in present])
    moments = moment_rows(values, present, {
        "count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max,
    })
    medians = exact_quantiles(
        values.unpivot([], present, "variable", "value"), F.col("value"), {"p50": 0.5},
        ["variable"], method=method, groups_bounded=True,
    )
    return moments.join(F.broadcast(medians), "variable", "left").select(
        "variable", "count", "mean", "std", "min", "p50", "max"
    )
