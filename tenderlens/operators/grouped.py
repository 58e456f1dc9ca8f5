"""Summaries per modality and per band of competition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlens import schema as S
from tenderlens.functions import BAND_LABELS, band_order, number_column
from tenderlens.operators.quantiles import exact_quantiles


def _share_of(df: DataFrame, part: Column) -> Column:
    """``part`` in percent of all rows of ``df``, which are counted without reading a column."""
    return F.try_divide(part, df.agg(F.count("*")).scalar()) * 100


def dispersion_by_group(
    df: DataFrame, value: str = S.AWARD, key: str = S.MODALITY, method: str = "narrow",
    quartiles: DataFrame | None = None,
) -> DataFrame:
    """Count, mean, quartiles and spread of ``value`` per group, largest group first.

    Rows without a key form no group but belong to the total of the share.  ``quartiles``
    (the key, ``q1``, ``mediana``, ``q3``) if they are known already.
    """
    values = df.where(F.col(key).isNotNull()).select(key, number_column(df, value).alias("value"))
    moments = values.groupBy(key).agg(
        F.count("value").alias("conteo"), F.avg("value").alias("media"),
        F.stddev_samp("value").alias("std"),
    )
    if quartiles is None:
        quartiles = exact_quantiles(
            values, F.col("value"), {"q1": 0.25, "mediana": 0.5, "q3": 0.75}, [key], method=method
        )
    return (
        moments.join(quartiles, key, "left")
        .select(
            key, "conteo", "media", "mediana", "std", "q1", "q3",
            (F.col("q3") - F.col("q1")).alias("iqr"),
            _share_of(df, F.col("conteo")).alias("porcentaje_contratos"),
        )
        .orderBy(F.desc("conteo"), key)
    )


def _band_medians(rows: DataFrame, method: str) -> DataFrame:
    """Median of ``value`` and ``days`` per band."""
    # Both medians come from one pass: the band and the measure are the group.
    pairs = F.stack(F.lit(2), F.lit("value"), F.col("value"), F.lit("days"), F.col("days"))
    return (
        exact_quantiles(
            rows.select("banda_orden", pairs.alias("measure", "amount")),
            F.col("amount"), {"median": 0.5}, ["banda_orden", "measure"],
            method=method, groups_bounded=True,
        )
        .groupBy("banda_orden")
        .agg(*[
            F.max(F.when(F.col("measure") == measure, F.col("median"))).alias(name)
            for measure, name in [
                ("value", "mediana_valor_adjudicado"), ("days", "mediana_duracion_dias")
            ]
        ])
    )


def competition_contrast(
    df: DataFrame,
    competition: str = S.BIDDERS,
    value: str = S.AWARD,
    flag: str = S.OVERCOST_FLAG,
    id_column: str = S.ID,
    duration: str = S.DURATION_DAYS,
    method: str = "narrow",
    medians: DataFrame | None = None,
) -> DataFrame:
    """Contracts, typical amount, overrun rate and duration per band of competition.

    ``medians`` (``banda_orden``, ``mediana_valor_adjudicado``, ``mediana_duracion_dias``) if they are known already.
    """
    rows = df.select(
        band_order(number_column(df, competition)).alias("banda_orden"),
        F.col(id_column).alias("id"),
        number_column(df, value).alias("value"),
        F.col(flag).alias("flag"),
        number_column(df, duration).alias("days"),
    )
    moments = rows.groupBy("banda_orden").agg(
        F.count("id").alias("total_contratos"), F.avg("value").alias("media_valor_adjudicado"),
        (F.avg("flag") * 100).alias("tasa_sobrecosto_pct"),
    )
    if medians is None:
        medians = _band_medians(rows, method)
    labels = F.array(*[F.lit(label) for label in BAND_LABELS])
    return (
        moments.join(F.broadcast(medians), "banda_orden", "left")
        .select(
            "banda_orden", F.element_at(labels, F.col("banda_orden")).alias("rango_competencia"),
            "total_contratos", "mediana_valor_adjudicado", "media_valor_adjudicado",
            "tasa_sobrecosto_pct", "mediana_duracion_dias",
            _share_of(df, F.col("total_contratos")).alias("porcentaje_del_total"),
        )
        .orderBy("banda_orden")
    )
