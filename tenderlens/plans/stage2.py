"""Stage 2: descriptive statistics, outliers, competition, chart tables."""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlens import schema as S
from tenderlens.functions import band_order, days_text, money_text, number_column, percent_text, skew_text
from tenderlens.operators import charts, describe, grouped, outliers
from tenderlens.operators.quantiles import Request, quantile_answers, quantiles_of
from tenderlens.plans.tables import Tables
from tenderlens.sources import kept


_QUARTILES = {"q1": 0.25, "mediana": 0.5, "q3": 0.75}


def _known_quantiles(clean: DataFrame) -> dict[str, dict[str, DataFrame]]:
    """All quantiles of the stage, as the arguments of the functions that use them.

    Two scans of the clean table find them together; the answers, a row per column, modality and
    band, are stored.
    """
    numbers = list(dict.fromkeys([*S.STATISTICS_COLUMNS, S.AWARD, S.DURATION_DAYS]))
    band = band_order(number_column(clean, S.BIDDERS)).alias("banda_orden")
    rows = clean.select(S.MODALITY, band, *[number_column(clean, c).alias(c) for c in numbers])
    requests = {c: Request(F.col(c), _QUARTILES) for c in numbers}
    positive = F.when(F.col(S.AWARD) > 0, F.log10(S.AWARD))
    requests["log"] = Request(positive, {"q1": 0.25, "q3": 0.75})
    requests["modality"] = Request(F.col(S.AWARD), _QUARTILES, [S.MODALITY])
    for name, column in (("mediana_valor_adjudicado", S.AWARD), ("mediana_duracion_dias", S.DURATION_DAYS)):
        requests[name] = Request(F.col(column), {name: 0.5}, ["banda_orden"], groups_bounded=True)
    answers = kept(quantile_answers(rows, requests))
    found = {name: quantiles_of(answers, requests, name) for name in requests}
    columns = reduce(DataFrame.unionByName, [
        found[c].select(F.lit(c).alias("variable"), *_QUARTILES) for c in S.STATISTICS_COLUMNS])
    bands = found["mediana_valor_adjudicado"].join(found["mediana_duracion_dias"], "banda_orden", "full")
    return {
        "central": {"medians": columns.select("variable", "mediana")},
        "dispersion": {"quartiles": columns.select("variable", "q1", "q3")},
        "modality": {"quartiles": found["modality"]}, "competition": {"medians": bands},
        "histogram": {"quartiles": found["log"]}, "lines": {"median": found[S.AWARD].select("mediana")},
        "award": {"bounds": outliers.fences(found[S.AWARD])}, "days": {"bounds": outliers.fences(found[S.DURATION_DAYS])},
    }


def run_stage2(clean: DataFrame, method: str = "narrow") -> Tables:
    """Result tables by name, each lazy and reading only the columns it needs.

    The quantiles of all tables are computed up front, in two scans together.  Other methods than ``narrow``
    find them table by table.
    """
    q = defaultdict(lambda: {"method": method}, _known_quantiles(clean) if method == "narrow" else {})
    return Tables({
        "central": lambda: describe.central_tendency(clean, **q["central"]),
        "dispersion": lambda: describe.dispersion(clean, **q["dispersion"]),
        "by_modality": lambda: grouped.dispersion_by_group(clean, **q["modality"]),
        "tukey_award": lambda: outliers.tukey_summary(clean, S.AWARD, **q["award"]),
        "tukey_days": lambda: outliers.tukey_summary(clean, S.DURATION_DAYS, **q["days"]),
        "top_award": lambda: outliers.top_outliers(clean, S.AWARD, **q["award"]),
        "top_days": lambda: outliers.top_outliers(clean, S.DURATION_DAYS, **q["days"]),
        "competition": lambda: grouped.competition_contrast(clean, **q["competition"]),
        "award_histogram": lambda: charts.log_histogram(clean, **q["histogram"]),
        "award_density": lambda: charts.density_curve(clean, cut=0.0),
        "award_lines": lambda: charts.reference_lines(clean, **q["lines"]),
        "boxes": lambda: charts.boxplot_by_group(clean, **q["modality"]),
        "competition_points": lambda: charts.competition_points(clean),
        "competition_grid": lambda: charts.competition_grid(clean),
    })


def _amount_text(variable: str, value: str) -> Column:
    amount = F.col(value)
    return F.when(F.col(variable).contains("duracion"), days_text(amount)).otherwise(money_text(amount))


def central_report(central: DataFrame) -> DataFrame:
    """Printed form of the table of central tendency."""
    return central.select(
        "variable",
        *[_amount_text("variable", c).alias(c) for c in ("media", "mediana", "moda")],
        skew_text(F.col("skewness")).alias("skewness"),
        percent_text(F.col("divergencia_media_vs_mediana_pct"), signed=True)
        .alias("divergencia_media_vs_mediana_pct"),
        "interpretacion_sesgo",
    )


def dispersion_report(dispersion: DataFrame) -> DataFrame:
    """Printed form of the table of dispersion."""
    shown = ("desviacion_estandar", "q1", "q3", "iqr", "rango")
    return dispersion.select(
        "variable", *[_amount_text("variable", c).alias(c) for c in shown],
        percent_text(F.col("coeficiente_variacion_pct"), grouped=True)
        .alias("coeficiente_variacion_pct"),
    )


def modality_report(by_modality: DataFrame, key: str = S.MODALITY) -> DataFrame:
    """Printed form of the table by modality."""
    money = [money_text(F.col(c)).alias(c) for c in ("mediana", "iqr", "media", "std")]
    return by_modality.select(
        key, "conteo", percent_text(F.col("porcentaje_contratos")).alias("porcentaje_contratos"), *money
    )


def competition_report(competition: DataFrame) -> DataFrame:
    """Printed form of the table by band of competition."""
    return competition.select(
        "rango_competencia", "total_contratos",
        percent_text(F.col("porcentaje_del_total")).alias("porcentaje_del_total"),
        money_text(F.col("mediana_valor_adjudicado")).alias("mediana_valor_adjudicado"),
        percent_text(F.col("tasa_sobrecosto_pct")).alias("tasa_sobrecosto_pct"),
        "mediana_duracion_dias",
    )
