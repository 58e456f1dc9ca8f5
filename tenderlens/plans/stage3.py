"""Stage 3: train, evaluate and store the model; chart tables of the predictions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlens import schema as S
from tenderlens.operators import charts, regression
from tenderlens.plans.tables import Tables
from tenderlens.sources import shared_folder


@dataclass
class Stage3Result:
    """Fitted model, where it was stored, and lazy result tables."""

    model: PipelineModel
    model_path: str
    predictions: DataFrame
    metrics: DataFrame
    coefficients: DataFrame
    charts: Tables


def _summary_plans(clean: DataFrame, predictions: DataFrame, method: str) -> dict[str, Callable[[], DataFrame]]:
    return {
        "price_density": lambda: charts.density_curve(clean, S.PRICE),
        "award_density": lambda: charts.density_curve(clean, S.AWARD),
        "award_ratio": lambda: charts.award_ratio_points(clean),
        "award_ratio_axis": lambda: charts.award_ratio_axis(clean),
        "error_histogram": lambda: charts.error_histogram(predictions),
        "error_density": lambda: charts.error_density(predictions),
        "risk_alerts": lambda: charts.risk_alerts(predictions),
        "risk_axis": lambda: charts.risk_axis(predictions, method=method),
    }


def executive_summary(clean: DataFrame, predictions: DataFrame, method: str = "narrow") -> Tables:
    """The tables of the four-panel summary."""
    return Tables(_summary_plans(clean, predictions, method))


def run_stage3(
    clean: DataFrame, model_path: str, test_size: float = 0.2, seed: int = 42,
    alpha: float = 1.0, model_type: str = "ridge", id_column: str = S.ID,
) -> Stage3Result:
    """Fit on the training part of ``clean``, store the model, evaluate on the test part.

    The test part is scored once, into the shared folder; every chart reads that table.
    """
    spark = clean.sparkSession
    prepared = regression.prepare_features(clean, keep=[id_column])
    train, test = regression.hash_split(prepared, id_column, test_size, seed)
    result = regression.train_and_evaluate(train, test, model_type, alpha)
    stored = regression.save_model(result.model, model_path)
    coefficients = regression.coefficient_table(spark, result.model)
    scored_path = f"{shared_folder(spark)}/predictions"
    result.predictions.write.parquet(scored_path)
    predictions = spark.read.parquet(scored_path)
    trained = F.lit(result.n_train).cast("bigint").alias("n_train")
    return Stage3Result(
        model=result.model,
        model_path=stored,
        predictions=predictions,
        metrics=regression.regression_metrics(predictions).select("*", trained),
        coefficients=coefficients,
        charts=Tables({
            "prediction_points": lambda: charts.prediction_points(predictions),
            "prediction_axis": lambda: charts.prediction_axis(predictions),
            "coefficient_bars": lambda: charts.coefficient_bars(coefficients),
            "risk_alerts_by_error": lambda: charts.risk_alerts_by_error(predictions),
            **_summary_plans(clean, predictions, "narrow"),
        }),
    )
