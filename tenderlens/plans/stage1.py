"""Stage 1: read raw records, clean, enrich, store, report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tenderlens import schema as S
from tenderlens.functions import number_column
from tenderlens.operators import cleaning, features, quality
from tenderlens.sources import read_clean, read_raw_csv, shuffles_removed, write_clean


@dataclass
class Stage1Result:
    """The stored clean table and lazy reports on it."""

    clean: DataFrame
    report: DataFrame
    nulls: DataFrame
    overcost: DataFrame
    retention: DataFrame
    description: DataFrame
    profile: DataFrame


def clean_and_enrich(raw: DataFrame) -> DataFrame:
    """Raw records to clean contracts with all derived columns."""
    clean = features.add_features(cleaning.clean_contracts(raw))
    if S.BIDDERS in clean.columns:
        clean = clean.withColumn(S.BIDDERS, number_column(clean, S.BIDDERS))
    return clean


def run_stage1(
    spark: SparkSession, input_path: str, output_path: str,
    file_format: str = "parquet", multiline: bool = True,
) -> Stage1Result:
    """Clean the raw CSV at ``input_path`` into ``output_path``.

    The clean table is computed once, by the write; all reports read the stored one.
    """
    raw = read_raw_csv(spark, input_path, multiline)
    with shuffles_removed(spark):
        write_clean(clean_and_enrich(raw), output_path, file_format)
    clean = read_clean(spark, output_path, file_format, multiline)
    return Stage1Result(
        clean=clean,
        report=quality.quality_balance(raw, clean),
        nulls=quality.null_counts(clean),
        overcost=quality.overcost_rate(clean),
        retention=quality.retention(raw, clean),
        description=quality.describe_numeric(clean),
        profile=quality.column_profile(clean),
    )
