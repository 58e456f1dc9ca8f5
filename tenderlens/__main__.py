"""Command line of the stages: ``spark-submit`` or ``python -m tenderlens <stage> ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from tenderlens.plans import run_stage1, run_stage2, run_stage3
from tenderlens.plans.stage2 import (
    central_report, competition_report, dispersion_report, modality_report,
)
from tenderlens.sources import (
    extract_contracts, preview, read_clean, read_json_records, write_raw_csv,
)


def _show(title: str, table: DataFrame) -> None:
    print(f"\n{title}")
    table.show(table.count(), truncate=False)


def _extract(spark: SparkSession, args: argparse.Namespace) -> None:
    records = read_json_records(spark, args.input, array=args.array)
    newest = extract_contracts(records, args.region, args.contract_type, args.limit)
    if newest.isEmpty():
        print("No se encontraron registros con los filtros indicados.")
        return
    write_raw_csv(newest, args.output)
    _show("Primeras filas", preview(newest))


def _stage1(spark: SparkSession, args: argparse.Namespace) -> None:
    result = run_stage1(spark, args.input, args.output, args.format, not args.single_line)
    _show("Balance de registros", result.report)
    _show("Sobrecosto", result.overcost)
    _show("Resumen estadístico", result.description)
    _show("Tipos y valores nulos", result.profile)


def _stage2(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = run_stage2(read_clean(spark, args.input, args.format, not args.single_line))
    if args.output:
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{args.output}/{name}")
    _show("Tendencia central", central_report(tables["central"]))
    _show("Dispersión", dispersion_report(tables["dispersion"]))
    _show("Dispersión por modalidad", modality_report(tables["by_modality"]))
    for name in ("tukey_award", "top_award", "tukey_days", "top_days"):
        _show(name, tables[name])
    _show("Competencia", competition_report(tables["competition"]))


def _stage3(spark: SparkSession, args: argparse.Namespace) -> None:
    clean = read_clean(spark, args.input, args.format, not args.single_line)
    result = run_stage3(clean, args.model, args.test_size, args.seed, args.alpha)
    if args.output:
        for name, table in result.charts.items():
            table.write.mode("overwrite").parquet(f"{args.output}/{name}")
    _show("Métricas", result.metrics)
    shown = result.coefficients.select(
        "variable_limpia", "coeficiente", "direccion"
    )
    _show("Coeficientes", shown)
    print(f"Modelo: {result.model_path}")


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tenderlens")
    commands = parser.add_subparsers(required=True)

    extract = commands.add_parser("extract", help="landed JSON records to raw CSV")
    extract.add_argument("--array", action="store_true", help="one JSON array per file")
    extract.add_argument("--region", default="Cundinamarca")
    extract.add_argument("--contract-type", default="Obra")
    extract.add_argument("--limit", type=int, default=10_000)
    extract.set_defaults(run=_extract)

    stage1 = commands.add_parser("stage1", help="raw CSV to clean table")
    stage1.set_defaults(run=_stage1)

    stage2 = commands.add_parser("stage2", help="statistics of the clean table")
    stage2.set_defaults(run=_stage2)

    stage3 = commands.add_parser("stage3", help="model of the awarded amount")
    stage3.add_argument("--model", required=True)
    stage3.add_argument("--test-size", type=float, default=0.2)
    stage3.add_argument("--seed", type=int, default=42)
    stage3.add_argument("--alpha", type=float, default=1.0)
    stage3.set_defaults(run=_stage3)

    for command in (extract, stage1, stage2, stage3):
        command.add_argument("--input", required=True)
        command.add_argument("--output", required=command in (extract, stage1))
    for command in (stage1, stage2, stage3):
        command.add_argument("--format", choices=("parquet", "csv"), default="parquet")
        command.add_argument("--single-line", action="store_true",
                             help="no CSV field holds a line break, so large files can be split")

    args = parser.parse_args(arguments)
    args.run(SparkSession.builder.appName("tenderlens").getOrCreate(), args)


if __name__ == "__main__":
    main()
