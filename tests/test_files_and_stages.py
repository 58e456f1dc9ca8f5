"""Readers, writers and the stages end to end."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenderlens import schema as S
from tenderlens import sources
from tenderlens.operators import regression
from tenderlens.plans import run_stage1, run_stage2, run_stage3
from tenderlens.plans.stage2 import (
    central_report, competition_report, dispersion_report, modality_report,
)

from conftest import rows


def text(row):
    return str([f"{v:.10g}" if isinstance(v, float) else v for v in row])


def raw_records(n=300):
    rng = np.random.default_rng(11)
    units = ["Mes(es)", "día(s)", "Año(s)", ""]
    kinds = ["Licitación Pública", " Mínima Cuantía ", "Selección Abreviada", "N/A"]
    out = []
    for i in range(n):
        base = float(rng.uniform(1e7, 1e9))
        bidders = int(rng.integers(1, 14))
        award = base * (1 - 0.005 * bidders + float(rng.normal(0, 0.02)))
        out.append((
            f"ID{i % 280}", f"R{i}", 'Alcaldía "El Rosal",\nCentro' if i % 7 == 0 else " Alcaldía ",
            "Cundinamarca" if i % 5 else "Boyacá", "Bogotá", kinds[i % 4], "Obra", "Adjudicado",
            f"$ {base:,.2f}" if i % 10 else "0", f"{award:.2f}", str(bidders), str(1 + i % 9),
            units[i % 4], f"2024-{1 + i % 12:02d}-{1 + i % 28:02d}T00:00:00.000",
        ))
    return out


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(raw_records(), S.RAW_SCHEMA)


@pytest.fixture(scope="module")
def landed(raw, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "contracts.csv")
    sources.write_raw_csv(raw, path)
    return path


def test_csv_round_trip(spark, raw, landed):
    got = sources.read_raw_csv(spark, landed)
    missing = raw.withColumns({
        c: F.when(~F.col(c).isin("", "N/A"), F.col(c)) for c in (S.MODALITY, S.DURATION_UNIT)
    })
    assert sorted(map(str, rows(got))) == sorted(map(str, rows(missing)))


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{S.AWARD},{S.ID}\n5,x\n,null\n", encoding="utf-8")
    got = sources.read_raw_csv(spark, str(tmp_path / "a.csv"))
    assert rows(got) == [("5", "x"), (None, None)]


def test_json_records(spark, raw, tmp_path):
    raw.write.json(str(tmp_path / "lines"))
    got = sources.read_json_records(spark, str(tmp_path / "lines"))
    assert sorted(map(str, rows(got))) == sorted(map(str, rows(raw)))
    (tmp_path / "array.json").write_text(
        '[{"id_del_portafolio": "a", "precio_base": 1500.5}, {"entidad": "b"}]', encoding="utf-8"
    )
    got = sources.read_json_records(spark, str(tmp_path / "array.json"), array=True)
    assert rows(got.select(S.ID, S.PRICE, S.ENTITY)) == [("a", "1500.5", None), (None, None, "b")]


def test_missing_inputs(spark, tmp_path):
    gone = str(tmp_path / "gone")
    for read in (sources.read_raw_csv, sources.read_json_records, sources.read_clean):
        with pytest.raises(FileNotFoundError, match="Ejecuta primero"):
            read(spark, gone)
    with pytest.raises(FileNotFoundError):
        run_stage1(spark, gone, str(tmp_path / "out"))


@pytest.mark.parametrize("method", ["direct", "cutoff"])
def test_extract(raw, method):
    got = sources.extract_contracts(raw, limit=20, method=method).collect()
    assert len(got) == 20 and list(got[0].asDict()) == S.RAW_COLUMNS
    assert {r[S.REGION] for r in got} == {"Cundinamarca"}
    dates = [r[S.PUBLISHED] for r in got]
    assert dates == sorted(dates, reverse=True)
    assert dates[0] == max(r[13] for r in raw_records() if r[3] == "Cundinamarca")
    plan = sources.extract_contracts(raw, method=method)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert sources.preview(raw).count() == 3


def test_extract_methods_agree(raw):
    undated = raw.withColumn(S.PUBLISHED, F.when(F.substring(S.ID, -1, 1) != "3", F.col(S.PUBLISHED)))
    for limit in (1, 7, 100, 215, 239, 240, 241, 1000):
        direct = sources.extract_contracts(undated, limit=limit, tie_break=[S.ID, S.REFERENCE], method="direct")
        cutoff = sources.extract_contracts(undated, limit=limit, tie_break=[S.ID, S.REFERENCE], method="cutoff")
        assert rows(direct) == rows(cutoff)
    with pytest.raises(ValueError, match="extract method"):
        sources.extract_contracts(raw, method="guess")


@pytest.fixture(scope="module")
def stage1(spark, landed, tmp_path_factory):
    return run_stage1(spark, landed, str(tmp_path_factory.mktemp("clean") / "deep" / "t"))


def test_stage1(stage1):
    assert stage1.clean.dtypes == [(f.name, f.dataType.simpleString()) for f in S.CLEAN_SCHEMA.fields]
    report = stage1.report.first().asDict()
    valid = [r for r in raw_records() if r[8] != "0"]
    unique = {r[0] for r in valid}
    assert report["filas_iniciales"] == 300 and report["filas_finales"] == len(unique)
    assert report["filas_descartadas_precio_invalido"] == 300 - len(valid)
    assert report["duplicados_eliminados"] == len(valid) - len(unique)
    first = stage1.clean.where(F.col(S.ID) == "ID1").first()
    newest = max((r for r in valid if r[0] == "ID1"), key=lambda r: r[13])
    assert first[S.REFERENCE] == newest[1]
    assert first[S.PUBLISHED] == dt.datetime.fromisoformat(newest[13])
    assert {r[0] for r in stage1.clean.select(S.MODALITY).distinct().collect()} == {
        "Licitación Pública", "Mínima Cuantía", "Selección Abreviada", None
    }
    assert dict(rows(stage1.nulls))[S.MODALITY] > 0
    assert stage1.profile.count() == 18 and stage1.description.count() == 6
    assert stage1.retention.first()["tasa_retencion_pct"] == pytest.approx(len(unique) / 3)


def test_stage1_as_csv_gives_the_same_table(spark, landed, stage1, tmp_path):
    as_csv = run_stage1(spark, landed, str(tmp_path / "c"), file_format="csv")
    assert as_csv.clean.dtypes == stage1.clean.dtypes
    assert sorted(map(str, rows(as_csv.clean))) == sorted(map(str, rows(stage1.clean)))
    with pytest.raises(ValueError, match="file format"):
        sources.write_clean(as_csv.clean, str(tmp_path / "x"), "xml")


def test_stage2(stage1):
    exact, narrow = run_stage2(stage1.clean, "aggregate"), run_stage2(stage1.clean, "narrow")
    for name, table in exact.items():
        one, two = sorted(map(text, rows(table))), sorted(map(text, rows(narrow[name])))
        assert one == two and (one or name.startswith("top")), name
    assert central_report(exact["central"]).first()["media"].startswith("$")
    assert dispersion_report(exact["dispersion"]).where(
        F.col("variable") == S.DURATION_DAYS).first()["iqr"].endswith("días")
    assert modality_report(exact["by_modality"]).first()["porcentaje_contratos"].endswith("%")
    assert competition_report(exact["competition"]).count() == 4


def test_stage3(spark, stage1, tmp_path):
    result = run_stage3(stage1.clean, str(tmp_path / "models" / "m"))
    assert result.metrics.first()["r2_real"] > 0.85
    assert result.coefficients.first()["variable"] == "num__precio_base_log"
    for table in result.charts.values():
        assert table.count() > 0
    again = regression.load_model(result.model_path)
    assert again.stages[-1].coefficients == result.model.stages[-1].coefficients


def test_command_line(spark, raw, tmp_path, capsys):
    from tenderlens.__main__ import main

    raw.write.json(str(tmp_path / "json"))
    at = lambda name: str(tmp_path / name)
    main(["extract", "--input", at("json"), "--output", at("raw"), "--limit", "200"])
    main(["stage1", "--input", at("raw"), "--output", at("clean")])
    with pytest.raises(SystemExit):
        main(["stage1", "--input", at("raw")])
    main(["stage2", "--input", at("clean"), "--output", at("stage2")])
    main(["stage3", "--input", at("clean"), "--model", at("model"), "--output", at("stage3")])
    printed = capsys.readouterr().out
    assert "Licitación Pública" in printed and "Precio Base [log1p]" in printed
    assert spark.read.parquet(at("stage2/boxes")).count() == 3
    main(["extract", "--input", at("json"), "--output", at("none"), "--region", "Marte"])
    assert "No se encontraron registros" in capsys.readouterr().out


def test_shared_folder_follows_the_setting(spark):
    one, two = sources.shared_folder(spark), sources.shared_folder(spark)
    assert one != two and one.startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))


def test_landed_json_is_compressed(spark, tmp_path, monkeypatch):
    from test_cleaning import write_orders
    from tenderlens.catalog import stage_one, views

    write_orders(spark, tmp_path)
    monkeypatch.setattr(sources, "shared_folder", lambda _: str(tmp_path / "landed"))
    got = stage_one.scan_json(spark, str(tmp_path))
    files = list((tmp_path / "landed" / "json").glob("part-*"))
    assert files and all(f.name.endswith(".json.gz") for f in files)
    assert got.count() == views.raw_contracts(spark, str(tmp_path)).count()
