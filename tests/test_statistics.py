"""Statistics against pandas and NumPy, for every way to find quantiles."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tenderlens import schema as S
from tenderlens.operators import describe, grouped, outliers, quality, quantiles
from tenderlens.operators.quantiles import exact_quantiles

from conftest import rows

METHODS = ["aggregate", "narrow"]
POINTS = {"p0": 0.0, "p1": 0.01, "q1": 0.25, "m": 0.5, "q3": 0.75, "p98": 0.98, "p100": 1.0}


def sample():
    """Amounts on a saw-tooth with a geometric tail, cycling through groups of unequal size."""
    table = []
    for i in range(84):
        tail = i % 7 == 3 and i > 40
        amount = 300.0 * 1.3 ** (i // 7) if tail else 60.0 + (29 * i) % 83 + i / 16
        table.append({
            S.ID: f"c{i:03}", S.REFERENCE: f"r{i}", S.ENTITY: "Municipio", S.CITY: "Cali",
            S.AWARD: amount, S.PRICE: amount * 1.25, S.OVERCOST: 12.5,
            S.DURATION_DAYS: 15.0 + (17 * i) % 61,
            S.MODALITY: ["Subasta", "Subasta", "Convenio", "Subasta", "Concurso"][i % 5],
            S.BIDDERS: [1.0, 3.0, 15.0, 7.0][i % 4], S.OVERCOST_FLAG: int(tail),
        })
    return pd.DataFrame(table)


@pytest.fixture(scope="module")
def pdf():
    return sample()


@pytest.fixture(scope="module")
def df(spark, pdf):
    return spark.createDataFrame(pdf)


def shapes():
    rng = np.random.default_rng(7)
    return {
        "heavy": np.exp(rng.normal(15, 3, 3000)),
        "mixed_sign": rng.normal(0, 1e6, 2001),
        "one_hot_value": np.where(rng.random(3000) < 0.4, 7.0, rng.normal(7, 1e-9, 3000)),
        "few": np.array([3.0, 1.0]),
        "single": np.array([5.5]),
        "constant": np.full(50, -2.25),
        "zeros": np.concatenate([np.zeros(40), [1e-300, -1e-300, 5e-324, 1e300]]),
        "near_ties": 1e9 + rng.integers(0, 5, 2000) * 1e-6,
        "integers": rng.integers(1, 30, 5000).astype(float),
    }


@pytest.mark.parametrize("method", METHODS)
@pytest.mark.parametrize("bounded", [True, False])
def test_quantiles_of_awkward_columns(spark, method, bounded):
    data = [(k, float(v)) for k, values in shapes().items() for v in values]
    table = spark.createDataFrame(
        data + [("heavy", None), ("heavy", float("nan")), ("empty", None), (None, 1.0)], "k string, v double"
    ).repartition(7)
    got = exact_quantiles(table, F.col("v"), POINTS, ["k"], method=method, groups_bounded=bounded)
    got = {r["k"]: [r[p] for p in POINTS] for r in got.collect()}
    assert set(got) == set(shapes())
    for name, values in shapes().items():
        expected = pd.Series(values).quantile(list(POINTS.values())).to_numpy()
        np.testing.assert_allclose(got[name], expected, rtol=1e-15, atol=0, err_msg=name)


@pytest.mark.parametrize("method", METHODS)
def test_quantiles_with_weights_and_without_keys(spark, method):
    values = shapes()["heavy"].round(-6)
    table = spark.createDataFrame([(float(v),) for v in values], "v double")
    counts = table.groupBy("v").count()
    got = exact_quantiles(counts, F.col("v"), POINTS, weight=F.col("count"), method=method).first()
    np.testing.assert_allclose(list(got), pd.Series(values).quantile(list(POINTS.values())), rtol=1e-15)
    assert exact_quantiles(table.limit(0), F.col("v"), POINTS, method=method).collect() == []


def test_large_groups_share_two_scans(spark, tmp_path):
    spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.exp(F.rand(3) * 20).alias("v"),
    ).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    q = exact_quantiles(table, F.col("v"), {"q1": 0.25, "q3": 0.75}, ["k"], method="narrow")
    got = {r["k"]: (r["q1"], r["q3"]) for r in q.collect()}
    final = q._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 2 and "percentile" not in final
    pdf = table.toPandas()
    for key, part in pdf.groupby("k"):
        np.testing.assert_allclose(got[key], part["v"].quantile([0.25, 0.75]), rtol=1e-15)


def test_many_groups_are_joined_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "MAX_BROADCAST_GROUPS", 10)
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({
        "k": np.where(rng.random(20_000) < 0.4, 0, rng.integers(1, 500, 20_000)),
        "v": np.where(rng.random(20_000) < 0.3, 1.0, rng.lognormal(3, 2, 20_000)),
    })
    table = spark.createDataFrame(pdf).repartition(5)
    assert not quantiles.few_groups(table, ["k"])
    got = exact_quantiles(table, F.col("v"), {"q1": 0.25, "q3": 0.75}, ["k"], method="narrow")
    assert "Broadcast" not in got._jdf.queryExecution().optimizedPlan().toString()
    got = {r["k"]: (r["q1"], r["q3"]) for r in got.collect()}
    expected = pdf.groupby("k")["v"].quantile([0.25, 0.75]).unstack()
    assert set(got) == set(expected.index)
    for key, row in expected.iterrows():
        np.testing.assert_allclose(got[key], row, rtol=1e-15)


def test_the_plan_does_not_depend_on_the_size(spark):
    for size in (10, 100_000):
        table = spark.range(size).select(F.rand(1).alias("v"))
        found = exact_quantiles(table, F.col("v"), {"m": 0.5})
        assert "percentile" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_unknown_quantile_method(df):
    with pytest.raises(ValueError, match="quantile method"):
        exact_quantiles(df, F.col(S.AWARD), POINTS, method="guess")


@pytest.mark.parametrize("method", METHODS)
def test_central_tendency(df, pdf, method):
    columns = [S.PRICE, S.AWARD, S.OVERCOST, S.DURATION_DAYS, "absent"]
    got = {r["variable"]: r for r in describe.central_tendency(df, columns, method).collect()}
    assert set(got) == set(columns[:-1])
    for name, row in got.items():
        s = pdf[name]
        expected = [s.mean(), s.median(), s.mode().iloc[0], s.skew()]
        np.testing.assert_allclose([row["media"], row["mediana"], row["moda"], row["skewness"]], expected, rtol=1e-9)
        gap = (s.mean() - s.median()) / abs(s.median()) * 100
        assert row["divergencia_media_vs_mediana_pct"] == pytest.approx(gap, abs=1e-9)
    assert got[S.AWARD]["interpretacion_sesgo"] == describe.SKEW_RIGHT
    assert got[S.OVERCOST]["interpretacion_sesgo"] == describe.SKEW_NONE
    assert got[S.OVERCOST]["skewness"] == 0.0


@pytest.mark.parametrize("method", METHODS)
def test_dispersion(df, pdf, method):
    got = {r["variable"]: r for r in describe.dispersion(df, method=method).collect()}
    for name, row in got.items():
        s = pdf[name]
        q1, q3 = s.quantile([0.25, 0.75])
        np.testing.assert_allclose(
            list(row)[1:],
            [s.std(), s.var(), s.min(), s.max(), s.max() - s.min(), q1, q3, q3 - q1,
             s.std() / abs(s.mean()) * 100],
            rtol=1e-9, atol=1e-9,
        )


def test_statistics_edge_cases(spark):
    table = spark.createDataFrame(
        [(1.0, 2.0, 7.0, "x"), (2.0, 2.0, None, "2"), (3.0, 1.0, None, None), (10.0, 1.0, None, None)],
        "a double, b double, one double, t string",
    )
    rows_ = {r["variable"]: r for r in describe.central_tendency(table, ["a", "b", "one", "t"]).collect()}
    assert rows_["a"]["skewness"] == pytest.approx(1.763632614803888)
    assert rows_["b"]["moda"] == 1.0
    assert rows_["one"]["skewness"] is None and rows_["one"]["interpretacion_sesgo"] == describe.SKEW_NONE
    assert rows_["t"]["mediana"] == 2.0
    spread = {r["variable"]: r for r in describe.dispersion(table, ["one"]).collect()}
    assert spread["one"]["varianza"] is None and spread["one"]["iqr"] == 0.0


def test_zero_centre_gives_null_ratio(spark):
    table = spark.createDataFrame([(-1.0,), (0.0,), (1.0,)], "x double")
    assert describe.central_tendency(table, ["x"]).first()["divergencia_media_vs_mediana_pct"] is None
    assert describe.dispersion(table, ["x"]).first()["coeficiente_variacion_pct"] is None


def test_empty_tables_keep_their_schema(df):
    assert describe.central_tendency(df, ["absent"]).collect() == []
    assert describe.central_tendency(df.limit(0)).collect() == []
    full, none = describe.dispersion(df), describe.dispersion(df, ["absent"])
    assert none.collect() == [] and none.dtypes == full.dtypes
    assert describe.central_tendency(df, []).dtypes == describe.central_tendency(df).dtypes


@pytest.mark.parametrize("method", METHODS)
def test_describe(df, pdf, method):
    got = {r["variable"]: list(r)[1:] for r in quality.describe_numeric(df, method=method).collect()}
    for name, values in got.items():
        expected = pdf[name].describe()[["count", "mean", "std", "min", "50%", "max"]]
        np.testing.assert_allclose(values, expected, rtol=1e-12)


@pytest.mark.parametrize("method", METHODS)
def test_by_modality(spark, df, pdf, method):
    extra = spark.createDataFrame([(None, 1e9), ("vacía", None)], f"{S.MODALITY} string, {S.AWARD} double")
    table = df.select(S.MODALITY, S.AWARD).unionByName(extra)
    got = [tuple(r) for r in grouped.dispersion_by_group(table, method=method).collect()]
    assert [r[0] for r in got] == ["Subasta", "Convenio", "Concurso", "vacía"]
    assert [r[1] for r in got] == [51, 17, 16, 0]
    assert got[3][2:8] == (None,) * 6
    for row in got[:3]:
        s = pdf.loc[pdf[S.MODALITY] == row[0], S.AWARD]
        q1, q3 = s.quantile([0.25, 0.75])
        np.testing.assert_allclose(
            row[2:], [s.mean(), s.median(), s.std(), q1, q3, q3 - q1, len(s) / 86 * 100], rtol=1e-12
        )


@pytest.mark.parametrize("method", METHODS)
def test_competition(df, pdf, method):
    got = grouped.competition_contrast(df, method=method).collect()
    assert [r["banda_orden"] for r in got] == [1, 2, 3, 4]
    assert sum(r["total_contratos"] for r in got) == len(pdf)
    last = pdf[pdf[S.BIDDERS] == 15.0]
    np.testing.assert_allclose(
        list(got[3])[3:],
        [last[S.AWARD].median(), last[S.AWARD].mean(), last[S.OVERCOST_FLAG].mean() * 100, last[S.DURATION_DAYS].median(), 25.0],
        rtol=1e-12,
    )


@pytest.mark.parametrize("method", METHODS)
def test_tukey(spark, method):
    values = [*range(10, 20), 100, 200, None, float("nan")]
    table = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")
    row = outliers.tukey_summary(table, "v", method=method).first().asDict()
    assert row == {
        "q1": 12.75, "q3": 18.25, "iqr": 5.5, "limite_inferior": 4.5, "limite_superior": 26.5,
        "total_validos": 12, "conteo_outliers": 2, "conteo_outliers_superiores": 2,
        "conteo_outliers_inferiores": 0, "porcentaje_outliers": pytest.approx(100 / 6),
    }
    flags = outliers.tukey_flags(table, "v", method=method)
    assert [tuple(r)[1:] for r in flags.collect() if r["v"] in (19.0, 100.0, None)] == [
        (False, False, False), (True, False, True), (False, False, False)
    ]
    assert flags.where("atipico").count() == 2
    assert outliers.tukey_summary(table.limit(0), "v").first()["porcentaje_outliers"] == 0.0


def test_top_outliers(df, pdf):
    top = outliers.top_outliers(df, S.AWARD, top_n=5).collect()
    assert [r[S.AWARD] for r in top] == sorted(pdf[S.AWARD], reverse=True)[:5]
    assert list(top[0].asDict()) == outliers.INFO_COLUMNS
    narrow = outliers.top_outliers(df, S.AWARD, top_n=3, info_columns=[S.ID, "absent"])
    assert narrow.columns == [S.ID, S.AWARD]


def test_nan_is_missing(spark):
    """Features, bands, null counts and chart axis treat NaN as no value."""
    from tenderlens.functions import competition_band
    from tenderlens.operators import charts, features

    nan = float("nan")
    table = spark.createDataFrame(
        [(100.0, nan, nan), (nan, 5.0, 3.0), (100.0, 110.0, 3.0)],
        f"{S.PRICE} double, {S.AWARD} double, {S.BIDDERS} double")
    got = rows(features.add_overcost(table).select(S.OVERCOST, S.OVERCOST_RATIO, S.OVERCOST_FLAG))
    assert got == [(None, None, 0), (None, 0.0, 0), (10.0, 0.1, 1)]
    assert rows(table.select(competition_band(F.col(S.BIDDERS))))[0][0].startswith("1 ")
    assert dict(rows(quality.null_counts(table))) == {S.PRICE: 1, S.AWARD: 1, S.BIDDERS: 1}
    assert {r["columna"]: r["nulos"] for r in quality.column_profile(table).collect()} == {
        S.PRICE: 1, S.AWARD: 1, S.BIDDERS: 1}
    full = spark.createDataFrame([(100.0, 90.0, nan), (100.0, 90.0, 3.0)], table.schema)
    assert charts.award_ratio_axis(full).first()[0] == 3.0
