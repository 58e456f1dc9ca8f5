"""Chart tables against NumPy and brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tenderlens import schema as S
from tenderlens.operators import charts

from conftest import rows


@pytest.fixture(scope="module")
def amounts():
    return np.exp(np.random.default_rng(3).normal(18, 1.5, 4000))


@pytest.fixture(scope="module")
def df(spark, amounts):
    rng = np.random.default_rng(4)
    return spark.createDataFrame(pd.DataFrame({
        S.AWARD: np.concatenate([amounts, [0.0, -5.0, np.nan]]),
        S.MODALITY: rng.choice(["a", "b", "c"], len(amounts) + 3),
    }))


@pytest.mark.parametrize("method", ["aggregate", "narrow"])
def test_log_histogram_automatic_bins(df, amounts, method):
    got = charts.log_histogram(df, method=method).toPandas()
    counts, edges = np.histogram(np.log10(amounts), bins="auto")
    assert got["n"].tolist() == counts.tolist()
    np.testing.assert_allclose(got["desde"], 10 ** edges[:-1], rtol=1e-9)
    np.testing.assert_allclose(got["hasta"], 10 ** edges[1:], rtol=1e-9)


def test_histogram_keeps_empty_and_closed_bins(spark):
    table = spark.createDataFrame([(0.0,), (1.0,), (10.0,)], "x double")
    got = charts.histogram(table, "x", bins=5).toPandas()
    assert got["n"].tolist() == [2, 0, 0, 0, 1]
    constant = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [tuple(r) for r in charts.histogram(constant, "x").collect()] == [(0, 2.5, 3.5, 2)]
    assert charts.histogram(table.limit(0), "x").collect() == []
    assert charts.histogram(table.limit(0), "x", bins=4).collect() == []


@pytest.mark.parametrize("log, cut", [(True, 3.0), (True, 0.0), (False, 0.0)])
def test_density_is_the_full_kernel_sum(df, amounts, log, cut):
    x = np.log10(amounts) if log else np.concatenate([amounts, [0.0, -5.0]])
    got = charts.density_curve(df, log=log, cut=cut).toPandas()
    bw = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min() - cut * bw, x.max() + cut * bw, 200)
    expected = np.exp(-0.5 * ((grid[:, None] - x) / bw) ** 2).sum(1) / (len(x) * bw * np.sqrt(2 * np.pi))
    np.testing.assert_allclose(got["x"], grid, rtol=1e-12)
    np.testing.assert_allclose(got["densidad"], expected, rtol=1e-9, atol=1e-300)


def test_density_has_gaps_for_distant_clusters(spark):
    x = np.concatenate([np.linspace(0, 1, 3000), [1e6]])
    table = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = charts.density_curve(table, "x", log=False, points=50).toPandas()
    assert len(got) == 50 and (got["densidad"] == 0).sum() > 10
    assert charts.density_curve(table.limit(1), "x", log=False).collect() == []


def test_reference_lines(df, amounts):
    values = np.concatenate([amounts, [0.0, -5.0]])
    row = charts.reference_lines(df).first()
    np.testing.assert_allclose(list(row), [values.mean(), np.median(values)], rtol=1e-12)


@pytest.mark.parametrize("method", ["aggregate", "narrow"])
def test_boxes(df, method):
    pdf = df.toPandas().dropna()
    got = charts.boxplot_by_group(df, method=method).collect()
    medians = pdf.groupby(S.MODALITY)[S.AWARD].median().sort_values(ascending=False)
    assert [r[S.MODALITY] for r in got] == list(medians.index)
    for r in got:
        x = pdf.loc[pdf[S.MODALITY] == r[S.MODALITY], S.AWARD]
        q1, q3 = x.quantile([0.25, 0.75])
        inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
        assert (r["n"], r["atipicos"]) == (len(x), len(x) - len(inside))
        np.testing.assert_allclose(
            [r["bigote_inferior"], r["bigote_superior"], r["media"], r["q1"], r["q3"]],
            [min(inside.min(), q1), max(inside.max(), q3), x.mean(), q1, q3], rtol=1e-12,
        )
    assert charts.boxplot_fliers(df, method=method).count() == sum(r["atipicos"] for r in got)


def test_competition_tables(spark):
    table = spark.createDataFrame(
        [(1.0, 1e6, 0), (1.0, 1.1e6, 0), (2.0, 5e8, 1), (None, 3.0, 0), (3.0, 1.0, None)],
        f"{S.BIDDERS} double, {S.AWARD} double, {S.OVERCOST_FLAG} int",
    )
    assert charts.competition_points(table).count() == 4
    assert sorted(rows(charts.competition_series(table))) == [(0, 3), (1, 1)]
    assert sum(r["contratos"] for r in charts.competition_grid(table).collect()) == 4


def test_award_ratio(spark):
    table = spark.createDataFrame(
        [(10.0, 4.0, 1.0), (10.0, 4.1, 2.0), (10.0, 12.0, 70.0), (10.0, 12.1, 4.0), (0.0, 1.0, 5.0)],
        f"{S.PRICE} double, {S.AWARD} double, {S.BIDDERS} double",
    )
    assert [r[0] for r in charts.award_ratio_points(table).collect()] == [2.0, 70.0]
    assert rows(charts.award_ratio_axis(table)) == [(50.0,)]
    assert rows(charts.award_ratio_axis(table.limit(0))) == [(None,)]


@pytest.fixture(scope="module")
def predictions(spark):
    rng = np.random.default_rng(5)
    real = np.exp(rng.normal(18, 1, 500))
    predicted = real * np.exp(rng.normal(0, 0.2, 500))
    return spark.createDataFrame(pd.DataFrame({
        "label": np.log1p(real), "prediction": np.log1p(predicted), "real": real, "predicho": predicted,
    }))


def test_prediction_band(predictions):
    pdf = predictions.toPandas()
    row = charts.prediction_axis(predictions).first()
    low, high = pdf[["label", "prediction"]].min().min(), pdf[["label", "prediction"]].max().max()
    near = ((pdf["label"] - pdf["prediction"]).abs() <= 0.10).sum()
    np.testing.assert_allclose(
        list(row), [500, low - 0.05 * (high - low), high + 0.05 * (high - low), near, near / 5], rtol=1e-12
    )


def test_error_charts(spark, predictions):
    pdf = predictions.toPandas()
    errors = np.clip((pdf["predicho"] - pdf["real"]) / pdf["real"] * 100, -30, 30)
    got = charts.error_histogram(predictions).toPandas()
    assert got["n"].tolist() == np.histogram(errors, bins=35)[0].tolist()
    curve = charts.error_density(predictions).toPandas()
    assert curve["x"].iloc[[0, -1]].tolist() == pytest.approx([errors.min(), errors.max()])
    zero = spark.createDataFrame([(0.0, 1.0)], "real double, predicho double")
    assert charts.relative_errors(zero, "real", "predicho").first()[0] is None


def test_risk(spark, predictions):
    table = spark.createDataFrame(
        [(3e8, 1e8), (1e8, 3e8), (2e8, 1e8), (1e8, 2e8)], "real double, predicho double"
    )
    assert [r["alerta"] for r in charts.risk_alerts(table).collect()] == [
        charts.RISK_HIGH, charts.RISK_MEDIUM, charts.RISK_NORMAL, charts.RISK_NORMAL
    ]
    pdf = predictions.toPandas()
    gap = pdf["real"] - pdf["predicho"]
    beyond = (gap.abs() > 2 * gap.abs().mean()).sum()
    by_error = charts.risk_alerts_by_error(predictions)
    assert by_error.where(F.col("alerta") != charts.RISK_NORMAL).count() == beyond
    assert charts.risk_axis(predictions).first()[0] == 5000.0
    far = predictions.select((F.col("predicho") * 1e3).alias("predicho"))
    assert charts.risk_axis(far).first()[0] == pytest.approx(np.percentile(pdf["predicho"] / 1e3, 98))


@pytest.mark.parametrize("values", [
    list(np.random.default_rng(4).lognormal(3, 1, 3000)), [1.0, 2.0, 4.0], [5.0] * 50 + [5.1], list(range(1, 400)),
])
@pytest.mark.parametrize("log", [True, False])
def test_binned_density_is_within_its_tolerance(spark, values, log):
    table = spark.createDataFrame([(float(v),) for v in values], "x double")
    exact = charts.density_curve(table, "x", log=log).collect()
    for tolerance in (1e-6, 1e-3):
        binned = charts.density_curve(table, "x", log=log, binned=True, tolerance=tolerance).collect()
        assert [r["x"] for r in binned] == [r["x"] for r in exact]
        assert max(abs(a["densidad"] - b["densidad"]) for a, b in zip(exact, binned)) <= tolerance


def test_binned_density_counts_each_row_once(spark):
    table = spark.range(200_000).select((F.rand(3) + 1).alias("x"))
    moments = table.select(F.log10("x").alias("x"))
    g = F.struct(F.lit(0.0).alias("low"), F.lit(0.001).alias("cell"))
    nodes = charts._on_cells(moments, g)
    assert nodes.count() <= 2 * 303
    assert nodes.agg(F.sum("weight")).first()[0] == pytest.approx(200_000)


@pytest.mark.parametrize("values", [[], [3.0], [2.0, 2.0]])
def test_binned_density_without_spread(spark, values):
    table = spark.createDataFrame([(v,) for v in values], "x double")
    assert charts.density_curve(table, "x", binned=True).collect() == []
