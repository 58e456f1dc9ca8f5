"""Model fitting against the closed form."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tenderlens import schema as S
from tenderlens.operators import charts, regression as R

from conftest import rows


def contracts():
    """Every pair of a size class and a number of bidders, with awards from a smooth rule."""
    kinds = ["Subasta", "Contratación Directa", "Convenio", "Licitación Pública"]
    table = []
    for size in range(1, 13):
        for bidders in range(1, 11):
            price = 1e6 * size ** 3 + 4321.0 * bidders
            table.append({
                S.ID: f"{size}/{bidders}", S.REFERENCE: f"r{10 * size + bidders}", S.PRICE: price,
                S.AWARD: price * (1.1 - 0.02 * bidders + 0.03 * math.sin(7 * size + bidders)),
                S.DURATION_DAYS: 20.0 + (37 * size + 11 * bidders) % 97, S.BIDDERS: float(bidders),
                S.MODALITY: kinds[(size * bidders + size // 3) % 4],
            })
    return pd.DataFrame(table)


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(contracts())


@pytest.fixture(scope="module")
def prepared(df):
    return R.prepare_features(df, keep=[S.ID]).cache()


def design(pdf):
    """Scaled and encoded features as the closed form needs them."""
    numbers = pdf[R.NUMERIC_FEATURES].to_numpy()
    deviation = numbers.std(axis=0)
    scaled = (numbers - numbers.mean(axis=0)) / np.where(deviation == 0, 1, deviation)
    kinds = sorted(pdf[S.MODALITY].unique())[1:]
    dummies = np.array([[float(m == k) for k in kinds] for m in pdf[S.MODALITY]]).reshape(len(pdf), -1)
    return np.hstack([scaled, dummies])


def closed_form(pdf, alpha):
    x, y = design(pdf), pdf["label"].to_numpy()
    xc, yc = x - x.mean(axis=0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return w, y.mean() - x.mean(axis=0) @ w


def test_prepare(spark, df):
    pdf = df.toPandas()
    got = R.prepare_features(df).toPandas()
    np.testing.assert_allclose(got[R.PRICE_LOG], np.log1p(pdf[S.PRICE]))
    np.testing.assert_allclose(got["label"], np.log1p(pdf[S.AWARD]))
    holes = spark.createDataFrame(
        [(None, None, None, None, None), (-5.0, float("nan"), 3.0, "x", -1.0)],
        f"{S.PRICE} double, {S.DURATION_DAYS} double, {S.BIDDERS} double, {S.MODALITY} string, {S.AWARD} double",
    )
    assert rows(R.prepare_features(holes)) == [
        (None, 0.0, 1.0, R.UNDEFINED, None), (0.0, 0.0, 3.0, "x", 0.0)
    ]


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="lacks the columns"):
        R.prepare_features(spark.createDataFrame([(1.0,)], f"{S.PRICE} double"))


def test_split_is_stable_and_complete(prepared):
    train, test = R.hash_split(prepared)
    again = R.hash_split(prepared.repartition(5))[1]
    ids = {r[0] for r in test.select(S.ID).collect()}
    assert ids == {r[0] for r in again.select(S.ID).collect()}
    assert train.count() + test.count() == 120 and 10 <= len(ids) <= 40


def test_split_keeps_null_ids(spark):
    table = spark.createDataFrame([(None,), ("a",)], f"{S.ID} string")
    train, test = R.hash_split(table)
    assert train.count() + test.count() == 2


def test_standardize(spark, prepared):
    pdf = prepared.toPandas()[R.NUMERIC_FEATURES]
    got = R.standardize(prepared).toPandas()[R.NUMERIC_FEATURES]
    np.testing.assert_allclose(got, (pdf - pdf.mean()) / pdf.std(ddof=0), atol=1e-12)
    constant = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert rows(R.standardize(constant, ["x"])) == [(0.0,), (0.0,)]


def test_one_hot(spark):
    table = spark.createDataFrame([("B",), ("A",), ("D",), ("C",)], f"{S.MODALITY} string")
    got = R.one_hot_drop_first(table).collect()
    codes = {r[S.MODALITY]: r[f"{S.MODALITY}_vec"].toArray().tolist() for r in got}
    assert codes == {"A": [0, 0, 0], "B": [1, 0, 0], "C": [0, 1, 0], "D": [0, 0, 1]}
    assert R.one_hot_drop_first(table.limit(1)).columns == [S.MODALITY]


@pytest.mark.parametrize("kind, alpha", [("ridge", 1.0), ("Ridge", 25.0), ("linear", 0.0)])
def test_coefficients_match_the_closed_form(spark, prepared, kind, alpha):
    model = R.fit_model(prepared, kind, alpha)
    w, intercept = closed_form(prepared.toPandas(), alpha)
    np.testing.assert_allclose(model.stages[-1].coefficients.toArray(), w, rtol=1e-8, atol=1e-10)
    assert model.stages[-1].intercept == pytest.approx(intercept)
    assert R.feature_names(model)[:3] == [f"num__{c}" for c in R.NUMERIC_FEATURES]
    assert len(R.feature_names(model)) == 6


def test_too_many_features_and_no_rows_are_refused(prepared, monkeypatch):
    with pytest.raises(ValueError, match="No training rows"):
        R.fit_model(prepared.limit(0))
    monkeypatch.setattr(R, "_NORMAL_SOLVER_FEATURES", 2)
    with pytest.raises(ValueError, match="6 features"):
        R.fit_model(prepared, "ridge", 5.0)


def test_small_test_parts_are_exact(spark):
    ids = spark.range(100_000).withColumnRenamed("id", S.ID)
    _, test = R.hash_split(ids, test_size=0.0004)
    assert 10 < test.count() < 100


def test_single_category_and_unseen_category(spark, prepared):
    one = prepared.withColumn(S.MODALITY, F.lit("única"))
    model = R.fit_model(one)
    assert len(R.feature_names(model)) == 3
    model = R.fit_model(prepared)
    strange = prepared.limit(3).withColumn(S.MODALITY, F.lit("nueva"))
    first = prepared.limit(3).withColumn(S.MODALITY, F.lit("Contratación Directa"))
    assert [r["prediction"] for r in R.predict(model, strange).collect()] == [
        r["prediction"] for r in R.predict(model, first).collect()
    ]


def test_bad_model_type_and_missing_label(prepared):
    with pytest.raises(ValueError, match="No model type"):
        R.fit_model(prepared, "invalid_model")
    with pytest.raises(ValueError, match="missing a? ?feature|missing feature"):
        R.fit_model(prepared.withColumn("label", F.when(F.col(S.BIDDERS) > 3, F.col("label"))))


def test_evaluation(spark, prepared, tmp_path):
    train, test = R.hash_split(prepared)
    result = R.train_and_evaluate(train, test)
    metrics = result.metrics.first().asDict()
    pdf = result.predictions.toPandas()
    y, p = pdf["label"], pdf["prediction"]
    ry, rp = np.expm1(y), np.expm1(p)
    assert metrics["r2_log"] > 0.85 and metrics["r2_real"] > 0.85
    expected = {
        "r2_log": 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum(),
        "mae_log": (y - p).abs().mean(), "rmse_log": math.sqrt(((y - p) ** 2).mean()),
        "r2_real": 1 - ((ry - rp) ** 2).sum() / ((ry - ry.mean()) ** 2).sum(),
        "mae_real": (ry - rp).abs().mean(), "mae_millones_cop": (ry - rp).abs().mean() / 1e6,
        "mape_real": ((ry - rp) / ry).abs().mean() * 100,
        "n_test": test.count(), "n_train": train.count(),
    }
    assert metrics == pytest.approx(expected, rel=1e-9)
    np.testing.assert_allclose(pdf["residuo_real"], ry - rp, rtol=1e-9)

    table = R.coefficient_table(spark, result.model).toPandas()
    assert table["magnitud"].is_monotonic_decreasing
    assert set(table["direccion"]) <= {R.RAISES, R.LOWERS}
    bars = charts.coefficient_bars(R.coefficient_table(spark, result.model)).toPandas()
    assert bars["coeficiente"].is_monotonic_increasing

    path = str(tmp_path / "deep" / "model")
    assert R.save_model(result.model, path) == path
    again = R.predict(R.load_model(path), test).toPandas()
    np.testing.assert_array_equal(again["prediction"], pdf["prediction"])
    R.save_model(result.model, path)


def test_missing_model(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        R.load_model(str(tmp_path / "none"))


def test_mape_and_constant_target(spark):
    table = spark.createDataFrame([(100.0, 110.0), (200.0, 180.0), (300.0, 300.0)], "y double, p double")
    assert table.agg(R.mape_percent("y", "p")).first()[0] == pytest.approx(20 / 3)
    nothing = table.select(F.lit(0.0).alias("y"), "p")
    assert nothing.agg(R.mape_percent("y", "p")).first()[0] == 0.0
    flat = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y double, p double")
    assert flat.agg(R._r2("y", "p")).first()[0] == 1.0
    assert flat.agg(R._r2("y", "p")).first()[0] == 1.0
    off = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "y double, p double")
    assert off.agg(R._r2("y", "p")).first()[0] == 0.0


def test_dependent_columns_give_the_smallest_weights(spark):
    draw = np.random.default_rng(11)
    pdf = pd.DataFrame({"a": draw.normal(5, 2, 300), "b": draw.normal(0, 1, 300)})
    pdf["twice"], pdf["both"], pdf["same"] = 2 * pdf["a"] + 3, pdf["a"] - pdf["b"], 7.0
    pdf[S.MODALITY] = draw.choice(["p", "q", "r"], 300)
    pdf["label"] = 3 * pdf["a"] - pdf["b"] + (pdf[S.MODALITY] == "q") + draw.normal(0, 0.1, 300)
    numeric = ["a", "b", "twice", "both", "same"]
    model = R.fit_model(spark.createDataFrame(pdf), "linear", numeric=numeric)
    scaled = (pdf[numeric] - pdf[numeric].mean()) / pdf[numeric].std(ddof=0).replace(0, 1)
    x = np.column_stack([scaled, pdf[S.MODALITY] == "q", pdf[S.MODALITY] == "r"]).astype(float)
    expected = np.linalg.lstsq(x - x.mean(0), pdf["label"] - pdf["label"].mean(), rcond=1e-10)[0]
    np.testing.assert_allclose(model.stages[-1].coefficients.toArray(), expected, atol=1e-6)


def test_facts_of_all_columns_from_one_read(spark):
    pdf = pd.DataFrame({"x": [1e9, 1e9 + 1, 1e9 + 5, 1e9 + 2], "k": ["b", "a", "b", None], "m": ["u", "v", "v", "u"],
                        "label": [1.0, 2.0, 4.0, 8.0]})
    facts = R.training_facts(spark.createDataFrame(pdf), ["x"], ["k", "m"], "label")
    assert (facts.n, facts.incomplete) == (4, 1)
    assert facts.categories == {"k": ["a", "b"], "m": ["u", "v"]}
    assert facts.means == pytest.approx({"x": pdf["x"].mean(), "label": 3.75}, rel=1e-15)
    assert facts.deviations == pytest.approx({"x": pdf["x"].std(ddof=0), "label": pdf["label"].std(ddof=0)}, rel=1e-12)


def test_reads_of_the_training_rows(spark, prepared, tmp_path):
    prepared.write.parquet(str(tmp_path / "train"))
    train = spark.read.parquet(str(tmp_path / "train"))
    reads = spark.sparkContext.accumulator(0)
    seen = train.rdd.map(lambda row: (reads.add(1), row)[1])
    R.fit_model(spark.createDataFrame(seen, train.schema))
    # Facts, normal equations, and the count that the estimator makes for its summary.
    assert reads.value == 3 * train.count()


@pytest.mark.parametrize("kind", ["ridge", "linear"])
def test_numbers_alone_are_read_once(spark, prepared, tmp_path, kind):
    prepared.write.parquet(str(tmp_path / "train"))
    train = spark.read.parquet(str(tmp_path / "train"))
    reads = spark.sparkContext.accumulator(0)
    seen = train.rdd.map(lambda row: (reads.add(1), row)[1])
    model = R.fit_model(spark.createDataFrame(seen, train.schema), kind, 2.0, categorical=[])
    assert reads.value == train.count()
    pdf = train.toPandas()
    x, y = pdf[R.NUMERIC_FEATURES].to_numpy(), pdf["label"].to_numpy()
    x = (x - x.mean(0)) / x.std(0)
    penalty = 2.0 if kind == "ridge" else 0.0
    expected = np.linalg.solve(x.T @ x + penalty * np.eye(3), x.T @ (y - y.mean()))
    assert np.allclose(model.stages[-1].coefficients.toArray(), expected, rtol=1e-9, atol=1e-11)
    assert model.stages[-1].intercept == pytest.approx(y.mean(), rel=1e-12)
