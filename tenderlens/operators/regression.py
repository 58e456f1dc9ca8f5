"""Regression of the log award with ``pyspark.ml``."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder,
    StandardScaler,
    StringIndexerModel,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tenderlens import schema as S
from tenderlens.functions import feature_label, number_column

PRICE_LOG = "precio_base_log"
NUMERIC_FEATURES = [PRICE_LOG, S.DURATION_DAYS, S.BIDDERS]
CATEGORICAL_FEATURES = [S.MODALITY]
LABEL, PREDICTION = "label", "prediction"

# Stand-in category, directions and model types.
UNDEFINED = "No Definido"
RAISES, LOWERS = "Positivo (Incrementa Monto)", "Negativo (Disminuye Monto)"
MODEL_TYPES = ("ridge", "linear")

# The normal-equation solver accepts no more features than this.
_NORMAL_SOLVER_FEATURES = 4096

# Of least squares, per row and unit variance: far below any direction of the data, far above
# the rounding errors of one without variance.
_VANISHING_PENALTY = 1e-12


def _log_amount(value: Column) -> Column:
    return F.when(value.isNotNull(), F.log1p(F.greatest(value, F.lit(0.0))))


def prepare_features(df: DataFrame, target: str = S.AWARD, keep: Sequence[str] = ()) -> DataFrame:
    """Features and log target, missing values filled where a neutral value exists."""
    required = [S.PRICE, S.DURATION_DAYS, S.BIDDERS, S.MODALITY, target]
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"The table lacks the columns {missing}")
    return df.select(
        *keep,
        _log_amount(number_column(df, S.PRICE)).alias(PRICE_LOG),
        F.coalesce(number_column(df, S.DURATION_DAYS), F.lit(0.0)).alias(S.DURATION_DAYS),
        F.coalesce(number_column(df, S.BIDDERS), F.lit(1.0)).alias(S.BIDDERS),
        F.coalesce(F.col(S.MODALITY).cast("string"), F.lit(UNDEFINED)).alias(S.MODALITY),
        _log_amount(number_column(df, target)).alias(LABEL),
    )


def is_test_row(id_column: str = S.ID, test_size: float = 0.2, seed: int = 42) -> Column:
    """True for the rows of the test part.

    The part depends on the id alone, so it survives repartitioning, retries and new
    rows, which a random number per row would not.
    """
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return number < math.ceil(test_size * 2**32)


def hash_split(
    df: DataFrame, id_column: str = S.ID, test_size: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows."""
    test = is_test_row(id_column, test_size, seed)
    return df.where(~test), df.where(test)


def standardize(df: DataFrame, columns: Sequence[str] = tuple(NUMERIC_FEATURES)) -> DataFrame:
    """Columns centred and divided by the population deviation; a constant becomes 0."""
    moments = df.agg(*[
        F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in columns
    ]).select(F.struct("*")).scalar()
    scaled = {}
    for c in columns:
        centred = F.col(c) - moments[c]["mean"]
        scaled[c] = F.when(moments[c]["std"] > 0, centred / moments[c]["std"]).otherwise(centred)
    return df.withColumns(scaled)


def _refuse_above_limit(width: int) -> None:
    if width > _NORMAL_SOLVER_FEATURES:
        raise ValueError(f"{width} features; the normal equations take {_NORMAL_SOLVER_FEATURES} at most")


def _encoder_stages(spark: SparkSession, column: str, labels: Sequence[str]) -> list:
    """Stages that encode ``column`` without the first of its ``labels``; none for a single one."""
    if len(labels) < 2:
        return []
    indexer = StringIndexerModel.from_labels(
        list(labels), inputCol=column, outputCol=f"{column}_index", handleInvalid="keep"
    )
    known = indexer.transform(spark.createDataFrame([(label,) for label in labels], f"`{column}` string"))
    encoder = OneHotEncoder(
        inputCols=[f"{column}_index"], outputCols=[f"{column}_all"], dropLast=False
    ).fit(known)
    # The encoder adds a slot for unseen categories behind the known ones; slicing
    # removes it together with the first category.
    slicer = VectorSlicer(
        inputCol=f"{column}_all", outputCol=f"{column}_vec", indices=list(range(1, len(labels)))
    )
    return [indexer, encoder, slicer]


@dataclass
class TrainingFacts:
    """What one aggregation tells of the training rows."""

    n: int
    incomplete: int
    means: dict[str, float]
    deviations: dict[str, float]  # of the population
    categories: dict[str, list[str]]
    covariance: list[list[float]] | None = None  # of the numbers, label last; without categorical columns


def training_facts(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str | None) -> TrainingFacts:
    """Counts, moments and categories from one read of ``train``.

    Rows are grouped by category, once for each categorical column, and the moments of the first one's
    groups are put together.  Without categorical columns the covariances of the numbers are found, too.  Only as many groups go to the driver as tell that the solver cannot take them all.
    """
    numbers = [*numeric, *([label] if label else [])]
    incomplete = F.greatest(F.lit(False), *[F.col(c).isNull() for c in [*numbers, *categorical]])
    entries = [F.struct(F.lit(i).alias("column"), value.cast("string").alias("category"))
               for i, value in enumerate([F.col(c) for c in categorical] or [F.lit(None)])]
    rows = train.select(*numbers, incomplete.alias("incomplete"), F.explode(F.array(*entries)).alias("at"))
    groups = rows.groupBy("at").agg(
        F.count("*").alias("n"), F.count_if("incomplete").alias("incomplete"),
        *[F.struct(F.count(c).alias("n"), F.avg(c).alias("mean"), F.var_pop(c).alias("variance")).alias(f"of_{i}")
          for i, c in enumerate(numbers)],
        *[F.covar_pop(c, numbers[j]).alias(f"of_{i}_{j}") for i, c in enumerate(numbers) for j in range(i) if not categorical],
    )
    found = groups.limit(_NORMAL_SOLVER_FEATURES + 2 * len(entries) + 1).collect()
    named = {c: sorted(g["at"]["category"] for g in found if g["at"]["column"] == i and g["at"]["category"] is not None)
             for i, c in enumerate(categorical)}
    _refuse_above_limit(len(numeric) + sum(max(len(labels) - 1, 0) for labels in named.values()))
    first = [g for g in found if g["at"]["column"] == 0]
    means, deviations = {}, {}
    for i, c in enumerate(numbers):
        parts = [(g[f"of_{i}"]["n"], g[f"of_{i}"]["mean"], g[f"of_{i}"]["variance"]) for g in first if g[f"of_{i}"]["n"]]
        total = sum(n for n, _, _ in parts)
        means[c] = math.fsum(n * mean for n, mean, _ in parts) / total if total else 0.0
        spread = math.fsum(n * (variance + (mean - means[c]) ** 2) for n, mean, variance in parts)
        deviations[c] = math.sqrt(spread / total) if total else 0.0
    covariance = None
    if first and not categorical:  # one group
        covariance = [[first[0][f"of_{i}"]["variance"] if i == j else first[0][f"of_{max(i, j)}_{min(i, j)}"]
                       for j in range(len(numbers))] for i in range(len(numbers))]
    return TrainingFacts(
        sum(g["n"] for g in first), sum(g["incomplete"] for g in first), means, deviations, named, covariance)


def _with_equal_moments(means: Sequence[float], covariance: Sequence[Sequence[float]]) -> list[list[float]]:
    """A few rows with these means and population covariances: pairs around the means, one for each direction.

    None at all if no rows have these covariances, as where a number varies by rounding errors only.
    """
    width, middle, spread = len(means), np.array(means), np.array(covariance)
    # Numbers of very different size keep their own precision.
    size = np.sqrt(np.diag(spread))
    unit = np.where(size > 0, size, 1.0)
    values, directions = np.linalg.eigh(spread / np.outer(unit, unit))
    if values.min() < -1e-9:
        return []
    steps = unit[:, None] * directions * np.sqrt(np.maximum(values, 0.0) * width)
    return [(middle + sign * step).tolist() for step in steps.T for sign in (-1, 1)]


def _for_the_estimator(train: DataFrame, numeric: Sequence[str], facts: TrainingFacts) -> DataFrame:
    """Rows with the normal equations of ``train``: a few with the moments in its facts if they tell all, or ``train``.

    The equations, divided by the number of rows, are made of means and covariances.
    """
    names = [*numeric, LABEL]
    moments = [*map(facts.means.get, names), *sum(facts.covariance or [], [])]
    if facts.covariance is None or not all(map(math.isfinite, moments)):
        return train
    rows = _with_equal_moments(moments[:len(names)], facts.covariance)
    return train.sparkSession.createDataFrame(rows, ", ".join(f"`{c}` double" for c in names)) if rows else train


def one_hot_drop_first(df: DataFrame, column: str = S.MODALITY) -> DataFrame:
    """``df`` with a 0/1 vector of all categories but the first, in sorted order."""
    facts = training_facts(df, [], [column], None)
    encoded = PipelineModel(_encoder_stages(df.sparkSession, column, facts.categories[column])).transform(df)
    return encoded.drop(f"{column}_index", f"{column}_all")


def build_preprocessor(
    train: DataFrame,
    numeric: Sequence[str] = tuple(NUMERIC_FEATURES),
    categorical: Sequence[str] = tuple(CATEGORICAL_FEATURES),
    facts: TrainingFacts | None = None,
) -> PipelineModel:
    """Scaling and encoding, ending in a ``features`` vector.  ``train`` is not read if its facts are known."""
    spark = train.sparkSession
    facts = facts or training_facts(train, numeric, categorical, None)
    numbers = VectorAssembler(inputCols=list(numeric), outputCol="num_raw", handleInvalid="error")
    # Two points with the mean of the rows, whose sample deviation is the rows' population one.
    points = [[facts.means[c] + sign * facts.deviations[c] / math.sqrt(2) for c in numeric] for sign in (-1, 1)]
    scaler = StandardScaler(inputCol="num_raw", outputCol="num_vec", withMean=True, withStd=True).fit(
        spark.createDataFrame([(Vectors.dense(point),) for point in points], ["num_raw"]))
    stages, vectors = [numbers, scaler], ["num_vec"]
    for column in categorical:
        encoding = _encoder_stages(spark, column, facts.categories[column])
        stages += encoding
        vectors += [f"{column}_vec"] if encoding else []
    stages.append(VectorAssembler(inputCols=vectors, outputCol="features"))
    return PipelineModel(stages)


def feature_names(model: PipelineModel) -> list[str]:
    """Technical names of the entries of the ``features`` vector."""
    numbers = next(s for s in model.stages if isinstance(s, VectorAssembler))
    names = [f"num__{c}" for c in numbers.getInputCols()]
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            names += [f"cat__{stage.getInputCol()}_{label}" for label in stage.labels[1:]]
    return names


def fit_model(
    train: DataFrame, model_type: str = "ridge", alpha: float = 1.0,
    numeric: Sequence[str] = tuple(NUMERIC_FEATURES),
    categorical: Sequence[str] = tuple(CATEGORICAL_FEATURES),
) -> PipelineModel:
    """Ridge (squared error plus ``alpha`` times squared weights) or least squares.

    ``train`` is read for its facts and for the sums of the normal equations; the estimator then counts its
    rows once more.  Without categorical columns the facts tell these sums, and it is read once.  Where columns depend on each other, least squares gives the smallest weights that fit best.
    """
    return _fit(train, model_type, alpha, numeric, categorical)[0]


def _fit(
    train: DataFrame, model_type: str, alpha: float, numeric: Sequence[str], categorical: Sequence[str]
) -> tuple[PipelineModel, TrainingFacts]:
    kind = model_type.lower()
    if kind not in MODEL_TYPES:
        raise ValueError(f"No model type '{model_type}'; there are {', '.join(MODEL_TYPES)}")
    facts = training_facts(train, numeric, categorical, LABEL)
    if not facts.n:
        raise ValueError("No training rows")
    if facts.incomplete:
        raise ValueError(f"{facts.incomplete} training rows have a missing feature or label")

    preprocessor = build_preprocessor(train, numeric, categorical, facts)
    # The estimator minimises the mean error on a label scaled by its deviation, hence
    # the factor between its penalty and ``alpha``.  The smallest weights are the limit of
    # ever smaller penalties.
    penalty = alpha / facts.n if kind == "ridge" else _VANISHING_PENALTY
    regressor = LinearRegression(
        featuresCol="features", labelCol=LABEL, predictionCol=PREDICTION,
        elasticNetParam=0.0, standardization=False, solver="normal",
        regParam=penalty * facts.deviations[LABEL],
    )
    rows = _for_the_estimator(train, numeric, facts)
    fitted = regressor.fit(preprocessor.transform(rows).select("features", LABEL))
    return PipelineModel([*preprocessor.stages, fitted]), facts


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Log and real predictions with their residuals, true minus predicted."""
    scored = model.transform(rows).select(*rows.columns, PREDICTION)
    return scored.select(
        "*", F.expm1(LABEL).alias("real"), F.expm1(PREDICTION).alias("predicho")
    ).select(
        "*",
        (F.col(LABEL) - F.col(PREDICTION)).alias("residuo_log"),
        (F.col("real") - F.col("predicho")).alias("residuo_real"),
    )


def _r2(true: str, predicted: str) -> Column:
    squares = F.sum(F.pow(F.col(true) - F.col(predicted), F.lit(2.0)))
    total = F.var_pop(true) * F.count(true)
    return F.when(total > 0, 1 - squares / total).when(squares == 0, 1.0).otherwise(0.0)


def mape_percent(true: str, predicted: str) -> Column:
    """Mean absolute error in percent of the positive true values; 0 if there are none."""
    share = F.abs(F.try_divide(F.col(true) - F.col(predicted), F.col(true)))
    return F.coalesce(F.avg(F.when(F.col(true) > 0, share)) * 100, F.lit(0.0))


def regression_metrics(
    predictions: DataFrame, label: str = LABEL, prediction: str = PREDICTION,
    real: str = "real", predicted: str = "predicho",
) -> DataFrame:
    """One row with the errors on both scales, from one aggregation."""
    log_gap, real_gap = F.col(label) - F.col(prediction), F.col(real) - F.col(predicted)
    return predictions.agg(
        _r2(label, prediction).alias("r2_log"),
        F.avg(F.abs(log_gap)).alias("mae_log"),
        F.sqrt(F.avg(log_gap * log_gap)).alias("rmse_log"),
        _r2(real, predicted).alias("r2_real"),
        F.avg(F.abs(real_gap)).alias("mae_real"),
        (F.avg(F.abs(real_gap)) / 1e6).alias("mae_millones_cop"),
        mape_percent(real, predicted).alias("mape_real"),
        F.count("*").alias("n_test"),
    )


def coefficient_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Feature, label, coefficient, direction and magnitude; the strongest first."""
    regressor = next(s for s in model.stages if isinstance(s, LinearRegressionModel))
    rows = list(zip(feature_names(model), [float(c) for c in regressor.coefficients.toArray()]))
    table = spark.createDataFrame(rows, "variable string, coeficiente double")
    return table.select(
        "variable",
        feature_label(F.col("variable")).alias("variable_limpia"),
        "coeficiente",
        F.when(F.col("coeficiente") > 0, RAISES).otherwise(LOWERS).alias("direccion"),
        F.abs("coeficiente").alias("magnitud"),
    ).orderBy(F.desc("magnitud"), "variable")


@dataclass
class Evaluation:
    """Fitted model and predictions of the test rows."""

    model: PipelineModel
    predictions: DataFrame
    n_train: int

    @property
    def metrics(self) -> DataFrame:
        """One row with the errors of the test rows."""
        return regression_metrics(self.predictions).select("*", F.lit(self.n_train).cast("bigint").alias("n_train"))


def train_and_evaluate(
    train: DataFrame, test: DataFrame, model_type: str = "ridge", alpha: float = 1.0
) -> Evaluation:
    """Fit on ``train``; predictions and metrics of ``test`` stay lazy."""
    kept = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model, facts = _fit(kept, model_type, alpha, NUMERIC_FEATURES, CATEGORICAL_FEATURES)
    finally:
        kept.unpersist()
    return Evaluation(model, predict(model, test), facts.n)


def save_model(model: PipelineModel, path: str) -> str:
    """Write the fitted pipeline, replacing an earlier one."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """Read a fitted pipeline; ``FileNotFoundError`` if there is none."""
    try:
        return PipelineModel.load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"No se encontró el modelo en: '{path}'") from error
        raise
