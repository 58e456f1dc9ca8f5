"""Central tendency and dispersion, one row per variable."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlens import schema as S
from tenderlens.functions import number_column
from tenderlens.operators.quantiles import exact_quantiles, is_present

# Limits and wording of the skew classes.
SKEW_LIMIT = 0.5
SKEW_RIGHT = "Asimetría Positiva (Sesgo a la derecha)"
SKEW_LEFT = "Asimetría Negativa (Sesgo a la izquierda)"
SKEW_NONE = "Aproximadamente Simétrica"

# Buckets of all columns together in the search for modes: so many rows are broadcast at most.
MODE_BUCKETS = 1 << 18

CENTRAL_SCHEMA = (
    "variable string, media double, mediana double, moda double, skewness double, "
    "divergencia_media_vs_mediana_pct double, interpretacion_sesgo string"
)
DISPERSION_SCHEMA = (
    "variable string, desviacion_estandar double, varianza double, min double, max double, "
    "rango double, q1 double, q3 double, iqr double, coeficiente_variacion_pct double"
)


def moment_rows(
    df: DataFrame, columns: Sequence[str], measures: Mapping[str, Callable[[str], Column]]
) -> DataFrame:
    """One wide aggregation over all columns, turned into a row per variable."""
    wide = df.agg(*[
        F.struct(*[measure(c).alias(name) for name, measure in measures.items()]).alias(c)
        for c in columns
    ])
    rows = [
        F.struct(F.lit(c).alias("variable"), *[F.col(c)[name].alias(name) for name in measures])
        for c in columns
    ]
    return wide.select(F.inline(F.array(*rows)))


def adjusted_skewness(n: Column, skewness: Column, low: Column, high: Column) -> Column:
    """Bias-adjusted skewness from the population one; NULL below three values, 0 for constants."""
    size = n.cast("double")
    adjusted = skewness * F.sqrt(size * (size - 1)) / (size - 2)
    return F.when(n >= 3, F.when(low == high, F.lit(0.0)).otherwise(adjusted))


def skew_class(skewness: Column) -> Column:
    """Wording of the skew; an unknown skew counts as symmetric."""
    return (
        F.when(skewness > SKEW_LIMIT, SKEW_RIGHT)
        .when(skewness < -SKEW_LIMIT, SKEW_LEFT)
        .otherwise(SKEW_NONE)
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(variable, value, n)``: distinct values of every column with their frequency."""
    values = df.select(*[number_column(df, c).alias(c) for c in columns])
    long = values.unpivot([], list(columns), "variable", "value").where(is_present(F.col("value")))
    return long.groupBy("variable", "value").agg(F.count("*").alias("n"))


def smallest_mode(counts: DataFrame) -> DataFrame:
    """``(variable, moda)``: the smallest of the most frequent values of each variable.

    ``counts`` has one row per variable and distinct value.  The highest frequency
    per variable is a handful of rows, one per column of the original table.
    """
    highest = counts.groupBy("variable").agg(F.max("n").alias("n"))
    return (
        counts.join(F.broadcast(highest), ["variable", "n"])
        .groupBy("variable").agg(F.min("value").alias("moda"))
    )


def mode_candidates(df: DataFrame, columns: Sequence[str], buckets: int = MODE_BUCKETS) -> DataFrame:
    """``(column, value, n)``: values with their frequency, all modes among them; ``column`` is a place in ``columns``.

    Values are hashed into ``buckets`` (of all columns together), and a bucket keeps its rows, least and
    largest value.  A bucket of one value is a frequency.  One of several values holds none as frequent as
    its rows, so it matters only if it has more rows than the best frequency known: that of a pure
    bucket, or of the values of the fullest mixed one, which are counted first.  Only the
    values of mixed buckets beyond it are counted in full.  Three scans, whose shuffles carry a row per bucket and
    those values; they are few where the mode has more rows than an average bucket, and all
    that share buckets where hardly any value repeats.  A value may be there twice.
    """
    each = 1 << (max(1, buckets // len(columns)).bit_length() - 1)
    values = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("column"), (number_column(df, c) + F.lit(0.0)).alias("value"))
        for i, c in enumerate(columns)])))
    # The bucket is never NULL, so joins add no filters below the count, which then runs once.
    place = F.col("column").cast("bigint") * each + F.xxhash64("value").bitwiseAND(F.lit(each - 1))
    values = values.where(is_present(F.col("value"))).select("column", "value", place.alias("bucket"))
    counted = values.groupBy("column", "bucket").agg(
        F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    pure = F.col("low") == F.col("high")

    def frequencies(chosen: DataFrame) -> DataFrame:
        rows = values.join(F.broadcast(chosen), "bucket", "left_semi")
        return rows.groupBy("column", "value").agg(F.count("*").alias("n"))

    fullest = counted.where(~pure).groupBy("column").agg(F.max_by("bucket", F.struct("n", "bucket")).alias("bucket"))
    known = counted.where(pure).select("column", F.col("low").alias("value"), "n")
    known = known.unionByName(frequencies(fullest.select("bucket")))
    best = known.groupBy(F.col("column").alias("of")).agg(F.max("n").alias("best"))  # a row per column
    beyond = counted.where(~pure).join(F.broadcast(best), (F.col("column") == F.col("of")) & (F.col("n") > F.col("best")))
    return known.unionByName(frequencies(beyond.select("bucket")))


def exact_modes(df: DataFrame, columns: Sequence[str], buckets: int = MODE_BUCKETS) -> DataFrame:
    """``(variable, moda)`` as ``smallest_mode``, from ``mode_candidates`` instead of all distinct values.

    Columns without values have no row.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], "variable string, moda double")
    found = mode_candidates(df, columns, buckets)
    names = F.array(*[F.lit(c) for c in columns])
    return found.groupBy("column").agg(F.max_by("value", F.struct("n", -F.col("value"))).alias("moda")).select(
        F.element_at(names, F.col("column") + 1).alias("variable"), "moda")


def central_tendency(
    df: DataFrame, columns: Sequence[str] = tuple(S.STATISTICS_COLUMNS), method: str = "narrow",
    medians: DataFrame | None = None,
) -> DataFrame:
    """Mean, median, mode, adjusted skewness and the distance between mean and median.

    ``medians`` (``variable``, ``mediana``) if they are known already; modes are then found without
    counting every distinct value, which medians and modes share otherwise.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], CENTRAL_SCHEMA)
    values = df.select(*[number_column(df, c).alias(c) for c in present])
    moments = moment_rows(values, present, {
        "n": F.count, "media": F.avg, "g1": F.skewness, "low": F.min, "high": F.max,
    }).where(F.col("n") > 0)
    if medians is None:
        counts = value_counts(values, present)
        modes = smallest_mode(counts)
        medians = exact_quantiles(
            counts, F.col("value"), {"mediana": 0.5}, ["variable"],
            weight=F.col("n"), method=method, groups_bounded=True,
        )
    else:
        modes = exact_modes(values, present)
    skewness = adjusted_skewness(F.col("n"), F.col("g1"), F.col("low"), F.col("high"))
    distance = (F.col("media") - F.col("mediana")) / F.abs("mediana") * 100
    return (
        moments.join(F.broadcast(medians), "variable")
        .join(F.broadcast(modes), "variable")
        .withColumn("skewness", skewness)
        .select(
            "variable", "media", "mediana", "moda", "skewness",
            F.when(F.col("mediana") != 0, distance).alias("divergencia_media_vs_mediana_pct"),
            skew_class(F.col("skewness")).alias("interpretacion_sesgo"),
        )
    )


def dispersion(
    df: DataFrame, columns: Sequence[str] = tuple(S.STATISTICS_COLUMNS), method: str = "narrow",
    quartiles: DataFrame | None = None,
) -> DataFrame:
    """Standard deviation, variance, range, quartiles and coefficient of variation.

    ``quartiles`` (``variable``, ``q1``, ``q3``) if they are known already.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], DISPERSION_SCHEMA)
    values = df.select(*[number_column(df, c).alias(c) for c in present])
    moments = moment_rows(values, present, {
        "desviacion_estandar": F.stddev_samp, "varianza": F.var_samp,
        "min": F.min, "max": F.max, "media": F.avg,
    })
    if quartiles is None:
        quartiles = exact_quantiles(
            values.unpivot([], present, "variable", "value"), F.col("value"),
            {"q1": 0.25, "q3": 0.75}, ["variable"], method=method, groups_bounded=True,
        )
    variation = F.col("desviacion_estandar") / F.abs("media") * 100
    return moments.join(F.broadcast(quartiles), "variable").select(
        "variable", "desviacion_estandar", "varianza", "min", "max",
        (F.col("max") - F.col("min")).alias("rango"),
        "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"),
        F.when(F.col("media") != 0, variation).alias("coeficiente_variacion_pct"),
    )
