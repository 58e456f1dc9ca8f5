"""The tables behind the charts, reduced on the cluster to what a plot needs."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlens import schema as S
from tenderlens.functions import number_column
from tenderlens.operators.quantiles import exact_quantiles, few_groups, first_digit, with_order_code

# exp(-z*z/2) is zero in double precision beyond this many bandwidths.
_KERNEL_REACH = 38.7

# Fixed values of the charts.
TOLERANCE_BAND = 0.10
AXIS_MARGIN = 0.05
RATIO_ABOVE, RATIO_UP_TO = 0.4, 1.2
BIDDER_AXIS_CAP = 50
ERROR_CLIP, ERROR_BINS = 30.0, 35
RISK_THRESHOLD_MILLIONS = 100.0
RISK_SCOPE_PERCENTILE, RISK_SCOPE_FLOOR = 0.98, 5000.0

# Legend texts.
FLAG_NORMAL, FLAG_OVERCOST = "Sin Sobrecosto (Normal)", "Con Sobrecosto"
RISK_HIGH = "Alerta Alta (Sobreprecio)"
RISK_MEDIUM = "Alerta Media (Descuento Anormal)"
RISK_NORMAL = "Normal (Alineado)"


def _axis_values(df: DataFrame, value: str, log: bool) -> DataFrame:
    """The values on the chart's axis; a log axis shows positive amounts only."""
    amount = number_column(df, value)
    x = F.when(amount > 0, F.log10(amount)) if log else amount
    return df.select(x.alias("x")).where(F.col("x").isNotNull())


def _automatic_bins(values: DataFrame, method: str, quartiles: DataFrame | None) -> Column:
    """Number of bins from the narrower of the quartile rule and the logarithmic rule.

    The quartile rule is kept from going below half the width of the square-root rule.
    """
    if quartiles is None:
        quartiles = exact_quantiles(values, F.col("x"), {"q1": 0.25, "q3": 0.75}, method=method)
    spread = quartiles.select(F.col("q3") - F.col("q1")).scalar()
    n = F.col("n").cast("double")
    extent = F.col("high") - F.col("low")
    by_quartiles = 2 * spread * F.pow(n, F.lit(-1 / 3))
    by_root = extent / F.sqrt(n)
    by_log = extent / (F.log2(n) + 1)
    width = F.least(F.greatest(by_quartiles, by_root / 2), by_log)
    return F.when(extent > 0, F.ceil(extent / width)).otherwise(1).cast("bigint")


def histogram(
    df: DataFrame, value: str, bins: int | None = None, log: bool = False, method: str = "narrow",
    quartiles: DataFrame | None = None,
) -> DataFrame:
    """Equal-width bins ``(bin, desde, hasta, n)``, empty ones included; the last is closed.

    On a log axis the bins have equal width in ``log10`` and the edges are amounts.
    ``quartiles`` (``q1``, ``q3`` on the axis) if they are known already.
    """
    values = _axis_values(df, value, log)
    extent = values.agg(
        F.count("x").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")
    )
    count = F.lit(bins).cast("bigint") if bins else _automatic_bins(values, method, quartiles)
    pad = F.when(F.col("low") == F.col("high"), 0.5).otherwise(0.0)
    axis = extent.select(
        (F.col("low") - pad).alias("low"), (F.col("high") + pad).alias("high"), count.alias("bins")
    ).where(F.col("low").isNotNull())
    a = axis.select(F.struct("*")).scalar()

    place = F.floor((F.col("x") - a["low"]) * a["bins"] / (a["high"] - a["low"]))
    placed = values.select(F.least(place, a["bins"] - 1).alias("bin"))
    counted = placed.groupBy("bin").agg(F.count("*").alias("n"))
    width = (F.col("high") - F.col("low")) / F.col("bins")
    edges = axis.select(
        "low", width.alias("width"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bins") - 1)).alias("bin"),
    )

    def amount(x: Column) -> Column:
        return F.pow(F.lit(10.0), x) if log else x

    return (
        edges.join(counted, "bin", "left")
        .select(
            "bin",
            amount(F.col("low") + F.col("bin") * F.col("width")).alias("desde"),
            amount(F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("hasta"),
            F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        )
        .orderBy("bin")
    )


def log_histogram(
    df: DataFrame, value: str = S.AWARD, bins: int | None = None, method: str = "narrow",
    quartiles: DataFrame | None = None,
) -> DataFrame:
    """Histogram of the positive values on a log axis."""
    return histogram(df, value, bins, log=True, method=method, quartiles=quartiles)


def _on_cells(values: DataFrame, g: Column) -> DataFrame:
    """The values ``x`` as weighted nodes of a fine grid, two rows per cell that holds any.

    A value gives each end of its cell the share that linear interpolation takes from there.
    """
    place = (F.col("x") - g["low"]) / g["cell"]
    cells = values.select(F.floor(place).alias("cell"), (place - F.floor(place)).alias("right"))
    counted = cells.groupBy("cell").agg(F.sum(1 - F.col("right")).alias("left"), F.sum("right").alias("right"))
    ends = F.array(
        F.struct(F.col("cell").alias("node"), F.col("left").alias("weight")),
        F.struct((F.col("cell") + 1).alias("node"), F.col("right").alias("weight")),
    )
    return counted.select(F.inline(ends)).select((g["low"] + F.col("node") * g["cell"]).alias("x"), "weight")


def density_curve(
    df: DataFrame, value: str = S.AWARD, log: bool = True, points: int = 200, cut: float = 3.0,
    binned: bool = False, tolerance: float = 1e-6,
) -> DataFrame:
    """Gaussian kernel density ``(punto, x, densidad)`` on an even grid.

    The bandwidth is ``std * n ** (-1/5)`` and the grid reaches ``cut`` bandwidths past
    the data.  A row is added only to the grid points at which its kernel is not zero in
    double precision, so the sum is exact, and the bandwidth shrinks as the table
    grows, so a row then touches few points.  At most ``points`` sums leave a task.

    ``binned`` first counts the rows on a grid so fine that no density is off by more than
    ``tolerance``: linear interpolation over a cell errs by an eighth of its squared width times the kernel's largest
    second derivative.  Each row is then one count, and only cells meet the points of the curve.
    """
    values = _axis_values(df, value, log)
    n = F.col("n").cast("double")
    moments = values.agg(
        F.count("x").alias("n"), F.stddev_samp("x").alias("std"),
        F.min("x").alias("low"), F.max("x").alias("high"),
    ).select(n.alias("n"), (F.col("std") * F.pow(n, F.lit(-0.2))).alias("bandwidth"), "low", "high")
    start = F.col("low") - cut * F.col("bandwidth")
    cell = F.sqrt(F.pow("bandwidth", F.lit(3.0)) * (8 * math.sqrt(2 * math.pi) * tolerance))
    grid = moments.where(F.col("bandwidth") > 0).select(
        "n", "bandwidth", start.alias("start"),
        ((F.col("high") + cut * F.col("bandwidth") - start) / (points - 1)).alias("step"), "low", cell.alias("cell"),
    )
    g = grid.select(F.struct("*")).scalar()
    weighted = _on_cells(values, g) if binned else values.select("x", F.lit(1.0).alias("weight"))

    reach = _KERNEL_REACH * g["bandwidth"]
    first = F.greatest(F.ceil((F.col("x") - reach - g["start"]) / g["step"]), F.lit(0))
    last = F.least(F.floor((F.col("x") + reach - g["start"]) / g["step"]), F.lit(points - 1))
    distance = (g["start"] + F.col("punto") * g["step"] - F.col("x")) / g["bandwidth"]
    sums = (
        weighted.select("x", "weight", first.cast("int").alias("first"), last.cast("int").alias("last"))
        .where("first <= last")
        .select("x", "weight", F.explode(F.sequence("first", "last")).alias("punto"))
        .select("punto", (F.col("weight") * F.exp(-0.5 * distance * distance)).alias("kernel"))
        .groupBy("punto").agg(F.sum("kernel").alias("kernels"))
    )
    scale = F.col("n") * F.col("bandwidth") * math.sqrt(2 * math.pi)
    return (
        grid.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("punto"))
        .join(sums, "punto", "left")
        .select(
            "punto", (F.col("start") + F.col("punto") * F.col("step")).alias("x"),
            (F.coalesce("kernels", F.lit(0.0)) / scale).alias("densidad"),
        )
        .orderBy("punto")
    )


def reference_lines(
    df: DataFrame, value: str = S.AWARD, method: str = "narrow", median: DataFrame | None = None
) -> DataFrame:
    """One row: mean and median of the column; ``median`` (``mediana``) if it is known already."""
    amount = number_column(df, value)
    if median is None:
        median = exact_quantiles(df, amount, {"mediana": 0.5}, method=method)
    return df.agg(F.avg(amount).alias("media")).select("media", median.scalar().alias("mediana"))


def _fences_of(
    values: DataFrame, key: str, k: float, method: str, quartiles: DataFrame | None
) -> tuple[DataFrame, bool]:
    """Quartiles and fences of ``_x`` per group, and whether the groups are few enough to broadcast."""
    if quartiles is None:
        few = few_groups(values, [key])
        quartiles = exact_quantiles(
            values, F.col("_x"), {"q1": 0.25, "mediana": 0.5, "q3": 0.75}, [key], method=method,
            groups_bounded=few,
        )
    else:
        few = few_groups(quartiles, [key])
    spread = F.col("q3") - F.col("q1")
    return quartiles.select(
        "*", (F.col("q1") - k * spread).alias("_low"), (F.col("q3") + k * spread).alias("_high")
    ), few


def _present_values(df: DataFrame, value: str, key: str) -> DataFrame:
    """The rows that have a group and a value, which is ``_x``."""
    values = df.where(F.col(key).isNotNull()).select("*", number_column(df, value).alias("_x"))
    return values.where(F.col("_x").isNotNull())


def boxplot_by_group(
    df: DataFrame, value: str = S.AWARD, key: str = S.MODALITY, k: float = 1.5,
    method: str = "narrow", quartiles: DataFrame | None = None,
) -> DataFrame:
    """Box, mean, whiskers and number of fliers per group, highest median first.

    A whisker ends at the most extreme value within the fences, or at the box if no
    value lies between fence and box.  ``quartiles`` (the key, ``q1``, ``mediana``, ``q3``) if they are known already.

    The rows are counted per group and first digit of the value's code, with sum, least and largest
    value, and only these cells are joined with the boxes.  A cell lies within the fences, beyond
    them, or across one, as at most two of a group do; only the values of those are looked at again.
    """
    values = _present_values(df, value, key).select(F.col(key).alias("_key"), "_x")
    boxes, few = _fences_of(values, "_key", k, method, quartiles and quartiles.withColumnRenamed(key, "_key"))
    hint = F.broadcast if few else (lambda table: table)
    x = F.col("_x")
    coded = with_order_code(values, "_x", "_code").select("_key", "_x", first_digit("_code").alias("_cell"))
    cells = coded.groupBy("_key", "_cell").agg(
        F.count("*").alias("n"), F.sum(x).alias("sum"), F.min(x).alias("least"), F.max(x).alias("most"))
    cells = cells.join(hint(boxes), "_key")
    low, high = F.col("_low"), F.col("_high")
    within = (F.col("least") >= low) & (F.col("most") <= high)
    beyond = (F.col("most") < low) | (F.col("least") > high)
    box = ["_key", "q1", "mediana", "q3", "_low", "_high"]
    groups = cells.groupBy(*box).agg(
        F.sum("n").alias("n"), (F.sum("sum") / F.sum("n")).alias("media"),
        F.min(F.when(within, F.col("least"))).alias("least"), F.max(F.when(within, F.col("most"))).alias("most"),
        F.sum(F.when(beyond, F.col("n")).otherwise(0)).alias("out"),
        F.collect_list(F.when(~within & ~beyond, F.col("_cell"))).alias("across"), F.min("_cell").alias("any"))
    # A group without such a cell looks at one that changes nothing, so that no group is lost.
    crossed = F.size("across") > 0
    targets = groups.withColumn("crossed", crossed).select(
        "*", F.explode(F.when(crossed, F.col("across")).otherwise(F.array("any"))).alias("_cell")).drop("across", "any")
    # Too many groups to broadcast: count first, so that a frequent value moves as one row.
    rows = coded.withColumn("rows", F.lit(1)) if few else coded.groupBy("_key", "_cell", "_x").agg(
        F.count("*").alias("rows"))
    inside = x.between(low, high)
    return (
        rows.join(hint(targets), ["_key", "_cell"])
        .groupBy(*box, "n", "media", "least", "most", "out").agg(
            F.min(F.when(inside, x)).alias("x_least"), F.max(F.when(inside, x)).alias("x_most"),
            F.sum(F.when(F.col("crossed") & ~inside, F.col("rows")).otherwise(0)).alias("x_out"))
        .select(
            F.col("_key").alias(key), "n", "media", "q1", "mediana", "q3",
            F.least("least", "x_least", "q1").alias("bigote_inferior"),
            F.greatest("most", "x_most", "q3").alias("bigote_superior"),
            (F.col("out") + F.col("x_out")).alias("atipicos"),
        )
        .orderBy(F.desc("mediana"), key)
    )


def boxplot_fliers(
    df: DataFrame, value: str = S.AWARD, key: str = S.MODALITY, k: float = 1.5,
    method: str = "narrow",
) -> DataFrame:
    """The rows beyond the fences of their own group."""
    values = _present_values(df, value, key)
    boxes, few = _fences_of(values, key, k, method, None)
    rows = values.join(F.broadcast(boxes) if few else boxes, key)
    beyond = ~F.col("_x").between(F.col("_low"), F.col("_high"))
    return rows.where(beyond).select(*df.columns)


def competition_points(
    df: DataFrame, competition: str = S.BIDDERS, value: str = S.AWARD, flag: str = S.OVERCOST_FLAG
) -> DataFrame:
    """One point per contract with the legend text of its series."""
    series = F.when(F.col(flag) == 0, FLAG_NORMAL).when(F.col(flag) == 1, FLAG_OVERCOST)
    return df.select(competition, value, flag, series.alias("serie")).where(F.col(flag).isin(0, 1))


def competition_series(df: DataFrame, flag: str = S.OVERCOST_FLAG) -> DataFrame:
    """Number of points per series."""
    return df.where(F.col(flag).isin(0, 1)).groupBy(flag).agg(F.count("*").alias("contratos"))


def competition_grid(
    df: DataFrame, competition: str = S.BIDDERS, value: str = S.AWARD,
    flag: str = S.OVERCOST_FLAG, per_decade: int = 10,
) -> DataFrame:
    """The points of the chart counted in cells: bidders by log10 band of the amount."""
    amount = number_column(df, value)
    cell = F.floor(F.log10(amount) * per_decade).alias("celda_log10")
    return (
        df.where((amount > 0) & F.col(flag).isin(0, 1))
        .groupBy(competition, cell, flag).agg(F.count("*").alias("contratos"))
    )


def award_ratio_points(
    df: DataFrame, price: str = S.PRICE, award: str = S.AWARD, competition: str = S.BIDDERS
) -> DataFrame:
    """Contracts awarded at more than 40 % and up to 120 % of the base, with that percentage."""
    ratio = F.try_divide(number_column(df, award), number_column(df, price))
    return (
        df.select(competition, ratio.alias("ratio_adjudicacion"))
        .where((F.col("ratio_adjudicacion") > RATIO_ABOVE)
               & (F.col("ratio_adjudicacion") <= RATIO_UP_TO))
        .withColumn("pct_adjudicado", F.col("ratio_adjudicacion") * 100)
    )


def award_ratio_axis(
    df: DataFrame, price: str = S.PRICE, award: str = S.AWARD, competition: str = S.BIDDERS
) -> DataFrame:
    """One row: upper end of the bidder axis."""
    points = award_ratio_points(df, price, award, competition)
    # An empty selection has no maximum; ``least`` would then fall back to the cap.
    top = F.max(number_column(points, competition))
    return points.agg(
        F.when(top.isNotNull(), F.least(top, F.lit(float(BIDDER_AXIS_CAP)))).alias("eje_x_max")
    )


def prediction_points(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction",
    band: float = TOLERANCE_BAND,
) -> DataFrame:
    """Every prediction with the mark whether it lies within the tolerance band."""
    near = F.abs(F.col(label) - F.col(prediction)) <= band
    return predictions.withColumn("en_banda", near)


def prediction_axis(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction",
    band: float = TOLERANCE_BAND,
) -> DataFrame:
    """One row: axis range with margin and the share of points within the band in percent."""
    points = prediction_points(predictions, label, prediction, band)
    return points.agg(
        F.count("*").alias("n"),
        F.least(F.min(label), F.min(prediction)).alias("low"),
        F.greatest(F.max(label), F.max(prediction)).alias("high"),
        F.count_if("en_banda").alias("en_banda"),
    ).select(
        "n",
        (F.col("low") - (F.col("high") - F.col("low")) * AXIS_MARGIN).alias("eje_min"),
        (F.col("high") + (F.col("high") - F.col("low")) * AXIS_MARGIN).alias("eje_max"),
        "en_banda", (F.try_divide(F.col("en_banda"), F.col("n")) * 100).alias("pct_en_banda"),
    )


def coefficient_bars(coefficients: DataFrame) -> DataFrame:
    """Coefficients in ascending order with the sign that colours the bar."""
    sign = F.when(F.col("coeficiente") < 0, "negativo").otherwise("positivo")
    return coefficients.select("variable_limpia", "coeficiente", sign.alias("signo")).orderBy(
        "coeficiente", "variable_limpia"
    )


def relative_errors(predictions: DataFrame, true: str, predicted: str) -> DataFrame:
    """Relative error in percent, clipped for the chart."""
    error = F.try_divide(F.col(predicted) - F.col(true), F.col(true)) * 100
    clipped = F.greatest(F.lit(-ERROR_CLIP), F.least(F.lit(ERROR_CLIP), error))
    return predictions.select(F.when(error.isNotNull(), clipped).alias("error_pct"))


def error_histogram(
    predictions: DataFrame, true: str = "real", predicted: str = "predicho", bins: int = ERROR_BINS
) -> DataFrame:
    """Histogram of the clipped relative errors."""
    return histogram(relative_errors(predictions, true, predicted), "error_pct", bins)


def error_density(
    predictions: DataFrame, true: str = "real", predicted: str = "predicho", points: int = 200,
    binned: bool = False,
) -> DataFrame:
    """Density of the clipped relative errors over their own range."""
    errors = relative_errors(predictions, true, predicted)
    return density_curve(errors, "error_pct", log=False, points=points, cut=0.0, binned=binned)


def risk_alerts(
    predictions: DataFrame, true: str = "real", predicted: str = "predicho",
    threshold: Column | float = RISK_THRESHOLD_MILLIONS,
) -> DataFrame:
    """Every prediction with its residual in millions and the early-warning class."""
    limit = F.lit(threshold) if isinstance(threshold, (int, float)) else threshold
    gap = (F.col(true) - F.col(predicted)) / 1e6
    alert = F.when(gap > limit, RISK_HIGH).when(gap < -limit, RISK_MEDIUM).otherwise(RISK_NORMAL)
    return predictions.select("*", gap.alias("residuo_millones"), alert.alias("alerta"))


def risk_alerts_by_error(
    predictions: DataFrame, true: str = "real", predicted: str = "predicho", multiple: float = 2.0
) -> DataFrame:
    """The same classes with a threshold of ``multiple`` mean absolute errors."""
    error = F.avg(F.abs(F.col(true) - F.col(predicted)))
    threshold = predictions.agg(error * multiple / 1e6).scalar()
    return risk_alerts(predictions, true, predicted, threshold)


def risk_axis(
    predictions: DataFrame, predicted: str = "predicho", method: str = "narrow"
) -> DataFrame:
    """One row: upper end of both axes in millions."""
    top = exact_quantiles(
        predictions, F.col(predicted) / 1e6, {"p": RISK_SCOPE_PERCENTILE}, method=method
    )
    return top.select(F.greatest("p", F.lit(RISK_SCOPE_FLOOR)).alias("eje_max"))
