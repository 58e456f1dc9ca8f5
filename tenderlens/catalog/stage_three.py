"""Queries for the regression and the tables behind its charts."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlens import schema as S
from tenderlens.catalog.registry import Registry
from tenderlens.catalog.views import (
    clean_table, predictions_view, rounded, with_clean, with_predictions,
)
from tenderlens.functions import feature_label
from tenderlens.operators import charts
from tenderlens.operators import regression as R
from tenderlens.plans import run_stage3
from tenderlens.sources import shared_folder

QUERIES = Registry()
_query = QUERIES.query


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions_view(clean_table(spark, sf_dir))


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.prepare_features(clean_table(spark, sf_dir), keep=[S.ID])


_PREPARED_SQL = """
, prepared as (
  select id_del_portafolio, ln(1 + precio_base) as precio_base_log,
    coalesce(duracion_dias_prevista, 0) as duracion_dias_prevista,
    coalesce(proveedores_unicos_con, 1) as proveedores_unicos_con,
    coalesce(modalidad_de_contratacion, 'No Definido') as modalidad_de_contratacion,
    ln(1 + valor_total_adjudicacion) as label,
    cast('0x' || substr(md5(concat('42:', id_del_portafolio)), 1, 8) as bigint) < 858993460 as de_prueba
  from clean)
"""


@_query(with_clean(_PREPARED_SQL + """
select id_del_portafolio, round(precio_base_log, 9) as precio_base_log, duracion_dias_prevista,
  proveedores_unicos_con, modalidad_de_contratacion, round(label, 9) as label from prepared
"""))
def prepare_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_prepared(spark, sf_dir), {"precio_base_log": 9, "label": 9})


@_query(with_clean(_PREPARED_SQL + "select id_del_portafolio, de_prueba from prepared"))
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = R.hash_split(clean_table(spark, sf_dir).select(S.ID))
    return train.select(S.ID, F.lit(False).alias("de_prueba")).unionAll(
        test.select(S.ID, F.lit(True).alias("de_prueba"))
    )


_SCALED = ", ".join(
    f"round(({c} - avg({c}) over ()) / stddev_pop({c}) over (), 6) as {c}" for c in R.NUMERIC_FEATURES
)


@_query(with_clean(_PREPARED_SQL + f"select id_del_portafolio, {_SCALED} from prepared"))
def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = R.standardize(_prepared(spark, sf_dir).select(S.ID, *R.NUMERIC_FEATURES))
    return rounded(scaled, dict.fromkeys(R.NUMERIC_FEATURES, 6))


@_query(with_clean(_PREPARED_SQL + """
, kinds as (select modalidad_de_contratacion as k, row_number() over (order by k) as pos
  from (select distinct modalidad_de_contratacion from prepared))
select id_del_portafolio, modalidad_de_contratacion,
  array_to_string([cast(cast(i = pos as int) as varchar) for i in range(2, (select count(*) from kinds) + 1)], '') as codigo
from prepared join kinds on modalidad_de_contratacion = k
"""))
def one_hot_drop_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = R.one_hot_drop_first(_prepared(spark, sf_dir).select(S.ID, S.MODALITY))
    digits = F.transform(vector_to_array(f"{S.MODALITY}_vec"), lambda x: x.cast("int").cast("string"))
    return encoded.select(S.ID, S.MODALITY, F.array_join(digits, "").alias("codigo"))


# Centred cross products of three standardised features and the label; the penalised
# normal equations of three unknowns are then solved with determinants.
_MOMENTS_SQL = """
, train as (select * from prepared where not de_prueba),
z as (select (precio_base_log - avg(precio_base_log) over ()) / stddev_pop(precio_base_log) over () as a,
    (duracion_dias_prevista - avg(duracion_dias_prevista) over ()) / stddev_pop(duracion_dias_prevista) over () as b,
    (proveedores_unicos_con - avg(proveedores_unicos_con) over ()) / stddev_pop(proveedores_unicos_con) over () as c,
    label - avg(label) over () as y from train),
s as (select sum(a * a) + {alpha} as aa, sum(b * b) + {alpha} as bb, sum(c * c) + {alpha} as cc,
    sum(a * b) as ab, sum(a * c) as ac, sum(b * c) as bc,
    sum(a * y) as ay, sum(b * y) as by_, sum(c * y) as cy from z),
d as (select *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) as det from s)
select 'num__precio_base_log' as variable,
  round((ay * (bb * cc - bc * bc) - ab * (by_ * cc - bc * cy) + ac * (by_ * bc - bb * cy)) / det, 7) as coeficiente from d
union all select 'num__duracion_dias_prevista',
  round((aa * (by_ * cc - bc * cy) - ay * (ab * cc - bc * ac) + ac * (ab * cy - by_ * ac)) / det, 7) from d
union all select 'num__proveedores_unicos_con',
  round((aa * (bb * cy - by_ * bc) - ab * (ab * cy - by_ * ac) + ay * (ab * bc - bb * ac)) / det, 7) from d
"""


def _numeric_fit(spark: SparkSession, sf_dir: str, kind: str, alpha: float) -> DataFrame:
    train, _ = R.hash_split(_prepared(spark, sf_dir))
    model = R.fit_model(train, kind, alpha, categorical=[])
    table = R.coefficient_table(spark, model).select("variable", "coeficiente")
    return rounded(table, {"coeficiente": 7})


@_query(with_clean(_PREPARED_SQL + _MOMENTS_SQL.format(alpha="1.0e0")))
def ridge_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numeric_fit(spark, sf_dir, "ridge", 1.0)


@_query(with_clean(_PREPARED_SQL + _MOMENTS_SQL.format(alpha="5000.0e0")))
def ridge_coefficients_strong(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numeric_fit(spark, sf_dir, "ridge", 5000.0)


@_query(with_clean(_PREPARED_SQL + _MOMENTS_SQL.format(alpha="0.0e0")))
def ols_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numeric_fit(spark, sf_dir, "linear", 0.0)


_METRICS_SQL = """
select round(1 - sum(power(label - prediction, 2)) / (var_pop(label) * count(*)), 6) as r2_log,
  round(avg(abs(label - prediction)), 6) as mae_log,
  round(sqrt(avg(power(label - prediction, 2))), 6) as rmse_log,
  round(1 - sum(power(real - predicho, 2)) / (var_pop(real) * count(*)), 6) as r2_real,
  round(avg(abs(real - predicho)), 3) as mae_real,
  round(avg(abs(real - predicho)) / 1e6, 6) as mae_millones_cop,
  round(avg(abs((real - predicho) / real)) filter (real > 0) * 100, 6) as mape_real,
  count(*) as n_test
from pred
"""


METRICS_DIGITS = {
    "r2_log": 6, "mae_log": 6, "rmse_log": 6, "r2_real": 6, "mae_real": 3,
    "mae_millones_cop": 6, "mape_real": 6,
}


@_query(with_predictions(_METRICS_SQL))
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(R.regression_metrics(_predictions(spark, sf_dir)), METRICS_DIGITS)


@_query(with_clean("""
select modalidad_de_contratacion, round(coalesce(avg(abs(
  (valor_total_adjudicacion - precio_base) / valor_total_adjudicacion))
  filter (valor_total_adjudicacion > 0) * 100, 0), 6) as mape
from clean group by 1
"""))
def mape(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = clean_table(spark, sf_dir)
    return clean.groupBy(S.MODALITY).agg(F.round(R.mape_percent(S.AWARD, S.PRICE), 6).alias("mape"))


@_query(with_predictions("""
select id_del_portafolio, round(label, 8) as label, round(prediction, 8) as prediction,
  abs(label - prediction) <= 0.1e0 as en_banda from logs
"""))
def prediction_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = charts.prediction_points(_predictions(spark, sf_dir))
    return rounded(points.drop("real", "predicho"), {"label": 8, "prediction": 8})


@_query(with_predictions("""
select count(*) as n, round(least(min(label), min(prediction))
    - 0.05e0 * (greatest(max(label), max(prediction)) - least(min(label), min(prediction))), 6) as eje_min,
  round(greatest(max(label), max(prediction))
    + 0.05e0 * (greatest(max(label), max(prediction)) - least(min(label), min(prediction))), 6) as eje_max,
  count(*) filter (abs(label - prediction) <= 0.1e0) as en_banda,
  round(count(*) filter (abs(label - prediction) <= 0.1e0) / count(*) * 100, 6) as pct_en_banda
from logs
"""))
def prediction_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(charts.prediction_axis(_predictions(spark, sf_dir)), {
        "eje_min": 6, "eje_max": 6, "pct_en_banda": 6,
    })


_ERRORS_SQL = """
, xs as (select greatest(-30.0e0, least(30.0e0, (predicho - real) / real * 100)) as x from pred),
"""


@_query(with_predictions(_ERRORS_SQL + """
axis as (select min(x) as low, max(x) as high, 35 as bins from xs),
edges as (select unnest(range(35)) as bin, low, (high - low) / bins as width from axis),
counted as (select least(cast(floor((x - low) * bins / (high - low)) as bigint), bins - 1) as bin,
  count(*) as n from xs, axis group by 1)
select bin, round(low + bin * width, 5) as desde, round(low + (bin + 1) * width, 5) as hasta,
  coalesce(n, 0) as n from edges left join counted using (bin)
"""))
def error_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(charts.error_histogram(_predictions(spark, sf_dir)), {"desde": 5, "hasta": 5})


@_query(with_predictions(_ERRORS_SQL + """
m as (select count(x) as n, stddev_samp(x) * power(count(x), -0.2e0) as bw, min(x) as low, max(x) as high from xs),
grid as (select punto, n, bw, low + punto * ((high - low) / 199) as g
  from m, (select unnest(range(200)) as punto))
select cast(punto as int) as punto, round(any_value(g), 6) as x,
  round(sum(exp(-0.5e0 * power((g - x) / bw, 2))) / (any_value(n) * any_value(bw) * sqrt(2 * pi())), 8) as densidad
from grid, xs group by punto
"""))
def error_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(charts.error_density(_predictions(spark, sf_dir)), {"x": 6, "densidad": 8})


def _risk_sql(limit: str) -> str:
    return f"""
select id_del_portafolio, round((real - predicho) / 1e6, 6) + 0 as residuo_millones,
  case when (real - predicho) / 1e6 > {limit} then 'Alerta Alta (Sobreprecio)'
    when (real - predicho) / 1e6 < -{limit} then 'Alerta Media (Descuento Anormal)'
    else 'Normal (Alineado)' end as alerta
from pred
"""


def _alerts(table: DataFrame) -> DataFrame:
    return rounded(table.select(S.ID, "residuo_millones", "alerta"), {"residuo_millones": 6})


@_query(with_predictions(_risk_sql("0.05e0")))
def risk_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts(charts.risk_alerts(_predictions(spark, sf_dir), threshold=0.05))


@_query(with_predictions(_risk_sql("(select 2 * avg(abs(real - predicho)) / 1e6 from pred)")))
def risk_alerts_by_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts(charts.risk_alerts_by_error(_predictions(spark, sf_dir)))


@_query(with_predictions("select greatest(quantile_cont(predicho / 1e6, 0.98), 5000.0e0) as eje_max from pred"))
def risk_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charts.risk_axis(_predictions(spark, sf_dir))


@_query(with_clean(_PREPARED_SQL + """
select distinct 'cat__modalidad_de_contratacion_' || modalidad_de_contratacion as variable,
  'Modalidad: ' || modalidad_de_contratacion as etiqueta from prepared
"""))
def feature_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = _prepared(spark, sf_dir).select(S.MODALITY).distinct()
    name = F.concat(F.lit(f"cat__{S.MODALITY}_"), F.col(S.MODALITY))
    return kinds.select(name.alias("variable"), feature_label(name).alias("etiqueta"))


# The whole model in SQL: scaled numbers and 0/1 columns for all modalities but the
# first, centred, and the penalised normal equations solved by elimination.
_MODEL_SQL = _PREPARED_SQL + """
, scales as (
  select avg(precio_base_log) as m1, stddev_pop(precio_base_log) as s1,
    avg(duracion_dias_prevista) as m2, stddev_pop(duracion_dias_prevista) as s2,
    avg(proveedores_unicos_con) as m3, stddev_pop(proveedores_unicos_con) as s3,
    avg(label) as my, list_sort(list(distinct modalidad_de_contratacion))[2:] as kinds
  from prepared where not de_prueba),
encoded as (
  select id_del_portafolio, label, de_prueba, my, kinds, list_concat(
    [(precio_base_log - m1) / s1, (duracion_dias_prevista - m2) / s2, (proveedores_unicos_con - m3) / s3],
    list_transform(kinds, lambda k: cast(cast(k = modalidad_de_contratacion as int) as double))) as x
  from prepared, scales),
centre as (
  select i, avg(x[i]) as m from encoded, (select unnest(range(1, len(kinds) + 4)) as i from scales)
  where not de_prueba group by i),
means as (select list(m order by i) as m from centre),
moved as (
  select label - my as y, list_transform(range(1, len(x) + 1), lambda i: x[i] - m[i]) as x
  from encoded, means where not de_prueba),
cells as (
  select i, j, sum(x[i] * (case when j <= len(x) then x[j] else y end))
    + (case when i = j then 1.0e0 else 0.0e0 end) as v
  from moved, (select unnest(range(1, len(m) + 1)) as i from means),
    (select unnest(range(1, len(m) + 2)) as j from means)
  group by i, j),
equations as (
  select list(line order by i) as a from (select i, list(v order by j) as line from cells group by i)),
solved as (
  with recursive elimination as (
    select 1 as k, a from equations
    union all
    select k + 1, list_transform(range(1, len(a) + 1), lambda i: list_transform(range(1, len(a) + 2),
      lambda j: case when i = k then a[k][j] / a[k][k] else a[i][j] - a[i][k] * a[k][j] / a[k][k] end))
    from elimination where k <= len(a))
  select list_transform(a, lambda line: line[len(a) + 1]) as w from elimination where k = len(a) + 1),
coefficients as (
  select unnest(list_concat(
      ['num__precio_base_log', 'num__duracion_dias_prevista', 'num__proveedores_unicos_con'],
      list_transform(kinds, lambda k: 'cat__modalidad_de_contratacion_' || k))) as variable,
    unnest(list_concat(
      ['Precio Base [log1p]', 'Duración Prevista (Días)', 'Concurrencia Oferentes (N°)'],
      list_transform(kinds, lambda k: 'Modalidad: ' || k))) as variable_limpia,
    unnest(w) as coeficiente
  from solved, scales),
logs as (
  select id_del_portafolio, label,
    my + list_sum(list_transform(range(1, len(x) + 1), lambda i: w[i] * (x[i] - m[i]))) as prediction
  from encoded, means, solved where de_prueba),
pred as (select *, exp(label) - 1 as real, exp(prediction) - 1 as predicho from logs)
"""


def _stage3(spark: SparkSession, sf_dir: str):
    return run_stage3(clean_table(spark, sf_dir), f"{shared_folder(spark)}/model")


@_query(with_clean(_MODEL_SQL + _METRICS_SQL.replace(
    "count(*) as n_test", "count(*) as n_test, (select count(*) from prepared where not de_prueba) as n_train"
)))
def stage3_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_stage3(spark, sf_dir).metrics, METRICS_DIGITS)


@_query(with_clean(_MODEL_SQL + """
select variable, variable_limpia, round(coeficiente, 7) + 0 as coeficiente,
  case when coeficiente > 0 then 'Positivo (Incrementa Monto)' else 'Negativo (Disminuye Monto)' end as direccion,
  round(abs(coeficiente), 7) as magnitud
from coefficients
"""))
def coefficient_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_stage3(spark, sf_dir).coefficients, {"coeficiente": 7, "magnitud": 7})


@_query(with_clean(_MODEL_SQL + """
select variable_limpia, round(coeficiente, 7) + 0 as coeficiente,
  case when coeficiente < 0 then 'negativo' else 'positivo' end as signo
from coefficients
"""))
def coefficient_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_stage3(spark, sf_dir).charts["coefficient_bars"], {"coeficiente": 7})


@_query(with_clean(_MODEL_SQL + """
select id_del_portafolio, round(prediction, 6) as prediction,
  round(label - prediction, 6) + 0 as residuo_log, round(real - predicho, 2) + 0 as residuo_real from pred
"""))
def saved_model_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stage3(spark, sf_dir).model_path
    _, test = R.hash_split(_prepared(spark, sf_dir))
    scored = R.predict(R.load_model(stored), test)
    columns = [S.ID, "prediction", "residuo_log", "residuo_real"]
    return rounded(scored.select(*columns), {"prediction": 6, "residuo_log": 6, "residuo_real": 2})
