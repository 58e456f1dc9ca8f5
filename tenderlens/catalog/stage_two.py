"""Queries for the descriptive statistics, the outliers and the chart tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlens import functions as fn
from tenderlens import schema as S
from tenderlens.catalog.registry import Registry
from tenderlens.catalog.views import clean_table, rounded, table, with_clean
from tenderlens.operators import charts, describe, grouped, outliers
from tenderlens.operators.quantiles import exact_quantiles
from tenderlens.plans import stage2

QUERIES = Registry()
_query = QUERIES.query


def _each(columns, select: str) -> str:
    return " union all ".join(select.format(c=c) for c in columns)


_SKEW_SQL = """case when skewness({c}) > 0.5 then 'Asimetría Positiva (Sesgo a la derecha)'
  when skewness({c}) < -0.5 then 'Asimetría Negativa (Sesgo a la izquierda)'
  else 'Aproximadamente Simétrica' end"""
_MODE_SQL = "(select {c} from clean where {c} is not null group by {c} order by count(*) desc, {c} limit 1)"


@_query(with_clean(_each(S.STATISTICS_COLUMNS, f"""
select '{{c}}' as variable, round(avg({{c}}), 4) as media, round(median({{c}}), 4) as mediana,
  round({_MODE_SQL}, 6) as moda, round(skewness({{c}}), 6) as skewness,
  round((avg({{c}}) - median({{c}})) / abs(median({{c}})) * 100, 6) as divergencia_media_vs_mediana_pct,
  {_SKEW_SQL} as interpretacion_sesgo
from clean
""")))
def central_tendency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(describe.central_tendency(clean_table(spark, sf_dir)), {
        "media": 4, "mediana": 4, "moda": 6, "skewness": 6, "divergencia_media_vs_mediana_pct": 6,
    })


@_query(with_clean(_each([S.AWARD, S.DURATION_DAYS, S.BIDDERS], f"""
select '{{c}}' as variable, round({_MODE_SQL}, 6) as moda
""")))
def mode_smallest(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [S.AWARD, S.DURATION_DAYS, S.BIDDERS]
    counts = describe.value_counts(clean_table(spark, sf_dir), columns)
    return rounded(describe.smallest_mode(counts), {"moda": 6})


_PRICES = ["l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_suppkey"]


@_query(_each(_PRICES, """
select '{c}' as variable,
  cast((select {c} from lineitem where {c} is not null group by {c} order by count(*) desc, {c} limit 1) as double) as moda
"""))
def modes_by_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.exact_modes(table(spark, sf_dir, "lineitem"), _PRICES)


@_query("""
select event_type, count(value) as n, round(skewness(value), 6) as skewness from events group by event_type
""")
def skewness_adjusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    skewness = describe.adjusted_skewness(
        F.count("value"), F.skewness("value"), F.min("value"), F.max("value")
    )
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count("value").alias("n"), F.round(skewness, 6).alias("skewness")
    )


DISPERSION_DIGITS = {
    "desviacion_estandar": 3, "varianza": -2, "min": 6, "max": 6, "rango": 4, "q1": 4, "q3": 4,
    "iqr": 4, "coeficiente_variacion_pct": 6,
}


@_query(with_clean(_each(S.STATISTICS_COLUMNS, """
select '{c}' as variable, round(stddev_samp({c}), 3) as desviacion_estandar,
  round(var_samp({c}), -2) as varianza, round(min({c}), 6) as min, round(max({c}), 6) as max,
  round(max({c}) - min({c}), 4) as rango, round(quantile_cont({c}, 0.25), 4) as q1,
  round(quantile_cont({c}, 0.75), 4) as q3,
  round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 4) as iqr,
  round(stddev_samp({c}) / abs(avg({c})) * 100, 6) as coeficiente_variacion_pct
from clean
""")))
def dispersion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(describe.dispersion(clean_table(spark, sf_dir)), DISPERSION_DIGITS)


GROUP_DIGITS = {"media": 4, "mediana": 4, "std": 3, "q1": 4, "q3": 4, "iqr": 4, "porcentaje_contratos": 6}


def _group_sql(key: str, value: str, source: str, mean_digits: int = 4) -> str:
    return f"""
select {key}, count({value}) as conteo, round(avg({value}), {mean_digits}) as media,
  round(median({value}), 4) as mediana, round(stddev_samp({value}), 3) as std,
  round(quantile_cont({value}, 0.25), 4) as q1, round(quantile_cont({value}, 0.75), 4) as q3,
  round(quantile_cont({value}, 0.75) - quantile_cont({value}, 0.25), 4) as iqr,
  round(count({value}) / (select count(*) from {source}) * 100, 6) as porcentaje_contratos
from {source} where {key} is not null group by {key}
"""


@_query(with_clean(_group_sql(S.MODALITY, S.AWARD, "clean")))
def dispersion_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(grouped.dispersion_by_group(clean_table(spark, sf_dir)), GROUP_DIGITS)


@_query(_group_sql("l_shipdate", "l_extendedprice", "lineitem", mean_digits=8))
def dispersion_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    by_date = grouped.dispersion_by_group(lines, "l_extendedprice", "l_shipdate", method="narrow")
    return rounded(by_date, {**GROUP_DIGITS, "media": 8})


@_query("""
select event_type, round(quantile_cont(value, 0.01), 6) as p01, round(median(value), 6) as p50,
  round(quantile_cont(value, 0.9), 6) as p90 from events group by event_type
""")
def quantiles_by_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = {"p01": 0.01, "p50": 0.5, "p90": 0.9}
    events = table(spark, sf_dir, "events")
    found = exact_quantiles(events, F.col("value"), points, ["event_type"], method="narrow")
    return rounded(found, dict.fromkeys(points, 6))


_BAND_SQL = """case when proveedores_unicos_con is null or proveedores_unicos_con <= 1 then 1
  when proveedores_unicos_con between 2 and 3 then 2
  when proveedores_unicos_con between 4 and 9 then 3 else 4 end"""
_LABELS_SQL = "[" + ", ".join(f"'{label}'" for label in fn.BAND_LABELS) + "]"


@_query(with_clean(f"""
select id_del_portafolio, proveedores_unicos_con, ({_LABELS_SQL})[{_BAND_SQL}] as rango_competencia from clean
"""))
def competition_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    bidders = F.col(S.BIDDERS)
    return clean_table(spark, sf_dir).select(
        S.ID, bidders, fn.competition_band(bidders).alias("rango_competencia")
    )


@_query(with_clean(f"""
select {_BAND_SQL} as banda_orden, ({_LABELS_SQL})[{_BAND_SQL}] as rango_competencia,
  count(id_del_portafolio) as total_contratos,
  round(median(valor_total_adjudicacion), 4) as mediana_valor_adjudicado,
  round(avg(valor_total_adjudicacion), 4) as media_valor_adjudicado,
  round(avg(tiene_sobrecosto) * 100, 6) as tasa_sobrecosto_pct,
  median(duracion_dias_prevista) as mediana_duracion_dias,
  round(count(id_del_portafolio) / (select count(*) from clean) * 100, 6) as porcentaje_del_total
from clean group by all
"""))
def competition_contrast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(grouped.competition_contrast(clean_table(spark, sf_dir)), {
        "mediana_valor_adjudicado": 4, "media_valor_adjudicado": 4, "tasa_sobrecosto_pct": 6,
        "porcentaje_del_total": 6,
    })


def _bounds_sql(value: str, source: str) -> str:
    return f"""
select quantile_cont({value}, 0.25) as q1, quantile_cont({value}, 0.75) as q3,
  quantile_cont({value}, 0.75) - quantile_cont({value}, 0.25) as iqr,
  quantile_cont({value}, 0.25) - 1.5e0 * (quantile_cont({value}, 0.75) - quantile_cont({value}, 0.25))
    as limite_inferior,
  quantile_cont({value}, 0.75) + 1.5e0 * (quantile_cont({value}, 0.75) - quantile_cont({value}, 0.25))
    as limite_superior
from {source}
"""


_FENCES = ["q1", "q3", "iqr", "limite_inferior", "limite_superior"]
_ROUNDED_FENCES = ", ".join(f"round({c}, 4) as {c}" for c in _FENCES)


@_query(f"select {_ROUNDED_FENCES} from ({_bounds_sql('value', 'events')})")
def tukey_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = outliers.tukey_bounds(table(spark, sf_dir, "events"), "value", method="narrow")
    return rounded(bounds, dict.fromkeys(_FENCES, 4))


@_query(with_clean(f"""
select id_del_portafolio, valor_total_adjudicacion > limite_superior as atipico_superior,
  valor_total_adjudicacion < limite_inferior as atipico_inferior,
  valor_total_adjudicacion > limite_superior or valor_total_adjudicacion < limite_inferior as atipico
from clean, ({_bounds_sql(S.AWARD, 'clean')})
"""))
def tukey_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = outliers.tukey_flags(clean_table(spark, sf_dir), S.AWARD)
    return flags.select(S.ID, "atipico_superior", "atipico_inferior", "atipico")


def _summary_sql(value: str, source: str) -> str:
    return f"""
select {_ROUNDED_FENCES}, count({value}) as total_validos,
  count(*) filter ({value} > limite_superior or {value} < limite_inferior) as conteo_outliers,
  count(*) filter ({value} > limite_superior) as conteo_outliers_superiores,
  count(*) filter ({value} < limite_inferior) as conteo_outliers_inferiores,
  round(count(*) filter ({value} > limite_superior or {value} < limite_inferior)
    / count({value}) * 100, 6) as porcentaje_outliers
from {source}, ({_bounds_sql(value, source)}) group by q1, q3, iqr, limite_inferior, limite_superior
"""


_SUMMARY_DIGITS = {**dict.fromkeys(_FENCES, 4), "porcentaje_outliers": 6}


@_query(with_clean(_summary_sql(S.AWARD, "clean")))
def tukey_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(outliers.tukey_summary(clean_table(spark, sf_dir), S.AWARD), _SUMMARY_DIGITS)


@_query(_summary_sql("value", "events"))
def tukey_summary_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return rounded(outliers.tukey_summary(events, "value", method="narrow"), _SUMMARY_DIGITS)


def _top_sql(value: str) -> str:
    return with_clean(f"""
select {', '.join(outliers.INFO_COLUMNS)}
from clean, ({_bounds_sql(value, 'clean')}) where {value} > limite_superior
order by {value} desc, id_del_portafolio limit 10
""")


@_query(_top_sql(S.AWARD))
def top_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.top_outliers(clean_table(spark, sf_dir), S.AWARD)


@_query(_top_sql(S.DURATION_DAYS))
def top_outliers_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.top_outliers(clean_table(spark, sf_dir), S.DURATION_DAYS)


def _histogram_sql(values: str, bins: str, log: bool) -> str:
    """Bins over the column ``x`` of ``values``."""
    edge = "round(power(10, {}), 4)" if log else "round({}, 6)"
    return f"""
xs as ({values}),
axis as (select min(x) as low, max(x) as high, cast({bins} as bigint) as bins from xs),
edges as (select unnest(range(bins)) as bin, low, (high - low) / bins as width from axis),
counted as (select least(cast(floor((x - low) * bins / (high - low)) as bigint), bins - 1) as bin,
  count(*) as n from xs, axis group by 1)
select bin, {edge.format('low + bin * width')} as desde, {edge.format('low + (bin + 1) * width')} as hasta,
  coalesce(n, 0) as n from edges left join counted using (bin)
"""


_LOG_AWARD = "select log10(valor_total_adjudicacion) as x from clean where valor_total_adjudicacion > 0"


@_query(with_clean("," + _histogram_sql(_LOG_AWARD, "20", True)))
def log_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(charts.log_histogram(clean_table(spark, sf_dir), bins=20), {"desde": 4, "hasta": 4})


_AUTO_BINS = """ceil((max(x) - min(x)) / least(greatest(
  2 * (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) * power(count(x), -1.0e0 / 3),
  (max(x) - min(x)) / sqrt(count(x)) / 2), (max(x) - min(x)) / (log2(count(x)) + 1)))"""


@_query(with_clean("," + _histogram_sql(_LOG_AWARD, _AUTO_BINS, True)))
def log_histogram_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(charts.log_histogram(clean_table(spark, sf_dir)), {"desde": 4, "hasta": 4})


def _density_sql(values: str, cut: float) -> str:
    return f"""
xs as ({values}),
m as (select count(x) as n, stddev_samp(x) * power(count(x), -0.2e0) as bw, min(x) as low, max(x) as high from xs),
grid as (select punto, n, bw, low - {cut}e0 * bw + punto * ((high - low + 2 * {cut}e0 * bw) / 199) as g
  from m, (select unnest(range(200)) as punto))
select cast(punto as int) as punto, round(any_value(g), 6) as x,
  round(sum(exp(-0.5e0 * power((g - x) / bw, 2))) / (any_value(n) * any_value(bw) * sqrt(2 * pi())), 8) as densidad
from grid, xs group by punto
"""


_DENSITY_DIGITS = {"x": 6, "densidad": 8}


@_query(with_clean("," + _density_sql(_LOG_AWARD, 3.0)))
def kde_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(charts.density_curve(clean_table(spark, sf_dir)), _DENSITY_DIGITS)


@_query(with_clean("," + _density_sql("select log10(precio_base) as x from clean where precio_base > 0", 3.0)))
def kde_log_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(charts.density_curve(clean_table(spark, sf_dir), S.PRICE), _DENSITY_DIGITS)


_BINNED_SQL = f"""
xs as ({_LOG_AWARD}),
m as (select count(x) as n, stddev_samp(x) * power(count(x), -0.2e0) as bw, min(x) as low, max(x) as high from xs),
w as (select *, sqrt(power(bw, 3) * 8 * sqrt(2 * pi()) * 1e-6) as cell from m),
places as (select (x - low) / cell as p from xs, w),
cells as (select floor(p) as c, sum(1 - (p - floor(p))) as l, sum(p - floor(p)) as r from places group by 1),
nodes as (select low + c * cell as x, l as weight from cells, w union all select low + (c + 1) * cell, r from cells, w),
grid as (select punto, n, bw, low - 3e0 * bw + punto * ((high - low + 6e0 * bw) / 199) as g
  from w, (select unnest(range(200)) as punto))
select cast(punto as int) as punto, round(any_value(g), 6) as x,
  round(sum(weight * exp(-0.5e0 * power((g - x) / bw, 2))) / (any_value(n) * any_value(bw) * sqrt(2 * pi())), 8)
    as densidad
from grid, nodes group by punto
"""


@_query(with_clean("," + _BINNED_SQL))
def kde_log_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(charts.density_curve(clean_table(spark, sf_dir), binned=True), _DENSITY_DIGITS)


@_query(with_clean("""
select round(avg(valor_total_adjudicacion), 4) as media,
  round(median(valor_total_adjudicacion), 4) as mediana from clean
"""))
def reference_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(charts.reference_lines(clean_table(spark, sf_dir)), {"media": 4, "mediana": 4})


_BOXES_SQL = """
, quartiles as (
  select modalidad_de_contratacion as k, quantile_cont(valor_total_adjudicacion, 0.25) as q1,
    median(valor_total_adjudicacion) as mediana, quantile_cont(valor_total_adjudicacion, 0.75) as q3
  from clean where modalidad_de_contratacion is not null group by 1),
boxed as (
  select *, valor_total_adjudicacion as v,
    v between q1 - 1.5e0 * (q3 - q1) and q3 + 1.5e0 * (q3 - q1) as inside
  from clean join quartiles on modalidad_de_contratacion = k)
"""


@_query(with_clean(_BOXES_SQL + """
select modalidad_de_contratacion, count(*) as n, round(avg(v), 4) as media, round(q1, 4) as q1,
  round(mediana, 4) as mediana, round(q3, 4) as q3,
  round(min(v) filter (inside), 4) as bigote_inferior, round(max(v) filter (inside), 4) as bigote_superior,
  count(*) filter (not inside) as atipicos
from boxed group by modalidad_de_contratacion, boxed.q1, boxed.mediana, boxed.q3
"""))
def boxplot_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = charts.boxplot_by_group(clean_table(spark, sf_dir))
    return rounded(boxes, dict.fromkeys(
        ["media", "q1", "mediana", "q3", "bigote_inferior", "bigote_superior"], 4
    ))


@_query(with_clean(_BOXES_SQL + """
select id_del_portafolio, modalidad_de_contratacion, valor_total_adjudicacion from boxed where not inside
"""))
def boxplot_fliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = clean_table(spark, sf_dir).select(S.ID, S.MODALITY, S.AWARD)
    return charts.boxplot_fliers(clean, method="narrow")


@_query(with_clean("""
select proveedores_unicos_con, valor_total_adjudicacion, tiene_sobrecosto,
  case tiene_sobrecosto when 0 then 'Sin Sobrecosto (Normal)' else 'Con Sobrecosto' end as serie from clean
"""))
def competition_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charts.competition_points(clean_table(spark, sf_dir))


@_query(with_clean("select tiene_sobrecosto, count(*) as contratos from clean group by 1"))
def competition_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charts.competition_series(clean_table(spark, sf_dir))


@_query(with_clean("""
select proveedores_unicos_con, cast(floor(log10(valor_total_adjudicacion) * 10) as bigint) as celda_log10,
  tiene_sobrecosto, count(*) as contratos from clean group by all
"""))
def competition_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charts.competition_grid(clean_table(spark, sf_dir))


@_query(with_clean("""
select proveedores_unicos_con, round(valor_total_adjudicacion / precio_base, 9) as ratio_adjudicacion,
  round(valor_total_adjudicacion / precio_base * 100, 9) as pct_adjudicado
from clean where valor_total_adjudicacion / precio_base > 0.4e0 and valor_total_adjudicacion / precio_base <= 1.2e0
"""))
def award_ratio_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = charts.award_ratio_points(clean_table(spark, sf_dir))
    return rounded(points, {"ratio_adjudicacion": 9, "pct_adjudicado": 9})


@_query(with_clean("""
select least(max(proveedores_unicos_con), 50.0e0) as eje_x_max from clean
where valor_total_adjudicacion / precio_base > 0.4e0 and valor_total_adjudicacion / precio_base <= 1.2e0
"""))
def award_ratio_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charts.award_ratio_axis(clean_table(spark, sf_dir))


@_query("""
select l_orderkey, l_linenumber, l_partkey,
  case when l_quantity = 3 then 'N/A' else format('${:,.2f}', l_extendedprice * l_quantity) end as monto
from lineitem
""")
def format_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.when(F.col("l_quantity") != 3, F.col("l_extendedprice") * F.col("l_quantity"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", fn.money_text(amount).alias("monto")
    )


def _compact_sql(value: str, decimals: int, size: str) -> str:
    return f"""case when {size} >= 1e12 then format('${{:.1f}}T', {value} / 1e12)
  when {size} >= 1e9 then format('${{:.1f}}B', {value} / 1e9)
  when {size} >= 1e6 then format('${{:.{decimals}f}}M', {value} / 1e6)
  when {size} >= 1e3 then format('${{:.0f}}K', {value} / 1e3) else format('${{:.0f}}', {value}) end"""


_SPREAD_SQL = "(l_extendedprice - 30000) * power(10, l_linenumber)"


@_query(f"""
select l_orderkey, l_linenumber, l_partkey, {_compact_sql(_SPREAD_SQL, 0, _SPREAD_SQL)} as eje,
  {_compact_sql(_SPREAD_SQL, 1, f'abs({_SPREAD_SQL})')} as resumen
from lineitem
""")
def format_compact_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = (F.col("l_extendedprice") - 30000) * F.pow(F.lit(10.0), "l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", fn.compact_money(amount).alias("eje"),
        fn.compact_money(amount, million_decimals=1, signed=True).alias("resumen"),
    )


def _amount_text_sql(value: str, c: str) -> str:
    return f"format('{{:,.1f}} días', {value})" if c == S.DURATION_DAYS else f"format('${{:,.2f}}', {value})"


@_query(with_clean(" union all ".join(f"""
select '{c}' as variable, {_amount_text_sql(f'avg({c})', c)} as media,
  {_amount_text_sql(f'median({c})', c)} as mediana,
  {_amount_text_sql(_MODE_SQL.format(c=c), c)} as moda, format('{{:,.4f}}', skewness({c})) as skewness,
  case when avg({c}) >= median({c}) then '+' else '' end
    || format('{{:,.2f}}%', (avg({c}) - median({c})) / abs(median({c})) * 100) as divergencia_media_vs_mediana_pct,
  {_SKEW_SQL.format(c=c)} as interpretacion_sesgo
from clean
""" for c in S.STATISTICS_COLUMNS)))
def central_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage2.central_report(describe.central_tendency(clean_table(spark, sf_dir)))


@_query(with_clean("""
select modalidad_de_contratacion, count(*) as conteo,
  format('{:.2f}%', count(*) / (select count(*) from clean) * 100) as porcentaje_contratos,
  format('${:,.2f}', median(valor_total_adjudicacion)) as mediana,
  format('${:,.2f}', quantile_cont(valor_total_adjudicacion, 0.75) - quantile_cont(valor_total_adjudicacion, 0.25)) as iqr,
  format('${:,.2f}', avg(valor_total_adjudicacion)) as media,
  format('${:,.2f}', stddev_samp(valor_total_adjudicacion)) as std
from clean where modalidad_de_contratacion is not null group by 1
"""))
def modality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage2.modality_report(grouped.dispersion_by_group(clean_table(spark, sf_dir)))


def _spread_report_sql(c: str) -> str:
    quartiles = [f"quantile_cont({c}, 0.25)", f"quantile_cont({c}, 0.75)"]
    shown = {
        "desviacion_estandar": f"stddev_samp({c})", "q1": quartiles[0], "q3": quartiles[1],
        "iqr": f"{quartiles[1]} - {quartiles[0]}", "rango": f"max({c}) - min({c})",
    }
    texts = ", ".join(f"{_amount_text_sql(value, c)} as {name}" for name, value in shown.items())
    return f"""
select '{c}' as variable, {texts},
  format('{{:,.2f}}%', stddev_samp({c}) / abs(avg({c})) * 100) as coeficiente_variacion_pct from clean
"""


@_query(with_clean(" union all ".join(_spread_report_sql(c) for c in S.STATISTICS_COLUMNS)))
def dispersion_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage2.dispersion_report(describe.dispersion(clean_table(spark, sf_dir)))


@_query(with_clean(f"""
select ({_LABELS_SQL})[{_BAND_SQL}] as rango_competencia, count(id_del_portafolio) as total_contratos,
  format('{{:.2f}}%', count(id_del_portafolio) / (select count(*) from clean) * 100) as porcentaje_del_total,
  format('${{:,.2f}}', median(valor_total_adjudicacion)) as mediana_valor_adjudicado,
  format('{{:.2f}}%', avg(tiene_sobrecosto) * 100) as tasa_sobrecosto_pct,
  median(duracion_dias_prevista) as mediana_duracion_dias
from clean group by all
"""))
def competition_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage2.competition_report(grouped.competition_contrast(clean_table(spark, sf_dir)))


# Table of the stage, query whose SQL states it, key columns, and digits of its rounded columns.
_STAGE2_TABLES = {
    "central": ("central_tendency", ["variable"], {
        "media": 4, "mediana": 4, "moda": 6, "skewness": 6, "divergencia_media_vs_mediana_pct": 6}),
    "dispersion": ("dispersion", ["variable"], DISPERSION_DIGITS),
    "by_modality": ("dispersion_by_group", [S.MODALITY], GROUP_DIGITS),
    "tukey_award": ("tukey_summary", [], _SUMMARY_DIGITS),
    "tukey_days": (with_clean(_summary_sql(S.DURATION_DAYS, "clean")), [], _SUMMARY_DIGITS),
    "top_award": ("top_outliers", [S.ID], {}),
    "top_days": ("top_outliers_duration", [S.ID], {}),
    "competition": ("competition_contrast", ["banda_orden"], {
        "mediana_valor_adjudicado": 4, "media_valor_adjudicado": 4, "tasa_sobrecosto_pct": 6, "porcentaje_del_total": 6}),
    "award_histogram": ("log_histogram_auto", ["bin"], {"desde": 4, "hasta": 4}),
    "award_density": (with_clean("," + _density_sql(_LOG_AWARD, 0.0)), ["punto"], _DENSITY_DIGITS),
    "award_lines": ("reference_lines", [], {"media": 4, "mediana": 4}),
    "boxes": ("boxplot_by_group", [S.MODALITY], dict.fromkeys(
        ["media", "q1", "mediana", "q3", "bigote_inferior", "bigote_superior"], 4)),
    "competition_points": ("competition_scatter", [], {}),
    "competition_grid": ("competition_grid", [S.BIDDERS, "celda_log10", S.OVERCOST_FLAG], {}),
}
# Columns of the tables that hold texts; all others are numbers.
_STAGE2_TEXTS = {
    "variable", "interpretacion_sesgo", S.MODALITY, S.ID, S.REFERENCE, S.ENTITY, S.CITY, "rango_competencia", "serie"}
_STAGE2_COLUMNS = {
    "central": ["media", "mediana", "moda", "skewness", "divergencia_media_vs_mediana_pct", "interpretacion_sesgo"],
    "dispersion": list(DISPERSION_DIGITS),
    "by_modality": ["conteo", *GROUP_DIGITS],
    "tukey_award": [*_FENCES, "total_validos", "conteo_outliers", "conteo_outliers_superiores",
                    "conteo_outliers_inferiores", "porcentaje_outliers"],
    "top_award": [c for c in outliers.INFO_COLUMNS if c != S.ID],
    "competition": ["rango_competencia", "total_contratos", "mediana_valor_adjudicado", "media_valor_adjudicado",
                    "tasa_sobrecosto_pct", "mediana_duracion_dias", "porcentaje_del_total"],
    "award_histogram": ["desde", "hasta", "n"],
    "award_density": ["x", "densidad"],
    "award_lines": ["media", "mediana"],
    "boxes": ["n", "media", "q1", "mediana", "q3", "bigote_inferior", "bigote_superior", "atipicos"],
    "competition_points": [S.BIDDERS, S.AWARD, S.OVERCOST_FLAG, "serie"],
    "competition_grid": ["contratos"],
}
_STAGE2_COLUMNS |= {"tukey_days": _STAGE2_COLUMNS["tukey_award"], "top_days": _STAGE2_COLUMNS["top_award"]}


def _long_sql(name: str) -> str:
    """Every value of a table of stage 2 as a row of its own."""
    source, keys, _ = _STAGE2_TABLES[name]
    sql = QUERIES[source][1] if source in QUERIES else source
    key = " || '|' || ".join(f"coalesce(cast({k} as varchar), '')" if k in _STAGE2_TEXTS else
                             f"coalesce(cast(cast({k} as bigint) as varchar), '')" for k in keys) or "''"
    columns = _STAGE2_COLUMNS[name]
    cells = ", ".join(
        f"struct_pack(medida := '{c}', valor := {'null::double' if c in _STAGE2_TEXTS else f'{c}::double'}, "
        f"texto := {f'{c}::varchar' if c in _STAGE2_TEXTS else 'null::varchar'})" for c in columns)
    return (f"select '{name}' as tabla, {key} as clave, unnest([{cells}], recursive := true) "
            f"from ({sql})")


def _long(name: str, rows: DataFrame) -> DataFrame:
    _, keys, digits = _STAGE2_TABLES[name]
    key = F.concat_ws("|", *[
        F.coalesce(F.col(k) if k in _STAGE2_TEXTS else F.col(k).cast("bigint").cast("string"), F.lit("")) for k in keys
    ]) if keys else F.lit("")
    cells = F.array(*[F.struct(
        F.lit(c).alias("medida"),
        (F.lit(None) if c in _STAGE2_TEXTS else F.col(c)).cast("double").alias("valor"),
        (F.col(c) if c in _STAGE2_TEXTS else F.lit(None)).cast("string").alias("texto"),
    ) for c in _STAGE2_COLUMNS[name]])
    return rounded(rows, digits).select(F.lit(name).alias("tabla"), key.alias("clave"), F.inline(cells))


@_query(" union all ".join(f"({_long_sql(name)})" for name in _STAGE2_TABLES))
def stage2_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = stage2.run_stage2(clean_table(spark, sf_dir))
    return reduce(DataFrame.unionAll, [_long(name, results[name]) for name in _STAGE2_TABLES])
