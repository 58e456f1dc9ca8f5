"""Queries for the extract, the cleaning and the quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlens import functions as fn
from tenderlens import schema as S
from tenderlens import sources
from tenderlens.catalog.registry import Registry
from tenderlens.catalog.views import (
    clean_table, clean_view, dedup_order, raw_contracts, rounded, table, with_clean, with_raw,
)
from tenderlens.operators import cleaning, features, quality
from tenderlens.plans import run_stage1

_RAW = ", ".join(S.RAW_COLUMNS)
_CLEAN = ", ".join(f.name for f in S.CLEAN_SCHEMA.fields)
_TOP = 10_000

# Landed CSV records of the first stage.  A compressed file is read by one task, hence many files; the fastest level
# takes a third of the usual one's time, for files a quarter larger.
LANDED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 50_000}

QUERIES = Registry()
_query = QUERIES.query


_NEWEST_SQL = f"""
  from raw where departamento_entidad = 'Cundinamarca' and tipo_de_contrato = 'Obra'
    and valor_total_adjudicacion > 0
  order by fecha_de_publicacion_del desc, id_del_portafolio, referencia_del_proceso, k_supp,
    duracion, k_ext, k_disc, k_tax
"""
_NEWEST_TIES = [S.ID, S.REFERENCE, "k_supp", S.DURATION, "k_ext", "k_disc", "k_tax"]


@_query(with_raw(f"select {_RAW} {_NEWEST_SQL} limit {_TOP}"))
def extract_filtered_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_contracts(spark, sf_dir)
    return sources.extract_contracts(raw, limit=_TOP, tie_break=_NEWEST_TIES)


@_query(with_raw(
    f"select entidad, precio_base, valor_total_adjudicacion, modalidad_de_contratacion {_NEWEST_SQL} limit 3"
))
def extract_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.preview(extract_filtered_topk(spark, sf_dir))


_TYPED_SQL = with_raw("""
  select id_del_portafolio, entidad, modalidad_de_contratacion, precio_base,
    valor_total_adjudicacion, fecha_de_publicacion_del from raw
""")
_TYPED = [S.ID, S.ENTITY, S.MODALITY, S.PRICE, S.AWARD, S.PUBLISHED]


def _typed(raw: DataFrame) -> DataFrame:
    return cleaning.parse_dates(cleaning.cast_money(raw)).select(*_TYPED)


@_query(_TYPED_SQL)
def scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sources.shared_folder(spark)}/json"
    # Compressed, as records repeat their keys; each task writes files of its own, so many tasks read them.
    raw = raw_contracts(spark, sf_dir).select(*S.RAW_COLUMNS)
    raw.write.option("maxRecordsPerFile", 500_000).json(path, compression="gzip")
    return _typed(sources.read_json_records(spark, path))


@_query(_TYPED_SQL)
def scan_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sources.shared_folder(spark)}/csv"
    sources.write_raw_csv(raw_contracts(spark, sf_dir).select(*S.RAW_COLUMNS), path)
    return _typed(sources.read_raw_csv(spark, path))


@_query(with_clean(f"select {_CLEAN} from clean"))
def clean_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sources.shared_folder(spark)}/clean"
    sources.write_clean(clean_view(spark, sf_dir), path)
    return sources.read_clean(spark, path)


@_query(with_clean(f"select {_CLEAN.replace('duracion,', 'cast(duracion as varchar) as duracion,', 1)} from clean"))
def clean_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sources.shared_folder(spark)}/clean_csv"
    sources.write_clean(clean_table(spark, sf_dir), path, "csv")
    return sources.read_clean(spark, path, "csv")


_MONEY_PARTS = """
  select l_orderkey, l_partkey, l_suppkey, l_linenumber,
    cast(round(l_extendedprice * 100) as bigint) + 100000 as c from lineitem
"""
_MONEY_SQL = f"""
with cents as ({_MONEY_PARTS}),
parts as (select *, cast(floor(c / 100) as bigint) as u from cents)
select l_orderkey, l_partkey, l_suppkey, l_linenumber,
  case l_linenumber when 1 then cast(u as double) when 2 then c / 100.0e0 when 3 then c / 100.0e0
    when 4 then c / 100.0e0 when 5 then c / 100.0e0 else null end as valor
from parts
"""


@_query(_MONEY_SQL)
def parse_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint") + 100000
    units, thousands = F.floor(F.col("c") / 100), F.floor(F.col("c") / 100000)
    rest = F.lpad((units % 1000).cast("string"), 3, "0")
    decimals = F.lpad((F.col("c") % 100).cast("string"), 2, "0")
    line = F.col("l_linenumber")
    text = (
        F.when(line == 1, F.concat(F.lit("$ "), thousands, F.lit(","), rest))
        .when(line == 2, F.concat(thousands, F.lit("."), rest, F.lit(","), decimals))
        .when(line == 3, F.concat(units, F.lit(","), decimals))
        .when(line == 4, F.concat(F.lit("  "), units, F.lit("."), decimals, F.lit(" ")))
        .when(line == 5, F.concat(thousands, F.lit(","), rest, F.lit("."), decimals))
        .when(line == 6, F.concat(F.lit("1."), thousands, F.lit("."), rest))
        .otherwise("N/D")
    )
    texts = table(spark, sf_dir, "lineitem").select(*keys, cents.alias("c")).select(*keys, text.alias("texto"))
    return texts.select(*keys, fn.parse_currency(F.col("texto")).alias("valor"))


@_query("""
select l_orderkey, l_partkey, l_suppkey, l_linenumber,
  case when l_linenumber <= 5 then l_shipdate end as fecha from lineitem
""")
def parse_iso_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, shipped = F.col("l_linenumber"), F.col("l_shipdate")
    text = (
        F.when(line == 1, F.date_format(shipped, "yyyy-MM-dd'T'HH:mm:ss.SSS"))
        .when(line == 2, F.date_format(shipped, "yyyy-MM-dd"))
        .when(line == 3, F.date_format(shipped, "yyyyMMdd"))
        .when(line == 4, F.date_format(shipped, "yyyy/MM/dd"))
        .when(line == 5, F.date_format(shipped, "yyyyMMdd'T'HHmmss"))
        .when(line == 6, F.date_format(shipped, "yyyy-13-dd"))
        .otherwise("sin fecha")
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", fn.parse_iso_date(text).alias("fecha")
    )


@_query(r"""
select doc_id, trim(regexp_replace(
  regexp_replace(strip_accents(lower(text)), '[^\x00-\x7F]', '', 'g'), '\s+', ' ', 'g')) as texto
from documents
""")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", fn.normalize_text(F.col("text")).alias("texto"))


@_query(with_raw("""
select id_del_portafolio, trim(entidad) as entidad, trim(departamento_entidad) as departamento_entidad,
  trim(ciudad_entidad) as ciudad_entidad, trim(modalidad_de_contratacion) as modalidad_de_contratacion,
  trim(tipo_de_contrato) as tipo_de_contrato, trim(estado_del_procedimiento) as estado_del_procedimiento,
  trim(unidad_de_duracion) as unidad_de_duracion
from raw
"""))
def trim_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_contracts(spark, sf_dir, [S.ID, *S.TEXT_COLUMNS])
    return cleaning.trim_categories(raw).select(S.ID, *S.TEXT_COLUMNS)


@_query(with_raw("""
select id_del_portafolio, precio_base, valor_total_adjudicacion from raw
where precio_base > 0 and valor_total_adjudicacion > 0
"""))
def valid_money_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_contracts(spark, sf_dir, [S.ID, S.PRICE, S.AWARD])
    return cleaning.valid_money_filter(raw).select(S.ID, S.PRICE, S.AWARD)


@_query(with_raw("""
select id_del_portafolio, referencia_del_proceso, duracion, fecha_de_publicacion_del from (
  select *, row_number() over (partition by id_del_portafolio order by fecha_de_publicacion_del desc,
    referencia_del_proceso, k_supp, duracion, k_ext, k_disc, k_tax) as rn from raw) t
where rn = 1
"""))
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [S.ID, S.REFERENCE, S.DURATION, S.PUBLISHED]
    raw = raw_contracts(spark, sf_dir, columns)
    return cleaning.dedup_keep_first(raw, S.ID, dedup_order()).select(*columns)


_REPORT_SQL = """
select count(*) as filas_iniciales,
  (select count(*) from clean) as filas_finales,
  count(*) - (select count(*) from valid) as filas_descartadas_precio_invalido,
  (select count(*) from valid) - (select count(*) from clean) as duplicados_eliminados,
  round((select count(*) from clean) / count(*) * 100, 2) as porcentaje_retencion
from raw
"""


@_query(with_clean(_REPORT_SQL))
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(raw_contracts(spark, sf_dir, [S.ID, S.PRICE, S.AWARD]))


@_query(with_clean(_REPORT_SQL))
def quality_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_contracts(spark, sf_dir, [S.PRICE, S.AWARD])
    return quality.quality_balance(raw, clean_table(spark, sf_dir))


def _per_column(select: str) -> str:
    return with_clean(" union all ".join(
        select.format(name=f.name, kind=f.dataType.simpleString() if f.name != S.DURATION else "double")
        for f in S.CLEAN_SCHEMA.fields
    ))


@_query(_per_column("select '{name}' as columna, count(*) - count({name}) as nulos from clean"))
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_counts(clean_table(spark, sf_dir))


@_query(_per_column("""
select '{name}' as columna, '{kind}' as dtype, count({name}) as no_nulos,
  count(*) - count({name}) as nulos, round((count(*) - count({name})) / count(*) * 100, 2) as pct_nulos
from clean
"""))
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.column_profile(clean_table(spark, sf_dir))


@_query(with_clean(f"select {_RAW} from clean"))
def clean_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_view(spark, sf_dir).select(*S.RAW_COLUMNS)


@_query(with_raw("""
select id_del_portafolio, valor_total_adjudicacion - precio_base as sobrecosto_pesos,
  case when precio_base > 0 then (valor_total_adjudicacion - precio_base) / precio_base else 0 end
    as ratio_sobrecosto,
  coalesce(cast(valor_total_adjudicacion - precio_base > 0 as int), 0) as tiene_sobrecosto
from raw
"""))
def overcost_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_contracts(spark, sf_dir, [S.ID, S.PRICE, S.AWARD])
    return features.add_overcost(raw).select(S.ID, S.OVERCOST, S.OVERCOST_RATIO, S.OVERCOST_FLAG)


@_query(with_raw("""
select id_del_portafolio, duracion, unidad_de_duracion,
  duracion * case unidad_de_duracion when 'Mes(es)' then 30 when 'Año(s)' then 365 else 1 end
    as duracion_dias_prevista
from raw
"""))
def duration_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_contracts(spark, sf_dir, [S.ID, S.DURATION, S.DURATION_UNIT])
    return features.add_duration_days(raw).select(S.ID, S.DURATION, S.DURATION_UNIT, S.DURATION_DAYS)


@_query(with_clean("""
select id_del_portafolio, sobrecosto_pesos, ratio_sobrecosto, tiene_sobrecosto,
  duracion_dias_prevista from clean
"""))
def contract_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    needed = [S.ID, S.REFERENCE, S.PRICE, S.AWARD, S.DURATION, S.DURATION_UNIT, S.PUBLISHED]
    clean = clean_view(spark, sf_dir, needed)
    return clean.select(S.ID, S.OVERCOST, S.OVERCOST_RATIO, S.OVERCOST_FLAG, S.DURATION_DAYS)


@_query(with_clean("""
select count(*) as filas, cast(sum(tiene_sobrecosto) as bigint) as con_sobrecosto,
  round(avg(tiene_sobrecosto) * 100, 6) as tasa_sobrecosto_pct from clean
"""))
def overcost_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quality.overcost_rate(clean_table(spark, sf_dir)), {"tasa_sobrecosto_pct": 6})


@_query(with_clean("""
select count(*) as filas_iniciales, (select count(*) from clean) as filas_finales,
  round((select count(*) from clean) / count(*) * 100, 6) as tasa_retencion_pct from raw
"""))
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_contracts(spark, sf_dir, [S.ID])
    return rounded(quality.retention(raw, clean_table(spark, sf_dir)), {"tasa_retencion_pct": 6})


DESCRIBE_DIGITS = {"mean": 4, "std": 3, "min": 6, "p50": 4, "max": 6}


@_query(with_clean(" union all ".join(f"""
select '{c}' as variable, count({c}) as count, round(avg({c}), 4) as mean,
  round(stddev_samp({c}), 3) as std, round(min({c}), 6) as min, round(median({c}), 4) as p50,
  round(max({c}), 6) as max from clean
""" for c in S.DESCRIBED_COLUMNS)))
def describe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quality.describe_numeric(clean_table(spark, sf_dir)), DESCRIBE_DIGITS)


@_query(with_clean(f"select {_CLEAN.replace('duracion,', 'cast(duracion as varchar) as duracion,', 1)} from clean"))
def stage1_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = sources.shared_folder(spark)
    with sources.shuffles_removed(spark):
        raw = raw_contracts(spark, sf_dir).select(*S.RAW_COLUMNS)
        sources.write_raw_csv(raw, f"{folder}/raw", **LANDED)
    return run_stage1(spark, f"{folder}/raw", f"{folder}/clean").clean
