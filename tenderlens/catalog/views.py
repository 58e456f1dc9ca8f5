"""A contracts table derived from the order tables, in Spark and as oracle SQL.

One order line is one contract.  The view has invalid amounts, missing modalities,
unknown and missing units, padded and accented texts, and repeated ids.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlens import schema as S
from tenderlens.operators import cleaning, features
from tenderlens.sources import read_clean, shared_folder, write_clean

# Which joins a column needs; every other column comes from the lines themselves.
_FROM_SUPPLIERS = {S.ENTITY, S.CITY, S.REGION}
_FROM_ORDERS = {S.MODALITY}
_FROM_COMPETITION = {S.BIDDERS}

# Lines that one task of the clean view sorts and looks up at once, whatever the table's size.
LINES_PER_TASK = 300_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _competition(lines: DataFrame) -> DataFrame:
    bidders = F.count_distinct("l_suppkey").cast("double")
    return lines.groupBy(F.col("l_orderkey").alias("key")).agg(bidders.alias("bidders"))


def _dealt_out(df: DataFrame, parts: int | None, key: str) -> DataFrame:
    """``df`` dealt out by ``key``; without a number of parts the planner chooses it."""
    return df.repartition(key) if parts is None else df.repartition(parts, key)


def _parts(spark: SparkSession, lines: DataFrame) -> int | None:
    """Parts of ``LINES_PER_TASK`` lines; None where a part for each core is no larger.

    The planner's parts are bounded by their compressed bytes and by a fixed number of parts, so the memory of a
    task would follow neither.  Counting reads the footers of the files alone.
    """
    parts = math.ceil(lines.count() / LINES_PER_TASK)
    return parts if parts > spark.sparkContext.defaultParallelism else None


def _order_facts(
    spark: SparkSession, sf_dir: str, columns: set[str], unique: bool, parts: int | None = None
) -> DataFrame | None:
    """What the lines look up by order, in one table with one row per order.

    One join instead of two lets the planner split a very large order without another shuffle.
    ``unique`` keeps one row where an order is given several times.  ``parts`` deals the tables out as the lines are.
    """
    priority = F.col("o_orderpriority")
    kind = (
        F.when(priority == "1-URGENT", 1).when(priority == "2-HIGH", 2)
        .when(priority == "3-MEDIUM", 3).when(priority == "4-NOT SPECIFIED", 4)
    )
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), kind.alias("kind"))
    lines = table(spark, sf_dir, "lineitem")
    if parts is not None:
        orders, lines = _dealt_out(orders, parts, "key"), _dealt_out(lines, parts, "l_orderkey")
    if unique:
        orders = orders.groupBy("key").agg(F.max("kind").alias("kind"))
    competition = _competition(lines)
    if not columns & _FROM_COMPETITION:
        return orders if columns & _FROM_ORDERS else None
    # Every order of a line has a row in ``competition``.
    return competition.join(orders, "key", "left") if columns & _FROM_ORDERS else competition


def _suppliers(spark: SparkSession, sf_dir: str, unique: bool) -> tuple[DataFrame, DataFrame]:
    """Suppliers and nations with the columns that the lines look up."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    if unique:
        return suppliers.dropDuplicates(["s_suppkey"]), nations.dropDuplicates(["n_nationkey"])
    return suppliers, nations


def _looked_up(
    rows: DataFrame, spark: SparkSession, sf_dir: str, columns: set[str],
    order: str, supplier: str, quantity: str, unique: bool = False, parts: int | None = None,
) -> DataFrame:
    """``rows`` with those of ``columns`` that come from other tables than the lines.

    ``order``, ``supplier`` and ``quantity`` name the columns of ``rows`` that hold a line's keys and its quantity.
    All lookups are left joins, so a join that no column needs can be left out without changing a row.
    """
    found: dict[str, Column] = {}
    by_order = _order_facts(spark, sf_dir, columns, unique, parts)
    if by_order is not None:
        rows = rows.join(by_order, F.col(order) == F.col("key"), "left")
        kind = F.col("kind")
        found[S.MODALITY] = (
            F.when(F.col(quantity) == 4, None)
            .when(kind == 1, "Licitación Pública").when(kind == 2, "Selección Abreviada")
            .when(kind == 3, "Mínima Cuantía").when(kind == 4, "Contratación Directa")
            .otherwise("  Régimen   Especial ")
        )
        found[S.BIDDERS] = F.col("bidders")
    if _FROM_SUPPLIERS & columns:
        suppliers, nations = _suppliers(spark, sf_dir, unique)
        rows = rows.join(suppliers, F.col(supplier) == F.col("s_suppkey"), "left")
        rows = rows.join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        found[S.ENTITY] = F.col("s_name")
        found[S.REGION] = F.when(F.col("n_regionkey") == 1, "Cundinamarca").otherwise("Otro")
        found[S.CITY] = F.col("n_name")
    return rows.withColumns({c: found[c] for c in found if c in columns})


def _own_columns() -> dict[str, Column]:
    """The contract columns that come from the lines themselves."""
    quantity, amount = F.col("l_quantity"), F.col("l_extendedprice") * F.col("l_quantity")
    line = F.col("l_linenumber") % 5
    return {
        S.ID: F.concat("l_orderkey", F.lit("-"), "l_linenumber"),
        S.REFERENCE: F.concat(F.lit("PO-"), "l_partkey"),
        S.CONTRACT_TYPE: F.when(F.col("l_returnflag") == "R", "Obra")
        .when(F.col("l_returnflag") == "A", " Consultoría ").otherwise("Suministro"),
        S.STATUS: F.when(F.col("l_linestatus") == "F", "Adjudicado").otherwise("Abierto"),
        S.PRICE: F.when(quantity == 1, 0.0).when(quantity == 2, -F.col("l_extendedprice"))
        .when(quantity == 3, None).otherwise(amount),
        S.AWARD: amount * (1 - F.col("l_discount")) * (1 + F.col("l_tax")),
        S.DURATION: quantity,
        S.DURATION_UNIT: F.when(line == 0, "Mes(es)").when(line == 1, "día(s)")
        .when(line == 2, "Año(s)").when(line == 3, "Semana(s)"),
        S.PUBLISHED: F.col("l_shipdate"),
    }


def _ties() -> list[Column]:
    return [F.col("l_suppkey").alias("k_supp"), F.col("l_extendedprice").alias("k_ext"),
            F.col("l_discount").alias("k_disc"), F.col("l_tax").alias("k_tax")]


def raw_contracts(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] = tuple(S.RAW_COLUMNS)
) -> DataFrame:
    """The raw contracts with ``columns`` and the tie-breaking ``k_`` columns."""
    lines = table(spark, sf_dir, "lineitem")
    rows = _looked_up(lines, spark, sf_dir, set(columns), "l_orderkey", "l_suppkey", "l_quantity")
    own = _own_columns()
    return rows.select(*[own.get(c, F.col(c)).alias(c) for c in S.RAW_COLUMNS if c in columns], *_ties())


def dedup_order() -> list[Column]:
    """The order that defines the first copy of a contract."""
    return [F.col(S.PUBLISHED).desc(), F.col(S.REFERENCE), F.col("k_supp"), F.col(S.DURATION),
            F.col("k_ext"), F.col("k_disc"), F.col("k_tax")]


def clean_view(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] = tuple(S.RAW_COLUMNS)
) -> DataFrame:
    """The first valid copy of every contract, enriched, computed from the given tables.

    Whether a line is valid and first follows from the line alone.  So lines are dealt out by order once, cleaned as
    narrow rows, and only those that stay look up, in the same tasks, what belongs to their order.
    An id names its order, so the first copy of a contract is found within its order.
    """
    given = table(spark, sf_dir, "lineitem")
    parts = _parts(spark, given)
    lines = _dealt_out(given, parts, "l_orderkey")
    own, wanted = _own_columns(), set(columns)
    raw = lines.select(*[own[c].alias(c) for c in S.RAW_COLUMNS if c in wanted and c in own],
                       *_ties(), F.col("l_orderkey").alias("k_order"))
    first = cleaning.clean_contracts(raw, order=dedup_order(), within=["k_order"])
    rows = _looked_up(first, spark, sf_dir, wanted, "k_order", "k_supp", S.DURATION, unique=True, parts=parts)
    looked_up = [c for c in S.TEXT_COLUMNS if c in wanted and c not in own]
    clean = cleaning.trim_categories(rows, looked_up).select(*[c for c in S.RAW_COLUMNS if c in wanted])
    return features.add_features(clean)


_stored: dict[tuple[str, str], str] = {}


def clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored clean table, as the later stages read it.

    The first call of a session computes and writes it, as stage 1 does.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _stored:
        try:
            return read_clean(spark, _stored[key])
        except FileNotFoundError:  # the shared folder was emptied meanwhile
            pass
    _stored[key] = f"{shared_folder(spark)}/clean"
    write_clean(clean_view(spark, sf_dir), _stored[key])
    return read_clean(spark, _stored[key])


def predictions_view(clean: DataFrame) -> DataFrame:
    """Log and real values with a fixed linear formula in place of a model."""
    label = F.log1p(S.AWARD)
    guess = 0.3 + 0.975 * F.log1p(S.PRICE) - 0.01 * F.col(S.BIDDERS)
    return clean.select(S.ID, label.alias("label"), guess.alias("prediction")).select(
        "*", F.expm1("label").alias("real"), F.expm1("prediction").alias("predicho")
    )


def rounded(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Round the named columns, so that two engines agree beyond the last bits."""
    return df.select(*[
        F.round(F.col(f"`{c}`"), digits[c]).alias(c) if c in digits else F.col(f"`{c}`")
        for c in df.columns
    ])


RAW_SQL = """
comp as (
  select l_orderkey as ck, cast(count(distinct l_suppkey) as double) as bidders
  from lineitem group by l_orderkey),
raw as (
  select concat(l_orderkey, '-', l_linenumber) as id_del_portafolio,
    concat('PO-', l_partkey) as referencia_del_proceso,
    s_name as entidad,
    case when n_regionkey = 1 then 'Cundinamarca' else 'Otro' end as departamento_entidad,
    n_name as ciudad_entidad,
    case when l_quantity = 4 then null
         when o_orderpriority = '1-URGENT' then 'Licitación Pública'
         when o_orderpriority = '2-HIGH' then 'Selección Abreviada'
         when o_orderpriority = '3-MEDIUM' then 'Mínima Cuantía'
         when o_orderpriority = '4-NOT SPECIFIED' then 'Contratación Directa'
         else '  Régimen   Especial ' end as modalidad_de_contratacion,
    case when l_returnflag = 'R' then 'Obra' when l_returnflag = 'A' then ' Consultoría '
         else 'Suministro' end as tipo_de_contrato,
    case when l_linestatus = 'F' then 'Adjudicado' else 'Abierto' end as estado_del_procedimiento,
    case when l_quantity = 1 then cast(0 as double) when l_quantity = 2 then -l_extendedprice
         when l_quantity = 3 then null else l_extendedprice * l_quantity end as precio_base,
    l_extendedprice * l_quantity * (1 - l_discount) * (1 + l_tax) as valor_total_adjudicacion,
    bidders as proveedores_unicos_con,
    l_quantity as duracion,
    case l_linenumber % 5 when 0 then 'Mes(es)' when 1 then 'día(s)' when 2 then 'Año(s)'
         when 3 then 'Semana(s)' else null end as unidad_de_duracion,
    l_shipdate as fecha_de_publicacion_del,
    l_suppkey as k_supp, l_extendedprice as k_ext, l_discount as k_disc, l_tax as k_tax
  from lineitem left join orders on l_orderkey = o_orderkey left join comp on l_orderkey = ck
       left join supplier on l_suppkey = s_suppkey left join nation on s_nationkey = n_nationkey)
"""

CLEAN_SQL = RAW_SQL + """,
valid as (select * from raw where precio_base > 0 and valor_total_adjudicacion > 0),
ranked as (
  select *, row_number() over (partition by id_del_portafolio
    order by fecha_de_publicacion_del desc, referencia_del_proceso, k_supp, duracion,
      k_ext, k_disc, k_tax) as rn
  from valid),
clean as (
  select id_del_portafolio, referencia_del_proceso, trim(entidad) as entidad,
    trim(departamento_entidad) as departamento_entidad, trim(ciudad_entidad) as ciudad_entidad,
    trim(modalidad_de_contratacion) as modalidad_de_contratacion,
    trim(tipo_de_contrato) as tipo_de_contrato,
    trim(estado_del_procedimiento) as estado_del_procedimiento,
    precio_base, valor_total_adjudicacion, proveedores_unicos_con, duracion, unidad_de_duracion,
    fecha_de_publicacion_del,
    valor_total_adjudicacion - precio_base as sobrecosto_pesos,
    (valor_total_adjudicacion - precio_base) / precio_base as ratio_sobrecosto,
    cast(valor_total_adjudicacion > precio_base as int) as tiene_sobrecosto,
    duracion * case unidad_de_duracion when 'Mes(es)' then 30 when 'Año(s)' then 365 else 1 end
      as duracion_dias_prevista
  from ranked where rn = 1)
"""

PREDICTIONS_SQL = CLEAN_SQL + """,
logs as (
  select id_del_portafolio, ln(1 + valor_total_adjudicacion) as label,
    0.3e0 + 0.975e0 * ln(1 + precio_base) - 0.01e0 * proveedores_unicos_con as prediction
  from clean),
pred as (select *, exp(label) - 1 as real, exp(prediction) - 1 as predicho from logs)
"""


def with_raw(select: str) -> str:
    """Oracle over the raw contracts."""
    return f"with {RAW_SQL} {select}"


def with_clean(select: str) -> str:
    """Oracle over the clean contracts."""
    return f"with {CLEAN_SQL} {select}"


def with_predictions(select: str) -> str:
    """Oracle over the formula's predictions."""
    return f"with {PREDICTIONS_SQL} {select}"
