"""Column names and declared schemas of the contract tables.

Fixed values: the column names are those of the open-data contract records, so
that existing files and reports keep working.
"""

from __future__ import annotations

from pyspark.sql import types as T

ID = "id_del_portafolio"
REFERENCE = "referencia_del_proceso"
ENTITY = "entidad"
REGION = "departamento_entidad"
CITY = "ciudad_entidad"
MODALITY = "modalidad_de_contratacion"
CONTRACT_TYPE = "tipo_de_contrato"
STATUS = "estado_del_procedimiento"
PRICE = "precio_base"
AWARD = "valor_total_adjudicacion"
BIDDERS = "proveedores_unicos_con"
DURATION = "duracion"
DURATION_UNIT = "unidad_de_duracion"
PUBLISHED = "fecha_de_publicacion_del"

OVERCOST = "sobrecosto_pesos"
OVERCOST_RATIO = "ratio_sobrecosto"
OVERCOST_FLAG = "tiene_sobrecosto"
DURATION_DAYS = "duracion_dias_prevista"

RAW_COLUMNS = [
    ID, REFERENCE, ENTITY, REGION, CITY, MODALITY, CONTRACT_TYPE, STATUS,
    PRICE, AWARD, BIDDERS, DURATION, DURATION_UNIT, PUBLISHED,
]

TEXT_COLUMNS = [ENTITY, REGION, CITY, MODALITY, CONTRACT_TYPE, STATUS, DURATION_UNIT]

MONEY_COLUMNS = [PRICE, AWARD]

DESCRIBED_COLUMNS = [PRICE, AWARD, OVERCOST, OVERCOST_RATIO, DURATION_DAYS, BIDDERS]

STATISTICS_COLUMNS = [PRICE, AWARD, OVERCOST, DURATION_DAYS]

# Every raw field arrives as text; the cleaning stage casts explicitly, so one
# badly formatted value can never change the type of a column.
RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

_CLEAN_TYPES = {
    PRICE: T.DoubleType(),
    AWARD: T.DoubleType(),
    BIDDERS: T.DoubleType(),
    PUBLISHED: T.TimestampNTZType(),
}

CLEAN_SCHEMA = T.StructType(
    [T.StructField(name, _CLEAN_TYPES.get(name, T.StringType())) for name in RAW_COLUMNS]
    + [
        T.StructField(OVERCOST, T.DoubleType()),
        T.StructField(OVERCOST_RATIO, T.DoubleType()),
        T.StructField(OVERCOST_FLAG, T.IntegerType()),
        T.StructField(DURATION_DAYS, T.DoubleType()),
    ]
)
