"""Files between the stages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlens import schema as S
from tenderlens.functions import parse_iso_date, parse_number
from tenderlens.sources.csv_records import read_csv_records

# Texts that CSV readers commonly take for a missing value.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Quotes are doubled inside quoted fields, as in RFC 4180, and edge blanks are data.
_CSV = {
    "header": True, "encoding": "UTF-8", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def _open(path: str, made_by: str, read: Callable[[], DataFrame]) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(
                f"No se encontró la entrada: '{path}'. Ejecuta primero: {made_by}."
            ) from error
        raise


def fold_null_tokens(df: DataFrame) -> DataFrame:
    """Missing-value texts of all string columns as NULL."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(c).isin(NULL_TOKENS), F.col(c)) for c in texts})


def read_json_records(spark: SparkSession, path: str, array: bool = False) -> DataFrame:
    """Landed JSON records with the raw schema; absent keys are NULL.

    JSON Lines by default, which Spark splits; ``array`` reads one array per file.
    """
    reader = spark.read.schema(S.RAW_SCHEMA).option("multiLine", array)
    return _open(path, "extracción", lambda: reader.json(path))


def _read_csv(spark: SparkSession, path: str, multiline: bool, whole_files: bool) -> DataFrame:
    if multiline and not whole_files:
        return read_csv_records(spark, path, _CSV)
    return spark.read.options(**_CSV).option("multiLine", multiline).csv(path)


def read_raw_csv(
    spark: SparkSession, path: str, multiline: bool = True, whole_files: bool = False
) -> DataFrame:
    """Raw CSV with a header; every column is text and found by its name.

    ``multiline`` keeps quoted line breaks whole, and large files are still read in many tasks; without it
    each line is a record, which saves a shuffle.  ``whole_files`` reads each file in one task, for files with quotes
    outside quoted fields, from which the splits could not tell where records begin.
    """
    rows = _open(path, "extracción", lambda: _read_csv(spark, path, multiline, whole_files))
    return fold_null_tokens(rows)


def write_raw_csv(df: DataFrame, path: str, **options: str | int) -> None:
    """CSV part files with a header, replacing earlier ones; ``options`` are further ones of the writer."""
    df.write.mode("overwrite").options(**_CSV, **options).csv(path)


def write_clean(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    """The clean table as Parquet or CSV, replacing an earlier one."""
    if file_format == "csv":
        write_raw_csv(df, path)
    elif file_format == "parquet":
        df.write.mode("overwrite").parquet(path)
    else:
        raise ValueError(f"Unknown file format: '{file_format}'")


def _typed(df: DataFrame) -> DataFrame:
    """Texts of a clean CSV in the types of the clean schema; other columns stay text."""
    casts = {}
    for field in S.CLEAN_SCHEMA.fields:
        if field.name not in df.columns or isinstance(field.dataType, T.StringType):
            continue
        text = F.col(field.name)
        if isinstance(field.dataType, T.TimestampNTZType):
            casts[field.name] = parse_iso_date(text)
        else:
            casts[field.name] = parse_number(text).cast(field.dataType)
    return df.withColumns(casts)


def read_clean(
    spark: SparkSession, path: str, file_format: str = "parquet", multiline: bool = True, whole_files: bool = False
) -> DataFrame:
    """The clean table that the first stage wrote; for CSV see ``read_raw_csv``."""
    if file_format == "csv":
        rows = _open(path, "etapa 1", lambda: _read_csv(spark, path, multiline, whole_files))
        return _typed(fold_null_tokens(rows))
    return _open(path, "etapa 1", lambda: spark.read.parquet(path))
