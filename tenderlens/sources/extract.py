"""The extract of awarded works contracts of one region."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlens import schema as S
from tenderlens.functions import exceeds, parse_iso_date

# Defaults of the extract.
REGION, CONTRACT_TYPE, LIMIT = "Cundinamarca", "Obra", 10_000
PREVIEW_COLUMNS = [S.ENTITY, S.PRICE, S.AWARD, S.MODALITY]


def _moment(df: DataFrame, name: str) -> Column:
    """Publication time; texts are parsed, and what is no date counts as missing."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_iso_date(F.col(name))
    return F.col(name)


def _second(df: DataFrame, moment: Column) -> Column:
    """A number of seconds that orders the moments of one day."""
    kind = df.select(moment).schema[0].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_seconds(moment)
    if isinstance(kind, T.TimestampNTZType):
        return (F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)).cast("bigint")
    return F.lit(0).cast("bigint")


def _recent(rows: DataFrame, moment: Column, limit: int) -> DataFrame:
    """Rows from the second on with which the newest ``limit`` rows are complete.

    A top-k gathers ``limit`` rows of every task in one place.  Counting rows per second first leaves
    it hardly more than ``limit`` rows in all, also where one day holds most of them: the counts
    are added per day, and only the seconds of the day that crosses the limit, at most 90,000, are
    looked at.  With fewer dated rows than ``limit`` everything stays.
    """
    day, second = F.to_date(moment), _second(rows, moment)
    counts = rows.groupBy(day.alias("day"), second.alias("second")).agg(F.count("*").alias("n")).where("day is not null")
    newest_day = Window.partitionBy(F.lit(1)).orderBy(F.desc("day"))
    days = counts.groupBy("day").agg(F.sum("n").alias("n")).withColumn("newer", F.sum("n").over(newest_day))
    missing = (F.lit(limit) - F.col("newer") + F.col("n")).alias("missing")
    crossing = days.where(F.col("newer") >= limit).agg(F.max(F.struct("day", missing)).alias("last"))  # one row
    newest_second = Window.partitionBy("day").orderBy(F.desc("second"))
    seconds = counts.join(F.broadcast(crossing), F.col("day") == F.col("last.day"))
    seconds = seconds.withColumn("newer", F.sum("n").over(newest_second)).where(F.col("newer") >= F.col("last.missing"))
    cutoff = seconds.agg(F.max(F.struct("day", "second"))).scalar()
    recent = day.isNotNull() & (F.struct(day.alias("day"), second.alias("second")) >= cutoff)
    return rows.where(F.coalesce(cutoff.isNull() | recent, F.lit(False)))


def extract_contracts(
    df: DataFrame,
    region: str = REGION,
    contract_type: str = CONTRACT_TYPE,
    limit: int = LIMIT,
    columns: Sequence[str] = tuple(S.RAW_COLUMNS),
    tie_break: Sequence[str] = (S.ID,),
    method: str = "cutoff",
) -> DataFrame:
    """The newest ``limit`` contracts of a region and type with a positive award.

    Equality is exact.  Filters and columns reach the scan, and the limit is a top-k
    per task, so nothing is sorted as a whole.  ``method``: ``cutoff`` (drop what
    is too old first) or ``direct``, which saves a scan where few rows match.
    """
    if method not in {"direct", "cutoff"}:
        raise ValueError(f"Unknown extract method: '{method}'")
    rows = df.where(
        (F.col(S.REGION) == region)
        & (F.col(S.CONTRACT_TYPE) == contract_type)
        & exceeds(df, S.AWARD, 0)
    )
    moment = _moment(df, S.PUBLISHED)
    if method == "cutoff":
        rows = _recent(rows, moment, limit)
    newest = [moment.desc_nulls_last(), *[F.col(c) for c in tie_break]]
    return rows.orderBy(*newest).limit(limit).select(*columns)


def preview(df: DataFrame, rows: int = 3) -> DataFrame:
    """The first rows with the columns worth a glance."""
    return df.limit(rows).select(*PREVIEW_COLUMNS)
