"""From raw text records to valid, unique, typed contracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlens import schema as S
from tenderlens.functions import exceeds, number_column, parse_currency, parse_iso_date, strip_text


def _require(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"The table lacks the columns {missing}")


def money_column(df: DataFrame, name: str) -> Column:
    """Column ``name`` as an amount: texts are parsed, numbers pass through."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_currency(F.col(name))
    return number_column(df, name)


def cast_money(df: DataFrame, columns: Sequence[str] = tuple(S.MONEY_COLUMNS)) -> DataFrame:
    """Amounts as doubles; absent columns are skipped."""
    return df.withColumns({c: money_column(df, c) for c in columns if c in df.columns})


def is_valid_money(df: DataFrame, price: str = S.PRICE, award: str = S.AWARD) -> Column:
    """True for rows whose two amounts are known and positive, else false or NULL.

    Stored numbers are compared as they are, so that the filter reaches the scan.
    """
    positive = [
        parse_currency(F.col(c)) > 0 if isinstance(df.schema[c].dataType, T.StringType)
        else exceeds(df, c, 0)
        for c in (price, award)
    ]
    return positive[0] & positive[1]


def valid_money_filter(df: DataFrame, price: str = S.PRICE, award: str = S.AWARD) -> DataFrame:
    """Drop rows in which the base price or the award is missing, zero or negative."""
    return df.where(is_valid_money(df, price, award))


def default_order(df: DataFrame, id_column: str = S.ID, date_column: str = S.PUBLISHED) -> list[Column]:
    """Newest first, then by every other column, which makes "first" well defined."""
    newest = [F.col(date_column).desc_nulls_last()] if date_column in df.columns else []
    return newest + [F.col(c).asc() for c in df.columns if c not in (id_column, date_column)]


def dedup_keep_first(
    df: DataFrame, id_column: str, order: Sequence[Column], within: Sequence[str] = ()
) -> DataFrame:
    """First row per id in ``order``; missing ids count as one id.

    Rows have no position in a distributed table, so the order is an argument.  The
    planner keeps one row per id in each task before the shuffle, so a very frequent
    id does not load the task that receives it.

    ``within`` names columns whose values follow from an id that is not missing.  A table that is already
    dealt out by them is then neither shuffled nor sorted again by id.
    """
    if id_column not in df.columns:
        return df
    window = Window.partitionBy(*within, id_column).orderBy(*order)
    kept = df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")
    if not within:
        return kept
    # Missing ids are left with one row per value of ``within``; the first of them all stays.
    missing = df.where(F.col(id_column).isNull()).orderBy(*order, *within).limit(1)
    first = missing.select(F.struct(*within)).scalar()
    return kept.where(F.col(id_column).isNotNull() | F.struct(*within).eqNullSafe(first))


def parse_dates(df: DataFrame, columns: Sequence[str] = (S.PUBLISHED,)) -> DataFrame:
    """Date texts as ``timestamp_ntz``; absent and already typed columns are left alone."""
    texts = [
        c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)
    ]
    return df.withColumns({c: parse_iso_date(F.col(c)) for c in texts})


def trim_categories(df: DataFrame, columns: Sequence[str] = tuple(S.TEXT_COLUMNS)) -> DataFrame:
    """Strip the category columns that exist; letters and accents stay, NULL stays NULL."""
    return df.withColumns({c: strip_text(F.col(c)) for c in columns if c in df.columns})


def clean_contracts(
    df: DataFrame,
    id_column: str = S.ID,
    price: str = S.PRICE,
    award: str = S.AWARD,
    date_columns: Sequence[str] = (S.PUBLISHED,),
    order: Sequence[Column] | None = None,
    within: Sequence[str] = (),
) -> DataFrame:
    """Drop invalid amounts, keep one row per id; amounts and dates typed, texts trimmed.

    For ``within`` see ``dedup_keep_first``.
    """
    _require(df, [price, award])
    valid = cast_money(valid_money_filter(df, price, award), [price, award])
    typed = trim_categories(parse_dates(valid, date_columns))
    first_date = date_columns[0] if date_columns else S.PUBLISHED
    chosen = order if order is not None else default_order(typed, id_column, first_date)
    return dedup_keep_first(typed, id_column, chosen, within)
