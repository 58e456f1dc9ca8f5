"""Number formats of the printed reports.

Ties round to even on the binary value.  Digits past the shortest form of a double,
from about the seventeenth, print as zeros.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "N/A"

# Thresholds, suffixes and decimals of compact money.
_SCALES = [(1e12, "T", 1), (1e9, "B", 1), (1e6, "M", None), (1e3, "K", 0)]

# Readable names of the model features.
FEATURE_LABELS = {
    "precio_base_log": "Precio Base [log1p]",
    "duracion_dias_prevista": "Duración Prevista (Días)",
    "proveedores_unicos_con": "Concurrencia Oferentes (N°)",
    "modalidad_de_contratacion_": "Modalidad: ",
}


def _fixed(value: Column, decimals: int) -> Column:
    return F.translate(F.format_number(value, decimals), ",", "")


def money_text(value: Column) -> Column:
    """``$1,234.50``; missing values as ``N/A``."""
    return F.coalesce(F.concat(F.lit("$"), F.format_number(value, 2)), F.lit(MISSING))


def compact_money(value: Column, million_decimals: int = 0, signed: bool = False) -> Column:
    """``$1.2T``, ``$1.2B``, ``$1M``, ``$1K``.  ``signed`` also scales negative amounts."""
    size = F.abs(value) if signed else value
    text = F.when(value.isNull(), F.lit(None).cast("string"))
    for scale, suffix, decimals in _SCALES:
        shown = _fixed(value / scale, million_decimals if decimals is None else decimals)
        text = text.when(size >= scale, F.concat(F.lit("$"), shown, F.lit(suffix)))
    return text.otherwise(F.concat(F.lit("$"), _fixed(value, 0)))


def days_text(value: Column) -> Column:
    """``1,234.5 días``; missing values as ``N/A``."""
    return F.coalesce(F.concat(F.format_number(value, 1), F.lit(" días")), F.lit(MISSING))


def percent_text(value: Column, signed: bool = False, grouped: bool = False) -> Column:
    """``12.34%``; ``signed`` writes the plus sign too, ``grouped`` the thousands marks."""
    number = F.format_number(value, 2) if signed or grouped else _fixed(value, 2)
    if signed:
        number = F.when(~number.startswith("-"), F.concat(F.lit("+"), number)).otherwise(number)
    return F.concat(number, F.lit("%"))


def skew_text(value: Column) -> Column:
    """``1,234.5678``."""
    return F.format_number(value, 4)


def feature_label(name: Column) -> Column:
    """Readable label of a technical feature name."""
    label = F.replace(F.replace(name, F.lit("num__"), F.lit("")), F.lit("cat__"), F.lit(""))
    for technical, readable in FEATURE_LABELS.items():
        label = F.replace(label, F.lit(technical), F.lit(readable))
    return label
