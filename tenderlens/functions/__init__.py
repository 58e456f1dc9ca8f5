"""Column expressions: every function maps columns to a column."""

from tenderlens.functions.bands import BAND_LABELS, band_order, competition_band
from tenderlens.functions.dates import parse_iso_date
from tenderlens.functions.duration import duration_days
from tenderlens.functions.money import parse_currency
from tenderlens.functions.numeric import exceeds, null_if_nan, number_column, parse_number
from tenderlens.functions.reporting import (
    compact_money,
    days_text,
    feature_label,
    money_text,
    percent_text,
    skew_text,
)
from tenderlens.functions.text import fold_ascii, normalize_text, strip_text

__all__ = [
    "BAND_LABELS", "band_order", "competition_band", "parse_iso_date", "duration_days",
    "parse_currency", "exceeds", "null_if_nan", "number_column", "parse_number", "compact_money",
    "days_text", "feature_label", "money_text", "percent_text", "skew_text",
    "fold_ascii", "normalize_text", "strip_text",
]
