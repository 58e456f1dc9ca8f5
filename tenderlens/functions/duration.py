"""Contract durations in days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tenderlens.functions.text import fold_ascii, fold_latin, is_ascii, once, strip_text

# Days per unit, tested as substrings of the folded unit in this order.
UNIT_DAYS = [("mes", 30.0), ("ano", 365.0), ("dia", 1.0)]


def duration_days(magnitude: Column, unit: Column) -> Column:
    """Days for a numeric ``magnitude`` (double, NULL if missing) in the written ``unit``.

    Unknown and missing units keep the magnitude.
    """
    def factor(folded: Column) -> Column:
        days = F.lit(1.0)
        for word, length in reversed(UNIT_DAYS):
            days = F.when(folded.contains(word), F.lit(length)).otherwise(days)
        return days

    # Outer white space is part of no word, and what folds to ASCII letter by letter needs no more than that.
    lower = F.lower(unit)
    folded = once(fold_ascii(F.lower(strip_text(unit))), factor)
    accented = once(fold_latin(lower), lambda text: F.when(~is_ascii(text), folded).otherwise(factor(text)))
    return magnitude * F.when(is_ascii(unit), factor(lower)).otherwise(accented)
