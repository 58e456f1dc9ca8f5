"""Bands of competition by number of bidders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tenderlens.functions.numeric import null_if_nan

# Report labels in logical order.
BAND_LABELS = [
    "1 oferente (Unipersonal)",
    "2 - 3 oferentes (Baja concurrencia)",
    "4 - 9 oferentes (Media concurrencia)",
    "10+ oferentes (Alta concurrencia)",
]


def band_order(bidders: Column) -> Column:
    """1 to 4.  Fractions between two bands fall into the last one, missing numbers into the first."""
    bidders = null_if_nan(bidders)
    return (
        F.when(bidders.isNull() | (bidders <= 1), 1)
        .when(bidders.between(2, 3), 2)
        .when(bidders.between(4, 9), 3)
        .otherwise(4)
    )


def competition_band(bidders: Column) -> Column:
    """Label of the band of competition."""
    labels = F.array(*[F.lit(label) for label in BAND_LABELS])
    return F.element_at(labels, band_order(bidders))
