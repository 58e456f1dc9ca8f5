"""Money texts in mixed notations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tenderlens.functions.numeric import PLAIN_NUMBER, parse_number
from tenderlens.functions.text import strip_text


# The comma is the decimal mark: behind the last point, or alone with two characters behind it.
_DECIMAL_COMMA = r"(?s)^(.*\..*,[^.]*|[^.]*,[^.,]{2})$"


def parse_currency(text: Column) -> Column:
    """Money text to double; NULL where no number remains.

    The mark that comes last is the decimal mark when both comma and point occur.
    Commas alone are decimal marks when exactly two characters follow the last
    one, and thousands marks otherwise.  Points alone are decimal marks.
    Plain numbers, the bulk of written tables, are cast as they are.
    """
    bare = F.translate(strip_text(text), "$ \xa0", "")
    plain = F.when(bare.rlike(_DECIMAL_COMMA), F.translate(bare, ",.", ".")).otherwise(
        F.translate(bare, ",", "")
    )
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double")).otherwise(parse_number(plain))
