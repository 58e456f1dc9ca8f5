"""ISO-8601 date texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First and last moment that a 64-bit nanosecond clock can hold.
_FIRST, _LAST = "1677-09-21 00:12:43.145225", "2262-04-11 23:47:16.854775"

_EXTENDED = (
    r"^ *[0-9]{4}(-[0-9]{1,2}(-[0-9]{1,2}"
    r"([T ][0-9]{1,2}:[0-9]{1,2}(:[0-9]{1,2}(\.[0-9]+)?)?)?)?)?$"
)

# Rewrites to the extended form: offset, date without dashes, time without
# colons, hour without minutes.
_REWRITES = [
    (r"([T ][0-9:]+(\.[0-9]+)?) *(Z|[+-][0-9]{2}(:?[0-9]{2})?)$", "$1"),
    (r"^( *[0-9]{4})/?([0-9]{2})/?([0-9]{2})(?=$|[T ])", "$1-$2-$3"),
    (r"([T ][0-9]{2})([0-9]{2})([0-9]{2})(?=$|\.)", "$1:$2:$3"),
    (r"([T ][0-9]{2})([0-9]{2})$", "$1:$2"),
    (r"([0-9][T ][0-9]{1,2})$", "$1:00"),
]


def parse_iso_date(text: Column) -> Column:
    """ISO-8601 text to ``timestamp_ntz``; NULL for anything else.

    An offset is accepted but not applied: the local wall-clock time is kept.
    """
    rewritten = text
    for pattern, replacement in _REWRITES:
        rewritten = F.regexp_replace(rewritten, pattern, replacement)
    extended = F.when(text.rlike(_EXTENDED), text).when(rewritten.rlike(_EXTENDED), rewritten)
    moment = F.trim(extended).try_cast("timestamp_ntz")
    in_range = moment.between(
        F.lit(_FIRST).cast("timestamp_ntz"), F.lit(_LAST).cast("timestamp_ntz")
    )
    return F.when(in_range, moment)
