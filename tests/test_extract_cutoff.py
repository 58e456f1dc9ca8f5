"""The cutoff of the extract keeps the newest rows and hardly more, also within one day."""

import datetime

import pytest
from pyspark.sql import functions as F

from tenderlens.sources.extract import _recent

START = datetime.datetime(2024, 5, 6, 8, 0, 0)


def _rows(spark, kind):
    """3000 rows of one day in 1000 seconds of three rows each, two newer days, an older one, and missing moments."""
    moments = [START + datetime.timedelta(seconds=i // 3, microseconds=i % 3) for i in range(3000)]
    moments += [START + datetime.timedelta(days=1)] * 5 + [START + datetime.timedelta(days=2)] * 4
    moments += [START - datetime.timedelta(days=1)] * 10 + [None] * 7
    if kind == "date":
        moments = [m and m.date() for m in moments]
    return spark.createDataFrame([(i, m) for i, m in enumerate(moments)], f"id int, moment {kind}")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
@pytest.mark.parametrize("limit", [1, 4, 5, 9, 10, 100, 3009, 3010, 3019, 3020, 9000])
def test_newest_rows_stay(spark, kind, limit):
    rows = _rows(spark, kind)
    newest = [F.desc_nulls_last("moment"), "id"]
    kept = _recent(rows, F.col("moment"), limit)
    assert kept.orderBy(*newest).limit(limit).collect() == rows.orderBy(*newest).limit(limit).collect()
    if kind != "date" and 9 < limit <= 3009:
        assert kept.count() < limit + 3
    if limit > 3019:
        assert kept.count() == rows.count()


def test_no_rows(spark):
    assert _recent(_rows(spark, "timestamp").limit(0), F.col("moment"), 5).count() == 0
