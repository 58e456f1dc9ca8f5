"""Modes from bucket counts against a count of every value."""

import math
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tenderlens.operators import describe


def by_hand(pdf):
    return {c: pdf[c].mode().min() for c in pdf.columns if pdf[c].notna().any()}


def by_buckets(table, columns, buckets=describe.MODE_BUCKETS):
    return {r["variable"]: r["moda"] for r in describe.exact_modes(table, columns, buckets).collect()}


@pytest.mark.parametrize("buckets", [1, 8, 64, 1 << 18])
def test_every_number_of_buckets(spark, buckets):
    draw = np.random.default_rng(5)
    pdf = pd.DataFrame({
        "unique": draw.permutation(3000) / 7.0 - 200,
        "pairs": np.repeat(draw.permutation(1500), 2) + 0.25,
        "hot": np.where(draw.random(3000) < 1 / 3, 12.5, draw.random(3000)),
        "few": draw.integers(0, 6, 3000).astype(float),
        "one": np.where(np.arange(3000) < 1700, np.nan, 4.0),
        "none": np.full(3000, np.nan),
        "signs": np.where(np.arange(3000) % 2 == 0, 0.0, np.where(np.arange(3000) % 4 == 1, -0.0, 3.0)),
    })
    got = by_buckets(spark.createDataFrame(pdf).repartition(5), list(pdf.columns), buckets)
    assert got == by_hand(pdf) and "none" not in got


@pytest.mark.parametrize("seed", range(4))
def test_ties_go_to_the_smallest(spark, seed):
    draw = np.random.default_rng(seed)
    pdf = pd.DataFrame({"x": draw.integers(-40, 40, 300) / 2.0, "y": draw.normal(0, 1, 300).round(1)})
    for buckets in (2, 32, 1 << 18):
        assert by_buckets(spark.createDataFrame(pdf), ["x", "y"], buckets) == by_hand(pdf)


def test_infinities_and_nothing(spark):
    table = spark.createDataFrame([(math.inf, 1), (math.inf, 2), (-math.inf, 2), (1.0, None)], "a double, b int")
    assert by_buckets(table, ["a", "b"]) == {"a": math.inf, "b": 2.0}
    assert by_buckets(table.limit(0), ["a", "b"]) == {} == by_buckets(table, [])


def test_values_counted_in_full_are_few_where_one_is_frequent(spark, tmp_path):
    """A continuous column with a value of 1 % of its rows: hardly any other value is shuffled."""
    rows = spark.range(400_000, numPartitions=4).select(
        F.when(F.col("id") % 100 == 0, 5.0).otherwise(F.rand(3) * 1e6).alias("x"))
    rows.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    found = describe.exact_modes(table, ["x"], 1 << 12)
    assert [tuple(r) for r in found.collect()] == [("x", 5.0)]
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall("FileScan parquet", plan)) == 3
    assert describe.value_counts(table, ["x"]).count() > 390_000
    assert describe.mode_candidates(table, ["x"], 1 << 12).count() < 1000


def test_known_medians_give_the_same_table(spark):
    draw = np.random.default_rng(8)
    pdf = pd.DataFrame({"p": draw.integers(0, 50, 800).astype(float), "q": draw.normal(5, 2, 800)})
    table = spark.createDataFrame(pdf)
    medians = spark.createDataFrame([(c, float(pdf[c].median())) for c in pdf], "variable string, mediana double")
    first = describe.central_tendency(table, ["p", "q"]).orderBy("variable").toPandas()
    again = describe.central_tendency(table, ["p", "q"], medians=medians).orderBy("variable").toPandas()
    pd.testing.assert_frame_equal(first, again)
