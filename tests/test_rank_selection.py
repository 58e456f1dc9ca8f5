"""Digits of order codes, and many quantile requests in the same two scans."""

import math
import random
import re
import struct

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tenderlens.operators import quantiles
from tenderlens.operators.quantiles import Request, exact_quantiles, quantile_answers, quantiles_of, with_order_code

POINTS = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.999, "e": 1.0}


def bits(value):
    size = struct.unpack("<q", struct.pack("<d", abs(value)))[0]
    return -size if value < 0 else size


def test_order_code_has_the_bits_of_the_double(spark):
    draw = random.Random(1)
    values = [0.0, -0.0, 5e-324, -5e-324, math.inf, -math.inf, 1.7976931348623157e308, 2.2250738585072014e-308]
    values += [math.ldexp(1, e) for e in range(-1074, 1024)]
    values += [math.nextafter(math.ldexp(1, e), 0) for e in range(-1073, 1024)]
    values += [struct.unpack("<d", struct.pack("<Q", draw.getrandbits(64)))[0] for _ in range(5000)]
    values = [v for v in values if not math.isnan(v)]
    got = with_order_code(spark.createDataFrame([(v,) for v in values], "v double"), "v", "c").collect()
    assert [(r["v"], r["c"]) for r in got] == [(v, bits(v)) for v in values]


@pytest.mark.parametrize("low, width", [(1e9, 10.0), (-5.0, 10.0), (1e-310, 1e-310), (3.0, 1e-12)])
def test_narrow_ranges_of_many_values(spark, low, width):
    values = low + np.random.default_rng(7).random(120_000) * width
    table = spark.createDataFrame(pd.DataFrame({"v": values}))
    got = exact_quantiles(table, F.col("v"), POINTS).first()
    np.testing.assert_allclose(list(got), np.quantile(values, list(POINTS.values())), rtol=1e-15, atol=1e-323)


def windows_of(plan):
    return [line for line in plan.splitlines() if "Window [" in line]


def test_every_running_total_is_inside_the_digits_before(spark):
    table = spark.range(10).select(F.col("id").cast("double").alias("v"))
    plan = exact_quantiles(table, F.col("v"), POINTS)._jdf.queryExecution().optimizedPlan().toString()
    before = [line.split("windowspecdefinition(")[1].split(" ASC")[0] for line in windows_of(plan) if " ASC" in line]
    names = {tuple(re.findall(r"_p\d|_c", line)) for line in before}
    assert names == {("_p1",), ("_p1", "_p2"), ("_p2", "_p3"), ("_p3", "_c")}  # digits before, then the next


@pytest.mark.parametrize("most", [20_000, 1])
def test_many_requests_at_once(spark, monkeypatch, most):
    monkeypatch.setattr(quantiles, "MAX_BROADCAST_GROUPS", most)
    draw = np.random.default_rng(3)
    pdf = pd.DataFrame({
        "x": np.where(draw.random(500) < 0.1, np.nan, draw.normal(100, 30, 500)),
        "y": draw.integers(0, 4, 500).astype(float), "k": draw.choice(["p", "q", None], 500), "n": draw.integers(0, 3, 500)})
    table = spark.createDataFrame(pdf).withColumn("y", F.when(F.col("y") > 0, F.col("y")))
    pdf["y"] = pdf["y"].where(pdf["y"] > 0)
    requests = {
        "x": Request(F.col("x"), POINTS), "half": Request(F.col("x") / 2, {"m": 0.5}),
        "by_k": Request(F.col("x"), {"q1": 0.25, "q3": 0.75}, ["k"]),
        "by_both": Request(F.col("y"), {"m": 0.5}, ["n", "k"]),
        "nothing": Request(F.lit(None).cast("double"), {"m": 0.5}),
    }
    answers = quantile_answers(table, requests)
    got = {name: quantiles_of(answers, requests, name).toPandas() for name in requests}
    x = pdf["x"].dropna()
    np.testing.assert_allclose(got["x"].iloc[0], x.quantile(list(POINTS.values())), rtol=1e-14)
    assert got["half"]["m"].tolist() == pytest.approx([x.median() / 2], rel=1e-14)
    by_k = pdf.groupby("k")["x"].quantile([0.25, 0.75]).unstack()
    for _, row in got["by_k"].iterrows():
        assert (row["q1"], row["q3"]) == pytest.approx(tuple(by_k.loc[row["k"]]), rel=1e-14)
    assert len(got["by_k"]) == 2
    both = pdf.dropna(subset=["k"]).groupby(["n", "k"])["y"].median()
    assert {(r["n"], r["k"]): r["m"] for _, r in got["by_both"].iterrows()} == both.to_dict()
    assert len(got["nothing"]) == 0


def test_requests_share_two_scans(spark, tmp_path):
    spark.range(100).selectExpr("double(id) as x", "id % 3 as k").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    requests = {f"r{i}": Request(F.col("x") * i, {"m": 0.5}, ["k"] if i % 2 else (), True) for i in range(6)}
    plan = quantile_answers(table, requests)._jdf.queryExecution()
    counts = plan.optimizedPlan().toString().count("parquet")
    assert counts >= 2
    executed = quantile_answers(table, requests)
    executed.collect()
    text = executed._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert text.count("FileScan parquet") == 2


def test_no_rows(spark):
    table = spark.createDataFrame([], "x double, k string")
    requests = {"a": Request(F.col("x"), {"m": 0.5}), "b": Request(F.col("x"), {"m": 0.5}, ["k"])}
    assert quantile_answers(table, requests).collect() == []
