"""Boxes and whiskers from counted cells against every row."""

import math

import numpy as np
import pandas as pd
import pytest

from tenderlens.operators import charts, quantiles


def by_hand(pdf):
    out = {}
    for key, x in pdf.dropna().groupby("k")["v"]:
        q1, median, q3 = x.quantile([0.25, 0.5, 0.75])
        inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
        out[key] = (len(x), x.mean(), q1, median, q3, min([*inside, q1]), max([*inside, q3]), len(x) - len(inside))
    return out


def check(table, pdf, **known):
    got = {r[0]: tuple(r)[1:] for r in charts.boxplot_by_group(table, "v", "k", **known).collect()}
    expected = by_hand(pdf)
    assert set(got) == set(expected)
    for key, row in expected.items():
        assert (got[key][0], got[key][-1]) == (row[0], row[-1])
        np.testing.assert_allclose(got[key], row, rtol=1e-12, atol=1e-12)
        assert got[key][5:7] == pytest.approx(row[5:7], rel=1e-15)  # values of the table or the box


@pytest.mark.parametrize("most", [20_000, 1])
@pytest.mark.parametrize("seed", range(3))
def test_whiskers_of_many_shapes(spark, monkeypatch, most, seed):
    monkeypatch.setattr(quantiles, "MAX_BROADCAST_GROUPS", most)
    draw = np.random.default_rng(seed)
    parts = {
        "wide": np.exp(draw.normal(0, 12, 400)), "narrow": 1e9 + draw.random(300), "signs": draw.standard_cauchy(500),
        "hot": np.where(draw.random(600) < 0.4, 7.0, draw.normal(7, 3, 600)), "whole": draw.integers(-9, 30, 200) * 1.0,
        "same": np.full(50, 3.25), "one": np.array([-2.0]), "two": np.array([0.0, -0.0]),
        "split": np.array([0.0] * 3 + [1.0] * 3 + [100.0]),
    }
    pdf = pd.DataFrame([(k, v) for k, x in parts.items() for v in x], columns=["k", "v"]).sample(frac=1, random_state=seed)
    pdf.loc[pdf.index[:25], "v"] = np.nan
    pdf.loc[pdf.index[25:50], "k"] = None
    check(spark.createDataFrame(pdf).repartition(4), pdf)


def test_known_quartiles_and_clashing_names(spark):
    draw = np.random.default_rng(9)
    pdf = pd.DataFrame({"k": draw.choice(["a", "b"], 300), "v": draw.standard_t(2, 300)})
    quartiles = pdf.groupby("k")["v"].quantile([0.25, 0.5, 0.75]).unstack().reset_index()
    quartiles.columns = ["k", "q1", "mediana", "q3"]
    table = spark.createDataFrame(pdf.assign(n=1, q1="x", least=2.0))
    check(table, pdf, quartiles=spark.createDataFrame(quartiles))


def test_no_rows(spark):
    table = spark.createDataFrame([(None, 1.0), ("a", None), ("a", math.nan)], "k string, v double")
    assert charts.boxplot_by_group(table, "v", "k").collect() == []

