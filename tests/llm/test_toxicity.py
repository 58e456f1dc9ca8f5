"""Toxicity: voters, classifier, held-out accuracy and odd input."""

import os
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

import __spark_entry__ as entry  # noqa: E402
from tenderlens.llm import label_model, toxicity  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def test_held_out_documents(spark):
    toxic = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF_DIR}/labels.parquet").to_pylist()}
    ids = pq.read_table(f"{SF_DIR}/documents.parquet")["doc_id"].to_pylist()
    got = entry.queries()["op13_toxicity"](spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(ids)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [(toxic[r["doc_id"]], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in toxic]
    assert sum(p for t, p in held if t) >= 0.8 * sum(t for t, _ in held)
    assert sum(p for t, p in held if not t) <= 0.01 * len(held)


def made(n, seed=0):
    draw = random.Random(seed)
    words = ["river", "stone", "cloud", "paper", "green", "seven", "house", "light"]
    bad = ["vile", "rotten", "snarkish", "snarkable", "snarkful"]
    rows = []
    for i in range(n):
        text = draw.choices(words, k=30)
        if i % 4 == 0:
            text[::7] = draw.choices(bad, k=5)
        rows.append((i, " ".join(text), int(i % 4 == 0)))
    return rows


def fitted(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, 5, "z") for i, t, _ in rows], "doc_id bigint, text string, toxic int, id string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id bigint, toxic int")
    return toxicity.fit(docs, labels, F.col("doc_id") % 5 != 0, **options)


def test_words_and_beginnings_are_found(spark):
    rows = made(400)
    model = fitted(spark, rows)
    assert {"vile", "rotten", "snark-"} <= set(model.lexicon)
    assert not {"river", "stone"} & set(model.lexicon)
    scores = model.score([t for _, t, _ in rows])
    assert [int(s >= 0.5) for s in scores] == [t for _, _, t in rows]
    assert model.score([""])[0] < 0.5
    assert model.voters.accuracy()[0] > 0.9


def test_wrong_labels_are_outvoted(spark):
    rows = [(i, t, 1 - y if i % 31 == 1 else y) for i, t, y in made(800)]
    model = fitted(spark, rows)
    truth = [int(i % 4 == 0) for i, _, _ in rows]
    assert np.mean((model.score([t for _, t, _ in rows]) >= 0.5) == truth) > 0.98


def test_the_sample_is_bounded(spark):
    assert {"vile", "rotten"} <= set(fitted(spark, made(1200), sample=300).lexicon)


@pytest.mark.parametrize("labels", [[], [(1, 0)], [(1, 1)], [(None, 1), (2, None), (3, 7)]])
def test_too_few_labels(spark, labels):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id bigint, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"), F.lit(True))
    share = 1 if labels == [(1, 1)] else 0
    got = docs.select(toxicity.score(F.col("text"), model).alias("s")).collect()
    assert [round(r["s"]) for r in got] == [share, share]


def test_empty_null_and_repeated_rows(spark):
    rows = made(200)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(0, rows[0][1]), (None, "vile"), (500, None), (501, "")],
                                 "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows] * 2, "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    got = docs.select("doc_id", toxicity.score(F.col("text"), model).alias("s")).collect()
    assert len(got) == 204
    assert len({r["s"] for r in got if r["doc_id"] in (500, 501)}) == 1
    none = docs.limit(0).select(toxicity.score(F.col("text"), model).alias("s"))
    assert none.collect() == []


def test_long_text_is_cut_between_words(monkeypatch):
    model = toxicity.ToxicityModel(["vile", "snar-"], np.zeros(3))
    text = "vile snarky snarling " * 40
    whole = model.counts(text)
    monkeypatch.setattr(toxicity, "_CHUNK", 11)
    assert (model.counts(text) == whole).all()
    assert whole.tolist() == [40, 80]


def test_correlated_voters_count_less():
    draw = np.random.default_rng(5)
    truth = draw.random(4000) < 0.3

    def voter(accuracy):
        return np.where(draw.random(4000) < accuracy, 1, -1) * np.where(truth, 1, -1)

    echoed, alone = voter(0.7), [voter(0.8) for _ in range(3)]
    votes = np.column_stack([*alone, echoed, echoed, echoed, echoed])
    given = np.where(draw.random(4000) < 0.1, np.where(truth, 1, -1), 0)
    model = label_model.fit_label_model(votes, given, np.ones(4000))
    assert (model.share[3:] < 0.5).all() and (model.share[:3] > 0.6).all()
    assert abs(model.accuracy()[:3] - 0.8).max() < 0.08
    assert ((model.posterior(votes) >= 0.5) == truth).mean() > 0.85
