"""Short spans of a second language, and the short cut of the path against the full search."""

import collections
import os
import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

pytest.importorskip("public_tokenizers")

from pyspark.sql import functions as F  # noqa: E402

from tenderlens.llm import language_id, language_model  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def halves():
    """Words of each language from the even documents, to learn from, and from the odd ones."""
    found = collections.defaultdict(lambda: ([], []))
    for r in pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist():
        if r["text"] and r["lang"]:
            found[r["lang"]][r["doc_id"] % 2].extend(re.findall(r"[^\W\d_]+", r["text"]))
    return found


@pytest.fixture(scope="module")
def model(halves):
    counts = collections.Counter()
    for language, (learn, _) in halves.items():
        for word in learn:
            padded = f" {word.lower()} "
            counts.update((language, padded[i:i + 3]) for i in range(len(word)))
    return language_model.fit_counts([(*key, n) for key, n in counts.items()])


def test_spans_of_a_few_words(spark, halves, model):
    """At least 70 % of spans of two words and 90 % of three, four and six, between runs of another language."""
    draw, texts = random.Random(5), []
    names = sorted(halves)
    for size in (2, 3, 4, 6):
        for _ in range(200):
            outer, inner = draw.sample(names, 2)
            words = []
            for language, n in ((outer, 40), (inner, size), (outer, 40)):
                at = draw.randrange(len(halves[language][1]) - n)
                words += halves[language][1][at:at + n]
            texts.append((size, inner, " ".join(words)))
    table = spark.createDataFrame(texts, "size int, inner string, text string")
    hits = collections.Counter()
    for r in table.select("*", language_id.spans(F.col("text"), model).alias("spans")).collect():
        middle = set(range(40, 40 + r["size"]))
        hits[r["size"]] += any(s["lang"] == r["inner"] and middle & set(range(s["start"], s["end"])) for s in r["spans"])
    assert hits[2] >= 140 and min(hits[3], hits[4], hits[6]) >= 180, hits


def full_search(scores, penalty):
    """The largest sum of scores less penalties, over all paths."""
    value = scores[0]
    for row in scores[1:]:
        value = np.maximum(value, value.max() - penalty) + row
    return value.max()


def test_short_cut_is_the_full_path():
    draw = np.random.default_rng(3)
    single = 0
    for _ in range(3000):
        n, k = draw.integers(1, 30), draw.integers(1, 5)
        scores = -draw.exponential(draw.choice([0.5, 2.0, 6.0]), (n, k))
        scores -= scores.max(axis=1, keepdims=True)
        labels = language_model.viterbi(scores, 12.0)
        value = scores[np.arange(n), labels].sum() - 12.0 * np.count_nonzero(np.diff(labels))
        assert value == pytest.approx(full_search(scores, 12.0), abs=1e-9)
        single += k > 1 and len(set(labels.tolist())) == 1
    assert 300 < single < 2900


def test_numerals_are_no_letters(spark):
    from pyspark.sql import functions as F

    from tenderlens.llm import language_id, language_model

    model = language_model.fit_counts([("aa", " ab", 3), ("aa", "ab ", 3), ("bb", " xy", 3), ("bb", "xy ", 3)])
    texts = ["½ ² ① Ⅷ", "12 34", "", None, "  ", "ab", "xy xy ab½xy", "ab xy", " ab ab "]
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = docs.select("i", language_id.predict(F.col("t"), model).alias("f")).orderBy("i").collect()
    names = [r["f"]["lang_pred"] for r in got]
    assert names[:5] == ["und"] * 5
    assert names[5:] == ["aa", "bb", "aa", "aa"]  # the tie goes to the name that sorts first
    assert [r["f"]["score"] for r in got[:6]] == [0, 0, 0, 0, 0, 1]


def test_half_of_the_pieces_is_forgotten():
    from tenderlens.llm import language_model

    model = language_model.fit_counts([("aa", " ab", 3), ("bb", " xy", 3)])
    model.remember = 4
    whole = language_model.fit_counts([("aa", " ab", 3), ("bb", " xy", 3)])
    for texts in (["ab xy q", "r s"], ["ab u v", "", "xy w"], ["ab xy"]):
        for a, b in zip(model.look_up(texts), whole.look_up(texts), strict=True):
            assert (model._scores[a] == whole._scores[b]).all() and (model._sizes[a] == whole._sizes[b]).all()
