"""The filter audit against plain counting, and its parts alone."""

import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from tenderlens.llm import filter_audit  # noqa: E402

LETTERS = "ABCDE"


def failed(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        letter for letter, fails in {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
        }.items() if fails}


def brute(docs, labels):
    texts = [(i, t or "", p or "", failed(t or "")) for i, t, p in docs]
    for i, t, _, fails in texts:
        if i is not None and any(j is not None and j < i and u == t for j, u, _, _ in texts):
            fails.add("E")
    marks = {}
    for i, q, t in labels:
        good, toxic = marks.get(i, (False, False))
        marks[i] = (good or q == 1, toxic or t == 1)
    rows = {}
    for part in {p for _, _, p, _ in texts}:
        mine = [(marks.get(i, (False, False)) if i is not None else (False, False), f)
                for i, _, p, f in texts if p == part]
        shapley = dict.fromkeys(LETTERS, 0)
        for order in itertools.permutations(LETTERS):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [m for m in left if letter in m[1]]
                left = [m for m in left if letter not in m[1]]
                fails = [m for m in mine if letter in m[1]]
                shapley[letter] += len(gone)
                rows[part, "".join(order), step] = [
                    len(left), len(gone), len(fails) - len(gone), sum(m[1] == {letter} for m in mine),
                    sum(m[0][0] for m in gone), sum(m[0][1] for m in gone)]
        for (p, order, step), row in rows.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in rows.items()}


LONG = " ".join(f"w{i}" for i in range(300))
DOCS = [
    (1, LONG, "en"), (2, LONG, "en"), (3, LONG, None), (None, LONG, "en"), (4, None, "en"), (5, "", ""), (5, "", ""),
    (6, "AB # c", "de"), (7, "x " * 400, "de"), (8, LONG.upper(), "de"), (9, f"{LONG} é\x85\xa0 $", "en"),
    (10, "\x1c".join("ab" * 5) + "\x0b\x0cq", "en"), (11, LONG, "en"), (11, "other", "en"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (3, None, 1), (3, 1, None), (6, 1, 1), (None, 1, 1), (99, 1, 1), (7, 0, 0)]


def test_against_counting(spark):
    docs = spark.createDataFrame(
        [(*d, "x", "y", 1) for d in DOCS],
        "doc_id bigint, text string, lang string, part string, digest string, repeat int")
    labels = spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")
    got = filter_audit.audit_documents(docs, labels)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                           "good_lost", "toxic_lost", "shapley"]
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got.collect()} == brute(DOCS, LABELS)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit_documents(docs, labels).collect() == []
    docs = spark.createDataFrame([(1, None, None)], "doc_id bigint, text string, lang string")
    assert filter_audit.audit_documents(docs, labels).count() == 600


def test_long_text_is_cut_between_words(monkeypatch):
    text = ("Ab cd\tef\n" * 50 + "g" * 100).encode()
    whole = filter_audit.text_failures(text)
    monkeypatch.setattr(filter_audit, "_CHUNK", 7)
    assert [w for words in filter_audit._words(text) for w in words] == text.split()
    assert filter_audit.text_failures(text) == whole


def test_truth_tables():
    words = filter_audit.survival_words(np.arange(32))
    for mask in range(32):
        for subset in range(32):
            assert bool(words[mask] >> subset & 1) == (mask & subset == 0)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 193, 5000])
def test_popcount(n):
    words = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
    assert filter_audit.positional_popcount(words).tolist() == [int((words >> i & 1).sum()) for i in range(32)]


def test_many_parts_in_one_task(spark, monkeypatch):
    rows = spark.range(0, 9000, 1, 2).select(
        F.col("id").cast("string").alias("part"), F.lit(1).alias("failures"), (F.col("id") % 2 == 0).alias("good"))
    got = filter_audit.subset_survivors(rows, ["good"])
    assert got.count() == 9000
    assert got.agg(F.sum(F.get("everything", F.lit(0))), F.sum(F.get("everything", F.lit(1))),
                   F.sum(F.get("good", F.lit(2)))).first() == (9000, 0, 4500)
