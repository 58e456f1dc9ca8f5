"""One document of each group stays where an id repeats with different texts."""

import pytest

pytest.importorskip("public_tokenizers")

from tenderlens.llm import simhash  # noqa: E402


def test_repeated_ids(spark):
    words = "one two three four five six seven eight nine ten"
    others = [f"w{i} x{i} y{i} z{i} v{i}" for i in range(6)]
    table = [(3, words), (5, words), *[(5, text) for text in others], (5, others[0])]
    got = [tuple(r) for r in simhash.one_of_each(spark.createDataFrame(table, "doc_id bigint, text string")).collect()]
    assert sorted(got) == sorted([(3, words), *[(5, text) for text in others]])
