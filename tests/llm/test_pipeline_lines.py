"""The line stage of the pipeline: whole rows as before, with each text sent to the join once."""

import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline as pipeline  # noqa: E402
from tenderlens.llm import line_dedup  # noqa: E402

SCHEMA = "lang string, text string, doc_id bigint, n_chars bigint, n_lines int, row string, n_removed int"
ROWS = [
    ("en", "alpha beta\n\nalpha bets\ngamma delta", 1, 99, 7, "r", 8), ("de", "gamma delta\nomega", 2, 99, 7, None, 8),
    (None, "alpha beta", 3, 99, 7, "r", 8), ("en", None, 4, 99, None, "r", 8), ("en", "", 5, 99, 7, "r", None),
    ("en", "psi chi phi", None, 99, 7, "r", 8), ("en", "omega zeta", 6, 99, 7, "r", 8), ("fr", "omega zeta", 6, 99, 7, "r", 8),
]


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("columns", [SCHEMA.replace(",", "").split()[::2], ["doc_id", "text"], ["text", "doc_id"]], ids=len)
def test_rows_stay_whole(spark, columns):
    docs = spark.createDataFrame(ROWS, SCHEMA).select(columns)
    left = {1: "alpha beta\n\ngamma delta", 2: "omega", 4: None, 5: "", None: "psi chi phi", 6: "omega zeta"}
    whole = [dict(zip(SCHEMA.replace(",", "").split()[::2], row)) for row in ROWS if row[2] != 3]
    for row in whole:
        row["text"] = left[row["doc_id"]]
        row["n_chars"] = None if row["text"] is None else len(row["text"])
    done = pipeline.lines(spark, docs, "")
    assert [(f.name, f.dataType) for f in done.schema] == [(f.name, f.dataType) for f in docs.schema]
    assert _rows(done) == sorted((tuple(row[c] for c in columns) for row in whole), key=str)


def _texts(kind):
    """How many columns and fields named ``text`` a schema has."""
    return sum((f.name == "text") + (_texts(f.dataType) if hasattr(f.dataType, "fields") else 0) for f in kind.fields)


def test_a_text_is_sent_once(spark, monkeypatch):
    given, whole = [], line_dedup.dedup_lines
    monkeypatch.setattr(line_dedup, "dedup_lines", lambda docs: given.append(docs.schema) or whole(docs))
    assert pipeline.lines(spark, spark.createDataFrame(ROWS, SCHEMA), "").count() == len(ROWS) - 1
    assert [_texts(schema) for schema in given] == [1]
