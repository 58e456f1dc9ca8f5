"""Nulls, empty tables, repeated rows and clashing names, for every operator on documents."""

import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from pyspark.sql import functions as F  # noqa: E402

from tenderlens.llm import (  # noqa: E402
    byte_bpe, exact_dedup, language_id, line_dedup, nearest, packing, simhash, token_counts, url_rules, vocabularies,
    warc,
)

SCHEMA = "doc_id bigint, text string, lang string, id string, key string, row string, n_lines int"
ROWS = [
    (1, "Alpha beta gamma\n\nAlpha beta gamme", "en", "a", "k", "r", 1),
    (2, None, None, None, None, None, None), (3, "", "en", "a", "k", "r", 1),
    (None, "alpha beta gamma", "en", "a", "k", "r", 1),
    (4, "Alpha beta gamma", "en", "a", "k", "r", 1), (4, "Alpha beta gamma", "en", "a", "k", "r", 1),
    (5, "12 34", "en", "a", "k", "r", 1),
]


@pytest.fixture(params=["rows", "empty"])
def docs(spark, request):
    return spark.createDataFrame(ROWS if request.param == "rows" else [], SCHEMA)


@pytest.fixture
def n(docs):
    return docs.count()


def test_every_row_is_answered(docs, n):
    assert token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json")).count() == n
    bpe = public_tokenizers.path("byte_bpe_50k.tiktoken")
    assert byte_bpe.encode_decode(docs, bpe, public_tokenizers.PATTERN).count() == n
    assert packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).count() == n
    assert simhash.near_duplicates(docs).count() == n


def test_exact(docs, n):
    got = exact_dedup.exact_duplicates(docs).collect()
    assert len(got) == n
    if n:
        assert sorted((r["id"] or 0, r["keep_id"], r["group_size"], r["kept"]) for r in got) == [
            (0, 4, 3, False), (1, 1, 1, True), (2, 3, 2, False), (3, 3, 2, True),
            (4, 4, 3, False), (4, 4, 3, True), (5, 5, 1, True)]


def test_lines(docs, n):
    got = line_dedup.dedup_lines(docs)
    assert got.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_removed"]
    got = got.collect()
    assert len(got) == n
    if n:
        assert sorted((r["doc_id"] or 9, r["text"] or "", r["n_lines"], r["n_removed"]) for r in got) == [
            (1, "Alpha beta gamma\n", 2, 1), (2, "", 0, 0), (3, "", 0, 0), (4, "", 1, 1), (4, "", 1, 1),
            (5, "12 34", 1, 0), (9, "", 1, 1)]


def test_language(docs, n):
    model = language_id.fit(docs, F.lit(True))
    got = docs.select("doc_id", language_id.predict(F.col("text"), model).alias("p")).select("doc_id", "p.*").collect()
    assert len(got) == n
    assert {r["doc_id"] for r in got if r["lang_pred"] == "und"} == ({2, 3, 5} if n else set())


def test_one_of_each(docs, n):
    got = [r["doc_id"] for r in simhash.one_of_each(docs).collect()]
    if n:
        assert got.count(4) <= 1 and None in got and 2 in got and 3 not in got


def test_vectors(spark):
    schema = "vec_id bigint, embedding array<float>, v string, ids string"
    nan = float("nan")
    table = [(0, [1.0, 0.0], "", ""), (1, [1.0, 0.0], "", ""), (2, [0.0, 1.0], "", ""), (2, [0.0, 1.0], "", ""),
             (3, None, "", ""), (4, [0.0, 0.0], "", ""), (5, [nan, 1.0], "", ""), (6, [None, 1.0], "", ""),
             (None, [1.0, 1.0], "", ""), (7, [], "", "")]
    got = nearest.nearest(spark.createDataFrame(table, schema), F.col("vec_id") == 0).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 1.0), (0, 2, 2, 0.0)]
    assert nearest.nearest(spark.createDataFrame([], schema), F.lit(True)).count() == 0


def test_urls(spark):
    rules = spark.createDataFrame([("a.b", "/x", "block"), ("b", "/", "allow"), (None, "/", "block")],
                                  "host string, path string, verdict string")
    table = [(1, "http://A.b/x/1", "h"), (1, "http://A.b/x/1", "h"), (2, None, "h"), (3, "no", "h"), (None, "x://b/y?z", "h"),
             (4, "x://ca.b/x", "h")]
    urls = spark.createDataFrame(table, "page_id bigint, url string, host string")
    got = sorted(((r["page_id"] or 0), r["host"], r["path"], r["rule"] or "", r["verdict"])
                 for r in url_rules.judge(urls, rules).collect())
    assert got == [(0, "b", "/y", "b/", "allow"), (1, "a.b", "/x/1", "a.b/x", "block"), (1, "a.b", "/x/1", "a.b/x", "block"),
                   (2, "", "", "", "allow"), (3, "", "", "", "allow"), (4, "ca.b", "/x", "b/", "allow")]
    assert url_rules.judge(urls.limit(0), rules).count() == 0
    assert url_rules.judge(urls, rules.limit(0)).where("verdict = 'allow'").count() == 6


def test_archives(spark):
    long = "é" * 40_000
    table = [(1, "u", long), (2, "u", long), (2, "u", long), (3, None, None), (None, "u", long), (4, "u", "short"), (5, "u", "short")]
    pages = spark.createDataFrame(table, "page_id bigint, url string, html string")
    got = sorted(((r["page_id"] or 0), r["payload_bytes"], r["record_type"], r["refers_to"])
                 for r in warc.round_trip(pages).collect())
    assert got == [(0, 80_000, "revisit", 2), (1, 80_000, "revisit", 2), (2, 80_000, "response", None),
                   (2, 80_000, "response", None), (3, 0, "response", None), (4, 5, "response", None), (5, 5, "response", None)]
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_segments_of_long_texts():
    """A text that is cut to segments has the ids of the whole text, special strings included."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, encoder = Tokenizer.from_file(path), vocabularies.encoder.__wrapped__(path)
    encoder._batch = 40
    special = next(iter(library.get_added_tokens_decoder().values())).content
    texts = [None, "", " ", "a" * 300, "  two  spaces " * 20, "né à l'été, it's 12345 \n\n\t x" * 15,
             f"before {special} after " * 9, "語 の 文 " * 40, "᠎ \u0085   end " * 12]
    expected = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    given = pa.array(texts, pa.string())
    assert [ids.tolist() for ids in encoder.ids(given)] == expected
    assert encoder.lengths(given) == [len(ids) for ids in expected]
