"""The registered queries against plain single-process computations over whole tables."""

import collections
import hashlib
import os
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

import __spark_entry__ as entry  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rows(name):
    return pq.read_table(f"{SF_DIR}/{name}.parquet").to_pylist()


def result(spark, name):
    return [r.asDict() for r in entry.queries()[name](spark, SF_DIR).collect()]


def test_nearest_vectors(spark):
    vectors = {r["vec_id"]: np.array(r["embedding"], float) for r in rows("embeddings")}
    ids = np.array(sorted(vectors))
    matrix = np.stack([vectors[i] for i in ids])
    matrix /= np.linalg.norm(matrix, axis=1)[:, None]
    got = collections.defaultdict(list)
    for r in sorted(result(spark, "op1_nearest_vectors"), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append(r)
    asked = [i for i in ids if i % 50 == 0]
    assert sorted(got) == asked
    hits = 0
    for query in asked:
        scores = matrix @ matrix[np.searchsorted(ids, query)]
        best = [i for _, i in sorted((-s, i) for s, i in zip(scores, ids) if i != query)][:5]
        found = got[query]
        assert [r["rank"] for r in found] == [1, 2, 3, 4, 5]
        assert [(-r["score"], r["vec_id"]) for r in found] == sorted((-r["score"], r["vec_id"]) for r in found)
        for r in found:
            assert r["score"] == pytest.approx(scores[np.searchsorted(ids, r["vec_id"])], abs=1e-12)
        hits += len({r["vec_id"] for r in found} & set(best))
    assert hits >= 0.9 * 5 * len(asked)


def test_token_counts(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r["doc_id"]: r for r in result(spark, "op3_token_counts")}
    for r in rows("documents"):
        n = len(library.encode(r["text"] or "", add_special_tokens=False).ids)
        assert got[r["doc_id"]] == {
            "doc_id": r["doc_id"], "n_bytes": len((r["text"] or "").encode()), "n_tokens": n, "over_limit": n > 2048}


def test_packing(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = result(spark, "op4_best_fit_packing")
    pieces = collections.defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
    for r in rows("documents"):
        ids = np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted(pieces.pop(r["doc_id"]), key=lambda p: p["piece"])
        assert [p["piece"] for p in own] == list(range(len(own)))
        assert all(p["length"] == 2048 for p in own[1:])
        assert own[0]["start"] == 0 and sum(p["length"] for p in own) == len(ids)
        for p in own:
            part = ids[p["start"]:p["start"] + p["length"]]
            assert zlib.crc32(part.tobytes()) == p["ids_crc32"]
    assert not pieces
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    bound = -(-sum(r["length"] for r in got) // 2048)
    assert len(sequences) <= 1.01 * bound + 1


def test_byte_bpe(spark):
    import base64

    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r for r in result(spark, "op5_byte_bpe")}
    for r in rows("documents"):
        text = r["text"] or ""
        ids = library.encode_ordinary(text)
        assert got[r["doc_id"]] == {
            "doc_id": r["doc_id"], "n_tokens": len(ids),
            "ids_sha256": hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            "decoded_sha256": hashlib.sha256(text.encode()).hexdigest()}


def test_language_id_on_held_out_documents(spark):
    truth = {r["doc_id"]: r["lang"] for r in rows("documents")}
    got = result(spark, "op6_language_id")
    assert sorted(r["doc_id"] for r in got) == sorted(truth)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"] and truth[r["doc_id"]]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)


def simhash(text):
    import xxhash

    data = (text or "").encode()
    words = bytes(b + 32 if 65 <= b <= 90 else b for b in data)
    for space in b"\t\n\x0b\x0c\r":
        words = words.replace(bytes([space]), b" ")
    words = [w for w in words.split(b" ") if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def test_simhash(spark):
    fps = {r["doc_id"]: simhash(r["text"]) for r in rows("documents")}
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in fps:
        for j in fps:
            if i < j and (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    expected = {i: (f"{fp:016x}", find(i)) for i, fp in fps.items()}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in result(spark, "op7_simhash")}
    assert got == expected


def test_pipeline(spark):
    """Every stage against its own input, and the last against the whole chain."""
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    by_name = dict(pipeline.STAGES)

    first = by_name["language ID"](spark, docs, SF_DIR)
    assert first.columns == columns
    kept = {r["doc_id"]: r["text"] for r in first.collect()}
    assert all(before[i] == t for i, t in kept.items())
    assert len(kept) >= 0.95 * len(before)

    second = by_name["line dedup"](spark, first, SF_DIR)
    assert second.columns == columns
    rest = {r["doc_id"]: r for r in second.collect()}
    seen, expected = [], {}
    for i in sorted(kept):
        lines = []
        for line in kept[i].split("\n"):
            if not line.strip(" \t\n\x0b\f\r"):
                lines.append(line)
            elif not any(within_one(line, old) for old in seen):
                lines.append(line)
                seen.append(line)
            else:
                seen.append(line)
        expected[i] = "\n".join(lines)
    for i, text in expected.items():
        if i in rest:
            assert rest[i]["text"] == text
            assert rest[i]["n_chars"] == len(text)
        else:
            assert not text.strip()

    third = by_name["SimHash near-dedup"](spark, second, SF_DIR)
    assert third.columns == columns
    one = {r["doc_id"]: r["text"] for r in third.collect()}
    fps = {i: simhash(r["text"]) for i, r in rest.items()}
    for i in rest:
        linked = [j for j in one if (fps[i] ^ fps[j]).bit_count() <= 3]
        assert (i in one) == (linked == [i]) or len(linked) > 1
    last = by_name["best-fit packing"](spark, third, SF_DIR).collect()
    whole = pipeline.run(spark, SF_DIR).collect()
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, last)) == sorted(map(key, whole))
    assert {r["doc_id"] for r in last} == set(one)


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at:] == b[at + 1:]
