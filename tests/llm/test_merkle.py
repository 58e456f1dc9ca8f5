"""Manifest, proofs and their check against a plain tree."""

import hashlib

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from tenderlens.llm import merkle  # noqa: E402


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    """Root, and the siblings of every node level by level."""
    ways, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 8] for i in range(0, len(nodes), 8)]
        for way, at in zip(ways, places):
            run, k = runs[at // 8], at % 8
            way.append(("".join(run[:k]), "".join(run[k + 1:])))
        nodes, places = [sha("".join(run)) for run in runs], [at // 8 for at in places]
    return nodes[0], ways


def brute(rows):
    """Sorted ``(id, leaf, subroot, root, siblings)`` of rows (id, group, text)."""
    order = sorted({g for _, g, _ in rows}, key=lambda g: (g is not None, (g or "").encode()))
    found, tops = [], []
    for group in order:
        leaves = sorted(((i is not None, i or 0, sha("".join(map(frame, (i, g, t)))), i)
                         for i, g, t in rows if g == group))
        root, ways = tree([leaf for _, _, leaf, _ in leaves])
        tops.append(root)
        found.append([(i, leaf, way) for (_, _, leaf, i), way in zip(leaves, ways)])
    root, ways = tree(tops)
    return sorted(((i, leaf, top, root, "".join(a + b for a, b in [*way, *up]))
                   for part, top, up in zip(found, tops, ways) for i, leaf, way in part), key=repr)


def check(spark, rows):
    docs = spark.createDataFrame([(*r, "n", 1, 2) for r in rows], "doc_id bigint, lang string, text string, node string, at int, tree int")
    cells = [F.col(c) for c in ("doc_id", "lang", "text")]
    changed = F.when(F.col("doc_id") % 3 == 0, merkle.leaf(*cells[:2], F.concat(F.coalesce("text", F.lit("")), F.lit("!"))))
    got = merkle.proofs(docs, merkle.leaf(*cells), presented=changed)
    got = got.withColumn("folded", merkle.folded(F.coalesce("presented", "leaf"), F.col("proof")))
    got = got.withColumn("digest", merkle.proof_digest(F.col("proof"))).collect()
    expected = brute(rows)
    assert sorted(((r["id"], r["leaf"].hex(), r["subroot"].hex(), r["root"].hex(), r["digest"].hex()) for r in got), key=repr) == sorted(
        ((i, leaf, top, root, sha(way)) for i, leaf, top, root, way in expected), key=repr)
    for r in got:
        tampered = r["id"] is not None and r["id"] % 3 == 0 and r["presented"] is not None
        assert (r["folded"] == r["root"]) == (not tampered)


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {"a": 8}, {"a": 9}, {"a": 65, "b": 1, None: 3, "": 2}, {f"g{i}": 1 + i % 3 for i in range(70)},
    {"a": 600, "Z": 64, "é": 7},
])
def test_sizes(spark, sizes):
    rows, i = [], 0
    for group, n in sizes.items():
        for _ in range(n):
            i += 1
            rows.append((i * 7 % 1009, group, f"text {i}" if i % 5 else None))
    check(spark, rows)


def test_ties_nulls_and_repeats(spark):
    check(spark, [(None, "a", "x"), (None, "a", "y"), (1, "a", "x"), (1, "a", "x"), (1, "a", "y"), (2, None, None),
                  (2, "", ""), *[(4, "b", "same")] * 20])


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, lang string, text string")
    assert merkle.proofs(docs, merkle.leaf(F.col("text"))).collect() == []


def test_groups_too_many_to_send(spark, monkeypatch):
    monkeypatch.setattr(merkle, "_BROADCAST_BYTES", 0)
    check(spark, [(i, f"g{i % 3}" if i % 4 else "hot", f"t{i}") for i in range(200)])
