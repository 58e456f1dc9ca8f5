"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints differ in at most ``radius`` bits.  Every bit position gets a code of
``radius + 1`` bits; for each non-zero vector v of that many bits there is a table whose
mask holds the positions with an odd inner product of code and v.  For any ``radius`` positions some v is
orthogonal to all their codes, so two fingerprints within the radius agree on that
table's whole mask: no pair is missed.

Equal fingerprints are put together first.  A large bucket is cut into blocks, and each pair of
blocks is one group of bounded size that returns a spanning forest of its links.
"""

import functools
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderlens.llm.common import block, blocks_of, stored, tidy
from tenderlens.llm.components import components

_SEED = 42
_RUN = 1 << 15  # shingles that are counted at once


def masks(radius: int = 3, seed: int = 7) -> list[int]:
    """The masks of all tables, as signed 64-bit integers."""
    draw = random.Random(seed)
    codes = [draw.randrange(1, 1 << (radius + 1)) for _ in range(64)]
    found = []
    for vector in range(1, 1 << (radius + 1)):
        mask = sum(1 << i for i, code in enumerate(codes) if (code & vector).bit_count() & 1)
        found.append(mask - (1 << 64) if mask >> 63 else mask)
    return found


def fingerprint_of(text: str, size: int = 3) -> int:
    """Unsigned fingerprint of a text; see ``fingerprint``."""
    words = text.encode("utf-8").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    digest = functools.partial(xxhash.xxh64_intdigest, seed=_SEED)
    if len(words) <= size:
        hashes, n = [digest(joined)], 1
        return hashes[0]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - size + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _RUN):
        a, b = starts[at:min(at + _RUN, n)].tolist(), ends[at + size - 1:at + size - 1 + _RUN].tolist()
        hashes = np.fromiter((digest(joined[x:y]) for x, y in zip(a, b)), np.uint64, len(a))
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(ones * 2 > n).tolist()))


def fingerprint(text: Column, size: int = 3) -> Column:
    """SimHash of a whole text as a signed 64-bit integer.

    A-Z become lower case, words are what stands between ASCII white space, shingles are ``size`` words
    joined by spaces, repeats included.  A bit is 1 if it is set in more than half of the
    shingles' XXH64 values.  Fewer words make one shingle; NULL and texts without words give 0.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in tidy(batches):
            found = np.fromiter((fingerprint_of(t.as_py() or "", size) for t in batch), np.uint64, len(batch))
            yield pa.array(found.view(np.int64), pa.int64())

    return F.arrow_udf(run, "bigint")(text)


def _forest(values: np.ndarray, sides: np.ndarray, same: bool, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links inside a block, or between two blocks."""
    root = list(range(len(values)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []
    left = np.arange(len(values)) if same else np.flatnonzero(sides == 0)
    right = np.arange(len(values)) if same else np.flatnonzero(sides == 1)
    for start in range(0, len(left), 256):
        rows = left[start:start + 256]
        near = np.bitwise_count(values[rows][:, None] ^ values[right][None, :]) <= radius
        for i, j in zip(*np.nonzero(near)):
            a, b = find(int(rows[i])), find(int(right[j]))
            if a != b:
                root[b] = a
                links.append((int(rows[i]), int(right[j])))
    return links


def links(values: DataFrame, radius: int = 3, size: int = 1024) -> DataFrame:
    """Links (a, b) with the same components as all pairs of ``fp`` within ``radius`` bits.

    ``values`` is a stored table of distinct fingerprints.  Buckets hold at most ``size``
    fingerprints per block, about, and every pair of blocks of a bucket is compared.
    """
    tables = F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for t, m in enumerate(masks(radius))
    ])
    rows = values.select("fp", F.explode(tables).alias("at")).select("at.t", "at.key", "fp")
    shared = stored(rows.groupBy("t", "key").count().where("count > 1"))
    shared = shared.select(F.col("t").alias("st"), F.col("key").alias("skey"), blocks_of(F.col("count"), size).alias("n"))
    member = rows.join(shared, (F.col("t") == F.col("st")) & (F.col("key") == F.col("skey"))).select(
        "t", "key", "fp", "n", block(F.col("n"), F.col("fp")).alias("own")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("n") - 1))
    paired = member.select("t", "key", "fp", "own", other.alias("other")).select(
        "t", "key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
        F.struct((F.col("own") > F.col("other")).cast("int").alias("side"), "fp").alias("item"),
    )
    groups = paired.groupBy("t", "key", "x", "y").agg(F.collect_list("item").alias("items"))

    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for x, y, items in tidy(batches):
            counts, a, b = [0], [], []
            for same, group in zip((p == q for p, q in zip(x.to_pylist(), y.to_pylist())), items):
                flat = group.values
                fps = flat.field("fp").to_numpy(zero_copy_only=False)
                sides = flat.field("side").to_numpy(zero_copy_only=False)
                for i, j in _forest(fps.view(np.uint64), sides, same, radius):
                    a.append(int(fps[i]))
                    b.append(int(fps[j]))
                counts.append(len(a))
            found = pa.StructArray.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
            yield pa.ListArray.from_arrays(pa.array(counts, pa.int32()), found)

    found = F.arrow_udf(run, "array<struct<a:bigint,b:bigint>>")("x", "y", "items")
    return groups.select(F.explode(found).alias("link")).select("link.a", "link.b")


def near_duplicates(
    docs: DataFrame, size: int = 3, radius: int = 3, text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """``id``, ``fp`` and ``component_id`` for every row of ``docs``.

    Documents are linked if their fingerprints differ in at most ``radius`` bits; the component is
    named by its smallest id.  Rows with a NULL id take part, and a component of such rows alone has
    no name.  Repeated rows stay.  Other columns are not read.
    """
    return _grouped(docs, size, radius, text, id_column).select("id", "fp", "component_id")


def _grouped(docs: DataFrame, size: int, radius: int, text: str, id_column: str) -> DataFrame:
    """As ``near_duplicates``, with a hash ``th`` of the text and the component's fingerprint ``of``."""
    rows = stored(docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("th"),
                              fingerprint(F.col(text), size).alias("fp")))
    values = stored(rows.groupBy("fp").agg(F.min("id").alias("first")))
    linked = components(links(values, radius))
    rooted = stored(values.join(linked, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    ))
    names = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id")))
    named = stored(rooted.select("fp", F.col("root").alias("of")).join(names, F.col("of") == F.col("root"))
                   .select(F.col("fp").alias("nfp"), "of", "component_id"))
    return rows.join(named, F.col("fp") == F.col("nfp")).select("id", "th", "fp", "of", "component_id")


def one_of_each(
    docs: DataFrame, size: int = 3, radius: int = 3, text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each near-duplicate group stays.

    That is the one with the smallest id; of rows of the group that repeat this id, the one whose text has the
    least hash.  Rows with a NULL id stay, since nothing names them.
    """
    found = _grouped(docs, size, radius, text, id_column).where("id is not null")
    stay = stored(found.groupBy("of").agg(F.min(F.struct("id", "th")).alias("stay")).select("stay.*"))
    rows = docs.select(F.struct("*").alias("row"))
    own_id, own_hash = F.col(f"row.{id_column}"), F.xxhash64(f"row.{text}")
    kept = rows.join(stay, (own_id == F.col("id")) & (own_hash == F.col("th")), "left_semi")
    first = Window.partitionBy(own_id, own_hash).orderBy(F.col(f"row.{text}"))
    kept = kept.select("row", F.row_number().over(first).alias("n")).where("n = 1").select("row.*")
    return kept.union(docs.where(F.col(id_column).isNull()))
