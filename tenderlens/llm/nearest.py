"""Approximate nearest neighbours by cross-polytope hashing.

Each table turns unit vectors by three rounds of random signs and a fast Hadamard transform and
assigns them to the nearest signed axis.  A query looks into the buckets of its ``probes`` nearest
axes in every table, and candidates are ranked by their exact cosine.

Equal vectors are put together first, so a vector with a third of all rows is one entry
with the few ids that a result can need.  A bucket is cut into blocks of points and
of queries; each pair of blocks is one group of bounded size and returns a short list per query.
"""

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderlens.llm.common import block, blocks_of, stored


@dataclass(frozen=True)
class Index:
    """Parameters of the search; more tables or probes find more and cost more."""

    tables: int = 4
    probes: int = 28  # of the 128 axes of 64 components; see ``probes_of``
    seed: int = 42
    points: int = 4096  # of a block
    queries: int = 2048  # of a block


@functools.cache
def _signs(tables: int, size: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, size]).choice([-1.0, 1.0], (tables, 3, size))


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of rows whose length is a power of two."""
    size, half = rows.shape[1], 1
    while half < size:
        pairs = rows.reshape(-1, size // (2 * half), 2, half)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(-1, size)
        half *= 2
    return rows / np.sqrt(size)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows with length one; scaled first, so that no square over- or underflows."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def probes_of(index: Index, size: int) -> int:
    """Probes for vectors padded to ``size`` components, out of 2 * ``size`` axes.

    The share that finds as much grows with the width, by a seventh of that at 64 components for each doubling.
    Vectors of fewer components get no fewer probes.
    """
    doublings = max(0, size.bit_length() - 7)
    return min(2 * size, max(index.probes, 2 * size * index.probes * (7 + doublings) // (7 * 128)))


def buckets(rows: np.ndarray, index: Index, probes: int | None = None) -> np.ndarray:
    """The ``probes`` nearest signed axes in every table, nearest first: (row, table, probe)."""
    size = 1 << max(rows.shape[1] - 1, 0).bit_length()
    probes = probes_of(index, size) if probes is None else min(probes, 2 * size)
    padded = np.zeros((len(rows), size))
    padded[:, :rows.shape[1]] = unit(rows)
    found = []
    for signs in _signs(index.tables, size, index.seed):
        turned = padded
        for sign in signs:
            turned = hadamard(turned * sign)
        axes = np.concatenate([turned, -turned], axis=1)
        near = np.argpartition(-axes, probes - 1, axis=1)[:, :probes]
        found.append(near)
    return np.stack(found, axis=1)


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _bucket_column(vector: Column, index: Index, probes: int | None = None) -> Column:
    """Array of (table, axis) of a vector."""

    def run(batches):
        for batch in batches:
            sizes = np.diff(batch.offsets.to_numpy())
            result: list = [None] * len(batch)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                rows = _matrix(batch.take(pa.array(at)), int(size))
                for start in range(0, len(at), 4096):
                    found = buckets(rows[start:start + 4096], index, probes)
                    for i, axes in zip(at[start:start + 4096], found):
                        result[i] = [
                            {"t": t, "axis": int(a)} for t, row in enumerate(axes) for a in row
                        ]
            yield pa.array(result, pa.list_(pa.struct([("t", pa.int32()), ("axis", pa.int32())])))

    return F.arrow_udf(_typed(run), "array<struct<t:int,axis:int>>")(vector)


def _typed(run):
    from collections.abc import Iterator

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return run


_ANSWER = "qh1 bigint, qh2 bigint, found bigint, score double"


def _rank_block(k: int):
    """For two blocks: the ``k`` best ids of each query, by cosine, ties to the smaller id."""

    def run(points: pa.Table, queries: pa.Table) -> pa.Table:
        empty = pa.table({n: pa.array([], t) for n, t in (
            ("qh1", pa.int64()), ("qh2", pa.int64()), ("found", pa.int64()), ("score", pa.float64()))})
        if not points.num_rows or not queries.num_rows:
            return empty
        size = points.column("size")[0].as_py()
        p, q = _matrix(points.column("v"), size), _matrix(queries.column("v"), size)
        pu, qu = unit(p), unit(q)
        ids = points.column("ids").to_pylist()
        first = np.array([i[0] for i in ids])
        out: list[tuple[int, int, float]] = []
        for start in range(0, len(q), 256):
            scores = qu[start:start + 256] @ pu.T
            cut = min(k, len(p)) - 1
            least = -np.partition(-scores, cut, axis=1)[:, cut]
            for row, floor in enumerate(least):
                near = np.flatnonzero(scores[row] >= floor - 1e-12)
                # summed in the same order for each pair, whatever block it is in
                exact = np.einsum("ij,j->i", pu[near], qu[start + row])
                near = near[np.lexsort((first[near], -exact))]
                exact = -np.sort(-exact)
                best = sorted((-s, i) for s, at in zip(exact[:4 * k].tolist(), near[:4 * k].tolist()) for i in ids[at])
                out += [(start + row, i, -s) for s, i in best[:k]]
        at = pa.array([o[0] for o in out], pa.int64())
        return pa.table({
            "qh1": queries.column("qh1").take(at), "qh2": queries.column("qh2").take(at),
            "found": pa.array([o[1] for o in out], pa.int64()), "score": pa.array([o[2] for o in out], pa.float64()),
        })

    return run


def _compare(points: DataFrame, queries: DataFrame, index: Index, k: int) -> DataFrame:
    """The short lists of all queries from the groups (size, t, axis) that both sides share.

    ``sizes`` has a row for each bucket of each table and vector size, not more.
    """
    keys = ["size", "t", "axis"]
    counted = points.groupBy(*keys).agg(F.count("*").alias("np")).join(
        queries.groupBy(*keys).agg(F.count("*").alias("nq")), keys)
    sizes = stored(counted.select(
        *[F.col(c).alias(f"s_{c}") for c in keys], blocks_of(F.col("np"), index.points).alias("np"),
        blocks_of(F.col("nq"), index.queries).alias("nq")))
    same = [F.col(c) == F.col(f"s_{c}") for c in keys]
    span = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt_points = points.join(F.broadcast(sizes), same).select(
        *keys, block(F.col("np"), F.col("v")).alias("pb"), span("nq").alias("qb"), "ids", "v")
    dealt_queries = queries.join(F.broadcast(sizes), same).select(
        *keys, span("np").alias("pb"), block(F.col("nq"), F.col("v")).alias("qb"), "qh1", "qh2", "v")
    groups = [*keys, "pb", "qb"]
    return dealt_points.groupBy(*groups).cogroup(dealt_queries.groupBy(*groups)).applyInArrow(
        _rank_block(k), _ANSWER)


def _best(answers: DataFrame, k: int) -> DataFrame:
    each = answers.groupBy("qh1", "qh2", "found").agg(F.max("score").alias("score"))
    order = Window.partitionBy("qh1", "qh2").orderBy(F.desc("score"), "found")
    return each.select("*", F.row_number().over(order).alias("n")).where(F.col("n") <= k).drop("n")


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, index: Index = Index(),
    vector: str = "embedding", id_column: str = "vec_id",
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of the ``k`` nearest rows found.

    ``is_query`` says over the columns of ``vectors`` which rows ask.  Nearness is the cosine in
    double precision, ties go to the smaller id, and the rows with the query's own id do not answer.  Rows
    that repeat id and vector count once.  Vectors that are NULL, empty, zero or hold NULL or
    non-finite components, and rows with a NULL id, take no part; vectors of different lengths do not
    meet.  Where the buckets hold fewer than ``k`` answers and there are more rows, the query is compared
    with all of them in blocks.  No rows, or no queries, give no rows.
    """
    doubles = F.transform(vector, lambda x: x.cast("double") + F.lit(0.0))  # -0.0 becomes 0.0
    rows = vectors.select(F.col(id_column).cast("bigint").alias("id"), doubles.alias("v"),
                          F.coalesce(is_query, F.lit(False)).alias("asks"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where("id is not null and v is not null").where(finite & F.exists("v", lambda x: x != 0.0))
    rows = rows.groupBy("id", "v").agg(F.max("asks").alias("asks"))

    smallest = Window.partitionBy("v").orderBy("id")
    points = rows.select("id", "v", F.row_number().over(smallest).alias("n")).where(F.col("n") <= k + 1)
    points = stored(points.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
                    .select("v", "ids", F.size("v").alias("size")))
    asking = stored(rows.where("asks").select(
        F.col("id").alias("query_id"), "v", F.xxhash64("v").alias("qh1"), F.xxhash64(F.lit(7), "v").alias("qh2")))
    queries = stored(asking.groupBy("qh1", "qh2").agg(F.first("v").alias("v"))
                     .select("qh1", "qh2", "v", F.size("v").alias("size")))

    in_table = points.select("size", "ids", "v", F.explode(_bucket_column(F.col("v"), index, 1)).alias("at"))
    probed = queries.select("size", "qh1", "qh2", "v",
                            F.explode(_bucket_column(F.col("v"), index)).alias("at"))
    in_table = in_table.select("size", "at.t", "at.axis", "ids", "v")
    probed = probed.select("size", "at.t", "at.axis", "qh1", "qh2", "v")
    found = stored(_best(_compare(in_table, probed, index, k + 1), k + 1))

    reached = found.groupBy(F.col("qh1").alias("f1"), F.col("qh2").alias("f2")).agg(F.count("*").alias("n"))
    there = points.groupBy(F.col("size").alias("of")).agg(F.sum(F.size("ids")).alias("there"))  # a row per size
    short = queries.join(reached, (F.col("qh1") == F.col("f1")) & (F.col("qh2") == F.col("f2")), "left").join(
        there, F.col("size") == F.col("of"))
    short = stored(short.where(F.coalesce("n", F.lit(0)) < F.least(F.lit(k + 1), "there"))
                   .select("size", "qh1", "qh2", "v", F.lit(-1).alias("t"), F.lit(0).alias("axis")))
    if not short.isEmpty():
        everything = points.select("size", "ids", "v", F.lit(-1).alias("t"), F.lit(0).alias("axis"))
        found = found.union(stored(_compare(everything, short, index, k + 1)))
        found = stored(_best(found, k + 1))
    found = found.select(F.col("qh1").alias("f1"), F.col("qh2").alias("f2"), "found", "score")
    answers = asking.select("query_id", "qh1", "qh2").join(
        found, (F.col("qh1") == F.col("f1")) & (F.col("qh2") == F.col("f2"))).where("found != query_id")
    order = Window.partitionBy("query_id", "qh1", "qh2").orderBy(F.desc("score"), "found")
    ranked = answers.select("query_id", F.row_number().over(order).alias("rank"), F.col("found").alias("vec_id"), "score")
    return ranked.where(F.col("rank") <= k)
