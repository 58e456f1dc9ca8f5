"""Pack documents into as few token sequences as possible.

Texts are tokenized and cut in one pass without a shuffle.  The histogram of piece lengths,
at most ``capacity`` rows, goes to the driver, which plans the sequences; the plan names places by
length and rank within the length.  Pieces get their ranks by counting per length and block, so a
length with a third of all pieces is not one task, and look their place up by binary search.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenderlens.llm import packing_plan, vocabularies
from tenderlens.llm.common import arrow_function, block, blocks_of, stored, tidy

_BLOCK = 1024


def cut_pieces(
    docs: DataFrame, path: str, capacity: int = 2048, end: int = 0, text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keep``, ``piece``, ``start``, ``length`` and ``ids_crc32`` for each piece of a document.

    A document is its ids followed by ``end``; NULL is the empty text and gives one piece of
    one id.  Longer documents are cut into pieces of ``capacity`` ids, of which the
    first takes the rest.
    """

    def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = vocabularies.encoder(path)
        for batch in tidy(batches):
            counts, starts, lengths, sums = [0], [], [], []
            for ids in encoder.ids(batch):
                ids = np.append(ids, end).astype("<u4")
                data, size = memoryview(ids.tobytes()), len(ids)
                edges = [0, *range((size - 1) % capacity + 1, size + 1, capacity)]
                for a, b in zip(edges, edges[1:]):
                    starts.append(a)
                    lengths.append(b - a)
                    sums.append(zlib.crc32(data[4 * a:4 * b]))
                counts.append(len(starts))
            rows = pa.StructArray.from_arrays(
                [pa.array(x, pa.int64()) for x in (starts, lengths, sums)], ["start", "length", "ids_crc32"]
            )
            yield pa.ListArray.from_arrays(pa.array(counts, pa.int32()), rows)

    kind = "array<struct<start:bigint,length:bigint,ids_crc32:bigint>>"
    cut = docs.select(F.struct(*keep).alias("kept"), arrow_function(pieces, kind)(F.col(text)).alias("cut"))
    return cut.select("kept", F.posexplode("cut").alias("piece", "at")).select("kept.*", "piece", "at.*")


def assign(pieces: DataFrame, capacity: int = 2048, tolerance: float = 0.02) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; no sequence holds more than ``capacity``.

    ``pieces`` is a stored table with a column ``length`` from 1 to ``capacity``.  Sequence
    numbers have no gaps.  Equal rows are interchangeable; no rows give no sequences.  At most
    ``tolerance`` of the tokens are packed best fit, the others by the configuration program, unless
    best fit alone needs fewer sequences.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    if not histogram:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("bigint"), "offset": F.lit(0).cast("bigint")})
    slots = packing_plan.plan(histogram, capacity, tolerance)

    # One row per length, so at most ``capacity`` rows; from a list, executors would start more Python workers.
    blocks = spark.createDataFrame(pa.table({
        "p_length": pa.array(list(histogram), pa.int64()),
        "p_blocks": pa.array([-(-count // _BLOCK) for count in histogram.values()], pa.int32()),
    }))
    rows = F.struct(*pieces.columns).alias("row")
    spread = pieces.select(rows).join(F.broadcast(blocks), F.col("row.length") == F.col("p_length"))
    spread = spread.select("row", "p_length", block(F.col("p_blocks"), F.to_json("row")).alias("p_block"))
    sizes = spread.groupBy("p_length", "p_block").count()
    before = Window.partitionBy("p_length").orderBy("p_block").rowsBetween(Window.unboundedPreceding, -1)
    first = stored(sizes.select(
        F.col("p_length").alias("q_length"), F.col("p_block").alias("q_block"),
        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"),
    ))
    within = Window.partitionBy("p_length", "p_block").orderBy("row")
    ranked = spread.select("row", "p_length", "p_block", (F.row_number().over(within) - 1).alias("place"))
    same = (F.col("p_length") == F.col("q_length")) & (F.col("p_block") == F.col("q_block"))
    ranked = ranked.join(first, same).select("row", (F.col("place") + F.col("first")).alias("rank"))

    span = np.int64(1) << 44  # more than any rank
    keys = slots.length * span + slots.rank

    def places(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for length, rank in tidy(batches):
            length, rank = (x.to_numpy(zero_copy_only=False) for x in (length, rank))
            at = np.searchsorted(keys, length * span + rank, side="right") - 1
            sequence = slots.sequence[at] + rank - slots.rank[at]
            yield pa.StructArray.from_arrays(
                [pa.array(sequence, pa.int64()), pa.array(slots.offset[at], pa.int64())], ["sequence_id", "offset"]
            )

    place = arrow_function(places, "struct<sequence_id:bigint,offset:bigint>")
    return ranked.select("row", place("row.length", "rank").alias("place")).select("row.*", "place.*")


def pack(
    docs: DataFrame, path: str, capacity: int = 2048, tolerance: float = 0.02, text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Pieces of all documents with their sequence and place in it.

    One document at least per row of ``docs``, repeated rows and NULL ids included.  Columns
    of ``docs`` beyond ``keep`` and ``text`` are not read, whatever their names.
    """
    pieces = stored(cut_pieces(docs, path, capacity, 0, text, keep))
    return assign(pieces, capacity, tolerance)
