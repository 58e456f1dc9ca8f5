"""Exact duplicates by progressive refinement, with built-in functions only.

Rows are grouped by length, then by a hash of their first characters, then by the SHA-256 of the
whole text, and only rows that share a group go on to the next step.  Every step moves a few
numbers per row, never a text.  Groups are counted before the shuffle, so a group with a
third of all rows is a counter in each task.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlens.llm.common import ascii_lower, stored

_PREFIX = 64  # characters of the second step


def exact_duplicates(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` for every row of ``docs``.

    Texts are equal when they are identical after lower-casing A-Z; NULL is the empty text.  The
    row with the largest id stays; NULL ids are smaller than all others, and of rows that repeat
    the id one stays.  No rows give no rows; other columns are not read.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    source = docs.select(F.col(id_column).alias("id"), whole.alias("t"))

    size = F.octet_length("t").alias("size")
    sizes = stored(source.select(size).groupBy("size").count().where("count > 1").select(F.col("size").alias("s")))
    head = F.xxhash64(ascii_lower(F.substring("t", 1, _PREFIX))).alias("head")
    heads = source.select(size, head).join(sizes, F.col("size") == F.col("s"), "left_semi")
    heads = stored(heads.groupBy("size", "head").count().where("count > 1")
                   .select(F.col("size").alias("s"), F.col("head").alias("h")))

    # The digest belongs to the result of every row, so it is taken while the text is at hand.
    digest = F.unhex(F.sha2(ascii_lower(F.col("t")), 256)).alias("digest")
    rows = stored(source.select("id", size, head, digest).groupBy("id", "size", "head", "digest").count())
    same = (F.col("size") == F.col("s")) & (F.col("head") == F.col("h"))
    groups = stored(
        rows.join(heads, same, "left_semi").groupBy("digest")
        .agg(F.sum("count").alias("group_size"), F.max("id").alias("keep_id"))
        .where("group_size > 1").withColumnRenamed("digest", "d")
    )
    grouped = rows.join(groups, F.col("digest") == F.col("d"), "left")
    copies = grouped.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), "count")).alias("copy"))
    keep = F.when(F.col("d").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return copies.select(
        "id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        ((F.col("copy") == 1) & F.col("id").eqNullSafe(keep)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
