"""Token counts of whole texts.

Texts reach the libraries in Arrow batches and only lengths return.  Inside a task, texts
are grouped to batches of about equal size in bytes, and a text longer than a batch is cut at
boundaries where its vocabulary never merges.  There is no shuffle.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlens.llm.common import tidy
from tenderlens.llm import vocabularies


def token_count(text: Column, path: str) -> Column:
    """Number of tokens that the library of ``path`` makes of a text.

    No begin, end or added special tokens; special strings inside a text are handled as by
    the library's default.  NULL counts as the empty text, which has no tokens.
    """

    def lengths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = vocabularies.encoder(path)
        for batch in tidy(batches):
            yield pa.array(encoder.lengths(batch), pa.int64())

    return F.arrow_udf(lengths, "bigint")(text)


def count_tokens(
    docs: DataFrame, path: str, limit: int = 2048, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep`` with ``n_bytes``, ``n_tokens`` and whether a text is longer than ``limit``.

    One row per row of ``docs``, repeated rows and rows with NULL ids included; NULL texts
    count as empty; other columns of ``docs``, whatever their names, are not read.
    """
    counted = docs.select(
        F.struct(*keep).alias("kept"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"),
        token_count(F.col(text), path).alias("n_tokens"),
    )
    return counted.select("kept.*", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
