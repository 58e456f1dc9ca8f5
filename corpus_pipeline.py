"""From raw documents to packed training sequences, one stored table per stage.

Every stage takes (spark, docs, sf_dir) and works on all documents that the one before kept.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlens.llm import language_id, line_dedup, packing, simhash
from tenderlens.llm.common import small_batches, stored, table

LEAST_SHARE = 0.5  # of a text's letters in its main language


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language: those without letters or without a majority go."""
    small_batches(spark)
    model = language_id.fit(docs, F.lit(True))
    row = docs.select(F.struct("*").alias("row"))
    found = row.select("row", language_id.predict(F.col("row.text"), model).alias("found"))
    accepted = (F.col("found.lang_pred") != language_id.UNKNOWN) & (F.col("found.score") >= LEAST_SHARE)
    return found.where(accepted).select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier one; those that lose every line go."""
    small_batches(spark)
    others = F.struct(*[c for c in docs.columns if c != "text"])  # the text travels once
    done = line_dedup.dedup_lines(docs.select(others.alias("row"), "doc_id", "text"))
    done = done.where("n_lines = 0 or n_removed < n_lines")
    columns = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    return done.select(*[columns.get(c, F.col(f"row.{c}")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints are linked."""
    small_batches(spark)
    return simhash.one_of_each(docs, size=3, radius=3)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents in sequences of 2048 tokens."""
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language ID", language), ("line dedup", lines), ("SimHash near-dedup", near_duplicates),
          ("best-fit packing", packed)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
