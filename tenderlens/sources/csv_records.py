"""CSV records whose quoted fields hold line breaks, read in many tasks per file.

Spark splits a text file at line breaks, but a task that starts in the middle of a file cannot tell whether
its first line is inside a quoted field.  Quotes tell: inside one if an odd number of them came before,
as quotes inside quoted fields are doubled.  So quotes are counted per chunk, a run of at most 4,096 lines
of a split, and the counts of a file are added up, one row per chunk.  Where a chunk begins outside of quoted fields
and no line of it has an odd number of quotes, each line is a record, and stays in the task that reads it;
the numbers of the files' first lines tell which of them are headers.
Only the lines of the other chunks are shuffled, by chunk, and put in order there; the first and the last record
of such a chunk can reach into another one, and these few are put together in a second step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_CHUNK_BITS = 12
_PLACE = ["file", "start", "chunk"]  # of a chunk: its file, its split and its number


def _before(chunks: DataFrame, column: str) -> DataFrame:
    """``chunks`` (a row per chunk) with the sum of ``column`` over the earlier chunks of the file."""
    earlier = Window.partitionBy("file").orderBy("start", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    return chunks.withColumn(f"{column}_before", F.coalesce(F.sum(column).over(earlier), F.lit(0)))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their chunk, their order in it and their number of quotes."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"')))
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"), "value", quotes.cast("bigint").alias("quotes"),
    ).withColumn("chunk", F.shiftright("line", _CHUNK_BITS))


def _chunks(lines: DataFrame) -> DataFrame:
    """A row per chunk: its first line, quotes before it, whether it begins its file, whether each line is a record by itself.

    The filter is always true.  With it every use needs all counts, so the planner counts once and not for each use.
    """
    counts = lines.groupBy(*_PLACE).agg(
        F.sum("quotes").alias("quotes"), F.max(F.col("quotes") % 2).alias("odd"), F.min("line").alias("head"))
    counts = counts.where("quotes >= 0 and odd >= 0 and head >= 0")
    begins = F.col("head") == F.first("head").over(Window.partitionBy("file").orderBy("start", "chunk"))
    return _before(counts, "quotes").select(
        *_PLACE, "head", "quotes_before", begins.alias("begins_file"),
        ((F.col("odd") == 0) & (F.col("quotes_before") % 2 == 0)).alias("plain"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``(first, text)``: the records of all files below ``path``, and whether one is the first of its file.

    Lines end with a line feed, with or without a carriage return before it; line breaks in
    quoted fields stay as they are.  Empty records are left out.
    Quotes must stand in quoted fields only, where they are doubled (RFC 4180).
    """
    lines = _lines(spark, path)
    chunks = _chunks(lines)
    # The numbers of the chunks that need more than their lines, for all tasks: eight bytes for each 4,096 lines at most.
    # A number is one of the whole table; at the edge of two splits it may stand for two chunks.
    broken = F.broadcast(chunks.where(~F.col("plain")).select("chunk").distinct())
    # The first lines of the files, one number for each file.
    heads = F.broadcast(chunks.where("begins_file").select(F.col("head").alias("line"), F.lit(True).alias("first")))
    plain = lines.join(broken, "chunk", "left_anti").join(heads, "line", "left").select(
        F.coalesce("first", F.lit(False)).alias("first"), F.col("value").alias("text"))

    rest = lines.join(broken, "chunk", "left_semi")
    in_order = Window.partitionBy(*_PLACE).orderBy("line")
    earlier = F.sum("quotes").over(in_order) - F.col("quotes") + F.col("quotes_before")
    begins = (earlier % 2 == 0).cast("bigint")
    numbered = (
        rest.join(chunks.drop("plain", "head"), _PLACE)
        .select(*_PLACE, "line", "value", "begins_file", begins.alias("begins"))
        .withColumn("record", F.sum("begins").over(in_order))
    )
    # A record's part in one chunk; the lines before the chunk's first record start have number 0.
    ordered = F.array_sort(F.collect_list(F.struct("line", "value")))
    parts = numbered.groupBy(*_PLACE, "record").agg(
        F.array_join(ordered["value"], "\n").alias("text"), F.max("begins_file").alias("begins_file"))
    parts = parts.withColumn("records", F.max("record").over(Window.partitionBy(*_PLACE)))
    inner = (F.col("record") > 0) & (F.col("record") < F.col("records"))
    # A file's first chunk begins with its first record, which may be the chunk's last one as well.
    first = F.col("begins_file") & (F.col("record") == 1)
    whole = parts.where(inner).select(first.alias("first"), "text")

    # At most two parts of each chunk: the end of an earlier record, and the beginning of the last one.
    # A record that goes on in the next chunk makes that one of these chunks, too.
    edges = parts.where(~inner)
    records = _before(edges.groupBy(*_PLACE).agg(F.max("records").alias("records")), "records")
    place = F.struct("start", "chunk")
    joined = (
        edges.drop("records").join(records.select(*_PLACE, "records_before"), _PLACE)
        .groupBy("file", (F.col("record") + F.col("records_before")).alias("number"))
        .agg(F.max(first).alias("first"), F.array_sort(F.collect_list(F.struct(place.alias("place"), "text"))).alias("all"))
        .select("first", F.array_join(F.col("all")["text"], "\n").alias("text"))
    )
    found = plain.unionByName(whole).unionByName(joined)
    bare = F.when(F.col("text").endswith("\r"), F.regexp_replace("text", "\r$", "")).otherwise(F.col("text"))
    found = found.withColumn("text", bare)
    return found.where(F.col("first") | (F.octet_length("text") > 0))


def read_csv_records(spark: SparkSession, path: str, options: dict) -> DataFrame:
    """A CSV table with a header in each file, every column text, in as many tasks as the files have splits."""
    settings = {**options, "multiLine": True}
    schema = spark.read.options(**settings).csv(path).schema
    if not schema.fields:
        return spark.createDataFrame([], schema)
    columns = ", ".join(f"`{name.replace('`', '``')}` string" for name in schema.names)
    texts = {k: str(v).lower() if isinstance(v, bool) else v for k, v in settings.items() if k != "header"}
    records = csv_records(spark, path).where(~F.col("first"))
    # A generator's output is computed once; fields of a struct would each parse the record again.
    return records.select(F.inline(F.array(F.from_csv("text", columns, texts))))
