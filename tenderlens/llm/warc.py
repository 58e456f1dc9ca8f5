"""Web archives of pages: written with segmented records, read back and put together.

Archives are files of bounded size in the shared folder, so that one task reads one file.  A record that
was cut is put together by its origin's identifier: its segments are ordered by number, their
number and total length are checked, and the chunked transfer framing is taken off.
"""

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlens.llm import warc_format
from tenderlens.llm.common import stored, tidy
from tenderlens.sources import shared_folder

_PAGE = "urn:page:"


def _binary(html: Column) -> Column:
    return F.coalesce(html, F.lit("")).cast("binary")


def revisits(pages: DataFrame, least: int = 1000) -> DataFrame:
    """``revisit`` and ``refers_to`` for the ids of pages whose payload another record holds.

    Of payloads of at least ``least`` bytes that are equal, the one with the largest id is the
    response.  Rows with its id, repeated ones too, are responses.
    """
    html = _binary(F.col("html"))
    keys = pages.select("page_id", F.unhex(F.sha1(html)).alias("sha"), F.octet_length(html).alias("size"))
    keys = keys.where(F.col("size") >= least)
    groups = stored(keys.groupBy("sha", "size").agg(F.max("page_id").alias("best"), F.count("*").alias("n"))
                    .where("n > 1").select(F.col("sha").alias("g_sha"), F.col("size").alias("g_size"), "best"))
    same = (F.col("sha") == F.col("g_sha")) & (F.col("size") == F.col("g_size"))
    found = keys.join(groups, same).where("best is not null and not page_id <=> best")
    return found.select("page_id", "sha", F.col("best").alias("refers_to"))


def write_archives(
    pages: DataFrame, path: str, chunk: int = 4096, segment: int = 16384, per_file: int = 1000, least: int = 1000
) -> None:
    """Write ``page_id``, ``url`` and ``html`` of all pages as gzipped archives below ``path``.

    A file has at most ``per_file`` records of at most about ``segment`` bytes.  NULL html is the
    empty payload and a NULL url the empty one; control characters of a url are written as ``%0A``.  Repeated rows
    are records of their own, and NULL ids stay NULL.  Other columns are not read.
    """
    pages = pages.select("page_id", "url", "html")
    other = stored(revisits(pages, least).select(F.col("page_id").alias("r_id"), F.col("sha").alias("r_sha"), "refers_to")
                   .distinct())
    html = _binary(F.col("html"))
    same = F.col("page_id").eqNullSafe(F.col("r_id")) & (F.unhex(F.sha1(html)) == F.col("r_sha"))
    rows = pages.join(other, same, "left").select("page_id", "url", html.alias("payload"), "refers_to")

    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        task, number = TaskContext.get().partitionId(), 0
        for batch in tidy(batches):
            result = []
            for page, url, payload, target in zip(*(c.to_pylist() for c in batch)):
                number += 1
                name = "null" if page is None else page
                refers = None if target is None else f"<{_PAGE}{target}>"
                own = f"<{_PAGE}{name}/{task}-{number}>"
                result.append([*warc_format.written(own, url or "", payload, refers, chunk, segment)])
            yield pa.array(result, pa.list_(pa.binary()))

    made = F.arrow_udf(run, "array<binary>")("page_id", "url", "payload", "refers_to")
    records = rows.select(F.explode(made).alias("record"))
    # A record ends with two line ends; the bytes of a text column are written as they are.
    records.select(F.col("record").cast("string").alias("value")).write.option("compression", "gzip").option(
        "lineSep", "\r\n\r\n").option("maxRecordsPerFile", per_file).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``record_id``, ``fields`` and ``block`` of the whole records of all archives below ``path``.

    Continuations are joined to their origin.  A segment that is missing or repeated, or a
    length that is not the one announced, is an error of the job.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([
            ("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()),
            ("fields", pa.map_(pa.string(), pa.string())), ("block", pa.binary())]))
        for batch in tidy(batches):
            for content in batch:
                found = [
                    {"origin": r.origin, "segment": r.segment, "total": r.total, "fields": list(r.fields.items()),
                     "block": r.block}
                    for r in warc_format.records(gzip.decompress(content.as_py()))
                ]
                yield pa.array([found], kind)

    kind = "array<struct<origin:string,segment:int,total:bigint,fields:map<string,string>,block:binary>>"
    parts = files.select(F.explode(F.arrow_udf(run, kind)("content")).alias("r")).select("r.*")
    whole = parts.where("segment is null").select(F.col("origin").alias("record_id"), "fields", "block")
    segments = parts.where("segment is not null").groupBy("origin").agg(
        F.max("total").alias("total"),
        F.sort_array(F.collect_list(F.struct("segment", F.map_entries("fields").alias("fields"), "block"))).alias("parts"),
    )

    def join(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch in tidy(batches):
            blocks = []
            for origin, total, parts in zip(*batch):
                numbers = [p["segment"].as_py() for p in parts]
                block = b"".join(p["block"].as_py() for p in parts)
                if numbers != list(range(1, len(parts) + 1)) or len(block) != total.as_py():
                    raise ValueError(f"The segments {numbers} of {origin} make {len(block)} bytes of {total}")
                blocks.append(block)
            yield pa.array(blocks, pa.binary())

    block = F.arrow_udf(join, "binary")("origin", "total", F.transform(
        "parts", lambda p: F.struct(p["segment"].alias("segment"), p["block"].alias("block"))))
    joined = segments.select(
        F.col("origin").alias("record_id"), F.map_from_entries(F.col("parts")[0]["fields"]).alias("fields"), block.alias("block"))
    return whole.union(joined)


def page_records(records: DataFrame) -> DataFrame:
    """What whole records say of their pages.

    ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type`` and ``refers_to``.  A payload that
    is not the one its digest field names is an error of the job.
    """

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for fields, blocks in tidy(batches):
            rows = []
            for field, block in zip(fields, blocks):
                field = dict(field.as_py())
                http, payload = warc_format.http_payload(block.as_py())
                named, size = warc_format.bare(field["warc-payload-digest"]), len(payload)
                if field["warc-type"] == "revisit":
                    size = int(http["content-length"])
                elif warc_format.digest(payload) != named:
                    raise ValueError(f"The payload of {field['warc-record-id']} is not the one that was written")
                page = field["warc-record-id"].removeprefix(f"<{_PAGE}").partition("/")[0]
                refers = field.get("warc-refers-to", "").removeprefix(f"<{_PAGE}").rstrip(">")
                rows.append({
                    "page_id": None if page == "null" else int(page), "payload_bytes": size, "payload_digest": named,
                    "record_type": field["warc-type"], "refers_to": int(refers) if refers else None,
                })
            yield pa.array(rows, pa.struct([
                ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                ("record_type", pa.string()), ("refers_to", pa.int64())]))

    kind = "struct<page_id:bigint,payload_bytes:bigint,payload_digest:string,record_type:string,refers_to:bigint>"
    return records.select(F.arrow_udf(run, kind)("fields", "block").alias("page")).select("page.*")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write archives of all pages to the shared folder and tell what reading them back gives."""
    path = shared_folder(pages.sparkSession)
    write_archives(pages, path)
    return page_records(read_archives(pages.sparkSession, path))
