"""Helpers that the operators share."""

import ctypes
import string
from collections.abc import Callable, Iterable, Iterator
from typing import TypeVar

import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlens.sources import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the shared folder.

    This cuts the lineage: whatever executor is lost later, the rows are read again and
    not computed again, and a value that hangs on the partitioning keeps its first form.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a table that ``stored`` wrote and nothing reads any more."""
    spark = df.sparkSession
    for path in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is.

    A text without other characters takes the faster general function.
    """
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def blocks_of(rows: Column, size: int) -> Column:
    """How many blocks of about ``size`` rows hold ``rows`` rows, one at least."""
    return F.greatest(F.lit(1), F.ceil(rows / F.lit(size))).cast("int")


def block(blocks: Column, *key: Column) -> Column:
    """The block of a row, by a hash of its key."""
    return F.pmod(F.xxhash64(F.lit(17), *key), blocks).cast("int")


def arrow_function(run: Callable, kind: str) -> Callable[..., Column]:
    """An Arrow function that a plan evaluates once for each row.

    Spark copies a deterministic one into every filter that it moves below it, also into those
    that ``explode`` brings along, and so would start a second worker that does the work again.
    """
    return F.arrow_udf(run, kind).asNondeterministic()


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow functions of this session get at most ``rows`` rows at once; a lower limit stays.

    A batch is held several times over, by the executor and by its Python worker, and Spark's 10,000
    texts are often all that a task reads.  Plans take the limit when they run, so it stays set.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


_Batch = TypeVar("_Batch")


def tidy(batches: Iterable[_Batch]) -> Iterator[_Batch]:
    """The batches; after each, memory that a worker has freed goes back to the machine.

    Spark's Python workers live on from task to task, and without this each keeps the most
    it ever held.
    """
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
        if trim:
            trim(0)
