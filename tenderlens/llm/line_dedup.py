"""Lines that repeat an earlier line but for one edit, by a deletion-neighbourhood join.

Two lines are within one edit (a character inserted, deleted or replaced) exactly if one is the other, one
is the other without a character, or both without the character at the same place are equal.  So
every line gives a hash for itself and for itself without each of its characters, and lines
that share a hash meet.  The lines that share a hash with the same place deleted are all within one
edit of each other, so the earliest of them answers for all, and no pairs are listed.

Equal lines are put together before.  Two lines within one edit also share all characters before the
middle or all after it; lines whose halves nobody shares cannot have a partner, so only the
others give deletions.  This is exact and spares nearly all of them.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlens.llm.common import arrow_function, stored, tidy

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLANK = " \t\n\x0b\f\r"


def deletion_hashes(line: str) -> np.ndarray:
    """64-bit hashes of a line and of the line without each character, in order.

    A line's hash is the sum of a mixed value of each character times a power of an odd base, so all
    deletions together cost one pass.
    """
    points = np.frombuffer(line.encode("utf-32-le"), np.uint32).astype(np.uint64)
    n = len(points)
    with np.errstate(over="ignore"):
        mixed = (points + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(32)
        factors = np.full(n, _BASE, np.uint64)
        factors[:1] = 1
        powers = np.cumprod(factors, dtype=np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * powers, dtype=np.uint64)])
        without = sums[:-1] + (sums[-1] - sums[1:]) * np.uint64(_INVERSE)
    return np.concatenate([sums[-1:], without])


def _half_keys(line: Column) -> Column:
    """Hashes of the halves of a line, for lines of its own and the neighbouring lengths.

    Class c holds the lengths 2c - 1 to 2c + 1; both lines of a pair share the first c - 1
    characters of a class of both, or its last c.
    """
    n = F.length(line)
    c = F.floor(n / 2).cast("int")

    def keys(c: Column) -> list[Column]:
        return [F.xxhash64(F.lit(1), c, F.substring(line, F.lit(1), c - 1)), F.xxhash64(F.lit(2), c, F.right(line, c))]

    return F.when(n % 2 == 0, F.array(*keys(c))).otherwise(F.array(*keys(c), *keys(c + 1)))


def _lines(docs: DataFrame) -> DataFrame:
    """The lines of documents that are not blank, with the order of all lines.

    ``o`` orders by id, NULL last, then by a hash of the text for rows that share an id.
    """
    at = F.struct(F.col("id").isNull().alias("null"), "id", "th")
    lines = docs.where("t is not null").select(at.alias("d"), F.posexplode(F.split("t", "\n")).alias("n", "line"))
    lines = lines.where(F.col("line").rlike(r"\S"))  # ASCII, as _BLANK
    return lines.select(F.struct("d.*", "n").alias("o"), "line", F.xxhash64("line").alias("h1"),
                        F.xxhash64(F.lit(7), "line").alias("h2"))


def _partners(lines: DataFrame, first: DataFrame) -> DataFrame:
    """``o`` of the first copies of lines for which an earlier line is within one edit."""
    keys = lines.select("o", "h1", F.explode(_half_keys(F.col("line"))).alias("key"))
    shared = stored(keys.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b"))
                    .where("a != b").select(F.col("key").alias("k")))
    wanted = keys.join(shared, F.col("key") == F.col("k"), "left_semi").select("o").distinct()
    wanted = wanted.join(first.select(F.col("o").alias("f")), F.col("o") == F.col("f"), "left_semi")
    return stored(wanted.select(F.col("o").alias("w")))


def _variants(candidates: DataFrame) -> DataFrame:
    """A row for each deletion of each candidate ``c``: the hash ``v`` and the place ``p``.

    The line itself has place -1.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in tidy(batches):
            found = [deletion_hashes(line.as_py()) for line in batch]
            counts = np.concatenate([[0], np.cumsum([len(f) for f in found])])
            flat = np.concatenate(found) if found else np.zeros(0, np.uint64)
            yield pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.array(flat.view(np.int64)))

    hashes = arrow_function(run, "array<bigint>")(F.col("line"))
    return candidates.select("c", hashes.alias("hashes")).select(
        "c", F.posexplode("hashes").alias("i", "v")
    ).select("v", (F.col("i") - 1).alias("p"), "c")


def _near(candidates: DataFrame) -> DataFrame:
    """``o`` of candidates with an earlier candidate within one edit, verified on the texts.

    Candidates are distinct lines, so few share a hash: those that differ at one place, by one of
    the characters in use.
    """
    variants = _variants(candidates)
    many = stored(variants.groupBy("v").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x != y")
                  .select(F.col("v").alias("mv")))
    order = candidates.select(F.col("c").alias("oc"), "o")
    shared = variants.join(many, F.col("v") == F.col("mv"), "left_semi")
    shared = stored(shared.join(order, F.col("c") == F.col("oc")).select("v", "p", "o"))
    least = stored(shared.groupBy("v", "p").agg(F.min("o").alias("least")))
    met = least.groupBy(F.col("v").alias("v1")).agg(
        F.min(F.when(F.col("p") < 0, F.col("least"))).alias("itself"),
        F.min(F.when(F.col("p") >= 0, F.col("least"))).alias("deleted"),
    )
    least = least.select(F.col("v").alias("v2"), F.col("p").alias("p2"), "least")
    joined = shared.join(met, F.col("v") == F.col("v1")).join(
        least, (F.col("v") == F.col("v2")) & (F.col("p") == F.col("p2")))
    earlier = F.when(F.col("p") < 0, F.array("deleted")).otherwise(F.array("itself", "least"))
    pairs = joined.select("o", F.explode(earlier).alias("e")).where("e < o").distinct()
    text = candidates.select(F.col("o").alias("to"), "line")
    pairs = pairs.join(text, F.col("o") == F.col("to")).select("o", "e", F.col("line").alias("a"))
    pairs = pairs.join(text, F.col("e") == F.col("to")).select("o", "a", F.col("line").alias("b"))
    return pairs.where(F.levenshtein("a", "b", 1) >= 0).select("o").distinct()


def _without(text: Column, stay: Column) -> Column:
    """A text with its blank lines and those whose places are in ``stay``, and how many went."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, places in tidy(batches):
            left, before, gone = [], [], []
            for text, at in zip(texts, places):
                text, at = text.as_py(), set(at.as_py() or ())
                lines = [] if text is None else text.split("\n")
                blank = [not line.strip(_BLANK) for line in lines]
                rest = [line for i, (line, b) in enumerate(zip(lines, blank)) if b or i in at]
                left.append(None if text is None else "\n".join(rest))
                before.append(len(lines) - sum(blank))
                gone.append(len(lines) - len(rest))
            yield pa.StructArray.from_arrays(
                [pa.array(left, pa.string()), pa.array(before, pa.int64()), pa.array(gone, pa.int64())],
                ["left", "n_lines", "n_removed"],
            )

    return arrow_function(run, "struct<left:string,n_lines:bigint,n_removed:bigint>")(text, stay)


def dedup_lines(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``docs`` with its lines deduplicated, and ``n_lines`` and ``n_removed`` after its columns.

    A line goes if an earlier one, of the same or another document, is equal to it or within one edit.
    Lines are ordered by id (NULL last), then by a hash of the text, then by their place.  Lines are cut
    at line feeds; those of ASCII white space alone stay and are not counted.  Rows that repeat id
    and text are one document: all of them get the same result.  NULL texts stay NULL, with no
    lines.  Columns ``n_lines`` and ``n_removed`` that ``docs`` has already are replaced.
    """
    source = docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("th"), F.col(text).alias("t"))
    lines = _lines(source)
    first = stored(lines.groupBy("h1", "h2").agg(F.min("o").alias("o")).select("o"))
    wanted = _partners(lines, first)

    # The texts of the candidates, from the few documents that have any.
    own = F.struct(F.col("id").isNull().alias("null"), "id", "th")
    places = stored(wanted.groupBy(F.struct("w.null", "w.id", "w.th").alias("doc"))
                    .agg(F.collect_list("w.n").alias("places")))
    with_any = source.where("t is not null").select(own.alias("own"), "t").join(places, F.col("own") == F.col("doc"))
    candidates = with_any.select("own", F.explode(_chosen(F.col("t"), F.col("places"))).alias("at"))
    candidates = candidates.select(F.struct("own.*", "at.n").alias("o"), "at.line").dropDuplicates(["o"])
    candidates = stored(candidates.withColumn("c", F.monotonically_increasing_id()))
    near = stored(_near(candidates).select(F.col("o").alias("gone")))

    kept = first.join(near, F.col("o") == F.col("gone"), "left_anti")
    kept = stored(kept.groupBy(F.struct("o.null", "o.id", "o.th").alias("doc")).agg(F.collect_list("o.n").alias("stay")))
    row = docs.select(F.struct("*").alias("row"))
    key = F.struct(F.col(f"row.{id_column}").isNull().alias("null"), F.col(f"row.{id_column}").alias("id"),
                   F.xxhash64(f"row.{text}").alias("th"))
    joined = row.select("row", key.alias("key")).join(kept, F.col("key") == F.col("doc"), "left")
    done = joined.select("row", _without(F.col(f"row.{text}"), F.col("stay")).alias("done"))
    columns = [F.col("done.left").alias(c) if c == text else F.col(f"row.`{c}`")
               for c in docs.columns if c not in ("n_lines", "n_removed")]
    return done.select(*columns, "done.n_lines", "done.n_removed")


def _chosen(text: Column, places: Column) -> Column:
    """The lines of a text at ``places``, as structs of place and line."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, wanted in tidy(batches):
            counts, n, found = [0], [], []
            for text, at in zip(texts, wanted):
                lines, at = text.as_py().split("\n"), at.as_py()
                n += at
                found += [lines[i] for i in at]
                counts.append(len(n))
            rows = pa.StructArray.from_arrays([pa.array(n, pa.int32()), pa.array(found, pa.string())], ["n", "line"])
            yield pa.ListArray.from_arrays(pa.array(counts, pa.int32()), rows)

    return arrow_function(run, "array<struct<n:int,line:string>>")(text, places)
