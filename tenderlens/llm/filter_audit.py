"""How filters of documents interact: who removes what, in every order at once.

Each document becomes a truth table, a 32-bit word: bit S is set if it survives the set S of
up to five filters.  The words of a part and label are summed per bit by carry-save adders, which
gives the survivors of every subset.  Any order of the filters is a chain of subsets, so
what each step keeps and removes, and each filter's share over all orders, follows from these sums.
"""

import itertools
import json
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderlens.llm.common import stored, tidy

# Truth tables of the five variables: bit S of VARIABLES[i] tells whether the set S holds filter i.
VARIABLES = np.array([sum(1 << s for s in range(32) if s >> i & 1) for i in range(5)], np.uint32)
SUBSETS = 32
_KEYS = 4096  # groups that a task sums at once before it passes partial sums on
_CHUNK = 1 << 20  # bytes of a text that are cut into words at once
_SPACE = re.compile(rb"[ \t-\r]")
_MARKS = re.compile(rb"[#$%&*|]")
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_CONTINUED = bytes(range(0x80, 0xC0))  # UTF-8 bytes that begin no code point


def survival_words(failures: np.ndarray) -> np.ndarray:
    """The truth tables of documents from the bits of the filters that they fail."""
    words = np.full(len(failures), 0xFFFFFFFF, np.uint32)
    for i, variable in enumerate(VARIABLES):
        words &= np.where(failures >> i & 1, ~variable, np.uint32(0xFFFFFFFF))
    return words


def positional_popcount(words: np.ndarray, lanes: int = 64) -> np.ndarray:
    """How many words have each of the 32 bits set.

    Three rows of equal weight become a sum row and a carry row of twice the weight, until
    at most two rows of each weight are left, whose bits are counted.
    """
    counts = np.zeros(SUBSETS, np.int64)
    rows = np.zeros((-(-len(words) // lanes), lanes), np.uint32)
    rows.reshape(-1)[:len(words)] = words
    weight = 1
    while len(rows):
        carries = []
        while len(rows) > 2:
            full = len(rows) // 3 * 3
            a, b, c = rows[0:full:3], rows[1:full:3], rows[2:full:3]
            half = a ^ b
            carries.append((a & b) | (half & c))
            rows = np.concatenate([half ^ c, rows[full:]])
        bits = np.unpackbits(rows.astype("<u4").reshape(-1, 1).view(np.uint8), axis=1, bitorder="little")
        counts += weight * bits.sum(axis=0, dtype=np.int64)
        rows = np.concatenate(carries) if carries else rows[:0]
        weight *= 2
    return counts


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in pieces that end at white space."""
    start = 0
    while start < len(text):
        space = _SPACE.search(text, start + _CHUNK) if start + _CHUNK < len(text) else None
        end = space.start() if space else len(text)
        yield text[start:end].split()  # of bytes: at the six ASCII blanks alone
        start = end


def text_failures(text: bytes) -> int:
    """The filters A to D that a text fails, as bits 0 to 3.

    A: under 200 words; B: 100 * distinct words < 50 * words; C: 100 * capitals A-Z > 3 * code
    points; D: holds any of ``#$%&*|``.  Words part at ASCII white space and keep their case.
    """
    total, distinct = 0, set()
    for words in _words(text):
        total += len(words)
        distinct.update(words)
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text.translate(None, _CONTINUED))
    return (
        (total < 200) | (100 * len(distinct) < 50 * total) << 1 | (100 * capitals > 3 * points) << 2
        | (_MARKS.search(text) is not None) << 3
    )


def failures(text: Column) -> Column:
    """``text_failures`` of a column of texts; NULL counts as empty."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in tidy(batches):
            texts = (t.as_py() or b"" for t in batch.cast(pa.binary()))
            yield pa.array(map(text_failures, texts), pa.int32())

    return F.arrow_udf(run, "int").asNondeterministic()(text)


def repeats(rows: DataFrame, bit: int) -> DataFrame:
    """``rows`` (id, digest, ...) with ``repeat``: ``bit`` where a smaller id has the digest, else 0.

    The smallest id per digest is found with partial sums before the shuffle and is then
    joined on id and digest together, so a digest of very many rows loads no task.  A NULL id is
    neither smaller nor larger than another; rows that repeat an id and a digest agree.
    """
    first = rows.groupBy("digest").agg(F.min("id").alias("first_id")).where("first_id is not null")
    first = first.select(F.col("first_id").alias("id"), "digest", F.lit(0).alias("repeat"))
    repeat = F.coalesce("repeat", F.when(F.col("id").isNull(), 0).otherwise(bit))
    return rows.join(first, ["id", "digest"], "left").withColumn("repeat", repeat)


def subset_survivors(rows: DataFrame, labels: Sequence[str]) -> DataFrame:
    """``(part, everything, *labels)``: arrays of the survivors of all 32 subsets.

    ``rows`` holds ``part`` (string), ``failures`` (int, bit i for filter i) and a boolean per
    label.  A task holds 32 sums per part and combination of labels, and passes them on when
    it meets more than 4096 of these.
    """
    labels = list(labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], np.ndarray] = {}

        def passed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part for part, _ in sums], pa.string()),
                "label": pa.array([label for _, label in sums], pa.int32()),
                "counts": pa.array([c.tolist() for c in sums.values()], pa.list_(pa.int64())),
            })

        for batch in tidy(batches):
            words = survival_words(batch["failures"].to_numpy())
            part = batch["part"].dictionary_encode()
            label = sum(batch[name].to_numpy(zero_copy_only=False).astype(np.int32) << i
                        for i, name in enumerate(labels)) + np.zeros(len(words), np.int32)
            key = (part.indices.to_numpy().astype(np.int64) << len(labels)) | label
            order = np.argsort(key, kind="stable")
            edges = np.flatnonzero(np.diff(key[order])) + 1
            for group in np.split(order, edges) if len(order) else []:
                at = (part.dictionary[int(key[group[0]] >> len(labels))].as_py(), int(label[group[0]]))
                sums[at] = sums.get(at, 0) + positional_popcount(words[group])
            if len(sums) > _KEYS:
                yield passed_on()
                sums.clear()
        yield passed_on()

    found = rows.select("part", "failures", *labels).mapInArrow(run, "part string, label int, counts array<bigint>")
    long = found.select("part", "label", F.posexplode("counts").alias("subset", "n"))
    per_subset = long.groupBy("part", "subset").agg(
        F.sum("n").alias("everything"),
        *[F.sum(F.when(F.col("label").bitwiseAND(1 << i) != 0, F.col("n")).otherwise(0)).alias(name)
          for i, name in enumerate(labels)],
    )
    names = ["everything", *labels]
    gathered = per_subset.groupBy("part").agg(
        F.array_sort(F.collect_list(F.struct("subset", *names))).alias("all"))  # 32 of each part
    return gathered.select("part", *[F.col("all")[name].alias(name) for name in names])


def order_steps(letters: str) -> list[dict]:
    """Every step of every order of the filters, with the subsets before and after it."""
    steps = []
    for order in itertools.permutations(range(len(letters))):
        before = 0
        for step, i in enumerate(order, 1):
            steps.append({"filter_order": "".join(letters[j] for j in order), "step": step,
                          "own": 1 << i, "before": before, "after": before | 1 << i})
            before |= 1 << i
    return steps


def audit(survivors: DataFrame, letters: str, labels: Sequence[str]) -> DataFrame:
    """A row per part, order of the filters and step, from ``subset_survivors``.

    ``kept``, ``removed``, ``redundant`` (fails here, went earlier), ``unique_fails`` (fails only here),
    ``<label>_lost`` and ``shapley`` (removed by the filter, summed over all orders).
    """
    schema = "array<struct<filter_order:string,step:int,own:int,before:int,after:int>>"
    steps = survivors.select("*", F.inline(F.from_json(F.lit(json.dumps(order_steps(letters))), schema)))
    everyone = (1 << len(letters)) - 1

    def n(subset: Column | int, of: str = "everything") -> Column:
        return F.get(of, F.lit(subset) if isinstance(subset, int) else subset)

    removed = n(F.col("before")) - n(F.col("after"))
    filter_of_part = Window.partitionBy("part", "own")  # 5! rows
    return steps.select(
        "part", "filter_order", "step", n(F.col("after")).alias("kept"), removed.alias("removed"),
        (n(0) - n(F.col("own")) - removed).alias("redundant"),
        (n(F.lit(everyone) - F.col("own")) - n(everyone)).alias("unique_fails"),
        *[(n(F.col("before"), name) - n(F.col("after"), name)).alias(f"{name}_lost") for name in labels],
        F.sum(removed).over(filter_of_part).alias("shapley"),
    )


def audit_documents(
    docs: DataFrame, labels: DataFrame, text: str = "text", part: str = "lang", id_column: str = "doc_id",
    label_columns: Sequence[tuple[str, str]] = (("good", "quality"), ("toxic", "toxic")),
) -> DataFrame:
    """The audit of filters A to E (``text_failures``; E: a smaller id has an identical text).

    NULL texts count as empty, NULL parts as the empty string.  A document has a label if any row
    of ``labels`` with its id holds 1 there; without a row, or with NULL id, it has none.  No documents
    give no rows.  Only ids, digests and parts are shuffled, never texts.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    rows = stored(docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(content, 256)).alias("digest"), failures(content).alias("own_failures"),
    ))
    names = [name for name, _ in label_columns]
    marks = labels.groupBy(F.col(id_column).alias("id")).agg(*[
        F.max(F.coalesce(F.col(column) == 1, F.lit(False))).alias(name) for name, column in label_columns
    ])
    # NULL ids have no label; spread by their digests they load no task either.
    spread = F.when(F.col("id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0).cast("bigint")).alias("spread")
    marked = repeats(rows, 1 << 4).select("*", spread).join(
        marks.select("*", F.lit(0).cast("bigint").alias("spread")), ["id", "spread"], "left"
    ).select(
        "part", F.col("own_failures").bitwiseOR(F.col("repeat")).alias("failures"),
        *[F.coalesce(name, F.lit(False)).alias(name) for name in names],
    )
    return audit(subset_survivors(marked, names), "ABCDE", names)
