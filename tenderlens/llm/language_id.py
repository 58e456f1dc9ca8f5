"""Language identification with labels for the spans of mixed texts."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlens.llm import language_model
from tenderlens.llm.common import tidy
from tenderlens.llm.language_model import LanguageModel

UNKNOWN = "und"


def fit(
    docs: DataFrame, learn: Column, sample: int = 500, penalty: float = 12.0,
    text: str = "text", language: str = "lang", id_column: str = "doc_id",
) -> LanguageModel:
    """A model from the rows of ``docs`` where ``learn`` holds and the language is known.

    ``sample`` bounds the texts: about so many of each language, chosen by a hash of the id
    before any text is read.  Only the trigram counts of these texts go to the driver.  Rows with
    NULL text or language are not learned from; without rows the model has no languages.
    """
    labelled = docs.where(learn & F.col(text).isNotNull() & F.col(language).isNotNull()).select(
        F.col(language).alias("l"), F.xxhash64(F.lit(1), F.col(id_column)).alias("h"), F.col(text).alias("t"),
    )
    counts = {r["l"]: r["count"] for r in labelled.groupBy("l").count().collect()}
    if not counts:
        return language_model.fit_counts([], penalty)
    share = F.create_map(*[
        F.lit(x) for name, n in counts.items() for x in (name, min(1.0, sample / n))
    ])
    drawn = F.pmod("h", F.lit(1 << 20)) < share[F.col("l")] * (1 << 20)
    words = labelled.where(drawn).select(
        "l", F.explode(F.split(F.lower("t"), r"[^\p{L}]+")).alias("w")
    ).where(F.length("w") > 0).groupBy("l", "w").count()
    padded = F.concat(F.lit(" "), "w", F.lit(" "))
    grams = F.transform(F.sequence(F.lit(1), F.length("w")), lambda i: F.substr(padded, i, F.lit(3)))
    rows = words.select("l", "count", F.explode(grams).alias("g")).groupBy("l", "g").agg(F.sum("count"))
    return language_model.fit_counts([tuple(r) for r in rows.collect()], penalty)


def _batches(batch: pa.Array, size: int = 256) -> Iterator[pa.Array]:
    for start in range(0, len(batch), size):
        yield batch.slice(start, size)


def predict(text: Column, model: LanguageModel) -> Column:
    """Struct of ``lang_pred`` and ``score`` of a whole text.

    The language with most letters on the best path, ties to the name that sorts first; the
    score is its share of the letters.  ``und`` with score 0 if the text is NULL or has no letter, or
    if the model knows no language.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in tidy(batches):
            names, shares = [], []
            for texts in _batches(batch):
                for rows in model.look_up(texts):
                    labels, sizes = model.path(rows)
                    letters = np.bincount(labels, weights=sizes, minlength=1) if len(rows) else np.zeros(1)
                    if letters.sum() == 0 or not model.languages:
                        names.append(UNKNOWN)
                        shares.append(0.0)
                    else:
                        best = int(letters.argmax())
                        names.append(model.languages[best])
                        shares.append(float(letters[best] / letters.sum()))
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(shares, pa.float64())], ["lang_pred", "score"]
            )

    return F.arrow_udf(run, "struct<lang_pred:string,score:double>")(text)


def spans(text: Column, model: LanguageModel) -> Column:
    """Array of spans of a text: language, first and last+1 piece between white space, letters.

    Pieces without a letter belong to the span around them; a text without letters, and NULL,
    has no spans.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in tidy(batches):
            counts, names, starts, ends, letters = [0], [], [], [], []
            for texts in _batches(batch):
                for rows in model.look_up(texts):
                    labels, sizes = model.path(rows)
                    if model.languages and sizes.sum():
                        edges = np.flatnonzero(np.diff(labels)) + 1
                        edges = [0, *edges.tolist(), len(labels)]
                        for a, b in zip(edges, edges[1:]):
                            names.append(model.languages[labels[a]])
                            starts.append(a)
                            ends.append(b)
                            letters.append(int(sizes[a:b].sum()))
                    counts.append(len(names))
            rows = pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), *(pa.array(x, pa.int64()) for x in (starts, ends, letters))],
                ["lang", "start", "end", "letters"],
            )
            yield pa.ListArray.from_arrays(pa.array(counts, pa.int32()), rows)

    return F.arrow_udf(run, "array<struct<lang:string,start:bigint,end:bigint,letters:bigint>>")(text)
