"""Toxicity by weak supervision.

A bounded sample of labelled texts shows which words and word beginnings are more frequent in
toxic ones.  Dealt out, they are the lexicons of many voters; patterns and the given labels are further
voters.  ``label_model`` weighs the voters, and a linear classifier of the lexicon counts learns its
posterior labels.  The classifier alone scores texts: labels, languages, sources and ids are no input.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlens.llm.common import stored, tidy
from tenderlens.llm.label_model import LabelModel, fit_label_model, fit_linear

BEGINNINGS = (4, 5, 6, 7)  # letters of the word beginnings that are looked at
_WORD = re.compile(r"[^\W\d_]+")
_SPACE = re.compile(r"\s")
_CHUNK = 1 << 20  # characters of a text that are counted at once
_USUAL = 400  # words; beginnings are counted per so many words of longer texts
_LEXICONS = 16

# Pattern voters: what insults often come with, whatever the words.
PATTERNS = [
    re.compile(r"!{2,}"), re.compile(r"\b[A-Z]{4,}(?:\W+[A-Z]{4,})+\b"), re.compile(r"\b\w+(?:[*@#$]+\w+)+\b"),
    re.compile(r"\b(?:you|du|tu|eres)\b", re.IGNORECASE), re.compile(r"\b(\w{3,})(?:\W+\1\b){2,}", re.IGNORECASE),
]


def _chunks(text: str) -> Iterator[str]:
    """A text in pieces that end at white space."""
    start = 0
    while start < len(text):
        space = _SPACE.search(text, start + _CHUNK) if start + _CHUNK < len(text) else None
        end = space.start() if space else len(text)
        yield text[start:end]
        start = end


def _beginnings(word: str) -> list[str]:
    """The beginnings of a word, each with a mark that tells it from a whole word."""
    return [f"{word[:k]}-" for k in BEGINNINGS if k < len(word)]


def candidates(text: str) -> set[str]:
    """What a text may teach: its words, and beginnings (``abcd-``) that two of its words share."""
    words: Counter[str] = Counter()
    for chunk in _chunks(text):
        words.update(_WORD.findall(chunk.lower()))
    seen: Counter[str] = Counter()
    for word, n in words.items():
        for beginning in _beginnings(word):
            seen[beginning] += n
    return {*words, *(b for b, n in seen.items() if n > 1)}


@dataclass
class ToxicityModel:
    """Lexicon, its place in the feature vector, and the classifier's weights with the intercept last."""

    lexicon: list[str]
    weights: np.ndarray
    voters: LabelModel | None = None

    def __post_init__(self):
        self._place = {entry: i for i, entry in enumerate(self.lexicon)}
        self._begins = np.array([entry.endswith("-") for entry in self.lexicon], bool)
        self._first = {entry[:BEGINNINGS[0]] for entry in self.lexicon}

    def counts(self, text: str) -> np.ndarray:
        """How often each entry occurs; beginnings per 400 words where a text is longer."""
        found = np.zeros(len(self.lexicon))
        total, place, first = 0, self._place, self._first
        for chunk in _chunks(text):
            words = _WORD.findall(chunk.lower())
            total += len(words)
            for word, n in Counter(words).items():
                if word[:4] in first:
                    for entry in (word, *_beginnings(word)):
                        if entry in place:
                            found[place[entry]] += n
        found[self._begins] *= min(1.0, _USUAL / max(total, 1))
        return found

    def count(self, texts: list[str]) -> np.ndarray:
        """``counts`` of many texts."""
        return np.array([self.counts(t) for t in texts]).reshape(len(texts), len(self.lexicon))

    def score(self, texts: list[str]) -> np.ndarray:
        """Probability that each text is toxic."""
        x = np.log1p(self.count(texts))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))

    def votes(self, texts: list[str], counts: np.ndarray) -> np.ndarray:
        """The votes of all lexicons, of the absence of their entries, and of the patterns."""
        present = counts >= np.where(self._begins, 1.5, 1.0)
        votes = [np.where(part.any(axis=1), 1, 0) for part in np.array_split(present, _LEXICONS, axis=1)]
        hits = present.sum(axis=1)
        votes.append(np.where(hits >= 3, 1, np.where(hits == 0, -1, 0)))
        # Half of the entries each: a text without any of them votes clean.
        votes += [np.where(present[:, i::2].any(axis=1), 0, -1) for i in range(2)]
        votes += [np.array([any(p.search(c) for c in _chunks(t)) for t in texts], int) for p in PATTERNS]
        return np.column_stack(votes)


def fit_sample(
    lexicon: list[str], counts: np.ndarray, votes: np.ndarray, toxic: np.ndarray, weight: np.ndarray
) -> ToxicityModel:
    """The model from the counts and votes of sampled texts, each row standing for ``weight`` texts."""
    given, weight = np.where(toxic, 1, -1), weight / weight.mean()
    voters = fit_label_model(votes, given, weight)
    return ToxicityModel(lexicon, fit_linear(np.log1p(counts), voters.posterior(votes, given), weight), voters)


def _mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each class with each candidate, summed over a task's part of the sample."""
    seen = (Counter(), Counter())
    for batch in tidy(batches):
        for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
            seen[toxic].update(candidates(text))
    entries = list({*seen[0], *seen[1]})
    yield pa.RecordBatch.from_pydict({
        "entry": pa.array(entries, pa.string()),
        "clean": pa.array([seen[0][e] for e in entries], pa.int64()),
        "bad": pa.array([seen[1][e] for e in entries], pa.int64()),
    })


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column, sample: int = 6000, entries: int = 300, least: int = 3,
    text: str = "text", id_column: str = "doc_id", label: str = "toxic",
) -> ToxicityModel:
    """A model from the documents where ``learn`` holds (an expression over the id) and a label is known.

    About ``sample`` texts at most are learned from, half of each class if there are as many, chosen by a
    hash of the id; all labelled texts are counted and each drawn one stands for its share.  The lexicon has at
    most ``entries`` words and beginnings, each in ``least`` toxic texts or more; it, and the counts and votes of the
    sample, go to the driver, but no text.  A document is toxic if any of its labels is 1; labels other than 0 and 1 and NULL ids are left out, NULL
    texts are empty.  Without texts of both classes all scores are the share of toxic ones, 0 without any.
    """
    gold = labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull() & learn)
    gold = gold.groupBy(F.col(id_column).alias("id")).agg(F.max(F.col(label)).cast("int").alias("toxic"))
    known = docs.where(learn).select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    labelled = stored(gold.join(known.select("id"), "id", "left_semi"))
    sizes = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        share = 1.0 if 1 in sizes else 0.0
        return ToxicityModel([], np.array([30.0 if share else -30.0]))
    shares = [min(1.0, sample / 2 / sizes[y]) for y in (0, 1)]
    share = F.when(F.col("toxic") == 1, shares[1]).otherwise(shares[0])
    # At most about ``sample`` ids go to all tasks, so no other text moves.
    chosen = labelled.where(F.pmod(F.xxhash64(F.lit(13), "id"), F.lit(1 << 20)) < share * (1 << 20))
    drawn = stored(known.join(F.broadcast(chosen), "id").select("text", "toxic"))

    mined = drawn.mapInArrow(_mine, "entry string, clean bigint, bad bigint")
    mined = mined.groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("bad").alias("bad")).where(
        F.col("bad") >= least)
    n = {r["toxic"]: r["count"] for r in drawn.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return ToxicityModel([], np.array([np.log(sizes[1] / sizes[0])]))

    def odds(hits: Column, size: int) -> Column:
        return F.log((hits + 0.5) / (size - hits + 0.5))

    error = F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("clean") + 0.5))
    gain = odds(F.col("bad"), n.get(1, 0)) - odds(F.col("clean"), n.get(0, 0)) - 1.64 * error
    best = mined.select("entry", gain.alias("gain")).where("gain > 1").orderBy(F.desc("gain"), "entry").limit(entries)
    blank = ToxicityModel([r["entry"] for r in best.collect()], np.zeros(0))

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tidy(batches):
            texts = batch["text"].to_pylist()
            counts = blank.count(texts)
            yield pa.RecordBatch.from_pydict({
                "counts": pa.array(counts.tolist(), pa.list_(pa.float64())),
                "votes": pa.array(blank.votes(texts, counts).tolist(), pa.list_(pa.int32())), "toxic": batch["toxic"]})

    rows = drawn.mapInArrow(seen, "counts array<double>, votes array<int>, toxic int").collect()
    toxic = np.array([r["toxic"] for r in rows], bool)
    return fit_sample(
        blank.lexicon, np.array([r["counts"] for r in rows]).reshape(len(rows), len(blank.lexicon)),
        np.array([r["votes"] for r in rows]), toxic, np.where(toxic, 1 / shares[1], 1 / shares[0]))


def score(text: Column, model: ToxicityModel) -> Column:
    """Probability from 0 to 1 that a whole text is toxic; NULL counts as empty."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in tidy(batches):
            yield pa.array(model.score([t.as_py() or "" for t in batch]), pa.float64())

    return F.arrow_udf(run, "double").asNondeterministic()(text)
