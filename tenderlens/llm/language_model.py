"""Word scores, scripts and the path of languages through a text.

A word is a run of letters inside a piece between white space.  Its script narrows the
languages that may have written it; the score of each is the mean-free log probability of
the word's letter trigrams.  Viterbi's algorithm then labels all words of a text, and a
switch from one language to another costs ``penalty``.
"""

import bisect
import re
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# First code points of runs of letters, by Unicode block, and their script.
SCRIPT_STARTS = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"),
    (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0900, "Indic"), (0x0E00, "Thai"),
    (0x0E80, "Other"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Other"),
    (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"), (0x3040, "Kana"),
    (0x3100, "Han"), (0xA000, "Other"), (0xAC00, "Hangul"), (0xD7B0, "Other"),
    (0xF900, "Han"), (0xFB00, "Other"), (0x20000, "Han"), (0x30000, "Other"),
]
_POINTS = [point for point, _ in SCRIPT_STARTS]
_NO_LETTERS = re.compile(r"[^\w\n]+|[\d_]+")


def script_of(letter: str) -> str:
    """The script of a letter, by its range of code points."""
    return SCRIPT_STARTS[bisect.bisect_right(_POINTS, ord(letter)) - 1][1]


def letters_of(pieces: list[str]) -> list[list[str]]:
    """The runs of letters of each piece, in lower case; numerals such as fractions are no letters.

    Pieces hold no white space, so a line break can part them and one search serves all.
    """
    text = _NO_LETTERS.sub(" ", "\n".join(pieces).lower())
    letters = text.replace(" ", "").replace("\n", "")
    if letters and not letters.isalpha():
        text = "".join(c if c.isalpha() or c == "\n" else " " for c in text)
    return list(map(str.split, text.split("\n")))


def _points_of(text: str) -> np.ndarray:
    """The code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)


def _code(points: np.ndarray) -> np.ndarray:
    """The trigram that starts at each place as one integer; a code point has 21 bits."""
    return (points[:-2] << 42) | (points[1:-1] << 21) | points[2:]


@dataclass
class LanguageModel:
    """Trigram statistics per language; ``counts[gram][k]`` belongs to ``languages[k]``."""

    languages: list[str]
    counts: dict[str, list[int]]
    scripts: dict[str, list[bool]]
    penalty: float = 12.0
    remember: int = 30_000
    _index: dict[str, int] = field(default_factory=dict, repr=False)
    _scores: np.ndarray | None = field(default=None, repr=False)
    _sizes: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def __setstate__(self, state):
        self.__dict__.update(state, _index={}, _scores=None, _sizes=None)
        self.__post_init__()

    def __post_init__(self):
        k = len(self.languages)
        codes = _code(_points_of("".join(self.counts) + "  "))[::3][:len(self.counts)]
        order = np.argsort(codes)
        counts = np.array([*self.counts.values(), [0] * k], np.float64).reshape(len(self.counts) + 1, k) + 0.5
        table = np.log(counts / counts.sum(0))
        self._codes = codes[order]
        self._table = np.concatenate([table[order], table[-1:]])  # the last row is for unknown trigrams
        # Who may write the letters from each start of SCRIPT_STARTS on; nobody's scripts rule nobody out.
        writers = [self.scripts.get(name, []) for _, name in SCRIPT_STARTS]
        self._known = np.array([name in self.scripts for _, name in SCRIPT_STARTS])
        self._allowed = np.array([row if any(row) else [True] * k for row in writers]).reshape(len(writers), k)

    def words(self, words: list[str]) -> np.ndarray:
        """Scores of words, the best language's being zero; languages of other scripts lose.

        A script that no language writes gives zeros, so the neighbours decide.
        """
        k = len(self.languages)
        if not words or not k:
            return np.zeros((len(words), k))
        points = _points_of(f" {'  '.join(words)} ")
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(sizes + 2) - (sizes + 2)  # of the words with a blank on both sides
        ends = np.cumsum(sizes)
        inside = np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)
        codes = _code(points)[inside]
        rows = np.searchsorted(self._codes, codes)
        if len(self._codes):
            rows = np.where(self._codes[np.minimum(rows, len(self._codes) - 1)] == codes, rows, len(self._codes))
        score = np.add.reduceat(self._table[rows], ends - sizes, axis=0)
        scripts = np.searchsorted(_POINTS, points[starts + 1], side="right") - 1
        score = np.where(self._allowed[scripts], score, -np.inf)
        score = np.maximum(score - score.max(axis=1, keepdims=True), -20.0)
        return np.where(self._known[scripts][:, None], score, 0.0)

    def _learn(self, pieces: list[str]) -> None:
        found = letters_of(pieces) if pieces else []
        counts = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(counts)
        words = [word for some in found for word in some]
        total = np.concatenate([np.zeros((1, len(self.languages))), np.cumsum(self.words(words), axis=0)])
        letters = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))])
        rows = (total[ends] - total[ends - counts]).astype(np.float32)
        sizes = (letters[ends] - letters[ends - counts]).astype(np.int32)
        start = len(self._index)
        self._index.update(zip(pieces, range(start, start + len(pieces))))
        self._scores = rows if self._scores is None or not start else np.concatenate([self._scores, rows])
        self._sizes = sizes if self._sizes is None or not start else np.concatenate([self._sizes, sizes])

    def _forget(self) -> None:
        """Drop the older half of the pieces."""
        half = len(self._index) // 2
        self._index = {piece: row - half for piece, row in self._index.items() if row >= half}
        self._scores, self._sizes = self._scores[half:].copy(), self._sizes[half:].copy()

    def look_up(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """The row numbers of every text's pieces in ``scores`` and ``sizes``."""
        if len(self._index) > self.remember:
            self._forget()
        column = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts, "")
        cut = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(column))
        coded = cut.flatten().dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        missing = [p for p in pieces if p not in self._index]
        if missing or self._scores is None:
            self._learn(missing)
        place = np.fromiter(map(self._index.__getitem__, pieces), np.int64, len(pieces))
        rows = place[coded.indices.to_numpy()]
        ends = np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False)).astype(np.int64)
        return np.split(rows, ends[:-1])[:len(column)]

    def path(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The language of every piece, and the pieces' numbers of letters."""
        scores, sizes = self._scores[rows].astype(np.float64), self._sizes[rows]
        return viterbi(scores, self.penalty), sizes


def viterbi(scores: np.ndarray, penalty: float) -> np.ndarray:
    """The labels with the largest sum of scores less ``penalty`` for each switch.

    Ties go to the label that comes first, and to staying.  One label for all is the answer if no
    stretch of another gains more than a penalty, and no beginning and end together do: m
    stretches of other labels take m switches if a stretch of the one label remains, and m - 1 if none does.
    """
    n, k = scores.shape
    if n == 0 or k == 0:
        return np.zeros(n, np.int64)
    best = int(scores.sum(0).argmax())
    gain = np.cumsum(scores - scores[:, best:best + 1], axis=0)
    low = np.minimum(np.minimum.accumulate(gain, axis=0), 0.0)
    stretch = max((gain[1:] - low[:-1]).max(initial=0.0), gain[0].max())
    ends = max(gain.max(), 0.0) + max((gain[-1] - gain).max(), 0.0)
    if stretch <= penalty and ends <= penalty:
        return np.full(n, best, np.int64)
    back = np.zeros((n, k), np.int64)
    stay = np.arange(k)
    value = scores[0].copy()
    for i in range(1, n):
        top = int(value.argmax())
        switch = value[top] - penalty > value
        back[i] = np.where(switch, top, stay)
        value = np.where(switch, value[top] - penalty, value) + scores[i]
    labels = np.empty(n, np.int64)
    labels[-1] = int(value.argmax())
    for i in range(n - 1, 0, -1):
        labels[i - 1] = back[i, labels[i]]
    return labels


def fit_counts(rows: list[tuple[str, str, int]], penalty: float = 12.0) -> LanguageModel:
    """A model from (language, trigram, count); no rows give a model without languages."""
    languages = sorted({language for language, _, _ in rows})
    at = {language: i for i, language in enumerate(languages)}
    counts: dict[str, list[int]] = defaultdict(lambda: [0] * len(languages))
    letters: dict[str, list[int]] = defaultdict(lambda: [0] * len(languages))
    for language, gram, count in rows:
        counts[gram][at[language]] += count
        letters[script_of(gram[1])][at[language]] += count
    total = [sum(row) for row in zip(*letters.values())]
    # A language writes a script that has at least a hundredth of its letters.
    scripts = {name: [c * 100 >= t > 0 for c, t in zip(row, total)] for name, row in letters.items()}
    return LanguageModel(languages, dict(counts), scripts, penalty)
