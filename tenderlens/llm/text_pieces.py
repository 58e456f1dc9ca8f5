"""Encode long texts as the ids of short pieces, each distinct piece once per batch.

The pre-tokenizers of the known vocabularies never look over certain boundaries, so the
ids of a text are the ids of its pieces, one after the other.  ``Boundaries`` names them:

``LEADING``
    Byte-level patterns, where a space belongs to what follows.  A cut stands before a
    space that a visible character follows; all other white space stays inside a piece.
``DROPPED``
    Vocabularies that drop white space.  A cut replaces a space.
``SINGLE``
    Vocabularies that mark word starts.  A cut replaces a single space between two visible
    characters.
``WHOLE``
    Anything else; texts are not cut.
"""

import enum
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


class Boundaries(enum.Enum):
    LEADING = "leading"
    DROPPED = "dropped"
    SINGLE = "single"
    WHOLE = "whole"


# Wider than any library's white space, so a doubtful character is never cut at.
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{180e}\p{Z}]"
_UNCUT = {
    Boundaries.LEADING: rf" ({_SPACE}|$)",
    Boundaries.SINGLE: rf" ({_SPACE}|$)|(^|{_SPACE}) ",
}
_SLOW_CUT = {
    Boundaries.LEADING: re.compile(r" (?=[^\s᠎])"),
    Boundaries.SINGLE: re.compile(r"(?<=[^\s᠎]) (?=[^\s᠎])"),
}
_BETWEEN_WORDS = re.compile(r"(?<=[^\s᠎]) (?=[^\s᠎])")


def segments(text: str, size: int) -> Iterator[str]:
    """Parts of about ``size`` characters, cut before single spaces between words.

    A text without such a space stays whole.
    """
    start = 0
    while len(text) - start > size:
        cut = _BETWEEN_WORDS.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def packed(ids: list[int]) -> bytes:
    """Ids as unsigned 32-bit integers."""
    return array("I", ids).tobytes()


class Ragged:
    """Packed lists of ids, one after the other in one array."""

    def __init__(self, lists: list[bytes]):
        self.counts = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
        self.flat = np.frombuffer(b"".join(lists), np.uint32)
        self.starts = np.cumsum(self.counts) - self.counts

    def take(self, index: np.ndarray) -> np.ndarray:
        """The lists at ``index`` joined."""
        counts = self.counts[index]
        shift = self.starts[index] - (np.cumsum(counts) - counts)
        return self.flat[np.repeat(shift, counts) + np.arange(int(counts.sum()))]


class PieceEncoder:
    """Ids of whole texts from the ids of their distinct pieces.

    ``encode`` gets a list of pieces and returns the packed ids of each.  Texts with one of
    the ``special`` strings are encoded whole.  Texts are taken in batches of about
    ``batch`` bytes, longer ones in segments of that size, so memory is bounded by it.  Up
    to ``remember`` pieces are kept from batch to batch; beyond it those of the last one.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], list[bytes]],
        boundaries: Boundaries,
        special: tuple[str, ...] = (),
        batch: int = 2_000_000,
        remember: int = 60_000,
    ):
        self._encode, self._boundaries, self._batch = encode, boundaries, batch
        self._encode_special = encode
        self._remember = remember
        self._known: dict[str, bytes] = {}
        self._special = re.compile("|".join(map(re.escape, special))) if any(special) else None

    def _cut(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Offsets and values of the pieces of all texts."""
        if self._boundaries is Boundaries.WHOLE:
            return pa.array(range(len(texts) + 1)), texts
        pattern = _UNCUT.get(self._boundaries)
        if pattern and pc.any(pc.match_substring_regex(texts, pattern)).as_py():
            uncut, slow = re.compile(r" (?:[\s᠎]|\Z)|(?:\A|[\s᠎]) "), _SLOW_CUT[self._boundaries]
            lists = pa.array(
                [slow.split(t) if uncut.search(t) else t.split(" ") for t in texts.to_pylist()],
                pa.list_(pa.string()),
            )
        else:
            lists = pc.split_pattern(texts, " ")
        return lists.offsets, lists.flatten()

    def _encoded(self, pieces: pa.Array, prefix: str = "") -> tuple[np.ndarray, Ragged]:
        """The code of every piece, and the ids of every code."""
        coded = pieces.dictionary_encode()
        distinct = [prefix + p for p in coded.dictionary.to_pylist()]
        lists = [*map(self._known.get, distinct)]
        missing = [p for p, ids in zip(distinct, lists) if ids is None]
        found = iter(self._encode(missing))
        lists = [next(found) if ids is None else ids for ids in lists]
        if len(self._known) + len(missing) > self._remember:
            self._known = {}
        self._known.update(zip(distinct[:self._remember], lists))
        return coded.indices.to_numpy(zero_copy_only=False), Ragged(lists)

    def _batch_ids(self, texts: list[str], lengths: bool) -> list:
        offsets, pieces = self._cut(pa.array(texts, pa.large_string()).cast(pa.string()))
        offsets = offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        if self._boundaries is Boundaries.LEADING:
            first_at = offsets[:-1]
            first_code, firsts = self._encoded(pieces.take(pa.array(first_at)))
            inner = np.ones(len(pieces), bool)
            inner[first_at] = False
            rest_code, rests = self._encoded(pieces.filter(pa.array(inner)), " ")
            offsets = offsets - np.arange(len(offsets))
        else:
            rest_code, rests = self._encoded(pieces)
        if lengths:
            total = np.concatenate([[0], np.cumsum(rests.counts[rest_code])])
            counts = total[offsets[1:]] - total[offsets[:-1]]
            if self._boundaries is Boundaries.LEADING:
                counts = counts + firsts.counts[first_code]
            return counts.tolist()
        result = []
        for i in range(len(texts)):
            ids = rests.take(rest_code[offsets[i]:offsets[i + 1]])
            if self._boundaries is Boundaries.LEADING:
                ids = np.concatenate([firsts.take(first_code[i:i + 1]), ids])
            result.append(ids)
        return result

    def _jobs(self, texts: pa.Array) -> Iterator[tuple[int, str, bool]]:
        """Row, text or segment of it, and whether it is to be encoded whole."""
        for row, text in enumerate(texts):
            text = text.as_py() or ""
            if self._special and self._special.search(text):
                yield row, text, True
            elif self._boundaries is Boundaries.WHOLE:
                yield row, text, False
            else:
                for i, part in enumerate(segments(text, self._batch)):
                    # Where the cut replaces its space, the segment starts after it.
                    drop = i and self._boundaries is Boundaries.SINGLE
                    yield row, part[1:] if drop else part, False

    def _batches(self, texts: pa.Array, lengths: bool) -> Iterator[tuple[list[int], list]]:
        rows: list[int] = []
        run: list[str] = []
        size = 0
        for row, text, whole in self._jobs(texts):
            if whole:
                if run:
                    yield rows, self._batch_ids(run, lengths)
                    rows, run, size = [], [], 0
                ids = self._encode_special([text])[0]
                yield [row], [len(ids) // 4 if lengths else np.frombuffer(ids, np.uint32)]
                continue
            rows.append(row)
            run.append(text)
            size += len(text)
            if size >= self._batch:
                yield rows, self._batch_ids(run, lengths)
                rows, run, size = [], [], 0
        if run:
            yield rows, self._batch_ids(run, lengths)

    def ids(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of every text, in order; NULL has none."""
        at, parts = 0, []
        for rows, found in self._batches(texts, lengths=False):
            for row, ids in zip(rows, found):
                if row != at:
                    yield parts[0] if len(parts) == 1 else np.concatenate(parts)
                    at, parts = row, []
                parts.append(ids)
        if parts:
            yield parts[0] if len(parts) == 1 else np.concatenate(parts)

    def lengths(self, texts: pa.Array) -> list[int]:
        """The number of ids of every text, in order; NULL has none."""
        counts = [0] * len(texts)
        for rows, found in self._batches(texts, lengths=True):
            for row, count in zip(rows, found):
                counts[row] += count
        return counts


class SegmentEncoder(PieceEncoder):
    """Ids of whole texts from an encoder that is faster on running text than on its pieces.

    Long texts are still cut to segments, and ``encode_special`` gets the texts that hold
    one of the ``special`` strings.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], list[bytes]],
        boundaries: Boundaries,
        special: tuple[str, ...],
        encode_special: Callable[[list[str]], list[bytes]],
        batch: int = 2_000_000,
    ):
        super().__init__(encode, boundaries, special, batch)
        self._encode_special = encode_special

    def _batch_ids(self, texts: list[str], lengths: bool) -> list:
        found = self._encode(texts)
        return [len(ids) // 4 if lengths else np.frombuffer(ids, np.uint32) for ids in found]
