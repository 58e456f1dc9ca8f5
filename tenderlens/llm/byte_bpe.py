"""Byte-level BPE from a table of ranks, in linear time.

All bytes of a piece are mapped to Latin-1 characters, and one Aho-Corasick automaton finds
every vocabulary entry inside the piece.  The encoder takes the longest match at each
position and steps back to the next shorter one when a token cannot follow its predecessor.
Whether two tokens may stand side by side depends on the two alone: they may if no merge
across their border would have come before the merges that built them.  The answers are
remembered, so a piece costs its length and not the square of it.
"""

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlens.llm.common import tidy
from tenderlens.llm.text_pieces import Boundaries, PieceEncoder, packed


class ByteBpe:
    """Encoder and decoder for token bytes with ranks; a lower rank merges first."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"The vocabulary lacks the bytes {missing[:5]}")
        self._automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self._automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self._automaton.make_automaton()
        self._halves: dict[int, tuple[int, int]] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            self._halves[rank] = self._last_merge(token, rank)
        self._unbounded = max(self.token) + 1
        self._shorter: dict[int, int | None] = {}
        self._adjacent: dict[tuple[int, int], bool] = {}

    def _last_merge(self, token: bytes, rank: int) -> tuple[int, int]:
        """The two tokens whose merge makes ``token``; the token itself if there is none."""
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            merges = [
                (self.ranks.get(a + b, rank), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))
            ]
            best, i = min(merges)
            if best >= rank:
                return rank, rank  # no chain of merges leads here
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else (rank, rank)

    def _next_shorter(self, rank: int) -> int | None:
        """The longest vocabulary entry that is a proper prefix of a token."""
        if rank not in self._shorter:
            token = self.token[rank]
            prefixes = (self.ranks.get(token[:n]) for n in range(len(token) - 1, 0, -1))
            self._shorter[rank] = next((p for p in prefixes if p is not None), None)
        return self._shorter[rank]

    def _may_follow(self, left: int, right: int) -> bool:
        """Whether the merges leave a border between the two tokens.

        The inner border moves down both merge trees, later merge first.  A merge across
        the border that ranks before everything still to be undone would have happened.
        """
        known = self._adjacent.get((left, right))
        if known is not None:
            return known
        a, b, bound, allowed = left, right, self._unbounded, True
        while True:
            across = self.ranks.get(self.token[a] + self.token[b])
            if across is not None and across < bound:
                allowed = False
                break
            inner_a, inner_b = self._halves[a][1], self._halves[b][0]
            if a > b:  # the left one was made later
                if inner_a != a:
                    bound, a = a, inner_a
                elif inner_b != b:
                    bound, b = b + 1, inner_b
                else:
                    break
            elif inner_b != b:
                bound, b = b + 1, inner_b
            elif inner_a != a:
                bound, a = a, inner_a
            else:
                break
        if len(self._adjacent) > 500_000:
            self._adjacent.clear()
        self._adjacent[left, right] = allowed
        return allowed

    def piece(self, data: bytes) -> list[int]:
        """Ranks of one piece of the pre-tokenizer."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        if not data:
            return []
        latin = data.decode("latin-1")
        greedy = [found[1] for _, found in self._automaton.iter_long(latin)]
        if all(map(self._may_follow, greedy, greedy[1:])):
            return greedy  # tokens that may all follow one another are the merges' result
        return self._step_back(data, latin)

    def _step_back(self, data: bytes, latin: str) -> list[int]:
        """Longest matches first, shorter ones where a token may not follow."""
        longest: list[int] = [0] * len(data)
        reach = [0] * len(data)
        for end, (size, rank) in self._automaton.iter(latin):
            start = end - size + 1
            if size > reach[start]:
                reach[start], longest[start] = size, rank
        open_ends = bytearray(b"\x01") * (len(data) + 1)
        tokens: list[int] = []
        at, candidate = 0, longest[0]
        while at < len(data):
            end = at + len(self.token[candidate])
            if open_ends[end] and (not tokens or self._may_follow(tokens[-1], candidate)):
                tokens.append(candidate)
                at = end
                if at < len(data):
                    candidate = longest[at]
                continue
            shorter = self._next_shorter(candidate)
            while shorter is None:  # nothing fits here: this position is a dead end
                open_ends[at] = 0
                last = tokens.pop()
                at -= len(self.token[last])
                shorter = self._next_shorter(last) if not open_ends[at + len(self.token[last])] else last
            candidate = shorter
        return tokens

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of a list of ranks."""
        return b"".join(map(self.token.__getitem__, ids))


@functools.cache
def from_file(path: str) -> ByteBpe:
    """The vocabulary of a file with a line of base64 bytes and a rank for each token."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    return ByteBpe({base64.b64decode(token): int(rank) for token, rank in pairs})


@functools.cache
def text_encoder(path: str, pattern: str) -> PieceEncoder:
    """Piece encoder of the vocabulary.

    ``pattern`` has to let a space begin the match of what follows it, as the known
    byte-level patterns do.
    """
    import regex

    bpe, matches = from_file(path), regex.compile(pattern).findall
    known: dict[str, bytes] = {}

    def encode(pieces: list[str]) -> list[bytes]:
        if len(known) > 200_000:
            known.clear()
        result = []
        for piece in pieces:
            ids = []
            for match in matches(piece):
                found = known.get(match)
                if found is None:
                    found = known[match] = packed(bpe.piece(match.encode("utf-8")))
                ids.append(found)
            result.append(b"".join(ids))
        return result

    return PieceEncoder(encode, Boundaries.LEADING, remember=20_000)


def encode(text: Column, path: str, pattern: str) -> Column:
    """Ids of a text as binary of little-endian unsigned 32-bit integers; NULL as empty."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = text_encoder(path, pattern)
        for batch in tidy(batches):
            yield pa.array([_packed(ids) for ids in encoder.ids(batch)], pa.binary())

    return F.arrow_udf(run, "binary")(text)


def decode(ids: Column, path: str) -> Column:
    """Bytes of ids as ``encode`` returns them; NULL as empty.

    An id that the vocabulary does not hold is a ``KeyError``.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = from_file(path)
        for batch in tidy(batches):
            lists = (np.frombuffer(i or b"", "<u4").tolist() for i in batch.to_pylist())
            yield pa.array([bpe.decode(i) for i in lists], pa.binary())

    return F.arrow_udf(run, "binary")(ids)


def _packed(ids: np.ndarray) -> bytes:
    return ids.astype("<u4", copy=False).tobytes()


def encode_decode(
    docs: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` for every row of ``docs``.

    The digests are taken where the ids are made, so ids do not travel.  NULL counts as the
    empty text; repeated rows and NULL ids stay; no other column is read.
    """

    def digests(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, bpe = text_encoder(path, pattern), from_file(path)
        for batch in tidy(batches):
            counts, of_ids, of_bytes = [], [], []
            for ids in encoder.ids(batch):
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(_packed(ids)).hexdigest())
                of_bytes.append(hashlib.sha256(bpe.decode(ids.tolist())).hexdigest())
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                ["n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>"
    found = docs.select(F.struct(*keep).alias("kept"), F.arrow_udf(digests, kind)(F.col(text)).alias("found"))
    return found.select("kept.*", "found.*")
