"""The libraries' tokenizers as piece encoders, one of each kind per Python worker."""

import functools
import json
import os

from tenderlens.llm.text_pieces import Boundaries, PieceEncoder, SegmentEncoder, packed


def _json_boundaries(path: str) -> Boundaries:
    """Where a ``tokenizers`` file may be cut, read from its own pre-tokenizer."""
    with open(path, encoding="utf-8") as file:
        description = json.load(file)
    before = description.get("pre_tokenizer") or {}
    steps = before.get("pretokenizers", [before])
    first = steps[0] if steps else {}
    if first.get("type") == "ByteLevel" and first.get("use_regex", True) \
            and not first.get("add_prefix_space") and not description.get("normalizer"):
        return Boundaries.LEADING
    pattern = first.get("pattern", {}).get("Regex", "")
    if first.get("type") == "Split" and first.get("invert") \
            and first.get("behavior") == "Removed" and r"[^\s" in pattern:
        return Boundaries.DROPPED
    return Boundaries.WHOLE


@functools.cache
def library(path: str):
    """The tokenizer of a ``.json`` or ``.model`` file."""
    if path.endswith(".json"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task per core
        from tokenizers import Tokenizer

        return Tokenizer.from_file(path)
    if path.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path)
    raise ValueError(f"Neither a .json nor a .model file: {path}")


def _encode(path: str, pieces: list[str]) -> list[bytes]:
    found: list[bytes] = []
    for at in range(0, len(pieces), 4096):  # the libraries' own results are large
        some = pieces[at:at + 4096]
        if path.endswith(".json"):
            found += [packed(e.ids) for e in library(path).encode_batch_fast(some, add_special_tokens=False)]
        else:
            found += map(packed, library(path).encode(some, num_threads=1))
    return found


@functools.cache
def byte_level(path: str):
    """A faster encoder of the same ids for a byte-level ``.json`` file, or None.

    Where the ids of merged tokens rise with the merges' order, they are ranks, and the rank
    encoder gives the ids of the library.  Its table is read from the file.
    """
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"].get(a + b, -1) for a, b in merges]
    if made != sorted(made) or -1 in made[:1]:
        return None
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    others = [b for b in range(256) if b not in letters]
    of_byte = {chr(b): b for b in letters} | {chr(256 + i): b for i, b in enumerate(others)}
    ranks = {
        bytes(of_byte[c] for c in token): rank for token, rank in model["vocab"].items()
        if all(c in of_byte for c in token) and token not in _special(path)
    }
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def _special(path: str) -> tuple[str, ...]:
    if path.endswith(".json"):
        return tuple(t.content for t in library(path).get_added_tokens_decoder().values())
    return ()


def _boundaries(path: str) -> Boundaries:
    return _json_boundaries(path) if path.endswith(".json") else Boundaries.SINGLE


@functools.cache
def encoder(path: str) -> PieceEncoder:
    """The piece encoder of a ``.json`` or ``.model`` file."""
    library(path)
    boundaries, special = _boundaries(path), _special(path)
    by_library = functools.partial(_encode, path)
    ranked = byte_level(path) if boundaries is Boundaries.LEADING else None
    if ranked is None:
        return PieceEncoder(by_library, boundaries, special)

    def whole(texts: list[str]) -> list[bytes]:
        return [packed(ranked.encode_ordinary(text)) for text in texts]

    return SegmentEncoder(whole, boundaries, special, by_library)
