"""Text folding with built-in string functions only."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space of any kind, as a text strip understands it.
_SPACE = "".join(chr(code) for code in range(sys.maxunicode + 1) if chr(code).isspace())

_INNER_SPACE = r"[\s\x1c-\x1f]+"
_NON_ASCII = r"[^\x00-\x7F]"
_LATIN_END = 0x180


def strip_text(text: Column) -> Column:
    """Remove white space of any kind from both ends (``trim`` only knows U+0020)."""
    return F.trim(text, F.lit(_SPACE))


@lru_cache(maxsize=1)
def _folds() -> tuple[str, str, dict[str, str]]:
    """ASCII remainder of the compatibility decomposition of every code point.

    Characters that leave exactly one ASCII character go to a translate table;
    those that leave several (ligatures, fractions, units) to a map.  Characters
    that leave none need no entry, they are deleted as non-ASCII.
    """
    source, target, wide = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        kept = "".join(c for c in unicodedata.normalize("NFKD", char) if c < "\x80")
        if len(kept) == 1:
            source.append(char)
            target.append(kept)
        elif kept:
            wide[char] = kept
    return "".join(source), "".join(target), wide


def is_ascii(text: Column) -> Column:
    """Whether ``text`` has ASCII characters only."""
    return F.octet_length(text) == F.char_length(text)


def fold_latin(text: Column) -> Column:
    """``text`` with the accented Latin letters as ``fold_ascii`` folds them; other characters stay."""
    source, target, _ = _folds()
    pairs = [(char, plain) for char, plain in zip(source, target) if ord(char) < _LATIN_END]
    return F.translate(text, "".join(char for char, _ in pairs), "".join(plain for _, plain in pairs))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` applied to ``value``, which is evaluated a single time however often it is used."""
    return F.transform(F.array(value), use)[0]


def fold_ascii(text: Column) -> Column:
    """Drop accents and everything that has no ASCII form.

    ASCII texts pass as they are and nearly all others are settled by ``translate``.
    The map of multi-character folds is consulted only for texts that still hold one
    of those characters, which another ``translate`` finds out.
    """
    source, target, wide = _folds()
    folds = F.create_map(*[F.lit(part) for pair in wide.items() for part in pair])

    def expand(narrow: Column) -> Column:
        letters = F.transform(F.split(narrow, ""), lambda c: F.coalesce(folds[c], c))
        holds_wide = F.translate(narrow, "".join(wide), "") != narrow
        full = F.when(holds_wide, F.concat_ws("", letters)).otherwise(narrow)
        return F.when(narrow.rlike(_NON_ASCII), F.regexp_replace(full, _NON_ASCII, "")).otherwise(narrow)

    folded = once(F.translate(text, source, target), expand)
    return F.when(text.rlike(_NON_ASCII), folded).otherwise(text)


def normalize_text(text: Column) -> Column:
    """Lower-case ASCII text with single spaces; NULL becomes the empty string."""
    folded = fold_ascii(F.lower(strip_text(text)))
    return F.coalesce(F.trim(F.regexp_replace(folded, _INNER_SPACE, " ")), F.lit(""))
