"""Ids compare without regard to case, width forms and surrounding whitespace."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


@functools.cache
def width_pairs() -> tuple[str, str]:
    """(from, to) of single characters; marks of narrow kana stay separate characters."""
    pairs = []
    for cp in [0x3000, *range(0xFF01, 0xFFEF)]:
        to = unicodedata.normalize("NFKC", chr(cp))
        if unicodedata.decomposition(chr(cp)).startswith(("<wide>", "<narrow>")) and len(to) == 1:
            pairs.append((chr(cp), to))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


@functools.cache
def _voiced() -> list[tuple[str, str]]:
    kana = [c for c in map(chr, range(0x30A1, 0x30FF)) if len(unicodedata.normalize("NFD", c)) == 2]
    return [(unicodedata.normalize("NFD", c), c) for c in kana]


def compare_form(value: Column) -> Column:
    """The form in which equal ids are equal strings. Null stays null; a blank id becomes ''."""
    a, b = width_pairs()
    folded = F.translate(value, a, b)
    composed = folded
    for apart, whole in _voiced():
        composed = F.replace(composed, F.lit(apart), F.lit(whole))
    folded = F.when(folded.rlike("[゙゚]"), composed).otherwise(folded)
    return F.lower(F.regexp_replace(folded, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))


def present(value: Column) -> Column:
    """True for an id that is neither null nor blank."""
    return value.isNotNull() & (compare_form(value) != "")
