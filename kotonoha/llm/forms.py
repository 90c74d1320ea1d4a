"""Text forms in which texts that look alike are equal.

``looks_same`` folds width forms, composed and separate accents, radical forms of kanji, invisible
characters, kinds of blank and look-alike letters; case, punctuation and blanks stay significant.
``bare_form`` is that form in lower case without whitespace and punctuation.

Three renderings of the same definition:

* ``looks_same`` / ``bare_form``: one Python string at a time, the plain definition;
* ``bare_codes`` / ``bare_batch``: a whole Arrow batch at once through numpy look-up tables;
* ``looks_same_sql``: a Catalyst ``translate``; composition of accents is left to the collation, and to ``looks_same_batch``
  for the few texts that are ``odd``, as Spark has no normalisation function.

Null stays null; the empty text stays empty; texts of any length are handled whole.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters of one shape. The first of each group stands for all.
LOOKALIKE_GROUPS = (
    "AАΑ", "BВΒ", "CСϹ", "EЕΕ", "HНΗ", "IІΙӀ", "JЈͿ", "KКΚ", "MМΜ", "NΝ", "OОΟ", "PРΡ", "SЅ", "TТΤ", "XХΧ", "YУΥҮ", "ZΖ",
    "aаα", "cсϲ", "eе", "hһ", "iі", "jјϳ", "oоο", "pрρ", "sѕ", "vνѵ", "xх", "yу", "dԁ", "qԛ", "wԝ", "lӏ", "GԌ", "QԚ", "WԜ",
    "ΓГ", "ΠП", "ΦФ", "ωѡ",
    "カ力", "エ工", "ニ二", "ロ口", "タ夕", "ト卜", "ハ八", "へヘ", "べベ", "ぺペ", "ム厶", "ノ丿",
)
INVISIBLE_EXTRA = "͏ᅟᅠ឴឵᠋᠌᠍᠏ㅤﾠ"
_LINE_CONTROLS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85"


def _radical(cp: int) -> bool:
    return 0x2E80 <= cp <= 0x2FDF


def _fold(ch: str) -> str:
    """The folded form of one character, before composition."""
    cp, cat = ord(ch), unicodedata.category(ch)
    if ch in INVISIBLE_EXTRA or cat == "Cf" or 0xFE00 <= cp <= 0xFE0F or 0xE0100 <= cp <= 0xE01EF:
        return ""
    if cat == "Cc":
        return ch if ch in _LINE_CONTROLS else ""
    if cat == "Zs":
        return " "
    if ch == "゛":
        return "゙"
    if ch == "゜":
        return "゚"
    how = unicodedata.decomposition(ch)
    if how.startswith(("<wide>", "<narrow>")) or how.startswith("<compat>") and _radical(cp):
        ch = unicodedata.normalize("NFKC", ch)
    elif how and not how.startswith("<"):
        ch = unicodedata.normalize("NFC", ch)
    return ch


@functools.cache
def fold_map() -> dict[int, str]:
    """Code point to folded text, for every code point that changes."""
    alike = {c: g[0] for g in LOOKALIKE_GROUPS for c in g[1:]}
    out = {}
    for cp in range(sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF or 0xAC00 <= cp <= 0xD7A3 or 0x20000 <= cp <= 0xDFFFF and not 0x2F800 <= cp <= 0x2FA1F:
            continue
        ch = chr(cp)
        to = _fold(ch)
        if to:
            parts = unicodedata.normalize("NFD", to)
            changed = "".join(alike.get(c, c) for c in parts)
            if changed != parts:
                to = unicodedata.normalize("NFC", changed)
            to = alike.get(to, to)
        if to != ch:
            out[cp] = to
    return out


@functools.cache
def mark_codes() -> np.ndarray:
    """Sorted code points of marks that can compose with what stands before them."""
    return np.array([c for c in range(0x300, 0x30000) if unicodedata.combining(chr(c))], dtype=np.uint32)


class _Table(dict):
    def __missing__(self, key: int) -> int:
        self[key] = key
        return key


@functools.cache
def _looks_table() -> _Table:
    return _Table(fold_map())


def looks_same(text: str | None) -> str | None:
    """The form in which texts that look the same are equal."""
    if text is None:
        return None
    return unicodedata.normalize("NFC", text.translate(_looks_table()))


@functools.cache
def _bare_drop() -> _Table:
    return _Table({c: None for c in range(0x20000) if unicodedata.category(chr(c))[0] == "P" or chr(c).isspace()})


def bare_form(text: str | None) -> str | None:
    """``looks_same`` in lower case without whitespace and punctuation."""
    if text is None:
        return None
    return unicodedata.normalize("NFC", looks_same(text).lower().translate(_bare_drop()))


@functools.cache
def bare_lut() -> np.ndarray:
    """Code point to the code point of the bare form; 0 drops it, SLOW marks what the table cannot say."""
    lut = np.arange(0x110000, dtype=np.uint32)
    folded = fold_map()
    for cp in range(0x110000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        to = folded.get(cp, chr(cp)).lower()
        to = "".join(c for c in to if not (unicodedata.category(c)[0] == "P" or c.isspace()))
        lut[cp] = SLOW if len(to) > 1 else ord(to) if to else 0
    lut[mark_codes()] = SLOW
    lut[0x3A3] = SLOW  # capital sigma: its lower case depends on what follows
    for cp in (0x309B, 0x309C, 0xFF9E, 0xFF9F):
        lut[cp] = SLOW
    return lut


SLOW = np.uint32(0xFFFFFFFF)


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def bare_codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, offsets): the bare forms of all texts as one array of code points. Null counts as empty."""
    plain = [t or "" for t in texts]
    lengths = np.fromiter(map(len, plain), dtype=np.int64, count=len(plain))
    ends = np.cumsum(lengths)
    codes = bare_lut()[codes_of("".join(plain))]
    slow = np.flatnonzero(codes == SLOW)
    patches: dict[int, np.ndarray] = {}
    if len(slow):
        for i in np.unique(np.searchsorted(ends, slow, side="right")).tolist():
            patches[i] = codes_of(bare_form(plain[i]))
            codes[ends[i] - lengths[i] : ends[i]] = 0
    keep = codes != 0
    kept = np.concatenate(([0], np.cumsum(keep)))
    offsets = np.concatenate(([0], kept[ends])) if len(ends) else np.zeros(1, dtype=np.int64)
    codes = codes[keep]
    if patches:
        parts, sizes, last = [], np.diff(offsets), 0
        for i, own in sorted(patches.items()):
            parts += [codes[last : offsets[i]], own]
            sizes[i], last = len(own), offsets[i]
        codes = np.concatenate([*parts, codes[last:]])
        offsets = np.concatenate(([0], np.cumsum(sizes)))
    return codes, offsets


def bare_batch(texts: list[str | None]) -> list[str | None]:
    """The bare form of each text of a batch."""
    codes, offsets = bare_codes(texts)
    joined, at = codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass"), offsets.tolist()
    return [None if t is None else joined[at[i] : at[i + 1]] for i, t in enumerate(texts)]


@functools.cache
def translate_pairs() -> tuple[str, str]:
    """(from, to) of a ``translate`` with the same effect as ``fold_map`` on texts that aren't ``odd``."""
    one, gone = [], []
    for cp, to in fold_map().items():
        if cp == 0:
            continue
        if len(to) == 1:
            one.append((chr(cp), to))
        elif not to:
            gone.append(chr(cp))
    return "".join(a for a, _ in one) + "".join(gone), "".join(b for _, b in one)


def looks_same_sql(text: Column) -> Column:
    """Look-alike mapping inside codegen. Accents stay composed or separate as they were."""
    a, b = translate_pairs()
    return F.translate(text, a, b)


# Accents and voicing marks that the collation tells apart from each other and from nothing.
PLAIN_MARKS = "\u0300\u0301\u0302\u0303\u0304\u0306\u0307\u0308\u030a\u030b\u030c\u0327\u0328\u3099\u309a"


@functools.cache
def _odd_characters() -> tuple[list[int], list[int], list[str]]:
    """(odd, carriers, pairs): characters that make a text odd, those with one plain mark, and sequences that make a text odd."""
    folded, carriers, odd, pairs = fold_map(), [], set(), []
    for cp in range(0x80, 0x110000):
        if 0xD800 <= cp <= 0xDFFF or cp in folded and len(folded[cp]) <= 1:
            continue
        parts = unicodedata.normalize("NFD", folded.get(cp, chr(cp)))
        if len(parts) == 2 and parts[1] in PLAIN_MARKS:
            carriers.append(cp)
            if cp in folded:
                odd.add(cp)
                pairs.append(parts)
        elif len(parts) > 1 or unicodedata.combining(parts) and parts not in PLAIN_MARKS:
            odd.add(cp)
        odd |= {ord(c) for c in parts[1:] if c not in PLAIN_MARKS}
    return sorted(odd), carriers, pairs


@functools.cache
def _odd_pairs() -> tuple[str, str, list[str]]:
    """(from, to) of a ``translate`` to three controls, which no mapped text has: 1 for odd characters, 2 for carriers, 3 for marks."""
    odd, carriers, pairs = _odd_characters()
    kept = sorted(set(carriers) - set(odd))
    return "".join(map(chr, odd + kept)) + PLAIN_MARKS, "\x01" * len(odd) + "\x02" * len(kept) + "\x03" * len(PLAIN_MARKS), pairs


def odd(mapped: Column) -> Column:
    """Whether the collation may compare a mapped text otherwise than canonical equivalence does: it has marks other than the plain
    ones, several marks on one character, parts that compose without being marks (syllables of Hangul among them), or
    what the mapping turns into several characters. All texts of a class agree in this."""
    a, b, pairs = _odd_pairs()
    seen = F.translate(mapped, a, b)
    several = F.contains(seen, F.lit("\x02\x03")) | F.contains(seen, F.lit("\x03\x03"))
    for pair in pairs:
        several = several | F.contains(mapped, F.lit(pair))
    return F.contains(seen, F.lit("\x01")) | F.when(F.contains(seen, F.lit("\x03")), several).otherwise(False)


@F.pandas_udf(T.StringType())
def looks_same_batch(texts: pd.Series) -> pd.Series:
    return pd.Series([looks_same(t) if isinstance(t, str) else None for t in texts], dtype=object)


@functools.cache
def skeleton_pairs() -> tuple[str, str]:
    """(from, to): characters with a plain mark to their base, plain marks to nothing."""
    folded, base = fold_map(), []
    for cp in range(0xA0, 0x110000):
        if not 0xD800 <= cp <= 0xDFFF and cp not in folded:
            parts = unicodedata.normalize("NFD", chr(cp))
            if len(parts) == 2 and parts[1] in PLAIN_MARKS:
                base.append((chr(cp), parts[0]))
    return "".join(a for a, _ in base) + PLAIN_MARKS, "".join(b for _, b in base)


def skeleton_sql(text: Column) -> Column:
    """A mapped text without plain accents and voicing marks: equal for canonically equal texts, cheap to compare."""
    a, b = skeleton_pairs()
    return F.translate(text, a, b)
