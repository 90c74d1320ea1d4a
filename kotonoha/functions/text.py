"""Scalar text functions as Catalyst expressions. Null gives null unless said otherwise; code points count as characters."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Whitespace as Python's ``str.isspace`` has it; Java's own class differs on four controls.
SPACE = r"[\s\x1c-\x1f]"
# The blocks that count as Japanese, as kanji, as Latin and as emoji.
JAPANESE = r"[\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}]"
KANJI = r"[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}]+"
LATIN = r"[A-Za-zＡ-Ｚａ-ｚ]+"
EMOJI = r"[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{2300}-\x{23FF}]"
# What a reading may hold besides kana.
READING_PUNCTUATION = "、。！？!?，,．.：:；;・ー〜～…‥（）()「」『』【】［］[]〈〉《》〔〕〝〟\"'／/－-＿_"
READING_SYMBOLS = "%％+＋=＝@＠&＆#＃￥¥$＄℃°"
# Punctuation folded before NFKC, so that a full-width hyphen becomes the long-vowel mark first.
DASHES = ("〜～－", "ーーー")


def strip(text: Column) -> Column:
    """Without surrounding whitespace of any kind."""
    return F.regexp_replace(text, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def compact(text: Column) -> Column:
    """Without any whitespace; null becomes ''."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), rf"(?U){SPACE}+", "")


def blank_to_null(text: Column) -> Column:
    return F.nullif(strip(text), F.lit(""))


def japanese_ratio(text: Column) -> Column:
    """Share of Japanese script among letters and numbers; null if there are none."""
    eligible = F.regexp_replace(text, r"[^\p{L}\p{N}]", "")
    return F.length(F.regexp_replace(eligible, f"[^{JAPANESE[1:]}", "")) / F.nullif(F.length(eligible), F.lit(0))


def repeated_unit(text: Column, min_count: int = 3, max_unit: int = 20) -> Column:
    """The shortest unit that, repeated at least ``min_count`` times, makes up the whole text; '' if none does."""
    bare = F.regexp_replace(text, rf"(?U)[{SPACE[1:-1]}\p{{P}}]", "")
    return F.regexp_extract(bare, rf"(?s)\A(.{{1,{max_unit}}}?)\1{{{min_count - 1},}}\z", 1)


def density(text: Column, seconds: Column) -> Column:
    """Characters other than whitespace a second; null for no or no positive duration."""
    return F.when(seconds > 0, F.length(compact(text)) / seconds)


def id_prefix(basis: Column, fallback: Column) -> Column:
    """Upper-case prefix for record ids, from a hash of ``fallback`` where nothing usable is left."""
    safe = F.upper(F.regexp_replace(F.regexp_replace(basis, "[^A-Za-z0-9]+", "_"), "^_+|_+$", ""))
    hashed = F.concat(F.lit("TEXT_"), F.upper(F.substring(F.sha2(fallback, 256), 1, 8)))
    return F.when(safe != "", safe).otherwise(hashed)


def segment_id(parent: Column, number: Column) -> Column:
    """Id of the n-th part of a record; carries a hash where the parent's id had to be changed."""
    safe = F.regexp_replace(F.regexp_replace(parent, "[^A-Za-z0-9._-]+", "_"), r"^[._-]+|[._-]+$", "")
    safe = F.when(safe == "", F.lit("sample")).otherwise(safe)
    stem = F.when(safe == parent, safe).otherwise(F.concat_ws("_", safe, F.substring(F.sha2(parent, 256), 1, 8)))
    digits = number.cast("string")
    return F.concat(stem, F.lit("__seg"), F.lpad(digits, F.greatest(F.lit(4), F.length(digits)), F.lit("0")))


@F.pandas_udf(T.StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Compatibility composition; Spark has no function for it."""
    return pd.Series([unicodedata.normalize("NFKC", t) if isinstance(t, str) else None for t in texts], dtype=object)


def fold_width(text: Column) -> Column:
    """Dashes folded to the long-vowel mark, then NFKC."""
    return nfkc(F.translate(text, *DASHES))


def without_thousands(text: Column) -> Column:
    """Without the commas of complete thousands groups: of each run of digits, commas and points that as a whole is one to three
    digits and then groups of three."""
    run = "[0-9.,]+"
    whole = lambda x: x.rlike("^[0-9]{1,3}(,[0-9]{3})+$")
    runs = F.transform(F.regexp_extract_all(text, F.lit(f"({run})"), F.lit(1)), lambda x: F.when(whole(x), F.replace(x, F.lit(","), F.lit(""))).otherwise(x))
    return F.array_join(F.zip_with(F.split(text, run, -1), runs, lambda plain, number: F.concat(plain, F.coalesce(number, F.lit("")))), "")


def latin_hyphen(text: Column) -> Column:
    """A long-vowel mark between Latin letters or digits is a hyphen: looked at between the pieces that the marks part."""
    pieces = F.split(text, "ー", -1)
    n = F.size(pieces)
    between = lambda a, b: a.rlike("[A-Za-z0-9]$") & b.rlike("^[A-Za-z0-9]")
    joined = F.zip_with(F.slice(pieces, F.lit(1), n - 1), F.slice(pieces, F.lit(2), n - 1), lambda a, b: F.concat(a, F.when(between(a, b), F.lit("-")).otherwise(F.lit("ー"))))
    return F.concat(F.array_join(joined, ""), F.element_at(pieces, -1))


def collapse_space(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, rf"(?U){SPACE}+", " "), "^ | $", "")


# The names under which the steps of the normalisation are logged, in order.
NORMALIZATION = (
    ("jaconv_unicode_width_normalization", fold_width),
    ("numeric_thousands_separator_removed", without_thousands),
    ("latin_hyphen_normalization", latin_hyphen),
    ("whitespace_normalization", collapse_space),
)


def normalized(text: Column) -> Column:
    """struct(text, steps): the normalised text, null if nothing visible remains, and the steps that changed it."""
    stages = [text]
    for _, step in NORMALIZATION:
        stages.append(step(stages[-1]))
    changed = [F.when(a != b, F.lit(name)) for (name, _), a, b in zip(NORMALIZATION, stages, stages[1:])]
    return F.struct(F.nullif(stages[-1], F.lit("")).alias("text"), F.array_compact(F.array(*changed)).alias("steps"))


def _alternatives(surfaces: Sequence[str]) -> str:
    return "|".join(re.escape(s) for s in sorted(set(surfaces), key=lambda s: (-len(s), s)))


def matches(text: Column, surfaces: Sequence[str]) -> Column:
    """Occurrences of the surfaces, longest first, without overlap, in order."""
    return F.regexp_extract_all(text, F.lit(f"({_alternatives(surfaces)})"), F.lit(1))


def substitute(text: Column, replacements: dict[str, str]) -> Column:
    """All surfaces replaced at once, longest first; what was put in is not replaced again."""
    if not replacements:
        return text
    table = F.create_map(*[F.lit(x) for pair in sorted(replacements.items()) for x in pair])
    return F.array_join(
        F.zip_with(
            F.split(text, _alternatives(list(replacements)), -1),
            F.transform(matches(text, list(replacements)), lambda s: F.element_at(table, s)),
            lambda plain, to: F.concat(F.coalesce(plain, F.lit("")), F.coalesce(to, F.lit(""))),
        ),
        "",
    )


def occurrences(text: Column, surface: str) -> Column:
    """How often a surface occurs, without overlap."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(surface), F.lit("")))) / len(surface)).cast("int")


def spans(text: Column, surface: str) -> Column:
    """array<struct<start, end>>: half-open places of a surface, in characters, found in one pass over the pieces between them."""
    width = len(surface)
    none = F.array().cast("array<int>")
    ends = F.aggregate(
        F.split(text, re.escape(surface), -1),
        F.struct(F.lit(0).alias("at"), none.alias("found")),
        lambda state, piece: F.struct((state["at"] + F.length(piece) + width).alias("at"), F.array_append(state["found"], state["at"] + F.length(piece)).alias("found")),
        lambda state: F.slice(state["found"], F.lit(1), F.size(state["found"]) - 1),
    )
    return F.transform(ends, lambda start: F.struct(start.alias("start"), (start + width).alias("end")))


def latin_runs(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"({LATIN})"), F.lit(1)))


def digit_runs(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"(\p{Nd}+)"), F.lit(1)))


def kanji_runs(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"({KANJI})"), F.lit(1)))


def unexpected_in_reading(text: Column) -> Column:
    """Characters that are neither kana nor Latin, digits, kanji, whitespace or the punctuation a reading may hold."""
    allowed = "".join(rf"\x{{{ord(c):X}}}" for c in READING_PUNCTUATION + READING_SYMBOLS)
    return F.array_distinct(F.regexp_extract_all(text, F.lit(rf"(?U)([^\s\x1c-\x1f\x{{3040}}-\x{{30FF}}\x{{31F0}}-\x{{31FF}}A-Za-zＡ-Ｚａ-ｚ\p{{Nd}}{KANJI[1:-2]}{allowed}])"), F.lit(1)))


def emoji(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"({EMOJI})"), F.lit(1)))


def code_point(char: Column) -> Column:
    digits = F.hex(F.ascii(char))
    return F.concat(F.lit("U+"), F.lpad(digits, F.greatest(F.lit(4), F.length(digits)), F.lit("0")))


def invalid_controls(text: Column) -> Column:
    """Control and format characters that have no place in a text, as U+XXXX, each once."""
    found = F.regexp_extract_all(text, F.lit(r"([\p{Cc}\p{Cf}&&[^\t\n\r\x{200D}\x{FE0E}\x{FE0F}]])"), F.lit(1))
    return F.transform(F.array_distinct(found), code_point)


def valid_reading(text: Column) -> Column:
    """Whether a reading holds katakana and no Latin letters or digits of either width."""
    return text.rlike(r"[\x{30A1}-\x{30FA}]") & ~text.rlike(r"[A-Za-z0-9Ａ-Ｚａ-ｚ０-９]")


def _hiragana() -> tuple[str, str]:
    cps = [*range(0x3041, 0x3097), 0x309D, 0x309E]
    return "".join(map(chr, cps)), "".join(chr(c + 0x60) for c in cps)


def canonical_reading(text: Column) -> Column:
    """For comparison only: NFKC, katakana, without whitespace and punctuation."""
    return F.regexp_replace(F.translate(nfkc(text), *_hiragana()), rf"(?U)[{SPACE[1:-1]}\p{{P}}]", "")


def error_rate(expected: Column, observed: Column) -> Column:
    """Edit distance over the length of the expected text; null if that is empty."""
    return F.levenshtein(expected, observed) / F.nullif(F.length(expected), F.lit(0))


def sequence_status(expected: Column, observed: Column) -> Column:
    return F.when(expected.isNull(), "unresolved").when(F.contains(observed, expected), "observed").otherwise("not_observed")


def utc_text(moment: Column) -> Column:
    """ISO text of a moment in UTC, with microseconds only where there are any (for identities)."""
    micros = F.unix_micros(moment)
    whole = F.date_format(F.to_utc_timestamp(moment, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss")
    part = F.when(micros % 1_000_000 != 0, F.concat(F.lit("."), F.lpad((F.pmod(micros, F.lit(1_000_000))).cast("string"), 6, "0"))).otherwise("")
    return F.concat(whole, part, F.lit("+00:00"))


def verified_substitution(text: Column, replacements: dict[str, str], expected: dict[str, int]) -> Column:
    """struct(text, error): the substituted text if each surface occurs as often as recorded, else what differs."""
    found = matches(text, list(replacements)) if replacements else F.array().cast("array<string>")
    off = [F.when(F.size(found) - F.size(F.array_remove(found, s)) != n, F.lit(s)) for s, n in sorted(expected.items())]
    wrong = F.array_join(F.array_compact(F.array(*off)), ",") if off else F.lit("")
    return F.struct(F.when(wrong == "", substitute(text, replacements)).alias("text"), F.nullif(wrong, F.lit("")).alias("error"))
