"""A hidden Markov model over the lines of a text.

Each non-blank line is described by a few statistics, put together as one symbol: how likely its characters follow
each other in prose, whether it ends like a sentence, begins like a list item, falls into cells as a neighbour does,
is mostly symbols, or repeats itself. States are the four kinds of line. The model is fitted on a bounded sample of
labelled documents by Viterbi training, in which a line of a document labelled k may be k or prose.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

import numpy as np

from .forms import codes_of, fold_map

KINDS = ("prose", "list", "table", "junk")
PROSE, LIST, TABLE, JUNK = range(4)
#: Bins of the table of pairs of characters; pairs that share a bin are counted together.
PAIR_BITS = 22
SEPARATORS = ("\t", "|", ";", ",", "  ")

LINE_END = re.compile(r"\r\n|\n|\r")
ITEM = re.compile(
    r"\s*(?:([・•◦‣●○■□◆◇▪▫►▶★☆※])(?!\1)|[-*+–—]\s|\[[ xX]?\]|[(（][0-9a-zA-Z]{1,3}[)）]|[0-9]{1,3}(?:[)）、]|[.．](?![0-9]))|[a-zA-Z][)）]|[a-zA-Z]\.\s|[①-⑳])"
)
_BLANKS = re.compile(r" {2,}|\t+ *")
_SENTENCE_END = tuple("。．.!?！？」』）)…")
_STRONG_END = tuple("。．.!?！？")


class _Fold(dict):
    def __missing__(self, key: int) -> int:
        self[key] = key
        return key


_fold: _Fold | None = None


def folded(text: str) -> str:
    """The text with width forms, blanks and invisible characters folded (composition doesn't matter here)."""
    global _fold
    if _fold is None:
        _fold = _Fold(fold_map())
    return text if text.isascii() else text.translate(_fold)


def lines_of(text: str) -> list[str]:
    """The non-blank lines of a folded text."""
    return [x for x in LINE_END.split(text) if x and not x.isspace()]


def cell_counts(line: str) -> tuple[int, ...]:
    """Number of cells of a line by each separator (0 if it sets nothing apart)."""
    out = []
    for sep in SEPARATORS:
        if sep not in line:
            out.append(0)
            continue
        body = line.strip()
        if sep == "|":
            body = body.removeprefix("|").removesuffix("|")
            out.append(body.count("|") + 1)
        elif sep == "  ":
            out.append(len(_BLANKS.split(body)))
        elif sep == ",":
            out.append(0 if body.endswith(_STRONG_END) else body.count(",") + 1)
        else:
            out.append(line.count(sep) + 1)
    return tuple(out)


def kind_by_rule(lines: list[str]) -> str | None:
    """Table or list, by their definition over the non-blank lines."""
    n = len(lines)
    if n >= 4:
        counts = [cell_counts(x) for x in lines]
        for s in range(len(SEPARATORS)):
            most = Counter(c[s] for c in counts if c[s] >= 3).most_common(1)
            if most and most[0][1] >= 4 and 2 * most[0][1] > n:
                return "table"
    if n and 2 * sum(1 for x in lines if ITEM.match(x)) > n:
        return "list"
    return None


def _kinds_of_char() -> np.ndarray:
    """0 letter, 1 digit, 2 punctuation, 3 symbol or damaged, 4 blank or unassigned, over all code points."""
    import unicodedata

    out = np.full(0x110000, 4, dtype=np.uint8)
    for cp in range(0x33480):  # nothing but tags, selectors and private use beyond
        cat = unicodedata.category(chr(cp))
        out[cp] = 0 if cat[0] in "LM" else 1 if cat[0] == "N" else 4 if cat[0] in "ZC" else 2 if cat[0] == "P" else 3
    for ch in "#%&*@\\[]{}§¶¿¡�":
        out[ord(ch)] = 3
    out[0x80:0x100][out[0x80:0x100] == 2] = 3
    return out


def _char_bins(codes: np.ndarray) -> np.ndarray:
    """16 bits of every character; those of the basic plane keep their own."""
    return (codes ^ (codes >> np.uint32(16)) * np.uint32(0x9E37)) & np.uint32(0xFFFF)


def _pair_bins(chars: np.ndarray) -> np.ndarray:
    mixed = chars[:-1] * np.uint32(0x9E3779B1) + chars[1:] * np.uint32(0x85EBCA77)
    return (mixed ^ mixed >> np.uint32(15)) * np.uint32(0xC2B2AE35) >> np.uint32(32 - PAIR_BITS)


_char_kinds: np.ndarray | None = None


def char_kinds() -> np.ndarray:
    global _char_kinds
    if _char_kinds is None:
        _char_kinds = _kinds_of_char()
    return _char_kinds


def _emissions(state: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Log-probability of each symbol in each state; rare symbols lean on their parts, taken as independent."""
    parts = [np.arange(N_SYMBOLS) >> FLAGS] + [np.arange(N_SYMBOLS) >> b & 1 for b in range(FLAGS)]
    counts = np.zeros((4, N_SYMBOLS))
    np.add.at(counts, (state, symbols), 1)
    apart = np.ones((4, N_SYMBOLS))
    for part in parts:
        seen = np.stack([np.bincount(part, weights=row, minlength=part.max() + 1) for row in counts]) + 0.5
        apart *= (seen / seen.sum(axis=1, keepdims=True))[:, part]
    return np.log((counts + 100.0 * apart) / (counts.sum(axis=1, keepdims=True) + 100.0))


def _readable(docs: list[tuple[list[str], str]]) -> list[str]:
    return ["\n".join(x) for x, k in docs if k in ("prose", "list")]


class LineModel:
    """Fitted parameters; small enough to travel with a task."""

    def __init__(self) -> None:
        # Counts of pairs by bin, log of each character's share times 2, log of its count plus 2: all characters are treated alike.
        self.pairs = np.zeros(1 << PAIR_BITS, dtype=np.float16)
        self.single = np.full(0x10000, 2.0 / 0x10000, dtype=np.float32)
        self.before = np.full(0x10000, np.log(2.0), dtype=np.float32)
        self.edges = np.zeros(5)
        self.start = np.log(np.full(4, 0.25))  # kept even: how common a kind is says little of a single text
        self.step = np.log(np.full((4, 4), 0.25))
        self.emit = np.zeros((4, N_SYMBOLS))
        self.fitted = False

    # Line statistics ---------------------------------------------------------------------------------------------

    def _fit_follow(self, texts: Iterable[str]) -> None:
        pairs, first, single = np.zeros(1 << PAIR_BITS), np.zeros(0x10000), np.full(0x10000, 0.5)
        for t in texts:
            chars = _char_bins(codes_of(t))
            np.add.at(pairs, _pair_bins(chars), 1)
            first += np.bincount(chars[:-1], minlength=0x10000)
            single += np.bincount(chars[1:], minlength=0x10000)
        self.pairs = np.minimum(pairs, 60_000).astype(np.float16)
        self.single = (2.0 * single / single.sum()).astype(np.float32)
        self.before = np.log(first + 2.0).astype(np.float32)

    def scores(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per line: mean log-likelihood of its characters, share of symbols, of digits, and of repeated pairs."""
        if not lines:
            return (np.zeros(0),) * 4
        sizes = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
        codes = codes_of("\n".join(lines) + "\n")
        begins = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        own = _char_bins(codes)
        step = np.log(self.pairs[_pair_bins(own)].astype(np.float32) + self.single[own[1:]]) - self.before[own[:-1]]
        step = np.append(step, np.float32(0))
        step[begins + sizes] = 0
        step[begins + sizes - 1] = 0
        likely = np.add.reduceat(step, begins) / np.maximum(sizes - 1, 1)
        kind = char_kinds()[codes]
        symbols = np.add.reduceat((kind == 3).astype(np.int32), begins) / sizes
        digits = np.add.reduceat((kind == 1).astype(np.int32), begins) / sizes
        repeats = np.zeros(len(lines))
        for lag in (1, 2, 4, 6, 8):  # multiples of the periods of repeated characters and short words
            same = np.zeros(len(codes), dtype=np.int32)
            same[lag:] = codes[lag:] == codes[:-lag]
            repeats = np.maximum(repeats, np.add.reduceat(same, begins) / sizes)
        return likely, symbols, digits, repeats

    def symbols(self, lines: list[str], first: np.ndarray, likely: np.ndarray | None = None) -> np.ndarray:
        """The symbol of each line; ``first`` marks the first line of each document."""
        own, signs, _, repeats = self.scores(lines)
        likely = own if likely is None else likely
        counts = np.array([cell_counts(x) for x in lines], dtype=np.int64).reshape(len(lines), len(SEPARATORS))
        alike = np.zeros(len(lines), dtype=bool)
        if len(lines) > 1:
            same = ((counts[1:] == counts[:-1]) & (counts[1:] >= 3)).any(axis=1) & ~first[1:]
            alike[1:] |= same
            alike[:-1] |= same
        item = np.fromiter((ITEM.match(x) is not None for x in lines), dtype=bool, count=len(lines))
        ends = np.fromiter((x.rstrip().endswith(_SENTENCE_END) for x in lines), dtype=bool, count=len(lines))
        long_ = np.fromiter((len(x) >= 16 for x in lines), dtype=bool, count=len(lines))
        grade = np.searchsorted(self.edges, likely)
        out = grade
        for flag in (ends, item, alike, signs > 0.25, repeats > 0.5, long_):
            out = out * 2 + flag
        return out

    # Fitting -----------------------------------------------------------------------------------------------------

    @staticmethod
    def fit(labelled: list[tuple[str, str]], rounds: int = 5) -> LineModel:
        """``labelled``: (text, kind). Each half of the documents is scored by the character statistics of the other,
        so that texts seen and unseen are graded alike. The first rounds keep to the labels (or prose); the later ones
        may overrule a label, as some are wrong."""
        docs = [(lines_of(folded(t)), k) for t, k in labelled if t and k in KINDS]
        docs = [(x, k) for x, k in docs if x]
        docs = docs[::2] + docs[1::2]
        half = (len(docs) + 1) // 2
        model = LineModel()
        model.fitted = bool(docs)
        model._fit_follow(_readable(docs))
        lines = [x for own, _ in docs for x in own]
        sizes = np.array([len(own) for own, _ in docs], dtype=np.int64)
        first = np.zeros(len(lines), dtype=bool)
        begins = np.cumsum(sizes) - sizes
        first[begins] = True
        labels = np.array([KINDS.index(k) for _, k in docs], dtype=np.int64)
        state = np.repeat(labels, sizes)
        scores = [np.zeros(0)]
        for own, others in ((docs[:half], docs[half:]), (docs[half:], docs[:half])):
            other = LineModel()
            other._fit_follow(_readable(others))
            scores.append(other.scores([x for x, _ in own for x in x])[0])
        likely = np.concatenate(scores)
        prose = likely[state == PROSE]
        low, mid, high = np.quantile(prose, (0.01, 0.05, 0.3)) if len(prose) else (-5.0, -4.0, -3.0)
        model.edges = np.array([low - 2.0, low - 0.5, low, mid, high])
        symbols = model.symbols(lines, first, likely) if lines else np.zeros(0, dtype=np.int64)
        allowed = np.full((len(docs), 4), -1e9)
        allowed[np.arange(len(docs)), labels] = 0
        allowed[:, PROSE] = 0
        doubt = np.full((len(docs), 4), -1.0)
        doubt[np.arange(len(docs)), labels] = 0
        for turn in range(rounds):
            model.emit = _emissions(state, symbols)
            move = np.ones((4, 4))
            inner = np.flatnonzero(~first)
            np.add.at(move, (state[inner - 1], state[inner]), 1)
            model.step = np.log(move / move.sum(axis=1, keepdims=True))
            if turn < rounds - 1 and lines:
                state = model.viterbi(symbols, sizes, allowed, allowed) if turn < 2 else model.viterbi(symbols, sizes, doubt)
        return model

    # Decoding ----------------------------------------------------------------------------------------------------

    def viterbi(self, symbols: np.ndarray, sizes: np.ndarray, begin: np.ndarray | None = None, always: np.ndarray | None = None) -> np.ndarray:
        """Most likely state of every line; all documents advance together, one line at a time.

        ``begin`` and ``always``: log weights of the states of a document at its first line and at every later one."""
        order = np.argsort(-sizes, kind="stable")
        begins = (np.cumsum(sizes) - sizes)[order]
        counts = sizes[order]
        none = np.zeros((len(sizes), 4))
        begin, bar = none if begin is None else begin[order], none if always is None else always[order]
        back = np.zeros((len(symbols), 4), dtype=np.int8)
        out = np.zeros(len(symbols), dtype=np.int64)
        n = int(np.count_nonzero(counts))
        best = self.start + self.emit[:, symbols[begins[:n]]].T + begin[:n]
        final = np.zeros(len(sizes), dtype=np.int64)
        for t in range(1, int(counts.max(initial=0)) + 1):
            live = int(np.searchsorted(-counts, -t, side="left"))  # documents with more than t lines
            final[live:n] = best[live:n].argmax(axis=1)
            best, n = best[:live], live
            if not live:
                break
            at = begins[:live] + t
            ways = best[:, :, None] + self.step
            back[at] = ways.argmax(axis=1)
            best = ways.max(axis=1) + self.emit[:, symbols[at]].T + bar[:live]
        state = final
        n = int(np.count_nonzero(counts))
        for t in range(int(counts.max(initial=0)) - 1, -1, -1):
            live = int(np.searchsorted(-counts, -t, side="left"))
            at = begins[:live] + t
            out[at] = state[:live]
            state[:live] = back[at, state[:live]]
        return out


FLAGS = 6
N_SYMBOLS = 6 << FLAGS
