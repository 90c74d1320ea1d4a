"""Evaluation texts leaking into training text.

``LeakIndex.build`` cuts the documents into shards of bounded length and writes an FM-index of each (see ``fmindex``) to the shared
folder, once; any number of item sets is searched against it. The items are written in blocks of about ``block_chars`` characters
and reduced by each worker to phrase patterns: for every run of ``min_run`` characters of an item, the phrases that any
text with that run must contain. Backward search finds their rows, sampled positions locate them, and comparing the
texts around each place gives the longest common run; those of at least ``min_run`` characters are kept and
overlapping spans of an item in a document are merged. A task holds a few shards and takes all blocks in turn. Nothing is
shuffled but the items; only found spans leave a task, and neither items nor documents come to the driver.

Texts are compared in bare form (see ``forms``). Runs too uniform to hold a phrase are looked for where the text
holds no phrase either, by hashes of whole runs, so the result is exact.

Cases: null texts and texts shorter than a run contain nothing; items shorter than a run can't be found; items with
equal texts are all reported; a document with null id is reported under null; repeated rows give repeated spans,
which ``affected`` makes distinct; a document longer than a shard is a shard of its own; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.staging import Stage, filesystem
from . import fmindex
from .forms import bare_batch, bare_codes, codes_of

MIN_RUN = 50
SHARD_CHARS = 4_000_000
BLOCK_CHARS = 2_000_000
#: Shards that a task searches with one block before it takes the next.
SHARDS_AT_ONCE = 6


class Patterns:
    """Phrase patterns of a block of items."""

    def __init__(self, items: list[tuple[int, str]], min_run: int):
        self.min_run = min_run
        forms = [(i, f) for i, f in zip([i for i, _ in items], bare_batch([t for _, t in items])) if f is not None and len(f) >= min_run]
        by_form: dict[str, list[int]] = {}
        for i, f in forms:
            by_form.setdefault(f, []).append(i)
        self.forms = sorted(by_form)
        self.item_ids = [by_form[f] for f in self.forms]
        self.literal: list[tuple[int, int]] = []  # form, start of a run without a phrase
        seqs, self.form, self.at, self.span = [], [], [], []
        for k, f in enumerate(self.forms):
            codes = codes_of(f)
            cut = fmindex.cuts(codes)
            hashes = fmindex.phrase_hashes(codes, cut[:-1], cut[1:]) if len(cut) > 1 else np.zeros(0, dtype=np.uint64)
            runs = np.arange(len(codes) - min_run + 1)
            low = np.searchsorted(cut, runs + fmindex.BEFORE)
            high = np.searchsorted(cut, runs + min_run - 1 - fmindex.AFTER, side="right") - 1
            self.literal += [(k, p) for p in runs[high <= low].tolist()]
            # A pattern that holds a shorter one of the same item is implied by it.
            least, end = [], len(cut)
            for lo, hi in sorted(set(zip(low[high > low].tolist(), high[high > low].tolist())), key=lambda x: (-x[0], x[1])):
                if hi < end:
                    least.append((lo, hi))
                    end = hi
            for lo, hi in least:
                seqs.append(hashes[lo:hi])
                self.form.append(k)
                self.at.append(int(cut[lo]))
                self.span.append(int(cut[hi] - cut[lo]))
        self.lengths = np.array([len(s) for s in seqs], dtype=np.int64)
        self.hashes = np.zeros((len(seqs), max(self.lengths, default=1)), dtype=np.uint64)
        for row, s in zip(self.hashes, seqs):
            row[: len(s)] = s
        runs = np.stack([codes_of(self.forms[k])[p : p + min_run] for k, p in self.literal]) if self.literal else np.zeros((0, min_run), dtype=np.uint32)
        self.literal_hashes = _run_hashes(runs)
        self.literal_order = np.argsort(self.literal_hashes, kind="stable")
        self.form, self.at, self.span = (np.array(x, dtype=np.int64) for x in (self.form, self.at, self.span))
        self.codes = [codes_of(f) for f in self.forms]
        pad = min_run
        self.padded = np.zeros(sum(len(c) + pad for c in self.codes) + pad, dtype=np.uint32)
        self.base = np.zeros(len(self.codes), dtype=np.int64)
        at = pad
        for k, c in enumerate(self.codes):
            self.base[k] = at
            self.padded[at : at + len(c)] = c
            at += len(c) + pad

    def runs_in(self, index: fmindex.FMIndex) -> np.ndarray:
        """Rows (form, start, end): where the text of the index, in which 0 parts documents, shares a run with an item."""
        out, codes = [], index.codes
        if len(self.lengths) and len(codes) >= self.min_run:
            low, high = index.search(index.symbols_of(self.hashes), self.lengths)
            counts = np.maximum(high - low, 0)
            pattern = np.repeat(np.arange(len(low)), counts)
            rows = np.repeat(low, counts) + np.arange(len(pattern)) - np.repeat(np.cumsum(counts) - counts, counts)
            for part in range(0, len(rows), 1 << 16):
                at, own = index.locate(rows[part : part + (1 << 16)]), pattern[part : part + (1 << 16)]
                out.append(self._extend(codes, at, own))
        if self.literal and len(codes) >= self.min_run:
            out.append(self._uniform(index))
        return np.concatenate(out) if out else np.zeros((0, 3), dtype=np.int64)

    def _uniform(self, index: fmindex.FMIndex) -> np.ndarray:
        """Places of the runs without a phrase: only where the text has fewer than two cuts can they be."""
        codes, n = index.codes, len(index.codes) - self.min_run + 1
        before = np.zeros(len(codes) + 1, dtype=np.int32)
        before[index.cuts + 1] = 1
        np.cumsum(before, out=before)
        at = np.flatnonzero(before[self.min_run - fmindex.AFTER : self.min_run - fmindex.AFTER + n] - before[fmindex.BEFORE : fmindex.BEFORE + n] < 2)
        windows, out = np.lib.stride_tricks.sliding_window_view(codes, self.min_run), [np.zeros((0, 3), dtype=np.int64)]
        known = self.literal_hashes[self.literal_order]
        for part in range(0, len(at), 1 << 14):
            own = at[part : part + (1 << 14)]
            hashes = _run_hashes(windows[own])
            low, high = np.searchsorted(known, hashes, side="left"), np.searchsorted(known, hashes, side="right")
            count = high - low
            place = np.repeat(own, count)
            which = self.literal_order[np.repeat(low - (np.cumsum(count) - count), count) + np.arange(len(place))]
            rows = np.array([self.literal[w] for w in which.tolist()], dtype=np.int64).reshape(-1, 2)
            good = np.array([np.array_equal(codes[p : p + self.min_run], self.codes[k][q : q + self.min_run]) for p, (k, q) in zip(place.tolist(), rows.tolist())], dtype=bool)
            out.append(np.stack((rows[:, 0], place, place + self.min_run), axis=1)[good])
        return np.concatenate(out)

    def _extend(self, codes: np.ndarray, at: np.ndarray, pattern: np.ndarray) -> np.ndarray:
        """Common run around each place, looked at as far as ``min_run`` characters to either side."""
        reach, n = self.min_run, len(codes)
        mine, span = self.base[self.form[pattern]] + self.at[pattern], self.span[pattern]

        def same(places: np.ndarray, own: np.ndarray) -> np.ndarray:
            inside = (places >= 0) & (places < n) & (own >= 0) & (own < len(self.padded))
            a, b = codes[np.where(inside, places, 0)], self.padded[np.where(inside, own, 0)]
            return inside & (a == b) & (a != 0)

        step = np.arange(reach)
        left = np.logical_and.accumulate(same((at - 1)[:, None] - step, (mine - 1)[:, None] - step), axis=1).sum(axis=1)
        right = np.logical_and.accumulate(same((at + span)[:, None] + step, (mine + span)[:, None] + step), axis=1).sum(axis=1)
        middle = np.ones(len(at), dtype=bool)
        for d in range(int(span.max(initial=0))):
            inner = d < span
            middle[inner] &= same(at[inner] + d, mine[inner] + d)
        good = middle & (left + span + right >= self.min_run)
        return np.stack((self.form[pattern][good], (at - left)[good], (at + span + right)[good]), axis=1)


def _merged(rows: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Union of overlapping spans of each form."""
    last = None
    for k, a, b in rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))].tolist():
        if last and last[0] == k and a <= last[2]:
            last = (k, last[1], max(last[2], b))
        else:
            if last:
                yield last
            last = (k, a, b)
    if last:
        yield last


def _run_hashes(runs: np.ndarray) -> np.ndarray:
    weights = np.cumprod(np.full(runs.shape[1], 0x9E3779B97F4A7C15, dtype=np.uint64))
    return (runs.astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)


_INDEX = pa.schema([("n_docs", pa.int64()), ("ids", pa.binary()), ("begins", pa.binary()), ("text", pa.binary()), ("index", pa.binary())])
_INDEX_DDL = "n_docs long, ids binary, begins binary, text binary, index binary"
_SPANS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
_NO_ID = np.iinfo(np.int64).min


def _packed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unpacked(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _build(shard_chars: int):
    def shard(ids: list, texts: list) -> pa.RecordBatch:
        codes, offsets = bare_codes(texts)
        lengths = np.diff(offsets)
        apart = np.zeros(len(codes) + len(texts), dtype=np.uint32)
        begins = offsets[:-1] + np.arange(len(texts))
        apart[np.arange(len(codes)) + np.repeat(np.arange(len(texts)), lengths)] = codes
        own = np.array([_NO_ID if i is None else i for i in ids], dtype=np.int64)
        text = apart.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
        row = [len(ids), own.tobytes(), begins.astype(np.int64).tobytes(), _packed(text), _packed(fmindex.FMIndex(apart).dump())]
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _INDEX)], schema=_INDEX)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not t:
                    continue
                if texts and size + len(t) > shard_chars:
                    yield shard(ids, texts)
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t)
        if texts:
            yield shard(ids, texts)

    return run


class _Shard:
    def __init__(self, row: dict):
        self.ids, self.begins = np.frombuffer(row["ids"], dtype=np.int64), np.frombuffer(row["begins"], dtype=np.int64)
        self.index = fmindex.FMIndex(codes_of(_unpacked(row["text"]).decode("utf-8", "surrogatepass")), _unpacked(row["index"]))

    def spans(self, patterns: Patterns) -> pa.RecordBatch:
        found: list[tuple] = []
        for k, a, b in _merged(patterns.runs_in(self.index)):
            d = int(np.searchsorted(self.begins, a, side="right")) - 1
            doc = int(self.ids[d])
            found += [(None if doc == _NO_ID else doc, i, a - int(self.begins[d]), b - int(self.begins[d])) for i in patterns.item_ids[k]]
        return pa.RecordBatch.from_arrays([pa.array([x[c] for x in found], pa.int64()) for c in range(4)], schema=_SPANS)


_patterns: OrderedDict[tuple[str, int], Patterns] = OrderedDict()


def _block(uri: str, min_run: int) -> Patterns:
    """The patterns of a written block of items; a worker keeps the last ones."""
    if (uri, min_run) not in _patterns:
        system, path = filesystem(uri)
        with system.open_input_file(path) as source:
            rows = pq.read_table(source)
        _patterns[uri, min_run] = Patterns(list(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist())), min_run)
        while len(_patterns) > 4:
            _patterns.popitem(last=False)
    _patterns.move_to_end((uri, min_run))
    return _patterns[uri, min_run]


def _search(blocks: list[str], min_run: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[_Shard] = []
        for batch in batches:
            for at in range(batch.num_rows):
                held.append(_Shard(batch.slice(at, 1).to_pylist()[0]))
                if len(held) == SHARDS_AT_ONCE:
                    yield from group(held)
                    held = []
        yield from group(held)

    def group(held: list[_Shard]) -> Iterator[pa.RecordBatch]:
        for uri in blocks if held else []:
            for shard in held:
                yield shard.spans(_block(uri, min_run))

    return run


class LeakIndex:
    """The FM-index of a corpus, a row for each shard."""

    def __init__(self, stage: Stage, shards: DataFrame):
        self.stage, self.shards = stage, shards

    @staticmethod
    def build(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shard_chars: int = SHARD_CHARS, stage: Stage | None = None) -> LeakIndex:
        stage = stage or Stage(documents.sparkSession, "leaks")
        docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        return LeakIndex(stage, stage.write(docs.mapInArrow(_build(shard_chars), _INDEX_DDL), "index"))

    def spans(self, items: DataFrame, *, item_id: str = "item_id", item_text: str = "text", min_run: int = MIN_RUN, block_chars: int = BLOCK_CHARS) -> DataFrame:
        """(doc_id, item_id, start, end): spans of the bare form of a document to remove, with the item they come from."""
        rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text")).where(F.col("text").isNotNull())
        chars = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
        blocks = self.stage.write(rows.repartition(max(1, math.ceil(chars / block_chars)), F.xxhash64("item_id", "text")), "items")
        return self.shards.mapInArrow(_search(sorted(blocks.inputFiles()), min_run), "doc_id long, item_id long, start long, end long")


def leaked_spans(
    documents: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    min_run: int = MIN_RUN, shard_chars: int = SHARD_CHARS, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``LeakIndex.spans`` over an index built for this one search."""
    return LeakIndex.build(documents, doc_id=doc_id, text=text, shard_chars=shard_chars).spans(items, item_id=item_id, item_text=item_text, min_run=min_run, block_chars=block_chars)


def affected(spans: DataFrame) -> DataFrame:
    """(doc_id, item_id): each document with the items it contains."""
    return spans.select("doc_id", "item_id").distinct()
