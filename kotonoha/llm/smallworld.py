"""Navigable small-world graphs over sketches of short texts, in numpy.

A text is its set of three-character sequences, kept as sorted hashes. Its sketch has one byte for each of 64 ranges of the
hash space, taken from the smallest hash in it, so the share of equal bytes estimates the Jaccard similarity of two sets. Its
entry keys are the hashes, one for each of 12 ranges, that the fewest texts of the shard have.

A graph links every text to the nearest of those that stand next to it in the order of some entry key, both ways, and to a
random one for long steps. A search enters at the texts that share an entry key with the query, or at fixed
landmarks, and follows links: each query keeps a beam of the nearest texts seen and expands them until none is left
unexpanded; a block of queries moves in lockstep. Every text seen within ``NEAR`` is a candidate, whether or not it
stays in the beam. A query that sees as many near texts as its beam or a text's links hold may have missed more of them, so it is
compared with all sketches of the shard. When a graph is built, its beam is widened until all texts that are ``ALIKE`` to disturbed
members (a quarter of their set replaced), to members and to members with the most near links, the latter two by the shared keys, are
found as often as comparing with all sketches finds them; if no width does, it is searched exhaustively. What it finds of the texts that are
``ALIKE`` by exact overlap with all texts is kept as its recall.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BINS = 64
WORDS = BINS // 8
KEYS = 12
#: Differing bytes. At similarity 0.6 there are 26 on average, and at most 46 but for 3 standard deviations of the shortest texts and more.
NEAR = 46
LINKS = 10
BEAMS = (8, 16, 32, 64, 128)
#: Jaccard similarity of the texts that a search must find when its beam is chosen.
ALIKE = 0.5
LANDMARKS = 4
ENTRIES = 4
STEPS = 3
COUNTERS = 1 << 18
_GONE = np.int64(1) << 62
_HASH_BITS = 52
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_FIRST = np.uint64(42)
_LOW7, _HIGH = np.uint64(0x7F7F7F7F7F7F7F7F), np.uint64(0x8080808080808080)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def gram_sets(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(grams, offsets): of each text the sorted distinct hashes of its three-character sequences."""
    n = len(offsets) - 1
    counts = np.maximum(np.diff(offsets) - 2, 0)
    wide = codes.astype(np.uint64)
    out, sizes = [], np.zeros(n, dtype=np.int64)
    for at in range(0, n, 4096):  # the place in the chunk fits beside the hash in one number
        own = counts[at : at + 4096]
        owner = np.repeat(np.arange(len(own)), own)
        first = np.repeat(offsets[at : at + len(own)] - (np.cumsum(own) - own), own) + np.arange(len(owner))
        gram = _mixed(wide[first] << np.uint64(42) | wide[first + 1] << np.uint64(21) | wide[first + 2]) >> np.uint64(64 - _HASH_BITS)
        both = np.sort(owner.astype(np.uint64) << np.uint64(_HASH_BITS) | gram)
        both = both[np.concatenate((np.ones(min(1, len(both)), dtype=bool), both[1:] != both[:-1]))]
        sizes[at : at + len(own)] = np.bincount((both >> np.uint64(_HASH_BITS)).astype(np.int64), minlength=len(own))
        out.append(both & np.uint64((1 << _HASH_BITS) - 1))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64), np.concatenate(([0], np.cumsum(sizes)))


def _smallest(grams: np.ndarray, offsets: np.ndarray, bins: int) -> np.ndarray:
    """(n, bins): smallest hash in each range, 0 where there is none. Sorted hashes make it the first of each."""
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    place = owner * bins + (grams * np.uint64(bins) >> np.uint64(_HASH_BITS)).astype(np.int64)
    first = np.ones(len(place), dtype=bool)
    first[1:] = place[1:] != place[:-1]
    out = np.zeros(n * bins, dtype=np.uint64)
    out[place[first]] = grams[first] + np.uint64(1)
    return out.reshape(n, bins)


def _blocks(grams: np.ndarray, offsets: np.ndarray, size: int = 8192) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The sets in blocks of texts, to keep intermediate arrays small."""
    for at in range(0, max(len(offsets) - 1, 1), size):
        own = offsets[at : at + size + 1]
        yield grams[own[0] : own[-1]], own - own[0]


def sketches(grams: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(n, WORDS) uint64: one byte for each range. An empty range takes the byte of the next one that isn't, turned on."""
    return np.concatenate([_sketches(*block) for block in _blocks(grams, offsets)])


def _sketches(grams: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    low = _smallest(grams, offsets, BINS)
    place = np.where(low > 0, np.arange(BINS), 10 * BINS)
    ahead = np.minimum.accumulate(np.concatenate((place, place + BINS), axis=1)[:, ::-1], axis=1)[:, ::-1][:, :BINS]
    steps = np.minimum(ahead - np.arange(BINS), BINS).astype(np.uint64)
    source = np.where(ahead < 10 * BINS, ahead % BINS, 0)
    value = _mixed(np.take_along_axis(low, source, 1) + steps * np.uint64(0x9E3779B97F4A7C15))
    return np.ascontiguousarray((value >> np.uint64(56)).astype(np.uint8)).view(np.uint64)


def frequencies(grams: np.ndarray) -> np.ndarray:
    """In how many texts the hashes of each of COUNTERS classes occur, at most 4095."""
    return np.minimum(np.bincount((grams & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS), 4095).astype(np.uint16)


def entry_keys(grams: np.ndarray, offsets: np.ndarray, counts: np.ndarray, least: int) -> np.ndarray:
    """(n, KEYS) uint64: for each range the three rarest hashes among those that ``least`` texts have, 0 for none.

    The rarest stands in the high bits, so texts that share it stand together, those that share the next one closest.
    """
    return np.concatenate([_entry_keys(*block, counts, least) for block in _blocks(grams, offsets)])


def _entry_keys(grams: np.ndarray, offsets: np.ndarray, counts: np.ndarray, least: int) -> np.ndarray:
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    place = owner * KEYS + (grams * np.uint64(KEYS) >> np.uint64(_HASH_BITS)).astype(np.int64)
    seen = counts[(grams & np.uint64(COUNTERS - 1)).astype(np.int64)]
    use = seen >= least
    place, value = place[use], seen[use].astype(np.uint64) << np.uint64(_HASH_BITS) | grams[use]
    out = np.zeros(n * KEYS, dtype=np.uint64)
    if len(place):
        begins = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        sizes = np.diff(np.concatenate((begins, [len(place)])))
        for part in range(3):
            low = np.minimum.reduceat(value, begins)
            word = np.where(low == _NONE, np.uint64(0), _mixed(low) >> np.uint64(43))
            out[place[begins]] |= (word | np.uint64(1 << 21)) << np.uint64(42) if part == 0 else word << np.uint64(21 * (2 - part))
            value[value == np.repeat(low, sizes)] = _NONE
    return out.reshape(n, KEYS)


def _unlike(x: np.ndarray) -> np.ndarray:
    """Nonzero bytes of each word."""
    return np.bitwise_count(((x & _LOW7) + _LOW7 | x) & _HIGH)


def pair_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bytes of rows a[..., WORDS] and b[..., WORDS]."""
    return _unlike(a ^ b).sum(axis=-1, dtype=np.int64)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bytes of every row of a and every row of b."""
    out, x, y = (np.zeros((len(a), len(b)), dtype=kind) for kind in (np.uint8, np.uint64, np.uint64))
    for v, w in zip(np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)):  # _unlike without new arrays
        np.bitwise_xor(v[:, None], w, out=x)
        np.bitwise_and(x, _LOW7, out=y)
        y += _LOW7
        y |= x
        y &= _HIGH
        out += np.bitwise_count(y)
    return out


def _nearest(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest distinct keys of each row."""
    keys.sort(axis=1)
    keys[:, 1:][keys[:, 1:] == keys[:, :-1]] = _GONE
    keys.sort(axis=1)
    return keys[:, :width]


class Directory:
    """Texts in the order of each entry key."""

    def __init__(self, keys: np.ndarray, order: np.ndarray | None = None):
        self.order = np.argsort(keys, axis=0, kind="stable").astype(np.int32) if order is None else order
        self.sorted = np.take_along_axis(keys, self.order, 0)

    def entries(self, keys: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
        """(queries, places): texts to enter at, -1 for none: the ENTRIES next to each key that share its rarest hash, or
        else the landmarks."""
        n = len(self.order)
        out = np.full((len(keys), ENTRIES * KEYS + len(landmarks)), -1, dtype=np.int64)
        for t in range(KEYS):
            column, at = self.sorted[:, t], np.searchsorted(self.sorted[:, t], keys[:, t])
            for more in range(ENTRIES):
                place = at + more - ENTRIES // 2
                inside = np.clip(place, 0, n - 1)
                hit = (column[inside] >> _FIRST == keys[:, t] >> _FIRST) & (keys[:, t] != 0) & (place == inside)
                out[hit, ENTRIES * t + more] = self.order[inside[hit], t]
        lost = (out < 0).all(axis=1)
        out[lost, ENTRIES * KEYS :] = landmarks
        return out


class Graph:
    """One shard: sketches, frequencies, entry keys and links of its texts."""

    def __init__(self, sketch: np.ndarray, counts: np.ndarray, keys: np.ndarray, links: np.ndarray, beam: int, order: np.ndarray | None = None):
        self.sketch, self.counts, self.keys, self.links, self.beam = sketch, counts, keys, links, beam
        self.directory = Directory(keys, order)
        self.recall: float | None = None  # measured while the graph is built
        self.crowd = np.zeros(len(sketch), dtype=np.int64)  # near links of each text, known while the graph is built
        self.landmarks = np.unique(np.linspace(0, len(sketch) - 1, LANDMARKS).astype(np.int64)) if len(sketch) else np.zeros(0, dtype=np.int64)

    @staticmethod
    def build(grams: np.ndarray, offsets: np.ndarray, tuned: bool = True) -> Graph:
        sketch, counts = sketches(grams, offsets), frequencies(grams)
        n = len(sketch)
        graph = Graph(sketch, counts, entry_keys(grams, offsets, counts, 1), np.zeros((n, 0), dtype=np.int32), BEAMS[0])
        # A hash of one text only can't join two texts, so links go by the rarest of the shared ones.
        shared = Directory(entry_keys(grams, offsets, counts, 2))
        best = np.full((n, LINKS), _GONE)
        for t in range(KEYS):
            order, own = shared.order[:, t].astype(np.int64), shared.sorted[:, t]
            found = np.full((n, LINKS + 2 * STEPS), _GONE)
            found[:, :LINKS] = best
            for step in range(1, min(STEPS, n - 1) + 1):
                a, b = order[:-step], order[step:]
                same = (own[step:] >> _FIRST == own[:-step] >> _FIRST) & (own[step:] != 0)
                a, b = a[same], b[same]
                d = pair_distances(sketch[a], sketch[b]) << 32
                found[a, LINKS + 2 * step - 2], found[b, LINKS + 2 * step - 1] = d | b, d | a
            best = _nearest(found, LINKS)
        near = np.where(best < _GONE, best & 0xFFFFFFFF, -1).astype(np.int32)
        graph.crowd = (best >> 32 <= NEAR).sum(axis=1)
        far = np.random.default_rng(n).integers(0, max(n, 1), (n, 1)).astype(np.int32)
        graph.links = np.concatenate((near, _reverse(near, best >> 32), far), axis=1)
        if tuned and n:
            graph._tune(grams, offsets)
        return graph

    def _tune(self, grams: np.ndarray, offsets: np.ndarray, sample: int = 200, least: float = 0.97) -> None:
        n = len(self.sketch)
        rng = np.random.default_rng(n + 1)
        chosen = rng.choice(n, min(n, sample), replace=False)
        sets = []
        for i in chosen.tolist():
            own = grams[offsets[i] : offsets[i + 1]]
            kept = own[rng.random(len(own)) >= 0.25]
            others = grams[rng.integers(0, len(grams), len(own) - len(kept))]  # what other texts hold, as edits bring in
            sets.append(np.unique(np.concatenate((kept, others))))
        crowded = np.argsort(-self.crowd, kind="stable")[: len(chosen)]
        shared = self.shared_directory(grams, offsets)
        trials = [(_joined(sets), None)] + [(_joined([grams[offsets[i] : offsets[i + 1]] for i in own.tolist()]), shared) for own in (chosen, crowded)]
        trials = [(own, at, sketches(own, at), keys) for (own, at), keys in trials]
        truths = []
        for own, at, sketch, _ in trials:
            q, t = self._all(sketch)
            good = jaccard(own, at, grams, offsets, q, t) >= ALIKE
            truths.append(q[good] << 32 | t[good])
        for beam in BEAMS:
            self.beam = beam
            for truth, (own, at, sketch, keys) in zip(truths, trials):
                q, t = self.search(own, at, sketch, keys)
                if np.isin(truth, q << 32 | t).sum() < least * len(truth):
                    break
            else:
                break
        else:
            self.beam = 0
        self.recall = self._recall(trials, grams, offsets)

    def _recall(self, trials: list[tuple], grams: np.ndarray, offsets: np.ndarray, sample: int = 20) -> float:
        """Share of the texts ALIKE to the first queries of each trial, by exact overlap with every text of the shard, that a search sees."""
        parts, found, n = [], [], 0
        for own, at, sketch, keys in trials:
            k = min(sample, len(at) - 1)
            parts += [own[at[i] : at[i + 1]] for i in range(k)]
            q, t = self.search(own[: at[k]], at[: k + 1], sketch[:k], keys)
            found.append(q + n << 32 | t)
            n += k
        own, at = _joined(parts)
        if not len(own):
            return 1.0
        order = np.argsort(own, kind="stable")
        known, query = own[order], np.repeat(np.arange(n), np.diff(at))[order]
        perhaps = np.zeros(COUNTERS, dtype=bool)  # lets most go before the search
        perhaps[(known & np.uint64(COUNTERS - 1)).astype(np.int64)] = True
        hits = np.flatnonzero(perhaps[(grams & np.uint64(COUNTERS - 1)).astype(np.int64)])
        low = np.searchsorted(known, grams[hits])
        low[low == len(known)] = 0
        real = known[low] == grams[hits]
        hits, low = hits[real], low[real]
        count = np.searchsorted(known, known[low], side="right") - low
        place = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
        texts = len(offsets) - 1
        owner = np.searchsorted(offsets, hits, side="right") - 1
        shared = np.bincount(query[place] * texts + np.repeat(owner, count), minlength=n * texts).reshape(n, texts)
        q, t = np.nonzero(shared >= ALIKE * (np.diff(at)[:, None] + np.diff(offsets)[None, :] - shared))
        return float(np.isin(q << 32 | t, np.concatenate(found)).mean()) if len(q) else 1.0

    def shared_directory(self, grams: np.ndarray, offsets: np.ndarray) -> Directory:
        """Directory for searches among the shard's own texts, whose sets these are: a hash that only the query has leads
        nowhere then, so keys are made of hashes of two texts at least."""
        return Directory(entry_keys(grams, offsets, self.counts, 2))

    def search(self, grams: np.ndarray, offsets: np.ndarray, sketch: np.ndarray, shared: Directory | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(query, text) for all texts seen within NEAR of a query; with ``shared`` the queries are the shard's own texts."""
        out = list(self.found(grams, offsets, sketch, shared)) or [(np.zeros(0, dtype=np.int64),) * 2]
        return np.concatenate([q for q, _ in out]), np.concatenate([t for _, t in out])

    def found(self, grams: np.ndarray, offsets: np.ndarray, sketch: np.ndarray, shared: Directory | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The pairs of ``search`` in parts, each with all pairs of its queries: in crowds of near texts they are many."""
        if not len(self.sketch) or not len(sketch):
            return
        if not self.beam or len(self.sketch) <= 128:
            yield from self._exact(sketch, np.arange(len(sketch)))
            return
        keys, step = entry_keys(grams, offsets, self.counts, 2 if shared else 1), 4096
        directory, few = shared or self.directory, min(self.beam, LINKS)
        for at in range(0, len(sketch), step):
            q, t = self._block(sketch[at : at + step], directory.entries(keys[at : at + step], self.landmarks))
            full = np.bincount(q, minlength=min(step, len(sketch) - at)) >= few
            yield q[~full[q]] + at, t[~full[q]]
            yield from self._exact(sketch, at + np.flatnonzero(full))

    def _exact(self, sketch: np.ndarray, chosen: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for at in range(0, len(chosen), 256):
            own = chosen[at : at + 256]
            q, t = self._all(sketch[own])
            yield own[q], t

    def _all(self, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, text) for all texts within NEAR, in tiles that stay in the cache."""
        parts = [(np.zeros(0, dtype=np.int64),) * 2]
        for i in range(0, len(sketch), 64):
            for j in range(0, len(self.sketch), 4096):
                q, t = np.nonzero(distances(sketch[i : i + 64], self.sketch[j : j + 4096]) <= NEAR)
                parts.append((q + i, t + j))
        return np.concatenate([q for q, _ in parts]), np.concatenate([t for _, t in parts])

    def _block(self, sketch: np.ndarray, enter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        beam, live, hits = self.beam, np.arange(len(sketch)), []

        def step(texts: np.ndarray) -> np.ndarray:
            """Keys (distance, text, expanded) of a matrix of texts, -1 for none; notes the near ones."""
            q, c = np.nonzero(texts >= 0)
            t = texts[q, c]
            d = pair_distances(self.sketch[t], sketch[live[q]])
            hits.append((live[q[d <= NEAR]] << 32) | t[d <= NEAR])
            out = np.full(texts.shape, _GONE)
            out[q, c] = d << 33 | t << 1
            return out

        at = np.sort(step(enter), axis=1)
        at[:, 1:][(at[:, 1:] == at[:, :-1])] = _GONE
        at = np.sort(at, axis=1)[:, :beam]
        while True:
            rows, picked = np.arange(len(live)), []
            for _ in range(3):
                col = ((at & 1 == 0) & (at < _GONE)).argmax(axis=1)
                key = at[rows, col]
                some = (key & 1 == 0) & (key < _GONE)
                picked.append(np.where(some, (key >> 1) & 0xFFFFFFFF, -1))
                at[rows, col] |= some
            picked = np.stack(picked, axis=1)
            go = picked[:, 0] >= 0
            live, at, picked = live[go], at[go], picked[go]
            if not len(live):
                break
            links = np.where(picked[:, :, None] >= 0, self.links[picked], -1).reshape(len(live), -1).astype(np.int64)
            merged = np.concatenate((at, step(links)), axis=1)
            merged.sort(axis=1)
            same = (merged[:, 1:] >> 1 == merged[:, :-1] >> 1) & (merged[:, 1:] < _GONE)
            merged[:, :-1][same] = _GONE  # of equal texts the expanded one stands last and stays
            merged.sort(axis=1)
            at = np.ascontiguousarray(merged[:, :beam])
        pairs = np.unique(np.concatenate(hits)) if hits else np.zeros(0, dtype=np.int64)
        return pairs >> 32, pairs & 0xFFFFFFFF


def _rarest(grams: np.ndarray, offsets: np.ndarray, similarity: float, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(grams, owner): of each set x its rarest |x| - ceil(similarity |x|) + 1 elements, ties by hash. What is that similar has one of them."""
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((grams, seen, owner))
    place = np.arange(len(grams)) - np.repeat(offsets[:-1], sizes)
    keep = place < np.repeat(sizes - np.ceil(similarity * sizes - 1e-9).astype(np.int64) + 1, sizes)
    return grams[order][keep], owner[keep]


class Prefixes:
    """Exact candidates by prefix filtering: of two sets with a Jaccard similarity of at least t, the rarest |x| - ceil(t |x|) + 1
    elements of one have an element in common with those of the other, in any order of elements that is the same for both."""

    def __init__(self, grams: np.ndarray, offsets: np.ndarray, similarity: float):
        self.similarity = similarity
        self.known, counts = np.unique(grams, return_counts=True)
        self.counts = counts
        kept, owner = self._prefix(grams, offsets)
        order = np.argsort(kept, kind="stable")
        self.grams, self.owner = kept[order], owner[order]

    def _prefix(self, grams: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.known, grams)
        at[at == len(self.known)] = 0
        seen = np.where(self.known[at] == grams, self.counts[at], 0) if len(self.known) else np.zeros(len(grams), dtype=np.int64)
        return _rarest(grams, offsets, self.similarity, seen)

    def sharing(self, grams: np.ndarray, offsets: np.ndarray, most: int = 1 << 22) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, text) that may be similar, each once, with all pairs of a query together."""
        kept, owner = self._prefix(grams, offsets)
        low, high = np.searchsorted(self.grams, kept, side="left"), np.searchsorted(self.grams, kept, side="right")
        ends = np.searchsorted(owner, np.arange(1, len(offsets)))
        total = np.concatenate(([0], np.cumsum(high - low)))[ends]
        first, n = 0, len(offsets) - 1
        while first < n:
            last = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + most, side="right")))
            own = slice(ends[first - 1] if first else 0, ends[last - 1])
            count = high[own] - low[own]
            query = np.repeat(owner[own], count)
            text = self.owner[np.repeat(low[own] - (np.cumsum(count) - count), count) + np.arange(len(query))]
            pairs = np.unique(query.astype(np.int64) << 32 | text)
            yield pairs >> 32, pairs & 0xFFFFFFFF
            first = last


def _joined(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate(sets), np.concatenate(([0], np.cumsum([len(s) for s in sets])))


def _reverse(near: np.ndarray, far: np.ndarray) -> np.ndarray:
    """For each text the nearest LINKS of those that link to it."""
    n = len(near)
    source, target, far = np.repeat(np.arange(n, dtype=np.int32), near.shape[1]), near.ravel(), far.ravel()
    real = target >= 0
    source, target, far = source[real], target[real].astype(np.int64), far[real]
    order = np.argsort(target << 16 | far, kind="stable")
    source, target = source[order], target[order]
    starts = np.concatenate(([0], np.cumsum(np.bincount(target, minlength=n))))
    place = np.arange(len(target)) - starts[target]
    out = np.full((n, LINKS), -1, dtype=np.int32)
    few = place < LINKS
    out[target[few], place[few]] = source[few]
    return out


def jaccard(grams_a: np.ndarray, off_a: np.ndarray, grams_b: np.ndarray, off_b: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact Jaccard similarity of the sets a[i] and b[i]."""
    out = np.zeros(len(a))
    for at in range(0, len(a), 4096):  # the place in the chunk fits beside the hash in one number
        x, y = a[at : at + 4096], b[at : at + 4096]
        keys, sizes = [], []
        for grams, offsets, own in ((grams_a, off_a, x), (grams_b, off_b, y)):
            size = offsets[own + 1] - offsets[own]
            owner = np.repeat(np.arange(len(own)), size)
            place = np.arange(len(owner)) + np.repeat(offsets[own] - (np.cumsum(size) - size), size)
            keys.append(owner.astype(np.uint64) << np.uint64(_HASH_BITS) | grams[place])
            sizes.append(size)
        key = np.sort(np.concatenate(keys))  # a hash is in a set at most once, so twice means shared
        shared = key[1:][key[1:] == key[:-1]]
        both = np.bincount((shared >> np.uint64(_HASH_BITS)).astype(np.int64), minlength=len(x))
        union = sizes[0] + sizes[1] - both
        out[at : at + 4096] = np.where(union > 0, both / np.maximum(union, 1), 1.0)
    return out
