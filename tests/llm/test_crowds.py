import random

import numpy as np
import pandas as pd

from kotonoha.llm import history, smallworld


def crowded_texts(n, group, edits, seed):
    """Unrelated texts, then as many near copies of one of them."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("アイウエオカキクケコサシスセソ漢字時分港駅") for _ in range(rng.randint(2, 6))) for _ in range(400)]
    texts = ["".join(rng.choice(words) for _ in range(22)) for _ in range(n)]
    for _ in range(group):
        own = list(texts[0])
        for _ in range(edits):
            own[rng.randrange(len(own))] = rng.choice("ー円月日年火水木金土")
        texts.append("".join(own))
    return texts


def similar(grams, offsets, q, t):
    good = (smallworld.jaccard(grams, offsets, grams, offsets, q, t) >= 0.6) & (q != t)
    return set(zip(q[good].tolist(), t[good].tolist()))


def test_crowd_of_near_copies_is_found_whole():
    grams, offsets = history._grams(crowded_texts(3000, 300, 3, 7))
    graph = smallworld.Graph.build(grams, offsets)
    want = similar(grams, offsets, *graph._all(graph.sketch))
    assert len(want) > 10_000
    for shared in (None, graph.shared_directory(grams, offsets)):
        assert similar(grams, offsets, *graph.search(grams, offsets, graph.sketch, shared)) == want


def test_beam_is_widened_for_texts_that_only_the_shared_keys_lead_to():
    grams, offsets = history._grams(crowded_texts(3000, 300, 3, 7))
    graph = smallworld.Graph.build(grams, offsets, tuned=False)
    crippled, graph.links = graph.links, np.full_like(graph.links, -1)
    plain, graph.shared_directory = graph.shared_directory, lambda g, o: smallworld.Directory(np.zeros_like(graph.keys))
    graph._tune(grams, offsets)
    assert graph.beam == 0  # no width finds them, so all are compared
    graph.links, graph.shared_directory = crippled, plain
    graph._tune(grams, offsets)
    assert graph.beam > 0


def test_search_walks_through_far_texts():
    grams, offsets = history._grams(crowded_texts(100, 0, 0, 3))
    graph = smallworld.Graph.build(grams, offsets, tuned=False)
    graph.links, graph.beam = (np.arange(100, dtype=np.int32)[:, None] + 1) % 100, 128
    assert smallworld.distances(graph.sketch[57:58], graph.sketch[:1])[0, 0] > 52
    q, t = graph._block(graph.sketch[57:58], np.array([[0, -1]]))
    assert (0, 57) in zip(q.tolist(), t.tolist())


def test_shard_of_thousands_equals_brute_force_on_whole_sets():
    forms = crowded_texts(2500, 250, 3, 9)
    ids = [f"s{i:05d}" for i in range(len(forms))]
    rows = list(history._build(0.6)(iter([pd.DataFrame({"id": ids, "form": forms})])))
    pairs = {(a, b) for r in rows[1:] for a, b in zip(r["a"], r["b"])}
    grams, offsets = history._grams(forms)
    names, place = np.unique(grams, return_inverse=True)
    has = np.zeros((len(forms), len(names)), dtype=np.float32)
    has[np.repeat(np.arange(len(forms)), np.diff(offsets)), place] = 1
    both, size = has @ has.T, np.diff(offsets)
    a, b = np.nonzero(np.triu(both / (size[:, None] + size[None, :] - both) >= 0.6, 1))
    want = {(ids[x], ids[y]) for x, y in zip(a.tolist(), b.tolist())}
    assert pairs == want and len(want) > 10_000
