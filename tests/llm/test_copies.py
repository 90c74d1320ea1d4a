import json
import random

from pyspark.sql import functions as F

from kotonoha.llm.forms import bare_form, looks_same
from kotonoha.llm import copies, history, lookalike, smallworld
from kotonoha.plans.staging import Stage


def rows(df):
    return sorted(tuple(r) for r in df.collect())


VARIANTS = ["ガード Café", "ｶﾞｰﾄﾞ Café", "ガード​　Café", "ガード Cafe", "", "​", None, "二ロ", "ニ口", "x" * 30000, "x" * 29999 + "х"]


def test_lookalike_classes_against_plain_definition(spark):
    data = [(f"r{i:02d}", "f", v, "noise") for i, v in enumerate(VARIANTS)] * 2 + [("r50", "g", VARIANTS[1], "noise")]
    df = spark.createDataFrame(data, "id string, field string, text string, __form string").drop("__form").withColumn("first_id", F.lit("clash"))
    groups = {}
    for i, f, v, _ in sorted(set(data)):
        if v is not None:
            groups.setdefault((f, looks_same(v)), []).append((i, v))
    want = {(f, own[0][0], i) for (f, _), own in groups.items() for i, v in own if v != own[0][1]}
    assert set(rows(lookalike.differing_members(df, "id", "text", ("field",)))) == want and len(want) == 5
    out = lookalike.canonical_texts(df, "id", "text", ("field",)).collect()
    assert {looks_same(r["canonical_text"]) for r in out if r["id"] in ("r00", "r01", "r02")} == {"ガード Café"}
    assert len({r["canonical_text"] for r in out if r["field"] == "f"}) == len([k for k in groups if k[0] == "f"])
    assert lookalike.differing_members(df.limit(0), "id", "text", ("field",)).count() == 0
    assert spark.range(1).select(lookalike.looks_equal(F.lit("ｶﾞ"), F.lit("ガ"))).first()[0]


def test_ledger_counts_batches_like_one_pass(spark):
    rng = random.Random(3)
    texts = ["Ａ b。", "ab", "AB", "か き", "かき!", "。", "…", "hot"] + [f"t{k}" for k in range(5)]
    records = [(f"id{k:03d}", rng.choice(texts) if k % 3 else "h o t", 1 + k % 4) for k in range(200)]
    records += [(i, t, b + 1) for i, t, b in records[::9]] + [("null", None, 1), (None, "ab", 2)]
    df = spark.createDataFrame(records, "id string, t string, b int").withColumn("copies", F.lit(1)).select("*", copies.text_key("t").alias("k"))
    ledger = copies.CopyLedger(spark, Stage(spark, "t"), 4)
    for b in range(1, 7):
        ledger.add(df.where(F.col("b") == b).select(F.lit("s").alias("space"), "id", "k.k1", "k.k2"))
        if b == 4:
            ledger.compact()
    groups = {}
    for i, t in {(i, t) for i, t, _ in records if i and t is not None}:
        groups.setdefault(bare_form(t), []).append(i)
    assert set(rows(copies.copies_of(ledger))) == {("s", min(g), i) for g in groups.values() for i in g if i != min(g)}
    assert set(rows(copies.groups_of(ledger))) == {("s", min(g), len(g)) for g in groups.values()}
    none = copies.CopyLedger(spark, Stage(spark, "t"), 2)
    none.add(df.limit(0).select(F.lit("s").alias("space"), "id", "k.k1", "k.k2"))
    assert none.keys().count() == 0 and copies.copies_of(none).count() == 0


def test_json_keys_ignore_order_of_fields(spark):
    fields = ("a", "b")
    lines = ['{"a":"X y","b":"1"}', '{ "b": "1", "a": "xY。" }', '{"a":"x y"}', '{"a":"xy","b":null}', '{"a":"xy"', None, "[]", '{"a":1,"b":"1"}', '{"a":"xy1","b":""}']
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    keys = {r["i"]: r["k"]["k1"] for r in df.select("i", copies.json_key(F.col("line"), fields).alias("k")).collect()}
    assert keys[0] == keys[1] and keys[2] == keys[3] and len({keys[0], keys[2], keys[8]}) == 3
    assert [i for i, k in keys.items() if k is None] == [4, 5, 6, 7]
    assert copies.json_record(json.dumps({"a": "x", "b": "y"}), fields) == ["x", "y"]


def brute(records):
    settled, sets, out = {}, {}, set()
    for b, i, t in sorted((b, i, t) for i, t, b in records if t is not None):
        f = bare_form(t)
        if f in settled:
            if settled[f] != i:
                out.add((i, settled[f]))
            continue
        g = {f[k : k + 3] for k in range(len(f) - 2)}
        best = min(((-len(g & s) / len(g | s), j) for j, s in sets.items() if 5 * len(g & s) >= 3 * len(g | s)), default=None) if len(f) >= 40 else None
        settled[f] = best[1] if best else i
        if best:
            out.add((i, best[1]))
        elif len(f) >= 40:
            sets[i] = g
    return out


def sample_records(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("アイウエオカキクケコサシスセソ漢字時分港駅") for _ in range(rng.randint(2, 6))) for _ in range(300)]
    texts = [("、".join(rng.choice(words) for _ in range(rng.randint(12, 24)))) for _ in range(n)]
    records = []
    for k in range(2 * n):
        t = rng.choice(texts)
        own = list(t)
        for _ in range(rng.choice([0, 0, 1, 3, 8, 14])):
            own[rng.randrange(len(own))] = rng.choice("ー円月日")
        records.append((f"s{k:05d}", "".join(own), rng.randint(1, 4)))
    return records + [("null", None, 1), ("short", "短い", 1), ("short2", "短 い。", 2), ("empty", "", 1), ("empty2", "。", 3)]


def test_batches_against_history_equal_brute_force(spark):
    records = sample_records(250, 5)
    df = spark.createDataFrame(records + records[:40], "id string, text string, batch int").withColumn("target", F.lit("clash"))
    first = history.first_deliveries(df, "id", "batch", "text")
    keyed = first.select("id", "batch", history.bare_key("text").alias("k")).select("id", "batch", "k.*")
    for exact in (False, True):
        accepted = history.AcceptedHistory(spark, Stage(spark, "t"), shard_texts=120, fan_in=2, exact=exact, buckets=3)
        assert accepted.turned_away().count() == 0 and accepted.shards().count() == 0
        got = set()
        for b in (1, 2, 3, 4):
            got |= set(rows(accepted.add(keyed.where(F.col("batch") == b).drop("batch"))))
        assert got == brute(records) and {r[:2] for r in rows(accepted.turned_away())} == got
        assert len(accepted.segments) < 4 and all(exact or r["recall"] >= 0.97 for r in accepted.shards().collect())
        assert accepted.add(keyed.limit(0).drop("batch")).count() == 0


def test_prefix_filter_loses_no_similar_pair():
    forms = [r[1] for r in sample_records(150, 8) if r[1]]
    grams, offsets = history._grams(forms)
    sets = [set(grams[a:b].tolist()) for a, b in zip(offsets, offsets[1:])]
    for similarity in (0.5, 0.6, 0.9):
        got, queries = set(), []
        for q, t in smallworld.Prefixes(grams, offsets, similarity).sharing(grams, offsets, most=3000):
            good = smallworld.jaccard(grams, offsets, grams, offsets, q, t) >= similarity
            got |= set(zip(q[good].tolist(), t[good].tolist()))
            queries += set(q.tolist())
        assert len(queries) == len(set(queries))
        assert got == {(a, b) for a, x in enumerate(sets) for b, y in enumerate(sets) if x and len(x & y) >= similarity * len(x | y) - 1e-12}


def test_a_small_batch_touches_only_its_buckets(spark):
    ledger = copies.CopyLedger(spark, Stage(spark, "t"), 16)
    keyed = spark.range(2000).select(F.when(F.col("id") < 1, "s").otherwise("t").alias("space"), F.col("id").cast("string").alias("id"), F.xxhash64("id").alias("k1"), F.col("id").alias("k2"))
    ledger.add(keyed)
    files = lambda t: set(t.unbucketed().inputFiles())
    before = [files(t) for t in (ledger._keys, ledger._records)]
    ledger.add(keyed.limit(1).withColumn("id", F.lit("new")))
    after = [files(t) for t in (ledger._keys, ledger._records)]
    assert len(before[0] - after[0]) == 1 == len(after[0] - before[0]) and before[1] < after[1] and len(after[1] - before[1]) == 1
    plan = ledger._keys.matching([3]).join(keyed, ["space", "k1", "k2"], "full_outer")._jdf.queryExecution().toString()
    assert "part#" in plan and "SelectedBucketsCount" in plan or "Bucketed: true" in plan


def test_graph_recall_against_exhaustive_search():
    import numpy as np

    rng = random.Random(11)
    forms = ["".join(rng.choice("あいうえおかきくけこさしすせそたちつてと") for _ in range(90)) for _ in range(3000)]
    near = ["".join(c if rng.random() > 0.06 else "ん" for c in f) for f in forms[:300]]
    grams, offsets = history._grams(forms)
    graph = smallworld.Graph.build(grams, offsets)
    g2, o2 = history._grams(near)
    q, t = graph.search(g2, o2, smallworld.sketches(g2, o2))
    exact = smallworld.jaccard(g2, o2, grams, offsets, q, t)
    found = {(a, b) for a, b, j in zip(q.tolist(), t.tolist(), exact.tolist()) if j >= 0.6}
    sets = [{f[k : k + 3] for k in range(len(f) - 2)} for f in forms]
    want = set()
    for a, f in enumerate(near):
        s = {f[k : k + 3] for k in range(len(f) - 2)}
        want |= {(a, b) for b, x in enumerate(sets) if len(s & x) / len(s | x) >= 0.6}
    assert found <= want and len(found) >= 0.97 * len(want) and len(want) > 150
    empty = smallworld.Graph.build(np.zeros(0, dtype=np.uint64), np.zeros(1, dtype=np.int64))
    assert len(empty.search(g2, o2, smallworld.sketches(g2, o2))[0]) == 0
