import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kotonoha.llm import packing, splits
from kotonoha.plans.staging import Stage


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit_places_every_item_once_and_within_capacity(sizes):
    bins = packing.best_fit(sizes, 50)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 50 for b in bins)
    if sizes:
        assert len(bins) <= 1.3 * -(-sum(sizes) // 50) + 1 + sum(1 for s in sizes if s > 25)


def check_packed(sizes, got, capacity):
    used, pieces = Counter(), {}
    for container, i, piece, start, n in got:
        used[container] += n
        pieces.setdefault(i, []).append((start, n, piece))
    assert max(used.values(), default=0) <= capacity
    for i, n in sizes.items():
        own = sorted(pieces.get(i, []))
        assert sum(x[1] for x in own) == max(n or 0, 0)
        assert len(own) <= 1 or n > capacity
        assert [x[0] for x in own] == [capacity * k for k in range(len(own))] and [x[2] for x in own] == list(range(len(own)))
    return len(used)


def test_packing_rounds(spark):
    rng = random.Random(2)
    sizes = {k: rng.choice([1, 7, 100, 101, 250, rng.randint(1, 300)]) for k in range(3000)} | {5000: 0, 5001: None, 5002: 100}
    df = spark.createDataFrame([(k, n, "x") for k, n in sizes.items()] + [(1, sizes[1], "again"), (None, 5, "x")], "doc_id long, n int, members string").repartition(7)
    packed = packing.pack(df, "doc_id", "n", 100, per_task=400)
    got = [(r[0], r[1], r[2], r[3], r[4]) for r in packed.collect()]
    n = check_packed(sizes, got, 100)
    total = sum(x for x in sizes.values() if x)
    assert n <= 1.12 * -(-total // 100)
    assert {r[0] for r in packing.split_items(packed, "doc_id").collect()} == {k for k, x in sizes.items() if x and x > 100}
    report = packing.fill_report(packed, 100).first()
    assert report["n_containers"] == n and report["n_tokens"] == total
    assert packing.pack(df.limit(0), "doc_id", "n", 100).count() == 0
    again = packing.pack(df.repartition(3), "doc_id", "n", 100, per_task=400)
    assert {r[0].count("-") for r in again.collect()} == {1}


def test_items_that_never_pair_stay_bounded(spark):
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit(60).alias("n"))
    packed = packing.pack(df, "doc_id", "n", 100, per_task=100)
    assert packed.select("container_id").distinct().count() == 2000


def test_token_counts(spark):
    df = spark.createDataFrame([("あa",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(packing.byte_tokens(F.col("t"))).collect()] == [4, 0, None]


def plain_components(ties):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for r, n, o in ties:
        find(n)
        if o is not None:
            a, b = find(n), find(o)
            parent[max(a, b)] = min(a, b)
    groups = {}
    for r, n, _ in ties:
        if r is not None:
            groups.setdefault(find(n), set()).add(r)
    return groups


def test_components_grow_by_batches(spark):
    rng = random.Random(4)
    ties = []
    for k in range(400):
        own = f"s:r{k:03d}"
        other = "k:hot" if k % 3 == 0 else rng.choice([None, f"s:r{rng.randrange(400):03d}", f"k:{rng.randrange(120)}", own, f"s:gone{rng.randrange(30)}"])
        ties.append((f"r{k:03d}", own, other))
    ties += ties[::20] + [(None, "s:x", "k:hot")]
    df = spark.createDataFrame([(*t, i % 3) for i, t in enumerate(ties)], "record_id string, node string, other string, batch int").withColumn("root", F.lit("clash"))
    table = splits.ComponentTable(spark, Stage(spark, "t"), buckets=4)
    before = {}
    for b in range(3):
        table.add(df.where(F.col("batch") == b).select("record_id", "node", "other"))
        found = table.assigned().collect()
        now = {r["record_id"]: (r["split"], r["quarantined"]) for r in found}
        roots = {r["record_id"]: r["root"] for r in found}
        assert len(found) == len(now)
        for r, (split, held) in before.items():
            assert now[r][0] == split and now[r][1] >= held
        before = now
    groups = plain_components([t for t in ties if t[0] is not None])
    assert set(rows(table.related())) == {(min(g), r) for g in groups.values() for r in g if r != min(g)}
    assert len(before) == 400
    for g in groups.values():
        assert len({before[r][0] for r in g if not before[r][1]}) == 1 and len({roots[r] for r in g}) == 1
    held = sum(1 for _, h in before.values() if h)
    conflicts = table.conflicts().collect()
    assert held and sum(c["n_aside"] for c in conflicts) <= held and all(c["kept_split"] != c["aside_split"] for c in conflicts)
    table.add(df.limit(0).select("record_id", "node", "other"))
    assert len(table.assigned().collect()) == 400


def test_a_conflicting_tie_sets_the_smaller_side_aside(spark):
    table = splits.ComponentTable(spark, Stage(spark, "t"), buckets=2)
    schema = "record_id string, node string, other string"
    table.add(spark.createDataFrame([(f"a{k}", f"s:a{k}", "k:a") for k in range(8)] + [("b", "s:b", None), ("c", "s:c", None)], schema))
    first = {r["record_id"]: r["split"] for r in table.assigned().collect()}
    assert len(set(first.values())) == 3
    table.add(spark.createDataFrame([("new", "s:new", "k:a"), ("new", "s:new", "s:b")], schema))
    now = {r["record_id"]: (r["split"], r["quarantined"]) for r in table.assigned().collect()}
    assert now["new"] == (first["a0"], False) and now["b"] == (first["b"], True) and now["c"] == (first["c"], False)
    assert [tuple(r)[1:] for r in table.conflicts().collect()] == [(now_root := "k:a", "s:b", first["a0"], first["b"], 1)] and now_root


def test_shares_of_one_load(spark):
    ties = spark.range(4000).select(F.format_string("r%05d", "id").alias("record_id"), F.format_string("s:%05d", "id").alias("node"), F.format_string("k:%d", F.floor(F.sqrt("id") * 7)).alias("other"))
    table = splits.ComponentTable(spark, Stage(spark, "t"))
    table.add(ties)
    got = {r["split"]: r["n"] / 4000 for r in table.assigned().groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert abs(got["train"] - 0.8) < 0.01 and abs(got["validation"] - 0.1) < 0.01 and abs(got["test"] - 0.1) < 0.01


def test_no_records_at_all(spark):
    table = splits.ComponentTable(spark, Stage(spark, "t"))
    table.add(spark.createDataFrame([], "record_id string, node string, other string"))
    assert table.related().count() == 0 and table.assigned().count() == 0
