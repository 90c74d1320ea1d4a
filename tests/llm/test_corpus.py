import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kotonoha.llm.forms import bare_form
from kotonoha.llm import fmindex, leakage, linemodel, quality


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=120))
def test_suffix_array_and_wavelet_ranks(values):
    x = np.array(values, dtype=np.int64)
    want = sorted(range(len(x)), key=lambda i: values[i:])
    assert fmindex.suffix_array(x).tolist() == want
    m = fmindex.WaveletMatrix(x, 4)
    for c in range(4):
        at = np.arange(len(x) + 1)
        assert m.rank(np.full(len(at), c), at).tolist() == [values[:i].count(c) for i in at]
    symbol, rank = m.access(np.arange(len(x)))
    assert symbol.tolist() == values and rank.tolist() == [values[:i].count(v) for i, v in enumerate(values)]


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet="ab", min_size=30, max_size=400), st.integers(0, 300), st.integers(1, 40))
def test_index_finds_every_phrase_sequence(text, at, size):
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    index = fmindex.FMIndex(codes)
    begin = min(at, len(index.starts) - 1)
    end = min(begin + size, len(index.starts))
    ends = np.concatenate((index.starts[1:], [len(codes)]))
    hashes = fmindex.phrase_hashes(codes, index.starts[begin:end], ends[begin:end])
    pattern = index.symbols_of(hashes)[None, :]
    low, high = index.search(pattern, np.array([pattern.shape[1]]))
    assert int(index.starts[begin]) in set(index.locate(np.arange(low[0], high[0])).tolist())


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="abcあ漢", max_size=200), min_size=1, max_size=5))
def test_stored_index_is_the_built_one(texts):
    codes = np.concatenate([np.frombuffer((t + "\0").encode("utf-32-le"), dtype=np.uint32) for t in texts])
    built = fmindex.FMIndex(codes)
    loaded = fmindex.FMIndex(codes, built.dump())
    assert built.size == loaded.size and (built.alphabet == loaded.alphabet).all() and (built.first == loaded.first).all() and (built.samples == loaded.samples).all()
    rows_ = np.arange(built.size)
    assert (built.locate(rows_) == loaded.locate(rows_)).all()


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=1, max_size=3), min_size=1, max_size=4), st.lists(st.text(alphabet="abc", max_size=30), min_size=1, max_size=6))
def test_uniform_runs_are_found(units, fills):
    run = 20
    items = [(i, u * 40) for i, u in enumerate(units)]
    texts = [f + units[i % len(units)] * (5 + 3 * i) + f for i, f in enumerate(fills)]
    codes = np.concatenate([np.frombuffer((t + "\0").encode("utf-32-le"), dtype=np.uint32) for t in texts])
    patterns = leakage.Patterns(items, run)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    got = {(int(np.searchsorted(begins, a, side="right")) - 1, i) for k, a, _ in patterns.runs_in(fmindex.FMIndex(codes)).tolist() for i in patterns.item_ids[k]}
    assert got == {(d, i) for d, t in enumerate(texts) for i, x in items if any(x[p : p + run] in t for p in range(len(x) - run + 1))}


def plain_leaks(docs, items, run):
    out = set()
    for d, t in docs:
        for i, x in items:
            if t is not None and x is not None:
                a, b = bare_form(t), bare_form(x)
                if any(b[p : p + run] in a for p in range(len(b) - run + 1)):
                    out.add((d, i))
    return out


def test_leaks_equal_brute_force(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("アイウエオカキクケコ漢字abc") for _ in range(rng.randint(2, 7)))
    text = lambda n: "、".join(word() for _ in range(n))
    items = [(i, text(30)) for i in range(12)] + [(20, "あ" * 120), (21, "短い"), (22, None), (23, "abab" * 40)]
    items.append((24, items[0][1]))
    docs = []
    for d in range(60):
        t = text(40)
        if d % 3 == 0:
            src = items[rng.randrange(12)][1]
            n, at = rng.choice([30, 49, 50, 51, 80, 120]), rng.randrange(20)
            t = t[:50] + src[at : at + n] + "　" + t[50:]
        docs.append((d, t))
    docs += [(100, None), (101, ""), (102, "あ" * 49), (103, "あ" * 70), (104, "x" + "ab" * 40), (105, items[3][1].upper().replace("、", " ")), (105, items[3][1]), (106, text(3000) + items[5][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(-1)).repartition(3)
    it = spark.createDataFrame(items, "item_id long, text string")
    found = leakage.leaked_spans(df, it, shard_chars=3000, block_chars=900)
    assert set(rows(leakage.affected(found))) == plain_leaks(docs, items, 50)
    by_id = {}
    for d, t in docs:
        by_id.setdefault(d, []).append(t)
    for d, i, a, b in rows(found):
        part = {bare_form(t)[a:b] for t in by_id[d]}
        assert b - a >= 50 and any(p[:50] in bare_form(dict(items)[i]) for p in part)
    assert leakage.leaked_spans(df.limit(0), it).count() == 0
    assert leakage.leaked_spans(df, it.limit(0)).count() == 0


TABLE = "甲\t乙\t丙\n" + "\n".join(f"{k}\tx{k}\t{k * 7}" for k in range(6))
LIST = "題\n" + "\n".join(f"・品目{k}" for k in range(6))


def test_rules_of_tables_and_lists():
    kind = lambda t: linemodel.kind_by_rule(linemodel.lines_of(linemodel.folded(t)))
    assert kind(TABLE) == "table" and kind(LIST) == "list"
    assert kind(TABLE.replace("\t", "   ")) == "table" and kind(TABLE.replace("\t", ",")) == "table"
    assert kind("| a | b | c |\n|---|---|---|\n" + "| 1 | 2 | 3 |\n" * 3) == "table"
    assert kind("a\tb\tc\n" * 3) is None and kind("a\tb\n" * 9) is None
    assert kind("One, two, and three.\n" * 6) is None
    assert kind("1. a\n2. b\n") == "list" and kind("1.5 a\n2.5 b\n") is None
    assert kind("[ ] a\r\n[x] b\rc") == "list" and kind("□□□□\n□□□\n") is None
    assert kind("話す。\n・a\n") is None and kind("") is None


def test_kinds_of_documents(spark):
    rng = random.Random(1)
    names = ["".join(rng.choice("カキクケコサシスセソ") for _ in range(4)) for _ in range(60)]
    prose = lambda: "".join(f"{rng.choice(names)}は駅で切符を買いました。明日は{rng.choice(names)}へ行きます。" for _ in range(6))

    def junk():
        own = list(prose())
        rng.shuffle(own)
        return "".join(own)

    docs = [(k, (prose, junk, lambda: TABLE, lambda: LIST)[k % 4]()) for k in range(240)]
    docs += [(1000, None), (1001, ""), (1002, " \n　\t\n​"), (1003, "ああああ" * 50), (1004, prose() * 400), (1005, prose().replace("。", "。\r\n"))]
    kinds = ["prose", "junk", "table", "list"]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("kind", F.lit("clash"))
    labels = spark.createDataFrame([(k, kinds[k % 4] if k % 29 else "prose") for k in range(160)] + [(3, "odd"), (None, "list"), (9999, "junk")], "doc_id long, label string")
    model = quality.fit(df, labels)
    got = {r["doc_id"]: r for r in quality.line_kinds(df, model).collect()}
    assert 1000 not in got and len(got) == len(docs) - 1
    assert sum(got[k]["kind"] == kinds[k % 4] for k in range(160, 240)) >= 78
    assert [got[k]["kind"] for k in (1001, 1002, 1003, 1004, 1005)] == ["junk", "junk", "junk", "prose", "prose"]
    assert abs(sum(got[7][f"{k}_share"] for k in kinds) - 1) < 1e-5
    bare = quality.fit(df.limit(0), labels.limit(0))
    assert {r["kind"] for r in quality.line_kinds(df.where("doc_id % 4 = 2 and doc_id < 200"), bare).collect()} == {"table"}
    assert quality.line_kinds(df.limit(0), model).count() == 0


def test_statistics(spark):
    common = spark.createDataFrame([("en", "the"), ("ja", "の"), ("en", None)], "lang string, word string")
    df = spark.createDataFrame([(1, "The cat, the dog.\nno end\n\n"), (2, "猫の耳。"), (3, ""), (4, None), (5, "+ + =")], "doc_id long, text string").withColumn("t", F.lit(1))
    got = {r["doc_id"]: tuple(r)[1:] for r in quality.statistics(df, common).collect()}
    assert got[1] == (6, round(17 / 6, 6), 0.0, 0.5, round(2 / 6, 6))
    assert got[2] == (3, 1.0, 0.0, 1.0, round(1 / 3, 6))
    assert got[3] == (0, 0.0, 0.0, 0.0, 0.0) and 4 not in got and got[5][2] == 0.6
    assert quality.statistics(df.limit(0), common.limit(0)).count() == 0


def test_long_list_of_common_words_is_joined(spark, monkeypatch):
    common = spark.createDataFrame([(w,) for w in ("The", "cat", "の", "the")], "word string")
    df = spark.createDataFrame([(1, "The cat, the dog."), (1, "The cat, the dog."), (2, "猫の耳。"), (3, ""), (None, "the")], "doc_id long, text string")
    short = rows(quality.statistics(df, common).na.fill(-1))
    monkeypatch.setattr(quality, "IN_PLAN", 1)
    assert rows(quality.statistics(df, common).na.fill(-1)) == short and short[1][5] == 0.75


def test_labelled_sample_is_bounded_by_characters(spark, monkeypatch):
    df = spark.createDataFrame([(k, "あ" * (100 if k else 5000)) for k in range(20)], "doc_id long, text string")
    labels = spark.range(20).select(F.col("id").alias("doc_id"), F.lit("prose").alias("label"))
    taken = []
    monkeypatch.setattr(linemodel.LineModel, "fit", staticmethod(lambda rows_: taken.append(sum(len(t) for t, _ in rows_))))
    quality.fit(df, labels, max_chars=1000)
    quality.fit(df, labels, max_labelled=3, max_chars=1000)
    assert taken == [1000, 300]


def test_characters_beyond_the_basic_plane_are_told_apart():
    codes = np.array([ord(c) for c in "𠮷𠮟𝄞😀"], dtype=np.uint32)
    assert len(set(linemodel._char_bins(codes).tolist())) == 4 and linemodel.char_kinds()[0x20BB7] == 0 and linemodel.char_kinds()[0x1F600] == 3
