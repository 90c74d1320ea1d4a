from datetime import datetime, timezone

from kotonoha.operators.references import find_orphans, orphan_counts

REF = "id string, a string, b string, at timestamp"
KEY = "a string, b string, loaded timestamp, deleted timestamp, id string"


def t(day):
    return datetime(2025, 1, day, tzinfo=timezone.utc)


def kinds(df):
    return {(r["id"], r["null_mask"], r["kind"]) for r in df.collect()}


def test_kinds_over_time(spark):
    refs = spark.createDataFrame([("ok", "K1", None, t(5)), ("none", "zz", None, t(5)), ("late", "k2", None, t(5)), ("gone", "k3", None, t(5)), ("back", "k4", None, t(5)), ("blank", "　 ", None, t(5)), ("null", None, None, t(5)), ("wide", "ｋ１ ", None, t(5)), ("notime", "k1", None, None)], REF)
    keys = spark.createDataFrame([("k1", None, t(1), None, "x"), ("k2", None, t(6), None, "x"), ("k3", None, t(1), t(5), "x"), ("k3", None, t(7), None, "x"), ("k4", None, t(1), t(2), "x"), ("k4", None, t(3), t(9), "x"), (None, None, t(1), None, "x")], KEY)
    found = find_orphans(refs, ["a"], keys, ["a"], keep=["id"], ref_time="at", loaded="loaded", deleted="deleted")
    assert kinds(found) == {("none", 0, "missing"), ("late", 0, "late"), ("gone", 0, "deleted")}
    assert {(r["kind"], r["n_orphans"]) for r in orphan_counts(found, []).collect()} == {("missing", 1), ("late", 1), ("deleted", 1)}


def test_match_semantics(spark):
    refs = spark.createDataFrame([("both", "a", "b", t(1)), ("cross", "a", "d", t(1)), ("half", "a", None, t(1)), ("halfbad", None, "q", t(1)), ("none", None, None, t(1))], REF)
    keys = spark.createDataFrame([("a", "b", t(1), None, "x"), ("c", "d", t(1), None, "x")], KEY)
    run = lambda m: {x[0] for x in kinds(find_orphans(refs, ["a", "b"], keys, ["a", "b"], match=m, keep=["id"]))}
    assert run("simple") == {"cross"}
    assert run("partial") == {"cross", "halfbad"}
    assert run("full") == {"cross", "half", "halfbad"}


def test_empty_sides_and_hot_key(spark):
    refs = spark.createDataFrame([(str(i), "hot", None, t(2)) for i in range(500)], REF)
    none = spark.createDataFrame([], KEY)
    assert find_orphans(refs, ["a"], none, ["a"], keep=["id"]).count() == 500
    assert find_orphans(refs.limit(0), ["a"], none, ["a"], keep=["id"]).count() == 0
    many = spark.createDataFrame([("hot", None, t(1), None, "x")] * 300, KEY)
    assert find_orphans(refs, ["a"], many, ["a"], keep=["id"], ref_time="at", loaded="loaded", deleted="deleted").count() == 0
