import pytest
from pyspark.sql import functions as F

from kotonoha.llm import queries

QUERIES, SQL = queries.queries(), queries.oracle_sql()
SMALL = "/root/testdata/sf0.001"


def test_every_problem_has_its_queries():
    assert all(f"p{n}_found" in QUERIES for n in (1, 3, 4, 5, 6, 7, 8)) and set(QUERIES) - set(SQL) == {"p5_splits", "p6_packed_bpe", "p8_found", "p8_shares"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_its_sql(agrees, name):
    assert agrees(QUERIES[name], SQL[name])


def test_splits_cover_all_records_once(spark, agrees):
    rows = QUERIES["p5_splits"](spark, SMALL).collect()
    ids = spark.read.parquet(f"{SMALL}/sample_manifest.parquet").select("sample_id").distinct().count()
    assert len(rows) == len({r["sample_id"] for r in rows}) == ids and {r["split"] for r in rows} == {"train", "validation", "test"}


def test_token_containers_hold_all_pieces(spark, agrees):
    packed = QUERIES["p6_packed_bpe"](spark, SMALL)
    used = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("n")).agg(F.max("n"), F.min("n")).first()
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").where("text <> ''").select("doc_id").distinct().count()
    assert used[0] <= 4096 and used[1] > 0 and packed.select("doc_id").distinct().count() == texts


def test_kinds_follow_from_shares(spark, agrees):
    rows = QUERIES["p8_shares"](spark, SMALL).collect()
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").where("text is not null").count()
    assert len(rows) == texts
    for r in rows:
        shares = [r[f"{k}_share"] for k in ("prose", "list", "table", "junk")]
        assert r["n_lines"] == 0 and r["kind"] == "junk" or abs(sum(shares) - 1) < 1e-5 and r[f"{r['kind']}_share"] == max(shares)
    found = {(r["doc_id"], r["kind"]) for r in QUERIES["p8_found"](spark, SMALL).collect()}
    assert found == {(r["doc_id"], r["kind"]) for r in rows if r["kind"] != "prose"}
