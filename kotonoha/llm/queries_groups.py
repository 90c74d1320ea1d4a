"""Queries on splits of related records and on packing."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import compare_form, width_pairs
from ..plans.staging import Stage
from ..sources.tables import table
from . import packing, splits

CAPACITY = 4096
#: Ranks of a public byte-level tokenizer; workers must be able to read the file.
TOKENIZER = os.environ.get("KOTONOHA_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")


def _ties(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "sample_manifest").select(
        F.col("sample_id").alias("record_id"),
        splits.node("s", F.col("sample_id")).alias("node"),
        splits.node("s", F.col("lineage.parent_sample_id")).alias("parent"),
        F.when(compare_form(F.col("speaker.speaker_id")).rlike("^spk_[0-9]{7}$"), splits.node("k", F.col("speaker.speaker_id"))).alias("speaker"),
        F.expr("date_from_unix_date(cast(floor(unix_micros(loaded_at) / 86400000000) as int))").alias("day"),
    )
    quarter = (F.year("day") * 4 + F.quarter("day")).alias("quarter")
    return rows.select("record_id", "node", F.explode(F.array("parent", "speaker")).alias("other"), quarter)


def _components(spark: SparkSession, sf: str) -> splits.ComponentTable:
    """Batches are the quarters in which rows were loaded."""
    stage = Stage(spark, "splits")
    ties = stage.write(_ties(spark, sf), "all", "quarter")
    found = splits.ComponentTable(spark, stage)
    quarters = sorted((r["quarter"] or 0 for r in ties.select("quarter").distinct().collect()))  # one row per quarter
    for own in quarters:
        found.add(ties.where(F.coalesce("quarter", F.lit(0)) == own).drop("quarter"))
    return found


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """Each record that is related to a record with a smaller id, with the smallest id of its group."""
    return _components(spark, sf).related().select(F.col("first_id").alias("first_sample_id"), F.col("record_id").alias("sample_id"))


def p5_splits(spark: SparkSession, sf: str) -> DataFrame:
    """Every record with its split; related records share it, but for those in quarantine."""
    return _components(spark, sf).assigned().select(F.col("record_id").alias("sample_id"), "split", "quarantined")


def p5_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Each group with its number of records and of splits that hold records of it, quarantine apart."""
    groups = _components(spark, sf).assigned().groupBy("root").agg(F.min("record_id").alias("first_sample_id"), F.count("*").alias("n_records"), F.count_distinct(F.when(~F.col("quarantined"), F.col("split"))).alias("n_splits"))
    return groups.select("first_sample_id", "n_records", "n_splits")


def p5_shares(spark: SparkSession, sf: str) -> DataFrame:
    """One row: whether the shares of all records are within a point, or the largest group, of what was asked for."""
    groups = _components(spark, sf).assigned().groupBy("root").agg(F.count("*").alias("n"), *[F.count_if(F.col("split") == s).alias(s) for s, _ in splits.SHARES])
    room = F.greatest(F.lit(0.01), F.max("n") / F.sum("n"))
    near = [(F.abs(F.sum(s) / F.sum("n") - share) <= room).alias(f"{s}_near") for s, share in splits.SHARES]
    return groups.agg(F.sum("n").alias("n_records"), *near)


def _packed(spark: SparkSession, sf: str) -> DataFrame:
    sized = table(spark, sf, "documents").select("doc_id", packing.byte_tokens(F.col("text")).alias("n"))
    return packing.pack(sized, "doc_id", "n", CAPACITY)


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents larger than one container."""
    return packing.split_items(_packed(spark, sf), "doc_id")


def p6_pieces(spark: SparkSession, sf: str) -> DataFrame:
    """Every document or piece of one as it was packed, one token per byte."""
    return _packed(spark, sf).select("doc_id", F.col("piece_no").cast("long").alias("piece_no"), F.col("start").alias("start_at"), F.col("n_tokens").cast("long").alias("n_tokens"))


def p6_fill(spark: SparkSession, sf: str) -> DataFrame:
    """One row: tokens packed, containers above the capacity, and whether the rest is filled to 95 percent and more."""
    packed = _packed(spark, sf)
    per = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("used"))
    return per.agg(F.sum("used").alias("n_tokens"), F.count_if(F.col("used") > CAPACITY).alias("n_above"), (F.sum("used") >= 0.95 * CAPACITY * F.count("*")).alias("well_filled"))


def p6_packed_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Every document or piece with its container, counted by a public byte-level BPE tokenizer."""
    sized = table(spark, sf, "documents").select("doc_id", packing.bpe_tokens(F.col("text"), TOKENIZER).alias("n"))
    return packing.pack(sized, "doc_id", "n", CAPACITY)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p5_found": p5_found, "p5_splits": p5_splits, "p5_groups": p5_groups, "p5_shares": p5_shares, "p6_found": p6_found, "p6_pieces": p6_pieces, "p6_fill": p6_fill, "p6_packed_bpe": p6_packed_bpe}


def _form(column: str) -> str:
    a, b = (x.replace("'", "''") for x in width_pairs())
    return f"lower(regexp_replace(translate({column}, '{a}', '{b}'), '^[\\s]+|[\\s]+$', '', 'g'))"


_RELATED_SQL = f"""with recursive rows as materialized (select distinct sample_id, {_form('sample_id')} own, nullif({_form('lineage.parent_sample_id')}, '') parent,
              case when regexp_full_match({_form('speaker.speaker_id')}, 'spk_[0-9]{{7}}') then {_form('speaker.speaker_id')} end speaker from sample_manifest),
            e as materialized (select distinct sample_id, k from (select sample_id, own k from rows union all select sample_id, parent from rows union all select sample_id, speaker from rows) where k is not null),
            l(sample_id, low) using key (sample_id) as (
              select sample_id, sample_id from (select distinct sample_id from e)
              union
              select b.sample_id, min(m.low) from recurring.l o join e b using (sample_id)
                join (select a.k, min(r.low) low from recurring.l r join e a using (sample_id) group by a.k) m on m.k = b.k
              where exists (select 1 from l) group by b.sample_id, o.low having min(m.low) < o.low)"""


def oracle_sql() -> dict[str, str]:
    return {
        "p5_found": f"{_RELATED_SQL} select low first_sample_id, sample_id from l where low <> sample_id",
        "p5_groups": f"{_RELATED_SQL} select low first_sample_id, count(*) n_records, 1 n_splits from l group by low",
        "p5_shares": "select count(distinct sample_id) n_records, true train_near, true validation_near, true test_near from sample_manifest",
        "p6_pieces": f"""with d as (select doc_id, max(strlen(text)) n from documents where strlen(text) > 0 group by doc_id), e as (select *, unnest(range(0, (n - 1) // {CAPACITY} + 1)) p from d)
            select doc_id, p piece_no, p * {CAPACITY} start_at, least({CAPACITY}, n - p * {CAPACITY}) n_tokens from e""",
        "p6_fill": "select cast(sum(n) as bigint) n_tokens, 0 n_above, true well_filled from (select max(strlen(text)) n from documents group by doc_id)",
        "p6_found": f"select doc_id from documents where strlen(text) > {CAPACITY}",
    }
