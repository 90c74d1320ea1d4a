"""Queries over references to records that do not exist, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import width_pairs
from ..operators.references import find_orphans, orphan_counts
from ..sources.tables import table

#: referring table, its key, field, table referred to, that table's key
RELATIONS = (
    ("human_review_record", "review_id", "stage9_qa_id", "generated_audio_qa", "qa_id"),
    ("human_review_record", "review_id", "stage10a_evidence_id", "pronunciation_evidence", "evidence_id"),
    ("released_audio_artifact", "release_id", "regression_id", "pronunciation_regression", "regression_id"),
    ("release_gate_result", "gate_id", "review_id", "human_review_record", "review_id"),
)


def month_utc(moment: str) -> F.Column:
    """Month of a timestamp in UTC as YYYY-MM, whatever the session's zone."""
    day = F.expr(f"date_from_unix_date(cast(floor(unix_micros({moment}) / 86400000000) as int))")
    return F.date_format(day, "yyyy-MM")


def _records(spark: SparkSession, sf: str, name: str, key: str, fields: list[tuple[str, str]]) -> DataFrame:
    """One row per record and reference field, at the record's earliest load."""
    rows = table(spark, sf, name)
    names = [f for f, _ in fields]
    first = rows.groupBy(F.col(key).alias("record_id")).agg(F.min(F.struct("loaded_at", *[F.col(f).alias(f"f_{f}") for f in names])).alias("first"))
    each = [F.struct(F.lit(f).alias("field_name"), F.col(f"first.f_{f}").alias("ref"), F.lit(t).alias("target")) for f, t in fields]
    return first.select(
        F.lit(name).alias("table_name"), "record_id", F.col("first.loaded_at").alias("at"), F.explode(F.array(*each)).alias("x")
    ).select("table_name", "record_id", "at", "x.field_name", "x.ref", "x.target")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """Every reference whose record is missing, late or deleted at the referring record's first load."""
    by_table: dict[tuple[str, str], list[tuple[str, str]]] = {}
    for name, key, field, target, _ in RELATIONS:
        by_table.setdefault((name, key), []).append((field, target))
    refs = None
    for (name, key), fields in by_table.items():
        part = _records(spark, sf, name, key, fields)
        refs = part if refs is None else refs.unionByName(part)
    targets = None
    for target, key in dict.fromkeys((t, k) for *_, t, k in RELATIONS):
        part = table(spark, sf, target).select(F.lit(target).alias("target"), F.col(key).alias("id"), "loaded_at", "deleted_at")
        targets = part if targets is None else targets.unionByName(part)
    found = find_orphans(
        refs, ["ref"], targets, ["id"], match="simple", keep=["table_name", "field_name", "record_id", "at"],
        same=[("target", "target")], ref_time="at", loaded="loaded_at", deleted="deleted_at",
    )
    return found.select("table_name", "field_name", "record_id", "kind", month_utc("at").alias("period"))


def p2_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Orphan references per table, field, month and kind."""
    return orphan_counts(p2_found(spark, sf), ["table_name", "field_name", "period"])


def p2_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews whose pair of QA and evidence ids, so far as given, no evidence row ever had (partial match)."""
    reviews = table(spark, sf, "human_review_record").select("review_id", "stage9_qa_id", "stage10a_evidence_id").distinct()
    evidence = table(spark, sf, "pronunciation_evidence")
    found = find_orphans(
        reviews, ["stage9_qa_id", "stage10a_evidence_id"], evidence, ["stage9_qa_id", "evidence_id"], match="partial", keep=["review_id"]
    )
    return found.select("review_id", "null_mask", "kind")


def _form(column: str) -> str:
    a, b = (x.replace("'", "''") for x in width_pairs())
    return f"lower(regexp_replace(translate({column}, '{a}', '{b}'), '^[\\s]+|[\\s]+$', '', 'g'))"


def _found_sql() -> str:
    refs, targets = [], []
    for name, key, field, target, _ in RELATIONS:
        refs.append(
            f"select '{name}' table_name, '{field}' field_name, {key} record_id, '{target}' target, min(loaded_at) since, "
            f"{_form(f'arg_min({field}, loaded_at)')} ref from {name} group by {key}"
        )
    for target, key in dict.fromkeys((t, k) for *_, t, k in RELATIONS):
        targets.append(f"select '{target}' target, {_form(key)} id, loaded_at, deleted_at from {target}")
    return f"""
    with refs as ({' union all '.join(refs)}), targets as ({' union all '.join(targets)}),
    judged as (
      select r.table_name, r.field_name, r.record_id, r.since,
        count(t.id) n, count(*) filter (where t.loaded_at <= r.since) n_by,
        count(*) filter (where t.loaded_at <= r.since and (t.deleted_at is null or t.deleted_at > r.since)) n_ok
      from refs r left join targets t on r.target = t.target and r.ref = t.id
      where r.ref is not null and r.ref <> '' group by all)
    select table_name, field_name, record_id,
      case when n = 0 then 'missing' when n_by = 0 then 'late' else 'deleted' end kind,
      strftime(since at time zone 'UTC', '%Y-%m') period
    from judged where n_ok = 0"""


def _pairs_sql() -> str:
    return f"""
    with refs as (select distinct review_id, nullif({_form('stage9_qa_id')}, '') q, nullif({_form('stage10a_evidence_id')}, '') e
      from human_review_record),
    targets as (select {_form('stage9_qa_id')} q, {_form('evidence_id')} e from pronunciation_evidence)
    select review_id, cast((case when q is null then 1 else 0 end) + (case when e is null then 2 else 0 end) as integer) null_mask, 'missing' kind
    from refs r where (q is not null or e is not null)
      and not exists (select 1 from targets t where r.q is not null and r.e is not null and t.q = r.q and t.e = r.e)
      and not exists (select 1 from targets t where r.q is null and t.e = r.e)
      and not exists (select 1 from targets t where r.e is null and t.q = r.q)"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p2_found": p2_found, "p2_counts": p2_counts, "p2_pairs": p2_pairs}


def oracle_sql() -> dict[str, str]:
    found = _found_sql()
    return {
        "p2_found": found,
        "p2_counts": f"select table_name, field_name, period, kind, count(*) n_orphans from ({found}) group by all",
        "p2_pairs": _pairs_sql(),
    }
