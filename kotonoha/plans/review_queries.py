"""Queries that join the review and release tables, with their SQL. Rows are records at their latest delivery."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identity, sets
from ..functions.ids import compare_form
from ..operators import history as hx
from ..operators import chains, integrity, issues
from ..sources.tables import table


def _latest(spark: SparkSession, sf: str, name: str, key: str, *columns: str) -> DataFrame:
    rows = table(spark, sf, name).select(key, "loaded_at", *columns)
    return hx.latest(rows, [key], ["loaded_at", *columns]).drop("loaded_at")


# What a review and the gate must agree on for the review to be of the present evidence, as far as these tables hold it.
EVIDENCE_OF_REVIEW = ("queue_item_id", "sample_id", "artifact_run_id", "stage9_qa_id", "stage10a_evidence_id", "regression_id")


def gate_currency(spark: SparkSession, sf: str) -> DataFrame:
    """Each gate with the latest review of its case, and whether that review is of the same evidence."""
    gates = _latest(spark, sf, "release_gate_result", "gate_id", "logical_case_id", *EVIDENCE_OF_REVIEW, "review_id")
    reviews = table(spark, sf, "human_review_record").select("logical_case_id", "reviewed_at", F.col("review_id").alias("last_review"), F.col("decision").alias("last_decision"), *[F.col(c).alias(f"r_{c}") for c in EVIDENCE_OF_REVIEW]).distinct()
    last = hx.latest(reviews, ["logical_case_id"], ["reviewed_at", "last_review"])
    joined = gates.join(last, "logical_case_id", "left")
    same = F.col("last_review").isNotNull() & chains.same_references("", "r_", EVIDENCE_OF_REVIEW, compare_form)
    return joined.select("gate_id", F.coalesce("last_review", F.lit("")).alias("last_review"), F.coalesce("last_decision", F.lit("none")).alias("last_decision"), same.alias("is_current"))


def release_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Released audio with what can be found behind it: gate, review, regression, and whether the run agrees along the way."""
    releases = _latest(spark, sf, "released_audio_artifact", "release_id", "artifact_run_id", "release_gate_id", "human_review_id", "regression_id")
    gates = _latest(spark, sf, "release_gate_result", "gate_id", "artifact_run_id", "decision").withColumnRenamed("artifact_run_id", "gate_run").withColumnRenamed("decision", "gate_decision")
    reviews = _latest(spark, sf, "human_review_record", "review_id", "artifact_run_id").withColumnRenamed("artifact_run_id", "review_run")
    regressions = table(spark, sf, "pronunciation_regression").select("regression_id").distinct()
    joined = hx.chain(releases, (gates, "release_gate_id", "gate_id", "has_gate"), (reviews, "human_review_id", "review_id", "has_review"), (regressions, "regression_id", "regression_id", "has_regression"))
    same = integrity.all_equal(F.col("artifact_run_id"), F.col("gate_run"), F.col("review_run"))
    return joined.select("release_id", "has_gate", "has_review", "has_regression", same.alias("same_run"), F.coalesce("gate_decision", F.lit("none")).alias("gate_decision"))


def review_issue_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Content-addressed id of each issue of a QA row, and the reasons it adds, once each."""
    rows = _latest(spark, sf, "generated_audio_qa", "qa_id", "decision", "issues", "decision_reasons")
    each = rows.select("qa_id", "decision_reasons", F.posexplode("issues").alias("at", "issue"))
    address = identity.content_id({"source": F.lit("qa"), "code": F.col("issue.code"), "reference": F.col("qa_id")})
    known = sets.is_subset(F.array("issue.code"), F.col("decision_reasons"))
    return each.select("qa_id", (F.col("at") + 1).alias("nth"), F.col("issue.code").alias("code"), F.col("issue.severity").alias("severity"), address.alias("issue_id"), known.alias("named"))


def qa_routes(spark: SparkSession, sf: str) -> DataFrame:
    """Count, seconds and mean error rate of QA rows by decision as recorded and as their issues would have it."""
    rows = _latest(spark, sf, "generated_audio_qa", "qa_id", "decision", "issues", "audio_duration_sec", "cer")
    rows = rows.withColumn("derived", issues.decision(F.col("issues")))
    return rows.groupBy("decision", "derived").agg(F.count("*").alias("n"), F.round(F.sum("audio_duration_sec"), 3).alias("total_sec"), F.round(F.avg("cer"), 6).alias("mean_cer"))


def reviewer_load(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews, cases and longest delay of delivery by reviewer and month of review."""
    from .reference_queries import month_utc

    rows = table(spark, sf, "human_review_record").groupBy("review_id", "reviewer_id", "logical_case_id", "reviewed_at").agg(F.min("loaded_at").alias("first"))
    delay = (F.unix_micros("first") - F.unix_micros("reviewed_at")) / 3_600_000_000
    return rows.withColumn("delay", delay).groupBy("reviewer_id", month_utc("reviewed_at").alias("month")).agg(
        F.count("*").alias("n_reviews"), F.countDistinct("logical_case_id").alias("n_cases"), F.round(F.max("delay"), 3).alias("longest_hours")
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (gate_currency, release_chain, review_issue_ids, qa_routes, reviewer_load)}


def _form(column: str) -> str:
    from .reference_queries import _form as form

    return form(column)


def oracle_sql() -> dict[str, str]:
    def last(name: str, key: str, first: str) -> str:
        return f"(select * exclude (rn) from (select *, row_number() over (partition by {key} order by loaded_at desc, {first} desc) rn from {name}) where rn = 1)"

    same = " and ".join(f"coalesce({_form(f'g.{c}')} = {_form(f'r.{c}')}, false)" for c in EVIDENCE_OF_REVIEW)
    qa = last("generated_audio_qa", "qa_id", "decision")
    return {
        "gate_currency": f"""with g as {last('release_gate_result', 'gate_id', 'logical_case_id')},
            r as (select * from (select *, row_number() over (partition by logical_case_id order by reviewed_at desc, review_id desc) rn from human_review_record) where rn = 1)
            select gate_id, coalesce(r.review_id, '') last_review, coalesce(r.decision, 'none') last_decision, r.review_id is not null and {same} is_current from g left join r using (logical_case_id)""",
        "release_chain": f"""with a as {last('released_audio_artifact', 'release_id', 'artifact_run_id')}, g as {last('release_gate_result', 'gate_id', 'artifact_run_id')}, r as {last('human_review_record', 'review_id', 'artifact_run_id')},
            p as (select distinct regression_id from pronunciation_regression)
            select release_id, g.gate_id is not null has_gate, r.review_id is not null has_review, p.regression_id is not null has_regression,
              coalesce(a.artifact_run_id = g.artifact_run_id and a.artifact_run_id = r.artifact_run_id, false) same_run, coalesce(g.decision, 'none') gate_decision
            from a left join g on a.release_gate_id = g.gate_id left join r on a.human_review_id = r.review_id left join p on a.regression_id = p.regression_id""",
        "review_issue_ids": f"""with q as (select qa_id, decision_reasons d, issues i from {qa}), e as (select qa_id, d, unnest(range(1, len(i) + 1)) nth, unnest(i) x from q)
            select qa_id, cast(nth as integer) nth, x.code code, x.severity severity, sha256('{{"code":"' || x.code || '","reference":"' || qa_id || '","source":"qa"}}') issue_id, list_contains(d, x.code) named from e""",
        "qa_routes": f"""with q as (select *, case when len(list_filter(issues, lambda i: i.severity = 'critical')) > 0 then 'drop' when len(list_filter(issues, lambda i: i.severity = 'warning')) > 0 then 'review' else 'pass' end derived from {qa})
            select decision, derived, count(*) n, round(sum(audio_duration_sec), 3) total_sec, round(avg(cer), 6) mean_cer from q group by all""",
        "reviewer_load": """with r as (select review_id, reviewer_id, logical_case_id, reviewed_at, min(loaded_at) f from human_review_record group by all)
            select reviewer_id, strftime(reviewed_at at time zone 'UTC', '%Y-%m') "month", count(*) n_reviews, count(distinct logical_case_id) n_cases, round(max((epoch_us(f) - epoch_us(reviewed_at)) / 3600000000), 3) longest_hours from r group by 1, 2""",
    }
