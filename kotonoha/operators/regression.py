"""Comparison of pronunciation evidence with a captured baseline, as differences of signatures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import content_id

# Kinds of change.
TEXT, EXPECTED, OBSERVED, RISKS = "source_text_changed", "expected_reading_changed", "observed_reading_changed", "risk_status_changed"
PROVENANCE, ARTIFACT, NO_BASELINE, NO_CURRENT = "provenance_config_changed", "artifact_identity_changed", "baseline_case_missing", "current_case_missing"


def expectation_signature(references: Column) -> Column:
    """What matters of expected readings, in their order: scope, surface, canonical reading, source and confirmation."""
    parts = ("scope", "surface", "canonical_expected_reading", "expectation_source", "confirmation_status")
    return F.transform(references, lambda r: F.struct(*[r[p].alias(p) for p in parts]))


def risk_signature(risks: Column) -> Column:
    """What matters of risks, in their order: surface, kind and alignment."""
    return F.transform(risks, lambda r: F.struct(*[r[p].alias(p) for p in ("surface", "risk_type", "alignment_status")]))


def compare_cases(before: DataFrame, after: DataFrame, key: str, material: dict[str, tuple[str, str]], immaterial: dict[str, str]) -> DataFrame:
    """Full outer join of two sets of cases, each unique by ``key``: (key, changes, decision).

    ``material`` gives for each field its kind of change; ``immaterial`` likewise for provenance. Values compare null-safely and are kept
    as JSON. A case on one side only is a material change of its own. One shuffle of both sides on the key.
    """
    fields = [*material, *immaterial]
    a = before.select(key, F.struct(*fields).alias("a"))
    b = after.select(key, F.struct(*fields).alias("b"))
    joined = a.join(b, key, "full_outer")
    both = F.col("a").isNotNull() & F.col("b").isNotNull()

    def change(kind: str, name: str, old: Column, new: Column, matters: bool) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("field"), old.alias("baseline_value"), new.alias("current_value"), F.lit(matters).alias("material_pronunciation_change"))

    def as_json(value: Column) -> Column:
        text = F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"})
        return F.substr(text, F.lit(6), F.length(text) - 6)

    each = [
        F.when(F.col("a").isNull(), change(NO_BASELINE, key, F.lit("null"), as_json(F.col(key)), True)),
        F.when(F.col("b").isNull(), change(NO_CURRENT, key, as_json(F.col(key)), F.lit("null"), True)),
    ]
    for name, kind in [*material.items(), *immaterial.items()]:
        old, new = F.col(f"a.{name}"), F.col(f"b.{name}")
        each.append(F.when(both & ~old.eqNullSafe(new), change(kind, name, as_json(old), as_json(new), name in material)))
    changes = F.array_compact(F.array(*each))
    decision = F.when(F.exists("changes", lambda c: c["material_pronunciation_change"]), "review").otherwise("no_regression_detected")
    return joined.select(key, changes.alias("changes")).withColumn("decision", decision)


#: Fields of evidence by what their change means, when ``expected`` and ``risks`` are signatures and ``observed`` the canonical reading.
MATERIAL = {"source_text": TEXT, "expected": EXPECTED, "observed": OBSERVED, "risks": RISKS}


def case_view(evidence: DataFrame, provenance: Sequence[str]) -> DataFrame:
    """Evidence records as cases to compare: signatures, observed reading, provenance and audio."""
    return evidence.select(
        "logical_case_id", "evidence_id", "source_text", expectation_signature(F.col("expected_references")).alias("expected"), F.col("observed_evidence.canonical_observed_reading").alias("observed"),
        risk_signature(F.col("risk_evidence")).alias("risks"), *provenance, "audio_sha256",
    )


def capture_baseline(evidence: DataFrame, provenance: Sequence[str]) -> DataFrame:
    """Baseline records of evidence: what is compared later, the comparison of its QA, and an id of the content."""
    full = F.element_at(F.filter("expected_references", lambda r: r["scope"] == "full_text"), 1)
    seen = F.col("observed_evidence")
    snapshot = F.struct(
        F.col("stage9_qa_id").alias("qa_id"), seen["stage9_decision"].alias("decision"), full["canonical_expected_reading"].alias("canonical_expected_reading"), seen["canonical_observed_reading"].alias("canonical_observed_reading"),
        F.coalesce(seen["stage9_edit_distance"], F.lit(0)).alias("edit_distance"), F.coalesce(seen["stage9_cer"], F.lit(0.0)).alias("cer"), seen["stage9_issue_codes"].alias("issue_codes"),
    )
    identity = {"logical_case_id": F.col("logical_case_id"), "source_evidence_id": F.col("evidence_id"), "expected_references": F.col("expected_references"), "risk_evidence": F.col("risk_evidence"), "observed": seen["canonical_observed_reading"], "provenance": F.struct(*sorted(provenance))}
    return evidence.select(
        "schema_version", content_id(identity).alias("baseline_id"), "logical_case_id", F.col("evidence_id").alias("source_evidence_id"), "source_text", "expected_references", "risk_evidence",
        seen["canonical_observed_reading"].alias("observed_canonical_reading"), snapshot.alias("stage9_comparison"), "audio_sha256", *provenance,
        F.col("policy_version").alias("stage10a_policy_version"), F.col("policy_fingerprint_sha256").alias("stage10a_policy_fingerprint_sha256"),
    )


def summary(results: DataFrame) -> DataFrame:
    """One row: cases on either side, compared, decisions, and cases with immaterial changes only."""
    has = lambda kind: F.exists("changes", lambda c: c["kind"] == kind)
    material = F.exists("changes", lambda c: c["material_pronunciation_change"])
    return results.agg(
        F.count_if(~has(NO_BASELINE)).alias("baseline_cases"), F.count_if(~has(NO_CURRENT)).alias("current_cases"), F.count_if(~has(NO_BASELINE) & ~has(NO_CURRENT)).alias("compared_cases"),
        F.count_if(~material).alias("no_regression_detected"), F.count_if(material).alias("review_candidates"), F.count_if((F.size("changes") > 0) & ~material).alias("provenance_only_changes"),
    )
