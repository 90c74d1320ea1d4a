"""Assertions along the chains of provenance, as named conditions over joined records.

Each function returns conditions by name; ``problems`` turns them into the names of those that fail, so that a plan can report or
(with ``integrity.require``) abort. Columns are structs named after the records joined by ``history.chain`` or a plain join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .integrity import all_equal


def problems(conditions: dict[str, Column]) -> Column:
    """Names, in order, of the conditions that don't hold; a null one doesn't."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in conditions.items()]))


def _c(path: str) -> Column:
    return F.col(path)


def evidence_conditions(passed: str = "passed", artifact: str = "artifact", run: str = "run", qa: str = "qa", curation: str = "curation") -> dict[str, Column]:
    """What must agree before evidence is built from a passed QA row, its audio, its run, its QA result and its text's curation."""
    return {
        "qa_completed": _c(f"{qa}.status") == "completed",
        "qa_passed": _c(f"{qa}.decision") == "pass",
        "run_succeeded": _c(f"{run}.status") == "success",
        "curation_passed": _c(f"{curation}.status").isin("curated", "skipped") & (_c(f"{curation}.decision") == "pass"),
        "one_sample": all_equal(*[_c(f"{x}.sample_id") for x in (artifact, run, qa, passed, curation)]),
        "one_run": all_equal(*[_c(f"{x}.run_id") for x in (artifact, run, qa, passed)]),
        "one_qa": all_equal(_c(f"{passed}.qa_id"), _c(f"{qa}.qa_id")),
        "one_audio": all_equal(_c(f"{artifact}.audio_sha256"), _c(f"{run}.audio_sha256"), _c(f"{qa}.observed_audio_sha256"), _c(f"{passed}.audio_sha256")),
        "one_reading": all_equal(_c(f"{artifact}.expected_reading_kana"), _c(f"{passed}.expected_reading_kana")),
        "one_input": all_equal(_c(f"{artifact}.synthesis_text"), _c(f"{run}.synthesis_text")),
    }


def review_conditions(pairs: dict[str, tuple[str, ...]]) -> dict[str, Column]:
    """Equality of several paths under a name each: the shape of all review-chain assertions."""
    return {name: all_equal(*map(_c, paths)) for name, paths in pairs.items()}


# What must agree, column by column, before a case goes to review.
REVIEW_PAIRS: dict[str, tuple[str, ...]] = {
    "one_sample": ("artifact.sample_id", "run.sample_id", "qa.sample_id", "evidence.sample_id", "evidence.logical_case_id"),
    "one_run": ("artifact.run_id", "run.run_id", "qa.run_id", "evidence.artifact_run_id", "evidence.synthesis_run_id"),
    "one_qa": ("qa.qa_id", "evidence.stage9_qa_id"),
    "one_decision": ("qa.decision", "evidence.observed_evidence.stage9_decision"),
    "one_evidence": ("evidence.evidence_id", "regression.current_evidence_id"),
    "one_case": ("evidence.logical_case_id", "regression.logical_case_id"),
    "one_audio": ("artifact.audio_sha256", "run.audio_sha256", "qa.expected_audio_sha256", "qa.observed_audio_sha256", "evidence.audio_sha256"),
    "one_text": ("artifact.input_text", "evidence.normalized_text"),
    "one_input": ("artifact.synthesis_text", "evidence.synthesis_input", "qa.actual_synthesis_text"),
    "one_backend": ("artifact.backend", "evidence.tts_backend"),
    "one_model": ("artifact.model_name", "evidence.tts_model_name"),
    "one_speaker": ("artifact.speaker", "evidence.speaker"),
}


def review_chain() -> dict[str, Column]:
    """What must hold for artifact, run, qa, evidence and regression of a case before it goes to review."""
    same_issues = F.col("evidence.observed_evidence.stage9_issue_codes") == F.col("qa.decision_reasons")
    return {"run_succeeded": F.col("run.status") == "success", **review_conditions(REVIEW_PAIRS), "same_issues": same_issues}


def planning_conditions(sample: str = "sample", preparation: str = "preparation", curation: str = "curation") -> dict[str, Column]:
    """What must hold before a text is synthesised: both reports are there and say what the sample says."""
    reading = f"{preparation}.reading"
    return {
        "preparation_found": _c(f"{preparation}.sample_id").isNotNull(),
        "curation_found": _c(f"{curation}.sample_id").isNotNull(),
        "reading_prepared": _c(f"{preparation}.status").isin("reading_prepared", "skipped") & _c(reading).isNotNull(),
        "curation_passed": _c(f"{curation}.status").isin("curated", "skipped") & (_c(f"{curation}.decision") == "pass"),
        "text_agrees": _c(f"{sample}.text.normalized_text") == _c(f"{reading}.input_text"),
        "reading_agrees": _c(f"{sample}.text.reading_kana") == _c(f"{reading}.reading_kana"),
        "report_agrees": all_equal(_c(f"{curation}.normalized_text"), _c(f"{sample}.text.normalized_text")) & all_equal(_c(f"{curation}.reading_kana"), _c(f"{sample}.text.reading_kana")),
        "overrides_agree": _c(f"{curation}.applied_overrides").eqNullSafe(_c(f"{reading}.applied_overrides")),
    }


def same_references(left: str, right: str, names: tuple[str, ...], compare=lambda c: c) -> Column:
    """Whether all named columns of two sides agree; a null on either side doesn't."""
    each = [F.coalesce(compare(F.col(f"{left}{n}")) == compare(F.col(f"{right}{n}")), F.lit(False)) for n in names]
    return reduce(lambda a, b: a & b, each)
