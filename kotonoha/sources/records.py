"""Contracts of all kinds of records: schema, key, order, and the conditions between fields.

A schema is written as ``name:type`` parts; a part without a type is text. ``[x]`` is an array, a word is a named struct. Field names are
fixed values of the manifests.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.identity import is_sha256
from ..functions.sets import is_subset, same_set
from . import contracts, manifests

_PLAIN = {"text": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "bool": T.BooleanType(), "time": T.TimestampType(), "json": T.StringType()}
_NAMED: dict[str, T.StructType] = {}


def _type(name: str) -> T.DataType:
    if name.startswith("["):
        return T.ArrayType(_type(name[1:-1]))
    return _PLAIN.get(name) or _NAMED[name]


def _schema(spec: str) -> T.StructType:
    return T.StructType([T.StructField(n, _type(t or "text")) for n, _, t in (part.partition(":") for part in spec.split())])


# Parts of records.
for _name, _spec in {
    "issue": "code severity message evidence:json",
    "remark": "code message",
    "applied": "surface reading_kana source occurrences:int",
    "error": "phase code message",
    "padding": "type duration_ms:int policy_version policy_fingerprint_sha256",
    "asr_segment": "start_sec:double end_sec:double text",
    "risk_term": "surface category reason note occurrence_count:int",
    "script": "remaining_latin:[text] remaining_digits:[text] remaining_kanji:[text] unexpected_symbols:[text]",
    "integrity": "audio_path file_size_bytes:long expected_audio_sha256 observed_audio_sha256 expected_sample_rate_hz:int observed_sample_rate_hz:int expected_channels:int observed_channels:int expected_duration_sec:double observed_duration_sec:double",
    "comparison": "canonicalizer_version expected_reading_kana observed_reading_kana canonical_expected_reading canonical_observed_reading edit_distance:int cer:double",
    "round_trip": "backend backend_version model_name model_identity config_fingerprint_sha256 transcript normalized_transcript observed_reading_kana inference_time_sec:double audio_duration_sec:double rtf:double",
    "reference": "reference_id scope surface expected_reading canonical_expected_reading expectation_source confirmation_status provenance_reference",
    "span": "text_form start:int end:int text",
    "risk": "risk_id surface risk_type reason occurrence_count:int evidence_source spans:[span] expected_reference_id alignment_status evidence_statement",
    "observed": "stage9_qa_id asr_transcript observed_reading_kana canonical_observed_reading stage9_decision stage9_issue_codes:[text] stage9_edit_distance:int stage9_cer:double",
    "snapshot": "qa_id decision canonical_expected_reading canonical_observed_reading edit_distance:int cer:double issue_codes:[text]",
    "change": "kind field baseline_value:json current_value:json material_pronunciation_change:bool message",
    "machine_issue": "issue_id source code evidence_reference_id summary",
}.items():
    _NAMED[_name] = _schema(_spec)

_PROVENANCE = (
    "tts_backend tts_model_name speaker synthesis_strategy synthesis_config_fingerprint_sha256 stage7_policy_version stage7_policy_fingerprint_sha256 preparation_policy_version watchlist_version "
    "watchlist_fingerprint_sha256 override_fingerprint_sha256 stage9_policy_version stage9_policy_fingerprint_sha256 stage9_asr_model_identity stage9_asr_config_fingerprint_sha256 "
    "stage9_reading_provider_fingerprint_sha256"
)


@dataclass(frozen=True)
class Contract:
    schema: T.StructType
    key: str
    unique: bool = True
    checks: Callable[[], dict[str, Column]] = field(default=dict)


def _has(code: str) -> Column:
    return F.exists("issues", lambda i: i["severity"] == code)


def _qa_checks() -> dict[str, Column]:
    heard = F.col("asr_round_trip").isNotNull() & F.col("content_comparison").isNotNull()
    decision = F.col("decision")
    return {
        "failed_is_undecided": (F.col("status") == "failed") == (decision == "undecided"),
        "pass_has_evidence": (decision != "pass") | heard,
        "pass_is_equal": (decision != "pass") | (F.col("canonical_expected_reading") == F.col("canonical_observed_reading")),
        "pass_without_issue": (decision != "pass") | ~(_has("warning") | _has("critical")),
        "drop_is_critical": (decision != "drop") | _has("critical"),
        "review_has_evidence": (decision != "review") | heard,
        "review_has_warning": (decision != "review") | _has("warning"),
        "reasons_are_codes": F.col("decision_reasons") == F.transform("issues", lambda i: i["code"]),
        "qa_id": is_sha256(F.col("qa_id")),
        "run_id": is_sha256(F.col("run_id")),
    }


def _run_checks() -> dict[str, Column]:
    made = ["normalized_text", "synthesis_text", "expected_reading_kana", "output_audio_path", "sample_rate_hz", "channels", "duration_sec", "generation_time_sec", "rtf", "audio_sha256", "backend_version"]
    whole = F.col(made[0]).isNotNull()
    for c in made[1:]:
        whole = whole & F.col(c).isNotNull()
    ok = F.col("status") == "success"
    return {"success_is_whole": ~ok | (whole & (F.size("errors") == 0)), "failure_has_error": ok | (F.size("errors") > 0), "seed": (F.col("seed") >= 0) & (F.col("seed") < 2_147_483_647), "run_id": is_sha256(F.col("run_id"))}


def _evidence_checks() -> dict[str, Column]:
    open_ = F.exists("risk_evidence", lambda r: r["alignment_status"].isin("expected_sequence_not_observed", "alignment_unresolved"))
    review = F.col("decision") == "review"
    return {
        "review_follows_risks": review == open_,
        "reasons_only_for_review": review == (F.size("review_reasons") > 0),
        "spans_fit": F.forall("risk_evidence", lambda r: F.forall(r["spans"], lambda s: s["end"] - s["start"] == F.length(s["text"]))),
        "unresolved_has_no_reference": F.forall("risk_evidence", lambda r: (r["alignment_status"] == "alignment_unresolved") == r["expected_reference_id"].isNull()),
        "span_reference_has_surface": F.forall("expected_references", lambda r: (r["scope"] != "risk_span") | (F.coalesce(r["surface"], F.lit("")) != "")),
        "provider_is_derived": F.forall("expected_references", lambda r: (r["expectation_source"] != "reading_provider") | (r["confirmation_status"] == "derived")),
        "human_is_confirmed": F.forall("expected_references", lambda r: (r["expectation_source"] != "human_confirmed") | (r["confirmation_status"] == "human_confirmed")),
    }


def _regression_checks() -> dict[str, Column]:
    return {"review_follows_changes": (F.col("decision") == "review") == F.exists("changes", lambda c: c["material_pronunciation_change"])}


def _once(name: str) -> Column:
    return F.size(F.array_distinct(F.col(name))) == F.size(F.col(name))


def _queue_checks() -> dict[str, Column]:
    return {
        "has_final_review": F.array_contains("priorities", "mandatory_final_review"),
        **{f"{c}_once": _once(c) for c in ("expected_reference_ids", "pronunciation_risk_ids", "hard_blocker_codes")},
        "issues_once": F.size(F.array_distinct(F.transform("machine_review_issues", lambda i: i["issue_id"]))) == F.size("machine_review_issues"),
    }


def _review_checks() -> dict[str, Column]:
    return {
        "reasons_once": _once("reason_codes"),
        "resolved_once": _once("resolved_issue_ids"),
        "resolved_ids": F.forall("resolved_issue_ids", is_sha256),
        "reason_given": (F.col("decision") == "approve") | (F.size("reason_codes") > 0),
        "target_only_for_rework": F.col("rework_target").isNull() | (F.col("decision") == "rework"),
    }


def _gate_checks() -> dict[str, Column]:
    out = F.col("decision") == "released"
    return {
        "missing_has_no_review": (F.col("review_freshness") != "missing") | F.col("review_id").isNull(),
        "released_without_reason": ~out | ((F.size("reason_codes") == 0) & (F.size("hard_blocker_codes") == 0)),
        "released_is_current": ~out | ((F.col("review_freshness") == "current") & (F.col("human_decision") == "approve")),
        "held_has_reason": out | (F.size("reason_codes") > 0),
    }


# Records by name.
CONTRACTS: dict[str, Contract] = {
    "speech_sample": Contract(contracts.SPEECH_SAMPLE, "sample_id", False, contracts.speech_checks),
    "text_sample": Contract(contracts.TEXT_SAMPLE, "sample_id"),
    "audio_preparation_report": Contract(_schema("sample_id status original_path prepared_path sample_rate_hz:int channels:int duration_sec:double speech_ratio:double segment_ids:[text] errors:[remark]"), "sample_id", False),
    "asr_report": Contract(_schema("sample_id status backend model_name language transcript segments:[asr_segment] inference_time_sec:double errors:[remark]"), "sample_id", False),
    "speech_curation_report": Contract(_schema("sample_id policy_version decision issues:[issue] decision_reasons:[text]"), "sample_id", False),
    "text_preparation_report": Contract(_schema("sample_id policy_version status input_stage output_stage warnings:[remark] errors:[remark] skipped_existing:bool"), "sample_id", False),
    "text_curation_report": Contract(
        _schema(
            "sample_id policy_version policy_fingerprint_sha256 status input_stage output_stage decision issues:[issue] decision_reasons:[text] raw_text normalized_text reading_kana preparation_policy_version preparation_status "
            "applied_overrides:[applied] override_fingerprint_sha256 reading_script:script risk_terms:[risk_term] override_resolved_risk_terms:[text] watchlist_version watchlist_source watchlist_fingerprint_sha256 skipped_existing:bool"
        ),
        "sample_id",
        True,
        lambda: {"failed_is_undecided": (F.col("status") == "failed") == (F.col("decision") == "undecided")},
    ),
    "synthesis_run": Contract(
        _schema(
            "schema_version run_id sample_id backend backend_version model_name model_path speaker language device dtype attention_implementation generation_parameters:json audio_post_processing:padding config_fingerprint_sha256 "
            "seed:long seed_policy synthesis_text_strategy normalized_text synthesis_text expected_reading_kana applied_pronunciation_overrides:[applied] status output_audio_path sample_rate_hz:int channels:int duration_sec:double "
            "generation_time_sec:double rtf:double audio_sha256 errors:[error]"
        ),
        "run_id",
        True,
        _run_checks,
    ),
    "audio_artifact": Contract(
        _schema(
            "schema_version run_id sample_id input_text expected_reading_kana synthesis_text synthesis_text_strategy applied_pronunciation_overrides:[applied] audio_path backend backend_version model_name speaker language "
            "audio_post_processing:padding sample_rate_hz:int channels:int duration_sec:double audio_sha256"
        ),
        "run_id",
    ),
    "qa_result": Contract(
        _schema(
            "schema_version qa_id run_id sample_id policy_version policy_fingerprint_sha256 status decision audio_path actual_synthesis_text expected_audio_sha256 observed_audio_sha256 expected_reading_kana asr_model_identity "
            "asr_config_fingerprint_sha256 reading_provider_fingerprint_sha256 asr_transcript normalized_asr_transcript observed_reading_kana canonical_expected_reading canonical_observed_reading edit_distance:int cer:double "
            "asr_inference_time_sec:double audio_duration_sec:double asr_rtf:double audio_integrity:integrity asr_round_trip:round_trip content_comparison:comparison issues:[issue] decision_reasons:[text]"
        ),
        "qa_id",
        True,
        _qa_checks,
    ),
    "evidence": Contract(
        _schema(
            "schema_version evidence_id logical_case_id sample_id artifact_run_id synthesis_run_id stage9_qa_id policy_version policy_fingerprint_sha256 decision review_reasons:[text] source_text normalized_text synthesis_input "
            f"normalization_transformations:[text] expected_references:[reference] risk_evidence:[risk] observed_evidence:observed audio_sha256 {_PROVENANCE}"
        ),
        "evidence_id",
        True,
        _evidence_checks,
    ),
    "baseline": Contract(
        _schema(
            "schema_version baseline_id logical_case_id source_evidence_id source_text expected_references:[reference] risk_evidence:[risk] observed_canonical_reading stage9_comparison:snapshot audio_sha256 "
            f"{_PROVENANCE} stage10a_policy_version stage10a_policy_fingerprint_sha256"
        ),
        "logical_case_id",
    ),
    "regression": Contract(_schema("schema_version regression_id logical_case_id baseline_id current_evidence_id decision changes:[change] policy_version policy_fingerprint_sha256"), "regression_id", True, _regression_checks),
    "queue_item": Contract(
        _schema(
            "schema_version queue_item_id logical_case_id sample_id priorities:[text] artifact_run_id artifact_sha256 audio_path audio_post_processing:padding artifact_integrity_valid:bool hard_blocker_codes:[text] "
            "machine_review_issues:[machine_issue] source_text normalized_text synthesis_input expected_reading expected_reference_ids:[text] pronunciation_risk_ids:[text] asr_transcript observed_canonical_reading stage9_qa_id "
            "stage9_status stage9_decision stage9_issue_codes:[text] stage9_policy_fingerprint_sha256 stage10a_evidence_id stage10a_decision stage10a_policy_fingerprint_sha256 regression_id regression_decision "
            "regression_baseline_id regression_policy_fingerprint_sha256 tts_backend tts_model_name speaker synthesis_config_fingerprint_sha256 override_fingerprint_sha256 review_policy_version "
            "review_policy_fingerprint_sha256 review_context_fingerprint_sha256"
        ),
        "queue_item_id",
        True,
        _queue_checks,
    ),
    "review": Contract(
        _schema(
            "schema_version review_id queue_item_id logical_case_id sample_id reviewer_id reviewed_at:time decision reason_codes:[text] resolved_issue_ids:[text] notes rework_target artifact_run_id artifact_sha256 stage9_qa_id "
            "stage10a_evidence_id regression_id review_context_fingerprint_sha256 review_policy_version review_policy_fingerprint_sha256"
        ),
        "review_id",
        True,
        _review_checks,
    ),
    "gate": Contract(
        _schema(
            "schema_version gate_id queue_item_id logical_case_id sample_id artifact_run_id review_id review_freshness human_decision decision reason_codes:[text] hard_blocker_codes:[text] resolved_issue_ids:[text] "
            "unresolved_issue_ids:[text] stage9_qa_id stage10a_evidence_id regression_id release_policy_version release_policy_fingerprint_sha256"
        ),
        "gate_id",
        True,
        _gate_checks,
    ),
    "release": Contract(
        _schema(
            "schema_version release_id logical_case_id sample_id artifact_run_id artifact_sha256 audio_path stage9_qa_id stage10a_evidence_id regression_id human_review_id release_gate_id released_at:time source_text tts_backend tts_model_name speaker"
        ),
        "release_id",
    ),
}


def broken(kind: str) -> Column:
    """Sorted names of the conditions of a contract that a record breaks."""
    return contracts.violations(CONTRACTS[kind].checks())


def read_records(spark: SparkSession, path: str, kind: str, *, lenient: str | None = None, missing_ok: bool = False, skip_blank: bool = False) -> DataFrame:
    """Records of a manifest. Malformed lines, unknown fields, repeated keys and broken conditions raise with their place.

    ``lenient`` names a text field that may be missing, null, blank or no text: such records are kept with the field null and
    ``{field}_missing`` true; any other fault of theirs still raises.
    """
    c = CONTRACTS[kind]
    rows = manifests.read_manifest(spark, path, c.schema, key=c.key if c.unique else None, missing_ok=missing_ok, skip_blank=skip_blank, lenient=lenient)
    checks = broken(kind)
    message = F.concat(F.lit(f"{kind} "), F.coalesce(F.col(c.key), F.lit("?")), F.lit(": "), F.array_join(checks, ", "))
    return rows.where(F.when(F.size(checks) == 0, True).otherwise(F.raise_error(message).cast("boolean")))


def write_records(df: DataFrame, path: str, kind: str, *, order: str | None = None, single_file: bool = False) -> None:
    """Records of one kind, sorted by key (or ``order``), keys unique where the contract asks for it."""
    c = CONTRACTS[kind]
    rows = df.select(*[F.col(f.name).cast(f.dataType) for f in c.schema.fields])
    manifests.write_manifest(rows, path, key=c.key if c.unique else None, order=order or c.key, single_file=single_file)


_JSON = {T.StringType: "string", T.IntegerType: "integer", T.LongType: "integer", T.DoubleType: "number", T.BooleanType: "boolean"}


def _json_type(kind: T.DataType) -> dict:
    if isinstance(kind, T.StructType):
        return {"type": ["object", "null"], "properties": {f.name: _json_type(f.dataType) for f in kind.fields}, "additionalProperties": False}
    if isinstance(kind, T.ArrayType):
        return {"type": ["array", "null"], "items": _json_type(kind.elementType)}
    if isinstance(kind, T.TimestampType):
        return {"type": ["string", "null"], "format": "date-time"}
    return {"type": [_JSON[type(kind)], "null"]}


def json_schema(kind: str) -> str:
    """A contract as JSON Schema: unknown fields are refused at every level, the key is required."""
    c = CONTRACTS[kind]
    out = _json_type(c.schema) | {"$schema": "https://json-schema.org/draft/2020-12/schema", "title": kind, "type": "object", "required": [c.key]}
    return json.dumps(out, indent=2, sort_keys=True, ensure_ascii=False)


def resolved_sets(known: Column, resolved: Column) -> dict[str, Column]:
    """Conditions between the issues of a case and those a review resolves."""
    return {"resolved_are_known": is_subset(resolved, known), "all_resolved": same_set(resolved, known)}
