"""Content-addressed identities: canonical JSON, fingerprints and seeds."""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

SEED_RANGE = 2_147_483_647


def canonical_json(fields: dict[str, Column]) -> Column:
    """Compact JSON with sorted keys and explicit nulls, non-ASCII kept. Nested structs must come with sorted fields;
    doubles should be given as text, as encoders differ below 0.001 and from 10**7."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in sorted(fields.items())]), {"ignoreNullFields": "false"})


def content_id(fields: dict[str, Column]) -> Column:
    """SHA-256 of the canonical JSON of the fields."""
    return F.sha2(canonical_json(fields), 256)


def fingerprint(settings: dict[str, Any], *, without: tuple[str, ...] = (), sort: bool = True) -> str:
    """SHA-256 of a settings object, on the driver; ``without`` leaves out what says where, not what."""
    kept = {k: v for k, v in settings.items() if k not in without}
    return hashlib.sha256(json.dumps(kept, ensure_ascii=False, sort_keys=sort, separators=(",", ":")).encode()).hexdigest()


def seed(base: int, key: Column) -> Column:
    """Seed below 2**31 - 1 from a base and a record id."""
    high = F.conv(F.substring(F.sha2(key, 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return F.pmod(high + F.lit(base).cast("decimal(20,0)"), F.lit(SEED_RANGE).cast("decimal(20,0)")).cast("long")


def is_sha256(value: Column) -> Column:
    return value.rlike("^[0-9a-f]{64}$")


# What the id of each kind of record is made of.
IDENTITIES = {
    "run": ("sample_id", "backend", "model_name", "speaker", "config_fingerprint_sha256", "seed", "synthesis_text_strategy", "synthesis_text"),
    "qa": (
        "run_id", "audio_sha256", "policy_fingerprint_sha256", "asr_model_identity", "asr_config_fingerprint_sha256", "reading_provider_fingerprint_sha256", "expected_reading_kana", "expected_sample_rate_hz",
        "expected_channels", "expected_duration_sec", "reading_canonicalizer_version",
    ),
    "reference": ("sample_id", "scope", "surface", "expected_reading", "expectation_source", "confirmation_status", "provenance_reference"),
    "risk": ("run_id", "surface", "risk_type", "reason", "expected_reference_id", "alignment_status"),
    "regression": ("logical_case_id", "baseline_id", "current_evidence_id", "policy_fingerprint", "changes"),
    "issue": ("source", "code", "evidence_reference_id", "summary"),
    "queue_item": ("review_context_fingerprint_sha256", "priorities"),
    "gate": (
        "queue_item_id", "review_id", "review_freshness", "decision", "reason_codes", "hard_blocker_codes", "resolved_issue_ids", "unresolved_issue_ids", "release_policy_fingerprint_sha256",
    ),
}


def record_id(kind: str, **fields: Column) -> Column:
    """The id of a record of a kind in ``IDENTITIES``; each part must be given, a null part counts as null."""
    names = IDENTITIES[kind]
    if set(fields) != set(names):
        raise ValueError(f"{kind} needs {', '.join(names)}")
    return content_id(fields)
