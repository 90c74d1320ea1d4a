"""Record contracts: nested schemas and the checks that hold between fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ids import compare_form

_S, _D, _I = T.StringType(), T.DoubleType(), T.IntegerType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


TEXTS = _struct(reference_text=_S, asr_text=_S, normalized_text=_S, reading_kana=_S, phonemes=T.ArrayType(_S))
STATE = _struct(stage=_S, curation_decision=_S, decision_reasons=T.ArrayType(_S))
SPEECH_SAMPLE = _struct(
    schema_version=_S, sample_id=_S, dataset_id=_S, language=_S, locale=_S, audio=_struct(path=_S, format=_S, duration_sec=_D, sample_rate_hz=_I, channels=_I), text=TEXTS,
    speaker=_struct(speaker_id=_S), source=_struct(source_name=_S, source_record_id=_S, source_url=_S, license=_S, rights_status=_S),
    lineage=_struct(parent_sample_id=_S, segment_start_sec=_D, segment_end_sec=_D), split=_S, state=STATE, metadata=_S,
)
TEXT_SAMPLE = _struct(
    schema_version=_S, sample_id=_S, dataset_id=_S, language=_S, locale=_S, text=_struct(raw_text=_S, normalized_text=_S, reading_kana=_S, phonemes=T.ArrayType(_S)),
    source=_struct(source_type=_S, source_name=_S, source_id=_S, source_path=_S), rights_status=_S, intended_use=_S, domain=_S, state=STATE, metadata=_S,
)


def violations(checks: dict[str, Column]) -> Column:
    """Sorted names of the checks that are false; one that is null (nothing to check) holds."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(True)), F.lit(name)) for name, ok in sorted(checks.items())]))


def speech_checks() -> dict[str, Column]:
    """Checks over the columns of a speech record."""
    start, end, parent = F.col("lineage.segment_start_sec"), F.col("lineage.segment_end_sec"), F.col("lineage.parent_sample_id")
    return {
        "id_blank": F.coalesce(F.trim("sample_id"), F.lit("")) != "",
        "duration_negative": F.col("audio.duration_sec") >= 0,
        "rate_not_positive": F.col("audio.sample_rate_hz") > 0,
        "channels_not_positive": F.col("audio.channels") > 0,
        "segment_half_open": start.isNull() == end.isNull(),
        "segment_without_parent": start.isNull() | parent.isNotNull(),
        "segment_backward": end >= start,
        "own_parent": compare_form(parent) != compare_form(F.col("sample_id")),
        "metadata_not_json": F.col("metadata").isNull() | F.try_parse_json("metadata").isNotNull(),
        "version_unknown": F.col("schema_version") == "1.0",
    }
