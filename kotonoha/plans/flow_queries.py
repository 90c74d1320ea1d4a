"""Queries on joins with earlier output, summaries, set algebra, manifests and audio, with their SQL.

Driver tables stand in for stage outputs; rules are the data checks of a stage, without its workflow.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import sets, text as tx
from ..operators import history as hx
from ..operators import chains, integrity, issues, regression
from ..sources import audio, manifests, records
from ..sources.tables import table

LINE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("raw_text", "normalized_text", "reading_kana")])


def _speech(spark: SparkSession, sf: str) -> DataFrame:
    """Speech records at their latest delivery, with the text to be checked."""
    rows = table(spark, sf, "sample_manifest").select("sample_id", "loaded_at", F.col("text.reference_text").alias("t"), F.col("audio.duration_sec").alias("sec"), F.col("audio.path").alias("path"))
    return hx.latest(rows.withColumn("t", F.coalesce("t", F.lit(""))), ["sample_id"], ["loaded_at", "t"])


def _checked(spark: SparkSession, sf: str) -> DataFrame:
    rows = _speech(spark, sf).select("*", F.length(tx.compact(F.col("t"))).alias("n_chars"), tx.density(F.col("t"), F.col("sec")).alias("density"), tx.japanese_ratio(F.col("t")).alias("ratio"), tx.repeated_unit(F.col("t")).alias("unit"))
    groups = hx.duplicate_groups(rows.where("n_chars > 0"), "t", "sample_id").select("t", F.col("n").alias("n_same"))
    rows = rows.join(groups, "t", "left")
    # Codes of the data checks.
    rules = [
        issues.Rule("empty_transcript", "critical", F.col("n_chars") == 0),
        issues.Rule("duration_unavailable", "warning", F.col("sec").isNull()),
        issues.Rule("duration_too_short", "warning", F.col("sec") < 0.5),
        issues.Rule("duration_too_long", "warning", F.col("sec") > 30.0),
        issues.Rule("transcript_density_anomaly", "warning", (F.col("n_chars") > 0) & ((F.col("density") < 1.0) | (F.col("density") > 20.0)), {"density": F.round("density", 3)}),
        issues.Rule("low_japanese_script_ratio", "warning", F.col("ratio") < 0.3),
        issues.Rule("excessive_text_repetition", "warning", F.col("unit") != ""),
        issues.Rule("duplicate_text", "warning", F.col("n_same") > 1, {"n": F.col("n_same")}),
    ]
    return rows.withColumn("issues", issues.issues(rules)).withColumn("decision", issues.decision(F.col("issues")))


def speech_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Every speech record with its issues in order and the decision by severity."""
    return _checked(spark, sf).select("sample_id", "decision", F.array_join(issues.codes(F.col("issues")), ",").alias("codes"), F.round("ratio", 6).alias("ratio"))


def speech_summary(spark: SparkSession, sf: str) -> DataFrame:
    """One row: count and seconds by decision; fails if they don't add up."""
    row = issues.summary(_checked(spark, sf), "decision", "sec", ("pass", "review", "drop"))
    row = issues.balanced(row, "total", ["n_pass", "n_review", "n_drop"])
    return row.select("total", *[c for k in ("pass", "review", "drop") for c in (f"n_{k}", F.round(f"amount_{k}", 3).alias(f"sec_{k}"))])


def issue_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return issues.histogram(_checked(spark, sf), issues.codes(F.col("issues")))


def passed_speech(spark: SparkSession, sf: str) -> DataFrame:
    return issues.route(_checked(spark, sf), "decision", "pass").select("sample_id", "n_chars")


def duplicate_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Normalised texts that several text records share, each record at its latest delivery."""
    rows = table(spark, sf, "tts_text_samples").select("sample_id", "loaded_at", F.coalesce("text.normalized_text", F.lit("")).alias("t"))
    rows = hx.latest(rows, ["sample_id"], ["loaded_at", "t"])
    return hx.duplicate_groups(rows.where("t <> ''"), "t", "sample_id").select("t", "n", "first_id")


def latest_review(spark: SparkSession, sf: str) -> DataFrame:
    """The latest review of each case: by time of review, then id."""
    rows = table(spark, sf, "human_review_record").select("logical_case_id", "reviewed_at", "review_id", "decision", "artifact_sha256").distinct()
    return hx.latest(rows, ["logical_case_id"], ["reviewed_at", "review_id"]).select("logical_case_id", "review_id", "decision", tx.utc_text(F.col("reviewed_at")).alias("reviewed_at"))


def review_reuse(spark: SparkSession, sf: str) -> DataFrame:
    """QA rows that carry on the latest completed transcript of their sample, where it is of the same audio."""
    rows = table(spark, sf, "generated_audio_qa")
    old = hx.latest(rows.select("sample_id", "loaded_at", "qa_id", "audio_path", "observed_audio_sha256", "status", "asr_transcript"), ["sample_id"], ["loaded_at", "qa_id"])
    now = rows.select("qa_id", "sample_id", "audio_path", "observed_audio_sha256").distinct()
    out = hx.reuse(now, old.where("status = 'completed'"), ["sample_id"], ["audio_path", "observed_audio_sha256"], ["asr_transcript"])
    return out.select("qa_id", "reused", F.coalesce("asr_transcript", F.lit("")).alias("transcript"))


def upserted_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews as first delivered, replaced by what came later under the same id."""
    rows = table(spark, sf, "human_review_record").select("review_id", "loaded_at", "decision", "reviewer_id").distinct()
    first = rows.groupBy("review_id").agg(F.min("loaded_at").alias("first"))
    joined = rows.join(first, "review_id")
    later = hx.latest(joined.where("loaded_at > first").drop("first"), ["review_id"], ["loaded_at", "decision", "reviewer_id"])
    early = hx.latest(joined.where("loaded_at = first").drop("first"), ["review_id"], ["decision", "reviewer_id"])
    return hx.upsert(early, later, ["review_id"]).select("review_id", "decision", "reviewer_id", F.unix_micros("loaded_at").alias("loaded_us"))


def evidence_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Evidence with its QA row and regression: which of the assertions along the chain fail, and material changes."""
    evidence = table(spark, sf, "pronunciation_evidence").select("evidence_id", "stage9_qa_id", "sample_id", "audio_sha256", "artifact_run_id", "source_text").distinct()
    qa = table(spark, sf, "generated_audio_qa").groupBy("qa_id").agg(F.max(F.struct("loaded_at", "status", "decision", "sample_id", "run_id", "observed_audio_sha256", "expected_audio_sha256")).alias("qa"))
    regression = table(spark, sf, "pronunciation_regression").where("current_evidence_id is not null").groupBy("current_evidence_id").agg(F.count_if(F.exists("changes", lambda c: c["material_pronunciation_change"])).alias("n_material"))
    joined = hx.chain(evidence, (qa, "stage9_qa_id", "qa_id", "has_qa"), (regression, "evidence_id", "current_evidence_id", "has_regression"))
    conditions = {
        "qa_completed": F.col("qa.status") == "completed",
        "qa_passed": F.col("qa.decision") == "pass",
        **chains.review_conditions({"one_sample": ("sample_id", "qa.sample_id"), "one_run": ("artifact_run_id", "qa.run_id"), "one_audio": ("audio_sha256", "qa.observed_audio_sha256", "qa.expected_audio_sha256")}),
    }
    return joined.select("evidence_id", "has_qa", "has_regression", F.array_join(chains.problems(conditions), ",").alias("problems"), F.coalesce("n_material", F.lit(0)).alias("n_material"))


# Provenance of evidence as delivered here, and the kind of change each field stands for.
DELIVERED_PROVENANCE = {"tts_backend": regression.PROVENANCE, "tts_model_name": regression.PROVENANCE, "speaker": regression.PROVENANCE, "policy_fingerprint_sha256": regression.PROVENANCE, "audio_sha256": regression.ARTIFACT}


def _regressions(spark: SparkSession, sf: str) -> DataFrame:
    """Samples' evidence halfway through the time of delivery compared with that at its end."""
    rows = table(spark, sf, "pronunciation_evidence").select("evidence_id", "sample_id", "source_text", "decision", "review_reasons", *DELIVERED_PROVENANCE, F.unix_micros("loaded_at").alias("at"), F.unix_micros("deleted_at").alias("gone"))
    times = rows.agg(F.expr("(min(at) + max(at)) div 2").alias("mid"), F.max("at").alias("end"))  # one row

    def cases(moment: str) -> DataFrame:
        known = hx.as_of(rows.join(F.broadcast(times)), ["evidence_id"], F.col("at"), F.col("gone"), F.col(moment))
        return hx.latest(known, ["sample_id"], ["at", "evidence_id"]).withColumn("reasons", F.array_join("review_reasons", ","))

    return regression.compare_cases(cases("mid"), cases("end"), "sample_id", {"source_text": regression.TEXT, "reasons": regression.RISKS}, DELIVERED_PROVENANCE)


def regression_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Each sample whose evidence differs between two moments, with the kinds and fields of its changes and the decision."""
    return _regressions(spark, sf).where(F.size("changes") > 0).select("sample_id", F.array_join(F.transform("changes", lambda c: F.concat_ws(":", c["kind"], c["field"])), ",").alias("changes"), "decision")


def regression_summary(spark: SparkSession, sf: str) -> DataFrame:
    """One row over all samples: cases on either side, compared, and by decision."""
    return regression.summary(_regressions(spark, sf))


def gate_sets(spark: SparkSession, sf: str) -> DataFrame:
    """Set algebra on review arrays: reasons once each, unresolved blockers, subset and equality."""
    rows = table(spark, sf, "release_gate_result").select("gate_id", "reason_codes", "hard_blocker_codes").distinct()
    return rows.select(
        "gate_id",
        F.array_join(sets.ordered_distinct(F.concat("reason_codes", "hard_blocker_codes")), ",").alias("codes"),
        F.array_join(sets.missing_from(F.col("hard_blocker_codes"), F.col("reason_codes")), ",").alias("unnamed"),
        sets.is_subset(F.col("hard_blocker_codes"), F.col("reason_codes")).alias("covered"),
        sets.same_set(F.col("hard_blocker_codes"), F.col("reason_codes")).alias("equal"),
    )


def manifest_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Manifest lines as records, or what is wrong with them."""
    rows = table(spark, sf, "raw_manifest_lines").select("line_id", "file_name", "line")
    parsed = manifests.parse(rows, LINE_SCHEMA)
    return parsed.select("line_id", F.coalesce("problem", F.lit("none")).alias("problem"), F.coalesce("record.raw_text", F.lit("")).alias("raw_text"))


def document_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Numbered lines of every document; a last line break ends the last line."""
    rows = table(spark, sf, "documents").where("text is not null")
    return rows.select("doc_id", F.posexplode(manifests.split_lines(F.col("text"))).alias("at", "line")).select("doc_id", (F.col("at") + 1).alias("line_no"), F.length("line").alias("n"))


def bad_regions(spark: SparkSession, sf: str) -> DataFrame:
    """Cuts that overlap the one before, end before they begin, or reach past the end of their parent."""
    rows = table(spark, sf, "sample_manifest").select("sample_id", F.col("lineage.parent_sample_id").alias("p"), F.col("lineage.segment_start_sec").alias("a"), F.col("lineage.segment_end_sec").alias("b"), F.col("audio.duration_sec").alias("sec"))
    lengths = rows.groupBy(F.col("sample_id").alias("p")).agg(F.max("sec").alias("length"))
    rows = rows.where("p is not null and a is not null and b is not null").groupBy("sample_id").agg(F.min(F.struct("p", "a", "b")).alias("x")).select("sample_id", "x.*").join(lengths, "p", "left")
    return hx.bad_regions(rows, "p", "a", "b", F.col("length")).select("sample_id", "p", F.array_join("problems", ",").alias("problems"))


def stage_steps(spark: SparkSession, sf: str) -> DataFrame:
    """Every record one step on, where its stage has one."""
    edges = {"ingested": ["audio_prepared"], "audio_prepared": ["transcribed"], "transcribed": ["text_prepared", "curated"], "text_prepared": ["curated"]}
    rows = table(spark, sf, "sample_manifest").select("sample_id", F.col("state.stage").alias("stage")).distinct()
    wanted = F.when(F.col("stage") == "ingested", "audio_prepared").when(F.col("stage") == "audio_prepared", "transcribed").when(F.col("stage").isin("transcribed", "text_prepared"), "curated").otherwise(F.col("stage"))
    return rows.select("sample_id", "stage", hx.transition(F.col("stage"), wanted, edges).alias("next"))


def waveform_tails(spark: SparkSession, sf: str) -> DataFrame:
    """Tail analysis of the vectors taken as samples at 100 Hz."""
    rows = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("x"))
    rows = rows.select("vec_id", F.size("x").alias("n"), audio.tail_of(100)("x").alias("t"))
    return rows.select("vec_id", F.round("t.peak", 6).alias("peak"), F.round("t.rms", 6).alias("rms"), "t.trailing_samples", F.coalesce("t.last_audible", F.lit(-1)).alias("last_audible"), F.col("n").cast("long").alias("n"))


def common_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Samples known to both QA and evidence, checked to overlap at all."""
    qa = table(spark, sf, "generated_audio_qa").select("sample_id").distinct()
    evidence = table(spark, sf, "pronunciation_evidence").select("sample_id").distinct()
    return integrity.assert_overlap(qa, evidence, ["sample_id"]).join(evidence, "sample_id", "left_semi")


def unique_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Records by batch after a check that none repeats within its batch at the same load time."""
    rows = table(spark, sf, "tts_text_samples").select("sample_id", "batch_no", "loaded_at")
    return integrity.assert_unique(rows, ["sample_id", "batch_no", "loaded_at"]).groupBy("batch_no").agg(F.count("*").alias("n"), F.countDistinct("sample_id").alias("n_records"))


def contract_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Records that break a condition between their fields, by kind: speech records, reviews and gates."""
    out = None
    # Ids of these tables aren't all hashes; what the tables lack isn't checked.
    for kind, name, key in (("speech_sample", "sample_manifest", "sample_id"), ("review", "human_review_record", "review_id"), ("gate", "release_gate_result", "gate_id"), ("qa_result", "generated_audio_qa", "qa_id")):
        rows = table(spark, sf, name)
        if kind == "qa_result":
            for c in ("canonical_expected_reading", "canonical_observed_reading"):
                rows = rows.withColumn(c, F.lit("").cast("string"))
            # Evidence counts as given where a transcript is.
            for c in ("asr_round_trip", "content_comparison"):
                rows = rows.withColumn(c, F.nullif("asr_transcript", F.lit("")))
        found = rows.select(F.lit(kind).alias("kind"), F.col(key).alias("id"), F.unix_micros("loaded_at").alias("loaded_us"), F.array_join(records.broken(kind), ",").alias("broken")).where("broken <> ''")
        out = found if out is None else out.unionByName(found)
    return out


def planned_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as regions of their order: one segment each, numbered, with the time spoken in all of them."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("long").alias("q"))
    region = F.struct(((F.col("l_linenumber") - 1) * 100).cast("long").alias("start"), ((F.col("l_linenumber") - 1) * 100 + F.col("q")).cast("long").alias("end"))
    parents = rows.groupBy(F.concat(F.lit("order "), F.col("l_orderkey").cast("string")).alias("id")).agg(F.array_sort(F.collect_list(region)).alias("regions")).withColumn("rate", F.lit(100))
    return audio.cut(parents, "regions", "rate", "id").select("segment_id", F.round("start_sec", 6).alias("start_sec"), F.round("end_sec", 6).alias("end_sec"), F.round("spoken_sec", 6).alias("spoken_sec"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        speech_checks, speech_summary, issue_histogram, passed_speech, duplicate_texts, latest_review, review_reuse, upserted_reviews, evidence_chain, regression_diff,
        regression_summary, gate_sets, manifest_lines, document_lines, bad_regions, stage_steps, waveform_tails, common_samples, unique_batches, contract_violations, planned_segments,
    )
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    from .text_queries import _JA, _WS

    speech = """s as (select sample_id, coalesce(text.reference_text, '') t, audio.duration_sec sec, row_number() over (partition by sample_id order by loaded_at desc, coalesce(text.reference_text, '') desc) r from sample_manifest)"""
    checked = rf"""with {speech},
        k as (select *, length(regexp_replace(t, '{_WS}+', '', 'g')) n, regexp_replace(t, '[{_WS[1:-1]}\pP]', '', 'g') b, regexp_replace(t, '[^\pL\pN]', '', 'g') e, count(*) over (partition by t) n_same from s where r = 1),
        m as (select *, case when sec > 0 then n / sec end density, length(regexp_replace(e, '[^{_JA}]', '', 'g')) / nullif(length(e), 0) ratio,
          len(list_filter(range(1, 21), lambda u: length(b) > 0 and length(b) % u = 0 and length(b) // u >= 3 and repeat(left(b, u), length(b) // u) = b)) > 0 repeats from k),
        i as (select *, list_filter([case when n = 0 then 'empty_transcript' end, case when sec is null then 'duration_unavailable' end, case when sec < 0.5 then 'duration_too_short' end, case when sec > 30 then 'duration_too_long' end,
          case when n > 0 and (density < 1 or density > 20) then 'transcript_density_anomaly' end, case when ratio < 0.3 then 'low_japanese_script_ratio' end, case when repeats then 'excessive_text_repetition' end, case when n > 0 and n_same > 1 then 'duplicate_text' end], lambda x: x is not null) codes from m),
        c as (select *, case when list_contains(codes, 'empty_transcript') then 'drop' when len(codes) > 0 then 'review' else 'pass' end decision from i)"""
    fields = {"source_text": "source_text_changed", "reasons": "risk_status_changed", "tts_backend": "provenance_config_changed", "tts_model_name": "provenance_config_changed", "speaker": "provenance_config_changed", "policy_fingerprint_sha256": "provenance_config_changed", "audio_sha256": "artifact_identity_changed"}
    state = lambda t: f"""(select *, array_to_string(review_reasons, ',') reasons from (select *, row_number() over (partition by sample_id order by l desc, evidence_id desc) k from
          (select *, row_number() over (partition by evidence_id order by l desc, coalesce(g, 9000000000000000000) desc) n from r where l <= {t}) where n = 1 and (g is null or g > {t})) where k = 1)"""  # noqa: E731
    differ = ", ".join(f"case when not no_a and not no_b and a_{f} is distinct from b_{f} then '{k}:{f}' end" for f, k in fields.items())
    cases = f"""with r as (select *, epoch_us(loaded_at) l, epoch_us(deleted_at) g, (min(epoch_us(loaded_at)) over () + max(epoch_us(loaded_at)) over ()) // 2 mid, max(epoch_us(loaded_at)) over () fin from pronunciation_evidence),
          j as (select coalesce(a.sample_id, b.sample_id) sample_id, a.sample_id is null no_a, b.sample_id is null no_b, {", ".join(f"a.{f} a_{f}, b.{f} b_{f}" for f in fields)} from {state("mid")} a full join {state("fin")} b using (sample_id)),
          x as (select *, concat_ws(',', case when no_a then 'baseline_case_missing:sample_id' end, case when no_b then 'current_case_missing:sample_id' end, {differ}) changes,
            case when no_a or no_b or a_source_text is distinct from b_source_text or a_reasons is distinct from b_reasons then 'review' else 'no_regression_detected' end decision from j)"""
    summary = ", ".join(f"count(*) filter (where decision = '{k}') n_{k}, round(coalesce(sum(sec) filter (where decision = '{k}'), 0), 3) sec_{k}" for k in ("pass", "review", "drop"))
    return {
        "speech_checks": f"{checked} select sample_id, decision, array_to_string(codes, ',') codes, round(ratio, 6) ratio from c",
        "speech_summary": f"{checked} select count(*) total, {summary} from c",
        "issue_histogram": f"{checked} select code, count(*) n from (select unnest(codes) code from c) group by code",
        "passed_speech": f"{checked} select sample_id, cast(n as integer) n_chars from c where decision = 'pass'",
        "duplicate_texts": """with s as (select sample_id, coalesce(text.normalized_text, '') t, row_number() over (partition by sample_id order by loaded_at desc, coalesce(text.normalized_text, '') desc) r from tts_text_samples)
            select t, count(*) n, min(sample_id) first_id from s where r = 1 and t <> '' group by t having count(*) > 1""",
        "latest_review": """select logical_case_id, arg_max(review_id, (reviewed_at, review_id)) review_id, arg_max(decision, (reviewed_at, review_id)) decision,
            (select strftime(max(reviewed_at) at time zone 'UTC', '%Y-%m-%dT%H:%M:%S') || case when epoch_us(max(reviewed_at)) % 1000000 <> 0 then '.' || lpad(cast(epoch_us(max(reviewed_at)) % 1000000 as varchar), 6, '0') else '' end || '+00:00') reviewed_at
            from human_review_record group by logical_case_id""",
        "review_reuse": """with l as (select * from (select *, row_number() over (partition by sample_id order by loaded_at desc, qa_id desc) r from generated_audio_qa) where r = 1 and status = 'completed'),
            n as (select distinct qa_id, sample_id, audio_path, observed_audio_sha256 from generated_audio_qa)
            select n.qa_id, l.sample_id is not null and n.audio_path is not distinct from l.audio_path and n.observed_audio_sha256 is not distinct from l.observed_audio_sha256 reused,
              coalesce(case when l.sample_id is not null and n.audio_path is not distinct from l.audio_path and n.observed_audio_sha256 is not distinct from l.observed_audio_sha256 then l.asr_transcript end, '') transcript
            from n left join l using (sample_id)""",
        "upserted_reviews": """with r as (select distinct review_id, loaded_at, decision, reviewer_id from human_review_record)
            select review_id, decision, reviewer_id, epoch_us(loaded_at) loaded_us from (select *, row_number() over (partition by review_id order by loaded_at desc, decision desc, reviewer_id desc) n from r) where n = 1""",
        "evidence_chain": """with e as (select distinct evidence_id, stage9_qa_id, sample_id, audio_sha256, artifact_run_id, source_text from pronunciation_evidence),
            q as (select qa_id, max({'l': loaded_at, 'status': status, 'decision': decision, 'sample_id': sample_id, 'run_id': run_id, 'heard': observed_audio_sha256, 'wanted': expected_audio_sha256}) q from generated_audio_qa group by qa_id),
            g as (select current_evidence_id, count(*) filter (where len(list_filter(changes, lambda c: c.material_pronunciation_change)) > 0) n_material from pronunciation_regression where current_evidence_id is not null group by 1)
            select evidence_id, q.qa_id is not null has_qa, g.current_evidence_id is not null has_regression, concat_ws(',', case when not coalesce(q.q.status = 'completed', false) then 'qa_completed' end, case when not coalesce(q.q.decision = 'pass', false) then 'qa_passed' end,
              case when not coalesce(e.sample_id = q.q.sample_id, false) then 'one_sample' end, case when not coalesce(e.artifact_run_id = q.q.run_id, false) then 'one_run' end,
              case when not coalesce(e.audio_sha256 = q.q.heard and e.audio_sha256 = q.q.wanted, false) then 'one_audio' end) problems, coalesce(n_material, 0) n_material
            from e left join q on e.stage9_qa_id = q.qa_id left join g on e.evidence_id = g.current_evidence_id""",
        "regression_diff": f"{cases} select sample_id, changes, decision from x where changes <> ''",
        "regression_summary": f"{cases} select count(*) filter (where not no_a) baseline_cases, count(*) filter (where not no_b) current_cases, count(*) filter (where not no_a and not no_b) compared_cases, count(*) filter (where decision <> 'review') no_regression_detected, count(*) filter (where decision = 'review') review_candidates, count(*) filter (where decision <> 'review' and changes <> '') provenance_only_changes from x",
        "gate_sets": """with g as (select distinct gate_id, reason_codes r, hard_blocker_codes h from release_gate_result), x as (select *, list_concat(r, h) a from g)
            select gate_id, array_to_string(list_filter(a, lambda x, i: list_position(a, x) = i), ',') codes, array_to_string(list_sort(list_distinct(list_filter(h, lambda x: not list_contains(r, x)))), ',') unnamed,
              len(list_filter(h, lambda x: not list_contains(r, x))) = 0 covered, list_sort(list_distinct(h)) = list_sort(list_distinct(r)) equal from x""",
        "manifest_lines": """select line_id, case when json_valid(line) then 'none' else 'malformed' end problem, case when json_valid(line) then coalesce(json_extract_string(line, '$.raw_text'), '') else '' end raw_text from raw_manifest_lines""",
        "document_lines": r"""with c as (select doc_id, regexp_split_to_array(regexp_replace(text, '(\r\n|\n|\r)\z', ''), '\r\n|\n|\r') l from documents where text is not null and text <> '')
            select doc_id, cast(unnest(range(1, len(l) + 1)) as integer) line_no, cast(length(unnest(l)) as integer) n from c""",
        "bad_regions": """with d as (select sample_id, min({'p': lineage.parent_sample_id, 'a': lineage.segment_start_sec, 'b': lineage.segment_end_sec}) x from sample_manifest
              where lineage.parent_sample_id is not null and lineage.segment_start_sec is not null and lineage.segment_end_sec is not null group by sample_id),
            n as (select sample_id p, max(audio.duration_sec) sec from sample_manifest group by sample_id),
            l as (select sample_id, x.p p, x.a a, x.b b, n.sec, lag(x.b) over (partition by x.p order by x.a, x.b) e from d left join n on n.p = x.p)
            select sample_id, p, concat_ws(',', case when b < a then 'backward' end, case when a < e then 'overlap' end, case when b > sec then 'beyond' end) problems from l where b < a or a < e or b > sec""",
        "stage_steps": "select distinct sample_id, state.stage stage, case state.stage when 'ingested' then 'audio_prepared' when 'audio_prepared' then 'transcribed' when 'transcribed' then 'curated' when 'text_prepared' then 'curated' else state.stage end \"next\" from sample_manifest",
        "waveform_tails": """with e as (select vec_id, list_transform(embedding, lambda v: abs(cast(v as double))) x from embeddings)
            select vec_id, round(list_max(x), 6) peak, round(sqrt(list_sum(list_transform(x, lambda v: v * v)) / len(x)), 6) rms,
              len(x) - coalesce(list_max(list_filter(list_transform(x, lambda v, i: case when v > power(10.0, -2.5) then i end), lambda k: k is not null)), 0) trailing_samples,
              coalesce(list_max(list_filter(list_transform(x, lambda v, i: case when v > power(10.0, -2.5) then i end), lambda k: k is not null)), 0) - 1 last_audible, len(x) n from e""",
        "contract_violations": """with c as (select 'speech_sample' kind, sample_id id, epoch_us(loaded_at) loaded_us, concat_ws(',', case when not audio.channels > 0 then 'channels_not_positive' end, case when not audio.duration_sec >= 0 then 'duration_negative' end,
              case when coalesce(trim(sample_id), '') = '' then 'id_blank' end, case when metadata is not null and not json_valid(metadata) then 'metadata_not_json' end,
              case when lower(trim(lineage.parent_sample_id)) = lower(trim(sample_id)) then 'own_parent' end, case when not audio.sample_rate_hz > 0 then 'rate_not_positive' end,
              case when not lineage.segment_end_sec >= lineage.segment_start_sec then 'segment_backward' end, case when (lineage.segment_start_sec is null) <> (lineage.segment_end_sec is null) then 'segment_half_open' end,
              case when lineage.segment_start_sec is not null and lineage.parent_sample_id is null then 'segment_without_parent' end, case when schema_version <> '1.0' then 'version_unknown' end) broken from sample_manifest
            union all select 'review', review_id, epoch_us(loaded_at), concat_ws(',', case when decision <> 'approve' and len(reason_codes) = 0 then 'reason_given' end, case when len(list_distinct(reason_codes)) <> len(reason_codes) then 'reasons_once' end,
              case when len(list_filter(resolved_issue_ids, lambda x: not regexp_full_match(x, '[0-9a-f]{64}'))) > 0 then 'resolved_ids' end, case when len(list_distinct(resolved_issue_ids)) <> len(resolved_issue_ids) then 'resolved_once' end,
              case when rework_target is not null and decision <> 'rework' then 'target_only_for_rework' end) from human_review_record
            union all select 'gate', gate_id, epoch_us(loaded_at), concat_ws(',', case when decision <> 'released' and len(reason_codes) = 0 then 'held_has_reason' end, case when review_freshness = 'missing' and review_id is not null then 'missing_has_no_review' end,
              case when decision = 'released' and not (review_freshness = 'current' and human_decision = 'approve') then 'released_is_current' end, case when decision = 'released' and len(reason_codes) + len(hard_blocker_codes) > 0 then 'released_without_reason' end) from release_gate_result
            union all select 'qa_result', qa_id, epoch_us(loaded_at), concat_ws(',', case when decision = 'drop' and not list_contains(s, 'critical') then 'drop_is_critical' end, case when (status = 'failed') <> (decision = 'undecided') then 'failed_is_undecided' end,
              case when decision = 'pass' and coalesce(asr_transcript, '') = '' then 'pass_has_evidence' end, case when decision = 'pass' and (list_contains(s, 'warning') or list_contains(s, 'critical')) then 'pass_without_issue' end,
              case when not regexp_full_match(qa_id, '[0-9a-f]{64}') then 'qa_id' end, case when decision_reasons <> list_transform(issues, lambda i: i.code) then 'reasons_are_codes' end, case when decision = 'review' and coalesce(asr_transcript, '') = '' then 'review_has_evidence' end,
              case when decision = 'review' and not list_contains(s, 'warning') then 'review_has_warning' end, case when not regexp_full_match(run_id, '[0-9a-f]{64}') then 'run_id' end) from (select *, list_transform(issues, lambda i: i.severity) s from generated_audio_qa))
            select * from c where broken <> ''""",
        "planned_segments": """with r as (select 'order ' || l_orderkey id, (l_linenumber - 1) * 100 a, (l_linenumber - 1) * 100 + cast(l_quantity as bigint) b from lineitem),
            n as (select *, cast(row_number() over (partition by id order by a, b) as varchar) k, sum(b - a) over (partition by id) s from r)
            select replace(id, ' ', '_') || '_' || left(sha256(id), 8) || '__seg' || lpad(k, greatest(4, length(k))::int, '0') segment_id, round(a / 100, 6) start_sec, round(b / 100, 6) end_sec, round(s / 100, 6) spoken_sec from n""",
        "common_samples": "select distinct sample_id from generated_audio_qa where sample_id in (select sample_id from pronunciation_evidence)",
        "unique_batches": "select batch_no, count(*) n, count(distinct sample_id) n_records from tts_text_samples group by batch_no",
    }
