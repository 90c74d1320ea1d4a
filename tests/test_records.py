import hashlib
import json

import pytest
from pyspark.sql import functions as F

from kotonoha import cli
from kotonoha.functions import identity
from kotonoha.operators import chains, regression
from kotonoha.operators import history as hx
from kotonoha.sources import manifests, records

SHA = "a" * 64


def test_lines_of_large_files_are_numbered_across_splits(spark, tmp_path):
    path = tmp_path / "big.txt"
    lines = [f"line {i} " + "x" * (i % 50) for i in range(3000)]
    path.write_bytes("".join(x + ("\r\n" if i % 3 == 0 else "\r" if i % 3 == 1 else "\n") for i, x in enumerate(lines)).encode())
    (tmp_path / "b.txt").write_bytes(b"one\n\ntwo")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7k")
    try:
        got = manifests.numbered_lines(spark, str(tmp_path / "*.txt")).collect()
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r["line"] for r in sorted(got, key=lambda r: r["line_no"]) if r["file"].endswith("big.txt")] == lines
    assert sorted((r["line_no"], r["line"]) for r in got if r["file"].endswith("b.txt")) == [(1, "one"), (2, ""), (3, "two")]


def evidence(case, **more):
    reference = {"reference_id": SHA, "scope": "full_text", "surface": None, "expected_reading": "カナ", "canonical_expected_reading": "カナ", "expectation_source": "reading_provider", "confirmation_status": "derived", "provenance_reference": "p"}
    risk = {"risk_id": SHA, "surface": "名", "risk_type": "t", "reason": "r", "occurrence_count": 1, "evidence_source": "w", "spans": [{"text_form": "source", "start": 0, "end": 1, "text": "名"}], "expected_reference_id": SHA, "alignment_status": "expected_sequence_observed", "evidence_statement": "s"}
    seen = {"stage9_qa_id": SHA, "asr_transcript": "x", "observed_reading_kana": "カナ", "canonical_observed_reading": "カナ", "stage9_decision": "pass", "stage9_issue_codes": [], "stage9_edit_distance": 0, "stage9_cer": 0.0}
    out = {f.name: "v" for f in records.CONTRACTS["evidence"].schema.fields} | {
        "evidence_id": hashlib.sha256(case.encode()).hexdigest(), "logical_case_id": case, "decision": "no_review_needed", "review_reasons": [], "normalization_transformations": [], "expected_references": [reference],
        "risk_evidence": [risk], "observed_evidence": seen,
    }
    return out | more


def test_records_round_trip_sorted_and_checked(spark, tmp_path):
    schema = records.CONTRACTS["evidence"].schema
    df = spark.createDataFrame([evidence(c) for c in "cab"], schema)
    out = str(tmp_path / "m")
    records.write_records(df.withColumn("more", F.lit(1)), out, "evidence", order="logical_case_id")
    text = [r[0] for r in spark.read.text(out).collect()]
    assert [json.loads(t)["logical_case_id"] for t in text] == ["a", "b", "c"] and '"surface":null' in text[0]
    assert sorted(map(str, records.read_records(spark, out, "evidence").collect())) == sorted(map(str, df.collect()))
    bad = evidence("d", decision="review")
    bad["risk_evidence"][0]["spans"][0]["end"] = 5
    assert spark.createDataFrame([bad], schema).select(records.broken("evidence")).first()[0] == ["reasons_only_for_review", "review_follows_risks", "spans_fit"]
    records.write_records(spark.createDataFrame([bad], schema), str(tmp_path / "bad"), "evidence", single_file=True)
    with pytest.raises(Exception, match="spans_fit"):
        records.read_records(spark, str(tmp_path / "bad"), "evidence").collect()
    with pytest.raises(Exception, match="repeated"):
        records.write_records(df.unionByName(df), str(tmp_path / "twice"), "evidence")


def test_every_contract_exports_and_checks(spark):
    for kind, contract in records.CONTRACTS.items():
        out = json.loads(records.json_schema(kind))
        assert out["required"] == [contract.key] and list(out["properties"]) == sorted(out["properties"]) and out["additionalProperties"] is False
        assert set(out["properties"]) == set(contract.schema.names)
        assert spark.createDataFrame([], contract.schema).select(records.broken(kind)).count() == 0
    assert cli.main(["schema", "--kind", "gate"]) == 0


def test_lenient_field(spark, tmp_path):
    fields = records.CONTRACTS["audio_artifact"].schema.names
    base = dict.fromkeys(fields) | {"sample_id": "s"}
    values = [("r1", "カナ", False), ("r2", " ", True), ("r3", None, True), ("r4", 5, True), ("r5", {"a": 1}, True)]
    path = tmp_path / "a.jsonl"
    path.write_text("\n".join(json.dumps(base | {"run_id": r, "expected_reading_kana": v}, ensure_ascii=False) for r, v, _ in values) + '\n{"run_id":"r6","sample_id":"s"}\n')
    got = {r["run_id"]: (r["expected_reading_kana"], r["expected_reading_kana_missing"]) for r in records.read_records(spark, str(path), "audio_artifact", lenient="expected_reading_kana").collect()}
    assert got == {r: (None if m else v, m) for r, v, m in values} | {"r6": (None, True)}
    path.write_text('{"run_id":"r6","odd":1}\n')
    with pytest.raises(Exception, match="unknown_field"):
        records.read_records(spark, str(path), "audio_artifact", lenient="expected_reading_kana").collect()


PROVENANCE = [c for c in records.CONTRACTS["baseline"].schema.names if c in records.CONTRACTS["evidence"].schema.names and ("stage" in c or c.startswith(("tts", "speaker", "synthesis", "watch", "over", "prep")))]


def test_baseline_and_comparison(spark):
    schema = records.CONTRACTS["evidence"].schema
    old = spark.createDataFrame([evidence(c) for c in ("same", "text", "risk", "speaker", "gone")], schema)
    risky = evidence("risk")
    risky["risk_evidence"][0]["alignment_status"] = "alignment_unresolved"
    risky["risk_evidence"][0]["reason"] = "another reason doesn't count"
    new = spark.createDataFrame([evidence("same"), evidence("text", source_text="他"), risky, evidence("speaker", speaker="z", audio_sha256="b"), evidence("new")], schema)
    immaterial = dict.fromkeys(PROVENANCE, regression.PROVENANCE) | {"audio_sha256": regression.ARTIFACT}
    found = regression.compare_cases(regression.case_view(old, PROVENANCE), regression.case_view(new, PROVENANCE), "logical_case_id", regression.MATERIAL, immaterial)
    got = {r["logical_case_id"]: ([(c["kind"], c["baseline_value"], c["material_pronunciation_change"]) for c in r["changes"]], r["decision"]) for r in found.collect()}
    assert got["same"] == ([], "no_regression_detected") and got["text"] == ([("source_text_changed", '"v"', True)], "review")
    assert [c[0] for c in got["risk"][0]] == ["risk_status_changed"] and json.loads(got["risk"][0][0][1])[0] == {"surface": "名", "risk_type": "t", "alignment_status": "expected_sequence_observed"}
    assert got["speaker"] == ([("provenance_config_changed", '"v"', False), ("artifact_identity_changed", '"v"', False)], "no_regression_detected")
    assert got["new"][0][0][0] == "baseline_case_missing" and got["gone"] == ([("current_case_missing", '"gone"', True)], "review")
    assert tuple(regression.summary(found).first()) == (5, 5, 4, 2, 4, 1)
    baseline = regression.capture_baseline(old, PROVENANCE)
    assert set(baseline.columns) == set(records.CONTRACTS["baseline"].schema.names)
    first, again = ({r["logical_case_id"]: r["baseline_id"] for r in regression.capture_baseline(x, PROVENANCE).collect()} for x in (old, new))
    assert first["same"] == again["same"] and first["text"] == again["text"] and first["risk"] != again["risk"] and first["speaker"] != again["speaker"]


def test_ids_equal_hashes_of_canonical_json(spark):
    values = {"sample_id": "さ", "backend": "b", "model_name": "m", "speaker": "s", "config_fingerprint_sha256": SHA, "seed": 5, "synthesis_text_strategy": "t", "synthesis_text": None}
    own = identity.record_id("run", **{k: F.lit(v) if v is not None else F.lit(None).cast("string") for k, v in values.items()})
    plain = hashlib.sha256(json.dumps(values, sort_keys=True, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()
    assert spark.range(1).select(own).first()[0] == plain
    gate = dict.fromkeys(identity.IDENTITIES["gate"], "x") | {"reason_codes": ["a", "b"], "hard_blocker_codes": [], "review_id": None}
    columns = {k: F.lit(None).cast("string") if v is None else F.array(*map(F.lit, v)).cast("array<string>") if isinstance(v, list) else F.lit(v) for k, v in gate.items()}
    assert spark.range(1).select(identity.record_id("gate", **columns)).first()[0] == hashlib.sha256(json.dumps(gate, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    with pytest.raises(ValueError):
        identity.record_id("issue", source=F.lit("x"))


def test_chain_conditions(spark):
    part = "struct<sample_id:string,run_id:string,qa_id:string,audio_sha256:string,observed_audio_sha256:string,expected_reading_kana:string,synthesis_text:string,status:string,decision:string>"
    good = ("s", "r", "q", "h", "h", "k", "t", "completed", "pass")
    run, curation = (*good[:7], "success", None), (*good[:7], "curated", "pass")
    rows = [(good, good, run, good, curation), (good, ("s", "r", "q", "h2", "h", "k", "t2", None, None), run, (*good[:7], "failed", "pass"), None)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {part}" for n in ("passed", "artifact", "run", "qa", "curation")))
    assert [r[0] for r in df.select(chains.problems(chains.evidence_conditions())).collect()] == [[], ["qa_completed", "curation_passed", "one_sample", "one_audio", "one_input"]]
    assert len(chains.planning_conditions()) == 8


def test_review_chain(spark):
    kinds = {"artifact": "audio_artifact", "run": "synthesis_run", "qa": "qa_result", "evidence": "evidence", "regression": "regression"}
    values = {c: "v" for own in kinds.values() for c in records.CONTRACTS[own].schema.names} | {"status": "success", "decision": "pass", "decision_reasons": []}

    def record(kind, **more):
        if kind == "evidence":
            return evidence("v", **({k: "v" for k in ("evidence_id", "sample_id")} | {"observed_evidence": evidence("v")["observed_evidence"] | {"stage9_decision": "pass"}} | more))
        return {f.name: (values | more)[f.name] if f.dataType.typeName() == "string" or f.name in ("decision_reasons",) else None for f in records.CONTRACTS[kind].schema.fields}

    good = [record(k) for k in kinds.values()]
    bad = [record("audio_artifact", speaker="x"), record("synthesis_run", status="failed"), record("qa_result", decision_reasons=["c"], actual_synthesis_text="x"), record("evidence", audio_sha256=None), record("regression", logical_case_id="x")]
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(n, records.CONTRACTS[k].schema) for n, k in kinds.items()])
    df = spark.createDataFrame([tuple(good), tuple(bad)], schema)
    assert [r[0] for r in df.select(chains.problems(chains.review_chain())).collect()] == [[], ["run_succeeded", "one_case", "one_audio", "one_input", "one_speaker", "same_issues"]]


def test_state_at_a_moment(spark):
    df = spark.createDataFrame([("a", 1, None, "x"), ("a", 5, None, "y"), ("b", 1, 3, "x"), ("c", 9, None, "x"), ("d", 1, 3, "x"), ("d", 1, None, "z")], "k string, at int, gone int, v string")
    state = lambda t: sorted((r["k"], r["v"]) for r in hx.as_of(df, ["k"], F.col("at"), F.col("gone"), F.lit(t)).collect())
    assert state(2) == [("a", "x"), ("b", "x"), ("d", "z")] and state(5) == [("a", "y"), ("d", "z")] and state(0) == []


def test_companion_lists_and_summaries(spark, tmp_path):
    path = tmp_path / "list.json"
    path.write_text('{"version":"1","overrides":[{"surface":"雨","reading_kana":"アメ"},{"surface":"傘","reading_kana":"カサ"}]}')
    rows, sha = manifests.load_table(str(path), ("surface", "reading_kana"), "surface", entries="overrides")
    assert [r["surface"] for r in rows] == ["雨", "傘"] and sha == hashlib.sha256(path.read_bytes()).hexdigest()
    assert manifests.load_table(f"file://{path}", ("surface",), "surface", entries="overrides")[1] == sha
    for bad in ('{"overrides":[{"surface":" "}]}', '{"overrides":[{"surface":"a"},{"surface":"a"}]}', '{"overrides":[{"surface":"a"},{"surface":"b"},{"surface":"c"}]}'):
        path.write_text(bad)
        with pytest.raises(ValueError):
            manifests.load_table(str(path), ("surface",), "surface", entries="overrides", most=2)
    manifests.write_summary(spark.range(3).agg(F.count("*").alias("件数")), str(tmp_path / "deep" / "s.json"))
    assert json.loads((tmp_path / "deep" / "s.json").read_text()) == {"件数": 3}
