import json
import struct
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kotonoha.operators import history as hx
from kotonoha.operators import integrity, issues, providers
from kotonoha.sources import audio, manifests

SCHEMA = T.StructType([T.StructField("sample_id", T.StringType()), T.StructField("text", T.StructType([T.StructField("raw", T.StringType())]))])


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_issues_decide_by_severity(spark):
    df = spark.createDataFrame([(1, 0.2), (2, 5.0), (3, None), (4, 40.0)], "id int, sec double")
    rules = [issues.Rule("missing", "critical", F.col("sec").isNull()), issues.Rule("short", "warning", F.col("sec") < 0.5, {"sec": F.col("sec")}), issues.Rule("long", "info", F.col("sec") > 30)]
    out = df.withColumn("i", issues.issues(rules)).withColumn("d", issues.decision(F.col("i")))
    assert rows(out.select("id", "d", F.array_join(issues.codes(F.col("i")), ","))) == [(1, "review", "short"), (2, "pass", ""), (3, "drop", "missing"), (4, "pass", "long")]
    assert rows(issues.histogram(out, issues.codes(F.col("i"), with_info=False))) == [("missing", 1), ("short", 1)]
    total = issues.summary(out, "d", "sec", ("pass", "review", "drop"))
    assert issues.balanced(total, "total", ["n_pass", "n_review", "n_drop"]).first()["amount_pass"] == 45.0
    with pytest.raises(Exception, match="differ"):
        issues.balanced(total, "total", ["n_pass"]).collect()


def test_integrity_checks_fire(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, v string")
    with pytest.raises(Exception, match="repeated"):
        integrity.assert_unique(df, ["k"], "repeated").count()
    assert integrity.assert_unique(df.where("v <> 'b'"), ["k"], null_ok=True).count() == 2
    other = spark.createDataFrame([(9,)], "k int")
    with pytest.raises(Exception, match="no common key"):
        integrity.assert_overlap(df, other, ["k"]).collect()
    assert integrity.assert_overlap(df, other.limit(0), ["k"]).count() == 3
    with pytest.raises(Exception, match="bad value"):
        integrity.require(df, F.col("k") > 0, "bad value").count()


def test_earlier_output(spark):
    old = spark.createDataFrame([("a", "p1", "t1"), ("b", "p1", "t2"), ("z", "p", "t")], "id string, path string, text string")
    new = spark.createDataFrame([("a", "p1"), ("b", "p2"), ("c", "p3")], "id string, path string")
    assert rows(hx.reuse(new, old, ["id"], ["path"], ["text"]).select("id", "reused", F.coalesce("text", F.lit("-")))) == [("a", True, "t1"), ("b", False, "-"), ("c", False, "-")]
    assert rows(hx.upsert(old, spark.createDataFrame([("b", "x", "y")], old.schema), ["id"])) == [("a", "p1", "t1"), ("b", "x", "y"), ("z", "p", "t")]
    log = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, None)], "k string, n int, v string")
    assert hx.latest(log, ["k"], ["n"]).where("k = 'a'").first()["v"] == "y"
    diff = hx.snapshot_diff(log.where("n = 1"), log.where("n = 2 or k = 'b'"), ["k"], ["n"], ["v"])
    assert rows(diff.select("k", "status", F.array_join("changed", ","), "material")) == [("a", "changed", "n,v", True), ("b", "same", "", False)]
    assert rows(hx.snapshot_diff(log.where("k = 'b'"), log.limit(0), ["k"], ["n"]).select("status", "material")) == [("removed", True)]
    with pytest.raises(Exception, match="no step"):
        log.select(hx.transition(F.col("k"), F.lit("c"), {"a": ["c"]})).collect()
    parts = spark.createDataFrame([("p", 0, 5), ("p", 4, 9), ("p", 9, 8), ("q", 0, 1)], "p string, a int, b int")
    assert hx.bad_regions(parts, "p", "a", "b").count() == 2
    assert rows(hx.duplicate_groups(log, "k", "n")) == [("a", 2, 1)]


def test_manifests(spark, tmp_path):
    good = tmp_path / "m.jsonl"
    good.write_text('{"sample_id":"a","text":{"raw":"x"}}\r\n{"sample_id":"b","text":null}\n', newline="")
    assert manifests.read_manifest(spark, str(good), SCHEMA, key="sample_id").count() == 2
    for line in ('{"sample_id":"c"', "", '{"sample_id":"c","more":1}', '{"sample_id":"c","text":{"raw":"x","odd":2}}', "[1]"):
        bad = tmp_path / f"bad{abs(hash(line))}.jsonl"
        bad.write_text('{"sample_id":"a","text":null}\n' + line + "\n")
        with pytest.raises(Exception, match=":2: "):
            manifests.read_manifest(spark, str(bad), SCHEMA).collect()
    odd = spark.createDataFrame([('{"a":1,"sample_id":"x","text":{"raw":"y","odd":2}}',)], "line string")
    assert odd.select(manifests.unknown_fields(F.col("line"), SCHEMA)).first()[0] == ["a", "text.odd"]
    with pytest.raises(Exception, match="repeated"):
        twice = tmp_path / "twice.jsonl"
        twice.write_text('{"sample_id":"a"}\n{"sample_id":"a"}\n')
        manifests.read_manifest(spark, str(twice), SCHEMA, key="sample_id").collect()
    assert manifests.read_manifest(spark, str(tmp_path / "none"), SCHEMA, missing_ok=True).count() == 0
    out = str(tmp_path / "out")
    df = spark.createDataFrame([("b", None), ("a", ("日本",))], SCHEMA)
    manifests.write_manifest(df, out, key="sample_id")
    assert spark.read.text(out).first()[0] == '{"sample_id":"a","text":{"raw":"日本"}}'
    plain = tmp_path / "t.txt"
    plain.write_text("一行\n 二行 \n")
    assert rows(manifests.ingest_lines(spark, str(plain), prefix="my set", dataset_id="d")) == [("MY_SET_000001", "一行", "line:1"), ("MY_SET_000002", " 二行 ", "line:2")]
    plain.write_text("a\n \n")
    with pytest.raises(Exception, match=":2: blank"):
        manifests.ingest_lines(spark, str(plain), prefix="x", dataset_id="d").collect()
    plain.write_text("")
    assert manifests.numbered_lines(spark, str(plain)).count() == 0
    assert json.loads(manifests.schema_json(SCHEMA))["type"] == "struct"
    paths = spark.createDataFrame([("/a/b",), ("c",)], "p string")
    assert [r[0] for r in paths.select(manifests.resolve(F.col("p"), "/r")).collect()] == ["/a/b", "/r/c"]


def tone(seconds, rate, channels=1, silence=0.0):
    x = 0.5 * np.sin(np.arange(int(seconds * rate)) * 2 * np.pi * 440 / rate)
    x = np.concatenate((x, np.zeros(int(silence * rate))))
    return np.repeat(x[:, None], channels, axis=1)


def test_wav_round_trip_and_codes(spark, tmp_path):
    x = tone(0.5, 24_000)[:, 0]
    raw = audio.encode(x, 24_000)
    back, rate = audio.decode(raw)
    assert rate == 24_000 and np.abs(back[:, 0] - x).max() < 1e-4
    (tmp_path / "ok.wav").write_bytes(raw)
    (tmp_path / "bad.wav").write_bytes(b"RIFFxxxxWAVEjunk" * 8)
    (tmp_path / "silent.wav").write_bytes(audio.encode(np.zeros(1000), 8000))
    (tmp_path / "empty.wav").write_bytes(raw[:40] + struct.pack("<I", 0))
    names = spark.createDataFrame([(str(tmp_path / n),) for n in ("ok.wav", "bad.wav", "silent.wav", "empty.wav", "gone.wav")], "path string")
    found = audio.attach(names, audio.read_audio(spark, str(tmp_path)), "path")
    codes = {r["path"].rsplit("/", 1)[1]: r["audio_code"] for r in found.collect()}
    assert codes == {"ok.wav": None, "bad.wav": "audio_decode_failed", "silent.wav": "audio_silent", "empty.wav": "audio_empty", "gone.wav": "audio_missing"}
    with pytest.raises(ValueError):
        audio.encode(np.zeros(0), 8000)


def test_preparation_padding_and_tail():
    stereo = tone(1.0, 44_100, 2)
    mono = audio.prepare(stereo, 44_100)
    assert len(mono) == 16_000 and abs(float(np.abs(mono[2000:-2000]).max()) - 0.5) < 0.01
    assert [audio.padding_frames(24_000, ms) for ms in (0, 300, 500)] == [0, 7200, 12_000]
    padded = audio.pad_tail(stereo, 44_100, 300)
    assert (padded[: len(stereo)] == stereo).all() and not padded[len(stereo) :].any()
    waves = [np.abs(tone(0.5, 8000, 1, 0.2)[:, 0]), np.zeros(40), np.ones(3), np.array([0.5, 0.25, 0.0, 0.001])]
    got = audio.tails(np.concatenate(waves), np.cumsum([0] + [len(w) for w in waves]), 8000, audible=0.01, bounds=(0.01, 0.1), windows_ms=(1, 50))
    for k, w in enumerate(waves):
        heard = [i for i, x in enumerate(w) if x > 0.01]
        assert got["last_audible"][k] == (heard[-1] if heard else -1) and got["trailing_samples"][k] == len(w) - 1 - (heard[-1] if heard else -1)
        assert got["peak"][k] == max(w) and abs(got["rms"][k] - np.sqrt(np.mean(w**2))) < 1e-9
        for ms, n in ((1, 8), (50, 400)):
            assert got[f"peak_{ms}"][k] == max(w[-n:]) and abs(got[f"rms_{ms}"][k] - np.sqrt(np.mean(w[-n:] ** 2))) < 1e-9
    assert [audio.TAIL_NAMES[k][:5] for k in got["kind"]] == ["subst", "no_de", "no_de", "no_de"] and 0.2 <= got["trailing_sec"][0] < 0.21
    assert audio.decibels(np.array([1.0, 0.1])).tolist() == [0.0, -20.0] and np.isnan(audio.decibels(np.zeros(1)))[0]
    assert audio.energy_regions(np.concatenate((np.zeros(8000), tone(0.5, 8000)[:, 0], np.zeros(8000))), 8000) == [(8000, 12_000)]
    with pytest.raises(ValueError):
        audio.padding_frames(24_000, -1)


def test_pcm_widths(tmp_path):
    x = np.array([0, 0.5, -0.5, 0.25])
    for width in (1, 2, 3, 4):
        with wave.open(str(tmp_path / "w.wav"), "wb") as w:
            w.setnchannels(1)
            w.setsampwidth(width)
            w.setframerate(8000)
            if width == 1:
                w.writeframes((np.round(x * 128) + 128).astype(np.uint8).tobytes())
            else:
                full = np.round(x * (1 << (8 * width - 1))).astype("<i4")
                w.writeframes(b"".join(int(v).to_bytes(width, "little", signed=True) for v in full))
        assert np.allclose(audio.decode((tmp_path / "w.wav").read_bytes())[0][:, 0], x, atol=0.01)


def test_providers(spark):
    df = spark.createDataFrame([("かな",), ("漢字",), (None,)], "t string").repartition(1)
    got = [tuple(r[0]) for r in df.select(providers.lookup({"漢字": "カンジ"})("t")).collect()]
    assert set(got) == {(None, "no entry"), ("カンジ", None), (None, None)}
    kana = [tuple(r[0]) for r in df.select(providers.kana_passthrough()("t")).collect()]
    assert ("カナ", None) in kana and (None, "kanji needs a dictionary") in kana

    def fail():
        raise RuntimeError("the model can't be loaded")

    assert df.limit(0).select(providers.provider(fail, lambda m, x: x)("t")).count() == 0
    with pytest.raises(Exception, match="can't be loaded"):
        df.select(providers.provider(fail, lambda m, x: x)("t")).collect()
    plans = spark.createDataFrame([("a", "テスト", 3), ("b", None, 4)], "id string, text string, seed int")
    out = {r["id"]: (r["error"], r["audio"] and audio.decode(bytes(r["audio"]))[1]) for r in providers.synthesize(plans, dict, providers.tone(), 1).collect()}
    assert out == {"a": (None, 24_000), "b": ("no text", None)}
