import numpy as np
import pytest
from pyspark.sql import functions as F

from kotonoha import cli
from kotonoha.functions import text as tx
from kotonoha.sources import audio, contracts
from kotonoha.streaming import latest


def test_contract_checks(spark):
    good = {"schema_version": "1.0", "sample_id": "a", "audio": {"duration_sec": 1.0, "sample_rate_hz": 16000, "channels": 1}, "lineage": {"parent_sample_id": None}, "metadata": "{}"}
    bad = good | {"sample_id": "b", "audio": {"duration_sec": -1.0, "sample_rate_hz": 0, "channels": None}, "lineage": {"parent_sample_id": "b", "segment_start_sec": 3.0, "segment_end_sec": 2.0}, "metadata": "{"}
    half = good | {"sample_id": "c", "lineage": {"segment_start_sec": 3.0}, "schema_version": "2"}
    df = spark.createDataFrame([good, bad, half], contracts.SPEECH_SAMPLE)
    got = {r["sample_id"]: r["v"] for r in df.select("sample_id", contracts.violations(contracts.speech_checks()).alias("v")).collect()}
    assert got["a"] == []
    assert got["b"] == ["duration_negative", "metadata_not_json", "own_parent", "rate_not_positive", "segment_backward"]
    assert got["c"] == ["segment_half_open", "segment_without_parent", "version_unknown"]


def test_stream_keeps_latest_and_survives_repeats(spark, tmp_path):
    source, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    schema = "k string, n int, v string"
    spark.createDataFrame([("a", 1, "x"), ("b", 5, "y")], schema).write.parquet(source)

    def run():
        query = latest.keep_latest(spark.readStream.schema(schema).parquet(source), ["k"], ["n"], out, mark, fan_in=2)
        query.awaitTermination()
        return sorted(tuple(r) for r in latest.current(spark, out, ["k"], ["n"]).collect())

    assert run() == [("a", 1, "x"), ("b", 5, "y")]
    spark.createDataFrame([("a", 3, "z"), ("b", 2, "old"), ("c", 1, None)], schema).write.mode("append").parquet(source)
    assert run() == [("a", 3, "z"), ("b", 5, "y"), ("c", 1, None)]
    assert run() == [("a", 3, "z"), ("b", 5, "y"), ("c", 1, None)]
    for n in range(4, 9):
        spark.createDataFrame([("a", n, "more"), ("d", n, None)], schema).write.mode("append").parquet(source)
        assert run() == [("a", n, "more"), ("b", 5, "y"), ("c", 1, None), ("d", n, None)]
    left = latest._parts(spark, out)
    assert len(left["v"]) <= 2 and len(left["d"]) <= 4
    assert latest.current(spark, str(tmp_path / "none"), ["k"], ["n"]) is None


def test_audio_files(spark, tmp_path):
    raw = audio.encode(0.25 * np.sin(np.arange(2400) / 9), 24_000)
    padded = audio.padded_copy(raw, 300)
    assert len(audio.decode(padded)[0]) == 2400 + 7200
    df = spark.createDataFrame([("x/a.wav", bytearray(raw)), ("b.wav", None)], "name string, audio binary")
    audio.write_wavs(df, "name", "audio", str(tmp_path))
    assert [p.name for p in tmp_path.rglob("*") if p.is_file()] == ["a.wav"]
    want = spark.createDataFrame([(str(tmp_path / "x/a.wav"), "0" * 64, 24_000, 2, 0.1)], "path string, expected_sha256 string, expected_rate int, expected_channels int, expected_duration_sec double")
    found = audio.attach(want, audio.read_audio(spark, str(tmp_path)), "path")
    assert found.select(audio.mismatches()).first()[0] == ["audio_hash_mismatch", "audio_channel_count_mismatch"]
    parents = spark.createDataFrame([("p 1", [(0, 10), (20, 50)], 10)], "id string, regions array<struct<start:bigint,end:bigint>>, rate int")
    rows = audio.cut(parents, "regions", "rate", "id").orderBy("start_sec").collect()
    assert [(r["start_sec"], r["end_sec"], r["spoken_sec"]) for r in rows] == [(0.0, 1.0, 4.0), (2.0, 5.0, 4.0)] and rows[1]["segment_id"].endswith("__seg0002")


def test_substitution_checks_recorded_counts(spark):
    df = spark.createDataFrame([("雨と雨傘",)], "t string")
    swap = {"雨": "アメ", "雨傘": "アマガサ"}
    good = df.select(tx.verified_substitution(F.col("t"), swap, {"雨": 1, "雨傘": 1}).alias("x")).first()["x"]
    bad = df.select(tx.verified_substitution(F.col("t"), swap, {"雨": 2}).alias("x")).first()["x"]
    assert tuple(good) == ("アメとアマガサ", None) and tuple(bad) == (None, "雨")
    assert df.select(tx.substitute(F.col("t"), {})).first()[0] == "雨と雨傘"
    moments = spark.sql("select timestamp'2025-01-02 03:04:05' a, timestamp'2025-01-02 03:04:05.000120' b")
    assert tuple(moments.select(tx.utc_text(F.col("a")), tx.utc_text(F.col("b"))).first()) == ("2025-01-02T03:04:05+00:00", "2025-01-02T03:04:05.000120+00:00")
    assert df.select(tx.blank_to_null(F.lit(" 　"))).first()[0] is None and tx.kanji_runs is not None


def test_command_line(spark, tmp_path):
    (tmp_path / "t.txt").write_text("３,５００円\n２\n")
    out = str(tmp_path / "m")
    args = cli.parser().parse_args(["ingest-text", "--input", str(tmp_path / "t.txt"), "--output", out, "--dataset", "d"])
    args.run(spark, args)
    args = cli.parser().parse_args(["normalize", "--input", out, "--output", out + ".parquet"])
    args.run(spark, args)
    assert sorted(r["normalized_text"] for r in spark.read.parquet(out + ".parquet").collect()) == ["2", "3500円"]
    args = cli.parser().parse_args(["orphans", "--input", out, "--targets", out + ".parquet", "--columns", "sample_id", "--keys", "source_id", "--keep", "sample_id", "--output", out + "2.parquet"])
    args.run(spark, args)
    assert spark.read.parquet(out + "2.parquet").count() == 2
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["nothing"])
