"""Queries on scalar text functions over the domain tables, with their SQL.

Results are flat: arrays are joined with commas, doubles rounded to six places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identity, text as tx
from ..sources.tables import table

OVERRIDES = {"傘": "カサ", "名札": "ナフダ", "入館カード": "ニューカンカード", "カード": "カード(札)", "録音機": "ロクオンキ"}
WATCHED = (("工具箱", "noun"), ("名札", "noun"), ("港", "place"), ("温泉", "place"))


def _manifest(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "sample_manifest").select("sample_id", F.unix_micros("loaded_at").alias("loaded_us"), F.col("text.reference_text").alias("t"), F.col("audio.duration_sec").alias("sec"))


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "tts_text_samples").select("sample_id", "batch_no", F.unix_micros("loaded_at").alias("loaded_us"), F.col("text.raw_text").alias("t"))


def text_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Characters, characters a second, script ratio and repeated unit of every reference text."""
    rows = _manifest(spark, sf)
    return rows.select(
        "sample_id", "loaded_us",
        F.length(tx.compact(F.col("t"))).alias("n_chars"),
        F.round(tx.density(F.col("t"), F.col("sec")), 6).alias("chars_per_sec"),
        F.round(tx.japanese_ratio(F.col("t")), 6).alias("script_ratio"),
        tx.repeated_unit(F.coalesce("t", F.lit(""))).alias("unit"),
    )


def text_normalized(spark: SparkSession, sf: str) -> DataFrame:
    """Normalised text and the steps that changed it."""
    rows = _raw(spark, sf).withColumn("n", tx.normalized(F.col("t")))
    return rows.select("sample_id", "batch_no", "loaded_us", F.col("n.text").alias("normalized"), F.array_join("n.steps", ",").alias("steps"))


def text_substituted(spark: SparkSession, sf: str) -> DataFrame:
    """Simultaneous longest-first substitution and how often each surface was met."""
    rows = _raw(spark, sf)
    found = tx.matches(F.col("t"), list(OVERRIDES))
    return rows.select("sample_id", "batch_no", "loaded_us", tx.substitute(F.col("t"), OVERRIDES).alias("out"), F.size(found).cast("long").alias("n"), F.array_join(found, ",").alias("surfaces"))


def watch_list(spark: SparkSession, sf: str) -> DataFrame:
    """Occurrences of watched terms: the greater count of raw and normalised text."""
    rows = table(spark, sf, "tts_text_samples").select("sample_id", "batch_no", F.unix_micros("loaded_at").alias("loaded_us"), F.col("text.raw_text").alias("r"), F.coalesce("text.normalized_text", F.lit("")).alias("n"))
    each = [F.struct(F.lit(s).alias("surface"), F.lit(k).alias("category"), F.greatest(tx.occurrences(F.col("r"), s), tx.occurrences(F.col("n"), s)).alias("n_found")) for s, k in WATCHED]
    return rows.select("sample_id", "batch_no", "loaded_us", F.explode(F.array(*each)).alias("x")).select("sample_id", "batch_no", "loaded_us", "x.*").where("n_found > 0")


def term_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Places of a term in every text, in characters."""
    rows = _raw(spark, sf).where(F.contains("t", F.lit("名札")))
    out = rows.select("sample_id", "batch_no", "loaded_us", F.posexplode(tx.spans(F.col("t"), "名札")).alias("at", "s"))
    return out.select("sample_id", "batch_no", "loaded_us", (F.col("at") + 1).alias("nth"), F.col("s.start").alias("start_at"), F.col("s.end").alias("end_at"))


def reading_inspection(spark: SparkSession, sf: str) -> DataFrame:
    """What a reading holds that it shouldn't: Latin, digits, kanji, other characters."""
    rows = table(spark, sf, "tts_text_samples").select("sample_id", "batch_no", F.unix_micros("loaded_at").alias("loaded_us"), F.col("text.reading_kana").alias("r")).where(F.col("r").isNotNull())
    parts = {"latin": tx.latin_runs, "digits": tx.digit_runs, "kanji": tx.kanji_runs, "other": tx.unexpected_in_reading}
    return rows.select("sample_id", "batch_no", "loaded_us", *[F.array_join(f(F.col("r")), ",").alias(k) for k, f in parts.items()], tx.valid_reading(F.col("r")).alias("valid"))


def control_characters(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with emoji or with control and format characters."""
    rows = _raw(spark, sf).select("sample_id", "batch_no", "loaded_us", F.array_join(tx.invalid_controls(F.col("t")), ",").alias("controls"), F.array_join(tx.emoji(F.col("t")), ",").alias("emoji"))
    return rows.where("controls <> '' or emoji <> ''")


def transcript_error(spark: SparkSession, sf: str) -> DataFrame:
    """Edit distance and error rate between what was to be said and what was heard, presentation aside."""
    rows = table(spark, sf, "generated_audio_qa").select("qa_id", F.unix_micros("loaded_at").alias("loaded_us"), "actual_synthesis_text", "asr_transcript")
    rows = rows.select("qa_id", "loaded_us", tx.canonical_reading(F.col("actual_synthesis_text")).alias("a"), tx.canonical_reading(F.coalesce("asr_transcript", F.lit(""))).alias("b"))
    status = tx.sequence_status(F.col("a"), F.col("b"))
    return rows.select("qa_id", "loaded_us", F.levenshtein("a", "b").alias("distance"), F.round(tx.error_rate(F.col("a"), F.col("b")), 6).alias("cer"), status.alias("status"))


def segment_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Id of each cut by its place among the cuts of the same parent, and an id prefix by data set."""
    from pyspark.sql import Window

    rows = table(spark, sf, "sample_manifest").where("lineage.parent_sample_id is not null").select("sample_id", "dataset_id", F.col("lineage.parent_sample_id").alias("p"), F.coalesce("lineage.segment_start_sec", F.lit(0.0)).alias("s")).distinct()
    nth = F.row_number().over(Window.partitionBy("p").orderBy("s", "sample_id", "dataset_id"))
    return rows.select("sample_id", "p", "s", "dataset_id", nth.alias("n")).select("sample_id", "s", tx.segment_id(F.col("p"), F.col("n")).alias("segment_id"), tx.id_prefix(F.col("dataset_id"), F.col("dataset_id")).alias("prefix"))


#: A synthesis as it may be planned; the fingerprint is that of its settings.
PLANNED = {
    "backend": "house-tts", "model_name": "custom-voice-a", "speaker": "voice-a", "synthesis_text_strategy": "normalized_text",
    "config_fingerprint_sha256": identity.fingerprint({"language": "Japanese", "model_path": "models/a", "temperature": 0.9}, without=("model_path",)),
}


def run_identities(spark: SparkSession, sf: str) -> DataFrame:
    """Seed and content address of each planned synthesis."""
    rows = table(spark, sf, "tts_text_samples").select("sample_id", "batch_no", F.col("text.normalized_text").alias("t")).distinct()
    rows = rows.withColumn("seed", identity.seed(7, F.col("sample_id")))
    planned = {c: F.lit(v) for c, v in PLANNED.items()}
    return rows.select("sample_id", "batch_no", "seed", identity.record_id("run", sample_id=F.col("sample_id"), seed=F.col("seed"), synthesis_text=F.col("t"), **planned).alias("run_id"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (text_metrics, text_normalized, text_substituted, watch_list, term_spans, reading_inspection, control_characters, transcript_error, segment_ids, run_identities)
    return {f.__name__: f for f in own}


_WS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_JA = r"\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}"


def _q(x: str) -> str:
    return x.replace("'", "''")


def _nfkc_pairs(pre: dict[str, str] | None = None) -> tuple[str, str]:
    """Single characters whose NFKC is one other character, after the dash folding (or another)."""
    import unicodedata

    pre = dict(zip(*tx.DASHES)) if pre is None else pre
    pairs = [(chr(c), unicodedata.normalize("NFKC", pre.get(chr(c), chr(c)))) for c in range(0xA0, 0x10000) if not 0xD800 <= c <= 0xDFFF and not 0xAC00 <= c <= 0xD7A3]
    pairs = [(a, b) for a, b in pairs if len(b) == 1 and a != b]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def oracle_sql() -> dict[str, str]:
    a, b = map(_q, _nfkc_pairs())
    surfaces = sorted(OVERRIDES, key=lambda s: (-len(s), s))
    marks = {s: chr(0xE000 + i) for i, s in enumerate(surfaces)}
    swap = "t"
    for s in surfaces:
        swap = f"replace({swap}, '{s}', '{marks[s]}')"
    for s in surfaces:
        swap = f"replace({swap}, '{marks[s]}', '{OVERRIDES[s]}')"
    alternatives = "|".join(surfaces)
    raw = "(select sample_id, batch_no, epoch_us(loaded_at) loaded_us, text.raw_text t from tts_text_samples)"
    width = f"nfc_normalize(translate(t, '{a}', '{b}'))"
    allowed = "".join(rf"\x{{{ord(c):X}}}" for c in tx.READING_PUNCTUATION + tx.READING_SYMBOLS)
    # NFKC by single characters, hiragana to katakana by code, then no blanks and punctuation.
    plain_a, plain_b = map(_q, _nfkc_pairs({}))
    kana = "".join(chr(c) for c in (*range(0x3041, 0x3097), 0x309D, 0x309E))

    def canonical(column: str) -> str:
        return f"regexp_replace(translate(nfc_normalize(translate({column}, '{plain_a}', '{plain_b}')), '{kana}', '{''.join(chr(ord(c) + 96) for c in kana)}'), '[{_WS[1:-1]}\\pP]', '', 'g')"

    inspect = {
        "latin": f"list_unique_ordered(r, '{tx.LATIN}')",
        "digits": r"list_unique_ordered(r, '\p{Nd}+')",
        "kanji": f"list_unique_ordered(r, '{tx.KANJI}')",
        "other": rf"list_unique_ordered(r, '[^\s\x{{0B}}\x{{1C}}-\x{{1F}}\x{{A0}}\x{{2000}}-\x{{200A}}\x{{202F}}\x{{3000}}\x{{3040}}-\x{{30FF}}\x{{31F0}}-\x{{31FF}}A-Za-zＡ-Ｚａ-ｚ\p{{Nd}}\x{{3400}}-\x{{4DBF}}\x{{4E00}}-\x{{9FFF}}\x{{F900}}-\x{{FAFF}}{allowed}]')",
    }

    def once(expression: str) -> str:
        """Ordered distinct matches, joined; written without a macro, as views are all there is."""
        text, pattern = expression[len("list_unique_ordered(") : -1].split(", ", 1)
        found = f"regexp_extract_all({text}, {pattern})"
        return f"array_to_string(list_filter({found}, lambda x, i: list_position({found}, x) = i), ',')"

    watch = " union all ".join(
        f"select sample_id, batch_no, loaded_us, '{s}' surface, '{k}' category, cast(greatest((length(r) - length(replace(r, '{s}', ''))) // {len(s)}, (length(n) - length(replace(n, '{s}', ''))) // {len(s)}) as integer) n_found from w" for s, k in WATCHED
    )
    return {
        "text_metrics": rf"""with m as (select sample_id, epoch_us(loaded_at) loaded_us, text.reference_text t, audio.duration_sec sec, regexp_replace(coalesce(text.reference_text, ''), '{_WS}+', '', 'g') c from sample_manifest),
            k as (select *, regexp_replace(coalesce(t, ''), '[{_WS[1:-1]}\pP]', '', 'g') b, regexp_replace(t, '[^\pL\pN]', '', 'g') e from m)
            select sample_id, loaded_us, cast(length(c) as integer) n_chars, case when sec > 0 then round(length(c) / sec, 6) end chars_per_sec,
              round(length(regexp_replace(e, '[^{_JA}]', '', 'g')) / nullif(length(e), 0), 6) script_ratio,
              coalesce(list_filter(list_transform(range(1, 21), lambda u: case when length(b) > 0 and length(b) % u = 0 and length(b) // u >= 3 and repeat(left(b, u), length(b) // u) = b then left(b, u) end), lambda x: x is not null)[1], '') unit from k""",
        "text_normalized": rf"""with a as (select *, {width} s1 from {raw}),
            c as (select *, array_to_string(list_transform(regexp_extract_all(s1, '[0-9,.]+|[^0-9,.]+'), lambda x: case when regexp_full_match(x, '[0-9]{{1,3}}(,[0-9]{{3}})+') then replace(x, ',', '') else x end), '') s2 from a),
            d as (select *, regexp_replace(regexp_replace(s2, '([A-Za-z0-9])ー([A-Za-z0-9])', '\1-\2', 'g'), '([A-Za-z0-9])ー([A-Za-z0-9])', '\1-\2', 'g') s3 from c),
            e as (select *, regexp_replace(regexp_replace(s3, '{_WS}+', ' ', 'g'), '^ | $', '', 'g') s4 from d)
            select sample_id, batch_no, loaded_us, nullif(s4, '') normalized, concat_ws(',', case when s1 <> t then 'jaconv_unicode_width_normalization' end, case when s2 <> s1 then 'numeric_thousands_separator_removed' end,
              case when s3 <> s2 then 'latin_hyphen_normalization' end, case when s4 <> s3 then 'whitespace_normalization' end) steps from e""",
        "text_substituted": f"select sample_id, batch_no, loaded_us, {swap} \"out\", len(regexp_extract_all(t, '{alternatives}')) n, array_to_string(regexp_extract_all(t, '{alternatives}'), ',') surfaces from {raw}",
        "watch_list": f"with w as (select sample_id, batch_no, epoch_us(loaded_at) loaded_us, text.raw_text r, coalesce(text.normalized_text, '') n from tts_text_samples), u as ({watch}) select * from u where n_found > 0",
        "term_spans": f"""with p as (select sample_id, batch_no, loaded_us, string_split(t, '名札') p from {raw} where contains(t, '名札')),
            k as (select *, unnest(range(1, len(p))) i from p)
            select sample_id, batch_no, loaded_us, cast(i as integer) nth, cast(list_sum(list_transform(p[1:i], lambda x: length(x))) + 2 * (i - 1) as integer) start_at,
              cast(list_sum(list_transform(p[1:i], lambda x: length(x))) + 2 * i as integer) end_at from k""",
        "reading_inspection": f"with r as (select sample_id, batch_no, epoch_us(loaded_at) loaded_us, text.reading_kana r from tts_text_samples where text.reading_kana is not null) select sample_id, batch_no, loaded_us, {', '.join(f'{once(v)} {k}' for k, v in inspect.items())}, regexp_matches(r, '[\\x{{30A1}}-\\x{{30FA}}]') and not regexp_matches(r, '[A-Za-z0-9Ａ-Ｚａ-ｚ０-９]') valid from r",
        "control_characters": rf"""with f as (select sample_id, batch_no, loaded_us, regexp_extract_all(t, '[\p{{Cc}}\p{{Cf}}]') c, regexp_extract_all(t, '{tx.EMOJI}') e from {raw}),
            g as (select *, list_filter(c, lambda x: not list_contains([chr(9), chr(10), chr(13), chr(8205)], x)) k from f),
            h as (select sample_id, batch_no, loaded_us, array_to_string(list_transform(list_filter(k, lambda x, i: list_position(k, x) = i), lambda x: 'U+' || lpad(hex(unicode(x)), greatest(4, length(hex(unicode(x))))::int, '0')), ',') controls,
              array_to_string(list_filter(e, lambda x, i: list_position(e, x) = i), ',') emoji from g)
            select * from h where controls <> '' or emoji <> ''""",
        "segment_ids": r"""with d as (select distinct sample_id, dataset_id, lineage.parent_sample_id p, coalesce(lineage.segment_start_sec, 0.0) s from sample_manifest where lineage.parent_sample_id is not null),
            n as (select *, cast(row_number() over (partition by p order by s, sample_id, dataset_id) as varchar) n, regexp_replace(regexp_replace(p, '[^A-Za-z0-9._-]+', '_', 'g'), '^[._-]+|[._-]+$', '', 'g') q from d),
            k as (select *, case when q = '' then 'sample' else q end stem from n)
            select sample_id, s, case when stem = p then stem else stem || '_' || left(sha256(p), 8) end || '__seg' || lpad(n, greatest(4, length(n))::int, '0') segment_id,
              upper(regexp_replace(regexp_replace(dataset_id, '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')) prefix from k""",
        "transcript_error": f"""with recursive c as materialized (select qa_id, epoch_us(loaded_at) loaded_us, {canonical("actual_synthesis_text")} a, {canonical("coalesce(asr_transcript, '')")} b, row_number() over () k from generated_audio_qa),
            d(k, j, r) as (select k, 0, cast(range(0, length(a) + 1) as integer[]) from c
              union all
              select k, j + 1, cast(list_transform(range(0, len(t)), lambda i: i + list_min(list_transform(t[1:i + 1], lambda v, n: v - n + 1))) as integer[])
              from (select d.k, d.j, list_transform(range(0, len(d.r)), lambda i: case when i = 0 then d.j + 1 else least(d.r[i + 1] + 1, d.r[i] + case when substr(c.a, i, 1) = substr(c.b, d.j + 1, 1) then 0 else 1 end) end) t from d join c using (k) where d.j < length(c.b)))
            select qa_id, loaded_us, d.r[len(d.r)] distance, round(d.r[len(d.r)] / nullif(length(a), 0), 6) cer, case when a is null then 'unresolved' when contains(b, a) then 'observed' else 'not_observed' end status
            from c join d using (k) where d.j = length(c.b)""",
        "run_identities": """with d as (select distinct sample_id, batch_no, text.normalized_text t, cast((cast(('0x' || left(sha256(sample_id), 16)) as ubigint)::hugeint + 7) % 2147483647 as bigint) seed from tts_text_samples)
            select sample_id, batch_no, seed, sha256('{"backend":"house-tts","config_fingerprint_sha256":"' || sha256('{"language":"Japanese","temperature":0.9}') || '","model_name":"custom-voice-a","sample_id":' || to_json(sample_id) || ',"seed":' || seed
              || ',"speaker":"voice-a","synthesis_text":' || coalesce(cast(to_json(t) as varchar), 'null') || ',"synthesis_text_strategy":"normalized_text"}') run_id from d""",
    }
