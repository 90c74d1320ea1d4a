"""Queries on look-alike texts and hidden copies."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from ..plans.staging import Stage
from . import copies, history, lookalike


def _fields(spark: SparkSession, sf: str) -> DataFrame:
    """(field_name, id, text) of the three fields that hold same-looking texts."""
    tts = table(spark, sf, "tts_text_samples").select(
        F.col("sample_id").alias("id"),
        F.explode(
            F.array(
                F.struct(F.lit("raw_text").alias("field_name"), F.col("text.raw_text").alias("text")),
                F.struct(F.lit("normalized_text").alias("field_name"), F.col("text.normalized_text").alias("text")),
            )
        ).alias("x"),
    )
    qa = table(spark, sf, "generated_audio_qa").select(F.lit("asr_transcript").alias("field_name"), F.col("qa_id").alias("id"), F.col("asr_transcript").alias("text"))
    return tts.select("x.field_name", "id", "x.text").unionByName(qa).where(F.col("text").isNotNull())


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Records whose text looks like the text of the record with the smallest id but is made of other characters."""
    return lookalike.differing_members(_fields(spark, sf), "id", "text", ("field_name",))


def p1_canonical(spark: SparkSession, sf: str) -> DataFrame:
    """Every text of the three fields in the canonical spelling of its class."""
    return lookalike.canonical_texts(_fields(spark, sf), "id", "text", ("field_name",))


MANIFEST_FIELDS = ("raw_text", "normalized_text", "reading_kana")


def _ledger(spark: SparkSession, sf: str) -> copies.CopyLedger:
    """The three tables counted batch by batch; tables without a batch number arrive with the first batch."""
    stage = Stage(spark, "copies")
    tts = table(spark, sf, "tts_text_samples").select(F.lit("tts_text_samples").alias("space"), F.col("sample_id").alias("id"), F.coalesce("batch_no", F.lit(1)).alias("batch"), copies.text_key("text.raw_text").alias("k"))
    cases = table(spark, sf, "japanese_text_frontend_regression").select(F.lit("japanese_text_frontend_regression").alias("space"), F.col("case_id").alias("id"), F.lit(1).alias("batch"), copies.text_key("raw_text").alias("k"))
    lines = table(spark, sf, "raw_manifest_lines").select(F.lit("raw_manifest_lines").alias("space"), F.col("line_id").alias("id"), F.lit(1).alias("batch"), copies.json_key(F.col("line"), MANIFEST_FIELDS).alias("k"))
    keyed = tts.unionByName(cases).unionByName(lines).select("space", "id", "batch", "k.k1", "k.k2")
    staged = stage.write(keyed, "keyed", "batch")
    ledger = copies.CopyLedger(spark, stage)
    numbers = sorted(r["batch"] for r in staged.select("batch").distinct().collect())  # one row per batch ever delivered
    for number in numbers:
        ledger.add(staged.where(F.col("batch") == number).drop("batch"))
    return ledger


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Each copy of a record that differs only in spacing, case, punctuation or order of fields."""
    return copies.copies_of(_ledger(spark, sf)).select(F.col("space").alias("table_name"), "first_id", "copy_id")


def p3_groups(spark: SparkSession, sf: str) -> DataFrame:
    """One record per group with its number of copies."""
    return copies.groups_of(_ledger(spark, sf)).select(F.col("space").alias("table_name"), "first_id", "n_copies")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """Records turned away, batch by batch, with the accepted record each repeats."""
    stage = Stage(spark, "history")
    rows = table(spark, sf, "tts_text_samples").select("sample_id", "batch_no", "text.raw_text")
    records = history.first_deliveries(rows, "sample_id", "batch_no", "raw_text")
    keyed = stage.write(records.select("id", "batch", history.bare_key("text").alias("k")).select("id", "batch", "k.*"), "keyed", "batch")
    accepted = history.AcceptedHistory(spark, stage)
    for number in sorted((r["batch"] for r in keyed.select("batch").distinct().collect()), key=lambda x: (x is None, x)):  # one row per batch
        accepted.add(keyed.where(F.col("batch").eqNullSafe(number)).drop("batch"))
    return accepted.turned_away().select(F.least("id", "accepted_id").alias("sample_id_a"), F.greatest("id", "accepted_id").alias("sample_id_b"))


def _sql(x: str) -> str:
    return x.replace("'", "''")


# The SQL states the form on its own, by character classes, ranges and lists, and shares no mapping with the operators.
# Letters of one shape, column by column.
_LATIN = "ABEHIKMNOPTXYZCSJaceopxyisjhv"
_GREEK = "ΑΒΕΗΙΚΜΝΟΡΤΧΥΖϹ\0Ϳαϲ\0ορ\0\0\0\0ϳ\0ν"
_CYRILLIC = "АВЕНІКМ\0ОРТХУ\0СЅЈасеорхуіѕјһѵ"
_KANA, _KANJI = "カエニロタトハムノへべぺ", "力工二口夕卜八厶丿ヘベペ"
_MORE_FROM, _MORE_TO = "ӀҮԁԛԝӏԌԚԜГПФѡ", "IYdqwlGQWΓΠΦω"
_NARROW = "｡｢｣､･ｦｧｨｩｪｫｬｭｮｯｰｱｲｳｴｵｶｷｸｹｺｻｼｽｾｿﾀﾁﾂﾃﾄﾅﾆﾇﾈﾉﾊﾋﾌﾍﾎﾏﾐﾑﾒﾓﾔﾕﾖﾗﾘﾙﾚﾛﾜﾝﾞﾟ"
_WIDE = "。「」、・ヲァィゥェォャュョッーアイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワン゙゚"


def _mapping_sql() -> tuple[str, str]:
    pairs = dict(zip(_NARROW, _WIDE)) | {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)} | {"゛": "゙", "゜": "゚"}
    pairs |= {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in range(0x2E80, 0x2FE0) if unicodedata.name(chr(c), "").startswith(("CJK RADICAL", "KANGXI RADICAL"))}
    pairs |= dict(zip("￠￡￢￣￤￥￦￨￩￪￫￬￭￮", "¢£¬¯¦¥₩│←↑→↓■○"))
    alike = {c: a for own in (_GREEK, _CYRILLIC) for a, c in zip(_LATIN, own) if c != "\0"} | dict(zip(_KANJI, _KANA)) | dict(zip(_MORE_FROM, _MORE_TO))
    pairs = {a: alike.get(b, b) for a, b in pairs.items() if a != b} | alike
    return "".join(pairs), "".join(pairs.values())


def looks_same_oracle(column: str) -> str:
    a, b = map(_sql, _mapping_sql())
    unseen = r"[\p{Cf}\x{034F}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180F}\x{3164}\x{FFA0}\x{FE00}-\x{FE0F}\x{E0100}-\x{E01EF}\x{01}-\x{08}\x{0E}-\x{1B}\x{7F}-\x{84}\x{86}-\x{9F}]"
    return f"nfc_normalize(translate(regexp_replace(regexp_replace(nfc_normalize({column}), '{unseen}', '', 'g'), '\\p{{Zs}}', ' ', 'g'), '{a}', '{b}'))"


_FIELDS_SQL = """
      select distinct 'raw_text' field_name, sample_id id, text.raw_text txt from tts_text_samples where text.raw_text is not null
      union all select distinct 'normalized_text', sample_id, text.normalized_text from tts_text_samples where text.normalized_text is not null
      union all select distinct 'asr_transcript', qa_id, asr_transcript from generated_audio_qa where asr_transcript is not null"""


def bare_oracle(column: str) -> str:
    return f"regexp_replace(lower({looks_same_oracle(column)}), '[\\s\\pP\\x{{0B}}\\x{{1C}}-\\x{{1F}}\\x{{85}}\\x{{2028}}\\x{{2029}}]', '', 'g')"


def _copies_sql() -> str:
    lines = ", ".join(f"coalesce({bare_oracle(f'json_extract_string(line, {chr(39)}$.{f}{chr(39)})')}, chr(1))" for f in MANIFEST_FIELDS)
    return f"""
      select distinct 'tts_text_samples' table_name, sample_id id, {bare_oracle("text.raw_text")} k from tts_text_samples where text.raw_text is not null
      union all select distinct 'japanese_text_frontend_regression', case_id, {bare_oracle("raw_text")} from japanese_text_frontend_regression where raw_text is not null
      union all select 'raw_manifest_lines', line_id, concat_ws(chr(2), {lines}) from raw_manifest_lines where json_valid(line)"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p1_found": p1_found, "p1_canonical": p1_canonical, "p3_found": p3_found, "p3_groups": p3_groups, "p4_found": p4_found}


def oracle_sql() -> dict[str, str]:
    forms = f"with f as ({_FIELDS_SQL}), k as (select *, {looks_same_oracle('txt')} form from f)"
    groups = f"with r as materialized ({_copies_sql()}), g as (select table_name, k, min(id) first_id, count(*) n_copies from r group by all)"
    return {
        "p4_found": f"""with recursive r as materialized (select sample_id id, min(batch_no) b, {bare_oracle("arg_min(text.raw_text, batch_no)")} f from tts_text_samples where text.raw_text is not null group by sample_id),
            n as materialized (select f, row_number() over (order by min({{'b': b, 'i': id}})) o, min({{'b': b, 'i': id}}).i id from r group by f),
            g as materialized (select o, f[k:k + 2] g from (select distinct o, f, unnest(range(1, length(f) - 1)) k from n where length(f) >= {history.MIN_CHARS}) group by all),
            z as materialized (select o, count(*) z from g group by o),
            p as materialized (select a, b, s from (select x.o a, y.o b, count(*) ib from g x join g y on x.g = y.g and x.o < y.o group by all) join z u on u.o = a join z v on v.o = b, (select ib / (u.z + v.z - ib) s) where s >= {history.SIMILARITY}),
            t(o, s) using key (o) as (
              select b, 0 from p group by b union select a, 1 from p where a not in (select b from p) group by a
              union
              select c.o, case when max(cast(e.s = 1 as int)) = 1 then 2 else 1 end from recurring.t c join p on p.b = c.o join recurring.t e on e.o = p.a where c.s = 0 and exists (select 1 from t) group by c.o having max(cast(e.s = 1 as int)) = 1 or min(e.s) = 2),
            m as (select b o, arg_min(w.id, (-p.s, w.id)) target from p join t c on c.o = p.b and c.s = 2 join t e on e.o = p.a and e.s = 1 join n w on w.o = p.a group by b)
            select least(r.id, coalesce(m.target, n.id)) sample_id_a, greatest(r.id, coalesce(m.target, n.id)) sample_id_b from r join n using (f) left join m using (o) where r.id <> coalesce(m.target, n.id)""",
        "p3_found": f"{groups} select table_name, first_id, id copy_id from r join g using (table_name, k) where id <> first_id",
        "p3_groups": f"{groups} select table_name, first_id, n_copies from g",
        "p1_found": f"""{forms}, g as (select field_name, form, arg_min(txt, id) first_txt, min(id) first_id from k group by field_name, form)
            select k.field_name, g.first_id, k.id other_id from k join g using (field_name, form) where k.txt <> g.first_txt""",
        "p1_canonical": f"""{forms}, m as (select *, nfc_normalize(txt) <> form changed from k),
            g as (select field_name, form, coalesce(min(txt) filter (where not changed), min(txt)) canonical_text from m group by field_name, form)
            select k.field_name, k.id, g.canonical_text from k join g using (field_name, form)""",
    }
