import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kotonoha.functions import identity, ids, sets
from kotonoha.functions import text as tx

ALPHABET = "aAzZ09 ー,.-\t\n　 \x1cア゛カｶﾞガか゛がé éＡＢ漢字力夕😊​‍﻿。、!­٣"
texts = st.lists(st.text(alphabet=ALPHABET, max_size=24), min_size=1, max_size=40)


def column(spark, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r["x"] for r in rows.select("i", expression(F.col("t")).alias("x")).orderBy("i").collect()]


def unit(text, least=3, most=20):
    own = "".join(c for c in text if not c.isspace() and unicodedata.category(c)[0] != "P")
    for n in range(1, min(most, len(own) // least) + 1):
        if len(own) % n == 0 and own[:n] * (len(own) // n) == own:
            return own[:n]
    return ""


def ungrouped(text):
    """Each run of digits, commas and points is looked at as a whole."""
    out, run = [], ""
    for ch in text + "\0":
        if ch in "0123456789,.":
            run += ch
            continue
        head, *groups = run.split(",")
        proper = groups and all(len(g) == 3 and g.isdigit() for g in groups) and 1 <= len(head) <= 3 and head.isdigit()
        out += ["".join([head, *groups]) if proper else run, ch]
        run = ""
    return "".join(out)[:-1]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts)
def test_expressions_agree_with_plain_definitions(spark, values):
    values = [*values, "", None, "アアア", "ab ab ab", "12,345,678と1,23と1,234.5"]
    known = [v for v in values if v is not None]
    assert column(spark, known, tx.compact) == ["".join(c for c in v if not c.isspace()) for v in known]
    assert column(spark, known, tx.strip) == [v.strip() for v in known]
    assert column(spark, known, tx.repeated_unit) == [unit(v) for v in known]
    assert column(spark, known, tx.collapse_space) == [re.sub(r"\s+", " ", v).strip() for v in known]
    assert column(spark, values, tx.without_thousands) == [None if v is None else ungrouped(v) for v in values]
    assert column(spark, known, tx.latin_hyphen) == [re.sub("(?<=[A-Za-z0-9])ー(?=[A-Za-z0-9])", "-", v) for v in known]
    swap = {"カ": "か", "ア": "カ", "アー": "x", "9 ": "[9]"}
    pattern = re.compile("|".join(map(re.escape, sorted(swap, key=len, reverse=True))))
    assert column(spark, values, lambda t: tx.substitute(t, swap)) == [None if v is None else pattern.sub(lambda m: swap[m.group(0)], v) for v in values]
    assert column(spark, known, lambda t: tx.spans(t, "ア")) == [[(m.start(), m.end()) for m in re.finditer("ア", v)] for v in known]
    assert column(spark, known, lambda t: tx.occurrences(t, "ア")) == [v.count("ア") for v in known]


WIDTH, THOUSANDS, HYPHEN, BLANKS = (name for name, _ in tx.NORMALIZATION)


@pytest.mark.parametrize(
    "raw, text, steps",
    [
        ("会費は９，８７６円", "会費は9876円", [WIDTH, THOUSANDS]),
        ("人口4,321,000", "人口4321000", [THOUSANDS]),
        ("Ｘ－ｒａｙ室", "X-ray室", [WIDTH, HYPHEN]),
        ("2ー3ーB ーC", "2-3-B ーC", [HYPHEN]),
        ("ﾊﾞｽﾃｲ", "バステイ", [WIDTH]),
        ("9,87 Q,R 5,432.1 1,2,345 ,123", "9,87 Q,R 5,432.1 1,2,345 ,123", []),
        ("\t朝 \n 夕 ", "朝 夕", [BLANKS]),
        ("\u3000", None, [WIDTH, BLANKS]),
    ],
)
def test_normalisation_and_its_log(spark, raw, text, steps):
    row = column(spark, [raw], tx.normalized)[0]
    assert (row["text"], row["steps"]) == (text, steps)


def test_scripts_controls_and_readings(spark):
    assert column(spark, ["日本語abc", "123", "!?", ""], tx.japanese_ratio) == [0.5, 0.0, None, None]
    assert column(spark, ["A​B‍\x07​"], tx.invalid_controls) == [["U+200B", "U+0007"]]
    assert column(spark, ["😊x☀😊"], tx.emoji) == [["😊", "☀"]]
    assert column(spark, ["カナ", "かな", "カナA", "カナ１"], tx.valid_reading) == [True, False, False, False]
    assert column(spark, ["カナ漢字AB12、♪"], tx.unexpected_in_reading) == [["♪"]]
    assert column(spark, ["きょう、 は。", "ｷｮｳ ﾊ"], tx.canonical_reading) == ["キョウハ", "キョウハ"]
    assert column(spark, ["キョー", "キヨ", ""], lambda t: tx.error_rate(t, F.lit("キヨ"))) == [2 / 3, 0.0, None]
    assert column(spark, ["a b/c", "__", "ok"], lambda t: tx.segment_id(t, F.lit(3)))[2] == "ok__seg0003"
    assert column(spark, ["my set!", "日本"], lambda t: tx.id_prefix(t, t))[0] == "MY_SET"


def test_identity_matches_plain_hashes(spark):
    import hashlib
    import json

    values = ["a", "日本", 'q"\\', None]
    got = column(spark, values, lambda t: identity.content_id({"z": t, "a": F.lit(1), "n": F.lit(None).cast("string")}))
    assert got == [hashlib.sha256(json.dumps({"a": 1, "n": None, "z": v}, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest() for v in values]
    seeds = column(spark, ["a", "日本"], lambda t: identity.seed(7, t))
    assert seeds == [(7 + int.from_bytes(hashlib.sha256(v.encode()).digest()[:8], "big")) % 2147483647 for v in ("a", "日本")]
    assert identity.fingerprint({"b": 1, "a": 2, "path": "x"}, without=("path",)) == identity.fingerprint({"a": 2, "b": 1})


def test_ids_and_sets(spark):
    assert column(spark, [" ＡＢc1　", "x", "　", None, "ｶﾞ"], ids.compare_form) == ["abc1", "x", "", None, "ガ"]
    row = spark.sql("select array('a','b','a') x, array('b','c') y")
    got = row.select(sets.ordered_distinct("x").alias("d"), sets.missing_from(F.col("x"), F.col("y")).alias("m"), sets.is_subset(F.col("y"), F.col("x")).alias("s"), sets.same_set(F.col("x"), F.array(F.lit("b"), F.lit("a"))).alias("e"), sets.add_once(F.col("y"), F.lit("c")).alias("o")).first()
    assert (got["d"], got["m"], got["s"], got["e"], got["o"]) == (["a", "b"], ["a"], False, True, ["b", "c"])
