import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kotonoha.llm import forms, lookalike


def classes(spark, texts):
    """Pairs (first, other) of positions that the operator puts together."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    return {(r["first_id"], r["other_id"]) for r in lookalike.differing_members(df, "id").collect()}


def plain(texts):
    first, out = {}, set()
    for i, t in enumerate(texts):
        j = first.setdefault(forms.looks_same(t), i)
        if texts[j] != t:
            out.add((j, i))
    return out


def assigned():
    return [c for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF and unicodedata.category(chr(c)) not in ("Cn", "Co")]


def test_every_character_composed_and_separate(spark):
    texts = []
    for c in assigned():
        ch = chr(c)
        texts += [f"n{ch}n"]
        for other in (unicodedata.normalize("NFD", ch), unicodedata.normalize("NFC", ch)):
            if other != ch:
                texts.append(f"n{other}n")
    assert classes(spark, texts) == plain(texts)


def test_every_mark_on_letters_of_several_scripts(spark):
    marks = [chr(c) for c in assigned() if unicodedata.category(chr(c))[0] == "M"]
    texts = [b + m for b in "aAかדकHΗyу" for m in marks] + ["a", "か", "A"]
    assert classes(spark, texts) == plain(texts)


PARTS = ["a", "é", "é", "̣", "́", "̧", "ậ", "か", "゙", "が", "‍", "가", "ᄀ", "ᅡ", "각", "ᆨ", "שׁ", "ש", "ׁ", "ּ", "𑂚", "𑂙", "𑂺", "ᬆ", "ᬅ", "ᬵ", "Ή", "Η", "H", "α", "ά", "ｶ", "ﾞ", "゛", "̈́", "̈", "क़", "क", "़", "①", "1", "１", "٣", "3"]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=5).map("".join), min_size=30, max_size=200))
def test_mixtures_of_marks_and_letters(spark, texts):
    assert classes(spark, texts) == plain(texts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(), st.lists(st.sampled_from(PARTS)).map("".join))))
def test_forms_of_batches_are_those_of_single_texts(texts):
    assert forms.bare_batch(texts) == [forms.bare_form(t) for t in texts]


def test_oddness_is_the_same_for_all_texts_of_a_class(spark):
    texts = ["é", "é", "ậ", "ậ", "ậ", "가", "가", "Ή", "H́", "が", "が"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string")
    odd = [r[0] for r in df.orderBy("id").select(forms.odd(forms.looks_same_sql(F.col("t")))).collect()]
    assert odd == [False, False, True, True, True, True, True, True, True, False, False]


def test_looks_same():
    same = [("ｶﾞｰﾄﾞ", "ガード"), ("Café", "Café"), ("⼭", "山"), ("a​b", "ab"), ("a　b", "a b"), ("Рaу", "Pay"), ("ニ", "二"), ("へや", "ヘや")]
    other = [("a b", "ab"), ("A", "a"), ("a.", "a"), ("か", "カ"), ("a\tb", "a b"), ("e", "é")]
    for a, b in same:
        assert forms.looks_same(a) == forms.looks_same(b), (a, b)
    for a, b in other:
        assert forms.looks_same(a) != forms.looks_same(b), (a, b)
    assert forms.bare_form("Ａ、 Ｂ。") == "ab"
