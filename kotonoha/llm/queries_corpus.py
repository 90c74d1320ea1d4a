"""Queries on leaked evaluation texts and on text quality."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from . import leakage, quality
from .queries_text import bare_oracle


def _spans(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.leaked_spans(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with the evaluation items of which they contain a run of 50 characters."""
    return leakage.affected(_spans(spark, sf))


def p7_spans(spark: SparkSession, sf: str) -> DataFrame:
    """The spans to remove, in characters of the bare form."""
    return _spans(spark, sf)


def _kinds(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    return quality.line_kinds(documents, quality.fit(documents, table(spark, sf, "doc_labels")))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that aren't prose, with their kind."""
    return _kinds(spark, sf).where("kind <> 'prose'").select("doc_id", "kind")


def p8_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Shares of prose, list, table and junk lines of every document, and its kind."""
    return _kinds(spark, sf)


def p8_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Number of non-blank lines of every document and the sum of the shares of its kinds of line."""
    total = F.col("prose_share") + F.col("list_share") + F.col("table_share") + F.col("junk_share")
    return _kinds(spark, sf).select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.round(total, 3).alias("share_sum"))


def p8_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Word, symbol and line statistics of every document."""
    return quality.statistics(table(spark, sf, "documents"), table(spark, sf, "common_words"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p7_found": p7_found, "p7_spans": p7_spans, "p8_found": p8_found, "p8_shares": p8_shares, "p8_lines": p8_lines, "p8_stats": p8_stats}


def oracle_sql() -> dict[str, str]:
    grams = "select {key}, unnest(list_transform(range(1, length(b) - 48), lambda i: substr(b, i, 50))) g from (select {key}, {bare} b from {name} where text is not null) where length(b) >= 50"
    word = r"[\p{Han}々]+|\p{Hiragana}+|[\p{Katakana}ー]+|\p{Latin}+|[\p{Greek}\p{Cyrillic}]+|[0-9]+"
    return {
        "p8_lines": r"""with l as (select doc_id, len(list_filter(regexp_split_to_array(text, '\r\n|\n|\r'), lambda x: regexp_matches(x, '[^\s\pZ\p{Cf}\p{Cc}\x{034F}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180F}\x{3164}\x{FFA0}\x{FE00}-\x{FE0F}\x{E0100}-\x{E01EF}]'))) n from documents where text is not null)
            select doc_id, n n_lines, cast(n > 0 as double) share_sum from l""",
        "p7_spans": f"""with i as materialized (select distinct * from ({grams.format(key="item_id", bare=bare_oracle("text"), name="eval_items")})),
            d as (select doc_id, unnest(range(1, length(b) - 48)) p, unnest(list_transform(range(1, length(b) - 48), lambda i: substr(b, i, 50))) g from (select doc_id, {bare_oracle("text")} b from documents where text is not null) where length(b) >= 50),
            m as (select doc_id, item_id, p, case when p > lag(p) over (partition by doc_id, item_id order by p) + 50 then 1 else 0 end apart from d join i using (g)),
            s as (select *, sum(apart) over (partition by doc_id, item_id order by p) island from m)
            select doc_id, item_id, min(p) - 1 as start, max(p) + 49 as "end" from s group by doc_id, item_id, island""",
        "p8_stats": f"""with t as (select doc_id, lower(text) t from documents where text is not null),
            w as (select doc_id, length(t) n, regexp_extract_all(t, '{word}') w, len(regexp_extract_all(t, '[^\\pL\\pM\\pN\\pP\\pZ\\pC]')) s,
              list_filter(regexp_split_to_array(t, '\\r\\n|\\n|\\r'), lambda x: regexp_matches(x, '[^\\pZ\\t]')) l from t),
            c as (select list(distinct lower(word)) c from common_words)
            select doc_id, len(w) n_words, round(coalesce(length(array_to_string(w, '')) / nullif(len(w), 0), 0), 6) mean_word_length,
              round(coalesce(s / nullif(n, 0), 0), 6) symbol_ratio,
              round(coalesce(len(list_filter(l, lambda x: regexp_matches(x, '\\pP[\\pZ\\t]*\\z'))) / nullif(len(l), 0), 0), 6) punctuation_line_share,
              round(coalesce(len(list_filter(w, lambda x: list_contains(c, x))) / nullif(len(w), 0), 0), 6) common_word_share
            from w, c""",
        "p7_found": f"""with i as materialized (select distinct * from ({grams.format(key="item_id", bare=bare_oracle("text"), name="eval_items")})),
            d as ({grams.format(key="doc_id", bare=bare_oracle("text"), name="documents")})
            select distinct doc_id, item_id from d join i using (g)""",
    }
