"""Per-document text quality: statistics in codegen, and the kind of text by a hidden Markov model over its lines.

``statistics`` computes word count, mean word length, symbol ratio, share of lines ending in punctuation and share of
common words with built-in functions. ``line_kinds`` labels every line prose, list, table or junk by the model
of ``linemodel``, aggregates the shares per document and takes the kind that has most lines; a text that shows nothing is junk. Both
read the text once and shuffle nothing.

The model is fitted on labelled documents chosen by a hash of their ids, at most ``max_labelled`` of at most ``max_chars`` characters
together; everything else covers all documents whole.

Cases: a null text has no statistics and no kind; a text without visible characters has no lines and is junk; without
labels the definitions of table and list alone decide and no other text is junk; repeated rows are
repeated; an empty table gives no rows; lines of any length are handled whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .linemodel import KINDS, LineModel, folded, kind_by_rule, lines_of

MAX_LABELLED = 5_000
MAX_LABELLED_CHARS = 12_000_000
#: Common words that may become part of the plan.
IN_PLAN = 20_000
#: Runs of one script count as words, so that scripts without blanks have words too.
WORD = r"[\p{IsHan}々]+|\p{IsHiragana}+|[\p{IsKatakana}ー]+|\p{IsLatin}+|[\p{IsGreek}\p{IsCyrillic}]+|[0-9]+"
SYMBOL = r"[^\p{L}\p{M}\p{N}\p{P}\p{Z}\p{C}]"
BREAK = r"\r\n|\n|\r"


def statistics(documents: DataFrame, common: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, mean_word_length, symbol_ratio, punctuation_line_share, common_word_share).

    ``common`` (word) is a list of function words. A counted list of at most ``IN_PLAN`` words becomes a hash set of the plan; a
    longer one is joined, by shuffle or by broadcast as its size asks for, with the distinct words of each document.
    """
    wanted = common.select(F.lower("word").alias("word")).where("word is not null").distinct()
    listed = sorted(r[0] for r in wanted.limit(IN_PLAN + 1).collect())
    words = F.regexp_extract_all(F.col("t"), F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(F.col("t"), BREAK), lambda x: x.rlike(r"[^\p{Z}\t]"))
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.lower(F.col(text)).alias("t")).where(F.col("t").isNotNull())
    rows = rows.select("doc_id", F.length("t").alias("n"), words.alias("w"), lines.alias("l"), F.regexp_count("t", F.lit(SYMBOL)).alias("s"))
    if len(listed) > IN_PLAN:
        rows = _with_hits(rows, wanted)
    else:
        rows = rows.withColumn("hits", F.size(F.filter("w", lambda x: x.isin(*listed))) if listed else F.lit(0))
    n_words, n_lines = F.size("w"), F.size("l")
    letters = F.length(F.array_join("w", ""))
    ends = F.size(F.filter("l", lambda x: x.rlike(r"\p{P}[\p{Z}\t]*\z")))
    share = lambda a, b: F.round(F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0)), 6)
    return rows.select(
        "doc_id",
        n_words.cast("long").alias("n_words"),
        share(letters, n_words).alias("mean_word_length"),
        share(F.col("s"), F.col("n")).alias("symbol_ratio"),
        share(ends, n_lines).alias("punctuation_line_share"),
        share(F.col("hits"), n_words).alias("common_word_share"),
    )


def _with_hits(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Adds ``hits``, the number of words of each row that are wanted; rows are told apart by a number of their own."""
    keyed = rows.withColumn("row", F.xxhash64("doc_id", F.concat_ws(" ", "w"), "n", "s", F.concat_ws("\n", "l")))
    words = keyed.select("row", F.explode("w").alias("word")).groupBy("row", "word").agg(F.count("*").alias("c"))
    repeated = keyed.groupBy("row").agg(F.count("*").alias("copies"))
    hits = words.join(wanted, "word").groupBy("row").agg(F.sum("c").alias("all_hits")).join(repeated, "row")
    return keyed.join(hits, "row", "left").withColumn("hits", F.coalesce(F.col("all_hits") / F.col("copies"), F.lit(0.0)).cast("int")).drop("row", "all_hits", "copies")


def fit(
    documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "label", max_labelled: int = MAX_LABELLED, max_chars: int = MAX_LABELLED_CHARS
) -> LineModel:
    """The line model of a bounded sample of labelled documents, the same whatever the order of rows: the first by a hash of their ids,
    as many as ``max_labelled`` documents and ``max_chars`` characters hold."""
    chosen = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isin(*KINDS))
    chosen = chosen.groupBy("doc_id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    texts = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(F.col("text").isNotNull() & (F.length("text") <= max_chars))
    rows = texts.join(F.broadcast(chosen), "doc_id")  # at most max_labelled ids are broadcast
    rows = rows.withColumn("size", F.sum(F.length("text")).over(Window.orderBy(F.xxhash64("doc_id"), "doc_id", "text")))  # as many rows, in one task
    taken = rows.where(F.col("size") <= max_chars).select("doc_id", "text", "label").collect()
    return LineModel.fit([(r["text"], r["label"]) for r in sorted(taken, key=lambda r: (r["doc_id"], r["text"]))])


def _label(model: LineModel):
    schema = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int32()), *[(f"{k}_share", pa.float64()) for k in KINDS], ("kind", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                yield one(batch.slice(at, 2000))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        docs = [lines_of(folded(t)) for t in batch.column(1).to_pylist()]
        sizes = np.array([len(x) for x in docs], dtype=np.int64)
        lines = [x for own in docs for x in own]
        begins = np.cumsum(sizes) - sizes
        first = np.zeros(len(lines), dtype=bool)
        first[begins[sizes > 0]] = True
        states = model.viterbi(model.symbols(lines, first), sizes) if lines else np.zeros(0, dtype=np.int64)
        counts = np.zeros((len(docs), 4))
        np.add.at(counts, (np.repeat(np.arange(len(docs)), sizes), states), 1)
        shares = counts / np.maximum(sizes, 1)[:, None]
        if model.fitted:
            kinds = [KINDS[k] if n else "junk" for k, n in zip(shares.argmax(axis=1).tolist(), sizes.tolist())]
        else:
            kinds = [(kind_by_rule(own) or "prose") if own else "junk" for own in docs]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes.astype(np.int32)), *[pa.array(np.round(shares[:, k], 6)) for k in range(4)], pa.array(kinds)], schema=schema
        )

    return run


def line_kinds(documents: DataFrame, model: LineModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_lines, prose_share, list_share, table_share, junk_share, kind) of every text."""
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    return rows.mapInArrow(_label(model), "doc_id long, n_lines int, prose_share double, list_share double, table_share double, junk_share double, kind string")
