"""Filling fixed-capacity containers with items by hierarchical residual packing.

Items larger than a container are cut into full pieces and one remainder; nothing else is ever cut. Full pieces are
containers at once. The other items are packed best-fit, largest first, within their partition; bins that are
nearly full are closed, the underfull ones travel on as items of the next round, merged with those of other
partitions. A round's partitions hold at most ``per_task`` bins, so no task receives more however many bins stay
open. Rounds end when everything is in one partition or a round brings next to nothing. Only ids and sizes move.

Container ids are ``<id>-<piece>`` of the container's smallest member, so they don't depend on task order.

Cases: a null text has no size and no container; a text without tokens needs no room and gets none; an item of
exactly the capacity fills one container; repeated rows of an id are one item of the largest size given; ids that
are null are ignored; an empty table gives no containers; other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.staging import Stage

#: Public splitting pattern of the byte-level tokenizers (a fixed value).
BYTE_BPE_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""

_MEMBER = T.StructType([T.StructField("id", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("size", T.IntegerType())])
_BIN = T.StructType([T.StructField("used", T.IntegerType()), T.StructField("members", T.ArrayType(_MEMBER)), T.StructField("low_id", T.LongType()), T.StructField("low_piece", T.IntegerType())])


def byte_tokens(text: Column) -> Column:
    """Tokens of a tokenizer with one token per UTF-8 byte."""
    return F.octet_length(text).cast("long")


@functools.cache
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def bpe_tokens(text: Column, path: str, pattern: str = BYTE_BPE_PATTERN) -> Column:
    """Tokens by the byte-level BPE ranks in the file at ``path``, which every worker must be able to read."""

    @F.pandas_udf(T.LongType())
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            own = _encoding(path, pattern)
            yield pd.Series([None if not isinstance(t, str) else len(own.encode_ordinary(t)) for t in batch], dtype="Int64")

    return count(text)


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices, best-fit decreasing. The open bins are kept by free room; a bit mask finds the tightest."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for i in order:
        size = sizes[i]
        fitting = mask >> size
        if fitting:
            room = (fitting & -fitting).bit_length() - 1 + size
            b = by_room[room].pop()
            if not by_room[room]:
                mask &= ~(1 << room)
            bins[b].append(i)
            left = room - size
        else:
            b = len(bins)
            bins.append([i])
            left = capacity - size
        if left:
            by_room[left].append(b)
            mask |= 1 << left
    return bins


def _pack_batches(capacity: int, per_task: int):
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[int, list]] = []

        def flush() -> pd.DataFrame:
            out = []
            for own in best_fit([u for u, _ in held], capacity):
                members = [m for i in own for m in held[i][1]]
                low = min((m["id"], m["piece"]) for m in members)
                out.append((sum(held[i][0] for i in own), members, *low))
            held.clear()
            return pd.DataFrame(out, columns=_BIN.names)

        for batch in batches:
            held.extend(zip(batch["used"].tolist(), [list(m) for m in batch["members"]]))
            if len(held) >= per_task:
                yield flush()
        if held:
            yield flush()

    return pack


def pack(
    items: DataFrame, id_column: str, size_column: str, capacity: int, *, nearly_full: float = 0.98, per_task: int = 50_000, stage: Stage | None = None
) -> DataFrame:
    """(container_id, id, piece_no, start, n_tokens): every item or piece with its container."""
    spark: SparkSession = items.sparkSession
    stage = stage or Stage(spark, "packing")
    sized = items.where(F.col(id_column).isNotNull() & (F.col(size_column) > 0))
    sized = sized.groupBy(F.col(id_column).cast("long").alias("id")).agg(F.max(F.col(size_column).cast("long")).alias("n"))
    pieces = sized.select("id", "n", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / capacity).cast("int"))).alias("piece"))
    pieces = stage.write(pieces.select("id", "piece", F.least(F.lit(capacity), F.col("n") - F.col("piece") * F.lit(capacity)).cast("int").alias("size")), "pieces")
    full = pieces.where(F.col("size") == capacity)
    rest = pieces.where(F.col("size") < capacity)
    open_bins = rest.select(F.col("size").alias("used"), F.array(F.struct("id", "piece", "size")).alias("members"))
    limit = int(capacity * nearly_full)
    closed, last, parts = [], None, None
    while True:
        packed = stage.write(open_bins.mapInPandas(_pack_batches(capacity, per_task), _BIN), "bins")
        counted = packed.agg(F.count("*"), F.count(F.when(F.col("used") < limit, 1)), F.sum("used")).first()
        n_open = counted[1]
        if parts == 1 or n_open <= 1 or last is not None and n_open > 0.98 * last:
            closed.append(packed)
            break
        closed.append(packed.where(F.col("used") >= limit))
        last, parts = n_open, max(1, math.ceil(n_open / per_task))
        if parts > 1:
            parts = max(parts, math.ceil(2 * n_open / per_task))
        open_bins = packed.where(F.col("used") < limit).repartition(parts, "low_id", "low_piece").select("used", "members")
    member = [F.concat_ws("-", "low_id", "low_piece").alias("container_id"), F.explode("members").alias("m")]
    out = full.select(F.concat_ws("-", "id", "piece").alias("container_id"), "id", "piece", "size")
    for part in closed:
        out = out.unionByName(part.select(*member).select("container_id", "m.id", "m.piece", "m.size"))
    return out.select(
        "container_id", F.col("id").alias(id_column), F.col("piece").alias("piece_no"), (F.col("piece").cast("long") * capacity).alias("start"), F.col("size").alias("n_tokens")
    )


def split_items(packed: DataFrame, id_column: str) -> DataFrame:
    """The items that had to be cut."""
    return packed.where("piece_no = 1").select(id_column)


def fill_report(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: containers, tokens and the share of room used."""
    per = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("used"))
    return per.agg(F.count("*").alias("n_containers"), F.sum("used").alias("n_tokens"), (F.sum("used") / (F.count("*") * capacity)).alias("fill"))
