"""Deduplicating new batches against all history.

Batches come one at a time. A text whose bare form is known repeats the accepted text the form was settled to. The
other forms of at least ``min_chars`` characters go through graph index shards: each history segment is one or more
navigable small-world graphs (see ``smallworld``), written once to the shared folder. A batch builds its own shards,
its texts are searched in blocks against the shards of all segments and of the batch itself, and whatever is seen near is
compared exactly (sets of three-character sequences, Jaccard similarity of at least ``similarity``). Acceptance runs in order within
the batch: a text without an earlier accepted neighbour is accepted, its later neighbours are turned away, until all
are settled. History is never read again but for compaction: when ``fan_in`` segments of one size tier have gathered,
their accepted texts are built into one segment.

A duplicate repeats the accepted text most similar to it; ties go to the earliest accepted one by id.

Cases: a null text is accepted and matches nothing; empty bare forms are equal to each other; a record delivered again
keeps its first batch (``first_deliveries``); rows with null id are ignored; ties and copies collapse to one form before any
search, so a text of a third of all rows is one node; very long texts are compared whole; an empty batch
settles nothing; other columns are ignored.

The search is approximate: a similar pair is lost if its sketches differ by more than ``smallworld.NEAR`` bytes of 64 or the walk doesn't see it.
``shards`` gives the recall of every shard, ``AcceptedHistory(exact=True)`` loses none.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .forms import bare_batch, codes_of
from ..plans.staging import Stage, filesystem
from . import smallworld
from .buckets import BucketedTable
from .copies import _hash

MIN_CHARS = 40
SIMILARITY = 0.6
SHARD_TEXTS = 100_000
BLOCK_TEXTS = 16_384

FORM = T.StructType([T.StructField("form", T.StringType()), T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType())])
_PARTS = ("sketch", "counts", "keys", "order", "links", "forms", "ids")
_SHARD = T.StructType([T.StructField("n", T.LongType()), T.StructField("beam", T.IntegerType()), T.StructField("recall", T.DoubleType()), *[T.StructField(p, T.BinaryType()) for p in _PARTS], T.StructField("a", T.StringType()), T.StructField("b", T.StringType()), T.StructField("similarity", T.DoubleType())])
_PAIR = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType()), T.StructField("similarity", T.DoubleType()), T.StructField("own", T.BooleanType())])


@F.pandas_udf(FORM)
def bare_key(texts: pd.Series) -> pd.DataFrame:
    """Bare form of a text and its 128-bit fingerprint."""
    forms = bare_batch([t if isinstance(t, str) else None for t in texts])
    keys = [None if f is None else _hash(f) for f in forms]
    return pd.DataFrame({"form": pd.Series(forms, dtype=object), "k1": pd.array([k and k[0] for k in keys], dtype="Int64"), "k2": pd.array([k and k[1] for k in keys], dtype="Int64")})


def first_deliveries(rows: DataFrame, id_column: str, batch_column: str, text_column: str) -> DataFrame:
    """(id, batch, text): each record once, as delivered in its lowest batch."""
    text = F.col(text_column).alias("text")
    first = rows.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("id")).agg(F.min(F.struct(F.col(batch_column).alias("batch"), text)).alias("f"))
    return first.select("id", "f.batch", "f.text")


def _grams(forms: list[str]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.concatenate(([0], np.cumsum([len(f) for f in forms])))
    return smallworld.gram_sets(codes_of("".join(forms)), offsets)


def _build(similarity: float, all_pairs: bool = False):
    """The graph over all texts of a partition as one row, then the pairs of its own texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        rows = pd.concat(parts).sort_values("id", kind="stable")  # the same graph whatever the order of arrival
        forms, ids = rows["form"].tolist(), rows["id"].tolist()
        grams, offsets = _grams(forms)
        graph = smallworld.Graph.build(grams, offsets, not all_pairs)
        text = "\x00".join(forms).encode("utf-8", "surrogatepass")
        row = {
            "n": len(forms), "beam": graph.beam, "recall": graph.recall, "sketch": graph.sketch.tobytes(), "counts": graph.counts.tobytes(), "keys": graph.keys.tobytes(), "order": graph.directory.order.tobytes(),
            "links": graph.links.tobytes(), "forms": len(text).to_bytes(8, "little") + pa.compress(text, "zstd", asbytes=True), "ids": "\x00".join(ids).encode(),
        }
        yield _rows(**{k: [v] for k, v in row.items()})
        if similarity <= 1:
            found = smallworld.Prefixes(grams, offsets, similarity).sharing(grams, offsets) if all_pairs else graph.found(grams, offsets, graph.sketch, graph.shared_directory(grams, offsets))
            for q, t in found:
                q, t = q[t < q], t[t < q]  # texts stand in the order of their ids
                exact = smallworld.jaccard(grams, offsets, grams, offsets, q, t)
                good = exact >= similarity
                q, t, exact = q[good], t[good], exact[good]
                for at in range(0, len(q), 1 << 16):
                    part = slice(at, at + (1 << 16))
                    yield _rows(a=[ids[x] for x in t[part].tolist()], b=[ids[x] for x in q[part].tolist()], similarity=exact[part].tolist())

    return run


def _rows(**columns: list) -> pd.DataFrame:
    n = len(next(iter(columns.values())))
    kinds = {"n": "Int64", "beam": "Int32", "recall": "Float64", "similarity": "Float64"}
    return pd.DataFrame({c: pd.Series(columns.get(c, [None] * n), dtype=kinds.get(c, object)) for c in _SHARD.names})


class Shard:
    def __init__(self, row: dict):
        n = row["n"]
        array = lambda p, kind: np.frombuffer(row[p], dtype=kind)
        keys = array("keys", np.uint64).reshape(n, -1)
        self.graph = smallworld.Graph(array("sketch", np.uint64).reshape(n, -1), array("counts", np.uint16), keys, array("links", np.int32).reshape(n, -1), row["beam"], array("order", np.int32).reshape(n, -1))
        packed = row["forms"]
        self.forms = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), "zstd", asbytes=True).decode("utf-8", "surrogatepass").split("\x00")
        self.ids = row["ids"].decode().split("\x00")


_loaded: OrderedDict[str, list[Shard]] = OrderedDict()
_KEPT_TEXTS = 2 * SHARD_TEXTS


def _shards(uri: str) -> list[Shard]:
    """The shards in a file, kept by the worker while there is room."""
    if uri not in _loaded:
        system, path = filesystem(uri)
        with system.open_input_file(path) as source:
            _loaded[uri] = [Shard(row) for row in pq.read_table(source, columns=["n", "beam", *_PARTS], filters=[("n", ">", 0)]).to_pylist()]
        while len(_loaded) > 1 and sum(len(s.ids) for own in _loaded.values() for s in own) > _KEPT_TEXTS:
            _loaded.popitem(last=False)
    _loaded.move_to_end(uri)
    return _loaded[uri]


def _search(history: list[str], own: list[str], similarity: float, all_pairs: bool = False):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        rows = pd.concat(parts)
        for at in range(0, len(rows), BLOCK_TEXTS):
            yield from block(rows["id"].tolist()[at : at + BLOCK_TEXTS], rows["form"].tolist()[at : at + BLOCK_TEXTS])

    def block(ids: list[str], forms: list[str]) -> Iterator[pd.DataFrame]:
        grams, offsets = _grams(forms)
        sketch = None if all_pairs else smallworld.sketches(grams, offsets)
        for uri, same_batch in [*((u, False) for u in history), *((u, True) for u in own)]:
            for shard in _shards(uri):
                found = smallworld.Prefixes(*_grams(shard.forms), similarity).sharing(grams, offsets) if all_pairs else shard.graph.found(grams, offsets, sketch)
                for q, t in found:
                    if same_batch:
                        before = np.fromiter((shard.ids[y] < ids[x] for x, y in zip(q.tolist(), t.tolist())), dtype=bool, count=len(q))
                        q, t = q[before], t[before]
                    if not len(q):
                        continue
                    texts, place = np.unique(t, return_inverse=True)
                    exact = smallworld.jaccard(grams, offsets, *_grams([shard.forms[x] for x in texts.tolist()]), q, place)
                    good = exact >= similarity
                    yield pd.DataFrame(
                        {"a": pd.Series([shard.ids[x] for x in t[good].tolist()], dtype=object), "b": pd.Series([ids[x] for x in q[good].tolist()], dtype=object), "similarity": exact[good], "own": same_batch}
                    )

    return run


class AcceptedHistory:
    """All accepted texts, extended batch by batch. With ``exact`` no graph is searched: candidates are all texts that share a sequence of
    their rare part with the query (prefix filtering), which loses none at a price that grows with the history."""

    def __init__(
        self, spark: SparkSession, stage: Stage, *, min_chars: int = MIN_CHARS, similarity: float = SIMILARITY, shard_texts: int = SHARD_TEXTS, fan_in: int = 4, exact: bool = False, buckets: int | None = None
    ):
        self.spark, self.stage, self.exact, self.batches = spark, stage, exact, 0
        self.min_chars, self.similarity, self.shard_texts, self.fan_in = min_chars, similarity, shard_texts, fan_in
        self.segments: list[dict] = []  # n, files, texts (id, form)
        self._settled = BucketedTable(stage, "k1 bigint, k2 bigint, target string", ("k1", "k2"), buckets)  # each form with the accepted record it stands for
        self._rejected = BucketedTable(stage, "a string", ("a",), buckets)
        self._found = stage.path("found")

    def add(self, batch: DataFrame) -> DataFrame:
        """(id, accepted_id) of the records of a batch of (id, form, k1, k2) that are turned away."""
        self.batches += 1
        on = ["k1", "k2"]
        rows = batch.where("form is not null")
        old = None
        if not self._settled.empty:  # the batch meets the matching buckets of the history of forms once; what is left is new
            known = self._settled.matching(self._settled.parts_of(rows)).withColumnRenamed("target", "known")
            rows = self.stage.write(rows.join(known, on, "left"), "met")
            old = rows.where("known is not null and id <> known").select("id", F.col("known").alias("accepted_id"))
            rows = rows.where("known is null")
        forms = rows.groupBy(*on).agg(F.min(F.struct("id", "form")).alias("f")).select(*on, "f.id", "f.form")
        fresh, n = self.stage.write_counted(forms, "fresh", F.length("form") >= self.min_chars)
        texts = fresh.where(F.length("form") >= self.min_chars).select("id", "form")
        settled = fresh.select(*on, F.col("id").alias("target"))
        if n:
            segment = self._segment(texts, n, self.similarity)
            turned = self._settle(*self._pairs(texts, n, segment))
            if turned is not None:
                target = turned.groupBy("b").agg(F.min(F.struct((-F.col("similarity")).alias("s"), F.col("a"))).alias("best")).select(F.col("b").alias("id"), F.col("best.a").alias("to"))
                settled = self.stage.write(fresh.join(target, "id", "left").select(*on, F.coalesce("to", "id").alias("target"), F.when(F.col("to").isNotNull(), F.col("id")).alias("lost")), "settled")
                self._rejected.append(settled.where("lost is not null").select(F.col("lost").alias("a")))
                settled = settled.select(*on, "target")
            self.segments.append(segment)
            self._compact()
        self._settled.append(settled)
        found = rows.select("id", *on).join(settled, on).where("id <> target").select("id", F.col("target").alias("accepted_id"))
        found = found if old is None else found.unionByName(old)
        found.withColumn("batch", F.lit(self.batches)).write.mode("append").parquet(self._found)
        return self.turned_away().where(F.col("batch") == self.batches).drop("batch")

    def turned_away(self) -> DataFrame:
        """(id, accepted_id, batch) of all batches so far."""
        schema = "id string, accepted_id string, batch int"
        return self.spark.read.schema(schema).parquet(self._found) if self.batches else self.spark.createDataFrame([], schema)

    def shards(self) -> DataFrame:
        """(n, beam, recall) of every shard: the share of similar pairs that its search found when its beam was chosen, by exact
        similarity against all texts of the shard (null where it is searched exhaustively)."""
        out = self.spark.createDataFrame([], "n long, beam int, recall double")
        for s in self.segments:
            out = out.unionByName(s["rows"].where("n is not null").select("n", "beam", "recall"))
        return out

    def _segment(self, texts: DataFrame, n: int, similarity: float = 2.0) -> dict:
        """Graph shards of the texts; similar pairs within a shard are found while it is at hand (none above 1)."""
        shards = math.ceil(n / self.shard_texts)
        built = self.stage.write(texts.repartition(shards, "id").mapInPandas(_build(similarity, self.exact), _SHARD), "graph")
        return {"n": n, "files": sorted(built.inputFiles()), "texts": texts, "rows": built, "shards": shards}

    def _pairs(self, texts: DataFrame, n: int, segment: dict) -> tuple[DataFrame, int]:
        """Similar pairs with an accepted text or one of the batch, and the number of those within the batch."""
        pairs = segment["rows"].where("a is not null").select("a", "b", "similarity", F.lit(True).alias("own"))
        history = [f for s in self.segments for f in s["files"]]
        others = segment["files"] if segment["shards"] > 1 else []
        if history or others:
            blocks = texts.repartition(max(1, math.ceil(n / BLOCK_TEXTS)), "id")
            pairs = pairs.unionByName(blocks.mapInPandas(_search(history, others, self.similarity, self.exact), _PAIR))
        if not self._rejected.empty:
            pairs = self.stage.write(pairs, "candidates")
            pairs = pairs.join(self._rejected.matching(self._rejected.parts_of(pairs.where("not own"))), "a", "left_anti")
        return self.stage.write_counted(pairs, "pairs", F.col("own"))

    def _settle(self, pairs: DataFrame, n: int) -> DataFrame | None:
        """The pairs (a, b) whose earlier text is accepted: their later text is turned away. A round settles all texts whose earlier
        neighbours are settled, so there are as many as the longest chain of neighbours within the batch."""
        old = pairs.where(~F.col("own"))
        done = [old]
        if n:
            gone = old.select(F.col("b").alias("a")).distinct()
            left, n = self.stage.write_counted(pairs.where("own").join(gone, "a", "left_anti").select("a", "b", "similarity", "own"), "open")
        if not n and old.isEmpty():
            return None
        while n:
            heads = left.select("a").distinct().join(left.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
            won = self.stage.write(left.join(heads, "a").select("a", "b", "similarity", "own"), "won")
            done.append(won)
            # What is turned away accepts nothing; what has been accepted needs no further look.
            settled = won.select(F.explode(F.array("a", "b")).alias("a")).distinct()
            left, n = self.stage.write_counted(left.join(settled, "a", "left_anti").select("a", "b", "similarity", "own"), "open")
        out = done[0]
        for part in done[1:]:
            out = out.unionByName(part)
        return out

    def _compact(self) -> None:
        tier = lambda s: int(math.log(max(s["n"], 1), self.fan_in))
        by_tier: dict[int, list[dict]] = {}
        for s in self.segments:
            by_tier.setdefault(tier(s), []).append(s)
        for own in by_tier.values():
            if len(own) >= self.fan_in:
                texts = own[0]["texts"]
                for s in own[1:]:
                    texts = texts.unionByName(s["texts"])
                if not self._rejected.empty:
                    texts = texts.join(self._rejected.unbucketed().withColumnRenamed("a", "id"), "id", "left_anti")
                merged = self._segment(*self.stage.write_counted(texts.select("id", "form"), "texts"))
                self.segments = [s for s in self.segments if s not in own] + [merged]
                for path in {f.rsplit("/", 1)[0] for s in own for f in s["files"]}:
                    self.stage.remove(path)
                return
