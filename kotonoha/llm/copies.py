"""Duplicates hidden by formatting differences, counted by an incremental ledger.

A record's canonical key is the 128-bit fingerprint of its bare form (or bare forms, for records with several
fields). The ledger keeps two bucketed tables in the shared folder (see ``buckets``):

* ``records``, bucketed by record id: which records have been counted, with their key. A record delivered again is
  recognised here and not counted twice;
* ``keys``, bucketed by key: number of records and the earliest representative of each key.

A batch is reduced to one row per new record (an anti-join with the matching buckets of ``records``, to which they are appended),
aggregated by key (map-side first, so a key that holds a third of all rows shuffles one row per task) and full-outer-joined with the
matching buckets of ``keys``, which alone are rewritten. History isn't shuffled, and buckets without a row of the batch are neither read nor written.

The representative is the member of the earliest batch, and within it the smallest id; ``smallest_id`` is the
smallest id over all batches.

Cases: a null text has no key and is not counted; texts without any letter share the empty form and are one group;
repeated rows and redelivered records count once; an empty batch changes nothing; very long texts are hashed whole;
ids that are null are ignored; other columns are ignored. Members are joined back to groups without the bucketing, so that AQE can split hot keys.
"""

from __future__ import annotations

import hashlib
import json
import struct

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.staging import Stage
from .buckets import BucketedTable
from .forms import bare_batch

KEY = T.StructType([T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType())])


def _hash(form: str) -> tuple[int, int]:
    return struct.unpack("<qq", hashlib.blake2b(form.encode("utf-8", "surrogatepass"), digest_size=16).digest())


def _frame(keys: list[tuple[int, int] | None]) -> pd.DataFrame:
    """Rows of two longs; pandas has no null in int64, so a missing key is null in an Int64 column."""
    return pd.DataFrame({"k1": pd.array([k and k[0] for k in keys], dtype="Int64"), "k2": pd.array([k and k[1] for k in keys], dtype="Int64")})


@F.pandas_udf(KEY)
def text_key(texts: pd.Series) -> pd.DataFrame:
    """Key of the bare form of a text; null for null."""
    return _frame([None if f is None else _hash(f) for f in bare_batch([t if isinstance(t, str) else None for t in texts])])


def json_record(line: str | None, fields: tuple[str, ...]) -> list[str | None] | None:
    """The fields of a line of JSON in their given order; None if the line isn't an object or a field isn't text or null."""
    try:
        value = json.loads(line) if line is not None else None
    except (ValueError, RecursionError):
        return None
    if not isinstance(value, dict):
        return None
    out = [value.get(f) for f in fields]
    return out if all(x is None or isinstance(x, str) for x in out) else None


def json_key(line: Column, fields: tuple[str, ...]) -> Column:
    """Key of the bare forms of ``fields`` of a line of JSON, whatever their order; null if it doesn't parse."""

    @F.pandas_udf(KEY)
    def key(lines: pd.Series) -> pd.DataFrame:
        records = [json_record(x if isinstance(x, str) else None, fields) for x in lines]
        forms = iter(bare_batch([x for r in records if r is not None for x in r]))
        out: list[tuple[int, int] | None] = []
        for r in records:
            own = None if r is None else [next(forms) for _ in fields]
            out.append(None if own is None else _hash("".join("\x00" if f is None else f"\x01{f}\x02" for f in own)))
        return _frame(out)

    return key(line)


class CopyLedger:
    """Counts copies batch by batch; see the module for the layout."""

    def __init__(self, spark: SparkSession, stage: Stage, buckets: int | None = None):
        self.spark, self.stage, self.batches = spark, stage, 0
        self._records = BucketedTable(stage, "space string, id string, k1 bigint, k2 bigint, batch int", ("space", "id"), buckets)
        self._keys = BucketedTable(stage, "space string, k1 bigint, k2 bigint, copies bigint, first_id string, smallest_id string", ("space", "k1", "k2"), buckets)

    def records(self) -> DataFrame:
        """(space, id, k1, k2) of every record counted so far."""
        return self._records.unbucketed().drop("batch")

    def keys(self) -> DataFrame:
        """(space, k1, k2, copies, first_id, smallest_id) of every key."""
        return self._keys.unbucketed()

    def add(self, batch: DataFrame) -> None:
        """Count a batch of (space, id, k1, k2), where ``space`` keeps tables apart. The batch is read three times: give a written table."""
        rows = batch.where(F.col("space").isNotNull() & F.col("id").isNotNull() & F.col("k1").isNotNull())
        parts = self._records.parts_of(rows)
        self.batches += 1
        fresh = rows.groupBy("space", "id").agg(F.min(F.struct("k1", "k2")).alias("k")).select("space", "id", "k.k1", "k.k2", F.lit(self.batches).alias("batch"))
        known = not self._records.empty
        if known:
            fresh = fresh.join(self._records.matching(parts).select("space", "id"), ["space", "id"], "left_anti")
        self._records.append(fresh, placed=known)
        on = ["space", "k1", "k2"]
        new = self._records.matching(parts).where(F.col("batch") == self.batches)
        counted = new.groupBy(*on).agg(F.count("*").alias("n"), F.min("id").alias("low"))
        if self._keys.empty:
            self._keys.append(counted.select(*on, F.col("n").alias("copies"), F.col("low").alias("first_id"), F.col("low").alias("smallest_id")))
            return
        counted = self._keys.matching(self._keys.parts_of(new)).join(counted, on, "full_outer")
        self._keys.replace(
            counted.select(
                *on,
                (F.coalesce("copies", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("copies"),
                F.coalesce("first_id", "low").alias("first_id"),
                F.least("smallest_id", "low").alias("smallest_id"),
            ),
            placed=True,
        )

    def compact(self) -> None:
        """Bring the files that the batches have added to each bucket of the records into one."""
        self._records.compact()


def copies_of(ledger: CopyLedger) -> DataFrame:
    """(space, first_id, copy_id): each record of a group but the one with the smallest id."""
    groups = ledger.keys().where("copies > 1").select("space", "k1", "k2", F.col("smallest_id").alias("first_id"))
    found = ledger.records().join(groups, ["space", "k1", "k2"]).where("id <> first_id")
    return found.select("space", "first_id", F.col("id").alias("copy_id"))


def groups_of(ledger: CopyLedger) -> DataFrame:
    """(space, first_id, n_copies): one record per group, copies counted with it."""
    return ledger.keys().select("space", F.col("smallest_id").alias("first_id"), F.col("copies").alias("n_copies"))
