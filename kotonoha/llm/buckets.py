"""Tables that grow batch by batch without being moved: bucketed by key, and partitioned by the number of the bucket.

A bucket is a partition of its own (``part`` is the bucket number as Spark's hash partitioning has it), so

* a join on the key reads a bucket in the task that holds the batch's rows of it: only the batch is shuffled;
* a filter on ``part`` reads nothing but the buckets that a batch touches, one file of one partition each;
* dynamic partition overwrite rewrites these buckets and leaves the others as they are.

The data lie in the stage's folder. Spark keeps bucketing only for tables of the session's catalog, so each has a name there, which ``drop`` removes.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.staging import Stage

LEAST_BUCKETS = 24


def default_buckets(spark: SparkSession) -> int:
    return max(LEAST_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))


class BucketedTable:
    def __init__(self, stage: Stage, columns: str, keys: Sequence[str], buckets: int | None = None):
        """``columns`` as in DDL; ``keys`` of them decide the bucket and must not be null."""
        self.spark, self.stage, self.keys = stage.spark, stage, list(keys)
        self.buckets = buckets or default_buckets(stage.spark)
        self.name = f"kept_{uuid.uuid4().hex}"
        self.path = stage.path("kept")
        self.spark.sql(f"create table {self.name} ({columns}, part int) using parquet partitioned by (part) clustered by ({', '.join(keys)}) into {self.buckets} buckets location '{self.path}'")
        self.columns = self.spark.table(self.name).columns[:-1]
        self.empty = True

    def part(self) -> Column:
        """Number of the bucket of a row."""
        return F.pmod(F.hash(*self.keys), F.lit(self.buckets))

    def parts_of(self, rows: DataFrame) -> list[int]:
        """The buckets that rows with these keys belong to; at most ``buckets`` numbers."""
        return sorted(r[0] for r in rows.select(self.part().alias("part")).distinct().collect())

    def all(self) -> DataFrame:
        return self.spark.table(self.name).drop("part")

    def matching(self, parts: Sequence[int]) -> DataFrame:
        """The rows of some buckets."""
        own = self.spark.table(self.name)
        return (own.where(F.col("part").isin(*parts)) if len(parts) < self.buckets else own).drop("part")

    def unbucketed(self) -> DataFrame:
        """All rows without their bucketing, for joins in which a hot key must be split: AQE splits what was shuffled."""
        schema = self.spark.table(self.name).schema
        return self.spark.read.schema(schema).parquet(self.path).drop("part") if not self.empty else self.all()

    def append(self, rows: DataFrame, placed: bool = False) -> None:
        """Add rows. ``placed`` says that a join on the keys has brought them together by bucket already."""
        self._insert(rows, placed, False)

    def replace(self, rows: DataFrame, placed: bool = False) -> None:
        """Rewrite the buckets of these rows, which may be computed from them."""
        self._insert(rows, placed, True)

    def _insert(self, rows: DataFrame, placed: bool, overwrite: bool) -> None:
        own = rows.select(*self.columns)
        own = (own if placed else own.repartition(self.buckets, *self.keys)).withColumn("part", self.part())
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")
        try:
            own.write.insertInto(self.name, overwrite=overwrite)
        finally:
            self.spark.conf.set(mode, before)
        self.empty = False

    def compact(self) -> None:
        """Bring the files of each bucket into one."""
        if not self.empty:
            self.replace(self.all())

    def drop(self) -> None:
        self.spark.sql(f"drop table if exists {self.name}")
        self.stage.remove(self.path)
