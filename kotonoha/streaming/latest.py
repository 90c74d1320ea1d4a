"""Latest row per key of a stream, as a base and the deltas since.

A micro-batch writes no more than the latest row of each of its own keys, under its batch number, so a batch that is run again
after a failure writes the same delta again. When ``fan_in`` deltas have gathered, base and deltas become the next base; what it
replaces is deleted one compaction later, so that readers at work can end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.history import latest


def _parts(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """Numbers of the finished bases (v) and deltas (d)."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out: dict[str, list[int]] = {"v": [], "d": []}
    for status in system.listStatus(where) if system.exists(where) else []:
        name = status.getPath().getName()
        if name[:1] in out and name[1:].isdigit() and system.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{name}/_SUCCESS")):
            out[name[0]].append(int(name[1:]))
    return {k: sorted(v) for k, v in out.items()}


def _remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def current(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame | None:
    """The latest row of each key as of the last finished batch; null before any."""
    found = _parts(spark, path)
    base = found["v"][-1] if found["v"] else -1
    names = [f"{path}/v{base}"] * (base >= 0) + [f"{path}/d{n}" for n in found["d"] if n > base]
    return latest(spark.read.parquet(*names), keys, order) if names else None


def keep_latest(stream: DataFrame, keys: Sequence[str], order: Sequence[str], path: str, checkpoint: str, *, fan_in: int = 8, **trigger: object) -> StreamingQuery:
    """Start a query that keeps the row with the greatest ``order`` of each key below ``path``."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        latest(batch, keys, order).write.mode("overwrite").parquet(f"{path}/d{number}")
        found = _parts(spark, path)
        base = found["v"][-1] if found["v"] else -1
        if number > base and len([n for n in found["d"] if n > base]) >= fan_in:
            current(spark, path, keys, order).write.mode("overwrite").parquet(f"{path}/v{number}")
            for kind, limit in (("v", base), ("d", base + 1)):
                for n in found[kind]:
                    if n < limit:
                        _remove(spark, f"{path}/{kind}{n}")

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
