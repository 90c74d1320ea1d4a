"""Cutting lineage through tables written to the folder all executors share.

The folder is the one the cluster names in ``spark.checkpoint.dir``; only in local mode, as in tests, a temporary
one is made where none is set, anywhere else that is an error. A written table survives the loss of executors, is compressed and can be read by column.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this application."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not known:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        known = "file://" + tempfile.mkdtemp(prefix="kotonoha-")
        spark.sparkContext.setCheckpointDir(known)
    return known.rstrip("/")


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI as Spark writes it, and the path in it."""
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


class Stage:
    """A folder of written tables below the shared folder, removed at exit or by ``close``."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._n, self._pid = 0, os.getpid()
        atexit.register(self.close)

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{name}-{self._n}"

    def write(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """Write ``df`` as a table and read it back: the plan of the result starts at the files. With ``by`` the table is
        partitioned by that column, so that a filter on it reads only its own files."""
        path = self.path(name)
        (df.write.partitionBy(by) if by else df.write).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write_counted(self, df: DataFrame, name: str, when: Column | None = None) -> tuple[DataFrame, int]:
        """The written table and its number of rows (of those for which ``when`` holds), counted while it is written."""
        seen = Observation()
        counted = F.count(F.lit(1)) if when is None else F.count_if(when)
        table = self.write(df.observe(seen, counted.alias("n")), name)
        return table, seen.get["n"]

    def remove(self, path: str) -> None:
        """Delete a folder; goes past the session, which may have ended already."""
        try:
            system, where = filesystem(path)
            system.delete_dir(where)
        except (OSError, ValueError):  # gone already, or a kind of storage only the cluster can clear
            pass

    def close(self) -> None:
        """Delete all tables of this stage, if this is the process that made them."""
        if os.getpid() == self._pid:
            self.remove(self.root)
