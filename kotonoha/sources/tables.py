"""The Parquet tables of a data folder."""

from __future__ import annotations

import io
import os
import zipfile

from pyspark.sql import DataFrame, SparkSession

from ..plans.staging import filesystem, shared_dir

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they run: an archive of it in the shared folder is given to them.

    Not needed, and not done, where the package's folder is on the PYTHONPATH that workers inherit.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    context = spark.sparkContext
    if context.applicationId in _shipped or os.path.dirname(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    _shipped.add(context.applicationId)
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    uri = f"{shared_dir(spark)}/kotonoha-{context.applicationId}.zip"
    system, path = filesystem(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    with system.open_output_stream(path) as out:
        out.write(packed.getvalue())
    context.addPyFile(uri)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table; also makes the package known to the workers."""
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")
