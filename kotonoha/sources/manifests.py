"""JSON-lines manifests and plain-text line sources, with errors that name file and line."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Sequence

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import id_prefix, strip
from ..operators.integrity import assert_unique
from ..plans.staging import filesystem

BREAKS = r"\r\n|\n|\r"


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line) of text files of any size. A last line break ends the last line; an empty file has no lines.

    Files are read in splits. Lines are numbered within their split, and what the splits before it in the file hold is added, so
    neither a file nor its lines come together in one task.
    """
    rows = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    # A carriage return breaks lines too, but for the one before a line feed.
    rows = rows.select("file", "block", "at", F.posexplode(F.split(F.regexp_replace("value", r"\r\z", ""), "\r", -1)).alias("piece", "line"))
    sizes = rows.groupBy("file", "block").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = rows.withColumn("nth", F.row_number().over(Window.partitionBy("file", "block").orderBy("at", "piece")))
    return numbered.join(sizes, ["file", "block"]).select("file", (F.col("before") + F.col("nth")).alias("line_no"), "line")


def split_lines(text: Column) -> Column:
    """Array of the lines of a text; a last line break ends the last line, an empty text has none."""
    cut = F.split(F.regexp_replace(text, rf"(?:{BREAKS})\z", ""), BREAKS, -1)
    return F.when(F.length(text) > 0, cut).otherwise(F.array().cast("array<string>"))


def _corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])


def _prefixed(names: Column, prefix: Column) -> Column:
    return F.transform(names, lambda n: F.concat(prefix, n))


def unknown_fields(line: Column, schema: T.StructType) -> Column:
    """Names that the schema doesn't have, at any level of nested objects, as paths in order."""
    found = [F.array_except(F.json_object_keys(line), F.array(*[F.lit(f.name) for f in schema.fields]))]
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            inner, prefix = unknown_fields(F.get_json_object(line, f"$.{f.name}"), f.dataType), F.lit(f"{f.name}.")
            found.append(_prefixed(inner, prefix))
    return F.concat(*[F.coalesce(x, F.array().cast("array<string>")) for x in found])


def parse(lines: DataFrame, schema: T.StructType, *, strict: bool = True, skip_blank: bool = False) -> DataFrame:
    """Lines with ``record`` and ``problem``: malformed, unknown_field, or null for a good line. A blank line is malformed
    unless skipped."""
    rows = lines.where(strip(F.col("line")) != "") if skip_blank else lines
    parsed = rows.withColumn("__r", F.from_json("line", _corrupt(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    well_formed = F.try_parse_json("line").isNotNull() & (F.substring(strip(F.col("line")), 1, 1) == "{")
    problem = F.when(~F.coalesce(well_formed, F.lit(False)) | F.col("__r._corrupt").isNotNull(), "malformed")
    if strict:
        problem = problem.when(F.size(unknown_fields(F.col("line"), schema)) > 0, "unknown_field")
    record = F.struct(*[F.col(f"__r.{f.name}").alias(f.name) for f in schema.fields])
    return parsed.select(*rows.columns, F.when(problem.isNull(), record).alias("record"), problem.alias("problem"))


def read_manifest(
    spark: SparkSession, path: str, schema: T.StructType, *, key: str | None = None, missing_ok: bool = False, skip_blank: bool = False, lenient: str | None = None
) -> DataFrame:
    """Records of a manifest; a bad line raises with file and line number, a repeated ``key`` raises too. With ``lenient``, a text field
    of that name may be anything: it is null and ``{name}_missing`` true where it is no text or blank."""
    if missing_ok and not _exists(spark, path):
        empty = spark.createDataFrame([], schema)
        return empty.withColumn(f"{lenient}_missing", F.lit(True)) if lenient else empty
    parsed = parse(numbered_lines(spark, path), schema, skip_blank=skip_blank)
    where = F.concat(F.col("file"), F.lit(":"), F.col("line_no").cast("string"), F.lit(": "), F.col("problem"))
    good = parsed.where(F.when(F.col("problem").isNull(), True).otherwise(F.raise_error(where).cast("boolean")))
    out = good.select("record.*")
    if lenient:
        kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json("line"), f"$.{lenient}", "variant"))
        fine = F.coalesce((kind == "STRING") & (strip(F.col(f"record.{lenient}")) != ""), F.lit(False))
        fields = [F.when(fine, F.col(f"record.{c}")).alias(c) if c == lenient else F.col(f"record.{c}").alias(c) for c in schema.names]
        out = good.select(*fields, (~fine).alias(f"{lenient}_missing"))
    return assert_unique(out, [key], f"repeated {key}") if key else out


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def write_manifest(df: DataFrame, path: str, *, key: str | None = None, order: str | None = None, single_file: bool = False) -> None:
    """Compact JSON lines with nulls kept, sorted by ``order`` (default: ``key``): ranges of it go to files whose names are in that order.
    ``single_file`` brings all into one, for byte-equal reruns of small outputs; without an order rows stay where they are."""
    rows = assert_unique(df, [key], f"repeated {key}") if key else df
    by = order or key
    lines = rows.select(*([F.col(by).alias("__by")] if by else []), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    if single_file:
        lines = lines.repartition(1)
        lines = lines.sortWithinPartitions("__by") if by else lines
    elif by:
        lines = lines.orderBy("__by")
    lines.select("value").write.mode("overwrite").text(path)


def ingest_lines(spark: SparkSession, path: str, *, prefix: str, dataset_id: str) -> DataFrame:
    """(sample_id, raw_text, source_id) of a text file, one record a line; a blank line raises with its number."""
    lines = numbered_lines(spark, path)
    blank = F.concat(F.col("file"), F.lit(":"), F.col("line_no").cast("string"), F.lit(": blank line"))
    good = lines.where(F.when(strip(F.col("line")) != "", True).otherwise(F.raise_error(blank).cast("boolean")))
    number = F.col("line_no").cast("string")
    padded = F.lpad(number, F.greatest(F.lit(6), F.length(number)), F.lit("0"))
    return good.select(F.concat_ws("_", id_prefix(F.lit(prefix or dataset_id), F.lit(dataset_id)), padded).alias("sample_id"), F.col("line").alias("raw_text"), F.concat(F.lit("line:"), number).alias("source_id"))


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI, or of a path on the driver's side."""
    return filesystem(path if "://" in path else f"file://{os.path.abspath(path)}")


def write_summary(row: DataFrame, path: str) -> None:
    """A one-row summary as indented JSON, at a path or a URI."""
    text = json.dumps(json.loads(row.toJSON().first()), indent=2, ensure_ascii=False) + "\n"
    system, where = _open(path)
    system.create_dir(os.path.dirname(where), recursive=True)
    with system.open_output_stream(where) as out:
        out.write(text.encode())


def schema_json(schema: T.StructType) -> str:
    """A contract as JSON, sorted, for export."""
    return json.dumps(json.loads(schema.json()), indent=2, sort_keys=True, ensure_ascii=False)


def resolve(path: Column, root: str) -> Column:
    """Absolute paths as they are, others below ``root``."""
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))


def relative(path: Column, root: str) -> Column:
    """Path below ``root``; raises for one outside."""
    base = root.rstrip("/") + "/"
    return F.when(path.startswith(base), F.substr(path, F.lit(len(base) + 1))).otherwise(F.raise_error(F.concat(F.lit("outside the data root: "), path)))


def load_table(path: str, fields: Sequence[str], unique: str, *, entries: str = "entries", most: int = 100_000) -> tuple[list[dict], str]:
    """A small companion list (JSON with ``entries``), at a path or a URI, and the SHA-256 of its bytes; checks fields and uniqueness.

    It becomes part of plans, so more than ``most`` entries are refused."""
    system, where = _open(path)
    with system.open_input_stream(where) as source:
        raw = source.read()
    rows = json.loads(raw)[entries]
    if len(rows) > most:
        raise ValueError(f"{len(rows)} entries are too many for a companion list")
    for e in rows:
        missing = [f for f in fields if not str(e.get(f) or "").strip()]
        if missing:
            raise ValueError(f"entry without {missing}: {e}")
    if len({e[unique] for e in rows}) != len(rows):
        raise ValueError(f"{unique} repeats")
    return rows, hashlib.sha256(raw).hexdigest()
