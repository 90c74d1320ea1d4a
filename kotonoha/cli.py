"""Command line over the operators: ``spark-submit`` or ``python -m kotonoha.cli COMMAND``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as tx
from .operators import regression
from .operators.history import latest, snapshot_diff
from .operators.references import find_orphans
from .sources import audio, manifests, records


def _write(df: DataFrame, out: str) -> None:
    if out.endswith(".parquet"):
        df.write.mode("overwrite").parquet(out)
    else:
        manifests.write_manifest(df, out)


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path) if path.endswith(".parquet") else spark.read.json(path)


def ingest_text(spark: SparkSession, a: argparse.Namespace) -> None:
    _write(manifests.ingest_lines(spark, a.input, prefix=a.prefix, dataset_id=a.dataset), a.output)


def normalize(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = _read(spark, a.input).withColumn("__n", tx.normalized(F.col(a.column)))
    _write(rows.withColumn("normalized_text", F.col("__n.text")).withColumn("steps", F.col("__n.steps")).drop("__n"), a.output)


def inspect_audio(spark: SparkSession, a: argparse.Namespace) -> None:
    found = audio.read_audio(spark, a.input).select("path", "size", "sha256", audio.wav_info("content").alias("wav"))
    _write(found.select("path", "size", "sha256", "wav.*"), a.output)


def diff(spark: SparkSession, a: argparse.Namespace) -> None:
    _write(snapshot_diff(_read(spark, a.before), _read(spark, a.after), a.keys, a.material, a.other), a.output)


def keep_latest(spark: SparkSession, a: argparse.Namespace) -> None:
    _write(latest(_read(spark, a.input), a.keys, a.order), a.output)


def orphans(spark: SparkSession, a: argparse.Namespace) -> None:
    found = find_orphans(_read(spark, a.input), a.columns, _read(spark, a.targets), a.keys, match=a.match, keep=a.keep)
    _write(found, a.output)


def validate(spark: SparkSession, a: argparse.Namespace) -> None:
    """Read a manifest against its contract and write it sorted by key; any fault ends the run with its place."""
    records.write_records(records.read_records(spark, a.input, a.kind), a.output, a.kind)


def capture_baseline(spark: SparkSession, a: argparse.Namespace) -> None:
    names = set(records.CONTRACTS["baseline"].schema.names) & set(records.CONTRACTS["evidence"].schema.names)
    provenance = [c for c in records.CONTRACTS["evidence"].schema.names if c in names and c not in ("schema_version", "logical_case_id", "source_text", "expected_references", "risk_evidence", "audio_sha256")]
    records.write_records(regression.capture_baseline(records.read_records(spark, a.input, "evidence"), provenance), a.output, "baseline")


def schema(spark: SparkSession, a: argparse.Namespace) -> None:
    print(records.json_schema(a.kind))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="kotonoha", description=__doc__)
    commands = top.add_subparsers(required=True)

    def command(run, *options: tuple[str, dict]) -> None:
        own = commands.add_parser(run.__name__.replace("_", "-"))
        own.set_defaults(run=run)
        for name, how in options:
            own.add_argument(name, **how)

    one, many = {"required": True}, {"required": True, "nargs": "+"}
    io = (("--input", one), ("--output", one))
    command(ingest_text, *io, ("--dataset", one), ("--prefix", {"default": ""}))
    command(normalize, *io, ("--column", {"default": "raw_text"}))
    command(inspect_audio, *io)
    command(diff, ("--before", one), ("--after", one), ("--output", one), ("--keys", many), ("--material", many), ("--other", {"nargs": "*", "default": []}))
    command(keep_latest, *io, ("--keys", many), ("--order", many))
    kind = ("--kind", {"required": True, "choices": sorted(records.CONTRACTS)})
    command(validate, *io, kind)
    command(capture_baseline, *io)
    command(schema, kind)
    command(orphans, *io, ("--targets", one), ("--columns", many), ("--keys", many), ("--keep", many), ("--match", {"default": "simple", "choices": ["simple", "partial", "full"]}))
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("kotonoha").getOrCreate()
    args.run(spark, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
