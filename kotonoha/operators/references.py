"""References to records that do not exist: orphan search over plain and composite keys, with time.

Composite keys with null columns follow the declared match semantics of SQL:

* ``simple``: a reference with any null column is not checked;
* ``partial``: the non-null columns must agree with some target row;
* ``full``: all columns null is fine, some null is an orphan.

References are grouped by null mask; each mask is anti-joined on its non-null columns only. The masks come from
the declared columns (2**k - 1 for k columns), never from the data.

With ``ref_time`` an orphan also gets a kind: ``missing`` (no target row has the key), ``late`` (all such rows were
loaded after the reference), ``deleted`` (each row loaded by then had been withdrawn by then). Targets are first
reduced to one row per key and withdrawal time (map-side), so a key with many deliveries stays small; the reference
side is never grouped, so a key named by a third of all references is split by AQE's skew handling.

Cases: null columns make the mask; blank ids count as null; empty references give no rows; empty targets make every
checked reference ``missing``; a null ``ref_time`` can't be placed in time and gives only ``missing``; a target
row with null load time counts as loaded before anything; repeated rows change nothing; extra columns are dropped
unless named in ``keep``, and the internal names all begin with ``__``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import compare_form

MATCHES = ("simple", "partial", "full")
_EPOCH = "0001-01-01 00:00:00"
_NEVER = "9999-12-31 23:59:59"


def _key(column: str) -> Column:
    form = compare_form(F.col(column))
    return F.when(form != "", form)


def _availability(targets: DataFrame, loaded: str | None, deleted: str | None) -> DataFrame:
    """Adds when a target row was loaded and, if ever, withdrawn."""
    seen = F.coalesce(F.col(loaded), F.lit(_EPOCH).cast("timestamp")) if loaded else F.lit(_EPOCH).cast("timestamp")
    gone = F.col(deleted).cast("timestamp") if deleted else F.lit(None).cast("timestamp")
    return targets.withColumn("__loaded", seen).withColumn("__deleted", gone)


def find_orphans(
    references: DataFrame,
    ref_columns: Sequence[str],
    targets: DataFrame,
    key_columns: Sequence[str],
    *,
    match: str = "simple",
    keep: Sequence[str] = (),
    same: Sequence[tuple[str, str]] = (),
    ref_time: str | None = None,
    loaded: str | None = None,
    deleted: str | None = None,
) -> DataFrame:
    """Rows of ``references`` without an available target: ``keep`` columns, ``null_mask`` and ``kind``.

    ``same`` names further (reference, target) columns that must be equal and are never null, e.g. a table name
    when several relations are checked in one pass.
    """
    if match not in MATCHES:
        raise ValueError(f"match must be one of {MATCHES}")
    if len(ref_columns) != len(key_columns) or not ref_columns:
        raise ValueError("ref_columns and key_columns must pair up")
    k = len(ref_columns)
    refs = references.select(
        *[F.col(c).alias(f"__keep_{i}") for i, c in enumerate(keep)],
        *[_key(c).alias(f"__r{i}") for i, c in enumerate(ref_columns)],
        *[F.col(a).alias(f"__s{i}") for i, (a, _) in enumerate(same)],
        (F.col(ref_time) if ref_time else F.lit(_NEVER).cast("timestamp")).alias("__at"),
    )
    mask = sum((F.when(F.col(f"__r{i}").isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i in range(k)), F.lit(0))
    refs = refs.withColumn("__mask", mask)
    rows = _availability(targets, loaded, deleted).select(
        *[_key(c).alias(f"__r{i}") for i, c in enumerate(key_columns)],
        *[F.col(b).alias(f"__s{i}") for i, (_, b) in enumerate(same)],
        "__loaded",
        "__deleted",
    )
    outs = []
    names = [f"__keep_{i}" for i in range(len(keep))]
    for m in range((1 << k) - 1):
        group = refs.where(F.col("__mask") == m)
        if m and match == "simple":
            continue
        if m and match == "full":
            outs.append(group.select(*names, F.lit(m).alias("null_mask"), F.lit("missing").alias("kind")))
            continue
        outs.append(_orphans_of_mask(group, rows, k, m, len(same), names))
    out = outs[0]
    for other in outs[1:]:
        out = out.unionByName(other)
    return out.select(*[F.col(f"__keep_{i}").alias(c) for i, c in enumerate(keep)], "null_mask", "kind")


def _orphans_of_mask(group: DataFrame, rows: DataFrame, k: int, mask: int, n_same: int, names: list[str]) -> DataFrame:
    on = [f"__r{i}" for i in range(k) if not mask >> i & 1] + [f"__s{i}" for i in range(n_same)]
    here = rows
    for i in range(k):
        if not mask >> i & 1:
            here = here.where(F.col(f"__r{i}").isNotNull())
    spans = here.groupBy(*on, "__deleted").agg(F.min("__loaded").alias("__loaded"))
    summary = spans.groupBy(*on).agg(
        F.min("__loaded").alias("__first"),
        F.min(F.when(F.col("__deleted").isNull(), F.col("__loaded"))).alias("__open"),
    )
    joined = group.join(summary, on, "left")
    never = F.col("__first").isNull()
    late = F.col("__first") > F.col("__at")
    lasting = F.coalesce(F.col("__open") <= F.col("__at"), F.lit(False))
    doubtful = joined.where(never | late | ~lasting).where(never | F.col("__at").isNotNull())
    kind = F.when(never, "missing").when(late, "late").otherwise("deleted")
    closed = spans.where(F.col("__deleted").isNotNull()).select(
        *[F.col(c).alias(f"{c}t") for c in on], F.col("__loaded").alias("__from"), F.col("__deleted").alias("__to")
    )
    covered = [F.col(c) == F.col(f"{c}t") for c in on] + [F.col("__from") <= F.col("__at"), F.col("__to") > F.col("__at")]
    # The references in doubt are few; those that a withdrawn row covered at their time drop out here.
    left = doubtful.join(closed, covered, "left_anti")
    return left.select(*names, F.lit(mask).alias("null_mask"), kind.alias("kind"))


def orphan_counts(orphans: DataFrame, by: Sequence[str]) -> DataFrame:
    """Number of orphans per group of ``by`` and kind."""
    return orphans.groupBy(*by, "kind").agg(F.count("*").alias("n_orphans"))
