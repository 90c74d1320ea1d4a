"""Joins with earlier output: reuse, upsert, latest per key, and the difference of two snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key with the greatest ``order``. ``max_by`` aggregates before the shuffle, so a hot key stays small."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("__row")).select("__row.*")


def as_of(df: DataFrame, keys: Sequence[str], loaded: Column, deleted: Column, moment: Column) -> DataFrame:
    """The rows known at a moment: of each key the one loaded last by then (of equal times the one deleted last or not at all), unless it was
    withdrawn by then."""
    known = df.withColumn("__at", loaded).withColumn("__gone", deleted).withColumn("__moment", moment).where(F.col("__at") <= F.col("__moment"))
    last = latest(known.withColumn("__left", F.coalesce("__gone", F.lit(9_000_000_000_000_000_000))), keys, ["__at", "__left"])
    return last.where(F.col("__gone").isNull() | (F.col("__gone") > F.col("__moment"))).drop("__at", "__gone", "__moment", "__left")


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``existing`` with the rows of ``new`` in place of those of the same key."""
    return existing.join(new.select(*keys), list(keys), "left_anti").unionByName(new)


def reuse(current: DataFrame, previous: DataFrame, keys: Sequence[str], same: Sequence[str], carry: Sequence[str], valid: Column | None = None) -> DataFrame:
    """``current`` with ``carry`` from the previous row of the same key and ``reused``: true where the ``same`` columns agree and
    ``valid`` (over the previous columns, prefixed ``previous_``) holds. Rows not reused have nulls, to be computed anew; filter
    before a model sees them. ``previous`` must be unique by key (see ``latest``)."""
    columns = dict.fromkeys([*same, *carry])
    old = previous.select(*keys, *[F.col(c).alias(f"previous_{c}") for c in columns], F.lit(True).alias("__had"))
    joined = current.join(old, list(keys), "left")
    good = F.coalesce(F.col("__had"), F.lit(False))
    for c in same:
        good = good & F.col(c).eqNullSafe(F.col(f"previous_{c}"))
    if valid is not None:
        good = good & F.coalesce(valid, F.lit(False))
    out = joined.withColumn("reused", good)
    kept = [F.when(F.col("reused"), F.col(f"previous_{c}")).alias(c) for c in carry]
    return out.select(*[c for c in current.columns if c not in carry], *kept, "reused")


def snapshot_diff(before: DataFrame, after: DataFrame, keys: Sequence[str], material: Sequence[str], other: Sequence[str] = ()) -> DataFrame:
    """Full outer join of two snapshots: keys, status, changed columns, and whether any of the ``material`` ones changed.

    A row on one side only is material. Nulls compare as values.
    """
    columns = [*material, *other]
    a = before.select(*keys, *[F.col(c).alias(f"__a_{c}") for c in columns], F.lit(1).alias("__in_a"))
    b = after.select(*keys, *[F.col(c).alias(f"__b_{c}") for c in columns], F.lit(1).alias("__in_b"))
    joined = a.join(b, list(keys), "full_outer")
    differs = lambda c: ~F.col(f"__a_{c}").eqNullSafe(F.col(f"__b_{c}"))
    both = F.col("__in_a").isNotNull() & F.col("__in_b").isNotNull()
    changed = F.array_compact(F.array(*[F.when(both & differs(c), F.lit(c)) for c in columns]))
    hit = ~both
    for c in material:
        hit = hit | differs(c)
    status = F.when(F.col("__in_a").isNull(), "added").when(F.col("__in_b").isNull(), "removed").when(F.size(changed) > 0, "changed").otherwise("same")
    return joined.select(*keys, status.alias("status"), changed.alias("changed"), hit.alias("material"))


def transition(current: Column, wanted: Column, edges: dict[str, Sequence[str]]) -> Column:
    """``wanted`` if the step is allowed or none is taken; anything else raises."""
    allowed = current == wanted
    for a, bs in edges.items():
        allowed = allowed | ((current == a) & wanted.isin(*bs))
    return F.when(allowed, wanted).otherwise(F.raise_error(F.concat(F.lit("no step from "), current, F.lit(" to "), wanted)))


def duplicate_groups(df: DataFrame, key: str, id_column: str) -> DataFrame:
    """(key, n, first_id) of the keys that several rows have; the members are joined back by key, never gathered."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"), F.min(id_column).alias("first_id")).where("n > 1")


def chain(start: DataFrame, *steps: tuple[DataFrame, str, str, str]) -> DataFrame:
    """Left joins along references: each step is (table, reference column, key column, flag). The flag says whether the row was found."""
    out = start
    for other, ref, key, flag in steps:
        side = other.withColumnRenamed(key, ref).withColumn(flag, F.lit(True))
        out = out.join(side, ref, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
    return out


def bad_regions(regions: DataFrame, parent: str, start: str, end: str, length: Column | None = None) -> DataFrame:
    """Regions that end before they begin, overlap the one before, or reach past the end of their parent."""
    from pyspark.sql import Window

    before = F.lag(end).over(Window.partitionBy(parent).orderBy(start, end))
    overlap = F.coalesce(F.col(start) < before, F.lit(False))
    backward = F.coalesce(F.col(end) < F.col(start), F.lit(False))
    beyond = F.coalesce(F.col(end) > length, F.lit(False)) if length is not None else F.lit(False)
    kinds = F.array_compact(F.array(F.when(backward, "backward"), F.when(overlap, "overlap"), F.when(beyond, "beyond")))
    return regions.withColumn("problems", kinds).where(F.size("problems") > 0)
