"""Visually identical text with different characters.

Look-alike-mapped values are grouped in SQL under the accent-sensitive collation ``UNICODE``, which settles composed
and separate accents; each class gets one canonical member by a fixed rule, joined back to its records.

The mapping (width forms, radicals, invisible characters, blanks, look-alike letters) is a ``translate`` inside
codegen. The collation takes some marks of rare scripts for equal or for nothing, doesn't sort several marks on one letter and
takes digits and numbers of all scripts for equal, so two exact checks stand beside it in the key: a hash of the
accent-free skeleton, equal for canonically equal texts, and for texts with such marks (``odd``, a property of
the whole class) a hash of the composed form, made in Arrow batches. So a class is canonical equivalence of mapped texts, over all of Unicode.

Most texts stand alone. A first pass moves two hashes for each text and keeps the skeletons that several spellings have;
only texts of those are grouped under the collation. The skeletons are broadcast while they are at most ``BROADCAST_KEYS``
(counted, 16 bytes each), else joined by shuffle.

The canonical member is the member that the mapping leaves as it is, if any, else any member; ties go to the text
smallest by code point. The first member is the one with the smallest id.

Cases: null texts are no members; '' and texts of only invisible characters form one class per field; repeated rows
of one id and text count once; an id may occur in several classes if its rows differ; very long texts are compared
whole; an empty table gives no rows; other columns are ignored, whatever their names. Classes are aggregated map-side, so a class with
a third of all rows shuffles little; the join back splits a hot class by AQE, as the class side has one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.staging import Stage
from .forms import looks_same_batch, looks_same_sql, odd, skeleton_sql

COLLATION = "UNICODE"
BROADCAST_KEYS = 500_000


def _mapped(texts: DataFrame, id_column: str, text: str, by: tuple[str, ...]) -> DataFrame:
    """(by_0.., id, text, mapped, exact): mapped texts; ``exact`` is 0 but for odd ones."""
    rows = texts.where(F.col(text).isNotNull()).select(*[F.col(c).alias(f"by_{i}") for i, c in enumerate(by)], F.col(id_column).alias("id"), F.col(text).alias("text"))
    rows = rows.withColumn("plain", looks_same_sql(F.col("text")))
    rows = rows.withColumn("composed", looks_same_batch(F.when(odd(F.col("plain")), F.col("text"))))
    exact = F.when(F.col("composed").isNotNull(), F.xxhash64("composed")).otherwise(F.lit(0).cast("long"))
    keys = [F.coalesce("composed", "plain").alias("mapped"), exact.alias("exact")]
    return rows.select(*[f"by_{i}" for i in range(len(by))], "id", "text", *keys)


def _grouped(texts: DataFrame, id_column: str, text: str, by: tuple[str, ...], stage: Stage | None) -> tuple[DataFrame, DataFrame]:
    """Rows with their class key (``alone`` where no other text shares the skeleton), and one row for each class of several spellings."""
    own = [f"by_{i}" for i in range(len(by))]
    rows = _mapped(texts, id_column, text, by).withColumn("skeleton", F.xxhash64(skeleton_sql(F.col("mapped"))))
    spelled = F.xxhash64("text")
    stage = stage or Stage(texts.sparkSession, "lookalike")
    hashes = rows.groupBy(*own, "skeleton").agg(F.min(spelled).alias("a"), F.max(spelled).alias("b")).where("a <> b").select(*own, "skeleton")
    several = stage.write(hashes, "several")
    known = several.withColumn("together", F.lit(True))
    if several.count() <= BROADCAST_KEYS:
        known = F.broadcast(known)
    rows = rows.join(known, [*own, "skeleton"], "left").withColumn("form", F.collate("mapped", COLLATION))
    key = [*own, "skeleton", "exact", "form"]
    changed = F.struct((F.col("mapped") != F.col("text")).alias("changed"), F.col("text").alias("text"))
    classes = rows.where("together").groupBy(*key).agg(F.min(F.struct("id", "text")).alias("first"), F.min(changed).alias("canonical"), (F.min("text") != F.max("text")).alias("differ"))
    return rows, classes.where("differ").select(*key, "first", "canonical")


def differing_members(texts: DataFrame, id_column: str, text: str = "text", by: tuple[str, ...] = (), stage: Stage | None = None) -> DataFrame:
    """(*by, first_id, other_id): records that look like the first of their class but are written differently."""
    rows, classes = _grouped(texts, id_column, text, by, stage)
    own = [f"by_{i}" for i in range(len(by))]
    found = rows.where("together").join(classes, [*own, "skeleton", "exact", "form"]).where((F.col("text") != F.col("first.text")) & (F.col("id") != F.col("first.id")))
    return found.select(*[F.col(o).alias(c) for o, c in zip(own, by)], F.col("first.id").alias("first_id"), F.col("id").alias("other_id")).distinct()


def canonical_texts(texts: DataFrame, id_column: str, text: str = "text", by: tuple[str, ...] = (), stage: Stage | None = None) -> DataFrame:
    """(*by, id_column, canonical_text) for every record; same-looking texts come out as equal strings."""
    rows, classes = _grouped(texts, id_column, text, by, stage)
    own = [f"by_{i}" for i in range(len(by))]
    together = rows.where("together").join(classes, [*own, "skeleton", "exact", "form"], "left").select(*own, "id", F.coalesce("canonical.text", "text").alias("to"))
    out = together.unionByName(rows.where("together is null").select(*own, "id", F.col("text").alias("to")))
    return out.select(*[F.col(o).alias(c) for o, c in zip(own, by)], F.col("id").alias(id_column), F.col("to").alias("canonical_text")).distinct()


def looks_equal(a: Column, b: Column) -> Column:
    """Whether two texts look the same."""
    return looks_same_batch(a) == looks_same_batch(b)
