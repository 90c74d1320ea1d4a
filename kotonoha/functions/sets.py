"""Algebra of small arrays taken as sets; order of first occurrence is kept where it matters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ordered_distinct(items: Column) -> Column:
    return F.array_distinct(items)


def missing_from(known: Column, seen: Column) -> Column:
    """Sorted elements of ``known`` that aren't in ``seen``."""
    return F.sort_array(F.array_except(known, seen))


def is_subset(part: Column, whole: Column) -> Column:
    return F.size(F.array_except(part, whole)) == 0


def same_set(a: Column, b: Column) -> Column:
    return F.sort_array(F.array_distinct(a)) == F.sort_array(F.array_distinct(b))


def add_once(items: Column, item: Column) -> Column:
    """``items`` with ``item`` at the end unless it is there; a null array counts as empty."""
    own = F.coalesce(items, F.array().cast("array<string>"))
    return F.when(F.array_contains(own, item), own).otherwise(F.concat(own, F.array(item)))
