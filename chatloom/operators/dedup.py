"""Exact first-wins dedup, in batch and against the keys of earlier runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mark_duplicates(records: DataFrame, key: str, order: list[str], scope: list[str]) -> DataFrame:
    """Adds is_dup: within a scope every row but the first of its key, by `order`. Null keys are never
    duplicates. The first place of each key comes from an aggregation that combines before its shuffle
    and is joined back, so a key in a third of all rows does not meet in one task."""
    # A single column keeps the aggregation hash-based; a struct has to be sorted.
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    names = [*scope, key]
    firsts = records.where(F.col(key).isNotNull()).groupBy(*names).agg(F.min(place).alias("_first"))
    joined = records.join(firsts, names, "left") if not scope else _null_safe_join(records, firsts, names)
    return joined.withColumn("is_dup", F.col(key).isNotNull() & ~place.eqNullSafe(F.col("_first"))).select(*records.columns, "is_dup")


def _null_safe_join(records: DataFrame, firsts: DataFrame, names: list[str]) -> DataFrame:
    renamed = firsts.select(*(F.col(n).alias(f"_{n}") for n in names), "_first")
    on = [records[n].eqNullSafe(renamed[f"_{n}"]) for n in names]
    return records.join(renamed, on, "left")


def new_only(records: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """The rows whose key no earlier run has kept."""
    return records.join(seen.select(key).distinct(), key, "left_anti")
