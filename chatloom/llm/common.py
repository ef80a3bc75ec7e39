"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed, ensure_checkpoint_dir, table  # noqa: F401


def fresh(name: str, *taken: list[str]) -> str:
    """A column name like `name` that none of the given lists has, whatever its case."""
    used = {c.lower() for columns in taken for c in columns}
    while name.lower() in used:
        name += "_"
    return name


def named(column: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def ascii_lower_bytes(text: Column) -> Column:
    """Equal for texts that are equal but for the case of A-Z, and only for these; ASCII is kept as it is.

    Each UTF-8 byte becomes one Latin-1 character, which is then lower-cased. That changes lead bytes
    of two-byte sequences too, but their number of continuation bytes still tells them apart, so no
    two texts fall together. translate() would do the same at twenty times the price.
    """
    return F.lower(F.decode(text.cast("binary"), "ISO-8859-1"))


def let(value: Column, body) -> Column:
    """body(x) with x bound to the value, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def wide_hash(*cols: Column) -> list[Column]:
    """Two independent 64-bit hashes: at trillions of keys one alone would collide."""
    return [F.xxhash64(*cols), F.xxhash64(F.lit(7919), *cols)]


def mapped(df: DataFrame, keep: list[str], text_col: str, run, made: dict[str, Column]) -> DataFrame:
    """df.mapInArrow(run) over the columns `keep` and the text as the last one, under plain names; the result
    has `keep` and a column of the given type for each name in `made`, whatever the names."""
    plain, new = [f"c{i}" for i in range(len(keep))], [f"m{i}" for i in range(len(made))]
    kept = df.select(*(named(c).alias(p) for c, p in zip(keep, plain)), named(text_col).alias("text"))
    schema = kept.drop("text").select("*", *(kind.alias(n) for kind, n in zip(made.values(), new))).schema

    def renamed(batches):
        for batch in run(batches):
            yield batch.rename_columns([*plain, *new])

    return kept.mapInArrow(renamed, schema).toDF(*keep, *made)
