"""Corpus formatting end to end: raw lines to annotated records, with every reject counted once."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import message
from ..functions.variant import lenient
from ..operators.adapters import FILE_MODES, adapted_record, file_conversations
from ..operators.validate import annotate
from ..operators.windows import ordinals
from ..sources import corpus_source


def formatted(raw: DataFrame, order: list[str], scope: list[str] | None = None, exclusions: DataFrame | None = None, max_records: int | None = None, file_modes: dict[str, str] | None = None, read_datasets: Callable[..., DataFrame] | None = None, **limits) -> DataFrame:
    """raw: lines `raw` with lineage columns. Excluded datasets (dataset, reason) are left out.
    max_records: the first accepted records of each dataset. file_modes: datasets each of whose files is one
    record, which stands in the place of the file's first row; read_datasets reads such datasets alone, else raw is
    read once more for each mode. Of repeated JSON keys the last counts, for which a
    setting of the session is made."""
    lenient(raw.sparkSession)
    rows = raw if exclusions is None else raw.join(exclusions.select("dataset"), "dataset", "left_anti")
    whole = F.coalesce(F.col("dataset").isin(*file_modes), F.lit(False)) if file_modes else F.lit(False)
    # a generator, as Spark would copy the whole expression into each part of a union
    read = (rows.where(~whole) if file_modes else rows).select("*", F.inline(F.array(adapted_record(F.col("raw"))))).withColumnRenamed("reject", "_early")
    for mode in sorted(set((file_modes or {}).values())):
        names = tuple(sorted(d for d, m in file_modes.items() if m == mode))
        own = read_datasets(names) if read_datasets else rows.where(F.col("dataset").isin(*names))
        if read_datasets and exclusions is not None:
            own = own.join(exclusions.select("dataset"), "dataset", "left_anti")
        by = [c for c in ("category", "dataset", "file_path", "file_order") if c in rows.columns]
        inside = [c for c in order if c not in by]
        made = file_conversations(own, by, inside, mode)
        blank = {c: F.lit(0).cast(rows.schema[c].dataType).alias(c) if c in inside else F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns if c not in by}
        read = read.unionByName(made.select(*by, *blank.values(), "messages", F.when(F.col("messages").isNull(), "unsupported_schema").alias("_early")))
    out = annotate(read, order, scope, early="_early", **limits)
    if max_records is None:
        return out
    taken = ordinals(out.withColumn("_ok", F.col("reject").isNull()), "_n", ["dataset", "_ok"], order)
    return taken.where(~F.col("_ok") | (F.col("_n") < max_records)).drop("_n", "_ok")


def formatted_tree(spark: SparkSession, root: str, exclusions: DataFrame | None = None, max_records: int | None = None, file_modes: dict[str, str] | None = None, **limits) -> DataFrame:
    """All data files below <root>/<category>/<owner>__<name>/ to annotated records: duplicates are those of a
    category, the first in the order of files and lines stays. file_modes: FILE_MODES unless given."""
    modes = FILE_MODES if file_modes is None else file_modes
    return formatted(corpus_source.records(spark, root), corpus_source.ORDER, ["category"], exclusions, max_records, modes, lambda names: corpus_source.records(spark, root, names), **limits)


def conversations(rows: DataFrame, group: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns as rows to one canonical conversation a group, in order."""
    turns = rows.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")))).alias("turns"))
    return turns.select(group, F.transform("turns", lambda t: message(t["role"], t["text"])).alias("messages"))


def strict_keys(annotated: DataFrame, seed: int = 42) -> DataFrame:
    """Adds strict_key, the 16-byte BLAKE2b digest of the record's canonical JSON, byte for byte as
    Python's json.dumps writes it with sorted keys. An Arrow UDF: no SQL function has that digest."""
    @F.pandas_udf("string")
    def digest(messages: pd.Series) -> pd.Series:
        def one(turns) -> str:
            payload = {"seed": seed, "messages": [{"role": t["role"], "content": t["content"]} for t in turns]}
            return hashlib.blake2b(json.dumps(payload, ensure_ascii=False, sort_keys=True).encode(), digest_size=16).hexdigest()

        return messages.map(one)

    return annotated.withColumn("strict_key", digest("messages"))


def canonical_json(annotated: DataFrame) -> DataFrame:
    """Adds `line`, the record as Python's json.dumps writes it (spaces after ', ' and ': ')."""
    @F.pandas_udf("string")
    def dump(messages: pd.Series) -> pd.Series:
        return messages.map(lambda turns: json.dumps({"messages": [{"role": t["role"], "content": t["content"]} for t in turns]}, ensure_ascii=False))

    return annotated.withColumn("line", dump("messages"))
