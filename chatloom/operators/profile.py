"""Profiling and reporting: surveys, inventories, manifests, histograms and top lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variant as V
from ..functions.text import dedup_key, multiset_digest, path_suffix, redact
from .validate import REJECTS, reason_group, schema_family

# Keys tried for a preview, in order.
PREVIEW_KEYS = ("text", "content", "messages", "conversations", "instruction", "prompt", "question", "input", "output", "response", "answer", "code")
LOW_RECORDS = 500


def survey_rows(rows: DataFrame, raw: str, by: list[str], order: list[str], sample: int = 3) -> DataFrame:
    """Per group: sampled rows, sorted distinct top-level keys, family and a redacted preview of the
    first row that parses. rows hold one JSON text a row."""
    from .windows import head

    first = head(rows, sample, order, by).withColumn("_v", V.parse(F.col(raw))).withColumn("_keys", F.json_object_keys(raw))
    shown = F.coalesce(*(F.when(V.key(F.col("_v"), k).isNotNull(), V.text_of(V.key(F.col("_v"), k))) for k in PREVIEW_KEYS))
    found = first.groupBy(*by).agg(
        F.count("*").alias("sampled"),
        F.count_if(F.col("_v").isNull()).alias("errors"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_keys")))).alias("keys"),
        F.min_by(shown, F.struct(*order)).alias("_shown"),
    )
    return found.withColumn("family", schema_family(F.col("keys"))).withColumn("preview", redact(F.substring("_shown", 1, 400))).drop("_shown")


def family_vote(files: DataFrame, by: list[str], family: str = "family", order: str = "file_ord") -> DataFrame:
    """The most frequent family of each group; of equally frequent ones the first seen."""
    counted = files.groupBy(*by, family).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return counted.groupBy(*by).agg(F.max_by(family, F.struct(F.col("n"), -F.col("first"))).alias(family), F.sum("n").alias("files"))


def key_union(rows: DataFrame, raw: str, by: list[str]) -> DataFrame:
    keys = rows.select(*by, F.explode(F.json_object_keys(raw)).alias("key")).distinct()
    return keys.groupBy(*by).agg(F.array_sort(F.collect_list("key")).alias("keys"))


def histogram(df: DataFrame, *by: str, top: int | None = None) -> DataFrame:
    """Counts, most frequent first (ties by value) if a top is asked for."""
    counts = df.groupBy(*by).agg(F.count("*").alias("n"))
    return counts.orderBy(F.col("n").desc(), *by).limit(top) if top else counts


def suffix_histogram(paths: DataFrame, path: str = "path", top: int = 8) -> DataFrame:
    return histogram(paths.select(path_suffix(F.col(path)).alias("suffix")), "suffix", top=top)


def inventory(datasets: DataFrame, by: str, records: str, size: str, low: int = LOW_RECORDS) -> DataFrame:
    """datasets, records, bytes and a LOW flag per category; unknown record counts stay unknown."""
    out = datasets.groupBy(by).agg(F.count("*").alias("datasets"), F.sum(records).alias("records"), F.sum(size).alias("bytes"))
    return out.withColumn("flag", F.when(F.coalesce("records", F.lit(0)) < low, "LOW").otherwise(""))


def size_gaps(datasets: DataFrame, logged: str, on_disk: str, factor: float = 1.35) -> DataFrame:
    """Datasets of which the log claims much more than the disk holds, largest gap first."""
    return datasets.where(F.col(logged) > factor * F.col(on_disk)).withColumn("gap", F.col(logged) - F.col(on_disk)).orderBy(F.col("gap").desc())


def merged_hits(hits: DataFrame, key: str, value: str, reason: str) -> DataFrame:
    """Several hits of a candidate as one: the largest value, and the sorted union of reasons."""
    return hits.groupBy(key).agg(F.max(value).alias(value), F.array_sort(F.collect_set(reason)).alias("reasons"), F.count("*").alias("hits"))


def status_counters(log: DataFrame, by: list[str], action: str = "action", size: str = "bytes") -> DataFrame:
    return log.groupBy(*by).agg(F.count_if(F.col(action) == "ok").alias("ok"), F.count_if(F.col(action) == "skipped").alias("skipped"), F.count_if(F.col(action) == "failed").alias("failed"), F.coalesce(F.sum(F.when(F.col(action) == "ok", F.col(size))), F.lit(0)).alias("bytes"))


def skip_histogram(log: DataFrame, reason: str = "reason") -> DataFrame:
    return histogram(log.select(reason_group(F.col(reason)).alias("reason")), "reason")


def manifest(annotated: DataFrame, by: list[str]) -> DataFrame:
    """Counters of every group and a fingerprint of the accepted records that no order changes."""
    return annotated.groupBy(*by).agg(
        F.count("*").alias("raw"),
        F.count_if(F.col("reject").isNull()).alias("accepted"),
        F.count_if(F.col("split") == "train").alias("train"),
        F.count_if(F.col("split") == "val").alias("val"),
        *(F.count_if(F.col("reject") == r).alias(r) for r in REJECTS),
        multiset_digest(F.when(F.col("reject").isNull(), F.col("dedup_key"))).alias("fingerprint"),
    )


def with_total(df: DataFrame, by: str, *sums: str) -> DataFrame:
    """Sums per group and a TOTAL row, in one pass."""
    out = df.rollup(by).agg(*(F.sum(c).alias(c) for c in sums), F.grouping(by).alias("_all"))
    return out.withColumn(by, F.when(F.col("_all") == 1, "TOTAL").otherwise(F.col(by))).drop("_all")


def longest_and_shortest(df: DataFrame, length: str, name: str, n: int = 20) -> DataFrame:
    """The n longest (ties: name descending) and n shortest (name ascending) rows: side, length, name.
    Each side keeps its n best rows a partition and merges those."""
    some = df.select(F.col(length).alias("length"), F.col(name).alias("name"))
    long = some.orderBy(F.col("length").desc(), F.col("name").desc()).limit(n).withColumn("side", F.lit("longest"))
    short = some.orderBy(F.col("length"), F.col("name")).limit(n).withColumn("side", F.lit("shortest"))
    return long.unionByName(short)
