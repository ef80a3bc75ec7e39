"""Sinks: corpora as JSON lines by category and split, manifests, samples, cards and lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import human_bytes
from ..operators.validate import license_family, size_bucket
from ..plans.corpus import canonical_json


def corpus_jsonl(annotated: DataFrame, path: str, by: tuple[str, ...] = ("category", "split"), mode: str = "overwrite", order: tuple[str, ...] = ()) -> None:
    """Accepted records as one canonical JSON object a line, in directories by category and split. With an
    order the files of a directory, read in the order of their names, hold the same bytes in every run."""
    kept = canonical_json(annotated.where(F.col("reject").isNull())).withColumnRenamed("line", "value")
    if order:
        kept = kept.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    kept.select("value", *by).write.mode(mode).partitionBy(*by).text(path)


def json_rows(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Manifests, catalogs, surveys, reports: one JSON object a row."""
    df.write.mode(mode).json(path)


def upserted_report(old: DataFrame, new: DataFrame, key: str = "category") -> DataFrame:
    """The old report with the rows of the new one in place of those with the same key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def sampled_jsonl(rows: DataFrame, path: str, info: DataFrame, raw: str = "raw") -> None:
    rows.select(F.col(raw).alias("value")).write.mode("overwrite").text(f"{path}/sample")
    info.write.mode("overwrite").json(f"{path}/sample_info")


def new_ids(found: DataFrame, listed: DataFrame, key: str = "id") -> DataFrame:
    """Ids that a list file does not have yet, in order, to be appended."""
    return found.select(key).distinct().join(listed.select(key), key, "left_anti").orderBy(key)


def card(title: Column, license_id: Column, records: Column, size: Column, body: Column) -> Column:
    """A dataset card: YAML front matter with license family and size bucket, then the body."""
    return F.concat(
        F.lit("---\nlicense: "), license_family(license_id), F.lit("\nsize_categories:\n- "), size_bucket(records), F.lit("\n---\n\n# "), title, F.lit("\n\n"), F.format_string("%,d records, ", records.cast("long")), human_bytes(size), F.lit("\n\n"), body, F.lit("\n")
    )


def markdown_table(df: DataFrame, max_rows: int = 1000) -> str:
    """A small aggregate as a markdown table; refuses what is not small."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} rows: aggregate before reporting")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    return "\n".join([*lines, *("| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows)]) + "\n"
