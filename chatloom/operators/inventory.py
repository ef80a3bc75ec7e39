"""Inventories of downloaded datasets: sizes, record counts, field names, formats, caches and status."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import variant as V
from ..functions.text import path_suffix, strip
from ..session import checkpointed
from ..sources import heads, json_ranges, paths, readers
from ..sources.sinks import markdown_table


def directory_sizes(catalog: DataFrame, directory: Column) -> DataFrame:
    """files and bytes of each directory of a file catalog; a directory without files has no row."""
    return catalog.groupBy(directory.alias("directory")).agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))


def has_files(catalog: DataFrame) -> bool:
    return not catalog.limit(1).isEmpty()


def format_histogram(catalog: DataFrame, by: Column) -> DataFrame:
    """For each group a map from suffix to count, and the suffixes by descending count."""
    counts = catalog.groupBy(by.alias("dataset"), path_suffix(F.col("path")).alias("suffix")).agg(F.count("*").alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "suffix", "n")))
    return counts.groupBy("dataset").agg(ordered.alias("o")).select("dataset", F.map_from_entries(F.transform("o", lambda x: F.struct(x["suffix"], x["n"]))).alias("formats"), F.transform("o", lambda x: x["suffix"]).alias("suffixes"))


def _lines(spark: SparkSession, files: list[str], header: int = 0) -> DataFrame:
    """Lines that are not blank, less the header, by file."""
    some = F.count_if(strip(paths.readable(F.col("value"))) != "")
    return paths.text_rows(spark, files).groupBy("file_path").agg(F.greatest(some - header, F.lit(0)).alias("records"))


def _whole_json(spark: SparkSession, files: list[str]) -> DataFrame:
    """The elements of a list, or of the first list among an object's values (null: it has none). What does not parse is
    counted by lines."""
    found = json_ranges.values(spark, files)
    v = V.parse(F.col("raw"))
    inner = F.transform(F.json_object_keys("raw"), lambda k: F.try_variant_get(v, F.concat(F.lit("$['"), k, F.lit("']")), "array<variant>"))
    first = F.get(F.filter(inner, lambda x: x.isNotNull()), F.lit(0))
    records = F.when(F.bool_and("listed"), F.count("*")).otherwise(F.max(F.when(~F.col("listed"), F.when(first.isNotNull(), F.size(first)))))
    by_file = found.groupBy("file_path").agg(F.bool_and("ok").alias("ok"), records.cast("long").alias("n"))
    lines = _lines(spark, files).withColumnRenamed("records", "lines")
    return by_file.join(lines, "file_path").select("file_path", F.when(F.col("ok"), F.col("n")).otherwise(F.col("lines")).alias("records"))


#: How records of a suffix are counted: file_path and records, from a session and literal paths; add your own. A file without
#: a row counts 0, one with null is not counted.
COUNTERS = {
    ".jsonl": _lines,
    ".ndjson": _lines,
    ".json": _whole_json,
    # without columns the footers alone are read
    ".parquet": lambda spark, files: spark.read.parquet(*files).groupBy(paths.file_path().alias("file_path")).agg(F.count("*").alias("records")),
    ".csv": lambda spark, files: _lines(spark, files, 1),
}


def record_counts(spark: SparkSession, catalog: DataFrame, files: int = 10_000) -> DataFrame:
    """file_path and records for every file of a catalog that can be counted; other files have no row, so a dataset with
    nothing countable sums to null. Lines that are not blank count for JSON lines and, but for the header, for CSV;
    Parquet and Arrow files are counted by their metadata. Spark's readers take paths from the driver: they come in
    parts of at most `files` paths, each counted and written before the next is listed."""
    listed = checkpointed(catalog.select("path").distinct().withColumn("_part", F.pmod(F.xxhash64("path"), F.lit(max(1, -(-2 * catalog.count() // files))))))
    out = heads.arrow_counts(listed.where(F.endswith(F.lower("path"), F.lit(".arrow")))).withColumnRenamed("path", "file_path")
    for part in sorted(r["_part"] for r in listed.select("_part").distinct().collect()):
        own_part = listed.where(F.col("_part") == part)
        found = sorted(r["path"] for r in own_part.collect())
        for suffix, count in COUNTERS.items():
            own = [p for p in found if p.lower().removesuffix(".gz").endswith(suffix)]
            if own:
                counted = count(spark, [paths.escaped(p) for p in own]).select(F.col("file_path").alias("_of"), F.col("records").alias("_n"))
                every = spark.createDataFrame([(p,) for p in own], "file_path string").join(counted, F.col("file_path") == F.col("_of"), "left")
                records = F.when(F.col("_of").isNull(), F.lit(0)).otherwise(F.col("_n")).cast("long")
                out = out.unionByName(checkpointed(every.select("file_path", records.alias("records")).where("records is not null")))
    return out


def row_count(df: DataFrame) -> int:
    """From parquet footers where the source can, by spark.sql.parquet.aggregatePushdown."""
    return df.count()


def field_names(spark: SparkSession, path: str) -> list[str]:
    """The fields of the first data file's first record, sorted; none for other types. Only the head of the file is read."""
    low = path.lower()
    if low.endswith(".parquet"):
        return sorted(spark.read.parquet(paths.escaped(path)).columns)
    if heads.by_arrow(path):
        rows = heads.first_records(spark.createDataFrame([(path,)], "path string"), 1)
    else:
        rows = readers.whole_json(spark, paths.escaped(path)) if low.endswith((".json", ".json.gz")) else readers.jsonl(spark, paths.escaped(path), 1)
    first = rows.where("line_no = 0").select(F.json_object_keys("raw").alias("k")).first()
    return sorted(first["k"] or []) if first else []


def pruned(files: DataFrame, limit: int, size: str = "size") -> tuple[DataFrame, DataFrame]:
    """Files within the limit, and those that a clean-up would remove. Nothing is deleted."""
    over = F.coalesce(F.col(size) > limit, F.lit(False))
    return files.where(~over), files.where(over)


def metadata_cache(spark: SparkSession, path: str, reasons: str = "reasons") -> DataFrame:
    """Cached search results, a JSON list: only the entries that passed their gate."""
    rows = spark.read.option("multiLine", "true").json(path)
    return rows.where(F.coalesce(F.size(reasons), F.lit(0)) == 0) if reasons in rows.columns else rows


def with_cached(plan: DataFrame, cache: DataFrame, key: str, columns: list[str], source: str = "meta_source") -> DataFrame:
    """Metadata from the cache where it has the key; `source` says 'cache' or 'lookup'."""
    named = cache.select(key, *(F.col(c).alias(f"_{c}") for c in columns), F.lit(True).alias("_hit")).dropDuplicates([key])
    joined = plan.join(named, key, "left")
    out = joined.withColumn(source, F.when(F.col("_hit"), "cache").otherwise("lookup"))
    for c in columns:
        out = out.withColumn(c, F.coalesce(F.col(f"_{c}"), F.col(c)) if c in plan.columns else F.col(f"_{c}"))
    return out.drop("_hit", *(f"_{c}" for c in columns))


def only_text(df: DataFrame, messages: str = "messages") -> bool:
    """Whether the contents of the first record that has messages are texts."""
    kind = df.schema[messages].dataType.simpleString()
    if not kind.startswith("array<struct<"):
        return False
    first = df.where(F.size(messages) > 0).select(F.forall(messages, lambda m: F.typeof(m["content"]).isin("string") & m["content"].isNotNull()).alias("ok")).first()
    return first is None or bool(first["ok"])


def logged(line: str, path: str) -> None:
    """Appends a line with a UTC time stamp; a single write, so that lines of several processes don't mix."""
    stamp = datetime.now(timezone.utc).isoformat(timespec="seconds")
    with open(path, "a", encoding="utf-8") as f:
        f.write(f"{stamp} {' '.join(line.splitlines())}\n")


def report(title: str, tables: dict[str, DataFrame]) -> str:
    """A markdown report of small aggregates."""
    return f"# {title}\n\n" + "\n".join(f"## {name}\n\n{markdown_table(df)}" for name, df in tables.items())


def status(counters: dict, path: str | None = None, previous: dict | None = None) -> dict:
    """Counters with a UTC time stamp and, beside them, an earlier estimate; written as JSON if a path is given."""
    out = counters | {"updated": datetime.now(timezone.utc).isoformat(timespec="seconds")} | ({"earlier_estimate": previous} if previous else {})
    if path:
        with open(path, "w", encoding="utf-8") as f:
            json.dump(out, f, indent=1, sort_keys=True)
    return out
