"""One source for a directory of datasets: files of every supported kind as rows of raw JSON.

The tree is <root>/<category>/<owner>__<name>/..., as deep as it likes. Files are read by Spark's own
readers, each kind by the reader that it needs, and put together by a union:

* JSON lines (.jsonl, .ndjson, also .gz) in splits, a row a line; blank lines are left out;
* JSON (.json, .json.gz) by the parallel scan of json_ranges, a row an element or file;
* Parquet in row groups and CSV by file, a dataset at a time as each has its own columns.

Every row has `category`, `dataset`, `file_path`, `file_order`, `block`, `line_no` and `raw`. (file_order,
block, line_no) orders them as a walk does that sorts directories component by component and reads each
file from its start: line_no counts the rows of a file, or of a block of a JSON file. No raw text is
shuffled, but for elements of a JSON list that reach over blocks.

Left out are directories '_*' for categories, '.cache' anywhere, names that start with '_' or '.' (Spark's
readers skip them), files that lie outside a dataset's directory, and files of other types; skipped()
names those and the JSON files that do not parse. Bytes that are no UTF-8 are left out of the text.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip
from . import json_ranges, paths
from .readers import DATA_SUFFIXES, file_catalog

LINES, WHOLE, PARQUET, CSV = (".jsonl", ".ndjson", ".jsonl.gz"), (".json", ".json.gz"), (".parquet",), (".csv",)
#: Lines over which a CSV header may go.
HEADER_LINES = 100
COLUMNS = ("category", "dataset", "file_path", "file_order", "block", "line_no", "raw")
ORDER = ["file_order", "block", "line_no"]


def _placed(rows: DataFrame, root: str) -> DataFrame:
    """rows (file_path, block, line_no, raw) below a dataset's directory, with category, dataset and file_order."""
    relative = paths.below(F.col("file_path"), root)
    parts = F.split(relative, "/")
    named = rows.withColumn("_parts", parts).withColumn("file_order", paths.in_order(relative))
    inside = (F.size("_parts") > 2) & ~F.startswith(F.get("_parts", F.lit(0)), F.lit("_")) & ~F.array_contains("_parts", ".cache")
    dataset = F.regexp_replace(F.get("_parts", F.lit(1)), "^(.*?)__", "$1/")
    return named.where(inside).withColumn("category", F.get("_parts", F.lit(0))).withColumn("dataset", dataset).select(*COLUMNS)


def _directory(path: Column, root: str) -> Column:
    """The directory of a dataset: root and two components."""
    inner = F.length(F.array_join(F.slice(F.split(paths.below(path, root), "/"), F.lit(3), F.lit(1 << 20)), "/"))
    return F.substring(path, F.lit(1), F.length(path) - inner - 1)


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    rows = paths.numbered(paths.text_rows(spark, path, paths.any_case(LINES)))
    rows = rows.select("file_path", F.lit(0).cast("long").alias("block"), "line_no", paths.readable(F.col("value")).alias("raw"))
    return rows.where(strip(F.col("raw")) != "")


def _whole(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return json_ranges.records(spark, path, paths.any_case(WHOLE)).withColumnRenamed("place", "line_no")


def _as_json(names: list[str], keys: list[str] | None = None) -> Column:
    """Rows of any columns as JSON, nulls included."""
    columns = [F.col("`" + c.replace("`", "``") + "`").alias(k) for c, k in zip(names, keys or names)]
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}) if columns else F.lit("{}")


def _parquet(spark: SparkSession, directory: str, files: list[str]) -> list[DataFrame]:
    """One read with the union of the files' columns; where they do not fit, one for each schema."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", paths.any_case(PARQUET))
    try:
        tables = [reader.option("mergeSchema", "true").parquet(directory)]
    except Exception as e:  # this error of Spark's is not among PySpark's own
        if "CANNOT_MERGE_SCHEMAS" not in str(e):
            raise
        alike = defaultdict(list)
        for f in files:
            alike[reader.parquet(paths.escaped(f)).schema.json()].append(f)
        tables = [reader.parquet(*map(paths.escaped, own)) for own in alike.values()]
    return [t.select(paths.file_path().alias("file_path"), F.lit(0).cast("long").alias("block"), F.col("_metadata.row_index").alias("line_no"), _as_json(t.columns).alias("raw")) for t in tables]


def _header(spark: SparkSession, file: str, first: str) -> list[str]:
    """The names of a CSV file's columns; a quoted one may go on over the next lines."""
    lines = [first]
    if first.count('"') % 2:
        rows = paths.text_rows(spark, paths.escaped(file)).orderBy("block", "place").limit(HEADER_LINES).collect()
        lines = [r["value"] for r in rows]
    return next(csv.reader(line + "\n" for line in lines), [])


def _csv(spark: SparkSession, directory: str, files: list[str]) -> list[DataFrame]:
    """One read for all files of a dataset that share their first line, as each file has its own header."""
    first = paths.text_rows(spark, directory, paths.any_case(CSV)).where("block = 0").groupBy("file_path").agg(F.min_by(paths.readable(F.col("value")), "place").alias("head"))
    headers = defaultdict(list)
    for r in first.collect():  # one row a file of one dataset
        headers[r["head"]].append(r["file_path"])
    reader = spark.read.option("header", "true").option("multiLine", "true").option("quote", '"').option("escape", '"').option("emptyValue", "")
    out = []
    for head, own in sorted(headers.items(), key=lambda x: min(x[1])):
        keys = _header(spark, min(own), head)
        names = [f"c{i}" for i in range(len(keys))]  # keys may repeat
        t = reader.schema(", ".join(f"{n} string" for n in names)).csv([paths.escaped(f) for f in sorted(own)])
        rows = t.select(paths.file_path().alias("file_path"), F.lit(0).cast("long").alias("block"), F.monotonically_increasing_id().alias("place"), _as_json(names, keys).alias("raw"))
        out.append(paths.numbered(rows).select("file_path", F.lit(0).cast("long").alias("block"), "line_no", "raw"))  # a file is one block
    return out


def records(spark: SparkSession, root: str, datasets: tuple[str, ...] | None = None) -> DataFrame:
    """The raw records of all data files below root, or of some datasets, of which alone the directories are read."""
    files = file_catalog(spark, root, DATA_SUFFIXES).withColumnRenamed("path", "file_path")
    files = _placed(files.select("file_path", *(F.lit(None).cast(k).alias(n) for n, k in (("block", "long"), ("line_no", "long"), ("raw", "string")))), root)
    if datasets is not None:
        files = files.where(F.col("dataset").isin(*datasets))
    # the driver gets the directories of datasets, and the names of files of the kinds that have columns
    low = F.lower("file_path")
    tabular = F.endswith(low, F.lit(PARQUET[0])) | F.endswith(low, F.lit(CSV[0]))
    listed = files.withColumn("directory", _directory(F.col("file_path"), root)).groupBy("directory", F.endswith(low, F.lit(PARQUET[0])).alias("parquet")).agg(F.array_sort(F.collect_list(F.when(tabular, F.col("file_path")))).alias("names")).orderBy("directory", "parquet").collect()
    if not listed:
        return spark.createDataFrame([], "category string, dataset string, file_path string, file_order string, block long, line_no long, raw string")
    top = paths.escaped(root.rstrip("/")) if datasets is None else [paths.escaped(d) for d in sorted({r["directory"] for r in listed})]
    found = [_lines(spark, top), _whole(spark, top)]
    for r in listed:
        if r["names"]:
            found += (_parquet if r["parquet"] else _csv)(spark, paths.escaped(r["directory"]), r["names"])
    return _placed(reduce(DataFrame.unionByName, found), root)


def skipped(spark: SparkSession, root: str) -> DataFrame:
    """file_path and reason of the files that give no record: of an unsupported type, or JSON that does not parse."""
    every = file_catalog(spark, root).withColumnRenamed("path", "file_path")
    known = reduce(lambda a, s: a | F.endswith(F.lower("file_path"), F.lit(s)), DATA_SUFFIXES, F.lit(False))
    other = every.where(~known).select("file_path", F.lit("unsupported file type").alias("reason"))
    bad = json_ranges.bad_files(json_ranges.values(spark, paths.escaped(root.rstrip("/")), paths.any_case(WHOLE)))
    return other.unionByName(bad.select("file_path", F.lit("malformed JSON").alias("reason")))
