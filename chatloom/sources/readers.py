"""File sources: every reader tags its rows with file_path and line_no, which give a stable order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import dataset_id, path_name, path_suffix, size_bytes, strip
from ..functions.variant import parse
from . import heads, json_ranges, paths

# Suffixes of data files, and of those that a survey also looks at.
DATA_SUFFIXES = (".jsonl.gz", ".json.gz", ".jsonl", ".ndjson", ".json", ".parquet", ".csv")
SURVEY_SUFFIXES = (*DATA_SUFFIXES, ".arrow", ".txt", ".parquet.gz")


def file_catalog(spark: SparkSession, root: str, suffixes: tuple[str, ...] | None = None, skip: tuple[str, ...] = (".cache",), max_bytes: int | None = None) -> DataFrame:
    """path, size, suffix of the files below root; contents are not read. Directories in `skip` are left out, and so are empty
    files, which no read of Spark's lists."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths.escaped(root)).select("path", F.col("length").alias("size"))
    below = files.withColumn("suffix", path_suffix(F.col("path")))
    for d in skip:
        below = below.where(~F.contains("path", F.lit(f"/{d}/")))
    if suffixes is not None:
        ends = F.lit(False)
        for s in suffixes:
            ends = ends | F.endswith(F.lower("path"), F.lit(s))
        below = below.where(ends)
    return below if max_bytes is None else below.where(F.col("size") <= max_bytes)


def skipped_files(catalog: DataFrame) -> DataFrame:
    """Files that no reader takes, with the reason."""
    name = F.lower(path_name(F.col("path")))
    known = F.lit(False)
    for suffix in DATA_SUFFIXES:
        known = known | F.endswith(name, F.lit(suffix))
    return catalog.where(~known).withColumn("reason", F.lit("unsupported file type"))


def jsonl(spark: SparkSession, path: str | list[str], limit: int | None = None) -> DataFrame:
    """file_path, line_no, raw of non-blank lines; .gz is opened, invalid bytes are left out. Bad lines stay, to be
    counted. Lines are numbered without a shuffle (paths.numbered)."""
    rows = paths.numbered(paths.text_rows(spark, path)).select("file_path", "line_no", paths.readable(F.col("value")).alias("raw")).where(strip(F.col("raw")) != "")
    return rows if limit is None else rows.where(F.col("line_no") < limit)


def whole_json(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Whole-file JSON of any size: file_path, line_no, raw, a row for each element of a list and one for any other value.
    A file that does not parse is one malformed row."""
    found = json_ranges.values(spark, path)
    bad = json_ranges.bad_files(found).select("file_path", F.lit(0).cast("long").alias("line_no"), F.lit('{"__malformed__": "a file that does not parse"}').alias("raw"))
    place = F.row_number().over(Window.partitionBy("file_path").orderBy("block", "place")) - 1  # of narrow rows only
    good = found.join(bad.select("file_path"), "file_path", "left_anti")
    numbers = good.select("file_path", "block", "place", place.cast("long").alias("line_no"))
    rows = good.join(numbers, ["file_path", "block", "place"]).select("file_path", "line_no", F.to_json(F.try_parse_json("raw")).alias("raw"))
    return rows.unionByName(bad)


def array_or_lines(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """A file whose first sign is '[' is one list, any other JSON lines. With a limit only the heads of the files are read,
    where tasks can open them; else the heads tell how each file is read. The driver gets the files' names, as it does
    for every read of Spark's."""
    files = file_catalog(spark, path)
    opened = heads.by_arrow(path)
    if limit is not None and opened:
        return heads.first_records(_lines_or_lists(files), limit).select(F.col("path").alias("file_path"), "line_no", "raw")
    if opened:
        known = heads.list_files(files)
    else:
        lines = paths.text_rows(spark, paths.escaped(path)).where(F.trim("value") != "")
        known = lines.groupBy(F.col("file_path").alias("path")).agg(F.min_by(F.startswith(F.ltrim("value"), F.lit("[")), F.struct("block", "place")).alias("listed"))
    found = {True: [], False: []}
    for r in known.collect():  # one row a file
        found[r["listed"]].append(paths.escaped(r["path"]))
    rows = spark.createDataFrame([], "file_path string, line_no long, raw string")
    if found[False]:
        rows = rows.unionByName(jsonl(spark, found[False]))
    if found[True]:
        rows = rows.unionByName(whole_json(spark, found[True]))
    return rows if limit is None else rows.where(F.col("line_no") < limit)


def _lines_or_lists(files: DataFrame) -> DataFrame:
    """Without the binary kinds, which are neither."""
    binary = F.lower("path")
    return files.where(~F.endswith(binary, F.lit(".parquet")) & ~F.endswith(binary, F.lit(".arrow")) & ~F.endswith(binary, F.lit(".csv")))


def tolerant(rows: DataFrame) -> DataFrame:
    """Only the rows that parse."""
    return rows.where(parse(F.col("raw")).isNotNull())


def csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Header CSV, all columns text, quoted line ends allowed."""
    return spark.read.option("header", "true").option("multiLine", "true").option("quote", '"').option("escape", '"').option("inferSchema", "false").csv(path)


def parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return paths.numbered(paths.text_rows(spark, path)).select("file_path", "line_no", F.col("value").alias("text"))


def sample(rows: DataFrame, n: int = 3) -> DataFrame:
    """The first n rows of each file."""
    return rows.where(F.col("line_no") < n)


def tagged(rows: DataFrame, root: str) -> DataFrame:
    """Adds category and dataset from <root>/<category>/<owner>__<name>/..., without '_*' directories."""
    rel = F.regexp_replace("file_path", f"^.*{root.rstrip('/').rsplit('/', 1)[-1]}/", "")
    cat, ds = F.split_part(rel, F.lit("/"), F.lit(1)), F.split_part(rel, F.lit("/"), F.lit(2))
    return rows.withColumn("category", cat).withColumn("dataset", dataset_id(ds)).where(~F.startswith("category", F.lit("_")) & ~F.startswith(ds, F.lit("_")))


def source_list(lines: DataFrame) -> DataFrame:
    """Markdown lists '- owner/name ... size' below '## category': id, category, declared_bytes; the first of an id wins."""
    w = Window.partitionBy("file_path").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    section = F.nullif(F.regexp_extract("text", r"^##\s+(.+?)\s*$", 1), F.lit(""))
    item = F.nullif(F.regexp_extract("text", r"^\s*[-*]\s+`?([A-Za-z0-9][A-Za-z0-9._-]*/[A-Za-z0-9._-]+)", 1), F.lit(""))
    rows = lines.withColumn("category", F.last(section, ignorenulls=True).over(w)).withColumn("id", item).withColumn("declared_bytes", size_bytes(F.col("text"))).where("id is not null")
    return rows.groupBy("id").agg(F.min_by(F.struct("category", "declared_bytes"), F.struct("file_path", "line_no")).alias("r")).select("id", "r.category", "r.declared_bytes")


def id_list(lines: DataFrame) -> DataFrame:
    """Ids one a line below '## category' or 'category: x'; '#' starts a comment; repeated ids stay."""
    w = Window.partitionBy("file_path").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    heading = F.coalesce(F.nullif(F.regexp_extract("text", r"^##\s+(.+?)\s*$", 1), F.lit("")), F.nullif(F.regexp_extract("text", r"^category:\s*(.+?)\s*$", 1), F.lit("")))
    item = F.nullif(F.regexp_extract("text", r"^\s*(?:[-*]\s+)?([A-Za-z0-9][A-Za-z0-9._-]*/[A-Za-z0-9._-]+)\s*(?:#.*)?$", 1), F.lit(""))
    return lines.withColumn("category", F.last(heading, ignorenulls=True).over(w)).withColumn("id", item).where("id is not null").select("id", "category", "file_path", "line_no")


def run_log(lines: DataFrame) -> DataFrame:
    """'OK id bytes ...' lines as id, bytes; the last of an id wins."""
    parts = F.split(F.trim("text"), r"\s+")
    ok = lines.where(F.get(parts, F.lit(0)) == "OK").select(F.get(parts, F.lit(1)).alias("id"), F.get(parts, F.lit(2)).try_cast("long").alias("bytes"), "line_no")
    return ok.groupBy("id").agg(F.max_by("bytes", "line_no").alias("bytes"))


def file_bodies(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file_path and whole text of files, to be joined to a catalog."""
    return spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("body"))


def with_hash(files: DataFrame, content: str = "content") -> DataFrame:
    return files.withColumn("sha256", F.sha2(F.col(content), 256))


def is_priority(path: Column, prefixes: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | F.startswith(path, F.lit(p))
    return out


def priority_walk(files: DataFrame, prefixes: tuple[str, ...], limit: int | None = None, path: str = "path") -> DataFrame:
    """Files in priority directories first, then by path, and at most `limit` of them."""
    ranked = files.withColumn("priority", is_priority(F.col(path), prefixes)).orderBy(F.col("priority").desc(), F.col(path))
    return ranked if limit is None else ranked.limit(limit)
