"""Paths as Spark's readers take and report them.

Readers take glob patterns, so a name with brackets or braces must be escaped, and they report
`_metadata.file_path` as a URI, in which spaces and other signs are encoded.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What is known of each block is broadcast up to this number of blocks.
BROADCAST_BLOCKS = 200_000


def escaped(path: str) -> str:
    """A path that a reader takes literally."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def decoded(uri: Column) -> Column:
    """The path that a reported URI names; '+' stands for itself there."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def file_path() -> Column:
    """The decoded path of the file that a row was read from."""
    return decoded(F.col("_metadata.file_path"))


def bare(path: str) -> str:
    """The path without scheme and authority; a relative one is taken from the working directory."""
    found = re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?(/.*)$", path)
    return (found[1] if found else os.path.abspath(path)).rstrip("/")


def below(path: Column, root: str) -> Column:
    """The part of a path below root, without a leading slash."""
    plain = F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?(?=/)", "")
    return F.substring(plain, F.lit(len(bare(root)) + 2), F.length(plain))


def in_order(relative: Column) -> Column:
    """A text that sorts as the path does component by component: a directory before its longer namesakes."""
    return F.translate(relative, "/", "\x01")


def any_case(suffixes: tuple[str, ...]) -> str:
    """A file name pattern for names with one of the suffixes, in any case."""
    letters = lambda s: "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in s)
    return "{" + ",".join("*" + letters(s) for s in suffixes) + "}"


def text_rows(spark: SparkSession, path: str | list[str], pattern: str | None = None, separator: str | None = None) -> DataFrame:
    """file_path, block, place, value: the pieces of text files between line ends, or between separators. Pieces
    of a file are in order by (block, place), where block is the offset of the split that a task read in order and
    place grows inside it by one a row. Nothing is shuffled."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if separator:
        reader = reader.option("lineSep", separator)
    return reader.text(path).select(file_path().alias("file_path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"), "value")


def numbered(rows: DataFrame) -> DataFrame:
    """rows (file_path, block, place, ...) with line_no, the place in the file from 0, instead of block and place. The
    first place and the number of rows of each block are read beforehand, one row a block, and joined: no row
    is shuffled unless there are more than BROADCAST_BLOCKS. line_no does not depend on how files are split; if the two
    scans are split in different ways, the job fails rather than lose a row."""
    counts = rows.groupBy("file_path", "block").agg(F.min("place").alias("_first"), F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("file_path").orderBy("block"))
    before = counts.select("file_path", "block", "_first", "_n", (upto - F.col("_n")).alias("_before"))
    small = len(rows.inputFiles()) + rows.rdd.getNumPartitions() <= BROADCAST_BLOCKS  # at most that many blocks
    joined = rows.join(F.broadcast(before) if small else before, ["file_path", "block"], "left")
    local = F.col("place") - F.col("_first")
    odd = F.raise_error(F.lit("the files were split in another way between two scans")).cast("long")
    line_no = F.when((local >= 0) & (local < F.col("_n")), F.col("_before") + local).otherwise(odd)
    return joined.withColumn("line_no", line_no).select("file_path", "line_no", *(c for c in rows.columns if c not in ("file_path", "block", "place")))


def readable(text: Column) -> Column:
    """Text without the bytes that are no UTF-8."""
    return F.when(F.is_valid_utf8(text), text).otherwise(F.replace(F.make_valid_utf8(text), F.lit("\ufffd"), F.lit("")))
