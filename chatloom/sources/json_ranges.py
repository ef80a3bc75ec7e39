"""Whole-file JSON of any size, read by many tasks: a parallel structural scan.

Spark reads a file in pieces that end at '},' and splits it into blocks at any of them, inside a text or
not. A first pass sums each block up under both assumptions: whether an odd number of quotes ends in it,
and by how much it nests deeper if it starts outside a text, or inside one. A running sum over the blocks
of a file, one row each, tells where every block really starts. The second pass then cuts each block at
the commas of the outermost list. Elements inside a block are rows at once; of those that reach over
blocks only the fragments are shuffled and joined.

A file whose first sign is '[' gives one row an element, any other file is one record. A file that does
not parse as a whole gives no record, as json.load gives none: bad_files() names it. Empty files are
bad; an empty list has no rows. A file without '},' is one block, read by one task.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.variant import parse
from . import paths

SEPARATOR = "},"

_ESCAPE = re.compile(r"\\.", re.S)
_STRING_END = re.compile(r'(?:[^"\\]|\\.)*"', re.S)
_SIGNS = re.compile(r'"(?:[^"\\]|\\.)*(?:"|\Z)|[\[\]{},]', re.S)

# kinds of rows that the second pass gives
WHOLE, HEAD, MIDDLE, TAIL, BAD, CLOSED = range(6)


def _nesting(text: str) -> int:
    return text.count("{") + text.count("[") - text.count("}") - text.count("]")


def _blocks(batches, columns: int):
    """(key, start, pieces) for each block of a task: its pieces in order, with the separators between them."""
    key, pieces, start = None, [], None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:2] != key:
                if key is not None:
                    yield key, start, pieces
                key, start, pieces = row[:2], row[2:columns], []
            # the first piece of a file follows no separator
            pieces.append(row[columns] if key[1] == 0 and not pieces else SEPARATOR + row[columns])
    if key is not None:
        yield key, start, pieces


def summary(pieces: list[str]) -> tuple[bool, int, int, str]:
    """(whether the quotes are odd, nesting if the block starts outside a text, nesting if inside, first sign)."""
    odd, outside, inside, first = 0, 0, 0, ""
    for piece in pieces:
        parts = (_ESCAPE.sub("", piece) if "\\" in piece else piece).split('"')
        even_depth, odd_depth = _nesting("".join(parts[::2])), _nesting("".join(parts[1::2]))
        outside += odd_depth if odd else even_depth
        inside += even_depth if odd else odd_depth
        odd ^= (len(parts) - 1) & 1
        first = first or piece.lstrip()[:1]
    return bool(odd), outside, inside, first


def cut(pieces: list[str], first: bool, in_string: bool, depth: int, listed: bool):
    """(kind, text) of a block that starts in the given state: see the kinds above. Of a file that is no list
    every block is a fragment of the one record."""
    if not listed:
        yield (TAIL if first else MIDDLE), "".join(pieces)
        return
    if not first and depth <= 0:  # after the list: only white space may follow
        if "".join(pieces).strip():
            yield BAD, ""
        return
    held: list[str] = []
    started = False  # whether the element that `held` belongs to began in this block
    any_cut = closed = False
    for piece in pieces:
        at = since = 0
        if in_string:
            end = _STRING_END.match(piece)
            if end is None:
                held.append(piece)
                continue
            at, in_string = end.end(), False
        for sign in _SIGNS.finditer(piece, at):
            c = sign[0]
            if c[0] == '"':
                in_string = sign.end() == len(piece) and (len(c) == 1 or _STRING_END.fullmatch(c[1:]) is None)
            elif c in "[{":
                depth += 1
                if depth == 1:  # the list itself
                    if closed or c == "{" or "".join(held).strip() or piece[since : sign.start()].strip():
                        yield BAD, ""
                    since, started, held = sign.end(), True, []
            else:
                if c != ",":
                    depth -= 1
                if depth == 0 or c == "," and depth == 1:
                    text = "".join([*held, piece[since : sign.start()]])
                    ends = c != ","
                    if ends and c != "]" or closed:
                        yield BAD, ""
                    elif not (ends and first and not any_cut and not text.strip()):  # not an empty list
                        yield (WHOLE if started else HEAD), text
                    held, since, started, any_cut = [], sign.end(), True, True
                    closed = closed or ends
                    if ends:
                        yield CLOSED, ""
                elif depth < 0:
                    yield BAD, ""
        held.append(piece[since:])
    rest = "".join(held)
    if closed:
        if rest.strip():
            yield BAD, ""
    else:
        yield (TAIL if started else MIDDLE), rest


_FIXED = "file_path string, block long"


def _pieces(spark: SparkSession, path: str | list[str], pattern: str | None) -> DataFrame:
    rows = paths.text_rows(spark, path, pattern, SEPARATOR)
    return rows.select("file_path", "block", paths.readable(F.col("value")).alias("value"))


def block_starts(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """file_path, block, in_string, depth, listed: the state in which each block starts."""

    def run(batches):
        for key, _, pieces in _blocks(batches, 2):
            yield pa.record_batch([pa.array([x]) for x in (*key, *summary(pieces))], ["file_path", "block", "odd", "outside", "inside", "first"])

    states = _pieces(spark, path, pattern).mapInArrow(run, f"{_FIXED}, odd boolean, outside long, inside long, first string")
    before = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(F.col("odd").cast("int")).over(before), F.lit(0)) % 2 == 1
    known = states.withColumn("in_string", inside).withColumn("step", F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside")))
    sign = F.first(F.nullif("first", F.lit("")), ignorenulls=True).over(Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return known.select("file_path", "block", "in_string", F.coalesce(F.sum("step").over(before), F.lit(0)).cast("int").alias("depth"), F.coalesce(sign == "[", F.lit(False)).alias("listed"))


def _cut_rows(spark: SparkSession, path: str | list[str], pattern: str | None) -> DataFrame:
    """file_path, block, place, kind, listed, raw of all blocks."""
    starts = block_starts(spark, path, pattern)
    few = len(spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern or "*").text(path).inputFiles())
    pieces = _pieces(spark, path, pattern)
    small = few + pieces.rdd.getNumPartitions() <= paths.BROADCAST_BLOCKS  # at most that many blocks
    # Both scans are split alike, or the row says so: no block may be lost.
    joined = pieces.join(F.broadcast(starts) if small else starts, ["file_path", "block"], "left")
    depth = F.coalesce("depth", F.raise_error(F.lit("the files were split in another way between two scans")).cast("int"))

    def run(batches):
        for (file, block), (in_string, depth, listed), pieces in _blocks(batches, 5):
            found = list(cut(pieces, block == 0, in_string, depth, listed))
            if found:
                kinds, texts = zip(*found)
                n = len(found)
                yield pa.record_batch([pa.array(x) for x in ([file] * n, [block] * n, range(n), kinds, [listed] * n, texts)], ["file_path", "block", "place", "kind", "listed", "raw"])

    ordered = joined.select("file_path", "block", "in_string", depth.alias("depth"), "listed", "value")
    return ordered.mapInArrow(run, f"{_FIXED}, place long, kind long, listed boolean, raw string")


def values(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """file_path, block, place, raw, listed, ok: one row for each element of a list file or for any other whole file, and one
    row that is not ok for what makes a file bad. Order in a file: (block, place)."""
    rows = _cut_rows(spark, path, pattern)
    broken = rows.where(F.col("kind").isin(HEAD, MIDDLE, TAIL))
    number = F.sum((F.col("kind") == TAIL).cast("int")).over(Window.partitionBy("file_path").orderBy("block", "place"))
    part = F.struct("block", "place", "kind", "raw")
    joined = broken.withColumn("number", number).groupBy("file_path", "number").agg(F.array_sort(F.collect_list(part)).alias("parts"), F.bool_or("listed").alias("listed"))
    first, last = F.get("parts", F.lit(0)), F.element_at("parts", -1)
    complete = (first["kind"] == TAIL) & (~F.col("listed") | (last["kind"] == HEAD))
    whole = joined.select("file_path", first["block"].alias("block"), first["place"].alias("place"), F.array_join(F.col("parts.raw"), "").alias("raw"), "listed", complete.alias("ok"))
    inner = rows.where(F.col("kind").isin(WHOLE, BAD)).select("file_path", "block", "place", "raw", "listed", (F.col("kind") == WHOLE).alias("ok"))
    every = inner.unionByName(whole)
    return every.withColumn("ok", F.col("ok") & parse(F.col("raw")).isNotNull())


def bad_files(found: DataFrame) -> DataFrame:
    """The files of values() that do not parse as a whole."""
    return found.where(~F.col("ok")).select("file_path").distinct()


def records(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """file_path, block, place, raw of the files that parse as a whole."""
    found = values(spark, path, pattern)
    return found.join(bad_files(found), "file_path", "left_anti").drop("ok", "listed")
