"""Contiguous shards of nearly equal bytes, from a global prefix sum of document sizes.

The documents are ordered by (doc_id, input position). Each range partition sums its own
bytes and rows; the driver turns these totals, one row a partition, into offsets; a window
inside each partition adds the local running sum. A document goes to the shard in which the
middle of its byte range falls, so that every cut is at most half a document off its target.

Defined cases: a null text has size `overhead` and crc32 0; a very long text is one document and may
fill a shard by itself; null ids sort first; equal ids are taken in input order; repeated
rows stay separate rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, table


def balanced_shards(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16) -> DataFrame:
    """One row per document: id, size, text_crc32, shard (0..n_shards-1), slot (gapless from 0), position."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    ).withColumn("tie", F.monotonically_increasing_id())
    # The tie column lets equal ids, even a third of all rows, spread over several ranges.
    parts = checkpointed(slim.repartitionByRange("id", "tie").withColumn("part", F.spark_partition_id()))

    totals = parts.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).orderBy("part").collect()
    offsets, nbytes, nrows = [], 0, 0
    for t in totals:
        offsets.append((t["part"], nbytes, nrows))
        nbytes, nrows = nbytes + t["bytes"], nrows + t["rows"]
    # One row a partition: bounded by the number of partitions, not by the data.
    starts = F.broadcast(spark.createDataFrame(offsets, "part int, bytes_before long, rows_before long"))

    w = Window.partitionBy("part").orderBy("id", "tie").rowsBetween(Window.unboundedPreceding, 0)
    placed = parts.join(starts, "part").select(
        "id",
        "size",
        "text_crc32",
        (F.col("bytes_before") + F.sum("size").over(w)).alias("upto"),
        (F.col("rows_before") + F.count("*").over(w) - 1).alias("position"),
    )
    if 2 * nbytes * n_shards >= 2**63:
        raise OverflowError("too many bytes for 64-bit shard arithmetic; use fewer shards")
    shard = F.expr(f"(2 * upto - size) * {n_shards} div {2 * max(nbytes, 1)}")
    placed = checkpointed(placed.select("id", "size", "text_crc32", "position", F.least(shard.cast("int"), F.lit(n_shards - 1)).alias("shard")))
    first = F.broadcast(placed.groupBy("shard").agg(F.min("position").alias("first")))  # n_shards rows
    return placed.join(first, "shard").select("id", "size", "text_crc32", "shard", (F.col("position") - F.col("first")).alias("slot"), "position")


def query(spark, sf_dir) -> DataFrame:
    return balanced_shards(table(spark, sf_dir, "documents"), 40).select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


ORACLE_SQL = """
WITH t AS (SELECT list(list_reduce(list_prepend(i::UBIGINT, range(8)::UBIGINT[]), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END) ORDER BY i) AS crcs FROM range(256) r(i)),
d AS (SELECT doc_id, list_transform(regexp_extract_all(hex(coalesce(text, '')), '..'), lambda h: ('0x' || h)::UBIGINT) AS b FROM documents),
s AS (SELECT doc_id, len(b) + 16 AS size, xor(list_reduce(list_prepend(4294967295::UBIGINT, b), lambda a, x: xor(a >> 8, crcs[(xor(a, x) & 255)::INT + 1])), 4294967295::UBIGINT)::BIGINT AS text_crc32 FROM d, t),
p AS (SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST) AS upto, sum(size) OVER () AS total FROM s),
g AS (SELECT *, least((2 * upto - size) * 40 // (2 * total), 39)::INT AS shard FROM p)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard, (row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST) - 1)::BIGINT AS slot, NULL::INT AS grown_shard FROM g
"""
