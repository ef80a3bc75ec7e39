"""Order-sensitive operators: heads, budgets, carried sections, first k of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed

#: Bounds among which a byte budget looks for its end.
BOUNDS = 256


def head(rows: DataFrame, n: int, order: list, by: list[str] | None = None) -> DataFrame:
    """The first n rows of each group by `order`; Spark stops sorting a group at n rows.
    Without groups it is a top-n without a global sort."""
    if not by:
        return rows.orderBy(*order).limit(n)
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def ranged(rows: DataFrame, *order: str | Column) -> DataFrame:
    """rows range-partitioned by `order`, with the number of their partition in `_part`, written to the
    checkpoint folder. Range bounds are sampled and adaptive execution folds partitions, so whoever
    reads the partitions twice must read them from one place."""
    return checkpointed(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))


def ordinals(rows: DataFrame, name: str, by: list[str], order: list[str | Column]) -> DataFrame:
    """Adds each row's place in its group, from 0; without groups, its place among all rows. Two
    levels, so that a group in most of the rows is spread: range partitions number their own rows of
    a group, and the counts of earlier partitions, one row a partition and group, are added. Rows
    equal in `order` are numbered in any order."""
    parts = ranged(rows, *by, *order)
    local = F.row_number().over(Window.partitionBy("_part", *by).orderBy(*order))
    counts = parts.groupBy("_part", *by).agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*by).orderBy("_part"))
    before = counts.select(F.col("_part").alias("_p"), *(F.col(c).alias(f"_by_{c}") for c in by), (upto - F.col("_n")).alias("_before"))
    numbered = parts.withColumn("_local", local)
    same = numbered["_part"] == before["_p"]
    for c in by:
        same = same & numbered[c].eqNullSafe(before[f"_by_{c}"])
    return numbered.join(before, same).withColumn(name, F.col("_before") + F.col("_local") - 1).select(*rows.columns, name)


def _enough(rows: DataFrame, budget: int, order: list[str], size: Column) -> DataFrame:
    """The rows up to a bound in order[0] that hold the budget, nearly the least: all of them if they hold less. Only
    the order's first column is read to find BOUNDS bounds, and sizes are summed in slices that grow until they suffice;
    the filters reach the scan, so files in order are read no further."""
    first = order[0]
    parts = rows.select(first).repartitionByRange(BOUNDS, first).groupBy(F.spark_partition_id().alias("part"))
    bounds = [r["upto"] for r in parts.agg(F.max(first).alias("upto")).where("upto is not null").orderBy("upto").collect()]  # BOUNDS rows at most
    total, at, step, low = 0, 0, 1, None
    while at + step < len(bounds):
        at += step
        high = F.col(first) <= F.lit(bounds[at - 1])
        slice_ = rows.where(high | F.col(first).isNull() if low is None else high & (F.col(first) > F.lit(low)))
        total += slice_.agg(F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()[0]
        low = bounds[at - 1]
        if total >= budget:
            return rows.where((F.col(first) <= F.lit(low)) | F.col(first).isNull())
        step *= 2
    return rows


def byte_budget(rows: DataFrame, budget: int, order: list[str], size: Column) -> DataFrame:
    """The rows written until the budget is reached: those whose preceding rows sum to less than it.

    A prefix of the rows that holds the budget is found first, and only that is read on. Then a global prefix
    sum in two levels: rows are range-partitioned by `order`, and partitions that start within the budget are
    summed inside and get the totals of earlier partitions, one row a partition, added. Adds `bytes` and
    `cum_bytes` (inclusive). Rows equal in `order` are taken in any order."""
    sized = ranged(_enough(rows, budget, order, size).withColumn("bytes", size.cast("long")), *order)
    totals = sized.groupBy("_part").agg(F.sum("bytes").alias("_total"))
    upto = F.sum("_total").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0))
    before = totals.select("_part", (upto - F.col("_total")).alias("_before")).where(F.col("_before") < budget)
    local = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = sized.join(F.broadcast(before), "_part").withColumn("cum_bytes", F.col("_before") + F.sum("bytes").over(local))  # one row a partition
    return out.where(F.col("cum_bytes") - F.col("bytes") < budget).select(*rows.columns, "bytes", "cum_bytes")


def ordered_digest(rows: DataFrame, line: Column, by: list[str], order: list[str], size: int = 1024, levels: int | None = None, open_top: bool = False) -> DataFrame:
    """by, n_lines, digest: a Merkle tree over the lines of each group in order. SHA-256 digests of lines are joined and
    hashed in runs of `size` ranks, and the runs' digests again, `levels` times (as often as the largest group needs,
    unless given). It tells any change, loss or swap of lines, and does not depend on partitions; lines equal in order are
    put in the order of their digests. Nulls are last; a null line counts and has a rank, but adds no digest, and a run of
    null lines only has none either. No task holds more than `size` digests of a group at a time. With fewer levels than
    the largest group needs it fails, unless `open_top`: then the last level joins all that the others leave, one digest for
    each size ** (levels - 1) lines, so any number of lines has a digest in so many levels."""
    nulls_last = [F.col(c).asc_nulls_last() for c in (*order, "_h")]
    numbered = ordinals(rows.select(*by, *order, F.sha2(line, 256).alias("_h")), "_n", by, nulls_last).select(*by, "_n", "_h")
    level = checkpointed(numbered)
    counts = level.groupBy(*by).agg(F.count("*").alias("n_lines"))
    if levels is None:
        largest, levels = counts.agg(F.max("n_lines")).first()[0] or 1, 1
        while size**levels < largest:
            levels += 1
    for at in range(levels):
        run = F.lit(0).cast("long") if open_top and at == levels - 1 else F.floor(F.col("_n") / size)
        runs = level.groupBy(*by, run.alias("_run")).agg(F.array_sort(F.collect_list(F.struct("_n", "_h"))).alias("_l"))
        digests = F.filter(F.transform("_l", lambda x: x["_h"]), lambda h: h.isNotNull())
        level = runs.select(*by, F.col("_run").alias("_n"), F.when(F.size(digests) > 0, F.sha2(F.array_join(digests, ""), 256)).alias("_h"))
    tops = level.groupBy(*by).agg(F.min_by("_h", "_n").alias("digest"), F.count("*").alias("_tops"))
    whole = F.when(F.col("_tops") == 1, F.col("digest")).otherwise(F.raise_error(F.lit("more lines than the levels hold")))
    named = tops.select(*(F.col(c).alias(f"_by_{c}") for c in by), whole.alias("digest"))
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return counts.join(named, same).select(*by, "n_lines", "digest")


def carried(rows: DataFrame, value: Column, name: str, by: list[str], order: list[str]) -> DataFrame:
    """Adds the last non-null value at or before each row of its group: section headings of a file. A segmented
    scan in two levels, so that a group in most of the rows is spread: range partitions carry their own
    values, and the last value of earlier partitions, one row a partition and group, goes on below."""
    parts = ranged(rows.withColumn("_value", value), *by, *order)
    place = F.struct(*order)
    lasts = parts.groupBy("_part", *by).agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), place)).alias("_last"))
    earlier = F.last("_last", ignorenulls=True).over(Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    above = lasts.select(F.col("_part").alias("_p"), *(F.col(c).alias(f"_by_{c}") for c in by), earlier.alias("_above"))
    local = Window.partitionBy("_part", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    known = parts.withColumn("_own", F.last("_value", ignorenulls=True).over(local))
    same = known["_part"] == above["_p"]
    for c in by:
        same = same & known[c].eqNullSafe(above[f"_by_{c}"])
    return known.join(above, same).withColumn(name, F.coalesce("_own", "_above")).select(*(c for c in rows.columns if c != name), name)


def last_index(messages: Column, who: str = "user") -> Column:
    """The index of the last turn of a role, or -1."""
    at = F.transform(messages, lambda m, i: F.when(m["role"] == who, i).otherwise(F.lit(-1)))
    return F.coalesce(F.array_max(at), F.lit(-1))
