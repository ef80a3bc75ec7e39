"""Exhaustive mixing: every row of every dataset exactly once, interleaved in proportion.

Datasets are ordered by size. With s the smallest size, a dataset of n rows has whole = max(1, n // s);
its first whole * s rows are spread evenly over the mix, the rest follows dataset by dataset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import ordinals


def mix_plan(sizes: DataFrame, name: str = "dataset", size: str = "n") -> DataFrame:
    """One row a dataset: n, ratio, whole, whole_rows, extra, rank and the totals of the mix."""
    every = Window.partitionBy(F.lit(0))  # one row a dataset: small whatever the corpora
    planned = sizes.select(F.col(name).alias("dataset"), F.col(size).cast("long").alias("n")).withColumn("smallest", F.min("n").over(every))
    full = planned.withColumn("whole", F.greatest(F.lit(1), F.expr("n div nullif(smallest, 0)")))
    full = full.withColumn("whole_rows", F.col("whole") * F.col("smallest")).withColumn("extra", F.col("n") - F.col("whole_rows"))
    totals = full.withColumn("whole_total", F.sum("whole_rows").over(every)).withColumn("extra_total", F.sum("extra").over(every))
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("n").desc(), F.col("dataset"))
    return totals.withColumn("rank", F.row_number().over(order) - 1).withColumn("ratio", F.col("n") / F.col("smallest")).withColumn("final_total", F.col("whole_total") + F.col("extra_total"))


def check_plan(plan: DataFrame) -> None:
    """Raises if there is no dataset, a name twice, or an empty dataset."""
    r = plan.agg(F.count("*").alias("rows"), F.countDistinct("dataset").alias("names"), F.min("n").alias("least")).first()
    if not r["rows"]:
        raise ValueError("no datasets to mix")
    if r["rows"] != r["names"]:
        raise ValueError("dataset names must be unique")
    if not r["least"]:
        raise ValueError("the smallest dataset is empty")


def jitter(seed: int, *cols: Column) -> Column:
    """A number in [0, 1) from a hash, so that the same seed gives the same order on any engine."""
    text = F.concat(F.lit(f"{seed}|"), *[x for c in cols for x in (c.cast("string"), F.lit("|"))])
    return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def mixed(rows: DataFrame, plan: DataFrame, dataset: str, order: list[str], seed: int = 42) -> DataFrame:
    """Adds `part` ('whole' or 'extra') and `mix_key`, by which the mix is sorted: in the whole part
    (position + jitter) / whole_rows, so each dataset is spread over (0, 1); extras come after.
    Jitter is less than a place, so every dataset, and a single one as a whole, keeps its own order."""
    small = F.broadcast(plan.select(F.col("dataset").alias(dataset), "n", "whole_rows", "rank"))  # one row a dataset
    placed = ordinals(rows, "_ord", [dataset], order).join(small, dataset)
    inside = F.col("_ord") < F.col("whole_rows")
    early = (F.col("_ord") + jitter(seed, F.col(dataset), F.col("_ord"))) / F.col("whole_rows")
    late = 2 + F.col("rank") + F.col("_ord") / F.col("n")
    return placed.withColumn("part", F.when(inside, "whole").otherwise("extra")).withColumn("mix_key", F.when(inside, early).otherwise(late)).select(*rows.columns, "part", "mix_key")


def positions(mix: DataFrame, name: str = "position") -> DataFrame:
    """The mix with the place of each row in it, from 1."""
    return ordinals(mix, name, [], ["mix_key"]).withColumn(name, F.col(name) + 1)


def write_order(mix: DataFrame) -> DataFrame:
    """The mix in its order over range partitions; files in partition order are the mixed corpus."""
    return mix.repartitionByRange("mix_key").sortWithinPartitions("mix_key")


def conservation(mix: DataFrame, plan: DataFrame, key: list[str]) -> DataFrame:
    """expected, actual and distinct rows, and whether all agree."""
    want = plan.agg(F.max("final_total").alias("expected")).withColumn("one", F.lit(1))
    have = mix.agg(F.count("*").alias("actual"), F.count_distinct(*key).alias("distinct_rows")).withColumn("one", F.lit(1))
    return want.join(have, "one").drop("one").withColumn("ok", (F.col("expected") == F.col("actual")) & (F.col("actual") == F.col("distinct_rows")))


def concatenated(*parts: tuple[str, DataFrame]) -> DataFrame:
    """A bag union of corpora that keeps which part, and so which order, a row came from."""
    out = None
    for i, (name, df) in enumerate(parts):
        one = df.withColumn("part_no", F.lit(i)).withColumn("part_name", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out
