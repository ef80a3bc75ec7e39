"""Named joins of corpora with their metadata. Small sides are left to Spark's size-based broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_wins(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row a key, the last by `order`, from an aggregation that combines before its shuffle."""
    others = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_r"))
    return best.select(key, *(F.col(f"_r.{c}").alias(c) for c in others))


def reply_pairs(messages: DataFrame, id_col: str, parent_col: str, body: Column, order: list[str]) -> DataFrame:
    """Replies with the message that they answer: question, answer. Blank texts and echoes go; of
    parents with one id the last counts."""
    said = messages.withColumn("_body", body)
    parents = last_wins(said.select(F.col(id_col).alias("_pid"), F.col("_body").alias("question"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]), "_pid", [f"_o{i}" for i in range(len(order))])
    replies = said.where(F.col(parent_col).isNotNull() & (F.col("_body") != ""))
    joined = replies.join(parents, replies[parent_col] == parents["_pid"])
    return joined.where((F.col("question") != "") & (F.col("question") != F.col("_body"))).withColumnRenamed("_body", "answer").drop("_pid", *[f"_o{i}" for i in range(len(order))])


def with_list(left: DataFrame, right: DataFrame, key: str, order: list[str], name: str = "items") -> DataFrame:
    """Left outer join on the right rows of each key, collected in order; an empty list if there are none."""
    others = [c for c in right.columns if c != key]
    lists = right.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*order, *(c for c in others if c not in order)))).alias(name))
    return left.join(lists, key, "left").withColumn(name, F.coalesce(name, F.array().cast(lists.schema[name].dataType)))


def with_default(left: DataFrame, lookup: DataFrame, key: str, value: str, default: str) -> DataFrame:
    return left.join(lookup.select(key, value).dropDuplicates([key]), key, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def missing_from(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right.select(key), key, "left_anti")


def by_expert(corpora: DataFrame, category: str, experts: dict[str, list[str]]) -> DataFrame:
    """Each row once for every expert whose list names its category (or '*')."""
    rows = [(e, c) for e, cs in experts.items() for c in cs]
    lookup = corpora.sparkSession.createDataFrame(rows, f"expert string, {category} string")
    named = corpora.join(F.broadcast(lookup.where(F.col(category) != "*")), category)  # the configured lists
    every = [e for e, cs in experts.items() if "*" in cs]
    if not every:
        return named
    return named.unionByName(corpora.withColumn("expert", F.explode(F.array(*map(F.lit, every)))))


def route(prompt: Column, rules: list[tuple[str, tuple[str, ...]]], default: str) -> Column:
    """The first expert of whose keywords the prompt holds one."""
    low, out = F.lower(prompt), None
    for expert, words in rules:
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(low, F.lit(w))
        out = F.when(hit, expert) if out is None else out.when(hit, expert)
    return out.otherwise(default)


def first_passing(items: Column, passes, otherwise_first: bool = True) -> Column:
    """The first element that passes, else the first."""
    good = F.get(F.filter(items, passes), F.lit(0))
    return F.coalesce(good, F.get(items, F.lit(0))) if otherwise_first else good


def key_values(df: DataFrame, columns: list[str]) -> Column:
    """k=v of all columns that are neither null nor empty, comma-separated, in the given order."""
    parts = [F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.concat(F.lit(f"{c}="), F.col(c).cast("string"))) for c in columns]
    return F.array_join(F.array_compact(F.array(*parts)), ", ")
