"""Filter interaction audit: what each filter removes in every order in which the filters may run.

Lattice-edge aggregation. A document is reduced to the set of filters that it fails (5 bits), its part
and two label flags; equal ones are counted first. Each count then contributes to the 80 edges
(filters already applied, next filter) of the subset lattice, and every one of the 120 orders is a path
of five edges: the 600 (order, step) pairs, a table of fixed size, are joined to the aggregated edges.
No document meets another but by hash: the first id of each text is an aggregation combined before
its shuffle, joined back, so neither a hot text nor a hot part meets in one task. Texts are read
once and never shuffled.

Defined cases: a null text is empty; a null source is the part ''; an empty text is under 200 words,
holds no capital and no sign, and its word variety is not below half. A null doc_id is neither
smaller nor larger than another, so it passes E and spoils no one else, and has no labels. Rows that
repeat id and text pass E together, as no id is smaller. Labels that repeat a doc_id: one row of 1 suffices.
Very long texts are read whole. Parts are whatever values occur; an empty table gives an empty
result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import checkpointed, let, table, wide_hash

FILTERS = "ABCDE"
MIN_WORDS = 200
WORD_BREAK = r"[\x20\x09-\x0D]+"
SIGNS = r"[#$%&*|]"


def content_failures(text: Column) -> Column:
    """The filters A to D that a text fails, as bits 1, 2, 4 and 8."""
    bit = lambda fails, value: F.when(fails, F.lit(value)).otherwise(F.lit(0))

    def by_words(words: Column) -> Column:
        n = F.size(words).cast("long")
        return bit(n < MIN_WORDS, 1) + bit(F.lit(100) * F.size(F.array_distinct(words)).cast("long") < F.lit(50) * n, 2)

    shouts = F.lit(100) * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > F.lit(2) * F.length(text).cast("long")
    return let(F.array_remove(F.split(text, WORD_BREAK), ""), by_words) + bit(shouts, 4) + bit(F.rlike(text, F.lit(SIGNS)), 8)


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (a bit for each filter that the row fails, A the lowest), good, toxic: one row per document.
    What is left of the texts, some 50 bytes a row, is written to the checkpoint folder, as it is read twice."""
    text = F.coalesce(F.col("text"), F.lit(""))
    part = F.coalesce(F.col("source").cast("string"), F.lit(""))
    narrow = checkpointed(docs.select("doc_id", part.alias("part"), content_failures(text).alias("content"), *(h.alias(n) for h, n in zip(wide_hash(text), ("h1", "h2")))))
    first = narrow.groupBy("h1", "h2").agg(F.min("doc_id").alias("first_id"))
    is_one = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(c)
    flags = labels.where("doc_id is not null").groupBy("doc_id").agg(is_one("quality"), is_one("toxic"))
    repeated = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    joined = narrow.join(first, ["h1", "h2"]).join(flags, "doc_id", "left")
    return joined.select("part", (F.col("content") + F.when(repeated, 16).otherwise(0)).alias("mask"), F.coalesce("quality", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def edges(failed: DataFrame) -> DataFrame:
    """One row per part and lattice edge (applied, next): the counts of that step, and shapley, the removed of
    all edges of the part with that next filter, each times the orders that pass along it."""
    kinds = failed.groupBy("part", "mask", "good", "toxic").agg(F.count("*").alias("n"))
    k = len(FILTERS)
    along = lambda s: factorial(s.bit_count()) * factorial(k - 1 - s.bit_count())
    lattice = [F.struct(F.lit(s).alias("applied"), F.lit(1 << f).alias("next"), F.lit(along(s)).alias("orders")) for s in range(2**k) for f in range(k) if not s >> f & 1]
    spread = kinds.select("*", F.inline(F.array(*lattice)))
    earlier, fails = (F.col("mask").bitwiseAND(F.col("applied")) != 0), (F.col("mask").bitwiseAND(F.col("next")) != 0)
    counted = {
        "kept": ~earlier & ~fails,
        "removed": ~earlier & fails,
        "redundant": earlier & fails,
        "unique_fails": F.col("mask") == F.col("next"),
        "good_lost": ~earlier & fails & F.col("good"),
        "toxic_lost": ~earlier & fails & F.col("toxic"),
    }
    counts = spread.groupBy("part", "applied", "next", "orders").agg(*(F.sum(F.when(rule, F.col("n")).otherwise(F.lit(0))).cast("long").alias(name) for name, rule in counted.items()))
    over = F.sum(F.col("removed") * F.col("orders")).over(Window.partitionBy("part", "next"))
    return counts.withColumn("shapley", over.cast("long")).drop("orders")


def paths(spark: SparkSession) -> DataFrame:
    """filter_order, step, applied, next: every order as a path through the lattice, 600 rows."""
    rows = []
    for order in permutations(range(len(FILTERS))):
        for step, f in enumerate(order, 1):
            rows.append(("".join(FILTERS[i] for i in order), step, sum(1 << i for i in order[: step - 1]), 1 << f))
    return spark.createDataFrame(rows, "filter_order string, step int, applied int, next int")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    steps = edges(failures(docs, labels)).join(F.broadcast(paths(docs.sparkSession)), ["applied", "next"])
    return steps.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def query(spark, sf_dir) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE_SQL = r"""
WITH letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE a.f NOT IN (b.f, c.f, d.f, e.f) AND b.f NOT IN (c.f, d.f, e.f) AND c.f NOT IN (d.f, e.f) AND d.f <> e.f
),
steps AS (SELECT filter_order, step::INT AS step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS before FROM orders, range(1, 6) t(step)),
plain AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM plain),
firsts AS (SELECT text AS t, min(doc_id) AS first_id FROM plain GROUP BY text),
flags AS (SELECT doc_id AS id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
failed AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS fails
    FROM words JOIN firsts ON text = t LEFT JOIN flags ON doc_id = id
),
kinds AS (SELECT part, fails, good, toxic, count(*) AS n FROM failed GROUP BY ALL),
counted AS (
    SELECT part, filter_order, step, f,
        sum(CASE WHEN NOT contains(fails, f) AND NOT earlier THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN contains(fails, f) AND NOT earlier THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN contains(fails, f) AND earlier THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN fails = f THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN contains(fails, f) AND NOT earlier THEN n * good ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN contains(fails, f) AND NOT earlier THEN n * toxic ELSE 0 END)::BIGINT AS toxic_lost
    FROM (SELECT *, before <> '' AND regexp_matches(fails, '[' || before || 'x]') AS earlier FROM kinds, steps)
    GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley FROM counted
"""
