"""A training-data pipeline over `documents`: each stage calls one operator and passes on what it keeps.

1. language: documents without a recognisable language go: no letter, a score under MIN_SCORE, or
   too few character n-grams that the learned languages have (langid.Model.floors).
2. lines: lines that repeat earlier ones go from the texts; a document of which nothing stays goes.
3. copies: of each SimHash component one document stays, the one with the smallest id.
4. benchmark: contaminated documents go.
5. packing: the rest is packed; the result is one row per piece.

All stages but the last return the columns of documents, in their order and types, whatever their
names; n_chars, if there is one, follows the text. Every stage takes an empty table and returns an
empty one. run() writes what each stage keeps to the checkpoint folder, so no stage runs twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm import decontaminate, langid, line_dedup, packing, simhash
from chatloom.llm.common import checkpointed, fresh, named, table

#: A prediction below this contradicts every learned language. Texts like none of them score about 0.5 and go as unfamiliar.
MIN_SCORE = 0.25


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null, empty and letterless texts go; repeated rows and null ids are judged like any other; a very
    long text is read whole. With no labelled row to learn from, only texts without a letter go."""
    model = langid.trained(docs)
    if not model.languages:
        return docs.where(F.coalesce(F.rlike("text", F.lit("\\p{L}")), F.lit(False)))
    names = tuple(fresh(n, docs.columns) for n in ("pred", "score", "familiar"))
    found = langid.identify(docs, model, docs.columns, names=names)
    return found.where((F.col(names[0]) != "und") & (F.col(names[1]) >= MIN_SCORE) & F.col(names[2])).select(*map(named, docs.columns))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A null text stays null, and a document none of whose lines repeats stays as it is, empty ones too.
    Ties: of equal lines that with the smallest (doc_id, text hash, line number) stays, null ids first.
    Rows that repeat both id and text count as one document and get the same text."""
    found = line_dedup.dedup_lines(docs, keep=docs.columns)
    stays = found.where((F.col("n_exact") + F.col("n_near") == 0) | F.coalesce(F.trim("kept_text") != "", F.lit(False)))
    new = {"text": F.col("kept_text"), "n_chars": F.coalesce(F.length("kept_text"), F.lit(0))}
    return stays.select(*(new[c].cast(docs.schema[c].dataType).alias(c) if c in new else F.col("others")[c].alias(c) for c in docs.columns))


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null and wordless texts are copies of each other. Ties: of equal ids the smaller text hash stays, of
    rows that repeat both one; null ids stay only where a component has no other."""
    return simhash.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null and wordless texts are clean and stay; repeated rows share their fate; a benchmark without words removes nothing."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), proximity=False).where("contaminated")
    key, of = fresh("id", docs.columns), fresh("of", docs.columns)
    bad = found.select(F.col("doc_id").alias(key), F.col("text_hash").alias(of)).distinct()
    same = docs.doc_id.eqNullSafe(F.col(key)) & (F.xxhash64(F.coalesce(docs.text, F.lit(""))) == F.col(of))
    return docs.join(bad, same, "left_anti")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row is packed, a null or empty text as its end token alone; equal ids are packed separately."""
    return packing.pack_documents(docs)


STAGES = [("language", language), ("lines", lines), ("copies", copies), ("benchmark", benchmark), ("packing", packed)]

#: The language model and the tokenizer are not SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = checkpointed(docs)
    return docs
