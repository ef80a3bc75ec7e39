"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Each text gets a 64-bit fingerprint of its 3-word shingles. Two fingerprints within `radius`
bits share a point within half the radius of both, so every distinct fingerprint emits all
variants within radius // 2 flips (65 for radius 2), the variants are shuffled, and fingerprints
that meet at a variant are linked to the smallest there. Every pair at one variant is within the
radius by the triangle inequality (the verification confirms it), so a star per variant keeps all
connections, and a variant holds at most 65 fingerprints however many documents share one.

Defined cases: a null, empty or blank text has fingerprint 0 and links like any other; a text of
fewer words than a shingle is one shingle; equal texts share a fingerprint; a null doc_id is kept
as a row but never names a component unless the component has no other; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, fresh, table
from .components import connected_components

SHINGLE = 3
SEED = 42


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of a UTF-8 text. bytes.lower and bytes.split know ASCII only, as wanted."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) <= shingle:
        starts, ends = [0], [len(whole)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(lengths + 1) - 1
        starts, ends = (end - lengths)[: len(words) - shingle + 1].tolist(), end[shingle - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(whole[s:e], SEED) for s, e in zip(starts, ends)], dtype=">u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):  # bounded memory for very long texts
        bits = np.unpackbits(hashes[at : at + 4096].view(np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * counts > len(hashes)).view(">u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp long): the fingerprint's 64 bits as a signed number."""

    def run(batches):
        for batch in batches:
            prints = np.fromiter((fingerprint(x.as_py()) for x in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints.view(np.int64))], names=["doc_id", "text_hash", "fp"])

    text = F.col(text_col)
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"), text.cast("binary").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, text_hash long, fp long")


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect all those within the radius."""
    masks = [reduce(lambda m, i: m ^ (1 << i), c, 0) for k in range(radius // 2 + 1) for c in combinations(range(64), k)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    variants = prints.select("fp").distinct().select("fp", F.explode(F.transform(F.array(*map(F.lit, signed)), lambda m: F.col("fp").bitwiseXOR(m))).alias("variant"))
    found = variants.select("variant", "fp", F.min("fp").over(Window.partitionBy("variant")).alias("low")).where("fp <> low")
    if radius % 2:
        raise ValueError("the radius must be even: both sides emit half of it")
    return found.select(F.col("low").alias("a"), F.col("fp").alias("b")).distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicates(docs: DataFrame, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text_hash, fp long, component_id (the smallest doc_id of its
    component) and root (a fingerprint that names the component even if it has no doc_id)."""
    prints = checkpointed(fingerprints(docs, id_col, text_col))
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connected_components(links(prints, radius)).withColumnRenamed("node", "fp")
    linked = roots.join(classes, "fp")
    named = roots.join(linked.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "root", "component_id")
    labels = classes.join(named, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "least").alias("component_id"))
    return prints.join(labels, "fp").select("doc_id", "text_hash", "fp", "component_id", "root")


def one_of_each(docs: DataFrame, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs without near-duplicates: of each component the row with the smallest doc_id
    (then text hash; null ids last), and one of rows that repeat both."""
    found = near_duplicates(docs, radius, id_col, text_col).select("doc_id", "text_hash", "root")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    ranked = found.withColumn("rank", rank)
    leads = ranked.groupBy("root").agg(F.min("rank").alias("lead"))
    key = [fresh("id", docs.columns), fresh("of", docs.columns)]
    keyed = lambda df: df.select(F.col("doc_id").alias(key[0]), F.col("text_hash").alias(key[1]))
    same = lambda df: df[f"`{id_col}`"].eqNullSafe(F.col(key[0])) & (F.xxhash64(F.coalesce(df[f"`{text_col}`"], F.lit(""))) == F.col(key[1]))
    gone = keyed(ranked.join(leads, "root").where("rank <> lead")).distinct()
    kept = docs.join(gone, same(docs), "left_anti")

    repeated = checkpointed(keyed(ranked.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1")))
    if repeated.isEmpty():
        return kept
    return kept.join(repeated, same(kept), "left_anti").union(kept.join(repeated, same(kept), "left_semi").dropDuplicates([id_col, text_col]))


def query(spark, sf_dir) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
