"""Benchmark decontamination with a distributed positional inverted index of the training tokens.

Each text is split once. For every word of the benchmark's vocabulary that it holds, a posting
(term, document, position) is written to a table in the shared folder; a header row beside them
keeps the document's id and number of words, so no text is read again. Then, on lists only:
  1. Terms are counted. A window is looked up by its terms in order of rarity: the list of the rarest,
     adjusted by its offset, gives candidate starts; the lists of the next two are intersected with
     them, each at its own adjusted offset, and for proximity matches within SLOP words of it.
  2. Exact: candidates of one alignment (a document and a benchmark text, shifted against each other)
     name the positions that they cover, each once; those without a posting of the wanted term
     (usually none) refute the windows over them. What is left matches word for word.
  3. Proximity: of the remaining candidates, those with NEAR_SHARE of the window's words within SLOP
     words of their places: reordered and interrupted passages, and ones with a word changed that is
     not among the window's three rarest.
Postings are a few bytes; no token array is shuffled, whatever the size of the benchmark. Joins are
on (document, term, place), so neither a common term nor a passage in a third of all documents makes
a hot key, and adaptive execution splits the one join on the rarest term alone. The vocabulary and
the windows are broadcast within measured bounds and joined by shuffle beyond.

All of it is DataFrame expressions.

Defined cases: a null or wordless text has no words, no hits and the digest of an empty list;
repeated rows each get a row; a null doc_id is a row like any other; ties in rarity go to the earlier
word of the window; a very long text gives a posting a word; benchmark rows with the same
item_id are one item; a null item_id is ignored; empty tables give empty or clean results; other
columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower_bytes, checkpointed, ensure_checkpoint_dir, table

#: Characters between words, as a class and one by one. Fixed by the contract.
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_SEPARATOR_CHARS = "".join(map(chr, [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
WINDOW = 13
#: A document is contaminated if at least one word in so many is hit.
SHARE = 20
#: Lists that are intersected before a window is compared as a whole.
RARE = 3
#: Proximity: words that a term may be off its place, and the share of a window's words that must be met.
SLOP = 5
NEAR_SHARE = 0.8
#: Bounds of broadcasts: words of the vocabulary and their bytes; windows and documents by number.
BROADCAST_TERMS = 500_000
BROADCAST_BYTES = 16 << 20
BROADCAST_ROWS = 200_000


def words(text: Column) -> Column:
    """The words of a text (their UTF-8 bytes as characters), an empty array if there are none."""
    trimmed = F.btrim(ascii_lower_bytes(F.coalesce(text, F.lit(""))), F.lit(_SEPARATOR_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SEPARATORS))


def test_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """src (a number for each benchmark row), item, w (its words)."""
    rows = benchmark.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w"))
    return checkpointed(rows.where(F.size("w") > 0).withColumn("src", F.monotonically_increasing_id()))


def test_windows(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """Distinct windows: window_id, terms array<string>, items (that hold it), src and off of one place where it stands."""
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))
    cut = items.select("item", "src", F.posexplode(F.transform(starts, lambda i: F.slice("w", i, width))).alias("off", "terms"))
    merged = cut.groupBy("terms").agg(F.collect_set("item").alias("items"), F.min(F.struct("src", "off")).alias("at"))
    return checkpointed(merged.select(F.monotonically_increasing_id().alias("window_id"), "terms", "items", "at.src", "at.off"))


def _small(df: DataFrame, is_small: bool) -> DataFrame:
    return F.broadcast(df) if is_small else df


def _few(df: DataFrame) -> bool:
    return df.count() <= BROADCAST_ROWS


def vocabulary(items: DataFrame) -> tuple[DataFrame, bool]:
    """(word, term), a number above 0 for each word of the benchmark and 0 for the empty one; whether it is small."""
    found = items.select(F.explode("w").alias("word")).distinct().withColumn("term", F.monotonically_increasing_id() + 1)
    made = checkpointed(found.union(items.sparkSession.createDataFrame([("", 0)], "word string, term long")))
    size = made.agg(F.count("*").alias("n"), F.sum(F.octet_length("word")).alias("bytes")).first()
    return made, size["n"] <= BROADCAST_TERMS and size["bytes"] <= BROADCAST_BYTES


def postings(base: DataFrame, terms: DataFrame, small: bool) -> DataFrame:
    """The index, as a table: doc (a number for each row of base), term, pos. The row of a document with
    term 0 is its header: doc_id, text_hash, and as pos its number of words."""
    # An empty word ends the text. Nothing here may leave generated code (no lambdas): rows would be copied with their tokens.
    numbered = base.withColumn("doc", F.monotonically_increasing_id())
    each = numbered.select("doc", "doc_id", "text_hash", F.posexplode_outer(F.concat("tokens", F.array(F.lit("")))).alias("pos", "word"))
    header = F.col("term") == 0
    index = each.join(_small(terms, small), "word").select("doc", "term", "pos", F.when(header, F.col("doc_id")).alias("doc_id"), F.when(header, F.col("text_hash")).alias("text_hash"))
    spark = base.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/postings-{uuid.uuid4().hex}"
    index.write.parquet(path)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)  # when the application ends
    return spark.read.schema(index.schema).parquet(path)


def ranked_windows(windows: DataFrame, terms: DataFrame, small: bool, index: DataFrame) -> DataFrame:
    """window_id, items, src, off, length, and `order`: its terms that occur, struct<n, at, term>, rarest first."""
    seen = _small(index.where("term > 0").groupBy("term").agg(F.count("*").alias("n")), small)
    placed = windows.select("window_id", F.posexplode("terms").alias("at", "word")).join(_small(terms, small), "word").join(seen, "term")
    order = placed.groupBy("window_id").agg(F.array_sort(F.collect_list(F.struct("n", "at", "term"))).alias("order"))
    return checkpointed(windows.join(order, "window_id").select("window_id", "items", "src", "off", F.size("terms").alias("length"), "order"))


def _in_reach(want: Column, slop: int) -> Column:
    """The places, of 2 * slop + 1 positions each, that hold the positions within slop of want."""
    return F.array_distinct(F.array(*(F.floor((want + d) / (2 * slop + 1)) for d in {-slop, slop})))


def _place(slop: int) -> Column:
    return F.floor(F.col("pos") / (2 * slop + 1)).alias("place")


def candidates(index: DataFrame, ranked: DataFrame, few: bool, slop: int = 0) -> DataFrame:
    """doc, window_id, start, exact: places where the RARE rarest terms of a window stand at their adjusted
    offsets (exact) or within slop words of them."""
    first = F.get("order", F.lit(0))
    plan = ranked.select("window_id", first["term"].alias("term"), first["at"].alias("at"), F.slice("order", 2, RARE - 1).alias("rest"))
    starts = index.join(_small(plan, few), "term").select("doc", "window_id", (F.col("pos") - F.col("at")).alias("start"), "rest")
    asked = starts.select("doc", "window_id", "start", F.size("rest").alias("n_rest"), F.posexplode("rest").alias("k", "r"))
    asked = asked.select("doc", "window_id", "start", "n_rest", "k", F.col("r.term").alias("term"), (F.col("start") + F.col("r.at")).alias("want"))
    asked = asked.withColumn("place", F.explode(_in_reach(F.col("want"), slop)))
    wanted = plan.select(F.explode("rest.term").alias("term")).distinct()
    lists = index.join(_small(wanted, few), "term", "left_semi").select("doc", "term", "pos", _place(slop))
    met = asked.join(lists, ["doc", "term", "place"]).where(F.abs(F.col("pos") - F.col("want")) <= slop)
    bit = F.expr("shiftleft(1, k)")
    both = met.groupBy("doc", "window_id", "start", "n_rest").agg(F.bit_or(bit).alias("near"), F.bit_or(F.when(F.col("pos") == F.col("want"), bit).otherwise(0)).alias("exact"))
    full = F.expr("shiftleft(1, n_rest) - 1")
    some = both.where(F.col("near") == full).select("doc", "window_id", "start", (F.col("exact") == full).alias("exact"))
    return checkpointed(some.union(starts.where(F.size("rest") == 0).select("doc", "window_id", "start", F.lit(True))))


def _of(index: DataFrame, found: DataFrame) -> DataFrame:
    """The postings of the documents in `found`."""
    docs = found.select("doc").distinct()
    return index.where("term > 0").join(_small(docs, _few(docs)), "doc", "left_semi")


def exact_matches(index: DataFrame, found: DataFrame, ranked: DataFrame, items: DataFrame, terms: DataFrame, small: bool, few: bool) -> DataFrame:
    """doc, window_id, start, length: every occurrence of a window, from the exact candidates."""
    whole = ranked.where(F.size("order") == F.col("length")).select("window_id", "src", "off", "length")  # a term that occurs nowhere cannot match
    placed = found.where("exact and start >= 0").select("doc", "window_id", "start").join(_small(whole, few), "window_id")
    aligned = placed.groupBy("doc", "src", (F.col("start") - F.col("off")).alias("shift")).agg(F.collect_list(F.struct("start", "length", "window_id")).alias("ws"))
    aligned = checkpointed(aligned)  # a row holds the windows of one benchmark text at most
    covered = F.array_distinct(F.flatten(F.transform("ws", lambda w: F.sequence(w["start"], w["start"] + w["length"] - 1))))
    said = items.select("src", F.posexplode("w").alias("i", "word")).join(_small(terms, small), "word").select("src", "i", "term")
    key = ["doc", "src", "shift"]
    # all windows of one text have the same length
    need = aligned.select(*key, F.get("ws", F.lit(0))["length"].alias("length"), F.explode(covered).alias("pos")).withColumn("i", F.col("pos") - F.col("shift")).join(_small(said, few), ["src", "i"])
    missing = need.join(_of(index, aligned).select("doc", "term", "pos"), ["doc", "term", "pos"], "left_anti")
    # a missing word spoils the windows that start at most a length before it
    spoilt = missing.select(*key, F.explode(F.sequence(F.col("pos") - F.col("length") + 1, F.col("pos"))).alias("start")).distinct()
    return aligned.select(*key, F.inline("ws")).join(spoilt, [*key, "start"], "left_anti").select("doc", "window_id", "start", "length")


def proximity_matches(index: DataFrame, found: DataFrame, ranked: DataFrame, few: bool, slop: int = SLOP, share: float = NEAR_SHARE) -> DataFrame:
    """doc, window_id, start: the candidates with `share` of the window's words within slop words of their places."""
    left = ranked.select("window_id", F.ceil(F.col("length") * share).alias("enough"), F.least(F.size("order"), F.lit(RARE)).alias("met"), F.slice("order", RARE + 1, 1 << 20).alias("rest"))
    asked = found.select("doc", "window_id", "start").join(_small(left.where(F.size("rest") + F.col("met") >= F.col("enough")), few), "window_id")
    each = asked.select("doc", "window_id", "start", "enough", "met", F.explode_outer("rest").alias("r"))
    each = each.select("doc", "window_id", "start", "enough", "met", F.col("r.at").alias("at"), F.col("r.term").alias("term"), (F.col("start") + F.col("r.at")).alias("want"))
    each = each.withColumn("place", F.explode_outer(_in_reach(F.col("want"), slop)))
    lists = _of(index, found).select("doc", "term", "pos", _place(slop))
    met = each.join(lists, ["doc", "term", "place"], "left").withColumn("hit", F.abs(F.col("pos") - F.col("want")) <= slop)
    counted = met.groupBy("doc", "window_id", "start", "enough", "met").agg(F.bit_or(F.when(F.col("hit"), F.expr("shiftleft(1L, at)")).otherwise(F.lit(0).cast("long"))).alias("hits"))
    return counted.where(F.col("met") + F.bit_count("hits") >= F.col("enough")).select("doc", "window_id", "start")


def _covered(spans: Column) -> Column:
    """Words in the union of spans struct<start, length>, sorted by start."""
    kind = "struct<n:long,upto:long>"

    def add(acc, s):
        end = s["start"] + s["length"]
        return F.struct((acc["n"] + F.greatest(end - F.greatest(s["start"], acc["upto"]), F.lit(0))).alias("n"), F.greatest(end, acc["upto"]).alias("upto")).cast(kind)

    return F.aggregate(spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")).cast(kind), add, lambda acc: acc["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, proximity: bool = True, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text_hash, n_words, n_hit, items array<string> sorted, contaminated, and, if
    wanted, near_items: those with an exact or a proximity match, sorted."""
    if not 0 < width < 63:
        raise ValueError("a window has 1 to 62 words")
    slop = SLOP if proximity else 0
    base = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"), words(F.col(text_col)).alias("tokens"))
    items = test_items(benchmark, item_col, item_text_col)
    windows = test_windows(items, width)
    terms, small = vocabulary(items)
    few = _few(windows)
    index = postings(base, terms, small)
    ranked = ranked_windows(windows, terms, small, index)
    found = candidates(index, ranked, few, slop)
    exact = checkpointed(exact_matches(index, found, ranked, items, terms, small, few))
    named = _small(ranked.select("window_id", "items"), few)
    every = lambda: F.array_sort(F.array_distinct(F.flatten(F.collect_set("items"))))
    # A document's own spans: bounded by its length.
    hits = exact.join(named, "window_id").groupBy("doc").agg(F.array_sort(F.collect_set(F.struct("start", "length"))).alias("spans"), every().alias("items"))
    out = index.where("term = 0").select("doc", "doc_id", "text_hash", F.col("pos").cast("long").alias("n_words"))
    out = out.join(hits.select("doc", _covered(F.col("spans")).alias("n_hit"), "items"), "doc", "left")
    none, n_hit = F.array().cast("array<string>"), F.coalesce("n_hit", F.lit(0).cast("long"))
    columns = ["doc_id", "text_hash", "n_words", n_hit.alias("n_hit"), F.coalesce("items", none).alias("items"), ((n_hit > 0) & (SHARE * n_hit >= F.col("n_words"))).alias("contaminated")]
    if proximity:
        open_ = checkpointed(found.join(exact, ["doc", "window_id", "start"], "left_anti"))
        near = proximity_matches(index, open_, ranked, few).union(exact.select("doc", "window_id", "start"))
        near = near.select("doc", "window_id").distinct().join(named, "window_id").groupBy("doc").agg(every().alias("near_items"))
        out, columns = out.join(near, "doc", "left"), [*columns, F.coalesce("near_items", none).alias("near_items")]
    return out.select(*columns)


def query(spark, sf_dir) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    listed = lambda c: F.sha2(F.array_join(c, ","), 256)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), listed("items").alias("items_sha256"), "contaminated", F.size("near_items").cast("long").alias("n_near_items"), listed("near_items").alias("near_items_sha256")
    )


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
m AS (SELECT DISTINCT doc_id, i, n, item_id FROM dw JOIN bw USING (n, g)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM m) GROUP BY doc_id),
p AS (SELECT doc_id, unnest(w) AS term, generate_subscripts(w, 1) AS pos FROM d),
wt AS (SELECT n, g, unnest(string_split(g, ' ')) AS term, generate_subscripts(string_split(g, ' '), 1) - 1 AS o FROM (SELECT DISTINCT n, g FROM bw)),
fr AS (SELECT term, count(*) AS f FROM p WHERE term IN (SELECT term FROM wt) GROUP BY term),
r AS (SELECT n, g, o, term, row_number() OVER (PARTITION BY g ORDER BY f, o) AS rk FROM wt JOIN fr USING (term)),
c AS (SELECT DISTINCT doc_id, g, pos - o AS start FROM r JOIN p USING (term) WHERE rk = 1),
nw AS (SELECT c.doc_id, c.g, c.start, any_value(r.n) AS n, count(DISTINCT r.o) AS k, count(DISTINCT r.o) FILTER (rk <= 3) AS k3
  FROM c JOIN r USING (g) JOIN p ON p.doc_id = c.doc_id AND p.term = r.term AND abs(p.pos - c.start - r.o) <= 5 GROUP BY ALL),
ni AS (SELECT doc_id, count(*) AS n_near, string_agg(item_id, ',' ORDER BY item_id) AS near FROM (
  SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM nw JOIN bw USING (n, g) WHERE k >= ceil(0.8 * n) AND k3 = least(3, n)) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(w), 0) AS contaminated,
  coalesce(n_near, 0)::BIGINT AS n_near_items, sha256(coalesce(near, '')) AS near_items_sha256
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN t ON d.doc_id = t.doc_id LEFT JOIN ni ON d.doc_id = ni.doc_id
"""
