r"""Line dedup by a deletion-neighbourhood join.

A line repeats an earlier one if both are equal, or within one edit (insertion, deletion or
substitution of a character), after trimming ASCII white space. Order is (doc_id, text hash, line
number). A line is dropped if any earlier line, dropped itself or not, is that close; the earliest
of every set of copies stays. Blank lines are layout and stay. All others count, however short; an
edit is near if the longer line has at least `near_chars` characters: one in five leaves 0.8 of it.
The bound is one edit: with two, a block of 32 characters would emit 528 variants instead of 33.

Equal lines meet in an aggregation that combines before its shuffle, so one line in a third of all
rows costs no more than others. Then only distinct lines are compared:
  1. Lines one edit apart share their first or their last g characters, g about half the length.
     Lines that share neither with another line are out.
  2. The rest is keyed by blocks: all of the line but a block of characters (an eighth within
     BLOCKS, half of a shorter line, the root of a very long one), with the place of the block and
     the longer length of the pair. Blocks that meet no other line are out.
  3. Each remaining block emits its deletion variants as hashed keys: without character i, with i;
     and, as the shorter side of a pair, unchanged. Lines that differ by a substitution meet at
     (variant, i); a longer and a shorter line at (variant, unchanged). At each meeting a line is
     paired with the earliest only, so nothing grows with the square of a group.
  4. Pairs are verified by their edit distance.
All of it is DataFrame expressions; no step drops or caps anything that could match.

Defined cases: a null text stays null with 0 lines; an empty text is one empty line; rows that
repeat both doc_id and text are treated as one document and get the same result; null ids come
first; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, let, named, table, wide_hash

#: ASCII white space within a line.
BLANKS = " \t\x0b\x0c\r"
NEAR_CHARS = 5
#: Characters of a block: an eighth of the line within these bounds.
BLOCKS = (32, 128)
#: Distinct lines whose texts are fetched by a broadcast of their places; more are fetched by a shuffle.
BROADCAST_ROWS = 200_000

PLACE = ("doc_id", "text_hash", "line_no")


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def _lines(docs: DataFrame) -> DataFrame:
    lines = docs.select("doc_id", "text_hash", F.posexplode(F.split("text", "\n")).alias("line_no", "raw"))
    return lines.select(*PLACE, _trimmed(F.col("raw")).alias("line")).where("line <> ''")


def _half_keys(line: Column) -> Column:
    """The hashed halves of a line of n characters, for itself and for a partner one character longer."""
    g, h = F.expr("if(n < 16, n div 2, 8 * (n div 16))"), F.expr("if(n < 15, (n + 1) div 2, 8 * ((n + 1) div 16))")
    both = lambda g: F.array(F.xxhash64(F.lit("first"), g, F.substring(line, F.lit(1), g)), F.xxhash64(F.lit("last"), g, F.substring(line, -g, g)))
    return F.when(g == h, both(g)).otherwise(F.concat(both(g), both(h)))


def _shared(rows: DataFrame, key: str, by: str) -> DataFrame:
    """The rows whose key occurs with different values of `by`."""
    met = rows.groupBy(key).agg(F.min(by).alias("_lo"), F.max(by).alias("_hi")).where("_lo < _hi").select(key)
    return rows.join(met, key, "left_semi")


def _blocks(lines: DataFrame, near_chars: int) -> DataFrame:
    """(id, key, mid, longer): each block of a line as the longer or equal (true) and as the shorter side."""
    line, n = F.col("line"), F.length("line")

    def cut(longer: bool) -> Column:
        c = n if longer else n + 1
        eighth, half, root = (F.ceil(x).cast("int") for x in (c / 8, c / 2, F.sqrt(c)))
        block = F.greatest(F.least(F.greatest(eighth, F.lit(BLOCKS[0])), F.lit(BLOCKS[1]), half), root)  # very long lines: about as many blocks as characters in one
        width = block if longer else block - 1
        parts = F.transform(
            F.sequence(F.lit(0), c - 1, block),
            lambda a: F.struct(
                F.xxhash64(c, a, F.substring(line, F.lit(1), a), F.lit("\n"), F.substring(line, a + width + 1, n)).alias("key"),
                F.substring(line, a + 1, width).alias("mid"),
                F.lit(longer).alias("longer"),
            ),
        )
        return F.when(c >= near_chars, parts).otherwise(F.slice(parts, 1, 0))

    return lines.select("id", F.inline(F.concat(cut(True), cut(False))))


def _variants(blocks: DataFrame) -> DataFrame:
    """(id, variant, i): a block without its character i, or as the shorter side unchanged (i = -1)."""
    mid = F.col("mid")
    without = F.transform(
        F.sequence(F.lit(0), F.length(mid) - 1),
        lambda i: F.struct(F.xxhash64("key", F.concat(F.substring(mid, F.lit(1), i), F.substring(mid, i + 2, F.length(mid)))).alias("variant"), i.alias("i")),
    )
    whole = F.array(F.struct(F.xxhash64("key", mid).alias("variant"), F.lit(-1).alias("i")))
    return blocks.where("not longer or mid <> ''").select("id", F.inline(F.when(F.col("longer"), without).otherwise(whole)))


def near_repeats(firsts: DataFrame, docs: DataFrame, near_chars: int) -> DataFrame:
    """firsts: the first place of each distinct line, with its half keys. Returns the places (PLACE)
    of those within one edit of an earlier distinct line."""
    keyed = firsts.select(*PLACE, "h1", F.explode(F.array_distinct("halves")).alias("half"))
    places = checkpointed(_shared(keyed, "half", "h1").select(*PLACE).distinct())
    small = places.count() <= BROADCAST_ROWS
    where = places.select(*(F.col(c).alias(f"_{c}") for c in PLACE))
    lines = _lines(docs)
    same = lines.doc_id.eqNullSafe(where._doc_id) & (lines.text_hash == where._text_hash) & (lines.line_no == where._line_no)
    texts = lines.join(F.broadcast(where) if small else where, same, "left_semi").dropDuplicates(list(PLACE))
    texts = checkpointed(texts.select(F.struct(*PLACE).alias("place"), "line").withColumn("id", F.monotonically_increasing_id()))

    blocks = checkpointed(_shared(_blocks(texts.select("id", "line"), near_chars), "key", "id"))
    order = texts.select("id", "place")
    met = _variants(blocks).join(order, "id")
    at, of = Window.partitionBy("variant", "i"), Window.partitionBy("variant")
    unchanged = F.min(F.when(F.col("i") < 0, F.col("place"))).over(of)
    changed = F.min(F.when(F.col("i") >= 0, F.col("place"))).over(of)
    equal = F.when(F.col("i") >= 0, F.min("place").over(at))
    other = F.when(F.col("i") >= 0, unchanged).otherwise(changed)
    paired = met.repartition("variant").select("id", "place", equal.alias("equal"), other.alias("other")).select("id", "place", F.explode(F.array("equal", "other")).alias("earlier"))
    pairs = paired.where("earlier < place").select("id", "earlier").distinct()
    a = texts.select("id", F.col("place").alias("this"), F.col("line").alias("line_a"))
    b = texts.select(F.col("place").alias("earlier"), F.col("line").alias("line_b"))
    close = pairs.join(b, "earlier").join(a, "id").where((F.greatest(F.length("line_a"), F.length("line_b")) >= near_chars) & F.levenshtein("line_a", "line_b", 1).between(0, 1))
    return close.select("this.*").distinct()


def dedup_lines(docs: DataFrame, near_chars: int = NEAR_CHARS, near: bool = True, id_col: str = "doc_id", text_col: str = "text", keep: tuple | list = ()) -> DataFrame:
    """One row per document: doc_id, text_hash, n_lines, n_exact and n_near (lines dropped), kept_text,
    and, if wanted, the columns `keep` of the document unchanged in one struct `others`."""
    others = F.struct(*map(named, keep)) if keep else F.lit(None).cast("struct<none:int>")
    base = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("text_hash"), F.col(text_col).alias("text"), others.alias("others"))
    lines = _lines(base).withColumn("n", F.length("line"))
    h1, h2 = wide_hash(F.col("line"))
    keyed = lines.select(*PLACE, h1.alias("h1"), h2.alias("h2"), F.when(F.col("n") + 1 >= near_chars, _half_keys(F.col("line"))).alias("halves"))
    halves = [F.first(F.get("halves", F.lit(k))).alias(f"half{k}") for k in range(4)]
    firsts = keyed.groupBy("h1", "h2").agg(F.min(F.struct(*PLACE)).alias("place"), *halves)
    firsts = checkpointed(firsts.select("place.*", "h1", F.array_compact(F.array(*(f"half{k}" for k in range(4)))).alias("halves")))

    found = firsts.select(*PLACE)
    if near:
        gone = near_repeats(firsts, base, near_chars).select(*(F.col(c).alias(f"_{c}") for c in PLACE))
        same = found.doc_id.eqNullSafe(gone._doc_id) & (found.text_hash == gone._text_hash) & (found.line_no == gone._line_no)
        found = found.join(gone, same, "left").select(*PLACE, F.col("_text_hash").isNotNull().alias("near"))
    else:
        found = found.withColumn("near", F.lit(False))
    # Lists of a document's own lines: bounded by the document.
    kept = found.groupBy("doc_id", "text_hash").agg(F.collect_list(F.when(~F.col("near"), F.col("line_no"))).alias("own"), F.count_if("near").alias("n_near"))
    kept = kept.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t"), "own", "n_near")

    joined = base.join(kept, base.doc_id.eqNullSafe(kept._d) & (base.text_hash == kept._t), "left")
    n_near, own = F.coalesce("n_near", F.lit(0).cast("long")), F.coalesce("own", F.array().cast("array<int>"))

    def result(all_lines: Column) -> Column:
        layout = F.filter(F.sequence(F.lit(0), F.size(all_lines) - 1), lambda i: _trimmed(F.get(all_lines, i)) == "")
        return let(
            F.array_sort(F.concat(own, layout)),
            lambda stay: F.struct(
                F.size(all_lines).cast("long").alias("n_lines"),
                (F.size(all_lines) - F.size(stay) - n_near).alias("n_exact"),
                n_near.alias("n_near"),
                F.array_join(F.transform(stay, lambda i: F.get(all_lines, i)), "\n").alias("kept_text"),
            ),
        )

    zero = F.lit(0).cast("long")
    none = F.struct(zero.alias("n_lines"), zero.alias("n_exact"), zero.alias("n_near"), F.lit(None).cast("string").alias("kept_text"))
    # The generator keeps filters and projections above from computing all this again.
    once = F.inline(F.array(F.when(F.col("text").isNull(), none).otherwise(let(F.split("text", "\n"), result))))
    return joined.select("doc_id", "text_hash", *(["others"] if keep else []), once)


def query(spark, sf_dir) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_exact", "n_near", F.length("kept_text").cast("long").alias("kept_chars"), F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH l AS (SELECT doc_id, i - 1 AS line_no, raw, trim(raw, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) AS line
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
f AS (SELECT line, length(line) AS n, min({'doc_id': doc_id, 'line_no': line_no}) AS pos FROM l WHERE line <> '' GROUP BY line),
c AS (SELECT line, pos, n, n + d AS c, (n + d) // 2 AS h FROM f, (VALUES (0), (1)) v(d) WHERE n + d >= 5),
k AS (SELECT line, pos, n, c, 'first' AS side, left(line, h) AS half FROM c UNION ALL SELECT line, pos, n, c, 'last', right(line, c - h) FROM c),
p AS (SELECT DISTINCT a.line AS this, a.n AS na, a.pos, b.line AS earlier, b.n AS nb, a.c
  FROM k a JOIN k b ON a.c = b.c AND a.side = b.side AND a.half = b.half AND b.pos < a.pos AND greatest(a.n, b.n) = a.c),
g AS (SELECT DISTINCT pos FROM (SELECT *, CASE WHEN na >= nb THEN this ELSE earlier END AS s, CASE WHEN na >= nb THEN earlier ELSE this END AS t FROM p)
  WHERE len(list_filter(range(0, c), lambda i: left(s, i) || substr(s, i + 2) = CASE WHEN na = nb THEN left(t, i) || substr(t, i + 2) ELSE t END)) > 0),
s AS (SELECT l.*, CASE WHEN l.line = '' THEN 'stay' WHEN f.pos <> {'doc_id': l.doc_id, 'line_no': l.line_no} THEN 'exact' WHEN g.pos IS NOT NULL THEN 'near' ELSE 'stay' END AS fate
  FROM l LEFT JOIN f ON l.line = f.line LEFT JOIN g ON g.pos = {'doc_id': l.doc_id, 'line_no': l.line_no})
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (fate = 'exact') AS n_exact, count(*) FILTER (fate = 'near') AS n_near,
  length(coalesce(string_agg(raw, chr(10) ORDER BY line_no) FILTER (fate = 'stay'), '')) AS kept_chars,
  sha256(coalesce(string_agg(raw, chr(10) ORDER BY line_no) FILTER (fate = 'stay'), '')) AS kept_sha256
FROM s GROUP BY doc_id
"""
