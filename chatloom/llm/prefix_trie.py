"""A trie of conversation prefixes: how many conversations share each prefix, and what sharing it saves.

Distributed MSD radix partitioning. Turns are dictionary-encoded (equal role and text, equal id), so a
conversation is an array of ids and texts are never shuffled. Equal conversations are first counted as
one. From the root on, a bucket of conversations with a common prefix is split by its next turn id:
the buckets that are still large (more than `local_turns` ids left, and more than one conversation) are
split again in the next round, the others are done. A large bucket is first led past the turns that all of
it shares, which are the common prefix of its smallest and its largest array, so there is one round for
each branching of large buckets, not for each turn. There is at most one large bucket for `local_turns`
ids, which bounds the tables that a round broadcasts; over BROADCAST_ROWS rows they are shuffled.
What is done goes to tasks by bucket, each of bounded size, where a multikey quicksort orders it: every
part of equal ids is a node, emitted as the recursion enters it. Sums over subtrees are formed inside a
bucket, and those of the large buckets are added along their ancestors by one aggregation.

A node is named by its smallest member and its depth. Its digest is over the members that end there,
which may be a third of all: they are joined to texts in blocks of ids, and the blocks of one group
are hashed one after the other, in order and without being held.

Defined cases: a null role or text is empty; rows with a null conv_id belong to no conversation and are
left out. Turns are ordered with nulls first; rows of one conversation that share a turn are ordered by
role and text, and repeated rows are turns like any other. A very long text is hashed whole. A conversation's ids are held in
one row, 12 bytes a turn. An empty table has no conversation and so no node. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, table, wide_hash

#: Ids left in a bucket that one task finishes.
LOCAL_TURNS = 1 << 17
#: Large buckets are broadcast up to this number.
BROADCAST_ROWS = 200_000
#: Ends of one node are joined to a text in blocks of this many conv_ids (a power of two).
BLOCK_BITS = 12
#: Nodes in an Arrow batch.
BATCH = 20_000
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


# ---------------------------------------------------------------- conversations as arrays of ids


def _by_turn(rows: DataFrame, *order: str) -> DataFrame:
    """conv_id, turns: array of (order..., id, bytes), in order."""
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(*order, "id", "bytes"))).alias("turns"))


def encoded(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, ids array<long>, sizes array<int>: the dictionary ids of a conversation's turns and the bytes of their texts."""
    blank = F.lit("")
    plain = rows.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(role_col, blank).alias("role"), F.coalesce(text_col, blank).alias("text")).where("conv_id is not null")
    hashes = [h.alias(n) for h, n in zip(wide_hash(F.col("role"), F.col("text")), ("h1", "h2"))]
    turns = checkpointed(plain.select("conv_id", "turn", *hashes, F.octet_length("text").alias("bytes")))
    # written, as ids made while reading would differ from read to read
    words = checkpointed(turns.groupBy("h1", "h2").agg(F.first("bytes").alias("bytes")).withColumn("id", F.monotonically_increasing_id()))
    done = checkpointed(_by_turn(turns.drop("bytes").join(words, ["h1", "h2"]), "turn"))
    shaped = lambda df: df.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.bytes").alias("sizes"))
    repeats = F.size(F.array_distinct(F.transform("turns", lambda t: t["turn"]))) < F.size("turns")
    tied = done.where(repeats).select("conv_id")
    if tied.isEmpty():
        return shaped(done)
    # only of conversations whose turns tie are roles and texts compared
    place = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    again = plain.join(tied, "conv_id", "left_semi").select("conv_id", "turn", *hashes, place.alias("place"))
    return shaped(done.where(~repeats)).unionByName(shaped(_by_turn(again.join(words, ["h1", "h2"]), "turn", "place")))


def shared_heads(coded: DataFrame, every: int = 5, heads: int = 9) -> DataFrame:
    """Every conversation c rebuilt: the first h turns of conversation c - c % every (all if fewer, none if
    there is no such conversation), then its own turns after the first h; h = crc32(decimal c) % heads."""
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    own = coded.select("*", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("base"))
    bases = coded.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.col("ids").alias("base_ids"), F.col("sizes").alias("base_sizes"))
    none = F.array()

    def put(base: str, mine: str, kind: str) -> Column:
        head = F.slice(F.coalesce(F.col(base), none.cast(kind)), F.lit(1), F.col("h"))
        return F.concat(head, F.slice(F.col(mine), F.col("h") + 1, F.size(mine)))

    return own.join(bases, "base", "left").select("conv_id", put("base_ids", "ids", "array<long>").alias("ids"), put("base_sizes", "sizes", "array<int>").alias("sizes"))


def distinct_sequences(coded: DataFrame) -> DataFrame:
    """One row per distinct array: conv_id (the smallest), n, ends_sha256 over all their conv_ids, ids, sizes."""
    keyed = checkpointed(coded.select("*", *(h.alias(n) for h, n in zip(wide_hash(F.col("ids")), ("c1", "c2")))))
    block = F.shiftright("conv_id", BLOCK_BITS).alias("block")
    texts = keyed.groupBy("c1", "c2", block).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("text"))

    def digests(batches):
        key, first, n, sha = None, 0, 0, None
        for batch in batches:
            done = []
            for c1, c2, conv, k, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (c1, c2) != key:
                    if key is not None:
                        done.append((first, n, sha.hexdigest()))
                    key, first, n, sha = (c1, c2), conv, 0, hashlib.sha256()
                elif n:
                    sha.update(b",")
                sha.update(text.encode())
                n += k
            if done:
                yield pa.record_batch([pa.array(x) for x in zip(*done)], ["conv_id", "n", "ends_sha256"])
        if key is not None:
            yield pa.record_batch([pa.array([x]) for x in (first, n, sha.hexdigest())], ["conv_id", "n", "ends_sha256"])

    in_order = texts.repartition("c1", "c2").sortWithinPartitions("c1", "c2", "block").select("c1", "c2", "conv_id", "n", "text")
    found = in_order.mapInArrow(digests, "conv_id long, n long, ends_sha256 string")
    return found.join(keyed.select("conv_id", "ids", "sizes"), "conv_id")


# ---------------------------------------------------------------- buckets that one task finishes


def multikey_nodes(convs: list, counts: list, ends: list, ids: list, sizes: list, depth: int, above) -> tuple[list, ...]:
    """The columns of NODE for the distinct sequences of one bucket, which share their first `depth` ids; the first
    node is the bucket's own, with parent `above`."""
    conv, deep, parent, n, children, leaves, saved, sha = [], [], [], [], [], [], [], []
    at: list[int] = []  # the node's parent as a place in these lists
    work: list[tuple[list[int], int, int]] = []

    def enter(items: list[int], d: int, up: int) -> None:
        """Emits the node of these sequences' first d ids and leaves those that go on to be sorted below it."""
        here = len(conv)
        own = min(convs[i] for i in items)
        total = sum(counts[i] for i in items)
        conv.append(own), deep.append(d), at.append(up), n.append(total)
        parent.append(conv[up] if up >= 0 else above)
        children.append(0), leaves.append(0)
        saved.append((total - 1) * sizes[items[0]][d - 1] if d else 0)
        ended = [i for i in items if len(ids[i]) == d]
        sha.append(ends[ended[0]] if ended else NO_ENDS)
        rest = items if not ended else [i for i in items if len(ids[i]) > d]
        if rest:
            work.append((rest, d, here))

    enter(list(range(len(convs))), depth, -1)
    while work:
        items, d, up = work.pop()
        if len(items) == 1:  # no branch is left: the rest of the sequence is a chain
            i, c = items[0], convs[items[0]]
            k, here = len(ids[i]) - d, len(conv)
            conv += [c] * k
            deep += range(d + 1, d + k + 1)
            parent += [conv[up], *[c] * (k - 1)]
            at += [up, *range(here, here + k - 1)]
            n += [counts[i]] * k
            children += [0] * k
            leaves += [0] * k
            saved += [(counts[i] - 1) * b for b in sizes[i][d:]]
            sha += [NO_ENDS] * (k - 1)
            sha.append(ends[i])
            continue
        few = sorted(ids[i][d] for i in (items[0], items[len(items) // 2], items[-1]))[1]
        for part in ([i for i in items if ids[i][d] < few], [i for i in items if ids[i][d] > few]):
            if part:
                work.append((part, d, up))
        enter([i for i in items if ids[i][d] == few], d + 1, up)
    for i in range(len(conv) - 1, -1, -1):  # parents stand before their children
        up = at[i]
        leaves[i] = leaves[i] or 1
        if up >= 0:
            children[up] += 1
            leaves[up] += leaves[i]
            saved[up] += saved[i]
    return conv, deep, parent, n, children, leaves, saved, sha


def _finished(buckets: DataFrame) -> DataFrame:
    """NODE and `top`, for rows (parent_conv_id, depth, digit, conv_id, n, ends_sha256, ids, sizes)."""
    key = ("parent_conv_id", "depth", "digit")
    names = [f.split()[0] for f in NODE.split(", ")] + ["top"]
    kinds = [pa.int64()] * 7 + [pa.string(), pa.bool_()]

    def run(batches):
        out: list[list] = [[] for _ in names]
        held: list[list] = [[] for _ in range(5)]
        now = None

        def close() -> None:
            if now is not None:
                found = multikey_nodes(*held, now[1], now[0])
                for column, values in zip(out, (*found, [True, *[False] * (len(found[0]) - 1)])):
                    column += values

        def batch_of_nodes() -> pa.RecordBatch:
            made = pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds)], names)
            for c in out:
                c.clear()
            return made

        for batch in batches:
            keys = list(zip(*(c.to_pylist() for c in batch.columns[:3])))
            flat = []
            for c in batch.columns[6:8]:
                ends = np.cumsum([0, *pc.list_value_length(c).to_pylist()]).tolist()
                values = c.flatten().to_pylist()
                flat.append([values[a:b] for a, b in zip(ends, ends[1:])])
            rows = zip(*(c.to_pylist() for c in batch.columns[3:6]), *flat)
            for k, row in zip(keys, rows):
                if k != now:
                    close()
                    now, held = k, [[] for _ in range(5)]
                    if len(out[0]) >= BATCH:
                        yield batch_of_nodes()
                for column, value in zip(held, row):
                    column.append(value)
        close()
        if out[0]:
            yield batch_of_nodes()

    columns = buckets.select(*key, "conv_id", "n", "ends_sha256", "ids", "sizes")
    return columns.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, f"{NODE}, top boolean")


# ---------------------------------------------------------------- rounds over large buckets


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _led_on(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Large buckets with the depth up to which all their rows agree, and the sizes of the shared turns.
    known: bucket, first_depth, n, parent_conv, path."""
    ends = rows.groupBy("bucket").agg(F.min(F.struct("ids", "sizes")).alias("low"), F.max("ids").alias("high"))
    same = F.zip_with("low.ids", "high", lambda a, b: a.eqNullSafe(b))
    until = F.array_position(same, False).cast("int")
    depth = F.when(until == 0, F.size("low.ids")).otherwise(until - 1)
    led = ends.select("bucket", depth.alias("depth"), F.slice("low.sizes", F.lit(1), depth).alias("sizes"))
    return known.join(led, "bucket").withColumn("path", F.concat("path", F.array(F.struct(F.col("bucket").alias("conv"), F.col("depth")))))


def prefix_nodes(sequences: DataFrame, local_turns: int = LOCAL_TURNS) -> DataFrame:
    """The nodes of the trie of distinct sequences (conv_id, n, ends_sha256, ids, sizes), as NODE."""
    base = checkpointed(sequences)
    total = base.agg(F.count("*").alias("rows"), F.min("conv_id").alias("conv"), F.sum("n").alias("n"), F.sum(F.size("ids")).alias("turns")).first()
    nothing = [F.lit(None).cast("long").alias("parent_conv_id"), F.lit(0).alias("depth"), F.lit(None).cast("long").alias("digit")]
    if total["rows"] <= 1 or total["turns"] <= local_turns:
        return _finished(base.select(*nothing, "*")).drop("top")
    spark = base.sparkSession
    rows = base.withColumn("bucket", F.lit(total["conv"]))
    known = spark.createDataFrame([(total["conv"], 0, total["n"], None, [])], "bucket long, first_depth int, n long, parent_conv long, path array<struct<conv:long,depth:int>>")
    done, large, count = [], [], 1
    while count:
        known = checkpointed(_led_on(rows, known))
        going = rows.join(_small(known.select("bucket", "depth", "path"), count), "bucket")
        ended = going.where(F.size("ids") == F.col("depth")).select("bucket", F.col("ends_sha256").alias("ends"))
        going = going.where(F.size("ids") > F.col("depth")).withColumn("digit", F.get("ids", F.col("depth")))
        large.append(checkpointed(known.join(ended, "bucket", "left")))
        parts = going.groupBy("bucket", "depth", "digit").agg(F.count("*").alias("rows"), F.min("conv_id").alias("next"), F.sum("n").alias("weight"), F.sum(F.size("ids") - F.col("depth")).alias("left"), F.first("path").alias("path"))
        more = checkpointed(parts.where((F.col("rows") > 1) & (F.col("left") > local_turns)))
        count = more.count()
        split = going.drop("path").join(_small(more.select("bucket", "digit", "next"), count), ["bucket", "digit"], "left")
        done.append(split.where("next is null").select(F.col("bucket").alias("parent_conv_id"), (F.col("depth") + 1).alias("depth"), "digit", "conv_id", "n", "ends_sha256", "ids", "sizes"))
        if count:
            rows = checkpointed(split.where("next is not null").select("conv_id", "n", "ends_sha256", "ids", "sizes", F.col("next").alias("bucket")))
            known = more.select(F.col("next").alias("bucket"), (F.col("depth") + 1).alias("first_depth"), F.col("weight").alias("n"), F.col("bucket").alias("parent_conv"), "path")
    finished = done[0]
    for other in done[1:]:
        finished = finished.unionByName(other)
    small = checkpointed(_finished(finished))
    chains = large[0]
    for other in large[1:]:
        chains = chains.unionByName(other)
    return small.drop("top").unionByName(_large_nodes(chains, small))


def _large_nodes(chains: DataFrame, small: DataFrame) -> DataFrame:
    """The nodes of the large buckets: one for each depth from first_depth to depth, with the sums of what is below."""
    tops = small.where("top").groupBy(F.col("parent_conv_id").alias("bucket"), (F.col("depth").cast("int") - 1).alias("depth")).agg(F.count("*").alias("kids"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    branches = chains.where("parent_conv is not null").groupBy(F.col("parent_conv").alias("bucket"), (F.col("first_depth") - 1).alias("depth")).agg(F.count("*").alias("more_kids"))
    # what each shared turn of the chain saves, from first_depth on; the root has no turn
    shared = F.slice("sizes", F.greatest(F.col("first_depth"), F.lit(1)), F.col("depth") - F.greatest(F.col("first_depth"), F.lit(1)) + 1)
    own = chains.withColumn("saves", F.transform(shared, lambda b: b.cast("long") * (F.col("n") - 1)))
    own = own.withColumn("chain", F.aggregate("saves", F.lit(0).cast("long"), lambda a, b: a + b))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    full = checkpointed(own.join(tops, ["bucket", "depth"], "left").join(branches, ["bucket", "depth"], "left").withColumns({c: zero(F.col(c)) for c in ("kids", "leaves", "saved", "more_kids")}))
    spread = full.select("leaves", "saved", "chain", F.col("bucket").alias("of"), F.col("depth").alias("at"), F.explode("path").alias("up"))
    below = spread.groupBy(F.col("up.conv").alias("bucket"), F.col("up.depth").alias("depth")).agg(
        F.sum("leaves").alias("all_leaves"),
        F.sum(F.col("saved") + F.when((F.col("of") == F.col("up.conv")) & (F.col("at") == F.col("up.depth")), F.lit(0)).otherwise(F.col("chain"))).alias("all_saved"),
    )
    each = full.join(below, ["bucket", "depth"]).select("*", F.explode(F.sequence("first_depth", "depth")).alias("d"))
    last, first = F.col("d") == F.col("depth"), F.col("d") == F.col("first_depth")
    # the turns of the chain from depth d on; `saves` starts at depth max(first_depth, 1)
    from_here = F.slice("saves", F.greatest(F.col("d") - F.greatest(F.col("first_depth"), F.lit(1)) + 1, F.lit(1)), F.size("saves"))
    return each.select(
        F.col("bucket").alias("conv_id"),
        F.col("d").cast("long").alias("depth"),
        F.when(first, F.col("parent_conv")).otherwise(F.col("bucket")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(last, F.col("kids") + F.col("more_kids")).otherwise(F.lit(1)).cast("long").alias("n_children"),
        F.col("all_leaves").cast("long").alias("n_leaves"),
        (F.col("all_saved") + F.aggregate(from_here, F.lit(0).cast("long"), lambda a, b: a + b)).cast("long").alias("saved_tokens"),
        F.when(last, F.coalesce("ends", F.lit(NO_ENDS))).otherwise(F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def prefix_trie(rows: DataFrame, rebuilt: bool = False, local_turns: int = LOCAL_TURNS) -> DataFrame:
    """The trie of conversations given as turns; `rebuilt`: with heads shared as shared_heads() says."""
    coded = encoded(rows)
    return prefix_nodes(distinct_sequences(shared_heads(coded) if rebuilt else coded), local_turns)


def query(spark, sf_dir) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"), rebuilt=True)


ORACLE_SQL = """
WITH t AS (SELECT list(list_reduce(list_prepend(i::UBIGINT, range(8)::UBIGINT[]), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END) ORDER BY i) AS crcs FROM range(256) r(i)),
said AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
heads AS (SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(regexp_extract_all(hex(conv_id::VARCHAR), '..'), lambda h: ('0x' || h)::UBIGINT)), lambda a, x: xor(a >> 8, crcs[(xor(a, x) & 255)::INT + 1])), 4294967295::UBIGINT)::BIGINT % 9 AS h FROM (SELECT DISTINCT conv_id FROM said), t),
parts AS (
    SELECT heads.conv_id, 0 AS part, i, role, text FROM heads JOIN said ON said.conv_id = base WHERE i <= h
    UNION ALL SELECT heads.conv_id, 1, i, role, text FROM heads JOIN said USING (conv_id) WHERE i > h
),
turns AS (SELECT heads.conv_id, coalesce(list(struct_pack(role := role, text := text) ORDER BY part, i) FILTER (WHERE part IS NOT NULL), []) AS said FROM heads LEFT JOIN parts ON parts.conv_id = heads.conv_id GROUP BY heads.conv_id),
prefixes AS (SELECT conv_id, d::BIGINT AS d, said[1:d] AS prefix, len(said) AS n FROM turns, unnest(range(0, len(said) + 1)) r(d)),
nodes AS (SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CASE WHEN n = d THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256, CASE WHEN d > 0 THEN (count(*) - 1) * strlen(prefix[d].text) ELSE 0 END AS saved FROM prefixes GROUP BY prefix, d),
linked AS (SELECT c.*, p.conv_id AS parent_conv_id FROM nodes c LEFT JOIN nodes p ON c.d = p.d + 1 AND p.prefix = c.prefix[1:c.d - 1]),
kids AS (SELECT parent_conv_id AS conv_id, d - 1 AS d, count(*) AS n_children FROM linked WHERE parent_conv_id IS NOT NULL GROUP BY ALL),
full_nodes AS (SELECT linked.*, coalesce(n_children, 0) AS n_children FROM linked LEFT JOIN kids ON kids.conv_id = linked.conv_id AND kids.d = linked.d),
sums AS (SELECT a.prefix[1:u] AS prefix, u AS d, sum(a.saved)::BIGINT AS saved_tokens, sum(CASE WHEN a.n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves FROM full_nodes a, unnest(range(0, a.d + 1)) r(u) GROUP BY ALL)
SELECT f.conv_id, f.d AS depth, f.parent_conv_id, f.n_convs::BIGINT AS n_convs, f.n_children::BIGINT AS n_children, n_leaves, saved_tokens, ends_sha256 FROM full_nodes f JOIN sums USING (prefix, d)
"""
