"""Embedding near-dedup by PCA-ordered tiled comparison.

Equal vectors of a label are first merged into one class (its size counts as links). Classes are
ordered inside their label along a curve through the AXES principal coordinates that vary most
(their bits interleaved) and cut into tiles of at most `tile` vectors, each with its box in these
coordinates. Neighbouring tiles form blocks. Two blocks, and in them two tiles, are compared only if
their boxes come within the largest distance that the threshold allows. Inside a tile pair dot
products accumulate over the leading principal dimensions; the rest is bounded by the product of the
suffix norms, and a pair is dropped as soon as that bound falls below the threshold. What survives is
checked by the cosine of the original vectors in double precision. A block pair returns link counts
and a star per connected group, at most two rows a vector, never its links one by one.

A tile travels once for every block that its own block may meet, not for every tile, and is rotated
once for all of them; pairs of blocks are found by the cells of a grid that their boxes touch. The number
of pairs is still quadratic in the vectors of one label that no box keeps apart: in many dimensions
unrelated vectors are closer along any few axes than the threshold's distance.

The principal axes come from second moments over all vectors; they steer the pruning only and
cannot change the result.

Defined cases: a null label or vector, an empty or zero vector, or one with a null, NaN or infinite
component links with nothing; vectors of different length never link; rows with a null vec_id link
but never name a component; repeated rows are vectors of their own; a cosine equal to the threshold
links; of equal ids any may name a component; blocks hold fewer tiles the longer the vectors, one at
least; vec_id is an integer, others fail the cast; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, table, wide_hash
from .components import connected_components

#: Vectors in a tile; a tile pair holds tile * tile partial products (8 MB at 1024).
TILE = 1024
#: Coordinates that order the vectors, and the bits of each; those that bound a tile.
AXES, AXIS_BITS, BOX = 4, 12, 8
#: Tiles in a block at most, and their bytes.
BLOCK, BLOCK_BYTES = 16, 16 << 20
#: Axes of the grid on which pairs of blocks are found, and blocks of a part of a cell.
GRID, PART = 3, 64
#: Slack of the pruning bounds against rounding; the final check has none.
SLACK = 1e-9


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


def _prepared(v: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors, their principal coordinates, and the norms of these from each place on."""
    u = _unit(v)
    r = u @ basis
    return u, r, np.sqrt(np.maximum(0, np.cumsum((r * r)[:, ::-1], axis=1)[:, ::-1]))


def linked_pairs(a: np.ndarray, b: np.ndarray, basis: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Indices (i, j) of rows of a and b whose cosine reaches the threshold; i < j if a is b."""
    return _linked(_prepared(a, basis), _prepared(b, basis), threshold, same)


def _linked(a: tuple, b: tuple, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    (ua, ra, rest_a), (ub, rb, rest_b) = a, b
    d = ra.shape[1]
    partial, at, few = np.zeros((len(ua), len(ub))), 0, max(1000, len(ua) * len(ub) // 20)
    while True:  # whole tiles, while many pairs are alive
        to = min(d, max(4, 2 * at))
        partial += ra[:, at:to] @ rb[:, at:to].T
        at = to
        bound = partial + np.outer(rest_a[:, at], rest_b[:, at]) if at < d else partial
        alive = bound >= threshold - SLACK
        if at == d or np.count_nonzero(alive) <= few:
            break
    i, j = np.nonzero(np.triu(alive, 1) if same else alive)
    part = partial[i, j]
    while at < d and len(i):  # then pair by pair
        to = min(d, 2 * at)
        part = part + np.einsum("ij,ij->i", ra[i, at:to], rb[j, at:to])
        at = to
        keep = part + (rest_a[i, at] * rest_b[j, at] if at < d else 0) >= threshold - SLACK
        i, j, part = i[keep], j[keep], part[keep]
    sure = [np.einsum("ij,ij->i", ua[i[k : k + 65536]], ub[j[k : k + 65536]]) >= threshold for k in range(0, len(i), 65536)]
    keep = np.concatenate(sure) if sure else np.zeros(0, bool)
    return i[keep], j[keep]


def _stars(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (x, y) as stars: each node with the smallest of its component here."""
    nodes, at = np.unique(np.concatenate([x, y]), return_inverse=True)
    x, y = at[: len(x)], at[len(x) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    off = label != np.arange(len(nodes))
    return nodes[label[off]], nodes[off]


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])


@dataclass
class Axes:
    basis: np.ndarray  # the principal axes as columns, leading first
    order: np.ndarray  # their numbers, by falling variance
    mean: np.ndarray  # of each coordinate
    spread: np.ndarray

    def curve(self, r: np.ndarray) -> np.ndarray:
        """The place of each row of coordinates on the curve through the first AXES axes."""
        place = np.zeros(len(r), np.int64)
        cells = [np.clip(((r[:, k] - self.mean[k]) / (6 * self.spread[k] + 1e-12) + 0.5) * (1 << AXIS_BITS), 0, (1 << AXIS_BITS) - 1).astype(np.int64) for k in self.order[:AXES]]
        for bit in reversed(range(AXIS_BITS)):
            for cell in cells:
                place = (place << 1) | ((cell >> bit) & 1)
        return place


def _axes(classes: DataFrame) -> dict[int, Axes]:
    """The axes for each vector length."""

    def moments(frames):
        for pdf in frames:
            for dim, group in pdf.groupby("dim"):
                u = _unit(_matrix(group["embedding"]))
                values = np.concatenate([[len(u)], u.sum(0), (u.T @ u).ravel()])
                yield pd.DataFrame({"dim": dim, "i": np.arange(len(values)), "x": values})

    sums: dict[int, list] = {}
    # dim * (dim + 1) + 1 rows for each vector length
    for r in classes.select("dim", "embedding").mapInPandas(moments, "dim int, i int, x double").groupBy("dim", "i").agg(F.sum("x").alias("x")).orderBy("dim", "i").collect():
        sums.setdefault(r["dim"], []).append(r["x"])
    axes = {}
    for d, x in sums.items():
        n, mean, second = x[0], np.array(x[1 : d + 1]), np.array(x[d + 1 :]).reshape(d, d)
        value, vector = np.linalg.eigh(second / n)
        basis = vector[:, ::-1].copy()
        centre = mean / n @ basis
        spread = np.sqrt(np.maximum(0, value[::-1] - centre**2))
        axes[d] = Axes(basis, np.argsort(-spread, kind="stable"), centre, spread)
    return axes


def _tiles(classes: DataFrame, axes: dict, tile: int) -> DataFrame:
    """tile_id, label, dim, lo and hi (the box), ids, weights, vectors; ids follow each other along the order."""
    shared = classes.sparkSession.sparkContext.broadcast(axes)  # dim * dim numbers

    def project(frames):
        for pdf in frames:
            x = np.zeros(len(pdf), np.int64)
            for dim, at in pdf.groupby("dim").indices.items():
                known = shared.value[dim]
                x[at] = known.curve(_unit(_matrix(pdf["embedding"].iloc[at])) @ known.basis)
            yield pdf.assign(x=x)

    def cut(frames):
        held, key, number, part = [], None, 0, TaskContext.get().partitionId()

        def emit():
            nonlocal number, held
            pdf = pd.concat(held)
            held, number = [], number + 1
            vectors, known = _matrix(pdf["embedding"]), shared.value[key[1]]
            r = _unit(vectors) @ known.basis[:, known.order[:BOX]]
            return pd.DataFrame({"tile_id": [(part << 32) + number], "label": [key[0]], "dim": [key[1]], "lo": [r.min(axis=0)], "hi": [r.max(axis=0)], "ids": [pdf["class_id"].to_numpy()], "weights": [pdf["weight"].to_numpy()], "vectors": [vectors.tobytes()]})

        for pdf in frames:
            for new, group in pdf.groupby(["label", "dim"], sort=False):
                if held and new != key:
                    yield emit()
                key = new
                while len(group):
                    room = tile - sum(map(len, held))
                    held.append(group.iloc[:room])
                    group = group.iloc[room:]
                    if sum(map(len, held)) == tile:
                        yield emit()
        if held:
            yield emit()

    named = ", ".join(f"{n} {t}" for n, t in classes.dtypes)
    label = dict(classes.dtypes)["label"]
    ordered = classes.mapInPandas(project, f"{named}, x long").repartitionByRange("label", "dim", "x", "class_id").sortWithinPartitions("label", "dim", "x", "class_id")
    return ordered.mapInPandas(cut, f"tile_id long, label {label}, dim int, lo array<double>, hi array<double>, ids array<long>, weights array<long>, vectors binary")


def _block_pairs(tiles: DataFrame, reach: float) -> DataFrame:
    """pair_id, block, second: the blocks of each pair whose boxes come within reach, and which of the two it is. Boxes are
    laid over a grid of width reach along GRID axes, the second widened by reach, and meet by equality of cells; of the
    cells that two boxes share, that of their lowest corner counts. Where no cell keeps blocks apart, a cell is dealt
    out in parts of PART blocks, so tasks grow in number and not in size."""
    sides = [f(F.get(c, F.lit(k))).alias(f"{c}{k}") for c, f in (("lo", F.min), ("hi", F.max)) for k in range(BOX)]
    blocks = checkpointed(tiles.groupBy("label", "dim", "block").agg(*sides))  # no vectors
    parts = max(1, -(-blocks.count() // PART))
    width = max(reach, 1e-3)

    def laid(more: float, suffix: str) -> DataFrame:
        out = blocks
        for k in range(GRID):  # shorter vectors have fewer axes
            first, last = (F.coalesce(F.floor((F.col(f"{side}{k}") + d) / width), F.lit(0)) for side, d in (("lo", -more), ("hi", more)))
            out = out.withColumn(f"first{k}", first).withColumn(f"cell{k}", F.explode(F.sequence(first, last)))
        return out.select(*(F.col(c).alias(c + suffix) for c in out.columns))

    a = laid(0.0, "_a").withColumn("part_a", F.pmod(F.xxhash64("block_a"), F.lit(parts)).cast("int"))
    b = laid(reach, "_b").withColumn("part_b", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    same = (a.label_a == b.label_b) & (a.dim_a == b.dim_b) & (a.part_a == b.part_b) & (a.block_a <= b.block_b)
    for k in range(GRID):
        same = same & (a[f"cell{k}_a"] == b[f"cell{k}_b"]) & (a[f"cell{k}_a"] == F.greatest(a[f"first{k}_a"], b[f"first{k}_b"]))
    met = a.join(b, same)
    gap = F.lit(0.0)
    for k in range(BOX):
        apart = F.greatest(F.col(f"lo{k}_b") - F.col(f"hi{k}_a"), F.col(f"lo{k}_a") - F.col(f"hi{k}_b"), F.lit(0.0))
        gap = gap + F.coalesce(apart * apart, F.lit(0.0))
    near = checkpointed(met.where(gap <= reach * reach).select("block_a", "block_b").withColumn("pair_id", F.monotonically_increasing_id()))
    both = F.array(F.struct(F.col("block_a").alias("block"), F.lit(False).alias("second")), F.struct(F.col("block_b").alias("block"), F.lit(True).alias("second")))
    return near.select("pair_id", F.inline(F.when(F.col("block_a") == F.col("block_b"), F.slice(both, 1, 1)).otherwise(both)))


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, tile: int = TILE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & (F.size("embedding") > 0) & ~bad & F.exists("embedding", lambda x: x != 0), F.lit(False))
    high, low = wide_hash(F.col("embedding"))
    keyed = rows.withColumn("usable", usable)
    valid = keyed.where("usable").withColumn("h1", high).withColumn("h2", low)

    classes = checkpointed(
        valid.groupBy("label", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("weight"), F.first("h1").alias("h1"), F.first("h2").alias("h2"))
        .withColumn("dim", F.size("embedding")).withColumn("class_id", F.monotonically_increasing_id())
    )
    axes = _axes(classes)
    tiles = checkpointed(_tiles(classes.select("class_id", "label", "dim", "weight", "embedding"), axes, tile))

    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK)
    count, longest = tiles.count(), max(axes, default=1)
    size = max(1, min(BLOCK, count // 16, BLOCK_BYTES // (tile * longest * 8)))  # small tables keep enough pairs for all cores
    # Tiles of one block follow each other in one partition; labels and lengths are told apart by the tile's own number.
    first = F.min("tile_id").over(Window.partitionBy("label", "dim", F.shiftright("tile_id", 32), F.expr(f"(tile_id & 4294967295) div {size}")))
    blocked = checkpointed(tiles.select("tile_id", "label", "dim", "lo", "hi").withColumn("block", first))
    pairs = _block_pairs(blocked, reach)
    members = blocked.select("tile_id", "block").join(tiles.select("tile_id", "dim", "lo", "hi", "ids", "weights", "vectors"), "tile_id")
    shared = vectors.sparkSession.sparkContext.broadcast({d: x.basis for d, x in axes.items()})

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        ready: list[tuple] = []
        for r in pdf.sort_values(["second", "tile_id"]).itertuples():
            basis = shared.value[int(r.dim)]
            ready.append((r, np.asarray(r.ids), np.asarray(r.weights), _prepared(np.frombuffer(r.vectors, np.float64).reshape(-1, r.dim), basis)))
        one = [x for x in ready if not x[0].second]
        two = [x for x in ready if x[0].second] or one
        ids, adds, roots, nodes = [], [], [], []
        for ra, ids_a, weight_a, a in one:
            for rb, ids_b, weight_b, b in two:
                if two is one and rb.tile_id < ra.tile_id:
                    continue
                gap = np.maximum(0, np.maximum(np.asarray(rb.lo) - np.asarray(ra.hi), np.asarray(ra.lo) - np.asarray(rb.hi)))
                if gap @ gap > reach * reach:
                    continue
                i, j = _linked(a, b, threshold, ra.tile_id == rb.tile_id)
                if len(i):
                    ids += [ids_a, ids_b]
                    adds += [np.bincount(i, weight_b[j], len(ids_a)), np.bincount(j, weight_a[i], len(ids_b))]
                    root, node = _stars(ids_a[i], ids_b[j])
                    roots.append(root)
                    nodes.append(node)
        if not ids:
            return pd.DataFrame({"link": np.zeros(0, bool), "x": np.zeros(0, np.int64), "y": np.zeros(0, np.int64)})
        known, at = np.unique(np.concatenate(ids), return_inverse=True)
        total = np.bincount(at, np.concatenate(adds)).astype(np.int64)
        root, node = _stars(np.concatenate(roots), np.concatenate(nodes))
        some = total > 0
        return pd.DataFrame({"link": np.repeat([False, True], [some.sum(), len(node)]), "x": np.concatenate([known[some], root]), "y": np.concatenate([total[some], node])})

    found = checkpointed(pairs.join(members, "block").groupBy("pair_id").applyInPandas(compare, "link boolean, x long, y long"))

    added = found.where("not link").groupBy(F.col("x").alias("class_id")).agg(F.sum("y").alias("added"))
    roots = connected_components(found.where("link"), "x", "y").withColumnRenamed("node", "class_id")
    slim = classes.select("class_id", "label", "h1", "h2", "least", "weight")
    names = roots.join(slim.select("class_id", "least"), "class_id").groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.join(names, "root").select("class_id", "component_id")
    info = slim.join(added, "class_id", "left").join(named, "class_id", "left").select(
        "label", "h1", "h2", (F.col("weight") - 1 + F.coalesce("added", F.lit(0))).cast("long").alias("n_links"), F.coalesce("component_id", "least").alias("component_id")
    )
    linked = valid.select("vec_id", "label", "h1", "h2").join(info, ["label", "h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = keyed.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def query(spark, sf_dir) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT vec_id AS a, vec_id AS c FROM v UNION SELECT l.b, r.c FROM r JOIN l ON r.a = l.a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a), m AS (SELECT a, min(c) AS c FROM r GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(c, vec_id) AS component_id, coalesce(c, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN n ON vec_id = n.a LEFT JOIN m ON vec_id = m.a
"""
