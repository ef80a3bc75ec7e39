import numpy as np
import pytest

from chatloom.llm import embedding_dedup as E

SCHEMA = "vec_id long, embedding array<float>, label int, component_id string, class_id int"


def plain(rows, threshold=0.93):
    ok = [(i, np.array(v, float), l) for i, v, l in rows if l is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    n, parent = [0] * len(ok), list(range(len(ok)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(ok)):
        for b in range(a + 1, len(ok)):
            (_, u, k), (_, v, m) = ok[a], ok[b]
            if k == m and len(u) == len(v) and u @ v / np.sqrt((u @ u) * (v @ v)) >= threshold:
                n[a] += 1
                n[b] += 1
                parent[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for a in range(len(ok)):
        ids = [i for i in (ok[a][0], least.get(find(a))) if i is not None]
        least[find(a)] = min(ids) if ids else None
    out = {i: (0, i) for i, _, _ in rows}
    out.update({ok[a][0]: (n[a], least[find(a)]) for a in range(len(ok))})
    return out


def run(spark, rows, tile):
    df = spark.createDataFrame([(i, v, l, "x", 0) for i, v, l in rows], SCHEMA).repartition(3)
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in E.near_duplicates(df, tile=tile).collect()}


def clustered(rng, n, dim=16):
    centres = rng.normal(size=(12, dim))
    rows = []
    for i in range(n):
        v = centres[rng.integers(12)] + rng.normal(size=dim) * rng.choice([0.05, 0.3, 1.0])
        rows.append((i, [float(np.float32(x)) for x in v * rng.choice([0.01, 1, 50])], int(rng.integers(3))))
    return rows


@pytest.mark.parametrize("tile, block", [(4, 3), (16, 16), (1024, 16)])
def test_against_brute_force(spark, tile, block, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", block)
    rows = clustered(np.random.default_rng(1), 250)
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(60)]
    want = plain(rows)
    got = run(spark, rows, tile)
    assert {k: v[:2] for k, v in got.items()} == want and all(v[2] == (k == v[1]) for k, v in got.items())
    assert sum(n > 0 for n, _ in want.values()) > 60


def test_unusable_vectors(spark):
    one = [1.0, 0.0, 0.0]
    rows = [(1, one, None), (2, one, None), (3, None, 1), (4, [0.0] * 3, 1), (5, [0.0] * 3, 1), (6, [1.0, None, 0.0], 1), (7, [float("nan"), 1.0, 0.0], 1), (8, [float("inf"), 1.0, 0.0], 1), (9, [], 1), (10, one, 1), (11, [1.0, 0.0], 1), (12, [2.0, 0.0, -0.0], 1)]
    got = run(spark, rows, 4)
    assert got == {i: ((1, 10, i == 10) if i in (10, 12) else (0, i, True)) for i, _, _ in rows}


def test_null_ids_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 1, "x", 0), (4, [1.0, 0.01], 1, "x", 0), (4, [1.0, 0.01], 1, "x", 0)], SCHEMA)
    assert sorted(((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in E.near_duplicates(df).collect())) == [(0, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True)]
    assert E.near_duplicates(df.limit(0)).count() == 0


def test_bounds_never_lose_a_pair():
    rng = np.random.default_rng(3)
    a = np.concatenate([rng.normal(size=(60, 8)), np.eye(8) + 0.01])
    u = E._unit(a)
    basis = np.linalg.qr(rng.normal(size=(8, 8)))[0]
    for threshold in (0.2, 0.6, 0.93):
        i, j = E.linked_pairs(a, a, basis, threshold, True)
        assert set(zip(i.tolist(), j.tolist())) == {(x, y) for x in range(68) for y in range(x + 1, 68) if u[x] @ u[y] >= threshold}


def test_distant_boxes_are_not_compared(spark, monkeypatch):
    """Tiles of two far clusters of one label never meet: their block pairs are fewer than all."""
    rng = np.random.default_rng(5)
    ends = np.eye(8)[:4] * 3
    rows = [(k, [float(x) for x in ends[k % 4] + rng.normal(size=8) * 0.02], 1) for k in range(240)]
    pairs = []
    made = E._block_pairs
    monkeypatch.setattr(E, "_block_pairs", lambda *a: pairs.append(made(*a)) or pairs[-1])
    got = run(spark, rows, 8)
    want = plain(rows)
    assert {k: v[:2] for k, v in got.items()} == want
    assert pairs[0].where("not second").count() < 30 * 31 / 2 / 2


@pytest.mark.parametrize("dim, part", [(2, 1), (1, 2), (16, 2)])
def test_pairs_by_grid_cells(spark, dim, part, monkeypatch):
    """Blocks over many cells, with cells dealt out in many parts, meet once each: no link is lost or counted twice."""
    monkeypatch.setattr(E, "PART", part)
    monkeypatch.setattr(E, "BLOCK", 1)
    rows = clustered(np.random.default_rng(dim), 150, dim)
    got = run(spark, rows, 2)
    assert {k: v[:2] for k, v in got.items()} == plain(rows)
