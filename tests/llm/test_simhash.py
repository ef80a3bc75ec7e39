import random
import re

import xxhash

from chatloom.llm import components, simhash


def plain_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints):
    parent = {k: k for k in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if bin(prints[a] ^ prints[b]).count("1") <= 2:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def sample(rng):
    base = [" ".join(rng.choice(["alpha", "Beta", "GAMMA", "élan", "ÉLAN", "x\x1cy"]) + str(rng.randint(0, 60)) for _ in range(rng.randint(80, 400))) for _ in range(25)]
    rows = [None, "", "  \t\n", "one", "one two", "a b c", "A  b\nC", "x " * 5000]
    for t in base:
        w = t.split(" ")
        rows += [t, t, " ".join([*w[:-1], "changed"]), " ".join(w[1:]), " ".join(rng.sample(w, len(w)))]
    return list(enumerate(rows))


def test_against_brute_force(docs):
    rows = sample(random.Random(5))
    got = {r.doc_id: r for r in simhash.near_duplicates(docs(rows)).collect()}
    prints = {i: plain_print(t) for i, t in rows}
    want = plain_components(prints)
    assert {i: r.fp % 2**64 for i, r in got.items()} == prints
    assert {i: r.component_id for i, r in got.items()} == want
    assert len(set(want.values())) < len(rows) - 25
    kept = simhash.one_of_each(docs(rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values())) and kept.columns == docs([]).columns


def test_chains_and_large_groups(spark):
    # A chain of fingerprints each one bit from the next, and a ball around one of them.
    chain = [sum(1 << k for k in range(n)) for n in range(40)]
    ball = [(1 << 63 | 1 << k) for k in range(20, 50)]
    rows = [(i, f - (1 << 64) if f >= 1 << 63 else f) for i, f in enumerate(chain + ball)]
    prints = spark.createDataFrame(rows * 3, "doc_id long, fp long")
    roots = {r.node: r.root for r in components.connected_components(simhash.links(prints)).collect()}
    want = plain_components({i: f % 2**64 for i, f in rows})
    groups = {}
    for i, f in rows:
        groups.setdefault(roots.get(f, f), set()).add(want[i])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))


def test_repeated_rows_and_nulls(docs):
    rows = [(5, "a b c d"), (5, "a b c d"), (5, "something quite different here"), (None, "a b c d"), (None, "only null ids have this text"), (3, "zz yy xx")]
    assert simhash.near_duplicates(docs(rows)).count() == 6
    kept = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in simhash.one_of_each(docs(rows)).collect())
    assert kept == [(False, 3, "zz yy xx"), (False, 5, "a b c d"), (False, 5, "something quite different here"), (True, 0, "only null ids have this text")]


def test_empty(docs):
    assert simhash.near_duplicates(docs([])).count() == 0 and simhash.one_of_each(docs([])).count() == 0


def test_components_of_random_links(spark):
    rng = random.Random(9)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1100)] + [(2000, 2000 + k) for k in range(1, 400)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in parent if any(x in (a, b) and a != b for a, b in links)}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
