import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from chatloom.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, ids string, n long, bucket string, top boolean, path string"


def table_of(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, "x", 1, "y", True, "z") for r in rows], SCHEMA).repartition(partitions)


def plain(rows, rebuilt=True):
    """The nodes as the contract words them, from a dictionary of prefixes."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    if rebuilt:
        built = {}
        for c, said in own.items():
            h = zlib.crc32(str(c).encode()) % 9
            built[c] = own.get(c - c % 5, [])[:h] + said[h:]
        own = built
    members = defaultdict(list)
    for c, said in own.items():
        for d in range(len(said) + 1):
            members[tuple(said[:d])].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0) + sum(saved[k] for k in kids[p])
    out = []
    for p, own_members in members.items():
        ends = ",".join(str(c) for c in sorted(own_members) if len(own[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(own_members), len(p), parent, len(own_members), len(kids[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def random_rows(seed, convs, words="abc", longest=6):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for turn in range(rng.randint(0, longest)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(words) * rng.randint(1, 2)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("local", [1, 6, prefix_trie.LOCAL_TURNS])
def test_random_conversations(spark, local):
    rows = random_rows(local, 60)
    assert found(prefix_trie.prefix_trie(table_of(spark, rows), rebuilt=True, local_turns=local)) == plain(rows)


def test_one_long_shared_head(spark):
    """A large bucket whose rows share many turns takes one round, and copies count once."""
    head = [("user", f"h{k}é") for k in range(40)]
    rows = [(c, t, role, text) for c in range(30) for t, (role, text) in enumerate([*head, ("assistant", f"end {c % 4}"), *[("user", "x")] * (c % 3)])]
    assert found(prefix_trie.prefix_trie(table_of(spark, rows), local_turns=8)) == plain(rows, rebuilt=False)


def test_large_buckets_are_shuffled_beyond_the_bound(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BROADCAST_ROWS", 0)
    rows = random_rows(7, 40)
    assert found(prefix_trie.prefix_trie(table_of(spark, rows), rebuilt=True, local_turns=4)) == plain(rows)


def test_odd_rows(spark):
    """Nulls anywhere, repeated rows, turns that tie, empty and very long texts, absent bases, sparse and negative ids."""
    rows = [
        (3, None, None, None), (3, None, "user", "b"), (3, 1, "user", ""), (3, 1, "user", ""), (3, 2, "b", "x"), (3, 2, "a", "y"), (3, 2, "a", "x"),
        (7, 0, "user", "long " * 200_000), (7, 1, None, "ü"), (5, 0, "user", "long " * 200_000), (None, 0, "user", "lost"),
        (10**15, 5, "user", "b"), (9, 0, "user", "b"), (9, 0, "user", "b"), (-10, 0, "user", "b"), (-10, 1, "a", None),
    ]
    for local in (1, 100):
        assert found(prefix_trie.prefix_trie(table_of(spark, rows), rebuilt=True, local_turns=local)) == plain(rows)


def test_ends_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", 2)
    rows = [(c, 0, "user", "same") for c in range(0, 70, 3)] + [(200, 0, "user", "same"), (200, 1, "user", "more")]
    assert found(prefix_trie.prefix_trie(table_of(spark, rows))) == plain(rows, rebuilt=False)


def test_empty_table(spark):
    assert prefix_trie.prefix_trie(table_of(spark, []), rebuilt=True).collect() == []
    assert prefix_trie.prefix_trie(table_of(spark, [(None, 1, "user", "x")])).collect() == []


def test_sql(spark, tmp_path):
    rows = random_rows(11, 50, words=["é", "bb"]) + [(3, None, None, None), (3, 0, "z", "tie")]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    got = con.execute(prefix_trie.ORACLE_SQL).fetchall()
    assert sorted(got, key=str) == plain(rows)


def test_multikey_nodes_of_one_sequence():
    nodes = prefix_trie.multikey_nodes([4], [3], ["end"], [[9, 8]], [[2, 5]], 0, None)
    assert list(zip(*nodes)) == [(4, 0, None, 3, 1, 1, 14, prefix_trie.NO_ENDS), (4, 1, 4, 3, 1, 1, 14, prefix_trie.NO_ENDS), (4, 2, 4, 3, 0, 1, 10, "end")]
