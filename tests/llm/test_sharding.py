import zlib

from chatloom.llm import sharding


def shards(df, n):
    return [r.asDict() for r in sharding.balanced_shards(df, n).collect()]


def test_balanced_contiguous_and_gapless(docs):
    rows = [(i * 3 % 1000, "x" * (i * 7919 % 500)) for i in range(1000)]
    got = shards(docs(rows), 7)
    size = {i: len(t.encode()) + 16 for i, t in rows}
    assert len(got) == 1000 and all(r["size"] == size[r["id"]] and r["text_crc32"] == zlib.crc32(b"x" * (r["size"] - 16)) for r in got)
    total, largest = sum(size.values()), max(size.values())
    by = {}
    for r in sorted(got, key=lambda r: r["position"]):
        by.setdefault(r["shard"], []).append(r)
    assert list(by) == list(range(7)) and [r["id"] for s in by.values() for r in s] == sorted(size)
    for own in by.values():
        assert [r["slot"] for r in own] == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 7) <= largest


def test_nulls_ties_and_copies(docs):
    got = shards(docs([(None, None), (None, "é"), (5, "a"), (5, "a"), (5, "a")] * 20), 4)
    assert len(got) == 100 and sorted({r["size"] for r in got}) == [16, 17, 18]
    assert {r["text_crc32"] for r in got if r["size"] == 16} == {0}
    assert {r["shard"] for r in got} == {0, 1, 2, 3}
    for s in range(4):
        own = sorted(r["slot"] for r in got if r["shard"] == s)
        assert own == list(range(len(own)))


def test_empty(docs):
    assert shards(docs([]), 40) == []


def plain(rows, n):
    """(id, size, crc, shard, slot) by one running sum over all rows."""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    sizes = [len((t or "").encode()) + 16 for _, t in ordered]
    out, upto, slots = [], 0, [0] * n
    for (i, t), size in zip(ordered, sizes):
        upto += size
        shard = min((2 * upto - size) * n // (2 * sum(sizes)), n - 1)
        out.append((i, size, zlib.crc32((t or "").encode()), shard, slots[shard]))
        slots[shard] += 1
    return out


def test_against_brute_force(docs):
    import random

    rng = random.Random(9)
    rows = [(k * 7 % 2003, rng.choice([None, "", "\u00e9" * rng.randint(0, 50), "x" * rng.randint(0, 4000)])) for k in range(2003)] + [(None, "x" * 300_000)]
    for n in (1, 7, 40):
        assert sorted(map(str, ((r["id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in shards(docs(rows, 16), n)))) == sorted(map(str, plain(rows, n)))
