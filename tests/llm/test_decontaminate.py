import math
import random
import re
from collections import Counter

import pytest

from chatloom.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def plain(text, items):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        b = words(t)
        if item is None or not b:
            continue
        n = min(13, len(b))
        for k in range(len(b) - n + 1):
            for i in range(len(w) - n + 1):
                if w[i : i + n] == b[k : k + n]:
                    hit |= set(range(i, i + n))
                    found.add(str(item))
    return len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)


def bench(spark, items):
    return spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, terms string")


def plain_near(rows, items, slop=5, rare=3):
    """Per document the items with a window whose rarest words, and 0.8 of all, stand within slop words of their places."""
    docs = {i: words(t) for i, t in rows}
    seen = Counter(w for d in docs.values() for w in d)
    out = {i: set() for i in docs}
    for item, t in items:
        b = words(t)
        n = min(13, len(b))
        for k in range(len(b) - n + 1 if b and item is not None else 0):
            order = sorted((seen[w], at, w) for at, w in enumerate(b[k : k + n]) if seen[w])
            for i, d in docs.items():
                for p in (p for p, w in enumerate(d) if order and w == order[0][2]):
                    near = [w in d[max(0, p - order[0][1] + at - slop) : max(0, p - order[0][1] + at + slop + 1)] for _, at, w in order]
                    if sum(near) >= math.ceil(0.8 * n) and all(near[:rare]):
                        out[i].add(str(item))
    return {i: sorted(v) for i, v in out.items()}


@pytest.mark.parametrize("small", [True, False])
def test_against_brute_force(spark, docs, small, monkeypatch):
    if not small:
        for name in ("BROADCAST_BYTES", "BROADCAST_TERMS", "BROADCAST_ROWS"):
            monkeypatch.setattr(D, name, -1)
    rng = random.Random(4)
    vocabulary = ["the", "of", "Éa", "éa", "naïve", "x1", "Straße", "日本", "ſ", "µ", "K", "rare"]
    text = lambda n: rng.choice([" ", "-", "\n", "_ "]).join(rng.choice(vocabulary) + rng.choice(["", "", str(rng.randint(0, 9))]) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 5, 13, 14, 40]))) for i in range(14)] + [(3, text(20)), (20, ""), (21, None), (None, "the of"), (22, "the the the"), (23, "of " * 30)]
    rows = [(i, text(rng.randint(0, 120))) for i in range(60)]
    for k in range(40):
        b = words(rng.choice(items)[1])
        rows.append((100 + k, f"{text(rng.randint(0, 300))} {' '.join(b[rng.randint(0, 3):]).upper() if k % 2 else '; '.join(b)} {text(5)}"))
    for k in range(12):
        b = words(items[k][1])
        b[rng.randrange(len(b) + 1) : 0] = ["new"] * rng.randint(0, 2)
        rows.append((150 + k, f"{text(9)} {' '.join(b)} {text(5)}"))
    rows += [(200, None), (201, ""), (202, "--- ___"), (203, "of " * 2000), (None, "the the the")]
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated, r.near_items) for r in D.contamination(docs(rows), bench(spark, items)).collect()}
    near = plain_near(rows, items)
    for i, t in rows:
        assert got[i] == (*plain(t, items), near[i]), (i, t)
    assert sum(v[3] for v in got.values()) > 10 and sum(set(v[2]) < set(v[4]) for v in got.values()) > 5
    slim = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in D.contamination(docs(rows), bench(spark, items), proximity=False).collect()}
    assert slim == {i: v[:4] for i, v in got.items()}


def test_repeated_rows_and_empty(spark, docs):
    items = bench(spark, [(1, "one two three")])
    got = D.contamination(docs([(1, "one two three"), (1, "one two three"), (1, "four")]), items).collect()
    assert sorted((r.n_hit, r.n_words) for r in got) == [(0, 1), (3, 3), (3, 3)]
    assert D.contamination(docs([]), items).count() == 0
    assert D.contamination(docs([(1, "one two three")]), items.limit(0)).first().contaminated is False


def test_proximity(spark, docs):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"
    rows = [(1, "x " * 9 + item), (2, "x beta gamma delta zeta epsilon eta inserted iota theta kappa lambda mu nu y"), (3, "alpha " + "x " * 40 + "beta nu"), (4, item.replace("mu", "other")), (5, "alpha alpha mu mu mu")]
    got = {r.doc_id: (r["items"], r.near_items) for r in D.contamination(docs(rows), bench(spark, [(7, item)])).collect()}
    assert got[1] == (["7"], ["7"]) and got[2] == ([], ["7"]) and got[3] == ([], [])
    assert got[4] == ([], ["7"])


def test_common_passages_and_long_texts(spark, docs):
    """A passage in most documents, many items that share it, and a very long text: all found, each row once."""
    shared = " ".join(f"w{k}" for k in range(60))
    items = [(k, f"{shared} own{k} words{k}") for k in range(30)]
    rows = [(k, f"before{k} {shared} after") for k in range(300)] + [(1000, f"{shared} gap " * 400 + "own3 words3"), (1001, "w1 " * 20_000)]
    got = {r.doc_id: (r.n_hit, len(r["items"])) for r in D.contamination(docs(rows), bench(spark, items)).collect()}
    assert all(got[k] == (60, 30) for k in range(300)) and got[1000] == (24_000, 30) and got[1001] == (0, 0)


def test_long_near_copies_in_linear_work(spark, docs):
    """A benchmark text of 6,000 words, copied with every 40th word changed and with every tenth: each window costs the
    same, however many words are missing, and exactly the whole windows count."""
    text = [f"w{i}x" for i in range(6000)]
    change = lambda k: [f"new{i}" if i % k == k - 1 else w for i, w in enumerate(text)]
    rows = [(1, " ".join(change(40))), (2, " ".join(change(10))), (3, " ".join(text)), (4, "before " + " ".join(text[100:112]) + " after")]
    got = {r.doc_id: (r.n_words, r.n_hit, r.contaminated) for r in D.contamination(docs(rows), bench(spark, [(1, " ".join(text))]), proximity=False).collect()}
    assert got == {1: (6000, 5850, True), 2: (6000, 0, False), 3: (6000, 6000, True), 4: (14, 0, False)}
