from itertools import permutations

import duckdb
import pytest

from chatloom.llm import filter_audit

WORDS = " ".join(f"w{i}" for i in range(250))
ROWS = [
    # doc_id, text, source
    (1, WORDS, "a"), (2, WORDS, "a"), (2, WORDS, "a"), (3, WORDS, None), (4, WORDS, ""), (None, WORDS, "b"), (None, None, None),
    (5, "same " * 300, "a"), (6, "A" * 60 + WORDS, "a"), (7, WORDS + " $ cost", "b"), (8, None, "b"), (9, "", "b"), (10, "   \n\t", "c'\"\\"),
    (11, "Ünï " * 130 + "x " * 70, "a"), (12, "Same same " * 150, "a"), (13, WORDS + "  ", "a"), (14, "z" * 3_000_000, "a"),
    (15, " ".join(["y"] * 100 + [f"k{i}" for i in range(99)]), "a"), (16, " ".join(["y"] * 101 + [f"k{i}" for i in range(99)]), "a"), (17, "|&#" + WORDS, "b"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (5, 1, 1), (5, 0, 0), (7, None, 1), (7, 1, None), (8, 1, 1), (None, 1, 1), (99, 1, 1), (12, 0, 1)]


def frames(spark, rows=ROWS, labels=LABELS):
    docs = spark.createDataFrame([(i, t, s, "x", 1, 2, "y") for i, t, s in rows], "doc_id long, text string, source string, part string, mask int, h1 int, content string")
    return docs.repartition(3), spark.createDataFrame([(*x, "z") for x in labels], "doc_id long, quality int, toxic int, good string").repartition(2)


def words_of(text):
    out, now = [], ""
    for c in text + " ":
        if c in " \t\n\x0b\x0c\r":
            if now:
                out.append(now)
            now = ""
        else:
            now += c
    return out


def plain(rows, labels):
    out, failed = {}, []
    for i, text, source in rows:
        text, fails = text or "", set()
        words = words_of(text)
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text):
            fails.add("C")
        if any(c in "#$%&*|" for c in text):
            fails.add("D")
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows):
            fails.add("E")
        mine = [x for x in labels if i is not None and x[0] == i]
        failed.append((source or "", fails, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    for part in {f[0] for f in failed}:
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = [f for f in failed if f[0] == part]
            gone = []
            for step, letter in enumerate(order, 1):
                removed = [f for f in left if letter in f[1]]
                redundant = sum(letter in f[1] for f in gone)
                left = [f for f in left if letter not in f[1]]
                gone += removed
                shapley[letter] += len(removed)
                unique = sum(f[0] == part and f[1] == {letter} for f in failed)
                out[part, "".join(order), step] = [len(left), len(removed), redundant, unique, sum(f[2] for f in removed), sum(f[3] for f in removed), letter]
        for key, value in out.items():
            if key[0] == part:
                value[-1] = shapley[value[-1]]
    return sorted((*k, *v) for k, v in out.items())


def test_every_order(spark):
    assert sorted(map(tuple, filter_audit.audit(*frames(spark)).collect())) == plain(ROWS, LABELS)


def test_sql():
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR); CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", ROWS)
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", LABELS)
    assert sorted(con.execute(filter_audit.ORACLE_SQL).fetchall()) == plain(ROWS, LABELS)


@pytest.mark.parametrize("rows, labels, n", [([], LABELS, 0), ([(1, None, None)], [], 600)])
def test_small_tables(spark, rows, labels, n):
    got = filter_audit.audit(*frames(spark, rows, labels)).collect()
    assert len(got) == n and sorted(map(tuple, got)) == plain(rows, labels)


def test_lattice(spark):
    """80 edges; each of the 120 orders is a path of five."""
    steps = filter_audit.paths(spark).collect()
    assert len(steps) == 600 and len({(s.applied, s.next) for s in steps}) == 80
