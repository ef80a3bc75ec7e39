import random

import pytest

from chatloom.llm import license_scan, line_dedup
from chatloom.operators import validate


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) < len(b):
        a, b = b, a
    p = 0
    while p < len(b) and a[p] == b[p]:
        p += 1
    return a[p + 1 :] == (b[p + 1 :] if len(a) == len(b) else b[p:]) if p < len(a) else True


def plain(rows, near_chars=5):
    seen, out = [], {}
    for i, text in sorted(rows):
        kept, exact, near = [], 0, 0
        for raw in text.split("\n"):
            line = raw.strip(" \t\x0b\x0c\r")
            if not line:
                kept.append(raw)
            elif line in seen:
                exact += 1
            else:
                close = any(max(len(line), len(s)) >= near_chars and within_one(line, s) for s in seen)
                near += close
                kept += [] if close else [raw]
                seen.append(line)
        out[i] = (len(text.split("\n")), exact, near, "\n".join(kept))
    return out


def edited(rng, line):
    i, c = rng.randrange(len(line) + 1), rng.choice("abcé\U0001f600")
    return rng.choice([line[:i] + c + line[i:], line[:i] + line[i + 1 :], line[:i] + c + line[i + 1 :]])


@pytest.mark.parametrize("broadcast", [True, False])
def test_lines_against_brute_force(docs, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", -1)
    rng = random.Random(7)
    base = ["".join(rng.choice("abcdefgh éß") for _ in range(n)) for n in (1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 14, 15, 16, 17, 19, 20, 21, 31, 32, 33, 47, 48, 63, 64, 65, 100, 129, 700)]
    pool = [*base, "a" * 40, "a" * 41, "ab" * 20, *("Page %d of the handbook" % k for k in range(30)), "", "  ", "short", "Menu", "Read more", "Share this", "2.5 kg", "---", "\x0b"]
    rows = []
    for i in range(90):
        lines = []
        for _ in range(rng.randint(0, 12)):
            line = rng.choice(pool)
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                line = edited(rng, line) if line else line
            lines.append(rng.choice(["", " ", "\t"]) + line + rng.choice(["", "\r"]))
        rows.append((i, "\n".join(lines)))
    want = plain(rows)
    got = {r.doc_id: (r.n_lines, r.n_exact, r.n_near, r.kept_text) for r in line_dedup.dedup_lines(docs(rows)).collect()}
    assert got == want
    assert sum(w[2] for w in want.values()) > 40 and sum(w[1] for w in want.values()) > 20


def test_lines_of_odd_rows(docs):
    line = "a line of more than twenty characters"
    rows = [(0, "Read more\nMenu\n\nMenu"), (1, None), (2, "Read more\n \nMenus\nx\ny"), (3, line), (3, line), (None, line), (4, line + "\n" + line + "!"), (5, "z" * 60_000), (6, "z" * 59_999), (7, "")]
    got = sorted(((r.doc_id if r.doc_id is not None else -1, r.n_lines, r.n_exact, r.n_near, r.kept_text) for r in line_dedup.dedup_lines(docs(rows)).collect()), key=str)
    assert got == sorted([(0, 4, 1, 0, "Read more\nMenu\n"), (1, 0, 0, 0, None), (2, 5, 1, 1, " \nx\ny"), (3, 1, 1, 0, ""), (3, 1, 1, 0, ""), (-1, 1, 0, 0, line), (4, 2, 1, 1, ""), (5, 1, 0, 0, "z" * 60_000), (6, 1, 0, 1, ""), (7, 1, 0, 0, "")], key=str)
    assert line_dedup.dedup_lines(docs([])).count() == 0
    kept = line_dedup.dedup_lines(docs([(9, line)]), keep=["doc_id", "text_hash", "fp"]).first()
    assert kept.others.asDict() == {"doc_id": 9, "text_hash": "x", "fp": "z"}


def test_line_dedup_leaves_its_result_alone(docs):
    rows = [(i, "\n".join(f"line {k} of a text with some words {k * i}" for k in range(6))) for i in range(8)]
    once = [(r.doc_id, r.kept_text) for r in line_dedup.dedup_lines(docs(rows)).collect()]
    assert sorted((r.doc_id, r.kept_text) for r in line_dedup.dedup_lines(docs(once)).collect()) == sorted(once)


def test_licenses(docs):
    t, rng = license_scan.TEMPLATES, random.Random(8)
    filler = lambda n: " ".join(rng.choice(["red", "blue", "green", "the", "license", "of", "software"]) + str(rng.randint(0, 99)) for _ in range(n))
    words = t["mit-grant"].split()
    near = " ".join("changed" if k in (20,) else w for k, w in enumerate(words))
    far = " ".join("changed" if k % 7 == 0 else w for k, w in enumerate(words))
    rows = [(k, f"{filler(50)}\n{v.upper()}\n{filler(70)}") for k, v in enumerate(t.values())] + [
        (100, None), (101, ""), (102, "the MIT license"), (103, filler(500)), (104, f"{filler(33)} {near} {filler(9)}"), (105, far), (106, t["mit-notice"] * 3 + t["cc-by-nc-4.0-notice"]), (107, filler(9000) + " " + t["bsd-grant"]), (None, t["mit-notice"]), (108, t["mit-notice"]), (108, t["mit-notice"]),
    ]
    got = {}
    for r in license_scan.scan(docs(rows)).collect():
        got.setdefault(r.doc_id, {})[r.license] = (r.n_found, r.n_shingles)
    for k, name in enumerate(t):
        n = got[k][name]
        assert n[0] == n[1]
    assert all(k not in got for k in (100, 101, 102, 103, 105))
    assert got[104]["mit-grant"][0] == got[104]["mit-grant"][1] - 5
    assert set(got[106]) == {"mit-notice", "cc-by-nc-4.0-notice"} and set(got[107]) == {"bsd-grant"} and set(got[None]) == set(got[108]) == {"mit-notice"}
    assert license_scan.scan(docs([])).count() == 0


def test_license_recall_at_the_threshold(docs):
    """Every copy with evenly spread changes that keeps at least SHARE of the shingles is found."""
    t, rng, rows, want = license_scan.TEMPLATES, random.Random(10), [], set()
    for name in ("mit-grant", "apache-2.0-header", "gpl-header", "isc-grant", "mpl-2.0-header", "unlicense-grant"):
        for k in range(25):
            words = t[name].split()
            words[rng.randrange(len(words))] = f"changed{k}"
            text, i = f"{'x ' * rng.randint(0, 9)}{' '.join(words)} y", len(rows)
            full = lambda s: {tuple(s[j : j + 5]) for j in range(len(s) - 4)}
            plain = lambda s: "".join(c.lower() if c.isalnum() else " " for c in s).split()
            a, b = full(plain(t[name])), full(plain(text))
            if len(a & b) >= 0.8 * len(a):
                want.add((i, name))
            rows.append((i, text))
    got = {(r.doc_id, r.license) for r in license_scan.scan(docs(rows)).collect()}
    assert len(want) > 100 and want <= got


def test_license_families(docs):
    """Usual one-line notices of every family name it, whatever stands around them."""
    wanted = {
        "mit": "Foo is licensed under the MIT License, see LICENSE", "apache-2.0": "This tool is released under the Apache License, Version 2.0", "gpl-3.0": "covered by the GNU General Public License v3.0",
        "gpl-2.0": "under the GNU General Public License, version 2", "lgpl-3.0": "Released under the GNU LGPL v3.", "agpl-3.0": "GNU Affero General Public License v3.0", "bsd-3-clause": "Licensed under the BSD 3-Clause License",
        "bsd-2-clause": "released under the Simplified BSD License", "mpl-2.0": "the Mozilla Public License 2.0", "cc-by-4.0": "Licensed under CC BY 4.0", "cc-by-sa-4.0": "Text is licensed under CC BY-SA 4.0", "cc-by-nc-4.0": "released under CC BY-NC 4.0",
        "cc0-1.0": "released under CC0 1.0", "unlicense": "under the terms of the Unlicense", "openrail": "under the CreativeML Open RAIL-M License", "odc-by": "Open Data Commons Attribution License",
    }
    assert set(wanted) == set(validate.LICENSES)
    rows = [(i, f"some words\n{t}\nand more") for i, t in enumerate(wanted.values())] + [(50 + i, f"# SPDX-License-Identifier: {x}\nimport os") for i, x in enumerate(license_scan._SPDX)]
    got = {}
    for r in license_scan.scan(docs([*rows, (98, license_scan.TEMPLATES["gpl-header"]), (99, "the license of the public is general and under the version of it")])).collect():
        got.setdefault(r.doc_id, set()).add(r.license)
    for i, family in enumerate(wanted):
        assert got[i] and all(x.startswith(family) for x in got[i]), (family, got.get(i))
    assert all(f"spdx-{x.lower()}" in got[50 + i] for i, x in enumerate(license_scan._SPDX)) and got[98] == {"gpl-header"} and 99 not in got


def license_words(text):
    return "".join(c.lower() if c.isalnum() else " " for c in text).split()


def license_shingles(text):
    w = license_words(text)
    return {tuple(w[j : j + 5]) for j in range(len(w) - 4)}


def test_license_recall_with_many_edits(docs):
    """Copies of short and long templates with words changed, put in, taken out and cut off, down to the threshold: at
    least 99 of 100 are found, and nothing below it."""
    t, rng, rows, want = license_scan.TEMPLATES, random.Random(11), [], set()
    names = [n for n in t if n.endswith(("-text", "-header", "-grant", "-clause", "-notice")) or "-name-0" in n]
    for name in names:
        n = len(license_shingles(t[name]))
        for k in range(40):
            w = license_words(t[name])
            for _ in range(rng.randint(0, n // 20)):
                i = rng.randrange(len(w))
                w[i : i + rng.choice([0, 1, 1])] = rng.choice([["changed"], ["two", "words"], []])
            cut = rng.choice([0, 0, rng.randint(0, max(1, n // 6))])
            w = w[: len(w) - cut] if rng.random() < 0.5 else w[cut:]
            text, i = f"{'x ' * rng.randint(0, 9)}{' '.join(w)} y{k}", len(rows)
            a = license_shingles(t[name])
            if len(a & license_shingles(text)) >= 0.8 * len(a):
                want.add((i, name))
            rows.append((i, text))
    got = {(r.doc_id, r.license): r for r in license_scan.scan(docs(rows)).collect()}
    near = [x for x in want if got.get(x) and got[x].n_found < 0.87 * got[x].n_shingles]
    assert len(want) > 600 and len(near) > 60 and len(want - set(got)) <= len(want) // 100
    for (i, name), r in got.items():
        a = license_shingles(t[name])
        assert r.n_found == len(a & license_shingles(rows[i][1])) >= 0.8 * len(a) and r.n_shingles == len(a)


def test_license_with_text_put_in(docs):
    w = license_scan.TEMPLATES["gpl-header"].split()
    apart = " ".join([*w[:21], *(f"between{k}" for k in range(300)), *w[21:]])
    (found,) = [r for r in license_scan.scan(docs([(1, apart)])).collect() if r.license == "gpl-header"]
    assert (found.n_found, found.n_shingles) == (34, 38)


def test_templates_of_more_than_one_pass(docs, monkeypatch):
    """Over 1 MiB of templates, in passes: the same result as in one."""
    rng = random.Random(12)
    made = {f"made-{k}": " ".join(f"{rng.choice('abcdefgh')}{rng.randint(0, 400)}" for _ in range(rng.choice([3, 5, 7, 11, 40, 9000]))) for k in range(160)}
    assert sum(map(len, made.values())) > 1 << 20
    rows = [(k, f"some words before {t} and after") for k, t in enumerate(made.values()) if len(t) < 400] + [(500, list(made.values())[-1])]
    few = {k: t for k, t in made.items() if len(t) < 400}
    want = sorted(map(str, license_scan.scan(docs(rows), few).collect()))
    assert len(want) >= sum(len(t.split()) >= 5 for t in few.values())
    monkeypatch.setattr(license_scan, "LITERALS", 500)
    assert sorted(map(str, license_scan.scan(docs(rows), few).collect())) == want
    monkeypatch.undo()
    long = [k for k, t in made.items() if len(t) > 400]
    text = " ".join(made[long[-1]].split()[1000:8600])
    got = {(r.doc_id, r.license) for r in license_scan.scan(docs([(1, text), (2, "nothing of it")]), {k: made[k] for k in long}).collect()}
    assert got == {(1, long[-1])} and license_scan.scan(docs(rows), {"short": "two words"}).count() == 0
