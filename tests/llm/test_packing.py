import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from chatloom.llm import packing

PATH = packing.default_tokenizer_path()


@pytest.mark.parametrize("seed", range(30))
def test_plan_places_every_piece_once(seed):
    rng = random.Random(seed)
    cap, counts = rng.choice([10, 64, 4096]), {}
    for _ in range(rng.randint(0, 3000)):
        k = min(cap, max(1, int(rng.choice([rng.randint(1, cap), rng.expovariate(4 / cap)]))))
        counts[k] = counts.get(k, 0) + 1
    runs, total = packing.plan_packing(counts, cap)
    bins, ranks = {}, {}
    for length, rank, n, first, offset in runs:
        for j in range(n):
            bins.setdefault(first + j, []).append((offset, length))
            ranks.setdefault(length, []).append(rank + j)
    assert {k: len(v) for k, v in ranks.items()} == counts and all(sorted(v) == list(range(len(v))) for v in ranks.values())
    assert len(bins) == total
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= cap and sum(3 * k > cap for _, k in own) <= 2
    if counts:
        need = -(-sum(k * n for k, n in counts.items()) // cap)
        halves = sum(n for k, n in counts.items() if 2 * k > cap)
        assert total <= 1.22 * max(need, halves) + 1


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeéß.,'!") for _ in range(rng.randint(1, 9))) for _ in range(n))


def test_ids_are_those_of_the_tokenizer():
    rng = random.Random(1)
    odd = ["á ́b", "ΟΔΟΣ ΣΑΣ x", "<|endoftext|> x<|endoftext|>y", "İ İ", "İ.", "İ, ok", "Hİ-x", "TBMM İ. H.", "ড়&", "x(שׁ)", "e ́", "don't 've", "it 's", "a\x1cb", "  ", "​ x", "漢字 テスト。", "x" * 5000, "\x85q r", "J̌x", "a\tb\x0bc\r\nd", "x.'s y", "", None]
    texts = odd + [words(rng, rng.randint(1, 200)) for _ in range(50)]
    import pyarrow as pa

    plain = Tokenizer.from_file(PATH)
    got = packing.ChunkEncoder(PATH).batch(pa.array(texts, pa.string()))
    for text, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text or "", add_special_tokens=False).ids, text


def test_full_cache_starts_anew(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(packing, "CACHE", 5)
    rng = random.Random(2)
    texts = [words(rng, 30) for _ in range(6)]
    encoder, plain = packing.ChunkEncoder(PATH), Tokenizer.from_file(PATH)
    for t in texts:
        assert np.frombuffer(encoder.batch(pa.array([t]))[0], "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids


def test_pack(docs):
    rng = random.Random(3)
    rows = [(i, words(rng, rng.choice([1, 20, 300, 3000]))) for i in range(60)] + [(3, "same"), (3, "same"), (None, None), (70, "")]
    df = docs(rows)
    placed = packing.pack_documents(df, capacity=512)
    plain = Tokenizer.from_file(PATH)
    want = sorted(str(plain.encode(t or "", add_special_tokens=False).ids + [1]) for _, t in rows)
    ids = packing.pieces(df, PATH, 512, with_ids=True)
    by = {}
    for r in ids.collect():
        by.setdefault((r.doc_id, r.ids_crc32), r)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids) <= 512
    got = placed.collect()
    assert len(got) == ids.count()
    bins, whole = {}, {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        if (r.doc_id, r.piece) != (3, 0):
            whole.setdefault(r.doc_id, []).append((r.start, by[r.doc_id, r.ids_crc32].ids))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 512
    texts = [str([x for _, part in sorted(v, key=lambda p: p[0]) for x in part]) for v in whole.values()]
    assert all(t in want for t in texts) and len(bins) <= 1.15 * sum(r.length for r in got) / 512 + 1


def test_ids_of_random_texts():
    """Marks, cased letters, signs and any other character, mixed at random."""
    import unicodedata

    import pyarrow as pa

    rng = random.Random(5)
    every = [c for c in map(chr, range(0x20, 0x30000)) if unicodedata.category(c) not in ("Cn", "Cs")]
    marks, cased = [c for c in every if unicodedata.category(c)[0] == "M"], [c for c in every if c.lower() != c or c.upper() != c]
    kept = [c for c in every if unicodedata.normalize("NFC", c) != c] + list("İßſK'’")
    signs = list("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~ \t\n'")
    texts = ["".join(rng.choice(rng.choice((signs, *rng.sample((every, marks, cased, kept), 2)))) for _ in range(rng.randint(1, 14))) for _ in range(8000)]
    encoder, plain = packing.ChunkEncoder(PATH), Tokenizer.from_file(PATH)
    for at in range(0, len(texts), 500):
        for text, ids in zip(texts[at : at + 500], encoder.batch(pa.array(texts[at : at + 500]))):
            assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_other_tokenizers_get_whole_texts(docs, tmp_path):
    from tokenizers import models, pre_tokenizers

    other = Tokenizer(models.WordLevel({"[UNK]": 0, "Hello": 1, "hello": 2, "end": 3}, unk_token="[UNK]"))
    other.pre_tokenizer = pre_tokenizers.Whitespace()
    other.save(str(tmp_path / "words.json"))
    (row,) = packing.pack_documents(docs([(1, "Hello hello x")]), str(tmp_path / "words.json"), end_id=3, with_ids=True).collect()
    assert list(row.ids) == [1, 2, 0, 3]


def test_sequences_and_empty(docs):
    rows = [(1, "one two"), (2, "three"), (3, "four five six"), (None, "seven"), (None, "eight nine"), (5, "same"), (5, "same"), (5, "other words " * 40)]
    out = packing.sequences(packing.pack_documents(docs(rows), capacity=32, with_ids=True)).collect()
    plain = Tokenizer.from_file(PATH)
    assert all(sum(r.lengths) == len(r.ids) <= 32 for r in out)
    got = sorted(str(list(r.ids[sum(r.lengths[:k]) : sum(r.lengths[: k + 1])])) for r in out for k in range(len(r.lengths)))
    whole = [plain.encode(t, add_special_tokens=False).ids + [1] for _, t in rows]
    assert got == sorted(str(w[at : at + 32]) for w in whole for at in range(0, len(w), 32))
    assert packing.pack_documents(docs([])).count() == 0
