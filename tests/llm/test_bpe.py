import hashlib
import json
import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from chatloom.llm import bpe

PATH = bpe.default_tokenizer_path()
ODD = [
    "", None, "a  b", "a   b ", " a", "x\n \n y", "<|endoftext|>x <|endoftext|>", "a<|endoftext|>  b", "it's 've I'LL", "\x00a b", "  ", "　　x", "a b",
    "aaaa" * 50, " \n\n a", "\x85q r\x1c\x1d s", "漢字 テスト。", "👍🏽 é é", "՘a ՘", "ि ी", "1２³Ⅷ½", "�﻿", "x" * 5000, "a\tb\x0bc\r\nd", "\n", " ",
]


@pytest.fixture(scope="module")
def both():
    return bpe.ByteBpe(PATH), Tokenizer.from_file(PATH)


def same(both, texts):
    own, library = both
    table = bpe.OffsetTable(PATH)
    packed = own.encode(pa.array(texts, pa.string()))
    for text, ids in zip(texts, packed):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids, text
    assert table.decode(pa.array(packed, pa.binary())) == [t or "" for t in texts]


def test_odd_texts(both):
    same(both, ODD)


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "aeinst", "ab", "e .", "Āéß漢👍 ", "0123456789.,-/ ", "=-#* \n", " \n\t x"])
def test_random_texts(both, letters):
    rng = random.Random(letters)
    same(both, ["".join(rng.choice(letters) for _ in range(rng.randint(1, 80))) for _ in range(1500)])


def test_every_short_run(both):
    same(both, [c * n for c in "ae =-.\n0é" for n in range(1, 140)])


def test_every_character(both):
    chars = [c for c in map(chr, range(0x3000)) if not "\ud800" <= c <= "\udfff"]
    same(both, [f"a{c}a1{c}1.{c}. {c}{c} " for c in chars])


def test_very_long_texts(both):
    rng = random.Random(4)
    same(both, ["x" * 300_000, "".join(rng.choice("abcxyz-/") for _ in range(200_000)), "word " * 50_000])


def test_full_caches_start_anew(both, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 20)
    rng = random.Random(5)
    same((bpe.ByteBpe(PATH), both[1]), [" ".join("".join(rng.choice("abcde") for _ in range(4)) for _ in range(50)) for _ in range(40)])


def test_decoding_any_ids(both):
    rng = random.Random(6)
    ids = [[rng.randrange(50_300) for _ in range(rng.randint(0, 20))] for _ in range(500)]
    packed = pa.array([np.array(i, "<u4").tobytes() for i in ids])
    assert bpe.OffsetTable(PATH).decode(packed) == [both[1].decode(i, skip_special_tokens=False) for i in ids]


def test_small_vocabulary_against_plain_merges(tmp_path):
    """Backtracking is needed: the longest tokens are not the ones that merging in order gives."""
    letters = bpe.byte_letters()
    merges = [("a", "b"), ("b", "c"), ("c", "d"), ("ab", "cd"), ("bc", "d"), ("d", "a"), ("b", "bc"), ("a", "a"), ("aa", "a"), ("aa", "ab"), ("c", "aa"), ("bc", "aa")]
    vocab = {c: i for i, c in enumerate(letters)}
    for a, b in merges:
        vocab[a + b] = len(vocab)
    config = json.load(open(PATH))
    config["model"] |= {"vocab": vocab, "merges": [list(m) for m in merges]}
    config["added_tokens"] = []
    path = str(tmp_path / "small.json")
    json.dump(config, open(path, "w"))
    own, library, rng = bpe.ByteBpe(path), Tokenizer.from_file(path), random.Random(7)
    rank = {m: r for r, m in enumerate(merges)}
    for _ in range(3000):
        text = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 24)))
        parts = list(text)
        while pairs := [(rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in rank]:
            i = min(pairs)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        got = np.frombuffer(own.encode(pa.array([text]))[0], "<u4").tolist()
        assert got == [vocab[p] for p in parts] == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("change", [{"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"model": {"ignore_merges": True}}, {"model": {"merges": [["Ġ", "t"], ["Ġ", "t"]]}}])
def test_other_tokenizers_are_refused(tmp_path, change):
    config = json.load(open(PATH))
    for k, v in change.items():
        config[k] = config[k] | v if k == "model" else v
    json.dump(config, open(tmp_path / "t.json", "w"))
    with pytest.raises(ValueError):
        bpe.ByteBpe(str(tmp_path / "t.json"))


def test_round_trip(docs, both):
    rng = random.Random(8)
    rows = [(i, " ".join("".join(rng.choice("abcdeé.,'") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 300)))) for i in range(80)]
    rows += [(3, "same"), (3, "same"), (None, None), (None, "x"), (200, "")] + [(300 + i, t) for i, t in enumerate(ODD)]
    df = docs(rows)
    coded = bpe.encoded(df, keep=df.columns, name="packed")
    assert coded.columns == [*df.columns, "packed"]
    back = bpe.decoded(coded, keep=["doc_id", "packed"], ids_col="packed", name="said").collect()
    key = lambda r: (str(r[0]), r[1], r[2])
    want = [(i, np.array(both[1].encode(t or "", add_special_tokens=False).ids, "<u4").tobytes(), t or "") for i, t in rows]
    assert sorted(map(tuple, back), key=key) == sorted(want, key=key)
    assert bpe.decoded(bpe.encoded(docs([(1, "x")]).where("false"))).collect() == []


def test_query(spark):
    data = "/root/testdata/sf0.001"
    library = Tokenizer.from_file(PATH)
    want = set()
    for r in spark.read.parquet(f"{data}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want.add((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert set(map(tuple, bpe.query(spark, data).collect())) == want
