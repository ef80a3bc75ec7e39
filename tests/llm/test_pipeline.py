"""The stages of the pipeline, each against what a plain version keeps of its own input."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from chatloom.llm import common

DATA = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    from test_decontaminate import plain as hits
    from test_lines_and_licenses import plain as lines
    from test_simhash import plain_components, plain_print

    docs = common.table(spark, DATA, "documents")
    items = [(r.item_id, r.text) for r in common.table(spark, DATA, "benchmark").collect()]
    assert [n for n, _ in P.STAGES] == ["language", "lines", "copies", "benchmark", "packing"]
    for name, stage in P.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, DATA)
        if name != "packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = {r.doc_id: r.text for r in docs.collect()} if name != "packing" else {}
        if name == "language":
            assert after == {i: t for i, t in before.items() if re.search(r"[^\W\d_]", t)}
        elif name == "lines":
            want = {i: r[3] for i, r in lines(list(before.items())).items() if r[1] + r[2] == 0 or r[3].strip(" ")}
            assert after == want and docs.where(F.col("n_chars") != F.length("text")).count() == 0
        elif name == "copies":
            assert set(after) == set(plain_components({i: plain_print(t) for i, t in before.items()}).values())
        elif name == "benchmark":
            assert set(after) == {i for i, t in before.items() if not hits(t, items)[3]}
        else:
            assert {r.doc_id for r in docs.collect()} == set(before) and docs.where("offset + length > 4096").count() == 0


def test_odd_documents(spark, docs):
    rows = [(1, None), (2, ""), (3, "12 34"), (None, "a text without an id but with letters"), (5, "the same text of some words"), (5, "the same text of some words"), (6, "the same text of some words")]
    for made in (docs(rows), docs([])):
        kept = made
        for _, stage in P.STAGES[:-1]:
            kept = stage(spark, kept, DATA)
            assert kept.columns == made.columns
        assert kept.count() == (2 if made.count() else 0) or made.count() == 0
        assert P.STAGES[-1][1](spark, kept, DATA).count() == kept.count()


def unlearned():
    rng = random.Random(3)
    scripts = ["Все люди рождаются свободными и равными в своем достоинстве и правах", "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心", "يولد جميع الناس أحرارا متساوين في الكرامة والحقوق", "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι"]
    noise = ["".join(rng.choice(letters) for _ in range(n)) for letters in ("abcdefghijklmnopqrstuvwxyz ", "bcdfghjklmnpqrstvwxz ") for n in (100, 400, 3000)]
    return scripts + [t * 20 for t in scripts] + noise


@pytest.mark.parametrize("kept", [("en",), ("en", "de"), ("en", "de", "fr", "es")])
def test_unfamiliar_texts_go(spark, kept):
    """Unlearned scripts and gibberish go, whatever the number of languages; clean texts and short cuts of them stay."""
    docs = common.table(spark, DATA, "documents").where(F.col("lang").isin(*kept)).select("doc_id", "text", "lang")
    some = [r.text for r in docs.where(F.length("text") > 300).orderBy("doc_id").limit(40).collect()]
    short = [t[t.index(" ", 100) :][:n] for t in some for n in (12, 40)]
    made = spark.createDataFrame([(10**9 + i, t, None) for i, t in enumerate(short + unlearned())], "doc_id long, text string, lang string")
    out = {r.doc_id for r in P.language(spark, docs.unionByName(made), DATA).collect()}
    assert out - {r.doc_id for r in docs.collect()} == {10**9 + i for i in range(len(short))}
    assert docs.where(F.rlike("text", F.lit("\\p{L}"))).count() == len({i for i in out if i < 10**9})


def test_any_column_names(spark, docs):
    """Columns named like those that the operators make for themselves, or with dots and blanks, come through."""
    names = ["__text", "__score", "__id", "__of", "id", "of", "id_", "pred", "score", "familiar", "others", "kept_text", "text_hash", "line_no", "root", "rank", "doc", "term", "pos", "a.b", "a b", "TEXT_"]
    rows = [(i, f"a text of some words with number {i} in it\nand a line that is shared by all of them", "en", *[f"{n}{i}" for n in names]) for i in range(12)]
    made = spark.createDataFrame([*rows, rows[0]], "doc_id long, text string, lang string, " + ", ".join(f"`{n}` string" for n in names))
    kept = made
    for _, stage in P.STAGES[:-1]:
        kept = stage(spark, kept, DATA)
        assert kept.dtypes == made.dtypes
    got = kept.collect()
    assert 0 < len(got) <= 12 and all(r[3:] == rows[r.doc_id][3:] for r in got)


def test_each_stage_runs_once(spark, monkeypatch):
    """run() reads every document once for each stage."""
    from chatloom.llm import langid

    seen = spark.sparkContext.accumulator(0)
    judge = langid.Model.judge

    def counted(self, texts):
        seen.add(len(texts))
        return judge(self, texts)

    monkeypatch.setattr(langid.Model, "judge", counted)
    out = P.run(spark, DATA)
    n = common.table(spark, DATA, "documents").count()
    assert out.count() > 0 and seen.value in (0, n)  # 0 if workers had loaded the module before
