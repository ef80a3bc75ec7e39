"""Language identification and toxicity: held-out accuracy, and defined results for odd rows."""

import numpy as np
import pytest

from chatloom.llm import common, langid, toxicity

DATA = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    lang = {r.doc_id: r.lang for r in common.table(spark, DATA, "documents").select("doc_id", "lang").collect()}
    got = langid.query(spark, DATA).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 1000 and 250 < len(held) < 420 and all(0 <= r.score <= 1 for r in got)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) >= 0.98


def test_language_of_odd_texts(docs):
    english, french = ["the cat sat on the mat with those other things", "where there is thought there then is the thing"] * 4, ["le chat est sur la table avec des choses", "nous avons été dans la maison du père"] * 4
    model = langid.fit([f"{t} {k}" for k, t in enumerate(english + french)], ["en"] * 8 + ["fr"] * 8, 8)
    rows = [(1, None), (2, ""), (3, "123 $$$"), (4, "the other thing is there"), (5, "THE OTHER THING IS THERE"), (6, "la maison est avec nous " * 4000), (None, "the mat"), (4, "the other thing is there"), (7, "\U0001f600"), (8, "a")]
    got = [(r.doc_id, r.lang_pred, r.score) for r in langid.identify(docs(rows), model, ["doc_id", "score", "fp"], names=("lang_pred", "p")).withColumnRenamed("score", "old").withColumnRenamed("p", "score").collect()]
    by = {i: (p, s) for i, p, s in got}
    assert len(got) == len(rows) and all(by[k] == ("und", 0.0) for k in (1, 2, 3, 7))
    assert by[4][0] == by[5][0] == "en" and by[4] == by[5] and by[6][0] == "fr"
    assert langid.fit([], []).predict(["text"])[0] == ["und"]


def test_presence_kernel_is_what_it_says():
    bits = np.zeros((3, 1 << langid.BITS), bool)
    assert langid.presence("abab", bits)
    # " abab ": letters a, b and the space; pairs ' a', 'ab', 'ba', 'b '; triples ' ab', 'aba', 'bab', 'ab '
    assert bits.sum(axis=1).tolist() == [3, 4, 4]
    model = langid.fit(["abab", "cdcd"], ["x", "y"], 2)
    kernel, some = model.features(["abab", "--", "abcd"])
    assert some.tolist() == [True, False, True] and kernel[0].max() == pytest.approx(1, abs=1e-5) and 0 < kernel[2].min()


def test_sample_is_bounded_and_independent_of_copies(docs):
    from pyspark.sql import functions as F

    df = docs([(i, f"text {i % 40}") for i in range(400)]).select("lang", F.col("text"))
    texts, labels = langid.training_sample(df, per_language=10)
    assert len(texts) == len(set(texts)) <= 10 and set(labels) == {"en"}
    assert langid.training_sample(docs([]).select("lang", "text")) == ([], [])


def test_toxicity_held_out(spark):
    labels = {r.doc_id: r.toxic for r in common.table(spark, "/root/testdata/sf0.1", "labels").collect()}
    got = toxicity.query(spark, "/root/testdata/sf0.1").collect()
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    hit = sum(p & y for p, y in held)
    assert len(got) == 10_000 and hit / sum(p for p, _ in held) >= 0.9 and hit / sum(y for _, y in held) >= 0.9


@pytest.fixture(scope="module")
def model():
    toxic = [f"you are an idiot and a moron number {k}" for k in range(20)] + [f"what trash and scum {k}" for k in range(20)]
    clean = [f"a fine day with good words and a clean page {k}" for k in range(60)]
    return toxicity.fit(toxic, clean)


@pytest.mark.parametrize("text", ["idiot", "an IDIOT!", "you 1d10t", "1di0t", "іdіоt", "ｉｄｉｏｔ", "ídïót", "tr@sh", "$cum", "m0r0n.", "i.d.i.o.t", "s-c-u-m", "idiot " * 3000, "a good day, you moron"])
def test_toxic_forms(model, text):
    assert model.score(text) >= toxicity.THRESHOLD


@pytest.mark.parametrize("text", ["", None, "idiotic?"[:0], "a good day", "the trash can is full", "a clown fish in the trash bin", "the trash, can", "mistrashed", "2024 100% $5 1d4", "price $100 and 3 items", "x" * 100_000])
def test_clean_forms(model, text):
    assert model.score(text) < toxicity.THRESHOLD


def test_toxicity_rows(docs, model):
    rows = [(1, None), (2, ""), (3, "idiot"), (3, "idiot"), (None, "scum"), (4, "fine " * 50_000)]
    got = toxicity.scored(docs(rows), model, ["doc_id"]).collect()
    assert len(got) == 6 and {r.score for r in got if r.doc_id in (1, 2)} == {model.score("")}
    assert toxicity.scored(docs([]), model, ["doc_id"]).count() == 0
    assert toxicity.fit([], []).score("you idiot") >= toxicity.THRESHOLD


def test_lexicon_finds_families_and_whole_words():
    toxic = [f"brak{s} and zonk here" for s in "abcdefghijklmnopqrstuvwxyz"]
    clean = [f"plain words and more here {k}" for k in range(100)]
    lexicon = toxicity.fit_lexicon(toxic, clean)
    assert " brak" in lexicon and " zonk " in lexicon and " and " not in lexicon and " here " not in lexicon


def plain_matches(model, text):
    """Every place and entry tried one by one: the heaviest entry at each start that no exception covers."""
    s = toxicity.folded(text)
    hidden = {at for e in model.exceptions for k in range(len(s)) if s.startswith(f" {e} ", k) for at in range(k, k + len(e) + 1)}
    best = {}
    for entry, weight in model.lexicon.items():
        for at in range(len(s)):
            if s.startswith(entry, at) and at not in hidden:
                best[at] = max(weight, best.get(at, 0.0))
    return sorted(best.items())


def test_matches_against_brute_force(model):
    import random

    rng = random.Random(6)
    words = ["trash", "can", "cans", "bin", "Idiot", "1d10t", "clown", "fish", "circus", "sc\u00fcm", "mor0n", "i.d.i.o.t", "the", "folder", "take", "out", "a,", "x!", "loser", "bracket", "collection"]
    for _ in range(300):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", ", ", "-", "\n"]) for _ in range(rng.randint(0, 40)))
        assert model.matched(text)[0] == plain_matches(model, text), text


def test_many_matches_and_exceptions_take_linear_time(model):
    import time

    def took(n):
        began = time.perf_counter()
        assert model.score("trash can " * n) < toxicity.THRESHOLD < model.score("trash can idiot " * n)
        return time.perf_counter() - began

    took(100)
    assert took(80_000) < 20 * took(8_000) + 0.5


def test_calibration_is_the_ridge_penalised_likelihood(model):
    """The fitted slopes are a stationary point of the penalised likelihood that the docstring names."""
    toxic = [f"you are an idiot and a moron number {k}" for k in range(20)] + [f"a fine day {k}" for k in range(5)]
    clean = [f"a fine day with good words {k}" for k in range(60)] + ["what a clown"] * 3
    w = np.array(toxicity.calibrate(model, toxic, clean, 0.25))
    x = np.array([(1.0, *model.features(t)) for t in [*toxic, *clean]])
    y = np.repeat([1.0, 0.0], [len(toxic), len(clean)])
    share = np.repeat([0.25 / len(toxic), 0.75 / len(clean)], [len(toxic), len(clean)]) * len(y)
    slope = x.T @ (share * (y - 1 / (1 + np.exp(-x @ w)))) - 0.05 * w
    assert np.abs(slope[w != 0]).max() < 1e-5 and (w[1:] >= 0).all()


def plain_language(texts, labels, given, ridge=langid.RIDGE):
    """The same classifier without hashing, matrices of bits or batches: kernels of sets, and plain solves."""

    def grams(text, k):
        s = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
        return {s[i : i + k] for i in range(len(s) - k + 1)}

    def kernel(a, b):
        return sum(len(grams(a, k) & grams(b, k)) / np.sqrt(len(grams(a, k)) * len(grams(b, k))) for k in langid.ORDERS) / len(langid.ORDERS)

    languages = sorted(set(labels))
    among = np.array([[kernel(a, b) for b in texts] for a in texts])
    value, vector = np.linalg.eigh(among)
    root = vector[:, value > 1e-6] / np.sqrt(value[value > 1e-6])
    phi = among @ root
    weight = np.array([1 / labels.count(x) for x in labels])[:, None]
    target = np.array([[1.0 if x == y else -1.0 for y in languages] for x in labels])
    solved = np.linalg.solve((phi * weight).T @ phi + ridge * np.eye(phi.shape[1]), (phi * weight).T @ target)
    margin = np.array([[kernel(t, b) for b in texts] for t in given]) @ root @ solved
    return [languages[k] for k in margin.argmax(axis=1)], np.clip((margin.max(axis=1) + 1) / 2, 0, 1)


def test_language_against_a_plain_version():
    texts = ["the cat sat on the mat", "those are other things there", "le chat est sur la table", "nous avons \u00e9t\u00e9 dans la maison", "die katze sitzt auf dem tisch", "wir waren gestern in der schule"]
    labels = ["en", "en", "fr", "fr", "de", "de"]
    given = [*texts, "the table", "la chatte est l\u00e0", "wir sitzen, 12 there", "zzz", "DIE MAISON"]
    names, scores = plain_language(texts, labels, given)
    got, got_scores = langid.fit(texts, labels, 12).predict(given)
    assert got == names and np.abs(got_scores - scores).max() < 1e-4


def test_equal_margins_take_the_first_language():
    model = langid.fit(["abab abab", "abab abab"], ["y", "x"], 8)
    assert model.predict(["abab"])[0] == ["x"]
