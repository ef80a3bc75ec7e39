"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton on folded text.

Folding lower-cases, strips accents, maps homoglyphs to Latin letters and everything else to a
space. Words that mix letters with digits or signs, and letters spelled out with dots or dashes,
are matched a second time with the substitutions undone. Lexicon entries match whole words or,
where a family of words shares a beginning, word prefixes. Entries inside an exception phrase do
not count. A document's weight, its weight per word and its heaviest
match go through a logistic calibration.

Lexicon, weights and calibration are fitted on the driver from a bounded sample of labelled rows:
at most PER_LABEL distinct texts of each label, of at most MAX_FIT_CHARS characters, chosen by the
hash of the text. Scoring covers every row and whole texts.

Defined cases: a null or empty text has no match and gets the score of a text without matches; a
very long one is read whole, in time linear in its length and matches; of matches at one place the
heaviest counts, and entries of equal weight are one; ids are integers, others fail the cast;
rows without a label, or with a null doc_id, are not learned from; repeated label rows count once
a text and label; with no labels of either kind the built-in seed words and a fixed calibration
are used; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass, field
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, mapped, table
from .langid import held_out

PER_LABEL = 1500
MAX_FIT_CHARS = 20_000
THRESHOLD = 0.3
#: Prefix entries have so many letters.
PREFIX = (4, 10)

#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = dict(zip("аеорсухіјѕԁһԛԝвкмнтгꭓαενορτυχικγ", "aeopcyxijsdhqwbkmhtrxaevoptuxiky"))
#: Digits and signs that stand for letters inside a word; 1 and | stand for either of two.
SUBSTITUTES = {"0": "o", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "+": "t", "€": "e"}
SEEDS = ("idiot", "moron", "stupid", "scum", "trash", "loser", "worthless", "pathetic", "disgusting", "clown")
EXCEPTIONS = (
    "trash can", "trash cans", "trash bin", "trash bag", "trash bags", "take out the trash", "trash collection", "trash folder",
    "clown fish", "circus clown", "pond scum", "soap scum", "loser bracket", "losers bracket", "sore loser rule", "disgusting taste",
)


class _Fold(dict):
    """For str.translate: learns each character when it is first met."""

    def __missing__(self, code: int) -> str:
        c = chr(code).lower()
        c = "".join(HOMOGLYPHS.get(x, x) for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        self[code] = out = "ss" if c == "ß" else "".join(x if x.isalpha() else " " for x in c) or ("" if unicodedata.combining(chr(code)) or unicodedata.category(chr(code)) == "Cf" else " ")
        return out


class _FoldSigns(_Fold):
    """As _Fold, but digits and substitute signs stay."""

    def __missing__(self, code: int) -> str:
        if chr(code) in "0123456789|" or chr(code) in SUBSTITUTES:
            self[code] = chr(code)
            return chr(code)
        return super().__missing__(code)


_fold, _fold_signs = _Fold(), _FoldSigns()
#: Words that mix letters with substitutes, each tried once from its start: linear in any text.
_MIXED = re.compile(r"(?<![^\W_])(?<![@$!|+€])(?:(?:[^\W\d_]++[0-9@$!|+€]++|[0-9@$!|+€]++)[^\W\d_](?:[^\W_]|[@$!|+€])*+|[^\W\d_]{2,}+[0-9@$]{1,2}(?![^\W_]|[@$]))")
_SPELLED = re.compile(r"(?<!\w)(?:[^\W\d_][.\-_*]){2,}[^\W\d_](?!\w)")
_undo = [str.maketrans(SUBSTITUTES | {"1": one, "|": one}) for one in "il"]


def folded(text: str | None) -> str:
    """The text as words between single spaces, then the words with substitutions undone."""
    if not text:
        return "  "
    plain = " ".join(text.translate(_fold).split())
    more = []
    for m in _MIXED.finditer(text):
        word = m[0].translate(_fold_signs).rstrip("!|+ ")
        more += dict.fromkeys(word.translate(t) for t in _undo)
    more += [re.sub(r"[^\w]|_", "", m[0]).translate(_fold) for m in _SPELLED.finditer(text)]
    return f" {plain} {' '.join(more)} "


@dataclass
class Model:
    #: " word " or " prefix" -> weight
    lexicon: dict
    #: bias, and the slopes of the features
    calibration: tuple = (-4.0, 1.0, 1.0, 1.0)
    exceptions: tuple = EXCEPTIONS
    _automaton: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None}

    def automaton(self):
        if self._automaton is None:
            a = ahocorasick.Automaton()
            for k, w in self.lexicon.items():
                a.add_word(k, (len(k), w))
            for k in self.exceptions:
                if f" {k} " not in self.lexicon:
                    a.add_word(f" {k} ", (len(k) + 2, None))
            if len(a):
                a.make_automaton()
            self._automaton = a
        return self._automaton

    def matched(self, text: str | None) -> tuple[list[tuple[int, float]], int]:
        """(start, weight) of every match outside exceptions, the heaviest a start, and the number of words."""
        s = folded(text)
        best: dict[int, float] = {}
        spans = []
        if len(self.automaton()):
            for end, (n, w) in self.automaton().iter(s):
                if w is None:
                    spans.append((end - n + 1, end))
                else:
                    best[end - n + 1] = max(w, best.get(end - n + 1, 0.0))
        if spans:
            spans.sort()
            starts, reach = [lo for lo, _ in spans], list(accumulate((hi for _, hi in spans), max))
            inside = lambda at: (k := bisect_right(starts, at)) > 0 and reach[k - 1] > at
            best = {at: w for at, w in best.items() if not inside(at)}
        return sorted(best.items()), s.count(" ")

    def features(self, text: str | None) -> tuple[float, float, float]:
        """The weight of all matches, the weight per word, and the heaviest match."""
        found, n = self.matched(text)
        weight = sum(w for _, w in found)
        return math.log1p(weight), math.log1p(100 * weight / (n + 20)), max((w for _, w in found), default=0.0)

    def score(self, text: str | None) -> float:
        bias, *slopes = self.calibration
        z = bias + sum(s * x for s, x in zip(slopes, self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _entries(text: str) -> set[str]:
    words = set(folded(text).split())
    return {f" {w} " for w in words} | {f" {w[:k]}" for w in words for k in range(PREFIX[0], min(PREFIX[1], len(w) - 1) + 1)}


def fit_lexicon(toxic: list[str], clean: list[str], z: float = 3.0, least_odds: float = 2.0) -> dict[str, float]:
    """Entries that tell toxic texts, with their log odds as weights.

    An entry counts if its toxic texts exceed what its clean texts lead one to expect by z standard
    deviations, and its log odds are at least least_odds. Of a family, the entry is the longest
    beginning (or the whole word) that keeps nine tenths of the family's toxic texts; entries that
    a kept beginning covers about as precisely are dropped.
    """
    seen = Counter(e for t in toxic for e in _entries(t))
    candidates = {e for e, n in seen.items() if n > z * z}
    other: Counter = Counter()
    for t in clean:
        other.update(candidates & _entries(t))
    ratio = len(toxic) / len(clean)
    odds = {e: math.log(seen[e] / (len(toxic) + 1)) - math.log((other[e] + 0.5) / (len(clean) + 1)) for e in candidates}
    strong = {e for e in candidates if odds[e] >= least_odds and seen[e] - (other[e] + 1) * ratio >= z * math.sqrt(seen[e])}
    longer: dict[str, list[str]] = {}
    for e in strong:
        word = e.strip()
        for k in range(PREFIX[0], len(word) + (e[-1] == " ")):
            longer.setdefault(f" {word[:k]}", []).append(e)
    kept: dict[str, float] = {}
    for e in sorted(strong, key=lambda e: (len(e), e)):
        word = e.strip()
        if any(kept.get(f" {word[:k]}", -9) >= odds[e] - 0.7 for k in range(PREFIX[0], len(word) + 1)):
            continue
        best = max([e, *(x for x in longer.get(e, ()) if seen[x] >= 0.9 * seen[e])], key=lambda x: (len(x), x))
        kept[best] = odds[best]
    return kept


def without_near_copies(texts: list[str], rows: int = 3) -> list[str]:
    """The texts that share none of a few MinHashes of five-word shingles with an earlier one: the words
    of one much copied text would otherwise look like common words."""
    salts = np.array([0x9E3779B97F4A7C15 + 2 * 0x85EBCA6B * k for k in range(rows)], np.uint64)
    seen: set = set()
    kept = []
    for text in texts:
        w = text.lower().split()
        shingles = np.array([zlib.crc32(" ".join(w[i : i + 5]).encode()) for i in range(max(1, len(w) - 4))], np.uint64)
        marks = {(k, int(h)) for k, h in enumerate((((shingles + np.uint64(1))[:, None] * salts) >> np.uint64(20)).min(axis=0))}
        if not marks & seen:
            kept.append(text)
        seen |= marks
    return kept


def calibrate(model: Model, toxic: list[str], clean: list[str], toxic_share: float) -> tuple:
    """Logistic regression on the features, the sample weighted to the labels' true shares. More matches
    never lower a score: a feature that would get a negative slope is left out."""
    full = np.array([(1.0, *model.features(t)) for t in [*toxic, *clean]])
    y = np.repeat([1.0, 0.0], [len(toxic), len(clean)])
    share = np.repeat([toxic_share / len(toxic), (1 - toxic_share) / len(clean)], [len(toxic), len(clean)]) * len(y)
    use = list(range(full.shape[1]))
    while True:
        x, w = full[:, use], np.zeros(len(use))
        for _ in range(100):  # Newton steps on the ridge-penalised likelihood
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w)), x.T @ (share * (y - p)) - 0.05 * w)
            w += step
            if np.abs(step).max() < 1e-8:
                break
        worst = int(np.argmin(w[1:])) + 1 if len(use) > 1 else 0
        if not worst or w[worst] >= 0:
            return tuple(float(w[use.index(k)]) if k in use else 0.0 for k in range(full.shape[1]))
        del use[worst]


def fit(toxic: list[str], clean: list[str], toxic_share: float | None = None) -> Model:
    if not toxic or not clean:
        return Model({f" {w} ": 5.0 for w in SEEDS})
    share = toxic_share or len(toxic) / (len(toxic) + len(clean))
    toxic, clean = without_near_copies(toxic), without_near_copies(clean)
    model = Model({f" {w} ": 3.0 for w in SEEDS} | fit_lexicon(toxic, clean))
    model.calibration = calibrate(model, toxic, clean, share)
    return model


def training_sample(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, max_chars: int = MAX_FIT_CHARS) -> tuple[list[str], list[str], float]:
    """docs (doc_id, text), labels (doc_id, label): at most per_label distinct texts of label 1 and of
    label 0, and the share of label 1. Only ids and hashes are joined; texts are read for the chosen."""
    slim = docs.where(F.col("text").isNotNull() & (F.length("text") <= max_chars)).select("doc_id", F.xxhash64("text").alias("h"))
    known = slim.join(labels.where(F.col("label").isin(0, 1)), "doc_id").groupBy("label", "h").agg(F.min("doc_id").alias("doc_id"))
    known = checkpointed(known)
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = [r for k in counts for r in known.where(F.col("label") == k).orderBy("h", "doc_id").limit(per_label).collect()]
    if not chosen:
        return [], [], 0.0
    ids = docs.sparkSession.createDataFrame([(r["doc_id"], r["label"], r["h"]) for r in chosen], "doc_id long, label int, h long")  # 2 * per_label rows
    found = docs.join(F.broadcast(ids), "doc_id").where(F.xxhash64("text") == F.col("h")).groupBy("label", "h").agg(F.first("text").alias("text")).collect()
    by = {k: [t for _, t in sorted((r["h"], r["text"]) for r in found if r["label"] == k)] for k in (0, 1)}
    return by[1], by[0], counts.get(1, 0) / sum(counts.values())


def scored(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text", name: str = "score") -> DataFrame:
    """The columns `keep` with the score under `name`, for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the lexicon: bounded by the fitted sample

    def run(batches):
        for batch in batches:
            scores = [shared.value.score(x.as_py()) for x in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], names=[*keep, name])

    return mapped(docs, keep, text_col, run, {name: F.lit(0.0)})


def trained(docs: DataFrame, labels: DataFrame) -> Model:
    known = labels.select("doc_id", F.col("toxic").alias("label")).where(~held_out(F.col("doc_id"), 4, 2))
    return fit(*training_sample(docs.select("doc_id", "text"), known))


def query(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scored(docs.select("doc_id", "text"), trained(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
