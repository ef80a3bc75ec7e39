"""Language identification by string kernels.

The kernel of two texts is the blended-spectrum presence kernel: over character n-grams of several
orders, the share of distinct n-grams they have in common (cosine of presence vectors, averaged
over the orders). n-grams are hashed to 2^16 presence bits an order. Nystroem landmarks, texts from
the training sample, turn the kernel into features; one-versus-rest kernel ridge regression is
solved on them; documents are scored in batches by two matrix products. Whole texts are read.

The model is fitted on the driver from a bounded sample: at most PER_LANGUAGE distinct texts of a
language, of at most MAX_FIT_CHARS characters each, chosen by the hash of the text. Scoring covers
every row.

The score says which learned language is nearest, not that any is near: a text like no landmark has
margins near 0 and a score near 0.5. Whether a text is familiar is asked of its n-grams of the
highest order: the share that some landmark has must reach the floor of the predicted language, less
one standard deviation of a share of so many n-grams. A floor lies midway between that share for
random letters of the sample's own alphabet and what nearly all fitted texts of the language reach
(landmarks without their own help), so it follows the languages and the size of the sample. Where
the two don't lie apart the floor is 0, and nothing is unfamiliar.

Defined cases: a null text or one without a letter is `und` with score 0; rows with a null lang,
or a null doc_id, are not learned from; with nothing to learn from every row is `und`; equal texts
get equal predictions; equal margins take the first language by name; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mapped, table

ORDERS = (1, 2, 3)
BITS = 16
LANDMARKS = 96
PER_LANGUAGE = 384
MAX_FIT_CHARS = 100_000
RIDGE = 1e-3
#: The share of a language's fitted texts that its clean level may leave below it (mislabelled ones, junk).
STRAYS = 0.02
#: Texts of random letters that show the level of noise, and their characters.
NOISE_TEXTS, NOISE_CHARS = 32, 400
#: Documents scored in one matrix product.
BATCH = 256

_SPACE = 32
_table: list = []


def _letters() -> np.ndarray:
    """For each character below 2^16: itself if it is a letter, else a space."""
    if not _table:
        _table.append(np.array([c if chr(c).isalpha() else _SPACE for c in range(1 << 16)], np.uint32))
    return _table[0]


def _codes(text: str) -> np.ndarray:
    """Lower-cased characters, each run of other than letters as one space; empty without letters."""
    raw = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    codes = _letters()[np.minimum(raw, 0xFFFF)]
    if len(raw) and raw.max() > 0xFFFF:
        far, at = np.unique(raw[raw > 0xFFFF], return_inverse=True)
        codes[raw > 0xFFFF] = np.array([c if chr(c).isalpha() else _SPACE for c in far.tolist()], np.uint32)[at]
    if not (codes != _SPACE).any():
        return codes[:0]
    codes = np.concatenate([[np.uint32(_SPACE)], codes, [np.uint32(_SPACE)]]).astype(np.uint32)
    return codes[(codes != _SPACE) | np.concatenate([[True], codes[:-1] != _SPACE])]


def presence(text: str | None, out: np.ndarray) -> bool:
    """Sets the n-gram bits of a text in out (one row of bools an order). False if it has no letter."""
    out[:] = False
    codes = _codes(text) if text else np.empty(0, np.uint32)
    if not len(codes):
        return False
    acc = np.zeros(len(codes), np.uint32)
    for k in range(max(ORDERS)):
        if k:
            acc = acc[:-1]
        if not len(acc):
            break
        acc = acc * np.uint32(0x9E3779B1) + codes[k : k + len(acc)] + np.uint32(1)
        if k + 1 in ORDERS:
            out[ORDERS.index(k + 1)][(acc * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)] = True
    return True


@dataclass
class Model:
    languages: list
    columns: np.ndarray  # the presence bits that some landmark has
    order_of: np.ndarray  # the order of each column
    landmarks: np.ndarray  # columns x landmarks, normalised
    weights: np.ndarray  # landmarks x languages
    floors: np.ndarray  # for each language, the least share of known n-grams

    def features(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Kernel values (texts x landmarks), and which texts have letters."""
        return self._read(texts)[:2]

    def _read(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Features, and of each text's n-grams of the highest order: how many a landmark has, and how many there are."""
        x, some = np.zeros((len(texts), len(self.columns)), np.float32), np.zeros(len(texts), bool)
        known, total, last = np.zeros(len(texts)), np.zeros(len(texts)), int(np.searchsorted(self.order_of, len(ORDERS) - 1))
        bits = np.zeros((len(ORDERS), 1 << BITS), bool)
        flat = bits.reshape(-1)
        for i, text in enumerate(texts):
            some[i] = presence(text, bits)
            if some[i]:
                sizes = np.count_nonzero(bits, axis=1)
                scale = 1 / np.sqrt(np.maximum(sizes, 1))
                np.multiply(flat[self.columns], scale[self.order_of], out=x[i], casting="unsafe")
                known[i], total[i] = np.count_nonzero(x[i, last:]), sizes[-1]
        return x @ self.landmarks, some, known, total

    def predict(self, texts: list) -> tuple[list, np.ndarray]:
        return self.judge(texts)[:2]

    def judge(self, texts: list) -> tuple[list, np.ndarray, np.ndarray]:
        """The language of each text, its score, and whether the text is familiar."""
        names, scores, familiar = [], np.zeros(len(texts)), np.zeros(len(texts), bool)
        for at in range(0, len(texts), BATCH):
            part = texts[at : at + BATCH]
            kernel, some, known, total = self._read(part)
            margin = kernel.astype(np.float64) @ self.weights if self.languages else np.zeros((len(part), 0))
            for i in range(len(part)):
                if some[i] and self.languages:
                    best = int(np.argmax(margin[i]))
                    names.append(self.languages[best])
                    # to six places: the last bits of a float32 product depend on the batch and the machine
                    scores[at + i] = round(min(1.0, max(0.0, (margin[i, best] + 1) / 2)), 6)
                    familiar[at + i] = known[i] + np.sqrt(total[i]) / 2 >= self.floors[best] * total[i]
                else:
                    names.append("und")
        return names, scores, familiar


def _noise(texts: list[str]) -> list[str]:
    """Texts of letters drawn evenly from those of the given texts; the same for the same letters."""
    letters = sorted({c for t in texts for c in t.lower() if c.isalpha()}) or ["a"]
    rng = np.random.default_rng(0)
    picks, spaces = rng.integers(len(letters), size=(NOISE_TEXTS, NOISE_CHARS)), rng.random((NOISE_TEXTS, NOISE_CHARS)) < 1 / 6
    return ["".join(" " if s else letters[k] for k, s in zip(row, gaps)) for row, gaps in zip(picks, spaces)]


def fit(texts: list[str], labels: list[str], n_landmarks: int = LANDMARKS) -> Model:
    """texts in a fixed order: the landmarks are taken evenly from each language."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 0), np.float32), np.zeros((0, 0)), np.zeros(0))
    chosen: list[int] = []
    for language in languages:
        own = [i for i, x in enumerate(labels) if x == language]
        chosen += own[: max(4, n_landmarks // len(languages))]
    bits = np.zeros((len(ORDERS), 1 << BITS), bool)
    rows, own_row = [], {}
    for i in chosen:
        if presence(texts[i], bits):
            own_row[i] = len(rows)
            rows.append((bits / np.sqrt(np.maximum(np.count_nonzero(bits, axis=1), 1))[:, None] / len(ORDERS)).astype(np.float32).ravel())
    if not rows:
        return fit([], [])
    full = np.array(rows)
    columns = np.flatnonzero(full.any(axis=0))
    model = Model(languages, columns, columns >> BITS, np.ascontiguousarray(full[:, columns].T), np.zeros((len(rows), len(languages))), np.zeros(len(languages)))
    read = [model._read(texts[at : at + BATCH]) for at in range(0, len(texts), BATCH)]
    kernel = np.concatenate([r[0] for r in read]).astype(np.float64)
    some, known, total = (np.concatenate([r[k] for r in read]) for k in (1, 2, 3))
    # A landmark knows itself: of its n-grams only those count that another landmark has too.
    last = full[:, (len(ORDERS) - 1) << BITS :] > 0
    again = last & (last.sum(axis=0) > 1)
    for i, row in own_row.items():
        known[i] = again[row].sum()
    _, _, noise_known, noise_total = model._read(_noise(texts))
    noise = float(np.median(noise_known / np.maximum(noise_total, 1)))
    share = known / np.maximum(total, 1)
    for k, language in enumerate(languages):
        reached = share[[i for i, x in enumerate(labels) if x == language and some[i]]]
        clean = float(np.quantile(reached, STRAYS, method="lower")) if len(reached) else 0.0
        model.floors[k] = (noise + clean) / 2 if clean > 2 * noise else 0.0
    among = (full[:, columns] * len(ORDERS)).astype(np.float64) @ model.landmarks.astype(np.float64)
    value, vector = np.linalg.eigh((among + among.T) / 2)
    keep = value > 1e-6
    root = vector[:, keep] / np.sqrt(value[keep])  # the Nystroem map: kernel @ root
    phi = kernel @ root
    target = np.where(np.array(labels)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    balance = np.array([1 / labels.count(x) for x in languages])[[languages.index(x) for x in labels]][:, None]
    solved = np.linalg.solve((phi * balance).T @ phi + RIDGE * np.eye(phi.shape[1]), (phi * balance).T @ target)
    model.weights = root @ solved
    return model


def training_sample(rows: DataFrame, per_language: int = PER_LANGUAGE, max_chars: int = MAX_FIT_CHARS) -> tuple[list[str], list[str]]:
    """rows (lang, text): at most per_language distinct texts of each language, by the hash of the text."""
    usable = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") <= max_chars)).withColumn("h", F.xxhash64("text"))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    if not counts:
        return [], []
    share: Column = F.lit(0.0)
    for language, n in counts.items():
        share = F.when(F.col("lang") == language, min(1.0, 1.5 * per_language / max(n, 1))).otherwise(share)
    picked = usable.where(F.pmod("h", F.lit(1 << 20)) < share * (1 << 20)).groupBy("lang", "h").agg(F.first("text").alias("text"))
    by: dict[str, list] = {}
    for r in picked.collect():  # about 1.5 * per_language rows a language
        by.setdefault(r["lang"], []).append((r["h"], r["text"]))
    texts, labels = [], []
    for language in sorted(by):
        for _, text in sorted(by[language])[:per_language]:
            texts.append(text)
            labels.append(language)
    return texts, labels


def identify(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text", names: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """The columns `keep` with the predicted language, its score and, for a third name, whether the
    text is familiar, under `names`, for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by landmarks x n-gram bits

    def run(batches):
        for batch in batches:
            texts, found, scores, near = batch.column(batch.num_columns - 1), [], [], []
            for at in range(0, len(texts), BATCH):  # few texts at a time become Python objects
                names_of, scores_of, near_of = shared.value.judge(texts.slice(at, BATCH).to_pylist())
                found += names_of
                scores += scores_of.tolist()
                near += near_of.tolist()
            made = [pa.array(found, pa.string()), pa.array(scores, pa.float64()), pa.array(near, pa.bool_())][: len(names)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=[*keep, *names])

    return mapped(docs, keep, text_col, run, dict(zip(names, (F.lit(""), F.lit(0.0), F.lit(False)))))


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def trained(docs: DataFrame) -> Model:
    """A model from the labelled rows outside the held-out fold."""
    return fit(*training_sample(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("lang", "text")))


def query(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), trained(docs), ["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
