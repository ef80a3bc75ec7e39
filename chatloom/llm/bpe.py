"""Byte-level BPE encoding and decoding with the exact merges of a tokenizer file, linear in the text.

Encoding backtracks. An Aho-Corasick automaton over the vocabulary gives the longest token that starts
at each byte; the encoder takes it if it is compatible with the token before it, else the next shorter
token of that start, else it goes back to the token before. Two tokens are compatible if their bytes,
merged together, come out as these two: no merge joins an edge of the left one with an edge of the right
one while both edges exist. That is read off the two chains of edges, from single bytes up to whole
tokens, and kept in a table. A position that no encoding reaches is never tried again, so time is linear.
Decoding copies each token's bytes out of one string by a table of offsets, whole batches at once.

A text is cut before each single space or line feed, over which no pre-token reaches, and distinct
chunks and pieces are encoded once per worker (bounded caches). Texts in which such a sign stands
between other white space, and those that hold an added token, are cut as a whole instead. The pattern
of the pre-tokenizer is applied to chunks; where the library's own tables class a character otherwise
(they know other versions of Unicode), its own pre-tokenizer cuts the chunk.

Defined cases: a null or empty text has no ids and decodes to an empty text; null ids decode to an
empty text, and an id that the tokenizer lacks to nothing; ids whose bytes are no UTF-8 decode with
replacement characters, as in the library. Repeated rows, ties and null ids of documents are rows like any other; an
empty table gives an empty result. A very long text is encoded whole, in time and memory linear in
it. Columns to keep may have any names. A tokenizer of another kind (normalizer, other pre-tokenizer or
model, merges out of order) is refused by a ValueError.
"""

from __future__ import annotations

import json
from functools import cache
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, table

#: Distinct chunks, and distinct pieces, that a worker keeps; a full cache starts anew.
CACHE = 200_000
#: Chunks and pieces longer than this hardly recur and are not kept.
KEPT_CHARS = 64
#: Bytes of text that are encoded together, unless one text has more.
SLICE_BYTES = 4 << 20
NEVER = 1 << 62

# The pre-tokenizer's pattern, and white space as it is written for Arrow's expressions.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
CUT = "\x00"
#: A place where a space or line feed follows white space and is not the last of its run, or a sign that marks cuts.
UNCUT = rf"[{SPACE}][ \n]([{SPACE}]|$)|\x00"


def default_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 characters for
    themselves, the others in order from U+0100."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    moved = iter(range(256))
    return [chr(b) if b in shown else chr(256 + next(moved)) for b in range(256)]


def _checked(config: dict) -> dict:
    """The model's part of a tokenizer file of the kind that is encoded here; others raise a ValueError."""
    model, cutter, decoder = config["model"], config.get("pre_tokenizer") or {}, config.get("decoder") or {}
    wants = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "byte_fallback": False, "ignore_merges": False}
    odd = [k for k, v in wants.items() if (model.get(k) or None) != (v or None)]
    odd += [k for k in ("normalizer",) if config.get(k)]
    odd += ["pre_tokenizer"] * (cutter.get("type") != "ByteLevel" or cutter.get("add_prefix_space") or not cutter.get("use_regex", True))
    odd += ["decoder"] * (decoder.get("type") != "ByteLevel")
    odd += [a["content"] for a in config.get("added_tokens") or [] if a.get("single_word") or a.get("lstrip") or a.get("rstrip") or a.get("normalized")]
    if odd:
        raise ValueError(f"not a plain byte-level BPE tokenizer: {odd}")
    return model


class ByteBpe:
    """Encoder of one tokenizer file."""

    def __init__(self, path: str):
        import ahocorasick
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        model = _checked(config)
        self.cutter = Tokenizer.from_file(path).pre_tokenizer
        self.pattern = regex.compile(PATTERN)
        self.added = {a["content"]: a["id"] for a in config.get("added_tokens") or []}
        self.splitter = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        letters = byte_letters()
        byte_of = {c: chr(b) for b, c in enumerate(letters)}
        # tokens as Latin-1 strings, one character a byte
        plain = {t: "".join(map(byte_of.__getitem__, t)) for t in model["vocab"] if t not in self.added}
        ids = {plain[t]: model["vocab"][t] for t in plain}
        if len(ids) < len(plain) or any(chr(b) not in ids for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes or repeats a token")
        self.size = [0] * (max(ids.values()) + 1)
        for t, i in ids.items():
            self.size[i] = len(t)
        self._merges(model, ids, plain)
        self._chains(ids)
        self.fits: dict[int, bool] = {}
        reached = [(t, i) for t, i in ids.items() if i not in self.born or self._meets(*self.parts[i]) >= self.born[i]]
        kept = dict(reached)
        #: By token: the longest other token that it starts with, or -1.
        self.shorter = [-1] * len(self.size)
        for t, i in reached:
            self.shorter[i] = next((kept[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in kept), -1)
        self.tokens = kept
        self.longest = ahocorasick.Automaton()
        for t, i in reached:
            self.longest.add_word(t, i)
        self.longest.make_automaton()
        self.chunks: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.agrees: dict[str, bool] = {}

    def _merges(self, model: dict, ids: dict[str, int], plain: dict[str, str]) -> None:
        """rank of each pair, and the rank and parts by which each token is born."""
        self.rank, self.born, self.parts = {}, {}, {}
        for r, pair in enumerate(model["merges"]):
            left, right = (plain[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            a, b, whole = ids[left], ids[right], ids.get(left + right)
            if whole is None or whole in self.born or max(self.born.get(a, -1), self.born.get(b, -1)) >= r:
                raise ValueError("a merge without a token, a token with two merges, or merges out of order")
            self.rank[a << 32 | b], self.born[whole], self.parts[whole] = r, r, (a, b)

    def _chains(self, ids: dict[str, int]) -> None:
        """For each token its right and its left edges from a single byte up, each with the rank at which the
        next larger edge swallows it."""
        self.right, self.left = {}, {}
        for i in sorted(ids.values(), key=lambda i: self.born.get(i, -1)):
            for side, chain in ((1, self.right), (0, self.left)):
                if i in self.born:
                    below = chain[self.parts[i][side]]
                    chain[i] = (*below[:-1], (below[-1][0], self.born[i]), (i, NEVER))
                else:
                    chain[i] = ((i, NEVER),)

    def _meets(self, a: int, b: int) -> int:
        """The rank of the first merge that joins an edge of a with an edge of b; NEVER if none does.
        Of equal ranks the leftmost place merges first."""
        x, y = iter(self.right[a]), iter(self.left[b])
        (left, left_ends), (right, right_ends) = next(x), next(y)
        while True:
            at = self.rank.get(left << 32 | right, NEVER)
            if at < left_ends and at <= right_ends:
                return at
            if left_ends == right_ends == NEVER:
                return NEVER
            if left_ends <= right_ends:
                left, left_ends = next(x)
            else:
                right, right_ends = next(y)

    def compatible(self, a: int, b: int) -> bool:
        if len(self.fits) > 2 * CACHE:
            self.fits.clear()
        found = self.fits[a << 32 | b] = self._meets(a, b) == NEVER
        return found

    def _piece(self, piece: str) -> bytes:
        """The ids of one pre-token."""
        text = piece.encode().decode("latin-1")
        whole = self.tokens.get(text)
        if whole is not None:
            return pack("<I", whole)
        n, size, shorter, fits = len(text), self.size, self.shorter, self.fits
        first = [0] * n
        for end, i in self.longest.iter(text):  # by end, so the longest of a start comes last
            first[end - size[i] + 1] = i
        out, at, dead, i, before = [], 0, set(), first[0], -1
        while True:
            if i < 0:  # nothing that starts here fits what is before: go back
                dead.add(at)
                i = out.pop()
                at -= size[i]
                i, before = shorter[i], out[-1] if out else -1
                continue
            after = at + size[i]
            if after in dead:
                i = shorter[i]
                continue
            if before >= 0:
                fit = fits.get(before << 32 | i)
                if not (self.compatible(before, i) if fit is None else fit):
                    i = shorter[i]
                    continue
            out.append(i)
            if after == n:
                return pack(f"<{len(out)}I", *out)
            at, before, i = after, i, first[after]

    def _cut(self, chunk: str) -> list[str]:
        """The pre-tokens of a chunk."""
        if not chunk.isascii():
            for c in set(chunk):
                if c not in self.agrees:
                    probe = f"a{c}a1{c}1.{c}. {c} "
                    self.agrees[c] = c.isascii() or self._own_cut(probe) == self.pattern.findall(probe)
                if not self.agrees[c]:
                    return self._own_cut(chunk)
        return self.pattern.findall(chunk)

    def _own_cut(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.cutter.pre_tokenize_str(text)]

    def _chunk(self, chunk: str) -> bytes:
        found = []
        for piece in self._cut(chunk):
            ids = self.pieces.get(piece)
            if ids is None:
                ids = self._piece(piece)
                if len(piece) <= KEPT_CHARS:
                    if len(self.pieces) >= CACHE:
                        self.pieces.clear()
                    self.pieces[piece] = ids
            found.append(ids)
        return b"".join(found)

    def _whole(self, text: str) -> bytes:
        """The ids of a text that may not be cut into chunks."""
        out, at = [], 0
        for hit in self.splitter.finditer(text) if self.splitter else ():
            out += [self._chunk(text[at : hit.start()]), pack("<I", self.added[hit[0]])]
            at = hit.end()
        return b"".join([*out, self._chunk(text[at:])])

    def _chunks_of(self, chunks: list[str]) -> list[bytes]:
        known = self.chunks
        if len(known) + len(chunks) > CACHE:
            known.clear()
        out = []
        for c in chunks:
            ids = known.get(c)
            if ids is None:
                ids = self._chunk(c)
                if len(c) <= KEPT_CHARS:
                    known[c] = ids
            out.append(ids)
        return out

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; none for a null."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, UNCUT)
        for content in self.added:
            odd = pc.or_(odd, pc.match_substring(texts, content))
        marked = pc.if_else(odd, "", texts)
        for sign in (" ", "\n"):
            marked = pc.replace_substring(marked, sign, CUT + sign)
        lists = pc.split_pattern(marked, CUT)
        chunks = lists.flatten().dictionary_encode()
        parts = self._chunks_of(chunks.dictionary.to_pylist())
        length = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        flat, start = np.frombuffer(b"".join(parts), "<u4"), np.cumsum(length) - length
        which = chunks.indices.to_numpy(zero_copy_only=False)
        n = length[which]
        upto = np.cumsum(n)
        ids = flat[np.repeat(start[which] - upto + n, n) + np.arange(len(n) and upto[-1])]
        ends = np.concatenate([[0], upto])[lists.offsets.to_numpy() - lists.offsets[0].as_py()].tolist()
        out = [ids[a:b].tobytes() for a, b in zip(ends, ends[1:])]
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
            out[i] = self._whole(texts[i].as_py())
        return out

class OffsetTable:
    """Decoder: the bytes of all tokens in one string, and where each starts; ids that do not exist have no bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        tokens = {i: bytes(map(byte_of.__getitem__, t)) for t, i in _checked(config)["vocab"].items() if all(c in byte_of for c in t)}
        tokens |= {a["id"]: a["content"].encode() for a in config.get("added_tokens") or []}
        sizes = np.zeros(max(tokens) + 3, np.int64)
        for i, t in tokens.items():
            sizes[i + 1] = len(t)
        self.at = np.cumsum(sizes)
        self.text = np.frombuffer(b"".join(tokens[i] for i in sorted(tokens)), np.uint8)

    def decode(self, packed: pa.Array) -> list[str]:
        """The text of each row of packed ids; empty for a null."""
        rows = [b or b"" for b in packed.to_pylist()]
        ids = np.minimum(np.frombuffer(b"".join(rows), "<u4"), len(self.at) - 2).astype(np.int64)
        n = self.at[ids + 1] - self.at[ids]
        upto = np.cumsum(n)
        said = self.text[np.repeat(self.at[ids] - upto + n, n) + np.arange(len(n) and upto[-1])]
        ends = np.concatenate([[0], upto])[np.cumsum([0, *(len(b) // 4 for b in rows)])].tolist()
        return [said[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]


@cache
def _loaded(kind: type, path: str):
    """One for each worker process."""
    return kind(path)


def _slices(batch: pa.RecordBatch, factor: int = 1):
    """The batch in runs of rows of about SLICE_BYTES in the last column."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.columns[-1]), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(sizes):
        before = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, before + SLICE_BYTES * factor, "right")))
        yield batch.slice(at, to - at)
        at = to


def encoded(docs: DataFrame, tokenizer_path: str | None = None, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", name: str = "ids") -> DataFrame:
    """`keep` and the ids of each text in one binary column, little-endian unsigned 32-bit integers."""
    path = tokenizer_path or default_tokenizer_path()

    def run(batches):
        bpe = _loaded(ByteBpe, path)
        for batch in batches:
            for part in _slices(batch):
                ids = pa.array(bpe.encode(part.columns[-1]), pa.binary())
                yield pa.record_batch([*part.columns[:-1], ids], [*part.schema.names[:-1], "ids"])

    return mapped(docs, list(keep), text_col, run, {name: F.lit(None).cast("binary")})


def decoded(rows: DataFrame, tokenizer_path: str | None = None, keep: tuple[str, ...] = ("doc_id",), ids_col: str = "ids", name: str = "text") -> DataFrame:
    """`keep` and the text of each row's ids."""
    path = tokenizer_path or default_tokenizer_path()

    def run(batches):
        offsets = _loaded(OffsetTable, path)
        for batch in batches:
            for part in _slices(batch, 2):
                text = pa.array(offsets.decode(part.columns[-1]), pa.string())
                yield pa.record_batch([*part.columns[:-1], text], [*part.schema.names[:-1], "text"])

    return mapped(rows, list(keep), ids_col, run, {name: F.lit(None).cast("string")})


def query(spark, sf_dir) -> DataFrame:
    """Digests of the ids and of the texts that they decode to."""
    coded = encoded(table(spark, sf_dir, "documents"))
    digests = coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), "ids")
    back = decoded(digests, keep=("doc_id", "n_tokens", "ids_sha256"))
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
