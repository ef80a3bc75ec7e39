"""Best-fit packing of tokenized documents into sequences of a fixed capacity.

Tokenizing is an Arrow map: texts are cut at white space, over which no pre-token reaches, and
each distinct chunk is encoded once per worker (a bounded cache). Packing needs only how
many pieces there are of each length, at most `capacity` numbers, so it is planned on the driver
whatever the corpus: pieces above half the capacity each open a sequence and take the largest
fitting partner above one third (greedy matching, at most two such pieces a sequence), leftover
pieces above one third pair among themselves, and smaller pieces fill the remaining gaps by best
fit, longest first. The plan says which ranks of a length go where; every piece finds its rank by
a prefix sum over per-partition counts, and its place by a search in the plan.

Defined cases: a null or empty text is the end token alone; a very long one becomes many pieces; ids
are integers (others fail the cast) and may be null; pieces of equal length are placed in any order; repeated rows and equal ids are packed
separately; only documents longer than the capacity are cut, the last piece keeping the rest; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import json
import unicodedata
import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, table

CAPACITY = 4096
END_ID = 1
#: Distinct chunks that a worker keeps; the cache starts anew when it is full.
CACHE = 600_000
#: Texts that are encoded together.
ROWS = 512

_tokenizers: dict = {}


def default_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: The normalizer and pre-tokenizer under which texts may be cut into chunks; others get whole texts. Fixed values.
CUT_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
CUT_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def _may_be_cut(tokenizer) -> bool:
    """By the state of the two parts alone: the vocabulary would be large."""
    normalizer, cutter = (part and json.loads(part.__getstate__()) for part in (tokenizer.normalizer, tokenizer.pre_tokenizer))
    first = ((cutter or {}).get("pretokenizers") or [{}])[0]
    return normalizer == CUT_NORMALIZER and (first.get("pattern") or {}).get("Regex") == CUT_PATTERN


@cache
def _makes_marks() -> str:
    """A class of the characters that are, or that composing and lower-casing turn into, letters with combining marks."""
    mark = lambda t: any(unicodedata.category(x)[0] == "M" for x in t)
    letters = (c for c in map(chr, range(0x80, 0x30000)) if not "\ud800" <= c <= "\udfff")
    changed = (c for c in letters if not unicodedata.is_normalized("NFC", c) or len(c.lower()) > 1)
    return "[\\p{M}" + "".join(f"\\x{{{ord(c):x}}}" for c in changed if not mark(c) and mark(unicodedata.normalize("NFC", c).lower())) + "]"


class ChunkEncoder:
    """Token ids of whole texts. Each distinct chunk between white space is encoded once.

    Spaces are also put between a letter and an ASCII sign other than an apostrophe, and A-Z are
    lower-cased, which no id depends on but which leaves fewer distinct chunks. Texts that hold a
    combining mark (which may compose over such a cut), a letter that is normalized to one with a
    mark, or the start of a special token are encoded whole instead; so are all texts if the
    tokenizer normalizes or cuts in other ways.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cuts = _may_be_cut(self.tokenizer)
        self.known: dict[str, bytes] = {}

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        """Encodes the chunks in one call; the tokens' offsets show where each chunk's ids end."""
        found = self.tokenizer.encode(" ".join(chunks), add_special_tokens=False)
        ids = np.array(found.ids, "<u4").tobytes()
        starts = np.fromiter((o[0] for o in found.offsets), np.int64, len(found.offsets))
        ends = np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)) + 1) - 1
        cuts = [0, *(4 * np.searchsorted(starts, ends)).tolist()]
        return {c: ids[cuts[i] : cuts[i + 1]] for i, c in enumerate(chunks)}

    def _ids_of(self, chunks: list[str]) -> list[bytes]:
        missing = [c for c in chunks if c not in self.known]
        if len(self.known) + len(missing) > CACHE:
            self.known, missing = {}, chunks
        for at in range(0, len(missing), 10_000):
            self.known.update(self._learn(missing[at : at + 10_000]))
        found = [self.known[c] for c in chunks]
        for c in missing:
            if len(c) > 64:  # long chunks hardly recur
                del self.known[c]
        return found

    def batch(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit bytes; none for a null."""
        texts = pc.fill_null(texts, "")
        if not self.cuts:
            return [np.array(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)]
        odd = pc.or_(pc.match_substring(texts, "<|"), pc.match_substring_regex(texts, _makes_marks()))
        plain = pc.replace_substring_regex(pc.ascii_lower(pc.if_else(odd, "", texts)), "[\\t-\\r]", " ")
        lists = pc.split_pattern(pc.replace_substring_regex(plain, "(\\p{L})([!-&(-/:-@\\[-`{-~])", "\\1 \\2"), " ")
        chunks = lists.flatten().dictionary_encode()
        parts = self._ids_of(chunks.dictionary.to_pylist())
        length = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        flat, start = np.frombuffer(b"".join(parts), "<u4"), np.cumsum(length) - length
        which = chunks.indices.to_numpy(zero_copy_only=False)
        n = length[which]
        upto = np.cumsum(n)
        ids = flat[np.repeat(start[which] - upto + n, n) + np.arange(len(n) and upto[-1])]
        ends = np.concatenate([[0], upto])[lists.offsets.to_numpy() - lists.offsets[0].as_py()].tolist()
        out = [ids[a:b].tobytes() for a, b in zip(ends, ends[1:])]
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
            out[i] = np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, "<u4").tobytes()
        return out


def encoder(path: str) -> ChunkEncoder:
    if path not in _tokenizers:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _tokenizers[path] = ChunkEncoder(path)
    return _tokenizers[path]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and the ids themselves if wanted."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encode = encoder(tokenizer_path)
        for batch in batches:
            which, number, start, length, crc, ids = [], [], [], [], [], []
            for i, ids_of in enumerate(x for at in range(0, batch.num_rows, ROWS) for x in encode.batch(batch.column(1).slice(at, ROWS))):
                whole = ids_of + end
                for k, at in enumerate(range(0, len(whole), 4 * capacity)):
                    part = whole[at : at + 4 * capacity]
                    which.append(i)
                    number.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            cols = [batch.column(0).take(pa.array(which, pa.int64())), pa.array(number, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols, names = [*cols, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """counts: pieces by length. Returns runs (length, first rank, n, first sequence, offset), each
    placing n pieces of consecutive ranks into n consecutive sequences, and the number of sequences."""
    left = {k: n for k, n in counts.items() if n > 0}
    if any(not 0 < k <= capacity for k in left):
        raise ValueError("a piece is longer than a sequence")
    used: dict[int, int] = defaultdict(int)
    runs: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # free room -> runs of sequences (first, n)
    rooms: list[int] = []  # the keys of gaps, in order
    total = 0

    def put(length: int, first: int, n: int, offset: int) -> None:
        runs.append((length, used[length], n, first, offset))
        used[length] += n

    def free(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in gaps:
                gaps[room] = []
                bisect.insort(rooms, room)
            gaps[room].append((first, n))

    def opened(n: int) -> int:
        nonlocal total
        total += n
        return total - n

    large = sorted(k for k in left if 3 * k > capacity)
    # Each piece above half takes the largest fitting piece above a third; then those pair among themselves.
    for k in reversed(large):
        while left.get(k):
            fit = bisect.bisect_right(large, capacity - k) - 1
            while fit >= 0 and not left[large[fit]]:
                fit -= 1
            partner = large[fit] if fit >= 0 else None
            if partner is None:
                n = left[k]
                first = opened(n)
                put(k, first, n, 0)
                free(capacity - k, first, n)
                left[k] = 0
                continue
            if partner == k:
                n, odd = divmod(left[k], 2)
                first = opened(n)
                put(k, first, n, 0)
                put(k, first, n, k)
                free(capacity - 2 * k, first, n)
                left[k] = odd
                if odd:
                    smaller = [x for x in large[:fit] if left[x]]
                    if smaller:
                        partner, n = smaller[-1], 1
                    else:
                        first = opened(1)
                        put(k, first, 1, 0)
                        free(capacity - k, first, 1)
                        left[k] = 0
                        continue
                else:
                    continue
            n = min(left[k], left[partner])
            first = opened(n)
            put(k, first, n, 0)
            put(partner, first, n, k)
            free(capacity - k - partner, first, n)
            left[k] -= n
            left[partner] -= n

    # Small pieces, longest first, each into the tightest gap; a gap takes as many as it holds.
    for k in sorted((k for k in left if 3 * k <= capacity), reverse=True):
        while left[k]:
            at = bisect.bisect_left(rooms, k)
            if at == len(rooms):
                each = capacity // k
                n = max(1, left[k] // each)
                free(capacity, opened(n), n)
                continue
            room = rooms[at]
            first, n = gaps[room].pop()
            if not gaps[room]:
                del gaps[room]
                rooms.pop(at)
            each = min(room // k, left[k])
            full = min(n, left[k] // each)
            for j in range(each):
                put(k, first, full, capacity - room + j * k)
            left[k] -= each * full
            free(room - each * k, first, full)
            free(room, first + full, n - full)
    return runs, total


def place(ranked: DataFrame, runs: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """Adds sequence_id and offset to rows with length and rank. The plan's size depends on the capacity only."""
    plan: dict[int, tuple] = {}
    by: dict[int, list] = defaultdict(list)
    for length, rank, n, first, offset in runs:
        if n:
            by[length].append((rank, first, offset))
    for length, found in by.items():
        plan[length] = tuple(np.array(x, np.int64) for x in zip(*sorted(found)))
    shared = ranked.sparkSession.sparkContext.broadcast(plan)

    def run(frames):
        for pdf in frames:
            if len(pdf) == 0:
                continue
            sequence, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
            lengths, ranks = pdf["length"].to_numpy(), pdf["rank"].to_numpy()
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                rank, first, at = shared.value[int(length)]
                i = np.searchsorted(rank, ranks[rows], "right") - 1
                sequence[rows] = first[i] + ranks[rows] - rank[i]
                offset[rows] = at[i]
            yield pdf.drop(columns=["rank"]).assign(sequence_id=sequence, offset=offset)

    schema = ", ".join(f"{n} {t}" for n, t in ranked.dtypes if n != "rank") + ", sequence_id long, offset long"
    return ranked.mapInPandas(run, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, the ids if wanted, sequence_id, offset."""
    parts = checkpointed(pieces(docs, tokenizer_path or default_tokenizer_path(), capacity, end_id, id_col, text_col, with_ids).withColumn("part", F.spark_partition_id()).withColumn("tie", F.monotonically_increasing_id()))
    # Ranks within a length: counts per (partition, length), their prefix sums, and the local row number.
    counts = parts.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    runs, _ = plan_packing(histogram, capacity)
    before = counts.select("length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    local = F.row_number().over(Window.partitionBy("part", "length").orderBy("tie")) - 1
    ranked = parts.withColumn("local", local).join(before, ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []), (F.col("before") + F.col("local")).alias("rank"))
    return place(ranked, runs)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, ids array<int>, lengths array<long> (for block-diagonal attention).
    placed: from pack_documents(with_ids=True); a sequence has at most `capacity` ids."""
    rows = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "length", "ids"))).alias("rows"))
    return rows.select("sequence_id", F.flatten(F.transform("rows", lambda r: r["ids"])).alias("ids"), F.transform("rows", lambda r: r["length"]).alias("lengths"))


def query(spark, sf_dir) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
