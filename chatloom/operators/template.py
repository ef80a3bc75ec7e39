"""Chat templates: rendering, checks, and token masks with an injected tokenizer."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .windows import last_index

# Turn markers and the wrapper of reasoning.
START, END = "<|im_start|>", "<|im_end|>"
THINK = "<think>\n\n</think>\n\n"
IGNORED = -100
#: Conversations that are encoded together.
BATCH_ROWS = 512


def render(messages: Column, generation_prompt: bool = False, thinking: bool = False) -> Column:
    """The turns between markers. Without thinking, assistant turns after the last user turn get an empty
    reasoning wrapper."""
    last = last_index(messages)

    def turn(m: Column, i: Column) -> Column:
        wrap = F.lit("") if thinking else F.when((m["role"] == "assistant") & (i > last), F.lit(THINK)).otherwise(F.lit(""))
        return F.concat(F.lit(START), m["role"], F.lit("\n"), wrap, m["content"], F.lit(END + "\n"))

    text = F.array_join(F.transform(messages, turn), "")
    return F.concat(text, F.lit(f"{START}assistant\n" + ("" if thinking else THINK))) if generation_prompt else text


def occurrences(text: Column, marker: str) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(marker), F.lit("")))) / len(marker)).cast("int")


def check_render(messages: Column, rendered: Column) -> dict[str, Column]:
    """What a correct rendering satisfies, by name."""
    return {
        "starts": F.startswith(rendered, F.lit(START)),
        "counts": (occurrences(rendered, START) == F.size(messages)) & (occurrences(rendered, END) == F.size(messages)),
        "content_clean": ~F.exists(messages, lambda m: F.contains(m["content"], F.lit(START)) | F.contains(m["content"], F.lit(END))),
        "has_assistant": F.exists(messages, lambda m: (m["role"] == "assistant") & (m["content"] != "")),
    }


class CharTokenizer:
    """A reversible stand-in for tests: one id a character."""

    def __call__(self, text: str) -> list[int]:
        return [ord(c) for c in text]

    def batch(self, texts: list[str]) -> list[tuple]:
        return [(np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int32), np.arange(1, len(t) + 1)) for t in texts]


whitespace_tokenizer = CharTokenizer()


class FileTokenizer:
    """A tokenizer from a file, loaded once a worker."""

    def __init__(self, path: str):
        self.path = path

    def __reduce__(self):
        return FileTokenizer, (self.path,)

    def _loaded(self):
        if not hasattr(self, "_tokenizer"):
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_file(self.path)
        return self._tokenizer

    def __call__(self, text: str) -> list[int]:
        return self._loaded().encode(text, add_special_tokens=False).ids

    def batch(self, texts: list[str]) -> list[tuple]:
        """(ids, ends) of each text: where each token ends, in characters."""
        found = self._loaded().encode_batch(texts, add_special_tokens=False)
        return [(np.array(e.ids, np.int32), np.fromiter((b for _, b in e.offsets), np.int64, len(e.ids))) for e in found]


pandas_tokenizer = FileTokenizer


def _parts(messages: Column) -> tuple[Column, Column]:
    """The rendering as texts, three a turn: what stands before a content, the content with its end, and a line feed; and
    whether each turn is an assistant's."""
    last = last_index(messages)

    def turn(m: Column, i: Column) -> Column:
        wrap = F.when((m["role"] == "assistant") & (i > last), F.lit(THINK)).otherwise(F.lit(""))
        return F.array(F.concat(F.lit(START), m["role"], F.lit("\n"), wrap), F.concat(m["content"], F.lit(END)), F.lit("\n"))

    return F.flatten(F.transform(messages, turn)), F.transform(messages, lambda m: m["role"] == "assistant")


def tokenize_chat(df: DataFrame, tokenizer, max_length: int, messages: str = "messages", learn: str = "all") -> DataFrame:
    """Adds input_ids, attention_mask, labels (IGNORED where nothing is learned), assistant_tokens and full_length.

    Each conversation is encoded once, with the place where each token ends; the turns' places in the text,
    which are sums of lengths, are searched among them, so the work is linear in the tokens. A token belongs to a turn
    if it ends inside it. That is what follows the longest common prefix of the encodings with and without the turn,
    where the template's own text before the turn is encoded alike in both.
    learn: 'all' assistant turns with their end markers, or the 'last' one with what follows it. The tokenizer has
    batch(texts) as FileTokenizer has."""
    if learn not in ("all", "last"):
        raise ValueError(f"learn must be 'all' or 'last', not {learn!r}")
    parts, said = _parts(F.col(messages))
    names = list(df.columns)
    plain = df.select(*(F.col("`" + c.replace("`", "``") + "`").alias(f"c{i}") for i, c in enumerate(names)), parts.alias("parts"), said.alias("said"))
    schema = T.StructType([*plain.drop("parts", "said").schema, *(T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("input_ids", "attention_mask", "labels")), T.StructField("assistant_tokens", T.IntegerType()), T.StructField("full_length", T.IntegerType())])

    def rows(batch: pa.RecordBatch):
        texts = pc.binary_join(batch.column("parts"), "")
        ends = np.cumsum(pc.utf8_length(batch.column("parts").flatten()).to_numpy(zero_copy_only=False).astype(np.int64))
        turns = np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column("said")).to_numpy(zero_copy_only=False).astype(np.int64))])
        spoken = batch.column("said").flatten().to_numpy(zero_copy_only=False)
        ids, masks, full = [], [], []
        for k, (own, stops) in enumerate(tokenizer.batch(texts.to_pylist())):
            a, b = turns[k], turns[k + 1]
            before = ends[3 * a - 1] if a else 0
            place = ends[3 * a : 3 * b].reshape(-1, 3) - before
            place = place[spoken[a:b].astype(bool)]
            mask = np.zeros(len(own) + 1, np.int64)
            if learn == "last":
                place = place[-1:]
            stop = np.maximum.accumulate(stops) if len(stops) else stops
            np.add.at(mask, np.searchsorted(stop, place[:, 0], "right"), 1)
            if learn == "all":
                np.add.at(mask, np.searchsorted(stop, place[:, 1], "right"), -1)
            ids.append(own[:max_length])
            masks.append(np.cumsum(mask)[: len(own)][:max_length] > 0)
            full.append(len(own))
        return ids, masks, full

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                ids, masks, full = rows(batch)
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32))
                flat, mask = np.concatenate([*ids, []]).astype(np.int32), np.concatenate([*masks, []]).astype(bool)
                lists = [pa.ListArray.from_arrays(offsets, pa.array(v.astype(np.int32))) for v in (flat, np.ones(len(flat)), np.where(mask, flat, IGNORED))]
                yield pa.record_batch([*batch.columns[:-2], *lists, pa.array([int(m.sum()) for m in masks], pa.int32()), pa.array(full, pa.int32())], schema.names)

    return plain.mapInArrow(run, schema).toDF(*names, *schema.names[-5:])


def drop_all_masked(tokens: DataFrame) -> DataFrame:
    return tokens.where(F.exists("labels", lambda x: x != IGNORED))


def truncation_stats(tokens: DataFrame, by: list[str], max_length: int, worst: float = 0.05) -> DataFrame:
    """Shares of truncated and of all-masked rows, the mean share kept, and whether a group passes."""
    cut = F.col("full_length") > max_length
    return tokens.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.avg(cut.cast("double")).alias("truncated"),
        F.avg((F.col("assistant_tokens") == 0).cast("double")).alias("all_masked"),
        F.avg(F.least(F.lit(1.0), F.lit(max_length) / F.greatest(F.col("full_length"), F.lit(1)))).alias("kept_share"),
    ).withColumn("passes", F.col("truncated") <= worst)
