"""A corpus as JSON lines that is replaced as a whole, with a manifest from the same pass.

Tasks write files below <path>/data-<version>/ and send home what they have counted: lines, bytes and a digest of
each file, records read and rejected by dataset, and the longest and shortest records of each category, at most TOP
of each. The commit merges these messages into <path>/_manifest-<number>-<version>.json, which appears by a rename when
all files are there. Readers take the manifest with the highest number and the files that it names, so
a write that fails or is killed leaves the old corpus as it was; what it wrote is deleted, or lies unread.
Failed and repeated tasks write files of their own, which only a successful attempt's message names.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections import Counter
from dataclasses import dataclass, field
from urllib.parse import quote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..operators.validate import REJECTS
from ..plans.corpus import canonical_json
from . import paths
from .arrow_ipc import _located

TOP = 20
COLUMNS = ("category", "dataset", "split", "reject", "total_chars", "line")


@dataclass
class Written(WriterCommitMessage):
    """What one task has written. files: category, split, name, lines, bytes, sha256."""

    partition: int = 0
    files: list = field(default_factory=list)
    counts: Counter = field(default_factory=Counter)  # by (category, dataset, reject or '')
    longest: dict = field(default_factory=dict)
    shortest: dict = field(default_factory=dict)


def _kept(best: dict, category: str, found: list, largest: bool) -> None:
    both = best.get(category, []) + found
    best[category] = heapq.nlargest(TOP, both) if largest else heapq.nsmallest(TOP, both)


class CorpusWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.version, self.parameters = options["path"].rstrip("/"), options["version"], json.loads(options.get("parameters", "{}"))

    def write(self, iterator) -> Written:
        from pyspark import TaskContext

        task = TaskContext.get()
        done = Written(task.partitionId())
        system, inner = _located(self.path)
        key = stream = None

        def close() -> None:
            if stream is not None:
                stream.close()
                done.files.append((*key, name, lines, size, sha.hexdigest()))

        for batch in iterator:
            category, dataset, split, reject, chars, line = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in COLUMNS)
            done.counts.update(zip(category, dataset, (r or "" for r in reject)))
            found: dict = {}
            for c, d, s, r, n, text in zip(category, dataset, split, reject, chars, line):
                if r is not None:
                    continue
                if (c, s) != key:
                    close()
                    key, lines, size, sha = (c, s), 0, 0, hashlib.sha256()
                    folder = f"data-{self.version}/{quote(str(c), safe='')}"
                    name = f"{folder}/{s}-{done.partition:06d}-{task.taskAttemptId()}.jsonl"
                    system.create_dir(f"{inner}/{folder}")
                    stream = system.open_output_stream(f"{inner}/{name}")
                data = text.encode() + b"\n"
                stream.write(data)
                sha.update(data)
                lines, size = lines + 1, size + len(data)
                if n > 0:
                    found.setdefault(c, []).append((n, d))
            for c, pairs in found.items():
                _kept(done.longest, c, pairs, True)
                _kept(done.shortest, c, pairs, False)
        close()
        return done

    def commit(self, messages: list) -> None:
        system, inner = _located(self.path)
        messages = sorted((m for m in messages if m is not None), key=lambda m: m.partition)
        whole = Written()
        for m in messages:
            whole.files += m.files
            whole.counts.update(m.counts)
            for c in m.longest:
                _kept(whole.longest, c, m.longest[c], True)
                _kept(whole.shortest, c, m.shortest[c], False)
        system.create_dir(inner)
        number = 1 + max((int(n.split("-")[1]) for n in _manifests(self.path)), default=0)
        name = f"_manifest-{number:09d}-{self.version}.json"
        with system.open_output_stream(f"{inner}/.{name}") as out:
            out.write(json.dumps({"version": self.version, "categories": [self._category(c, whole) for c in sorted({k[0] for k in whole.counts}, key=str)]}, ensure_ascii=False, indent=1).encode())
        system.move(f"{inner}/.{name}", f"{inner}/{name}")

    def _category(self, category: str, whole: Written) -> dict:
        sets = sorted({d for c, d, _ in whole.counts if c == category}, key=str)
        count = lambda d, r: whole.counts[category, d, r]
        per_dataset = [{"dataset": d, "raw": sum(n for (c, x, _), n in whole.counts.items() if (c, x) == (category, d)), "accepted": count(d, ""), "rejects": {r: count(d, r) for r in REJECTS}} for d in sets]
        out = {"category": category, **self.parameters, "source_dataset_ids": sets, "per_dataset": per_dataset, "rejects": {r: sum(x["rejects"][r] for x in per_dataset) for r in REJECTS}}
        for split in ("train", "val"):
            files = [dict(zip(("name", "lines", "bytes", "sha256"), f[2:])) for f in whole.files if f[:2] == (category, split)]
            joined = hashlib.sha256("".join(f["sha256"] for f in files).encode()).hexdigest()
            out |= {f"{split}_lines": sum(f["lines"] for f in files), f"{split}_bytes": sum(f["bytes"] for f in files), f"{split}_sha256": joined, f"{split}_files": files}
        tops = {f"{side}_records": [{"chars": n, "dataset": d} for n, d in best.get(category, [])] for side, best in (("longest", whole.longest), ("shortest", whole.shortest))}
        return out | tops

    def abort(self, messages: list) -> None:
        from pyarrow import fs

        system, inner = _located(self.path)
        folder = f"{inner}/data-{self.version}"
        if system.get_file_info(folder).type == fs.FileType.Directory:
            system.delete_dir(folder)


class CorpusSink(DataSource):
    """df.write.format('corpus_jsonl').mode('append').option('version', id).save(path)"""

    @classmethod
    def name(cls) -> str:
        return "corpus_jsonl"

    def writer(self, schema, overwrite: bool):
        return CorpusWriter(dict(self.options))


def _manifests(path: str) -> list[str]:
    from pyarrow import fs

    system, inner = _located(path)
    return sorted(x.base_name for x in system.get_file_info(fs.FileSelector(inner, allow_not_found=True)) if x.base_name.startswith("_manifest-"))


def write_corpus(annotated: DataFrame, path: str, order: list[str], parameters: dict | None = None) -> dict:
    """Replaces the corpus at path by the accepted records, in order within each category and split, and returns its
    manifest. annotated: all records with category, dataset, split, reject, total_chars and messages; rejected ones
    are counted only. The digest of a split is over the digests of its files, which depend on how rows are dealt out;
    windows.ordered_digest() gives one that does not."""
    spark = annotated.sparkSession
    spark.dataSource.register(CorpusSink)
    none = F.array().cast(annotated.schema["messages"].dataType)
    lines = canonical_json(annotated.withColumn("messages", F.when(F.col("reject").isNull(), F.col("messages")).otherwise(none)))
    dealt = lines.repartitionByRange("category", "split", *order).sortWithinPartitions("category", "split", *order)
    dealt.select(*(c for c in COLUMNS if c != "total_chars"), F.col("total_chars").cast("long").alias("total_chars")).write.format("corpus_jsonl").mode("append").option("version", uuid4().hex).option("parameters", json.dumps(parameters or {})).save(path)
    return read_manifest(path)


def read_manifest(path: str) -> dict:
    """The newest complete manifest."""
    names = _manifests(path)
    if not names:
        raise FileNotFoundError(f"no corpus at {path}")
    system, inner = _located(path)
    with system.open_input_stream(f"{inner}/{names[-1]}") as f:
        return json.loads(f.read())


def read_corpus(spark: SparkSession, path: str, category: str, split: str) -> DataFrame:
    """file_path, line_no, value of one split, in the order of its files and lines."""
    (own,) = [c for c in read_manifest(path)["categories"] if c["category"] == category]
    files = [paths.escaped(f"{path.rstrip('/')}/{f['name']}") for f in own[f"{split}_files"]]
    if not files:
        return spark.createDataFrame([], "file_path string, line_no long, value string")
    return paths.numbered(paths.text_rows(spark, files))
