"""The first records of files, read from their first bytes.

Tasks get paths, open each file as a stream (opening .gz on the way) and stop after the records asked for, so
the work grows with the number of files and not with their sizes. Stores that Arrow does not know are
read by Spark instead, which costs a scan: by_arrow() tells.
"""

from __future__ import annotations

import codecs
import csv
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpointed
from .arrow_ipc import _located, _open

STEP = 1 << 16
KINDS = {"path": pa.string(), "line_no": pa.int64(), "raw": pa.string(), "listed": pa.bool_(), "bytes_read": pa.int64()}
SCHEMA = "path string, line_no long, raw string, listed boolean, bytes_read long"


def by_arrow(path: str) -> bool:
    """Whether tasks can open files of this store themselves."""
    try:
        _located(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError, ValueError):
        return False
    return True


class Head:
    """The text of a file, a step at a time."""

    def __init__(self, path: str):
        system, inner = _located(path)
        self.source = system.open_input_file(inner)
        packed = path.lower().endswith(".gz")
        self.stream = pa.CompressedInputStream(self.source, "gzip") if packed else self.source
        self.decode = codecs.getincrementaldecoder("utf-8")("ignore").decode
        self.ended = False
        self.held = ""  # read by opens_list() and not yet given

    def more(self) -> str:
        if self.held:
            text, self.held = self.held, ""
            return text
        data = self.stream.read(STEP)
        self.ended = not data
        return self.decode(data, self.ended)

    def opens_list(self) -> bool:
        """Whether the first sign of the file opens a list."""
        text = self.more()
        while not text.strip() and not self.ended:
            text += self.more()
        if not self.ended and len(text) < STEP:  # small files are known whole
            text += self.more()
        self.held = text
        return text.lstrip()[:1] == "["

    def lines(self) -> Iterator[str]:
        """Lines without their ends; CR, LF and CRLF end one."""
        held = ""
        while self.held or not self.ended:
            held += self.more()
            # a CR at the end may be half of a CRLF
            *whole, held = re.split("\r\n|\n|\r(?!\\Z)" if not self.ended else "\r\n|\n|\r", held)
            yield from whole
        if held:
            yield held

    def elements(self) -> Iterator[str]:
        """The elements of a list, or the one value of another file; nothing more where the text does not parse."""
        listed, text, at, decoder = self.opens_list(), self.more(), 0, json.JSONDecoder()
        if not listed:
            while not self.ended:
                text += self.more()
            yield text
            return
        at = text.index("[") + 1
        while True:
            while at < len(text) and text[at] in " \t\r\n,":
                at += 1
            try:
                _, end = decoder.raw_decode(text, at)
            except ValueError:
                end = len(text)
            if end < len(text):  # the value is not cut off
                yield text[at:end]
                text, at = text[end:], 0
            elif self.ended or text[at : at + 1] == "]":
                return
            else:
                text, at = text[at:] + self.more(), 0


def _records(head: Head, path: str, n: int) -> tuple[Iterator[str], bool]:
    """The first records of a file as JSON, and whether it is a list."""
    name = path.lower().removesuffix(".gz")
    as_json = lambda rows: (json.dumps(r, ensure_ascii=False, default=str) for r in rows)
    if name.endswith(".csv"):
        return as_json(csv.DictReader(line + "\n" for line in head.lines())), False
    if name.endswith(".parquet"):
        import pyarrow.parquet as pq

        return as_json(r for b in pq.ParquetFile(head.source).iter_batches(batch_size=n) for r in b.to_pylist()), False
    if name.endswith(".arrow"):
        reader = _open(path)
        batches = (reader.get_batch(i) for i in range(reader.num_record_batches)) if hasattr(reader, "num_record_batches") else reader
        return as_json(r for b in batches for r in b.slice(0, n).to_pylist()), False
    listed = head.opens_list()
    if listed or name.endswith(".json") and head.ended and _parses(head.held):
        return head.elements(), listed
    return (line for line in head.lines() if line.strip()), False


def _parses(text: str) -> bool:
    try:
        json.loads(text)
    except ValueError:
        return False
    return True


def first_records(files: DataFrame, n: int = 3, path: str = "path") -> DataFrame:
    """path, line_no, raw, listed, bytes_read: the first n records of each file of a catalog. JSON that is not a
    list and does not parse within the first step is taken for lines."""

    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                head = Head(name)
                found, listed = _records(head, name, n)
                rows = [(name, k, raw, listed) for k, raw in zip(range(n), found)]
                size = head.source.tell()
                columns = zip(*(r + (size,) for r in rows)) if rows else [[]] * len(KINDS)
                yield pa.record_batch([pa.array(x, k) for x, k in zip(columns, KINDS.values())], list(KINDS))

    return files.select(F.col(path).alias("path")).mapInArrow(run, SCHEMA)


def list_files(files: DataFrame, path: str = "path") -> DataFrame:
    """path and whether the file's first sign opens a list; a file of white space is none."""

    def run(batches):
        for batch in batches:
            names, listed = batch.column(0).to_pylist(), []
            for name in names:
                listed.append(Head(name).opens_list())
            yield pa.record_batch([pa.array(names, pa.string()), pa.array(listed, pa.bool_())], ["path", "listed"])

    return files.select(F.col(path).alias("path")).mapInArrow(run, "path string, listed boolean")


def arrow_counts(files: DataFrame, path: str = "path") -> DataFrame:
    """path and rows of Arrow IPC files and streams, from one column of each batch; a file that is neither has no row."""

    def run(batches):
        for batch in batches:
            names, counts = [], []
            for name in batch.column(0).to_pylist():
                try:
                    reader = _open(name, pa.ipc.IpcReadOptions(included_fields=[0]))
                    rows = (reader.get_batch(i) for i in range(reader.num_record_batches)) if hasattr(reader, "num_record_batches") else reader
                    counts.append(sum(b.num_rows for b in rows))
                    names.append(name)
                except pa.ArrowInvalid:
                    continue
            yield pa.record_batch([pa.array(names, pa.string()), pa.array(counts, pa.int64())], ["path", "records"])

    return files.select(F.col(path).alias("path")).mapInArrow(run, "path string, records long")


def walk(spark: SparkSession, root: str, skip: tuple[str, ...] = (".git", ".cache"), depth: int = 256) -> DataFrame:
    """path and size of the files below root. Directories are listed by tasks, a level at a time, and those named in
    `skip` are never entered, so what is below them costs nothing; links to directories are not followed in circles, as
    `depth` levels are the most. Hidden and empty files are listed too."""

    def listed(batches):
        from pyarrow import fs

        for batch in batches:
            found = []
            for name in batch.column(0).to_pylist():
                system, inner = _located(name)
                before = name[: name.rindex(inner)] if inner in name else name.split("://")[0] + "://"
                for x in system.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
                    if x.type == fs.FileType.Directory and x.base_name not in skip:
                        found.append((before + x.path, None, True))
                    elif x.type == fs.FileType.File:
                        found.append((before + x.path, x.size, False))
            columns = zip(*found) if found else ([], [], [])
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.bool_()))], ["path", "size", "directory"])

    here, out = spark.createDataFrame([(root.rstrip("/") or "/",)], "path string"), None
    for _ in range(depth):
        level = checkpointed(here.repartition("path").mapInArrow(listed, "path string, size long, directory boolean"))
        files = level.where("not directory").select("path", "size")
        out = files if out is None else out.unionByName(files)
        here = level.where("directory").select("path")
        if here.isEmpty():
            return out
    raise RecursionError(f"directories are nested deeper than {depth} levels below {root}")
