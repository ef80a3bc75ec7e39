"""A Spark data source for Arrow IPC files and streams, one input partition a file."""

from __future__ import annotations

import glob
import os
import re
from urllib.parse import quote

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema


def _located(path: str):
    """The file system of a path or URI as Spark shows it, not encoded (local, hdfs, s3, gs, abfs as pyarrow knows them), and
    the path in it."""
    from pyarrow import fs

    if path.startswith("file:/") or "://" not in path:
        return fs.LocalFileSystem(), os.path.abspath(re.sub("^file:/+", "/", path))
    scheme, rest = path.split("://", 1)
    return fs.FileSystem.from_uri(f"{scheme}://{quote(rest, safe='/:@')}")


def _open(path: str, options=None):
    import pyarrow as pa

    system, inner = _located(path)
    source = system.open_input_file(inner)
    try:
        return pa.ipc.open_file(source, options=options)
    except pa.ArrowInvalid:
        source.seek(0)
        return pa.ipc.open_stream(source, options=options)


def _paths(root: str) -> list[str]:
    """The file itself, or the .arrow files below a directory, as full paths in the form of root; local patterns work too."""
    from pyarrow import fs

    if any(c in root for c in "*?[") and "://" not in root:
        return sorted(glob.glob(root))
    system, inner = _located(root)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.File:
        return [root]
    before = root[: root.index("://") + 3] if "://" in root else ""
    if before and not root[len(before) :].startswith(inner):  # hdfs: the host is not part of the inner path
        before = root[: root.index(inner, len(before))]
    return sorted(before + x.path for x in system.get_file_info(fs.FileSelector(inner, recursive=True, allow_not_found=True)) if x.path.endswith(".arrow"))


class ArrowFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


class ArrowReader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self):
        return [ArrowFile(p) for p in self.paths]

    def read(self, partition):
        reader = _open(partition.path)
        batches = (reader.get_batch(i) for i in range(reader.num_record_batches)) if hasattr(reader, "num_record_batches") else reader
        yield from batches


class ArrowIpc(DataSource):
    """spark.dataSource.register(ArrowIpc); spark.read.format('arrow_ipc').load(path)"""

    @classmethod
    def name(cls) -> str:
        return "arrow_ipc"

    def schema(self):
        paths = _paths(self.options["path"])
        if not paths:
            raise FileNotFoundError(self.options["path"])
        return from_arrow_schema(_open(paths[0]).schema)

    def reader(self, schema):
        return ArrowReader(_paths(self.options["path"]))
