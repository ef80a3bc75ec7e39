"""A Spark data source for repository metadata of a hub, with the network client injected.

    spark.dataSource.register(HubMetadata)
    spark.read.format("hub_metadata").option("client", "my.module:search").option("queries", "chat,code").load()

The client is a function from one query to dicts with the fields of SCHEMA; each query is an input
partition, so searches run in parallel. No client ships with the engine, as it never opens a
connection by itself; the rows go on to `operators.profile.merged_hits` and the gates of
`operators.validate`.
"""

from __future__ import annotations

import importlib

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "query string, id string, total_bytes long, max_file_bytes long, gated boolean, downloads long, likes long, license string, has_readme boolean, data_files long"
FIELDS = [f.split()[0] for f in SCHEMA.split(", ")]


class Query(InputPartition):
    def __init__(self, text: str):
        self.text = text


class HubReader(DataSourceReader):
    def __init__(self, client: str, queries: list[str]):
        self.client, self.queries = client, queries

    def partitions(self):
        return [Query(q) for q in self.queries]

    def read(self, partition):
        module, _, name = self.client.partition(":")
        search = getattr(importlib.import_module(module), name)
        for row in search(partition.text):
            yield tuple(partition.text if f == "query" else row.get(f) for f in FIELDS)


class HubMetadata(DataSource):
    @classmethod
    def name(cls) -> str:
        return "hub_metadata"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        if ":" not in self.options.get("client", ""):
            raise ValueError("name a client as module:function; the engine has none of its own")
        return HubReader(self.options["client"], [q.strip() for q in self.options.get("queries", "").split(",") if q.strip()])
