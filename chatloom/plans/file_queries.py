"""Queries over files that Spark writes from the driver tables: the sources on whole tables, beside their DuckDB equivalent.

The files are written to the shared checkpoint folder and deleted when the application ends.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import inventory
from ..operators.windows import carried
from ..session import ensure_checkpoint_dir, table
from ..sources import corpus_sink, corpus_source, heads, json_ranges, paths, readers
from . import corpus
from .queries import _DOC, _doc_annotated, query


def scratch(spark: SparkSession) -> str:
    """A folder of its own in the shared checkpoint folder, deleted when the application ends."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/files-{uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def renamed(spark: SparkSession, directory: str, old: str, new: str) -> None:
    """Gives the part files of a directory another suffix."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    system = hadoop(directory).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in system.listStatus(hadoop(directory)):
        name = status.getPath().getName()
        if name.startswith("part-") and name.endswith(old):
            system.rename(status.getPath(), hadoop(f"{directory}/{name.removesuffix(old)}{new}"))


def written_lists(rows: DataFrame, directory: str, order: str) -> None:
    """One JSON list a partition, in order; each list is one line."""
    spark = rows.sparkSession
    parts = rows.repartitionByRange(order).sortWithinPartitions(order).withColumn("value", F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})).select("value")

    def listed(batches):
        import pyarrow as pa

        opened = False
        for batch in batches:
            values = batch.column(0).to_pylist()
            if values:
                values[0] = ("," if opened else "[") + values[0]
                values[1:] = ["," + v for v in values[1:]]
                opened = True
                yield pa.record_batch([pa.array(values)], ["value"])
        if opened:
            yield pa.record_batch([pa.array(["]"])], ["value"])

    parts.mapInArrow(listed, "value string").write.option("lineSep", " ").text(directory)
    renamed(spark, directory, ".txt", ".json")


def document_tree(spark: SparkSession, sf_dir: str) -> str:
    """All documents as a tree of datasets: by doc_id % 4 as CSV, JSON lists, gzipped JSON lines and Parquet, in order of doc_id."""
    root = scratch(spark)
    docs = table(spark, sf_dir, "documents")
    row = docs.select("doc_id", F.concat(F.lit("Write a text from "), "source", F.lit(".")).alias("prompt"), F.col("text").alias("response"))
    of = lambda k: row.where(F.col("doc_id") % 4 == k).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    of(0).write.option("header", "true").option("quoteAll", "true").option("escape", '"').option("quote", '"').csv(f"{root}/docs/own__csv")
    written_lists(of(1), f"{root}/docs/own__list", "doc_id")
    of(2).write.option("compression", "gzip").json(f"{root}/docs/own__lines/part one")
    renamed(spark, f"{root}/docs/own__lines/part one", ".json.gz", ".jsonl.gz")
    of(3).write.parquet(f"{root}/docs/own__rows")
    return root


_NAMES = "CASE doc_id % 4 WHEN 0 THEN 'own/csv' WHEN 1 THEN 'own/list' WHEN 2 THEN 'own/lines' ELSE 'own/rows' END AS dataset"
_SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}]"
_CLEAN = rf"regexp_replace(regexp_replace(regexp_replace(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '\n{{3,}}', chr(10) || chr(10), 'g'), '^{_SPACE}+', ''), '{_SPACE}+$', '')"
_TREE = f"""WITH d AS (SELECT doc_id, {_NAMES}, 'Write a text from ' || source || '.' AS ask, {_CLEAN} AS said, text FROM documents),
e AS (SELECT *, CASE WHEN coalesce(text, '') = '' OR ask IS NULL THEN 'unsupported_schema' WHEN said = '' THEN 'missing_field' WHEN length(ask) + length(said) < 300 THEN 'too_short' WHEN length(ask) + length(said) > 20000 THEN 'too_long' END AS early FROM d),
r AS (SELECT *, CASE WHEN early IS NOT NULL THEN early WHEN row_number() OVER (PARTITION BY early, ask, said ORDER BY list_position(['own/csv', 'own/lines', 'own/list', 'own/rows'], dataset), doc_id) > 1 THEN 'duplicate' END AS reject FROM e)
"""


@query(_TREE + "SELECT dataset, reject, count(*) AS n, sha256(string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id)) AS ids FROM r GROUP BY ALL")
def tree_formatted(spark, sf_dir):
    """A tree of four kinds of files formatted in one call: how many records of each dataset met which fate, and which. Of
    equal records the first by files and lines stays."""
    done = corpus.formatted_tree(spark, document_tree(spark, sf_dir), min_chars=300, max_chars=20_000)
    ids = done.select("dataset", "reject", F.get_json_object("raw", "$.doc_id").cast("long").alias("id"))
    joined = F.array_join(F.array_sort(F.collect_list("id")).cast("array<string>"), ",")
    return ids.groupBy("dataset", "reject").agg(F.count("*").alias("n"), F.sha2(joined, 256).alias("ids"))


@query("SELECT doc_id, sha256(coalesce(text, 'none')) AS text_sha256, length(text) AS n_chars FROM documents")
def json_list_elements(spark, sf_dir):
    """Lists that are one line each, read by many tasks."""
    root = scratch(spark)
    written_lists(table(spark, sf_dir, "documents").select("doc_id", "text"), f"{root}/lists", "doc_id")
    found = json_ranges.records(spark, root, paths.any_case((".json",)))
    row = F.from_json("raw", "doc_id long, text string")
    return found.select(row.alias("r")).select("r.doc_id", F.sha2(F.coalesce("r.text", F.lit("none")), 256).alias("text_sha256"), F.length("r.text").cast("long").alias("n_chars"))


@query(f"SELECT {_NAMES.replace('own/', '')}, count(*) AS records FROM documents GROUP BY ALL")
def tree_record_counts(spark, sf_dir):
    """Records by dataset: JSON by its structure, lines by their ends, Parquet by its footers. CSV is counted by lines, as a
    reader without quotes would, so here by its records."""
    root = document_tree(spark, sf_dir)
    counts = inventory.record_counts(spark, readers.file_catalog(spark, root, (".json", ".jsonl.gz", ".parquet")))
    csv = corpus_source.records(spark, root, ("own/csv",)).groupBy("file_path").agg(F.count("*").alias("records"))
    of = F.regexp_extract("file_path", "/docs/own__([a-z]+)/", 1)
    return counts.unionByName(csv).groupBy(of.alias("dataset")).agg(F.sum("records").alias("records"))


@query("""WITH r AS (SELECT event_type, event_id, props, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS k FROM events)
SELECT event_type, k - 1 AS line_no, event_id, array_to_string(list_sort(json_keys(props)), ',') AS keys FROM r WHERE k <= 3""")
def first_records_of_files(spark, sf_dir):
    """The first three records of a file for each event type, read from the heads of the files alone."""
    root = scratch(spark)
    events = table(spark, sf_dir, "events").select("event_type", F.to_json(F.struct("event_id", "props")).alias("value"), "event_id")
    events.repartition("event_type").sortWithinPartitions("event_type", "event_id").select("value", "event_type").write.partitionBy("event_type").text(root)
    found = heads.first_records(readers.file_catalog(spark, root))
    row = F.from_json("raw", "event_id long, props string")
    of = F.regexp_extract("path", "/event_type=([^/]+)/", 1)
    keys = F.array_join(F.array_sort(F.json_object_keys("r.props")), ",")
    return found.select(of.alias("event_type"), "line_no", row.alias("r")).select("event_type", "line_no", "r.event_id", keys.alias("keys"))


@query("""WITH l AS (SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 50 = 0 THEN 'section ' || o_custkey END AS head FROM orders)
SELECT o_orderkey, last_value(head IGNORE NULLS) OVER (ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS section FROM l""")
def carried_sections(spark, sf_dir):
    """Headings carried down one group of all rows, in many tasks."""
    head = F.when(F.col("o_custkey") % 50 == 0, F.concat(F.lit("section "), "o_custkey"))
    return carried(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), head, "section", [], ["o_orderkey"]).select("o_orderkey", "section")


@query(_DOC + """, l AS (SELECT lang, total, source, row_number() OVER (PARTITION BY lang ORDER BY total DESC, source DESC) AS down, row_number() OVER (PARTITION BY lang ORDER BY total, source) AS up FROM s WHERE reject IS NULL),
t AS (SELECT lang, string_agg(total || ' ' || source, ',' ORDER BY down) FILTER (down <= 20) AS longest, string_agg(total || ' ' || source, ',' ORDER BY up) FILTER (up <= 20) AS shortest FROM l GROUP BY lang)
SELECT lang, count(*) AS raw, count(*) FILTER (split = 'train') AS train_lines, count(*) FILTER (split = 'val') AS val_lines, count(*) FILTER (reject = 'too_short') AS too_short, count(*) FILTER (reject = 'too_long') AS too_long, count(*) FILTER (reject = 'duplicate') AS duplicate, any_value(longest) AS longest, any_value(shortest) AS shortest
FROM s LEFT JOIN t USING (lang) GROUP BY lang""")
def corpus_manifest(spark, sf_dir):
    """The manifest that a corpus is published with, from the pass that writes it."""
    rows = _doc_annotated(spark, sf_dir).withColumnsRenamed({"lang": "category", "source": "dataset"})
    found = corpus_sink.write_corpus(rows, scratch(spark), ["doc_id"], {"seed": 42})["categories"]
    joined = lambda best: ",".join(f"{x['chars']} {x['dataset']}" for x in best)
    made = [(c["category"], sum(d["raw"] for d in c["per_dataset"]), c["train_lines"], c["val_lines"], *(c["rejects"][r] for r in ("too_short", "too_long", "duplicate")), joined(c["longest_records"]), joined(c["shortest_records"])) for c in found]
    return spark.createDataFrame(made, "lang string, raw long, train_lines long, val_lines long, too_short long, too_long long, duplicate long, longest string, shortest string")
