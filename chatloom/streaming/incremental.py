"""Incremental formatting: a stream of JSON lines, deduplicated against everything kept so far.

The keys of kept records are keyed state in RocksDB, partitioned by key and looked up one by one: a
micro-batch reads and writes as many keys as it has, however long the history. Records are validated and adapted
by the batch plan's columns, so the contents that survive are those of one batch run over the same
lines; of equal records in one micro-batch any one stays, with its file_path. Records are written under the
batch's number and the state is versioned with it, so a repeated batch overwrites itself.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip
from ..functions.variant import lenient
from ..operators.adapters import adapted_record
from ..operators.validate import annotate, observed_counts
from ..sources import paths

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    """A setting that a query takes over when it starts, and that the session does not keep."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def formatted_lines(lines: DataFrame, **limits) -> DataFrame:
    """Annotated records of a frame of raw lines (raw, file_path), batch or stream, without duplicates being marked."""
    read = lines.where(strip(F.col("raw")) != "").select("*", F.inline(F.array(adapted_record(F.col("raw"))))).withColumnRenamed("reject", "_early")
    return annotate(read, [], early="_early", dedup=False, **limits)


def format_stream(spark: SparkSession, source: str, out: str, checkpoint: str, available_now: bool = True, max_files: int | None = None, **limits):
    """Starts the stream: JSON lines below source to accepted records below out/records. Returns the query, whose progress
    holds the counters of each micro-batch under observedMetrics: `read` (raw and each reason but duplicates) and
    `kept` (accepted)."""
    lenient(spark)
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.text(paths.escaped(source)).select(paths.readable(F.col("value")).alias("raw"), paths.file_path().alias("file_path"))
    done = observed_counts(formatted_lines(lines, **limits), "read")
    fresh = done.where("reject is null").select("messages", "dedup_key", "split", "file_path").dropDuplicates(["dedup_key"]).observe("kept", F.count(F.lit(1)).alias("accepted"))

    def batch(df: DataFrame, n: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/records/batch={n}")

    writer = fresh.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    with _setting(spark, "spark.sql.streaming.stateStore.providerClass", ROCKSDB):
        return (writer.trigger(availableNow=True) if available_now else writer).start()
