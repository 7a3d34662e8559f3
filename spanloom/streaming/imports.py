"""Streaming: idempotent import of arriving files, and windowed counts of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spanloom.sources.ingest import identified

LEDGER = "sha256 string, byte_size long, source_name string, batch long"


def import_stream(spark: SparkSession, source: str, ledger: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Import every content below ``source`` once; a batch that runs again appends nothing twice.

    Contents that the ledger has from other batches are left out; a replayed
    batch replaces its own folder.
    """
    files = spark.readStream.format("binaryFile").option("recursiveFileLookup", "true").schema("path string, modificationTime timestamp, length long, content binary").load(source)

    def write(batch: DataFrame, batch_id: int) -> None:
        own = identified(batch.select("path", "content")).groupBy("sha256", "byte_size").agg(F.min("path").alias("source_name"))
        known = imported(spark, ledger).filter(F.col("batch") != batch_id).select("sha256", "byte_size")
        new = own.join(known, ["sha256", "byte_size"], "left_anti")
        new.write.mode("overwrite").parquet(f"{ledger}/batch={batch_id}")

    return files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def imported(spark: SparkSession, ledger: str) -> DataFrame:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.option("basePath", ledger).schema(LEDGER).parquet(ledger)


def windowed_events(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums of events by window and type; works on a stream (with its watermark) and on a table."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    timed = timed.withWatermark("ts", late) if events.isStreaming else timed
    out = timed.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "event_type", "n", "total")
