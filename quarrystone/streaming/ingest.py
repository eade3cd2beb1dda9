"""Streams of new documents and events: this library's own addition to the batch layers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def new_documents(spark: SparkSession, root: str, glob: str = "*.pdf", keep: str = "7 days") -> DataFrame:
    """New files of a folder, each content once within ``keep``."""
    kind = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()), T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])
    files = spark.readStream.format("binaryFile").schema(kind).option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    named = files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("document"), "path", "content", "modificationTime", F.substring(F.sha2("content", 256), 1, 16).alias("sha256"))
    return named.withWatermark("modificationTime", keep).dropDuplicatesWithinWatermark(["sha256"])


def windowed_counts(events: DataFrame, size: str = "1 hour", late: str = "2 hours", ts: str = "ts", key: str = "event_type") -> DataFrame:
    """Counts and sums of events by window and key, late ones up to ``late``."""
    typed = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return typed.groupBy(F.window(ts, size), key).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("window_start"), key, "n", "total")


def run_available(stream: DataFrame, path: str, checkpoint: str, each: Callable[[DataFrame, int], None] | None = None) -> None:
    """Processes what is there and stops; a rerun takes up where this one ended."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = writer.foreachBatch(each).start() if each else writer.format("parquet").outputMode("append").start(path)
    query.awaitTermination()
