"""Structured Streaming over event tables (an extension; the batch forms are what the registry queries)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, folder: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str | None = "10 minutes") -> DataFrame:
    """(window_start, event_type, n): tumbling counts; on a stream, state older than the watermark is dropped."""
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    events = events.withWatermark("ts", late) if late and events.isStreaming else events
    g = events.groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("window.start").alias("window_start"), "event_type", "n")


def registry_sink(stream: DataFrame, target: str, checkpoint: str, keys: list[str]):
    """Keeps the newest row of each key in a Parquet table, one batch at a time; each batch is a new version, named last in `latest`."""
    from inkstrata.operators.assemble import upsert

    def put(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        try:
            old = spark.read.parquet(f"{target}/v{epoch - 1}")
        except Exception as e:  # the first batch has no older version
            if "PATH_NOT_FOUND" not in str(e):
                raise
            old = batch.limit(0)
        upsert(old, batch, keys).write.mode("overwrite").parquet(f"{target}/v{epoch}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
