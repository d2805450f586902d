"""Structured Streaming over arriving files. The source of the other operators has no streams; these are extensions.

A stream of Parquet files is read with a fixed schema. Windows are closed by a watermark, and each batch lands under its
own number, so that a batch that runs twice after a failure writes the same files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

EVENTS = StructType([StructField("event_id", LongType()), StructField("ts", TimestampNTZType()), StructField("user_id", LongType()), StructField("event_type", StringType()), StructField("value", DoubleType()), StructField("props", StringType())])


def event_stream(spark: SparkSession, folder: str, files_a_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_a_batch).parquet(folder)


def _timed(events: DataFrame, late: str) -> DataFrame:
    zoned = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return zoned.withWatermark("ts", late) if events.isStreaming else zoned


def hourly(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Events and their value by hour and type; works on a stream and on a table. Stream rows later than `late` are left
    out once their hour is closed."""
    timed = _timed(events, late)
    counted = timed.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("events"), F.sum(F.floor(F.col("value") * 100).cast("long")).alias("cents"))
    return counted.select(F.col("w.start").alias("hour"), "event_type", "events", "cents")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    timed = _timed(events, late)
    counted = timed.groupBy(F.session_window("ts", gap).alias("s"), "user_id").agg(F.count(F.lit(1)).alias("events"))
    return counted.select("user_id", F.col("s.start").alias("started"), "events")


def land(stream: DataFrame, folder: str, checkpoint: str):
    """Appends closed windows to folder until all files that are there now are read."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return stream.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
