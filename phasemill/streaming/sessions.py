"""Sessions of events from a stream: the streaming form of islands parted by gaps. Beyond the batch engine's own operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phasemill.session import scratch

EVENT_STREAM = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def read_events(spark: SparkSession, path: str, pattern: str | None = None, files_per_trigger: int | None = None) -> DataFrame:
    """A stream of event files. The watermark needs a zoned timestamp, so ``ts`` is cast (session zone)."""
    reader = spark.readStream.schema(EVENT_STREAM)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def sessions(events: DataFrame, gap: str = "6 hours", late: str = "1 day") -> DataFrame:
    """Per user the stretches without a pause of ``gap``: ``user_id, from_ts, last_gap_end, n, total``; rows later than ``late`` are dropped by the watermark."""
    windowed = events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("w"))
    return windowed.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select("user_id", F.col("w.start").alias("from_ts"), F.col("w.end").alias("until_ts"), "n", "total")


def run_available(stream: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Process what is there, then stop: each batch replaces (complete) or extends (append) a table in the shared folder."""
    spark = stream.sparkSession
    root = scratch(spark, name)

    def sink(batch: DataFrame, epoch: int) -> None:
        # one folder per epoch: a batch that is run again replaces its own
        batch.write.mode("overwrite").parquet(f"{root}/out" if mode == "complete" else f"{root}/out/epoch={epoch}")

    q = stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    out = spark.read.schema(stream.schema).parquet(f"{root}/out")
    return out
