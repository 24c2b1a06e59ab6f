"""A stream over tables that grow by files: the batch measures, kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def file_stream(spark: SparkSession, path: str, like: DataFrame, glob: str = "*.parquet") -> DataFrame:
    return spark.readStream.schema(like.schema).option("pathGlobFilter", glob).parquet(path)


def daily_counts(events: DataFrame, ts: str = "ts", kind: str = "event_type", value: str = "value", late: str = "1 day") -> DataFrame:
    """Events and their mean value by day and kind; rows later than `late` are left out once their day has closed."""
    timed = events.withColumn("_t", F.col(ts).cast("timestamp")).withWatermark("_t", late)
    g = timed.groupBy(F.window("_t", "1 day"), kind).agg(F.count("*").alias("n"), F.round(F.avg(value), 6).alias("mean"))
    return g.select(F.col("window.start").cast("date").alias("day"), kind, "n", "mean")


def run_available(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Everything there is now, appended to `path` as days close; a later run goes on from the checkpoint."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
