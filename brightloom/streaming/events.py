"""Streaming jobs over event files. Each has a batch twin with the same result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from brightloom.operators.outliers import OutlierRule, apply_outliers
from brightloom.operators.quality import quality_score
from brightloom.staging import stage_path

LATENESS = "10 minutes"


def event_stream(
    spark: SparkSession, folder: str, pattern: str = "events.parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Stream of the event files of a folder. ``ts`` becomes an instant, which watermarks need."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(stream: DataFrame, width: str = "15 minutes", lateness: str = LATENESS) -> DataFrame:
    """Counts and sums per closed window and event type; rows later than the watermark are dropped."""
    return (
        stream.withWatermark("ts", lateness)
        .groupBy(F.window("ts", width), "event_type")
        .agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("sum_value"))
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("window_start"),
            F.col("window.end").cast("timestamp_ntz").alias("window_end"), "event_type", "n_events", "sum_value",
        )
    )


def dedup(stream: DataFrame, lateness: str = LATENESS, keys: Sequence[str] = ("event_id",)) -> DataFrame:
    """First row of each key; state older than the watermark is let go."""
    return stream.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(list(keys))


def live_outliers(stream: DataFrame, rules: Sequence[OutlierRule]) -> DataFrame:
    """Outlier flags from rules fitted in batch. No state."""
    return apply_outliers(stream, rules)


def run_to_files(stream: DataFrame, label: str) -> DataFrame:
    """Process what is there, append to files, and return a scan of them."""
    spark = stream.sparkSession
    out = stage_path(spark, f"{label}-out")
    query = (
        stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
        .option("checkpointLocation", stage_path(spark, f"{label}-log")).option("path", out).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def run_quality(stream: DataFrame, label: str = "quality") -> DataFrame:
    """Per micro-batch: rows, completeness, scores and the newest event time, as a table."""
    spark = stream.sparkSession
    out = stage_path(spark, f"{label}-out")

    def judge(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        newest = held.agg(F.max("ts").alias("newest"), F.lit(1).alias("_k"))
        score = quality_score(held).withColumn("_k", F.lit(1))
        row = score.join(newest, "_k").drop("_k").withColumn("batch_id", F.lit(batch_id).cast("long"))
        # one folder per batch: a replayed batch overwrites its own result
        row.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        held.unpersist()

    query: StreamingQuery = (
        stream.writeStream.foreachBatch(judge).trigger(availableNow=True)
        .option("checkpointLocation", stage_path(spark, f"{label}-log")).start()
    )
    query.awaitTermination()
    return spark.read.parquet(out).drop("batch")
