"""Reports over tables of run metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from brightloom.operators.ordered import row_index, spread_chunks, with_halo

MANUAL_HOURS = 5.0  # fixed values: hours per dashboard by hand and automated
AUTOMATED_HOURS = 0.5


def extraction_report(metrics: DataFrame) -> DataFrame:
    """Totals over (source, records, size_mb, seconds, quality)."""
    return metrics.agg(
        F.count(F.lit(1)).alias("total_sources"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("total_records"),
        F.sum("size_mb").alias("total_size_mb"),
        F.avg("quality").alias("average_quality_score"),
        F.sum("seconds").alias("total_extraction_time"),
    )


def extraction_details(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        "source", "records", F.round("size_mb", 2).alias("size_mb"), F.round("seconds", 2).alias("time_seconds"),
        F.round("quality", 3).alias("quality_score"),
    )


def transform_report(metrics: DataFrame) -> DataFrame:
    """Totals over (operation, input_records, output_records, seconds, features_created, improvement)."""
    speed = F.coalesce(F.try_divide(F.sum("input_records"), F.sum("seconds")), F.lit(0.0))
    return metrics.agg(
        F.count(F.lit(1)).alias("total_operations"),
        F.sum("input_records").alias("total_input_records"),
        F.sum("output_records").alias("total_output_records"),
        F.sum("seconds").alias("total_processing_time"),
        F.sum("features_created").alias("total_features_created"),
        F.round(speed, 0).alias("average_processing_speed"),
        F.round(F.avg("improvement"), 3).alias("data_quality_improvement"),
    )


def features_created(before: DataFrame, after: DataFrame) -> int:
    return len(after.columns) - len(before.columns)


def publish_report(results: DataFrame) -> DataFrame:
    """Over (platform, dashboards, error): platforms without error, dashboards, hours saved, improvement %."""
    fine = F.col("error").isNull()
    made = F.coalesce(F.sum(F.when(fine, F.col("dashboards"))), F.lit(0)).cast("long")
    saved = F.col("dashboards_created") * F.lit(MANUAL_HOURS - AUTOMATED_HOURS)
    gain = F.try_divide(saved, F.lit(MANUAL_HOURS) * F.col("dashboards_created")) * 100
    return results.agg(F.count_if(fine).alias("platforms_used"), made.alias("dashboards_created")).select(
        "platforms_used", "dashboards_created", saved.alias("time_saved_hours"),
        F.when(F.col("dashboards_created") > 0, F.concat(F.format_number(gain, 1), F.lit("%"))).otherwise("0%").alias("productivity_improvement"),
    )


def workflow_report(stages: DataFrame) -> DataFrame:
    """Per run over (run_id, stage, status, seconds): enabled, completed, success rate, duration, errors."""
    return stages.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("stages_enabled"),
        F.count_if(F.col("status") == "completed").alias("stages_completed"),
        F.try_divide(F.count_if(F.col("status") == "completed"), F.count(F.lit(1))).alias("success_rate"),
        F.sum("seconds").alias("duration_seconds"),
        F.count_if(F.col("status") == "failed").alias("error_count"),
    )


def metric_summary(samples: DataFrame) -> DataFrame:
    return samples.agg(
        F.avg("cpu_percent").alias("avg_cpu_percent"), F.max("cpu_percent").alias("max_cpu_percent"),
        F.avg("memory_used_mb").alias("avg_memory_mb"), F.max("memory_used_mb").alias("peak_memory_mb"),
        F.count(F.lit(1)).alias("total_monitoring_points"),
    )


def health(samples: DataFrame, cpu: float = 80, memory: float = 85, disk: float = 90) -> DataFrame:
    """Add cpu, memory, disk and overall health as 0/1."""
    checks = {
        "cpu_healthy": F.col("cpu_percent") < cpu,
        "memory_healthy": F.col("memory_percent") < memory,
        "disk_healthy": F.col("disk_percent") < disk,
    }
    every = checks["cpu_healthy"] & checks["memory_healthy"] & checks["disk_healthy"]
    return samples.withColumns({n: c.cast("int") for n, c in {**checks, "overall_healthy": every}.items()})


def performance_alert(runs: DataFrame, job: str, order_by: list[str], seconds: str, trailing: int = 20, ratio: float = 2.0) -> DataFrame:
    """Add the mean of a job's previous ``trailing`` runs, the ratio to it and ``slow`` (ratio above the limit)."""
    chunked = spread_chunks(with_halo(row_index(runs, order_by, [job]).drop("_part"), trailing))
    before = W.partitionBy("_chunk", job).orderBy("_rn").rowsBetween(-trailing, -1)
    normal = chunked.withColumn("normal_seconds", F.avg(seconds).over(before)).filter("_own")
    times = F.try_divide(F.col(seconds), F.col("normal_seconds"))
    return normal.select(
        *runs.columns, "normal_seconds", times.alias("ratio"), F.coalesce((times > ratio).cast("int"), F.lit(0)).alias("slow")
    )
