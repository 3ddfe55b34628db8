"""Calls as a stream: late rows within a watermark, cost and tokens per model and hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_calls(spark: SparkSession, folder: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def windowed(calls: DataFrame, late: str = "7 days", window: str = "1 hour") -> DataFrame:
    """(start, model_name, calls, tokens, cost_usd) per window; rows later than `late` are dropped. Works on
    streams and on tables alike."""
    timed = calls.withColumn("at", F.col("called_at").cast("timestamp")).withWatermark("at", late)
    return timed.groupBy(F.window("at", window), F.coalesce("model_name", F.lit("unknown")).alias("model_name")).agg(
        F.count("*").alias("calls"), F.sum(F.coalesce("prompt_tokens", F.lit(0)) + F.coalesce("completion_tokens", F.lit(0))).cast("bigint").alias("tokens"), F.round(F.sum("cost_usd"), 6).alias("cost_usd")
    ).select(F.col("window.start").alias("start"), "model_name", "calls", "tokens", "cost_usd")


def deduplicated(calls: DataFrame, late: str = "7 days") -> DataFrame:
    """Calls logged more than once kept once within the watermark."""
    timed = calls.withColumn("at", F.col("called_at").cast("timestamp")).withWatermark("at", late)
    return timed.dropDuplicatesWithinWatermark(["record_id", "model_name", "prompt_tokens", "completion_tokens", "latency_ms", "called_at"])
