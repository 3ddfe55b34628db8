"""Calls, tokens and cost; stages, runtimes and histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import call_cost


def once(calls: DataFrame, same: list[str], key: str) -> DataFrame:
    """Calls logged more than once kept once, under their smallest key."""
    return calls.groupBy(*same).agg(F.min(key).alias(key))


def priced(calls: DataFrame, prices: DataFrame) -> DataFrame:
    """Calls of known models with their cost by the price table. The table has a row a model and is broadcast."""
    joined = calls.join(F.broadcast(prices), calls["model_name"] == prices["name"])
    return joined.withColumn("priced_usd", call_cost(F.col("prompt_tokens"), F.col("completion_tokens"), F.col("input_per_1m"), F.col("output_per_1m")))


def unpriced(calls: DataFrame, prices: DataFrame) -> DataFrame:
    """Calls whose model has no price."""
    return calls.join(F.broadcast(prices), calls["model_name"] == prices["name"], "left_anti")


def summary(calls: DataFrame, by: list[str]) -> DataFrame:
    """Per group: calls, cost to six places, tokens, models in alphabetical order (unknown for none)."""
    return calls.groupBy(*by).agg(
        F.count("*").alias("total_calls"),
        F.round(F.coalesce(F.sum("cost_usd"), F.lit(0.0)), 6).alias("total_cost_usd"),
        F.coalesce(F.sum("prompt_tokens"), F.lit(0)).cast("bigint").alias("prompt_tokens"),
        F.coalesce(F.sum("completion_tokens"), F.lit(0)).cast("bigint").alias("completion_tokens"),
        F.coalesce(F.sum(F.coalesce("prompt_tokens", F.lit(0)) + F.coalesce("completion_tokens", F.lit(0))), F.lit(0)).cast("bigint").alias("total_tokens"),
        F.array_join(F.array_sort(F.collect_set(F.coalesce("model_name", F.lit("unknown")))), ", ").alias("models_used"),
    )


def running(df: DataFrame, within: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """A running total within each group."""
    w = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(value).over(w))


def stages(events: DataFrame, pipeline: str, ts: str, key: str) -> DataFrame:
    """Events of each pipeline as its stages: number, seconds since the start and since the stage before."""
    w = Window.partitionBy(pipeline).orderBy(ts, key)
    seconds = lambda a, b: (F.unix_micros(a) - F.unix_micros(b)) / 1e6
    t = F.col(ts).cast("timestamp")
    return (
        events.withColumn("stage_number", F.row_number().over(w))
        .withColumn("cumulative_seconds", seconds(t, F.first(t).over(w)))
        .withColumn("stage_seconds", F.coalesce(seconds(t, F.lag(t).over(w)), F.lit(0.0)))
    )


def history(staged: DataFrame, pipeline: str, cost: str) -> DataFrame:
    """Per pipeline: stages, the last cumulative runtime, total cost."""
    return staged.groupBy(pipeline).agg(
        F.count("*").alias("n_stages"), F.max_by("cumulative_seconds", "stage_number").alias("runtime_seconds"), F.round(F.sum(cost), 6).alias("total_cost")
    )


def progress(df: DataFrame, within: list[str], order: list[str], key: str) -> DataFrame:
    """Each row's position, the number of rows and the next key in its group."""
    w = Window.partitionBy(*within).orderBy(*order)
    return df.withColumn("position", F.row_number().over(w)).withColumn("total", F.count("*").over(Window.partitionBy(*within))).withColumn("next_key", F.lead(key).over(w))


def outcome(df: DataFrame, by: list[str], ok) -> DataFrame:
    """Per group: rows, successes, failures, success rate in per cent."""
    n = F.count("*")
    return df.groupBy(*by).agg(n.alias("total"), F.count_if(ok).alias("success"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("failed"), F.round(F.count_if(ok) / F.greatest(n, F.lit(1)) * 100, 6).alias("success_rate"))


def difference(old: DataFrame, new: DataFrame, key: str, watched: list[str]) -> DataFrame:
    """(key, change): rows that are new, changed or deleted between two states."""
    a = old.select(F.col(key), F.struct(*watched).alias("a"))
    b = new.select(F.col(key), F.struct(*watched).alias("b"))
    change = F.when(F.col("a").isNull(), "new").when(F.col("b").isNull(), "deleted").when(~F.col("a").eqNullSafe(F.col("b")), "changed")
    return a.join(b, key, "full").select(key, change.alias("change")).where("change is not null")
