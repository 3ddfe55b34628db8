"""What a run leaves behind."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_results(df: DataFrame, path: str, question: str = "qid") -> None:
    """Stage results, one folder per question."""
    df.write.mode("overwrite").partitionBy(question).parquet(path)


def csv_view(df: DataFrame) -> DataFrame:
    """Nested columns as JSON texts, which CSV can hold."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`") for f in df.schema])


def write_csv(df: DataFrame, path: str) -> None:
    csv_view(df).write.mode("overwrite").csv(path, header=True, escape='"')


def save_state(df: DataFrame, path: str) -> None:
    """The latest state, overwritten."""
    df.write.mode("overwrite").json(path)


def append_history(df: DataFrame, path: str, stage: str) -> None:
    """A dated copy of the state, appended."""
    df.withColumn("stage", F.lit(stage)).withColumn("saved_at", F.current_timestamp()).write.mode("append").parquet(path)


def debug_rows(df: DataFrame) -> DataFrame:
    """Every row as one JSON text."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))
