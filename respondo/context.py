"""The run itself: settings, folders, stage history, state checks."""

from __future__ import annotations

import os
import shutil
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STAGES = "pipeline string, stage_name string, stage_number int, status string, started timestamp_ntz, completed timestamp_ntz, calls bigint, cost_usd double, tokens bigint"


@dataclass
class RunContext:
    """One run of a project: where its files live and what it has done. Stays on the driver."""

    project: str
    root: str
    pipeline: str = field(default_factory=lambda: datetime.now().strftime("%Y%m%d_%H%M%S_%f")[:-3])
    settings: dict = field(default_factory=lambda: {k[9:].lower(): v for k, v in os.environ.items() if k.startswith("RESPONDO_")})
    stages: list[dict] = field(default_factory=list)

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), self.project, *parts])

    def create(self, raw_files: list[str] = ()) -> None:
        """Folders raw, results, state, temp, with copies of the given files in raw."""
        for name in ("raw", "results", "state", "temp"):
            Path(self.path(name)).mkdir(parents=True, exist_ok=True)
        for file in raw_files:
            shutil.copy2(file, self.path("raw"))

    def clear_temp(self) -> None:
        shutil.rmtree(self.path("temp"), ignore_errors=True)
        Path(self.path("temp")).mkdir(parents=True)

    def result_path(self, question: str, kind: str, at: datetime) -> str:
        return self.path("results", f"stage2_{question}_{kind}_{at:%Y%m%d_%H%M%S}")

    def add_stage(self, name: str, status: str, started: datetime, calls: int = 0, cost_usd: float = 0.0, tokens: int = 0) -> None:
        self.stages.append(
            {"pipeline": self.pipeline, "stage_name": name, "stage_number": len(self.stages) + 1, "status": status, "started": started, "completed": datetime.now(), "calls": calls, "cost_usd": cost_usd, "tokens": tokens}
        )

    def history(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([tuple(s.values()) for s in self.stages], STAGES)

    def save_history(self, spark: SparkSession) -> str:
        """Append what the stages did to the project's history table and name its place; earlier runs stay."""
        place = self.path("history")
        self.history(spark).write.mode("append").parquet(place)
        return place

    @staticmethod
    def registry(spark: SparkSession, root: str, project: str) -> DataFrame:
        """(pipeline, n_stages, first_started, last_completed, cost_usd, failed): every run in a project's history."""
        found = spark.read.schema(STAGES).parquet("/".join([root.rstrip("/"), project, "history"]))
        return found.groupBy("pipeline").agg(
            F.count("*").alias("n_stages"), F.min("started").alias("first_started"), F.max("completed").alias("last_completed"),
            F.round(F.sum("cost_usd"), 6).alias("cost_usd"), F.count_if(F.col("status") != "completed").alias("failed"),
        )

    def report(self, spark: SparkSession) -> DataFrame:
        """(pipeline, n_stages, runtime_seconds, calls, cost_usd, tokens, failed)."""
        seconds = F.unix_micros(F.col("completed").cast("timestamp")) - F.unix_micros(F.col("started").cast("timestamp"))
        return self.history(spark).groupBy("pipeline").agg(
            F.count("*").alias("n_stages"), F.round(F.sum(seconds) / 1e6, 3).alias("runtime_seconds"), F.sum("calls").alias("calls"),
            F.round(F.sum("cost_usd"), 6).alias("cost_usd"), F.sum("tokens").alias("tokens"), F.count_if(F.col("status") != "completed").alias("failed"),
        )


def missing_fields(columns: list[str]) -> Column:
    """The names of the columns that are null."""
    return F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]), lambda n: n.isNotNull())


def filled_fields(columns: list[str]) -> Column:
    return reduce(lambda a, c: a + F.col(c).isNotNull().cast("int"), columns, F.lit(0))


def size_mb(columns: list[str]) -> Column:
    """About how much a row's state takes, as JSON."""
    return F.length(F.to_json(F.struct(*columns))) / 1048576


def released(df: DataFrame, finished: list[str]) -> DataFrame:
    """The rows with finished fields set to null, for the stages that follow."""
    return df.unpersist().select(*[F.lit(None).cast(df.schema[c].dataType).alias(c) if c in finished else F.col(c) for c in df.columns])
