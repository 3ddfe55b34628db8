"""Session settings, table access and lineage cuts shared by every operator."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings the engine wants where the caller builds the session through `local_session`.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").config("spark.driver.memory", memory)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.config("spark.sql.shuffle.partitions", str(partitions)).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Give executors this package, unless their Python path has it already."""
    context = spark.sparkContext
    package = Path(__file__).parent
    root = str(package.parent)
    if getattr(context, "_respondo_shipped", False):
        return
    context._respondo_shipped = True
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or (context.master.startswith("local") and os.getcwd() == root):
        return
    archive = f"{tempfile.mkdtemp()}/respondo.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in package.rglob("*.py"):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(archive)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables of a data directory."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the session's `spark.checkpoint.dir`, or, where that is unset and
    everything runs on this machine, a temporary folder of our own. On a cluster without that setting there is no
    such folder, and a RuntimeError says so."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
    own = getattr(spark, "_respondo_shared", None)
    if own is None:
        folder = tempfile.mkdtemp(prefix="respondo-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        own = spark._respondo_shared = f"file://{folder}"
    return own


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write `df` as parquet into the shared folder and read it back: the lineage ends there, and a
    lost executor costs no recomputation of what came before."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Give Python-heavy operators a task per core where the input comes in fewer files than that.
    With as many input partitions as cores, which is always so at scale, nothing is shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
