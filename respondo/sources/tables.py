"""Tables and states on disk: profiles, samples, stage results, run states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import parse_vector
from ..operators.columns import existing


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with header and multi-line texts; a byte order mark is dropped by Spark."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"')


def header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.csv(path, header=True).columns


def info(df: DataFrame, rows: int = 3) -> dict:
    """Columns, types and a small sample; rows are not counted."""
    return {"columns": df.columns, "types": dict(df.dtypes), "sample": [r.asDict() for r in df.limit(rows).collect()]}


def sample(df: DataFrame, rows: int = 3, columns: list[str] | None = None) -> DataFrame:
    return df.select(*existing(df, columns or [])).limit(rows)


def read_state(spark: SparkSession, path: str) -> DataFrame | None:
    """A JSON state, None if it is not there."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return None
    return spark.read.json(path, multiLine=True)


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """CSV, JSON, parquet or text by suffix."""
    kind = path.rsplit(".", 1)[-1].lower()
    if kind == "csv":
        return read_csv(spark, path)
    if kind == "json":
        return spark.read.json(path, multiLine=True)
    return spark.read.parquet(path) if kind == "parquet" else spark.read.text(path, wholetext=True)


def read_stage_results(spark: SparkSession, path: str) -> DataFrame:
    """(qid, column, text, emb): long rows from a folder of per-question CSVs with text_k and embed_text_k
    columns; the question is the column question_id, else the number in the file's name."""
    df = spark.read.csv(path, header=True, multiLine=True, recursiveFileLookup=True, pathGlobFilter="*.csv", escape='"')
    numbered = F.regexp_extract(F.col("_metadata.file_path"), r"문(\d+)", 1)
    given = F.col("question_id") if "question_id" in df.columns else F.lit(None).cast("string")
    pairs = [c for c in df.columns if c.startswith("text_") and f"embed_{c}" in df.columns]
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("text"), F.col(f"embed_{c}").alias("raw")) for c in pairs])
    long = df.select(F.coalesce(given, F.nullif(numbered, F.lit(""))).alias("qid"), F.explode(cells).alias("c"))
    return long.select("qid", "c.column", "c.text", parse_vector(F.col("c.raw")).alias("emb")).where("text is not null and emb is not null")


def listing(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(path, length, modified) of the files that match, by path."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modified")).orderBy("path")
