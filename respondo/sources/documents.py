"""Questionnaire documents: text, PDF, DOCX; each one row with type, path, text and size."""

from __future__ import annotations

import io
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..providers import UnsupportedFileError

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def docx_text(data: bytes) -> str:
    """The paragraphs of a DOCX body, tables left out, joined by line ends."""
    with zipfile.ZipFile(io.BytesIO(data)) as archive:
        body = ET.fromstring(archive.read("word/document.xml")).find(f"{_W}body")
    return "\n".join("".join(t.text or "" for t in p.iter(f"{_W}t")) for p in (body if body is not None else []) if p.tag == f"{_W}p")


def _shaped(df: DataFrame, kind: str) -> DataFrame:
    return df.select(F.lit(kind).alias("type"), F.col("path"), F.col("text"), F.struct(F.col("size").cast("bigint").alias("size_bytes")).alias("meta"))


def read_text(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "^\ufeff", "").alias("text"), F.col("_metadata.file_size").alias("size"))
    return _shaped(df, "txt")


def read_pdf(spark: SparkSession, path: str) -> DataFrame:
    """PDF as base64; its text is the provider's business."""
    df = spark.read.format("binaryFile").load(path).select("path", F.base64("content").alias("text"), F.col("length").alias("size"))
    return _shaped(df, "pdf")


def read_docx(spark: SparkSession, path: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"path": pdf["path"], "text": [docx_text(c) for c in pdf["content"]], "size": pdf["length"]})

    df = spark.read.format("binaryFile").load(path).select("path", "content", "length").mapInPandas(run, "path string, text string, size bigint")
    return _shaped(df, "docx")


READERS = {"txt": read_text, "pdf": read_pdf, "docx": read_docx}


def read_survey(spark: SparkSession, path: str) -> DataFrame:
    """A questionnaire by its extension, whatever its case."""
    kind = path.rsplit(".", 1)[-1].lower() if "." in path.rsplit("/", 1)[-1] else ""
    if kind not in READERS:
        raise UnsupportedFileError(f"no reader for {path}")
    return READERS[kind](spark, path)
