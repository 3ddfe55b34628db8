"""Profiles of wide response tables: which columns hold keys, open answers, numbers, or nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import KEY_COLUMNS, NOT_ANSWERS, OPEN_SKIP_ROWS, STRING_RATIO
from ..functions.text import cleaned_number, null_tokens
from ..session import cut


def flat_names(levels: list[tuple[str, ...]]) -> list[str]:
    """Multi-level headers as one name each: parts joined by _, empty ones and "nan" left out."""
    return ["_".join(p.strip() for p in parts if p and p.strip() and p.strip().lower() != "nan") for parts in levels]


def clean_names(names: list[str]) -> list[str]:
    return [n.strip().replace("Unnamed: ", "") for n in names]


def key_column(names: list[str], wanted: list[str] = KEY_COLUMNS) -> str | None:
    """The first wanted key column that is there, whatever its case."""
    lower = {n.strip().lower(): n for n in reversed(names)}
    return next((lower[w.lower()] for w in wanted if w.lower() in lower), None)


def existing(df: DataFrame, requested: list[str]) -> list[str]:
    """The requested columns that are there, or all if none is."""
    return [c for c in requested if c in df.columns] or df.columns


def nulls_normalised(df: DataFrame) -> DataFrame:
    """Every text column with its null tokens as nulls."""
    return df.select(*[null_tokens(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema])


def with_key(df: DataFrame, key: str) -> DataFrame:
    """Rows that have a key, the key named respondent_key; rows of nothing but nulls are dropped first."""
    return df.dropna("all").dropna(subset=[key]).withColumnRenamed(key, "respondent_key")


def profile(df: DataFrame, skip: int = 0, order: str | None = None) -> DataFrame:
    """(ordinal, name, n_rows, n_values, n_numbers, null_ratio, number_ratio, string_ratio) of every column,
    in one pass. With `skip`, the first rows by `order` are left out. Ratios of an empty table are 0."""
    if skip and order:
        first = df.select(order).orderBy(order).limit(skip)  # a few rows
        df = df.join(F.broadcast(first), order, "left_anti")
    named = [(i, f.name, F.col(f"`{f.name}`").cast("string")) for i, f in enumerate(df.schema)]
    sums = [F.count("*").alias("n")]
    for i, _, c in named:
        sums += [F.count(c).alias(f"v{i}"), F.count(cleaned_number(c)).alias(f"d{i}")]
    one = df.agg(*sums)
    entries = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(name).alias("name"), F.col("n").alias("n_rows"), F.col(f"v{i}").alias("n_values"), F.col(f"d{i}").alias("n_numbers")) for i, name, _ in named])
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return one.select(F.inline(entries)).select(
        "*",
        F.round(ratio(F.col("n_rows") - F.col("n_values"), F.col("n_rows")), 6).alias("null_ratio"),
        F.round(ratio(F.col("n_numbers"), F.col("n_values")), 6).alias("number_ratio"),
        F.round(ratio(F.col("n_values") - F.col("n_numbers"), F.col("n_values")), 6).alias("string_ratio"),
    )


def open_columns(profiled: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Columns that are not wholly numbers and nulls."""
    return profiled.where((F.col("n_rows") > 0) & ((F.col("n_numbers") + F.col("n_rows") - F.col("n_values")) / F.col("n_rows") < threshold))


def text_columns(profiled: DataFrame, least: float = STRING_RATIO, denied: list[str] = NOT_ANSWERS) -> DataFrame:
    """Columns whose values are mostly no numbers, without the technical ones; empty columns are none."""
    return profiled.where((F.col("n_values") > 0) & (F.col("string_ratio") >= least) & ~F.col("name").isin(denied))


def left_neighbours(catalogue: DataFrame) -> DataFrame:
    """(ordinal, name, neighbour): the column to the left of each; the one before it if that is all null.
    The catalogue has a row a column, so one window over it is small."""
    w = Window.partitionBy(F.lit(1)).orderBy("ordinal")
    before, earlier = F.lag("name", 1).over(w), F.lag("name", 2).over(w)
    return catalogue.select("ordinal", "name", F.when(F.lag("n_values", 1).over(w) == 0, earlier).otherwise(before).alias("neighbour"))


def unpivoted(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys..., column, text): one row per cell."""
    return df.unpivot(keys, columns, "column", "text")


def ordinals(df: DataFrame, order: list[str], name: str = "id") -> DataFrame:
    """The 0-based position of each row in the given order, without moving all rows to one task: rows are
    ranged into partitions, numbered there and written, so that what is counted is what is numbered; then each
    row's number is its place in its partition and that partition's offset.

    Rows of equal order keys get neighbouring numbers in any order; nulls come first; an empty table stays empty."""
    placed = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    placed = cut(placed.withColumn("_place", F.monotonically_increasing_id()), "ordinals")
    part, place = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    counts = sorted((r["p"], r["n"]) for r in placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())  # a row a partition
    offsets, total = [], 0
    for p, n in counts:
        offsets.append((p, total))
        total += n
    starts = df.sparkSession.createDataFrame(offsets, "_part bigint, _start bigint")
    numbered = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return numbered.withColumn(name, F.col("_start") + place).drop("_part", "_start", "_place")
