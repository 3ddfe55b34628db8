"""Records that are the same but for formatting, by bottom-up hashing of their structure.

A record is a tree: a root over its fields; the answer field is an ordered leaf or, where it is a list
of labelled fields, an unordered node of (label, value) nodes. Leaves are normalised - white space,
punctuation, symbols and letter case go - and digested; an unordered node sorts the digests of its
children; the root digest covers all fields in order. Records are grouped by root digest and by the
normalised structure itself, so that a collision of digests can never join two records.

Everything is built from Spark expressions. A group of copies may hold any share of the rows: groups are
made by partial aggregation, and copies of hot groups find their first record through a broadcast whose
size is bounded by the definition of hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

#: What formatting may change: white space, punctuation, symbols, controls and invisible characters.
DROPPED = r"(?U)[\s\p{P}\p{S}\p{Z}\p{C}]+"
#: Between labelled fields, and between a label and its value.
BETWEEN = r"[;；|｜、，,/／\n\r]+"
INSIDE = r"\s*[:：=＝]\s*|\s+[-–—]\s+"
#: A list item's sign at the start of a line.
BULLET = r"^[\s*•·\-–]+"
#: A group is hot if it holds more than this part of all rows; so there are at most as many hot groups.
HOT_PART = 1000


def leaf(text: Column) -> Column:
    """The normalised form of a leaf: without what formatting may change, case folded (ß equals SS, both
    small sigmas are one)."""
    folded = F.lower(F.upper(F.regexp_replace(text, DROPPED, "")))
    return F.replace(F.replace(F.translate(folded, "ς", "σ"), F.lit("ß"), F.lit("ss")), F.lit("ẞ"), F.lit("ss"))


def labelled_fields(text: Column) -> Column:
    """The labelled fields of a text as sorted normalised (label, value) structs; an empty array if the
    text is not, in every part, a labelled field, or has only one part."""
    parts = F.filter(F.split(F.regexp_replace(text, BULLET, ""), BETWEEN), lambda p: leaf(p) != "")
    pairs = F.transform(parts, lambda p: F.split(p, INSIDE, 2))
    whole = (F.size(pairs) >= 2) & F.forall(pairs, lambda p: (F.size(p) == 2) & (leaf(p[0]) != "") & (leaf(F.get(p, F.lit(1))) != ""))
    fields = F.transform(pairs, lambda p: F.struct(leaf(p[0]).alias("label"), leaf(F.get(p, F.lit(1))).alias("value")))
    return F.when(whole, F.array_sort(fields)).otherwise(F.array().cast("array<struct<label:string,value:string>>"))


def _digest(text: Column) -> Column:
    return F.md5(F.encode(text, "UTF-8"))


def structure(df: DataFrame, key: str, fields: list[str], answer: str) -> DataFrame:
    """(key, root, form): the root digest and the normalised structure of every record with an answer.

    `fields` are plain leaves; a null leaf equals only a null leaf. Rows whose answer is null or blank are
    no records; an answer of nothing but punctuation is its own leaf, without white space."""
    rows = df.where(F.regexp_replace(F.col(answer), r"(?U)\s+", "") != "").select(
        F.col(key).alias("key"),
        *[F.coalesce(leaf(F.col(f).cast("string")), F.lit("\u0000")).alias(f"leaf{i}") for i, f in enumerate(fields)],
        labelled_fields(F.col(answer)).alias("parts"),
        leaf(F.col(answer)).alias("plain"),
        F.regexp_replace(F.col(answer), r"(?U)\s+", "").alias("signs"),
    )
    plain = F.when(F.col("plain") == "", F.col("signs")).otherwise(F.col("plain"))
    node = F.when(
        F.size("parts") > 0,
        # children are digested one by one, then sorted: their order in the text plays no part
        F.concat(F.lit("u"), F.concat_ws("", F.array_sort(F.transform("parts", lambda p: _digest(F.concat(_digest(p["label"]), _digest(p["value"]))))))),
    ).otherwise(F.concat(F.lit("o"), _digest(plain)))
    leaves = [F.col(f"leaf{i}") for i in range(len(fields))]
    root = _digest(F.concat(*[_digest(x) for x in leaves], _digest(node)))
    content = F.when(F.size("parts") > 0, F.concat_ws("\u0002", F.transform("parts", lambda p: F.concat(p["label"], F.lit("\u0003"), p["value"])))).otherwise(F.concat(F.lit("\u0004"), plain))
    return rows.select("key", F.unhex(root).alias("root"), F.concat_ws("\u0001", *leaves, content).alias("form"))


def groups(records: DataFrame) -> DataFrame:
    """(root, form, first_key, copies): one row per distinct record."""
    return records.groupBy("root", "form").agg(F.min("key").alias("first_key"), F.count("*").alias("copies"))


def copies(df: DataFrame, key: str, fields: list[str], answer: str) -> DataFrame:
    """(first_id, copy_id): every record that repeats an earlier one in another or the same format.

    first_id is the smallest key of the copies, copy_id each other one, in no order. Ties cannot be: keys
    are unique; a repeated key counts as one record. Null keys, blank and null answers take no part."""
    records = cut(structure(df.where(F.col(key).isNotNull()), key, fields, answer), "merkle")
    found = cut(groups(records).where("copies > 1"), "merkle-groups")
    total = records.count()
    hot_size = max(1000, total // HOT_PART)
    hot = found.where(F.col("copies") > hot_size).select("root", "form", "first_key")  # fewer than HOT_PART rows
    cold = found.where(F.col("copies") <= hot_size).select("root", "form", "first_key")
    from_hot = records.join(F.broadcast(hot), ["root", "form"])
    from_cold = records.join(cold, ["root", "form"])
    pairs = from_hot.select("first_key", "key").unionByName(from_cold.select("first_key", "key"))
    return pairs.where(F.col("key") != F.col("first_key")).select(F.col("first_key").alias("first_id"), F.col("key").alias("copy_id"))


def collapsed(df: DataFrame, key: str, fields: list[str], answer: str) -> DataFrame:
    """(first_id, copies): one row per distinct record, with the number of rows that are copies of it."""
    records = structure(df.where(F.col(key).isNotNull()), key, fields, answer)
    return groups(records).select(F.col("first_key").alias("first_id"), "copies")
