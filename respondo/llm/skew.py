"""Joins that survive a key which holds a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if it holds more than this part of all rows; so there are fewer than this many hot keys.
HOT_PART = 1000
#: Rows that are looked at for hot keys, at every size; a key of one in `HOT_PART` of all is among them about a hundred times.
LOOKED_AT = 100_000


def hot_keys(rows: DataFrame, keys: list[str], total: int) -> DataFrame:
    """The keys that hold more than about one in `HOT_PART` of all rows, fewer than twice `HOT_PART` of them, with their
    number among the rows looked at, which are drawn at random; the join is right whichever keys come out."""
    part = min(1.0, LOOKED_AT / max(1, total))
    some = rows if part == 1.0 else rows.where(F.rand(7) < part)
    return some.groupBy(*keys).count().where(F.col("count") > max(1.0, total * part / (2 * HOT_PART)))


def join_unique(rows: DataFrame, lookup: DataFrame, keys: list[str], size: str | None = None, total: int | None = None) -> DataFrame:
    """Inner join of `rows` with a `lookup` whose keys are unique. Hot keys, those that hold more than one in `HOT_PART`
    of all rows, go through a broadcast of their lookup rows (fewer than twice `HOT_PART`), the others through a shuffle. `size` names a lookup
    column with the number of rows of its key; without it `LOOKED_AT` rows at most are counted per key. `total` is the
    number of rows, where it is known. Tables of any size are treated alike."""
    total = rows.count() if total is None else total
    if size is None:
        names = [tuple(r)[: len(keys)] for r in hot_keys(rows, keys, total).collect()]  # fewer than twice HOT_PART
        if not names:
            return rows.join(lookup, keys)
        hot_rows = F.broadcast(rows.sparkSession.createDataFrame(names, rows.select(*keys).schema))
        hot, cold = lookup.join(hot_rows, keys, "left_semi"), lookup.join(hot_rows, keys, "left_anti")
    else:
        limit = total // HOT_PART
        hot, cold = lookup.where(F.col(size) > limit), lookup.where(F.col(size) <= limit)
    return rows.join(F.broadcast(hot), keys).unionByName(rows.join(cold, keys))
