"""Sources mixed to target shares of all tokens, by pivotal dependent rounding.

The size of the mixture is the largest at which no source would have to repeat a document more often than
its cap on average. Each document of a source then has the same expected number of copies; its whole part
is settled, its fraction is rounded dependently: two fractional documents trade expected tokens until one
of them is settled, at odds that keep both expectations. What a group of documents cannot settle is at most
one document; these residuals meet in groups of a reduction tree, level by level, until one is left per
source. So a source misses its share by less than one document's tokens, and every document's chance is
kept. All draws come from a keyed digest of the two documents' keys: the same table gives the same
mixture, on any cluster."""

from __future__ import annotations


import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .encode import count_tokens

#: Documents in a group of the first level, and groups that meet in one of the next.
GROUP = 20_000
FAN_IN = 64
_SETTLED = 1e-9


def pivot(keys: list, tokens: list[float], parts: list[float], seed: str) -> list[float]:
    """The fractional parts after pivotal rounding in the order given: all 0 or 1 but at most one.

    A trade moves tokens from one document to the other; their sum over both is kept."""
    out = list(parts)
    open_at = -1
    for i, p in enumerate(out):
        if p <= _SETTLED or p >= 1 - _SETTLED:
            out[i] = float(round(p))
            continue
        if open_at < 0:
            open_at = i
            continue
        j = open_at
        a, b = out[j] * tokens[j], out[i] * tokens[i]  # expected tokens
        up = min(tokens[j] - a, b)  # most that can move from i to j
        down = min(a, tokens[i] - b)  # most that can move from j to i
        draw = xxhash.xxh3_64_intdigest(f"{seed}|{keys[j]}|{keys[i]}") / 2**64
        move = up if draw < down / (up + down) else -down
        for k, value in ((j, a + move), (i, b - move)):
            share = value / tokens[k]
            out[k] = 0.0 if share <= _SETTLED else 1.0 if share >= 1 - _SETTLED else share
        open_at = next((k for k in (i, j) if 0.0 < out[k] < 1.0), -1)
    return out


def sizes_and_targets(sized: DataFrame, targets: DataFrame) -> list[dict]:
    """Per target source: its tokens, share, cap and expected copies a document. One row per target."""
    per_source = sized.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    wanted = targets.where("target_share > 0 and source is not null").groupBy("source").agg(F.sum("target_share").alias("share"), F.max("max_repeats").alias("cap"))
    rows = [r.asDict() for r in wanted.join(per_source, "source", "left").collect()]
    whole = sum(r["share"] for r in rows) or 1.0
    for r in rows:
        r["share"] /= whole
        r["tokens"] = int(r["tokens"] or 0)
        r["cap"] = max(1, int(r["cap"] or 1))
    # a source without tokens can contribute nothing; the others keep their proportions
    able = [r for r in rows if r["tokens"] > 0]
    able_share = sum(r["share"] for r in able)
    size = min((r["cap"] * r["tokens"] * able_share / r["share"] for r in able), default=0.0)
    for r in rows:
        r["copies"] = min(r["cap"], size * r["share"] / able_share / r["tokens"]) if r["tokens"] else 0.0
    return rows


def mix(documents: DataFrame, targets: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", seed: str = "mixture", group: int = GROUP) -> DataFrame:
    """(key, source, n_tokens, copies): the documents of the mixture, each with how often it is used.

    Documents with null, empty or token-less text, without a key or of a source without a target are in no
    mixture. Repeated keys are rounded on their own. An empty table or no usable target gives no rows."""
    spark = documents.sparkSession
    known = documents.select(F.col(key).alias("key"), F.col(source).alias("source"), F.col(text).alias("text")).where("key is not null and source is not null")
    sized = cut(count_tokens(known, ["key", "source"]).where("n_tokens > 0"), "mixture-sizes")
    rows = sizes_and_targets(sized, targets)
    empty = spark.createDataFrame([], f"{key} {documents.schema[key].dataType.simpleString()}, {source} string, n_tokens bigint, copies bigint")
    if not any(r["copies"] > 0 for r in rows):
        return empty
    rates = F.broadcast(spark.createDataFrame([(r["source"], float(r["copies"]), int(r["cap"])) for r in rows], "source string, rate double, cap int"))
    total = sized.count()
    leaves = max(1, -(-total // group))
    placed = sized.join(rates, "source").select(
        "key", "source", "n_tokens", "cap",
        F.floor("rate").cast("bigint").alias("sure"),
        (F.col("rate") - F.floor("rate")).alias("part"),
        F.pmod(F.xxhash64(F.col("key"), F.lit(seed)), F.lit(leaves)).cast("long").alias("node"),
    )
    schema = placed.schema

    def settle(level: int):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["key", "n_tokens"], kind="stable")
            parts = pivot(pdf["key"].tolist(), pdf["n_tokens"].tolist(), pdf["part"].tolist(), f"{seed}|{level}")
            return pdf.assign(part=parts)

        return run

    level, done = 0, []
    while True:
        settled = cut(placed.groupBy("source", "node").applyInPandas(settle(level), schema), "mixture-level")
        is_open = F.col("part").between(_SETTLED, 1 - _SETTLED)
        done.append(settled.where(~is_open))
        rest = settled.where(is_open)  # at most one row a source and node
        if leaves == 1:
            draw = F.pmod(F.xxhash64(F.col("key"), F.lit(f"{seed}|last")), F.lit(1_000_000)) / 1_000_000.0
            done.append(rest.withColumn("part", (draw < F.col("part")).cast("double")))
            break
        leaves = -(-leaves // FAN_IN)
        placed = rest.withColumn("node", F.pmod(F.col("node"), F.lit(leaves)))
        level += 1
    whole = done[0]
    for other in done[1:]:
        whole = whole.unionByName(other)
    copies = F.least(F.col("sure") + F.round("part").cast("bigint"), F.col("cap").cast("bigint"))
    return whole.select(F.col("key").alias(key), F.col("source").alias(source), "n_tokens", copies.alias("copies")).where("copies > 0")


def shares(mixture: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, max_repeats, n_docs, n_copies, n_tokens, actual_share, most_copies) of a
    mixture: one row per target, with zeros where nothing was taken."""
    got = mixture.groupBy("source").agg(
        F.count("*").alias("n_docs"), F.sum("copies").alias("n_copies"), F.sum(F.col("copies") * F.col("n_tokens")).alias("n_tokens"), F.max("copies").alias("most_copies")
    )
    total = got.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).collect()[0][0]  # one number
    return targets.join(got, "source", "left").select(
        "source", "target_share", "max_repeats",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_docs", "n_copies", "n_tokens")],
        F.round(F.coalesce(F.col("n_tokens") / F.lit(float(max(1, total))), F.lit(0.0)), 6).alias("actual_share"),
        F.coalesce("most_copies", F.lit(0)).alias("most_copies"),
    )
