"""Agreement of two labelings, sizes of clusters, scores and grades."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import ARI_WEIGHT, NMI_WEIGHT
from ..functions.numbers import grade


def contingency(df: DataFrame, by: list[str], truth: str, found: str) -> DataFrame:
    """(by..., t, p, n): rows per pair of labels. -1 is no label in either; such rows are left out."""
    valid = df.where((F.coalesce(F.col(truth).cast("string"), F.lit("-1")) != "-1") & (F.coalesce(F.col(found).cast("string"), F.lit("-1")) != "-1"))
    return valid.groupBy(*by, F.col(truth).cast("string").alias("t"), F.col(found).cast("string").alias("p")).agg(F.count("*").alias("n"))


def agreement(table: DataFrame, by: list[str]) -> DataFrame:
    """(by..., n, nmi, ari): normalised mutual information (arithmetic mean) and adjusted Rand index from a
    contingency table; both 1 where either labeling leaves nothing to tell, as the definitions have it."""
    keys = by or ["_all"]
    table = table if by else table.withColumn("_all", F.lit(1))
    w = lambda *c: Window.partitionBy(*keys, *c)
    cells = table.withColumn("a", F.sum("n").over(w("t"))).withColumn("b", F.sum("n").over(w("p"))).withColumn("s", F.sum("n").over(w()))
    pairs = lambda c: c * (c - 1) / 2
    n, a, b, s = (F.col(c).cast("double") for c in ("n", "a", "b", "s"))
    sums = cells.groupBy(*keys).agg(
        F.max("s").alias("n"),
        F.sum(n / s * F.ln(s * n / (a * b))).alias("mi"),
        # every cell carries its margins' terms in proportion, so one pass does
        F.sum(-n / s * F.ln(a / s)).alias("hu"),
        F.sum(-n / s * F.ln(b / s)).alias("hv"),
        F.sum(pairs(n)).alias("cn"),
        F.sum(n / a * pairs(a)).alias("ca"),
        F.sum(n / b * pairs(b)).alias("cb"),
    )
    expected = F.try_divide(F.col("ca") * F.col("cb"), pairs(F.col("n").cast("double")))
    below = (F.col("ca") + F.col("cb")) / 2 - expected
    return sums.select(
        *by, "n",
        F.when(F.col("hu") + F.col("hv") < 1e-15, 1.0).otherwise(F.greatest(F.lit(0.0), F.col("mi")) / ((F.col("hu") + F.col("hv")) / 2)).alias("nmi"),
        F.when((F.abs(below) < 1e-12) | below.isNull(), 1.0).otherwise((F.col("cn") - expected) / below).alias("ari"),
    )


def scores(df: DataFrame, by: list[str], truth: str, found: str) -> DataFrame:
    """(by..., n_total, n_valid, coverage, nmi, ari, adjusted_ari, score, grade). Fewer than two valid rows
    score 0."""
    total = df.groupBy(*by).agg(F.count("*").alias("n_total"))
    agreed = agreement(contingency(df, by, truth, found), by)
    joined = total.join(agreed, by, "left") if by else total.join(agreed)  # one row each without groups
    enough = F.coalesce(F.col("n"), F.lit(0)) >= 2
    nmi = F.when(enough, F.col("nmi")).otherwise(0.0)
    ari = F.when(enough, F.col("ari")).otherwise(0.0)
    coverage = F.when(enough, F.col("n") / F.col("n_total")).otherwise(0.0)
    score = NMI_WEIGHT * nmi + ARI_WEIGHT * ari * coverage
    return joined.select(
        *by, "n_total", F.coalesce("n", F.lit(0)).alias("n_valid"),
        *[F.round(c, 6).alias(name) for c, name in ((coverage, "coverage"), (nmi, "nmi"), (ari, "ari"), (ari * coverage, "adjusted_ari"), (score, "score"))],
        grade(score).alias("grade"),
    )


def cluster_sizes(df: DataFrame, by: list[str], label: str) -> DataFrame:
    """(by..., n_clusters, n_noise, n_samples, avg_size, min_size, max_size); -1 is noise, 0 where no cluster is."""
    sizes = df.groupBy(*by, F.col(label).alias("l")).agg(F.count("*").alias("n"))
    real = F.col("l") != -1
    return sizes.groupBy(*by).agg(
        F.count_if(real).alias("n_clusters"),
        F.coalesce(F.sum(F.when(~real, F.col("n"))), F.lit(0)).alias("n_noise"),
        F.sum("n").alias("n_samples"),
        F.round(F.coalesce(F.avg(F.when(real, F.col("n"))), F.lit(0.0)), 6).alias("avg_size"),
        F.coalesce(F.min(F.when(real, F.col("n"))), F.lit(0)).alias("min_size"),
        F.coalesce(F.max(F.when(real, F.col("n"))), F.lit(0)).alias("max_size"),
    )


def drop_small(df: DataFrame, by: list[str], label: str, least) -> DataFrame:
    """Clusters smaller than `least` become -1; the others are numbered from 0 in the order of their labels."""
    sizes = df.groupBy(*by, label).agg(F.count("*").alias("_n"))
    kept = sizes.where((F.col("_n") >= least) & (F.col(label) != -1))
    numbered = kept.withColumn("_new", F.dense_rank().over(Window.partitionBy(*(by or [F.lit(1)])).orderBy(label)) - 1).drop("_n")
    return df.join(numbered, [*by, label], "left").withColumn("new_label", F.coalesce("_new", F.lit(-1))).drop("_new")


def representatives(df: DataFrame, by: list[str], text: str, key: str) -> DataFrame:
    """(by..., n, representative): the longest text of every cluster, of equals that of smallest key."""
    return df.where(F.col(text).isNotNull()).groupBy(*by).agg(F.count("*").alias("n"), F.max_by(text, F.struct(F.length(text), -F.col(key))).alias("representative"))


def mapping_table(df: DataFrame, by: list[str], text: str, key: str) -> DataFrame:
    """(by..., n, n_texts, representative, texts): each cluster with its distinct texts in order."""
    distinct = df.where(F.col(text).isNotNull()).groupBy(*by, text).agg(F.count("*").alias("_m"), F.min(key).alias("_first"))
    return distinct.groupBy(*by).agg(
        F.sum("_m").alias("n"), F.count("*").alias("n_texts"), F.max_by(text, F.struct(F.length(text), -F.col("_first"))).alias("representative"), F.array_sort(F.collect_list(text)).alias("texts")
    )


def match_labels(items: DataFrame, column: str, label: str, text: str, key: str, base: str) -> DataFrame:
    """(column, label, base_label, sim): every cluster of another column with the base column's cluster whose
    representative is most like its own, by cosine of TF-IDF over words; none in common gives -1. Clusters meet
    over shared words, so none is compared that has nothing in common."""
    reps = representatives(items, [column, label], text, key)
    words = reps.select(column, label, F.explode(F.filter(F.split(F.lower("representative"), r"[^\p{L}\p{N}\p{M}_]+"), lambda w: w != "")).alias("w"))
    tf = words.groupBy(column, label, "w").agg(F.count("*").alias("tf"))
    n = reps.count()  # one number
    df_ = tf.groupBy("w").agg(F.count("*").alias("df"))
    weight = tf.join(df_, "w").withColumn("x", F.col("tf") * (F.ln((1 + F.lit(n)) / (1 + F.col("df"))) + 1))
    length = weight.groupBy(column, label).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("len"))
    unit = weight.join(length, [column, label]).select(column, label, "w", (F.col("x") / F.col("len")).alias("x"))
    b = unit.where(F.col(column) == base).select(F.col(label).alias("base_label"), "w", F.col("x").alias("y"))
    sims = unit.where(F.col(column) != base).join(b, "w").groupBy(column, label, "base_label").agg(F.round(F.sum(F.col("x") * F.col("y")), 9).alias("sim"))
    best = sims.groupBy(column, label).agg(F.max(F.struct("sim", (-F.col("base_label")).alias("neg"))).alias("b"))
    return reps.where(F.col(column) != base).select(column, label).join(best, [column, label], "left").select(
        column, label, F.coalesce(-F.col("b.neg"), F.lit(-1)).alias("base_label"), F.round(F.coalesce("b.sim", F.lit(0.0)), 6).alias("sim")
    )
