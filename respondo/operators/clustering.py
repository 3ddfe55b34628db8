"""Candidate clusterings of every question's vectors, their scores, and the best of them.

`vectors` is (grp, id, emb, truth): truth is a human label where there is one. All groups go through one
plan; a group with fewer than five vectors gets no scaled Markov clustering and is not trained, but takes part in the ensemble."""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import DBSCAN_MIN_SAMPLES, DBSCAN_PERCENTILES, INFLATION, MAX_K, MCL_ITERATIONS, MIN_CLUSTER_SHARE, MIN_SAMPLES, NEIGHBOURS
from ..session import cut
from . import graph
from .evaluation import scores


def large_enough(vectors: DataFrame, least: int = MIN_SAMPLES) -> DataFrame:
    sizes = vectors.groupBy("grp").agg(F.count("*").alias("_n")).where(F.col("_n") >= least)
    return vectors.join(sizes.select("grp"), "grp", "left_semi")


def _completed(vectors: DataFrame, labels: DataFrame, alone: int = -1) -> DataFrame:
    return vectors.select("grp", "id").join(labels, ["grp", "id"], "left").select("grp", "id", F.coalesce("label", F.lit(alone)).alias("label"))


def scaled_mcl(vectors: DataFrame, k: int = NEIGHBOURS, inflation: float = INFLATION, iterations: int = MCL_ITERATIONS, near: DataFrame | None = None) -> DataFrame:
    """(grp, id, label) by neighbours, local scaling and Markov clustering; nodes without an edge are -1. `near` are
    neighbour lists of at least k that are there already."""
    near = cut(graph.knn(vectors, k), "knn") if near is None else near.where(F.col("rank") <= k)
    edges = graph.symmetric(graph.csls(near), "max")
    return _completed(vectors, graph.mcl_by_group(edges, inflation, iterations))


def plain_mcl(vectors: DataFrame, k: int = NEIGHBOURS, inflation: float = INFLATION, iterations: int = MCL_ITERATIONS, near: DataFrame | None = None) -> DataFrame:
    """(grp, id, label) by neighbours, mean weights above their median and Markov clustering."""
    near = graph.knn(vectors, k) if near is None else near.where(F.col("rank") <= k)
    mean = graph.symmetric(near.withColumnRenamed("sim", "w"), "mean")
    return _completed(vectors, graph.mcl_by_group(graph.median_cut(mean).where("w > 0"), inflation, iterations))


def percentiles(vectors: DataFrame, shares: list[float] = DBSCAN_PERCENTILES, near: DataFrame | None = None) -> DataFrame:
    """(grp, eps_ord, eps): percentiles of the distance to the nearest neighbour."""
    nearest = (graph.knn(vectors, 1) if near is None else near.where("rank = 1")).select("grp", (1 - F.col("sim")).alias("far"))
    found = nearest.groupBy("grp").agg(F.percentile("far", F.array(*map(F.lit, shares))).alias("p"))
    return found.select("grp", F.posexplode("p").alias("eps_ord", "eps"))


def candidates(vectors: DataFrame) -> DataFrame:
    """(grp, method, method_ord, param_ord, id, label) of all methods. Scaled Markov clustering takes groups of five
    or more; in smaller ones a candidate needs a cluster, and those without any get `fallback_kmeans`."""
    vectors = cut(vectors.select("grp", "id", "emb"), "vectors")
    tag = lambda df, method, order, param: df.select("grp", F.lit(method).alias("method"), F.lit(order).alias("method_ord"), param.alias("param_ord"), "id", "label")
    near = cut(graph.knn(vectors, NEIGHBOURS), "knn")  # once for all methods
    parts = [
        tag(scaled_mcl(large_enough(vectors), near=near.join(large_enough(vectors).select("grp").distinct(), "grp", "left_semi")), "knn_csls_mcl", 0, F.lit(0)),
        tag(plain_mcl(vectors, near=near), "mcl", 1, F.lit(0)),
        tag(graph.kmeans(vectors, MAX_K, MIN_CLUSTER_SHARE), "kmeans", 2, F.col("k")),
    ]
    order = reduce(lambda c, i: c.when(F.col("least") == DBSCAN_MIN_SAMPLES[i], i), range(len(DBSCAN_MIN_SAMPLES)), F.when(F.lit(False), -1))
    grid = graph.dbscan_grid(vectors, percentiles(vectors, near=near), DBSCAN_MIN_SAMPLES)
    parts.append(tag(grid, "dbscan", 3, F.col("eps_ord") * len(DBSCAN_MIN_SAMPLES) + order))
    found = cut(reduce(DataFrame.unionByName, parts), "candidates")
    sizes = vectors.groupBy("grp").agg(F.count("*").alias("_n"))
    small = sizes.where(F.col("_n") < MIN_SAMPLES).select("grp")
    useful = found.where("label >= 0").select("grp", "method", "param_ord").distinct()
    kept = found.join(small, "grp", "left_anti").unionByName(found.join(small, "grp", "left_semi").join(useful, ["grp", "method", "param_ord"], "left_semi"))
    return kept.unionByName(tag(_fallback(vectors.join(kept.select("grp").distinct(), "grp", "left_anti")), "fallback_kmeans", 4, F.lit(3)))


def _fallback(vectors: DataFrame, k: int = 3) -> DataFrame:
    """(grp, id, label) by K-means with k clusters, no cluster too small. Groups come here with at most three vectors, as
    limited K-means finds a cluster among four: each vector is its own centre."""
    return vectors.select("grp", "id", F.least(F.row_number().over(Window.partitionBy("grp").orderBy("id")), F.lit(k)).cast("int").alias("label")).withColumn("label", F.col("label") - 1)


def synthetic_truth(vectors: DataFrame, method: str = "consensus") -> DataFrame:
    """(grp, id, truth) for groups without human labels. `consensus` is K-means with three clusters; `kmeans` takes
    three to five, as many as leave ten vectors each and one group of ten over; `hierarchical` merges by Ward's criterion down to three
    to five, one for twenty vectors. Groups above `graph.DENSE` are cut by K-means of the same number instead of being
    merged. Any other method is a ValueError; a group smaller than the number of clusters has no truth."""
    vectors = vectors.select("grp", "id", "emb")
    sizes = vectors.groupBy("grp").agg(F.count("*").alias("n"))
    of = lambda share: F.least(F.lit(5), F.greatest(F.lit(3), share)).cast("int").alias("k")
    wanted = {"consensus": F.lit(3).alias("k"), "kmeans": of(F.floor(F.col("n") / 10) - 1), "hierarchical": of(F.floor(F.col("n") / 20))}
    if method not in wanted:
        raise ValueError(f"unknown method {method}")
    number = sizes.select("grp", "n", wanted[method])
    if method != "hierarchical":
        return _cut_by_kmeans(vectors, number)
    small = vectors.join(number.where(F.col("n") <= graph.DENSE).select("grp", "k"), "grp")
    kind = dict(vectors.dtypes)

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        labels = graph.ward(np.stack(pdf["emb"].to_numpy()), int(pdf["k"].iloc[0])) if len(pdf) >= pdf["k"].iloc[0] else None
        return pd.DataFrame({"grp": pdf["grp"].to_numpy(), "id": pdf["id"].to_numpy(), "truth": labels.astype(str)} if labels is not None else {"grp": [], "id": [], "truth": []})

    merged = small.groupBy("grp").applyInPandas(merge, f"grp {kind['grp']}, id {kind['id']}, truth string")
    large = number.where(F.col("n") > graph.DENSE)
    return merged.unionByName(_cut_by_kmeans(vectors.join(large.select("grp"), "grp", "left_semi"), large))


def _cut_by_kmeans(vectors: DataFrame, number: DataFrame) -> DataFrame:
    found = graph.kmeans(vectors, 5, 0.0).join(number.select("grp", "k"), ["grp", "k"])
    return found.select("grp", "id", F.col("label").cast("string").alias("truth"))


def scored(found: DataFrame, truth: DataFrame) -> DataFrame:
    """Scores of every candidate against (grp, id, truth)."""
    return scores(found.join(truth, ["grp", "id"], "left"), ["grp", "method", "method_ord", "param_ord"], "truth", "label")


def best(scored_candidates: DataFrame) -> DataFrame:
    """The candidate of highest score in each group; of equals the earlier method and parameter."""
    w = Window.partitionBy("grp").orderBy(F.desc("score"), "method_ord", "param_ord")
    return scored_candidates.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def ensemble(vectors: DataFrame, truth: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(labels, scores) of the best candidate of each group: (grp, method, id, label) and one score row a group."""
    found = cut(candidates(vectors), "candidates")
    truth = truth if truth is not None else cut(synthetic_truth(vectors), "truth")
    winners = cut(best(scored(found, truth)), "winners")
    labels = found.join(winners.select("grp", "method", "param_ord"), ["grp", "method", "param_ord"]).select("grp", "method", "id", "label")
    return labels, winners


def estimate(vectors: DataFrame, truth: DataFrame) -> DataFrame:
    """(grp, estimated_clusters, recommended_k): the number of K-means clusters of highest score."""
    found = graph.kmeans(large_enough(vectors).select("grp", "id", "emb"), MAX_K, MIN_CLUSTER_SHARE)
    rated = scored(found.select("grp", F.lit("kmeans").alias("method"), F.lit(0).alias("method_ord"), F.col("k").alias("param_ord"), "id", "label"), truth)
    return best(rated).select("grp", F.col("param_ord").alias("estimated_clusters"), F.lit(NEIGHBOURS).alias("recommended_k"))


def auto_train(vectors: DataFrame, truth: DataFrame, inflations: tuple[float, ...] = (1.5, 2.0, 3.0), ks: tuple[int, ...] = (5, 10, 15)) -> DataFrame:
    """The best of a grid of inflations and neighbour numbers for each group."""
    vectors = cut(large_enough(vectors).select("grp", "id", "emb"), "vectors")
    near = cut(graph.knn(vectors, max(ks)), "knn")  # once for all numbers of neighbours
    edges = reduce(DataFrame.unionByName, [graph.symmetric(graph.csls(near.where(F.col("rank") <= k)), "max").withColumn("grp", F.struct("grp", F.lit(i).alias("k_ord"))) for i, k in enumerate(ks)])
    edges = cut(edges, "train-edges")
    parts = []
    for i, inflation in enumerate(inflations):  # the numbers of neighbours are groups of one run
        found = graph.mcl_by_group(edges, inflation).select("grp.grp", "grp.k_ord", "id", "label")
        for j, k in enumerate(ks):
            labels = _completed(vectors, found.where(F.col("k_ord") == j).select("grp", "id", "label"))
            parts.append(labels.select("grp", F.lit(f"inflation {inflation}, k {k}").alias("method"), F.lit(0).alias("method_ord"), F.lit(i * len(ks) + j).alias("param_ord"), "id", "label"))
    return best(scored(reduce(DataFrame.unionByName, parts), truth))


def manual_train(vectors: DataFrame, inflation: float = INFLATION, k: int = NEIGHBOURS, iterations: int = MCL_ITERATIONS) -> DataFrame:
    """Labels of every group with given parameters."""
    return scaled_mcl(large_enough(vectors), k, inflation, iterations)


def trained(vectors: DataFrame, **parameters) -> DataFrame:
    """As `manual_train`, with the vectors of smaller groups as -1."""
    return _completed(vectors, manual_train(vectors, **parameters))


def refine(labels: DataFrame, normalised: str) -> DataFrame:
    """(grp, id, label, refined): clusters whose normalised representatives are equal share the smallest label."""
    merged = labels.groupBy("grp", normalised).agg(F.min("label").alias("refined"))
    return labels.join(merged, ["grp", normalised]).select("grp", "id", "label", "refined")


def script_mcl(vectors: DataFrame, k: int = 10, inflation: float = INFLATION) -> DataFrame:
    """The variant whose neighbour lists count the vector itself: k - 1 others, all positive scaled weights,
    mean of both directions, nodes without cluster in cluster 0."""
    edges = graph.csls(cut(graph.knn(vectors, k - 1), "knn"), 0.0)
    return _completed(vectors, graph.mcl_by_group(graph.symmetric(edges, "mean"), inflation), alone=0)


def classify(answers: DataFrame, by: list[str], size: int = 384) -> DataFrame:
    """(grp, text, label): distinct answers of each group - a question, or a question and a polarity - encoded
    and clustered; alone answers are -1. `answers` is (by..., text)."""
    from ..providers import encode

    named = answers.select(F.concat_ws("/", *by).alias("grp"), "text").where("text is not null").distinct()
    points = cut(encode(named, "text", size).where(F.size("emb") > 0).select("grp", "text", F.xxhash64("text").alias("id"), F.col("emb").cast("array<double>").alias("emb")), "points")
    labels = scaled_mcl(large_enough(points.select("grp", "id", "emb")))
    return points.join(labels, ["grp", "id"], "left").select("grp", "text", F.coalesce("label", F.lit(-1)).alias("label"))


def rollup(scored_groups: DataFrame, question: str) -> DataFrame:
    """Per question over its columns: clusterings, mean NMI, adjusted ARI and score."""
    return scored_groups.groupBy(question).agg(F.count("*").alias("n"), *[F.round(F.avg(c), 6).alias(c) for c in ("nmi", "adjusted_ari", "score")])


def train(vectors: DataFrame, truth: DataFrame, mode: str, **parameters) -> DataFrame:
    """One of the modes `estimate`, `auto_train`, `manual_train`; any other is a ValueError."""
    if mode == "estimate":
        return estimate(vectors, truth)
    if mode == "auto_train":
        return auto_train(vectors, truth, **parameters)
    if mode == "manual_train":
        return manual_train(vectors, **parameters)
    raise ValueError(f"unknown mode {mode}")


@dataclass
class Outcome:
    """What a run of the clustering stage came to: completed or failed, why, how long it took, what went in, and the rows."""

    mode: str
    status: str
    error: str | None
    seconds: float
    summary: dict
    rows: DataFrame | None


def serve(vectors: DataFrame, truth: DataFrame, mode: str, **parameters) -> Outcome:
    """`train` as a service: the rows are written, so the time is theirs, and a failure or an unknown mode is an outcome, not an exception."""
    began = time.monotonic()
    try:
        counted = vectors.agg(F.count_distinct("grp").alias("groups"), F.count("*").alias("vectors")).first()
        summary = {"groups": counted.groups, "vectors": counted.vectors, "per_group": round(counted.vectors / max(1, counted.groups), 6)}
        rows = cut(train(vectors, truth, mode, **parameters), "stage-3")
        return Outcome(mode, "completed", None, time.monotonic() - began, summary, rows)
    except Exception as failure:  # noqa: BLE001 - whatever a stage raises is its outcome
        return Outcome(mode, "failed", f"{type(failure).__name__}: {failure}"[:500], time.monotonic() - began, {}, None)
