"""Nearest neighbours within groups, locally scaled edges, Markov and density clustering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..constants import CSLS_CUT, INFLATION, MCL_ITERATIONS, NEIGHBOURS
from ..session import cut

#: Rows of a block. A pair of blocks is a task: two times 25 MB of 384 floats, multiplied `_ROWS` rows at a time. A
#: group of n vectors moves n * n / BLOCK of them, so a block is as large as a task bears.
BLOCK = 16_384
_ROWS = 512
#: Groups of up to so many nodes are clustered as one dense matrix in a task of their own.
DENSE = 1024


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    x = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = x.reshape(len(flat), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def valid_vectors(df: DataFrame, group: str, key: str, emb: str, dim: int) -> DataFrame:
    """(grp, id, emb) of the vectors that can be compared: of the given length and not all zero, in the type
    they are stored in."""
    top, low = F.array_max(emb), F.array_min(emb)
    return df.where((F.size(emb) == dim) & ((top != 0) | (low != 0))).select(F.col(group).alias("grp"), F.col(key).alias("id"), F.col(emb).alias("emb"))


def _blocked(vectors: DataFrame, block: int) -> DataFrame:
    """Vectors with the block they are in and every block they meet: (grp, a, b, second, ...).

    A group of up to a block is one block that meets itself. Larger groups are cut into blocks by id hash,
    and each unordered pair of blocks is one task, so no group, however large, comes to one task whole."""
    sizes = vectors.groupBy("grp").agg(F.count("*").alias("_n")).select("grp", F.ceil(F.col("_n") / block).cast("int").alias("_blocks"))
    placed = vectors.join(sizes, "grp").withColumn("_home", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int"))
    met = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return met.select("grp", F.least("_home", "_other").alias("a"), F.greatest("_home", "_other").alias("b"), (F.col("_home") > F.col("_other")).alias("second"), *[c for c in vectors.columns if c != "grp"])


def _sides(key: tuple[pa.Scalar, ...], table: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """The row numbers of the two blocks of a task; of a block that meets itself, twice the same."""
    second = table.column("second").to_numpy()
    if key[1].as_py() == key[2].as_py():
        return [np.arange(len(second))] * 2
    return [np.flatnonzero(~second), np.flatnonzero(second)]


def knn(vectors: DataFrame, k: int = NEIGHBOURS, block: int = BLOCK) -> DataFrame:
    """(grp, src, dst, sim, rank): each vector's k most similar others of its group by cosine, itself left
    out by id, equal similarities by smaller id. Exact; blocks of a group are compared pairwise in tasks of
    their own and only their best are kept."""
    kind = dict(vectors.dtypes)

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        x, ids = _matrix(table.column("emb")), table.column("id").to_numpy()
        one, two = _sides(key, table)
        src, dst, sim = [], [], []
        for p, q in [(one, two)] if one is two else [(one, two), (two, one)]:
            if not len(p) or not len(q):
                continue
            right, qid = x[q].T, ids[q]
            for begin in range(0, len(p), _ROWS):
                rows = p[begin : begin + _ROWS]
                s = x[rows] @ right
                s[ids[rows][:, None] == qid[None, :]] = -np.inf
                for r in range(len(rows)):
                    best = np.argpartition(-s[r], min(k, len(q) - 1))[: k + 1] if len(q) > k + 1 else np.arange(len(q))
                    least = np.sort(s[r][best])[-min(k, len(best))]
                    best = np.flatnonzero(s[r] >= least - 1e-12)
                    best = best[np.lexsort((qid[best], -np.round(s[r][best], 12)))][:k]
                    best = best[np.isfinite(s[r][best])]
                    src += [ids[rows[r]]] * len(best)
                    dst += qid[best].tolist()
                    sim += s[r][best].tolist()
        n = len(src)
        t = table.schema
        return pa.table({"grp": pa.array([key[0].as_py()] * n, t.field("grp").type), "src": pa.array(src, t.field("id").type), "dst": pa.array(dst, t.field("id").type), "sim": pa.array(sim, pa.float64())})

    found = _blocked(vectors.select("grp", "id", "emb"), block).groupBy("grp", "a", "b").applyInArrow(compare, f"grp {kind['grp']}, src {kind['id']}, dst {kind['id']}, sim double")
    lists = found.groupBy("grp", "src").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.round("sim", 12)).alias("far"), "dst", "sim"))), 1, k).alias("near"))
    return lists.select("grp", "src", F.posexplode("near").alias("rank", "n")).select("grp", "src", F.col("n.dst").alias("dst"), F.col("n.sim").alias("sim"), (F.col("rank") + 1).alias("rank"))


def neighbour_mean(edges: DataFrame) -> DataFrame:
    """(grp, id, mean_sim) over each vector's neighbours."""
    return edges.groupBy("grp", F.col("src").alias("id")).agg(F.avg("sim").alias("mean_sim"))


def csls(edges: DataFrame, least: float = CSLS_CUT) -> DataFrame:
    """(grp, src, dst, w): twice the cosine less both ends' neighbour means, where above `least`."""
    mean = neighbour_mean(edges)
    a = mean.select("grp", F.col("id").alias("src"), F.col("mean_sim").alias("ra"))
    b = mean.select("grp", F.col("id").alias("dst"), F.col("mean_sim").alias("rb"))
    scaled = edges.join(a, ["grp", "src"]).join(b, ["grp", "dst"]).withColumn("w", 2 * F.col("sim") - F.col("ra") - F.col("rb"))
    return scaled.where(F.col("w") > least).select("grp", "src", "dst", "w")


def symmetric(edges: DataFrame, how: str = "max") -> DataFrame:
    """(grp, lo, hi, w): unordered edges with the larger weight (`max`) or the mean of both directions, a
    missing one counting 0 (`mean`)."""
    w = F.max("w") if how == "max" else F.sum("w") / 2
    return edges.groupBy("grp", F.least("src", "dst").alias("lo"), F.greatest("src", "dst").alias("hi")).agg(w.alias("w"))


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("grp", F.col("lo").alias("src"), F.col("hi").alias("dst"), "w").unionByName(edges.select("grp", F.col("hi").alias("src"), F.col("lo").alias("dst"), "w"))


def median_cut(edges: DataFrame) -> DataFrame:
    """Edges at or above the median positive weight of their group."""
    median = edges.where("w > 0").groupBy("grp").agg(F.percentile("w", F.lit(0.5)).alias("median"))
    return edges.join(median, "grp").where("w >= median - 1e-12").drop("median")


def mcl(edges: DataFrame, inflation: float = INFLATION, iterations: int = MCL_ITERATIONS, prune: float = 1e-3) -> DataFrame:
    """(grp, id, label): Markov clusters of the symmetric graph of each group, labels from 0 by smallest id.

    Self-loops of weight 1, column-normalised, squared, inflated and pruned until no entry changes by six
    places. The matrix is a table of its non-zero entries, keyed by group and column; a round is one join on the middle
    index, one aggregation and one window over the columns, written to the shared folder, so a group is bounded by the
    cluster, not by a task. Pruning leaves a column at most 1 / `prune` entries, as they sum to 1, which bounds the join. Nodes
    without an edge, and those that no attractor reaches, have no cluster."""
    loops = both_ways(edges).select("grp", F.col("src").alias("i")).distinct().select("grp", "i", F.col("i").alias("j"), F.lit(1.0).alias("v"))
    m = both_ways(edges).select("grp", F.col("src").alias("i"), F.col("dst").alias("j"), F.col("w").cast("double").alias("v")).unionByName(loops)
    column = Window.partitionBy("grp", "j")

    def normalised(entries: DataFrame) -> DataFrame:
        return entries.withColumn("v", F.col("v") / F.sum("v").over(column))

    def written(entries: DataFrame) -> tuple[DataFrame, int]:
        seen = Observation()
        done = cut(entries.observe(seen, F.bit_xor(F.xxhash64("grp", "i", "j", F.round("v", 6))).alias("digest")), "mcl")
        return done, seen.get["digest"]

    m, before = written(normalised(m))
    for _ in range(iterations):
        left = m.select("grp", "i", F.col("j").alias("k"), F.col("v").alias("x"))
        right = m.select("grp", F.col("i").alias("k"), "j", F.col("v").alias("y"))
        squared = left.join(right, ["grp", "k"]).groupBy("grp", "i", "j").agg(F.sum(F.col("x") * F.col("y")).alias("v"))
        inflated = normalised(squared.withColumn("v", F.pow("v", F.lit(inflation)))).withColumn("top", F.max("v").over(column))
        m, now = written(normalised(inflated.where((F.col("v") >= prune) | (F.col("v") == F.col("top"))).drop("top")))
        if now == before:
            break
        before = now
    # an attractor's row names its cluster; of several, a node takes the last
    attractors = m.where("i = j").select("grp", "i")
    owner = m.join(attractors, ["grp", "i"]).groupBy("grp", F.col("j").alias("id")).agg(F.max("i").alias("owner"))
    return dense_labels(owner, "owner")


def dense_labels(df: DataFrame, column: str) -> DataFrame:
    """(grp, id, label): names of clusters as numbers from 0 within each group, by smallest member id."""
    heads = df.groupBy("grp", column).agg(F.min("id").alias("_first"))
    numbered = heads.withColumn("label", F.dense_rank().over(Window.partitionBy("grp").orderBy("_first")) - 1)
    return df.join(numbered, ["grp", column]).select("grp", "id", "label")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(grp, id, head): connected components, named by their smallest id, by hooking to the smallest label
    around and halving paths, in rounds on narrow rows that are written out."""
    labels = cut(nodes.select("grp", "id", F.col("id").alias("head")), "components")
    links = cut(edges.select("grp", F.col("lo").alias("a"), F.col("hi").alias("b")).unionByName(edges.select("grp", F.col("hi").alias("a"), F.col("lo").alias("b"))).distinct(), "links")
    while True:
        around = links.join(labels.select("grp", F.col("id").alias("b"), F.col("head").alias("h")), ["grp", "b"]).groupBy("grp", F.col("a").alias("id")).agg(F.min("h").alias("h"))
        hooked = labels.join(around, ["grp", "id"], "left").select("grp", "id", F.least("head", F.coalesce("h", "head")).alias("head"), F.col("head").alias("old"))
        up = hooked.select("grp", F.col("id").alias("head"), F.col("head").alias("next"))
        new = cut(hooked.join(up, ["grp", "head"], "left").select("grp", "id", F.least("head", F.coalesce("next", "head")).alias("head"), "old"), "components")
        labels = new.drop("old")
        if not new.where("head <> old").take(1):
            return labels


def join_all(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the components of a[i] and b[i]; `root` names the smallest member of everyone's component."""
    while True:
        a, b = root[a], root[b]
        apart = a != b
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root[:] = root[root]


def _reached(one: np.ndarray, two: np.ndarray, x: np.ndarray, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, distances to the whole other block) of parts of a block; a vector is infinitely far from itself."""
    right = x[two].T
    for begin in range(0, len(one), _ROWS):
        rows = one[begin : begin + _ROWS]
        far = 1 - x[rows] @ right
        far[ids[rows][:, None] == ids[two][None, :]] = np.inf
        yield rows, far


def reach(vectors: DataFrame, radii: DataFrame, block: int = BLOCK) -> DataFrame:
    """(grp, eps_ord, id, n): how many others of its group a vector has within each radius (cosine distance), where
    any; `radii` is (grp, eps_ord, eps). Pairs are counted inside the blocks and never come out of them."""
    kind = dict(vectors.dtypes)
    lists = radii.groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("eps_ord", "eps"))).alias("radii"))

    def count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        x, ids = _matrix(table.column("emb")), table.column("id").to_numpy()
        wanted = table.column("radii")[0].as_py()
        one, two = _sides(key, table)
        n = np.zeros((len(wanted), len(ids)), np.int64)
        for rows, far in _reached(one, two, x, ids):
            for e, radius in enumerate(wanted):
                hit = far <= radius["eps"] + 1e-12
                n[e, rows] += hit.sum(1)
                if one is not two:
                    n[e, two] += hit.sum(0)
        e, i = np.nonzero(n)
        t = table.schema
        return pa.table({"grp": pa.array([key[0].as_py()] * len(i), t.field("grp").type), "eps_ord": pa.array([wanted[k]["eps_ord"] for k in e], pa.int32()), "id": pa.array(ids[i], t.field("id").type), "n": pa.array(n[e, i])})

    blocks = _blocked(vectors.select("grp", "id", "emb").join(lists, "grp"), block)
    found = blocks.groupBy("grp", "a", "b").applyInArrow(count, f"grp {kind['grp']}, eps_ord int, id {kind['id']}, n bigint")
    return found.groupBy("grp", "eps_ord", "id").agg(F.sum("n").alias("n"))


def density_links(vectors: DataFrame, radii: DataFrame, cores: DataFrame, block: int = BLOCK) -> DataFrame:
    """(grp, setting, lo, hi, border): what a density clustering needs of the pairs within a radius. Each pair of
    blocks joins its core points to components and gives one link a core point to the smallest of its component, and one
    link (border, core) for each component in reach of a point that is not core. `cores` is (grp, id, settings): the
    settings, as structs (eps_ord, least), in which a vector is core; vectors without any are not in it.

    A point that is not core has fewer than `least` in reach, so no list is longer than the block, however dense a group."""
    kind = dict(vectors.dtypes)
    lists = radii.groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("eps_ord", "eps"))).alias("radii"))
    marked = vectors.select("grp", "id", "emb").join(cores, ["grp", "id"], "left").join(lists, "grp")

    def link(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        x, ids = _matrix(table.column("emb")), table.column("id").to_numpy()
        eps = {r["eps_ord"]: r["eps"] for r in table.column("radii")[0].as_py()}
        core: dict[tuple[int, int], np.ndarray] = {}
        for i, settings in enumerate(table.column("settings").to_pylist()):
            for s in settings or ():
                core.setdefault((s["eps_ord"], s["least"]), np.zeros(len(ids), bool))[i] = True
        one, two = _sides(key, table)
        order = np.argsort(ids, kind="stable")  # components are named by their smallest id
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        roots = {s: np.arange(len(ids)) for s in core}
        edge: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {s: [] for s in core}
        for rows, far in _reached(one, two, x, ids):
            for s, is_core in core.items():
                hit = far <= eps[s[0]] + 1e-12
                a, b = np.nonzero(hit & is_core[rows][:, None] & is_core[two][None, :])
                join_all(roots[s], place[rows[a]], place[two[b]])
                a, b = np.nonzero(hit & ~is_core[rows][:, None] & is_core[two][None, :])
                edge[s].append((rows[a], two[b]))
                if one is not two:
                    a, b = np.nonzero(hit & is_core[rows][:, None] & ~is_core[two][None, :])
                    edge[s].append((two[b], rows[a]))
        columns: list[list] = [[], [], [], [], []]
        for s, root in roots.items():
            members = np.flatnonzero(root != np.arange(len(ids)))
            points = np.concatenate([a for a, _ in edge[s]]) if edge[s] else np.zeros(0, np.int64)
            near = np.concatenate([b for _, b in edge[s]]) if edge[s] else np.zeros(0, np.int64)
            borders = np.unique(np.stack([points, root[place[near]]]), axis=1)
            lo = np.concatenate([ids[order[root[members]]], ids[borders[0]]])
            hi = np.concatenate([ids[order[members]], ids[order[borders[1]]]])
            for column, values in zip(columns, ([s[0]] * len(lo), [s[1]] * len(lo), lo.tolist(), hi.tolist(), [False] * len(members) + [True] * borders.shape[1])):
                column += values
        t = table.schema
        kinds = [pa.int32(), pa.int32(), t.field("id").type, t.field("id").type, pa.bool_()]
        return pa.table({"grp": pa.array([key[0].as_py()] * len(columns[0]), t.field("grp").type)} | {n: pa.array(c, k) for n, c, k in zip(("eps_ord", "least", "lo", "hi", "border"), columns, kinds)})

    blocks = _blocked(marked, block)
    return blocks.groupBy("grp", "a", "b").applyInArrow(link, f"grp {kind['grp']}, eps_ord int, least int, lo {kind['id']}, hi {kind['id']}, border boolean")


def dbscan_grid(vectors: DataFrame, radii: DataFrame, least: list[int], block: int = BLOCK) -> DataFrame:
    """(grp, eps_ord, least, id, label): density clusters at each radius and number of points; core points have at
    least that many points in reach, themselves included; borders take the smallest label in reach; the rest is -1. Two
    passes over the blocks serve all settings."""
    radii = cut(radii.select("grp", F.col("eps_ord").cast("int").alias("eps_ord"), "eps"), "radii")
    wanted = F.explode(F.array(*[F.lit(n).cast("int") for n in least])).alias("least")
    dense = reach(vectors, radii, block).select("grp", "eps_ord", "id", "n", wanted).where(F.col("n") + 1 >= F.col("least"))
    core = dense.select("grp", "eps_ord", "least", "id")
    if min(least) <= 1:  # a vector alone is core
        core = core.unionByName(vectors.select("grp", "id").join(radii, "grp").select("grp", "eps_ord", F.lit(1).alias("least"), "id")).distinct()
    core = cut(core, "core")
    links = cut(density_links(vectors, radii, core.groupBy("grp", "id").agg(F.collect_list(F.struct("eps_ord", "least")).alias("settings")), block), "density-links")
    combined = F.struct("grp", "eps_ord", "least").alias("grp")
    labels = dense_labels(components(core.select(combined, "id"), links.where(~F.col("border")).select(combined, "lo", "hi")), "head")
    borders = links.where("border").select(combined, F.col("lo").alias("point"), F.col("hi").alias("id"))
    border = borders.join(labels, ["grp", "id"]).groupBy("grp", F.col("point").alias("id")).agg(F.min("label").alias("near"))
    everyone = vectors.select("grp", "id").join(radii.select("grp", "eps_ord"), "grp").select("grp", "eps_ord", "id", wanted).select(combined, "id")
    out = everyone.join(labels, ["grp", "id"], "left").join(border, ["grp", "id"], "left")
    return out.select("grp.grp", "grp.eps_ord", "grp.least", "id", F.coalesce("label", "near", F.lit(-1)).alias("label"))


def dbscan(vectors: DataFrame, radii: DataFrame, min_samples: int, block: int = BLOCK) -> DataFrame:
    """(grp, eps_ord, id, label): `dbscan_grid` with one number of points."""
    return dbscan_grid(vectors, radii, [min_samples], block).drop("least")


#: Starts of K-means; the one of least inertia counts.
STARTS = 10


def kmeans(vectors: DataFrame, most: int, smallest: float, seed: int = 42, rounds: int = 25, starts: int = STARTS) -> DataFrame:
    """(grp, k, id, label): limited K-means of each group for 2..`most` clusters, on unit vectors, the best of several
    starts; clusters below max(2, `smallest` of the group) become -1 and the others are numbered anew.

    Groups of up to `DENSE` vectors are clustered in a task each. Larger ones are cut into blocks; a round compares each
    block with the centres of its group and sends back sums per cluster, not rows. The centres of a start are the first vectors by a
    hash of their ids and the start, in both; a centre that nobody is nearest to is dropped."""
    vectors = vectors.select("grp", "id", "emb")
    sizes = cut(vectors.groupBy("grp").agg(F.count("*").alias("n")), "kmeans-sizes")
    hashed = vectors.withColumn("h", F.array(*[F.xxhash64("id", F.lit(seed + s)) for s in range(starts)]))
    kind = dict(vectors.dtypes)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        x = _unit(np.stack(pdf["emb"].to_numpy()))
        orders = np.argsort(np.stack(pdf["h"].to_numpy()), axis=0, kind="stable")
        out = []
        for k in range(2, min(most, len(x)) + 1):
            best = None
            for s in range(starts):
                labels, loss = _lloyd(x, x[orders[:k, s]], rounds)
                if best is None or loss < best[0] - 1e-9:
                    best = (loss, labels)
            out.append(pd.DataFrame({"grp": pdf["grp"].to_numpy(), "k": np.int32(k), "id": pdf["id"].to_numpy(), "label": best[1].astype(np.int32)}))
        return pd.concat(out) if out else pd.DataFrame({"grp": [], "k": [], "id": [], "label": []})

    small = sizes.where((F.col("n") >= 2) & (F.col("n") <= DENSE)).select("grp")
    assigned = hashed.join(small, "grp", "left_semi").groupBy("grp").applyInPandas(run, f"grp {kind['grp']}, k int, id {kind['id']}, label int")
    large = sizes.where(F.col("n") > DENSE)
    if large.take(1):
        assigned = assigned.unionByName(_large_kmeans(vectors.join(large, "grp"), most, rounds, seed, starts))
    assigned = cut(assigned, "kmeans")
    counts = assigned.groupBy("grp", "k", "label").agg(F.count("*").alias("m"), F.min("id").alias("head")).join(sizes, "grp")
    kept = counts.where(F.col("m") >= F.greatest(F.lit(2), F.floor(F.col("n") * smallest))).withColumn("new", F.dense_rank().over(Window.partitionBy("grp", "k").orderBy("head")) - 1)
    return assigned.join(kept.select("grp", "k", "label", "new"), ["grp", "k", "label"], "left").select("grp", "k", "id", F.coalesce("new", F.lit(-1)).alias("label"))


def _unit(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.float64)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _lloyd(x: np.ndarray, centres: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    labels = np.full(len(x), -1)
    for _ in range(rounds):
        near = x @ _unit(centres).T
        used, now = np.unique(np.argmax(near, axis=1), return_inverse=True)
        loss = float((1 - near.max(1)).sum())
        if (now == labels).all():
            break
        labels = now
        centres = np.stack([x[labels == c].mean(0) for c in range(len(used))])
    return labels, loss


def ward(x: np.ndarray, k: int) -> np.ndarray:
    """Labels of k clusters, numbered by first member, by merging the two clusters whose union adds least to the sum of
    squares until k are left."""
    x = np.asarray(x, np.float64)
    n = len(x)
    square = (x * x).sum(1)
    far = np.maximum(square[:, None] + square[None, :] - 2 * x @ x.T, 0)
    np.fill_diagonal(far, np.inf)
    size, owner = np.ones(n), np.arange(n)
    for _ in range(n - k):
        i, j = sorted(np.unravel_index(np.argmin(far), far.shape))
        alive = np.isfinite(far[i]) & np.isfinite(far[j])
        m = size[alive]
        far[i, alive] = ((size[i] + m) * far[i, alive] + (size[j] + m) * far[j, alive] - m * far[i, j]) / (size[i] + size[j] + m)
        far[alive, i] = far[i, alive]
        far[j, :] = far[:, j] = np.inf
        size[i] += size[j]
        owner[owner == j] = i
    return np.unique(owner, return_inverse=True)[1]


def _large_kmeans(vectors: DataFrame, most: int, rounds: int, seed: int, starts: int, block: int = 8192) -> DataFrame:
    """`kmeans` of groups in blocks. `vectors` is (grp, id, emb, n)."""
    kind = dict(vectors.dtypes)
    grp, number = kind["grp"], kind["id"]
    placed = cut(vectors.select("grp", "id", "emb", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / block)).cast("int").alias("block")), "kmeans-blocks")
    blocks = cut(placed.select("grp", "block").distinct(), "kmeans-block-list")
    rank = F.row_number().over(Window.partitionBy("grp", "start").orderBy("h", "id"))
    start = F.posexplode(F.array(*[F.xxhash64("id", F.lit(seed + s)) for s in range(starts)])).alias("start", "h")
    first = placed.select("grp", "id", start).withColumn("r", rank).where(F.col("r") <= most).join(placed.select("grp", "id", "emb"), ["grp", "id"])
    each = F.explode(F.sequence(F.greatest(F.lit(2), F.col("r")), F.lit(most))).alias("k")
    centres = cut(first.select("grp", "start", "r", F.col("emb").cast("array<double>").alias("c"), each).select("grp", "k", "start", (F.col("r") - 1).alias("label"), "c"), "kmeans-seeds")

    def tables(table: pa.Table) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
        """(labels, unit centres) of each number of clusters and start."""
        pdf = table.select(["k", "start", "label", "c"]).to_pandas().sort_values("label")
        return {key: (part["label"].to_numpy(), _unit(np.stack(part["c"].to_numpy()))) for key, part in pdf.groupby(["k", "start"])}

    def step(key: tuple[pa.Scalar, ...], points: pa.Table, around: pa.Table) -> pa.Table:
        x = _matrix(points.column("emb"))
        rows = []
        for (k, s), (labels, c) in tables(around).items():
            near = x @ c.T
            nearest = np.argmax(near, axis=1)
            loss = 1 - near[np.arange(len(x)), nearest]
            for i in np.unique(nearest):
                mine = nearest == i
                rows.append((key[0].as_py(), int(k), int(s), int(labels[i]), int(mine.sum()), x[mine].sum(0), float(loss[mine].sum())))
        names = ["grp", "k", "start", "label", "n", "total", "loss"]
        kinds = [points.schema.field("grp").type, pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.float64()]
        return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(names, kinds))})

    def label(key: tuple[pa.Scalar, ...], points: pa.Table, around: pa.Table) -> pa.Table:
        x, ids, parts = _matrix(points.column("emb")), points.column("id"), []
        for (k, _), (labels, c) in tables(around).items():
            found = labels[np.argmax(x @ c.T, axis=1)]
            parts.append(pa.table({"grp": pa.array([key[0].as_py()] * len(x), points.schema.field("grp").type), "k": pa.array([k] * len(x), pa.int32()), "id": ids, "label": pa.array(found, pa.int32())}))
        return pa.concat_tables(parts)

    meet = lambda c: placed.groupBy("grp", "block").cogroup(c.join(blocks, "grp").groupBy("grp", "block"))
    before = None
    for _ in range(rounds):
        sums = meet(centres).applyInArrow(step, f"grp {grp}, k int, start int, label int, n bigint, total array<double>, loss double")
        # sums of whole vectors by place, a row a block and cluster
        places = sums.select("grp", "k", "start", "label", "n", "loss", F.posexplode("total").alias("d", "v")).groupBy("grp", "k", "start", "label", "d").agg(F.sum("v").alias("v"), F.sum("n").alias("n"), F.sum("loss").alias("loss"))
        seen = Observation()
        whole = places.groupBy("grp", "k", "start", "label").agg(F.transform(F.array_sort(F.collect_list(F.struct("d", (F.col("v") / F.col("n")).alias("v")))), lambda e: e["v"]).alias("c"), F.max("loss").alias("loss"))
        whole = cut(whole.observe(seen, F.bit_xor(F.xxhash64("grp", "k", "start", "label", F.transform("c", lambda v: F.round(v, 9)))).alias("digest")), "kmeans-centres")
        centres, digest = whole.select("grp", "k", "start", "label", "c"), seen.get["digest"]
        if digest == before:
            break
        before = digest
    losses = whole.groupBy("grp", "k", "start").agg(F.sum("loss").alias("loss")).groupBy("grp", "k").agg(F.min_by("start", F.struct(F.round("loss", 9), "start")).alias("start"))
    return meet(centres.join(losses, ["grp", "k", "start"])).applyInArrow(label, f"grp {grp}, k int, id {number}, label int")


def _dense_mcl(m: np.ndarray, inflation: float, iterations: int, prune: float) -> np.ndarray:
    """The owner (row of the last attractor) of every column of a column-stochastic matrix; -1 where none reaches it."""
    m = m / m.sum(0, keepdims=True)
    for _ in range(iterations):
        new = (m @ m) ** inflation
        new /= new.sum(0, keepdims=True)
        top = new.max(0, keepdims=True)
        new[(new < prune) & (new != top)] = 0
        new /= new.sum(0, keepdims=True)
        same = (np.round(new, 6) == np.round(m, 6)).all()
        m = new
        if same:
            break
    attractors = np.flatnonzero(np.diag(m) > 0)
    owner = np.full(len(m), -1)
    for a in attractors:
        owner[m[a] > 0] = a
    return owner


def mcl_by_group(edges: DataFrame, inflation: float = INFLATION, iterations: int = MCL_ITERATIONS, prune: float = 1e-3) -> DataFrame:
    """`mcl`, with small groups as dense matrices in tasks and only large ones as rounds of joins."""
    edges = cut(edges.select("grp", "lo", "hi", F.col("w").cast("double").alias("w")), "mcl-edges")
    nodes = both_ways(edges).groupBy("grp").agg(F.count_distinct("src").alias("n"))
    large = nodes.where(F.col("n") > DENSE).select("grp")
    kind = dict(edges.dtypes)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = np.unique(np.concatenate([pdf["lo"], pdf["hi"]]))
        i, j = np.searchsorted(ids, pdf["lo"]), np.searchsorted(ids, pdf["hi"])
        m = np.eye(len(ids))
        m[i, j] = m[j, i] = pdf["w"]
        owner = _dense_mcl(m, inflation, iterations, prune)
        owned = owner >= 0
        return pd.DataFrame({"grp": [pdf["grp"].iloc[0]] * int(owned.sum()), "id": ids[owned], "owner": ids[owner[owned]]})

    small = edges.join(large, "grp", "left_anti").groupBy("grp").applyInPandas(run, f"grp {kind['grp']}, id {kind['lo']}, owner {kind['lo']}")
    labels = dense_labels(cut(small, "mcl-small"), "owner")
    return labels.unionByName(mcl(edges.join(large, "grp", "left_semi"), inflation, iterations, prune)) if large.take(1) else labels
