"""Clusters of mutually similar vectors by density peaks.

Neighbour joins run blocked: a random-projection forest finds which vectors are linked, and the vectors of what is linked, directly or through others,
are compared in blocks, so no pair of blocks meets that has nothing in common. The density of a vector is the sum of
its cosines with all similar vectors, copies included. Its delta is the distance to the nearest denser vector
among those it is linked with, which is where its pointer goes (of equal densities, that of smaller key is denser); a vector that is linked with
no denser one has the greatest delta, 1, and is a peak. Pointers are followed by doubling - after r rounds a pointer has covered
2^r steps - until each vector knows its peak, which is its group.

Groups that touch are tops of one cluster where the density at their border supports it: the border density of two groups is
the largest density of the sparser end of a link between them, and they are united if it is at least `support` times the density of the
lower of the two peaks. With the default, 0, any link supports a union, and clusters are what is linked directly or through others; with
more, thin bridges do not join dense groups. For support 0 all similar pairs count, not those of the lists alone: each leaf joins
them to components before it cuts its lists to the nearest.

For support 0 a group that is whole in one cell is finished there (`settled`): density, delta, pointers, peak and cluster of each of its
vectors come out of the cell, and no table of links. What groups cut into blocks still need works on narrow rows of keys, cut from their lineage each round."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..operators.graph import join_all
from ..session import cut
from .neighbours import FLOOR, SETTLED, SLACK, AllPairs, copy_groups, fit_forest, grouped, grouped_lists, merged_lists, neighbour_lists
from .skew import join_unique

#: Neighbours a pointer chooses from, on each side; density and clusters come from all similar pairs.
LINKS = 15
#: Leaves a vector visits below the floor from which whole groups are compared.
VISITS = 3
#: The delta of a peak, in units of 1e-9.
FARTHEST = 1_000_000_000


def _round(df: DataFrame, name: str, still_open) -> tuple[DataFrame, int]:
    """`df` cut from its lineage, and how many of its rows are open, counted as they are written."""
    seen = Observation()
    done = cut(df.observe(seen, F.count_if(still_open).alias("n")), name)
    return done, seen.get["n"]


def follow(pointers: DataFrame) -> DataFrame:
    """(key, peak) from (key, parent), where a peak is its own parent, by pointer doubling.

    Rows that have reached a peak do not move any more, so a peak with a large share of all rows below it
    is never a join key of more rows than still have to reach it."""
    state, n = _round(pointers.select("key", "parent", (F.col("key") == F.col("parent")).alias("done")), "pointers", ~F.col("done"))
    while n:
        ahead = state.select(F.col("key").alias("parent"), F.col("parent").alias("next"), F.col("done").alias("next_done"))
        moved = join_unique(state.where(~F.col("done")).select("key", "parent"), ahead, ["parent"], total=n)
        # a pointer to a peak is done; a pointer to a row that is done itself takes over its peak
        stepped = moved.select("key", F.col("next").alias("parent"), "next_done")
        state, n = _round(state.where("done").unionByName(stepped.withColumnRenamed("next_done", "done")), "pointers", ~F.col("done"))
    return state.select("key", F.col("parent").alias("peak"))


def join_peaks(links: DataFrame) -> DataFrame:
    """(peak, top): for every peak in `links` (a, b), the smallest peak it is linked with, directly or
    through others. Each peak points to the smallest one it is linked with, pointers are followed, and only the links between
    different ends go on to the next round, as links of these ends, of which at least half disappear each time."""
    edges, n = _round(links.select(F.greatest("a", "b").alias("key"), F.least("a", "b").alias("other")).distinct(), "peak-links", F.lit(True))
    tops = None
    while True:
        ends = edges.select("key", "other").unionByName(edges.select(F.col("other").alias("key"), "other"))
        roots = follow(ends.groupBy("key").agg(F.min("other").alias("parent")))
        if tops is None:
            tops = roots.withColumnRenamed("peak", "top")
        else:  # few are left after the first round
            moved = roots.select(F.col("key").alias("top"), F.col("peak").alias("next"))
            all_tops = tops.where("key = top").select("top").join(moved, "top", "left").select("top", F.coalesce("next", "top").alias("next"))
            tops = cut(join_unique(tops, all_tops, ["top"]).select("key", F.col("next").alias("top")), "peak-tops")
        one = join_unique(edges, roots, ["key"], total=n).select("other", F.col("peak").alias("a"))
        two = join_unique(one, roots.select(F.col("key").alias("other"), F.col("peak").alias("b")), ["other"], total=n).where("a <> b")
        edges, n = _round(two.select(F.greatest("a", "b").alias("key"), F.least("a", "b").alias("other")).distinct(), "peak-links", F.lit(True))
        if not n:
            return tops.withColumnRenamed("key", "peak")


def ranked(lists: DataFrame, density: DataFrame) -> DataFrame:
    """(key, density, delta, parent): every vector with the distance to, and the key of, the nearest denser one it is
    linked with; a peak has the greatest delta and is its own parent. `lists` is (key, near), `density` (key, density)."""
    # of the two ends of a link, the less dense one may point to the other, whichever list it stands in
    linked = lists.join(density, "key").select("key", "density", F.explode("near").alias("n")).select("key", "density", F.col("n.key").alias("other"), F.col("n.far").alias("far"))
    rated = join_unique(linked, density.select(F.col("key").alias("other"), F.col("density").alias("other_density")), ["other"])
    up = (F.col("other_density") > F.col("density")) | ((F.col("other_density") == F.col("density")) & (F.col("other") < F.col("key")))
    toward = rated.select(F.when(up, F.col("key")).otherwise(F.col("other")).alias("key"), "far", F.when(up, F.col("other")).otherwise(F.col("key")).alias("parent"))
    nearest = toward.groupBy("key").agg(F.min(F.struct("far", "parent")).alias("n")).select("key", F.col("n.far").alias("far"), F.col("n.parent").alias("parent"))
    return density.join(nearest, "key", "left").select("key", "density", F.coalesce("far", F.lit(FARTHEST)).alias("delta"), F.coalesce("parent", "key").alias("parent"))


def settled(copies: list[np.ndarray], pairs: AllPairs, one: np.ndarray, other: np.ndarray, far: np.ndarray, least_size: int) -> list[pa.Array]:
    """(key, head, peak, density, delta) of the vectors of whole groups, one row a member of a cluster of at least `least_size`: what `ranked`,
    `follow` and `join_peaks` find with support 0. `copies` has the keys of each distinct vector, in order; `pairs` has met
    all pairs; `one`, `other` and `far` are the links of the lists, by first keys."""
    numbers = np.array([c[0] for c in copies], np.int64)
    weights = np.array([len(c) for c in copies], np.int64)
    density = np.rint(pairs.mass * 1e6).astype(np.int64) + (weights - 1) * 1_000_000
    by = np.argsort(numbers)
    a, b = (by[np.searchsorted(numbers, keys, sorter=by)] for keys in (one, other))
    up = (density[b] > density[a]) | ((density[b] == density[a]) & (numbers[b] < numbers[a]))
    low, high = np.where(up, a, b), np.where(up, b, a)
    order = np.lexsort((numbers[high], far, low))
    nearest = order[np.r_[True, low[order][1:] != low[order][:-1]][: len(order)]]
    parent, delta = np.arange(len(numbers)), np.full(len(numbers), FARTHEST)
    parent[low[nearest]], delta[low[nearest]] = high[nearest], far[nearest]
    while (parent[parent] != parent).any():
        parent = parent[parent]
    root = pairs.root
    join_all(root, low, high)
    head = np.full(len(numbers), np.iinfo(np.int64).max)
    np.minimum.at(head, root, numbers)
    size = np.zeros(len(numbers), np.int64)
    np.add.at(size, root, weights)
    of = np.repeat(np.arange(len(numbers)), weights)
    first = np.r_[True, of[1:] != of[:-1]][: len(of)]
    fine = size[root[of]] >= least_size
    of, first = of[fine], first[fine]
    return [pa.array(c, pa.int64()) for c in (np.concatenate(copies)[fine], head[root[of]], numbers[parent[of]], density[of], np.where(first, delta[of], 0))]


def _supported(links: DataFrame, placed: DataFrame, support: float) -> DataFrame:
    """(a, b): pairs of peaks whose groups are linked, with enough density at their border. `links` is (key, other),
    `placed` (key, density, peak)."""
    one = join_unique(links, placed.select(F.col("key").alias("other"), F.col("peak").alias("b"), F.col("density").alias("db")), ["other"])
    two = one.join(placed.select("key", F.col("peak").alias("a"), F.col("density").alias("da")), "key").where("a <> b")
    touching = two.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max(F.least("da", "db")).alias("border"))
    if support <= 0:
        return touching.select("a", "b")
    tops = placed.where("key = peak")
    both = touching.join(tops.select(F.col("key").alias("a"), F.col("density").alias("pa")), "a").join(tops.select(F.col("key").alias("b"), F.col("density").alias("pb")), "b")
    return both.where(F.col("border") >= support * F.least("pa", "pb")).select("a", "b")


def clusters(df: DataFrame, key: str, emb: str, similar: float = 0.6, least_size: int = 5, links: int = LINKS, support: float = 0.0, visits: int | None = None, **options) -> DataFrame:
    """(head, key, peak, density, delta): one row per member of every cluster of at least `least_size` vectors; head is the
    smallest key of the cluster, peak that of its group's peak. With support 0, two vectors belong together if their cosine is at least `similar`,
    directly or through other members.

    Density is the sum of the cosines with all other members of at least `similar`, each copy counted.
    Exact copies count as members of one density; null, empty, all-zero, non-finite and odd-length vectors and null keys belong
    to none. Equal densities and cosines go by smaller key. An empty table gives no rows."""
    if similar >= FLOOR and support <= 0:
        placed, cells, dim = grouped(df, key, emb, visits=visits, **options)
        finish = lambda *cell: settled(*cell, least_size=least_size)
        found = neighbour_lists(placed, "key", "emb", None, dim, links, similar, whole=True, cells=cells, settle=finish)
        if cells.large:  # a few groups at most
            found = cut(found, "cluster-cells")
        members = _in_units(found.where(F.col("head").isNotNull()).select("key", *SETTLED))
        if not cells.large:
            return members
        lists = cut(merged_lists(found.where(F.col("head").isNull()), links, True), "neighbour-lists")
        copies = copy_groups(placed.where(F.col("top").isin(list(cells.large))), "key", "emb", dim)
        return members.unionByName(_of_lists(lists, copies, least_size, support))
    if similar >= FLOOR:
        lists, dim = grouped_lists(df, key, emb, links, similar, visits=visits, whole=True, **options)
    else:
        forest, dim = fit_forest(df, key, emb)
        lists = cut(neighbour_lists(df, key, emb, forest, dim, links, similar, visits or VISITS, options.get("slack", SLACK), True), "cluster-lists")
    return _of_lists(lists, copy_groups(df, key, emb, dim), least_size, support)


def _in_units(members: DataFrame) -> DataFrame:
    return members.select("head", "key", "peak", (F.col("density") / 1e6).alias("density"), (F.col("delta") / 1e9).alias("delta"))


def _of_lists(lists: DataFrame, copies: DataFrame, least_size: int, support: float) -> DataFrame:
    """The clusters of the vectors in `lists` (key, near, mass, tops) and of their `copies` (key, head)."""
    multiplicity = copies.groupBy("head").agg(F.count("*").alias("n"))
    # density in whole units, so that it is the same in whatever order it is summed
    density = lists.select("key", F.col("mass").alias("density")).join(multiplicity, F.col("key") == F.col("head"), "full").select(
        F.coalesce("key", "head").alias("key"), (F.coalesce("density", F.lit(0)) + (F.coalesce("n", F.lit(1)) - 1) * 1_000_000).alias("density")
    )
    density = cut(density, "cluster-density")
    placed = cut(ranked(lists.select("key", "near"), density), "cluster-deltas")
    peaks = follow(placed.select("key", "parent"))
    placed = cut(placed.join(peaks, "key").select("key", "density", "delta", "peak"), "cluster-peaks")
    if support <= 0:  # a leaf's component names its smallest key once for each member
        between = lists.select("key", F.explode("tops").alias("other")).where("key <> other")
    else:
        between = lists.select("key", F.explode("near").alias("n")).select("key", F.col("n.key").alias("other"))
    tops = join_peaks(_supported(between, placed, support))
    members = placed.join(tops, "peak", "left").select("key", "peak", "density", "delta", F.coalesce("top", "peak").alias("top"))
    others = join_unique(copies.where("key <> head"), members.withColumnRenamed("key", "head"), ["head"]).select("key", "peak", "density", F.lit(0).cast("bigint").alias("delta"), "top")
    members = cut(members.unionByName(others), "cluster-members")
    sizes = members.groupBy("top").agg(F.count("*").alias("n"), F.min("key").alias("head")).where(F.col("n") >= least_size)
    return _in_units(join_unique(members, sizes, ["top"], "n"))


def describe(found: DataFrame, typical: int = 3) -> DataFrame:
    """(head, size, n_peaks, typical array<key>): each cluster's size, its number of density peaks and its densest
    members, by smaller key where densities are equal."""
    sizes = found.groupBy("head").agg(F.count("*").alias("size"), F.count_if(F.col("key") == F.col("peak")).alias("n_peaks"))
    best = found.withColumn("r", F.row_number().over(Window.partitionBy("head").orderBy(F.desc("density"), "key"))).where(F.col("r") <= typical)
    top = best.groupBy("head").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "key"))), lambda x: x["key"]).alias("typical"))
    return sizes.join(top, "head")
