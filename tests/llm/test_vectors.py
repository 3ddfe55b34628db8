import numpy as np
import pytest
from helpers import clusters as brute_clusters
from helpers import neighbour_pairs
from pyspark.sql import functions as F

from respondo.llm import neighbours, peaks, skew


def make(seed=0, groups=6, each=30, dim=48, alone=60):
    rng = np.random.RandomState(seed)
    rows = []
    for g in range(groups):
        c = rng.randn(dim)
        rows += [(c + 0.5 * rng.randn(dim)).astype(np.float32).tolist() for _ in range(each)]
    rows += rng.randn(alone, dim).astype(np.float32).tolist()
    rng.shuffle(rows)
    rows = [(i, v) for i, v in enumerate(rows)]
    n = len(rows)
    rows += [(n, None), (n + 1, []), (n + 2, [0.0] * dim), (n + 3, [0.0] * dim), (n + 4, [1.0] * 7)]  # not usable
    rows += [(n + 5 + i, rows[3][1]) for i in range(20)]  # more copies than neighbours wanted
    rows += [(n + 30, [4 * x for x in rows[5][1]])]  # not of unit length
    return rows


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1.0, "x") for i, v in rows], "vec_id bigint, emb array<float>, far double, near string")


@pytest.fixture(scope="module")
def rows():
    return make()


def usable(rows, dim=48):
    return [(i, v) for i, v in rows if v and len(v) == dim]


def test_pairs_match_brute_force(spark, rows):
    found = {tuple(r) for r in neighbours.pairs(table(spark, rows), "vec_id", "emb", 15, 0.6).collect()}
    assert found == neighbour_pairs(usable(rows))


def test_forest_of_small_leaves_reaches_recall(spark):
    rows = make(seed=2, groups=12, each=40, alone=200)
    found = {tuple(r) for r in neighbours.pairs(table(spark, rows), "vec_id", "emb", 15, 0.6, leaf=150, visits=4, slack=0.2).collect()}
    expected = neighbour_pairs(usable(rows))
    assert len(found & expected) >= 0.9 * len(expected)


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_recall_at_the_defaults(spark, size):
    """Pairs and clusters of the real tables against brute force, with the parameters of the queries."""
    df = spark.read.parquet(f"/root/testdata/{size}/answer_vectors.parquet")
    rows = [(r.vec_id, r.emb) for r in df.select("vec_id", "emb").collect()]
    forest, _ = neighbours.fit_forest(df, "vec_id", "emb")
    assert len(forest.w) >= 2 * 10  # both trees are split at every size
    found = {tuple(r) for r in neighbours.pairs(df, "vec_id", "emb").collect()}
    expected = neighbour_pairs(rows)
    assert len(found & expected) >= 0.95 * len(expected) and len(found & expected) >= 0.95 * len(found)
    if size != "sf0.01":
        return  # the plain union takes too long
    members = {(r.head, r.key) for r in peaks.clusters(df, "vec_id", "emb").select("head", "key").collect()}
    true = brute_clusters(rows)
    assert len(members & true) >= 0.97 * len(true) and len(members & true) >= 0.97 * len(members)


def test_every_vector_gets_all_its_neighbours_without_a_floor(spark, rows):
    found = neighbours.neighbours(table(spark, rows), "vec_id", "emb", 15).groupBy("key").count().collect()
    assert len(found) == sum(any(v) for _, v in usable(rows)) and {r["count"] for r in found} == {15}


def test_many_vectors_of_one_direction_keep_the_order_of_ids(spark):
    rng = np.random.RandomState(3)
    v = rng.randn(16).astype(np.float32)
    rows = [(i, (v * np.float32(2.0 ** (i % 5) + i)).tolist()) for i in range(60)] + [(100 + i, rng.randn(16).astype(np.float32).tolist()) for i in range(30)]
    found = {}
    for r in neighbours.neighbours(table(spark, rows), "vec_id", "emb", 5, 0.6, leaf=200).collect():
        found.setdefault(r.key, set()).add(r.other)
    assert all(found[i] == {j for j in range(6 if i < 5 else 5) if j != i} for i in range(60))


def test_a_cloud_without_structure_is_still_cut(spark):
    rng = np.random.RandomState(4)
    v = rng.randn(16)
    x = neighbours.unit((v + 1e-4 * rng.randn(4000, 16)).astype(np.float32))
    forest = neighbours.Forest.fit(x[:500], 4000, 2, 200)
    _, leaf, resident = forest.route(x)
    assert np.bincount(leaf[resident]).max() <= 800 and forest.leaves >= 30


def test_trees_go_on_where_the_sample_ends():
    rng = np.random.RandomState(5)
    x = neighbours.unit(rng.randn(20_000, 16).astype(np.float32))
    forest = neighbours.Forest.fit(x[:100], 20_000, 2, 100)
    _, leaf, resident = forest.route(x, visits=3)
    assert forest.leaves >= 200 and np.median(np.bincount(leaf[resident])) < 300


def thin_bridge():
    """Two dense parts, 150 degrees apart, and two vectors between them, each like one part and like the other one."""
    rng = np.random.RandomState(11)
    a, b = np.linalg.qr(rng.randn(48, 2))[0].T
    at = lambda degrees: np.cos(np.radians(degrees)) * a + np.sin(np.radians(degrees)) * b
    rows = [(at(d) + 0.003 * rng.randn(48)).astype(np.float32).tolist() for d in (0, 150) for _ in range(20)]
    return list(enumerate(rows)) + [(50, at(49.5).astype(np.float32).tolist()), (51, at(100.5).astype(np.float32).tolist())]


def test_density_decides_what_a_thin_bridge_joins(spark, monkeypatch):
    df = table(spark, thin_bridge())
    assert len({r.head for r in peaks.clusters(df, "vec_id", "emb").collect()}) == 1  # linked through the bridge
    found = peaks.clusters(df, "vec_id", "emb", links=50, support=0.9)
    parts = {}
    for r in found.collect():
        parts.setdefault(r.head, set()).add(r.key)
        assert (r.delta == 1.0) == (r.key == r.peak)
    assert sorted(map(len, parts.values())) == [21, 21]
    whole = peaks.ranked
    monkeypatch.setattr(peaks, "ranked", lambda lists, density: whole(lists, density.withColumn("density", F.when(F.col("key") >= 50, F.col("key") + 10**12).otherwise(F.col("density")))))
    broken = {r.head for r in peaks.clusters(df, "vec_id", "emb", links=50, support=0.9).collect()}
    assert len(broken) == 1  # with the bridge as the peak of all, nothing is cut


def test_unusable_elements(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(3)] + [(9, [1.0, None, 3.0]), (10, [1.0, None, 3.0]), (11, [float("nan")] * 3), (12, [float("inf"), 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, emb array<float>")
    assert {tuple(r) for r in neighbours.pairs(df, "vec_id", "emb", 2, 0.6).collect()} == {(0, 1), (0, 2), (1, 2)}


def test_empty_tables(spark):
    df = spark.createDataFrame([], "vec_id bigint, emb array<float>")
    assert neighbours.pairs(df, "vec_id", "emb").count() == 0
    assert peaks.clusters(df, "vec_id", "emb").count() == 0
    nothing = spark.createDataFrame([(1, None), (2, [])], "vec_id bigint, emb array<float>")
    assert neighbours.pairs(nothing, "vec_id", "emb").count() == 0


def test_blocks_are_lossless():
    rng = np.random.RandomState(0)
    full = rng.randn(5, 9).astype(np.float32)
    half = (full.view(np.uint32) & 0xFFFF0000).view(np.float32)
    for x in (full, half):
        assert (neighbours.unpack(neighbours.pack(x), 5) == x).all()
    assert neighbours.pack(half)[0] == 2 and neighbours.pack(full)[0] == 4


def test_every_vector_lives_in_one_leaf_of_each_tree():
    rng = np.random.RandomState(1)
    x = neighbours.unit(rng.randn(3000, 16).astype(np.float32))
    forest = neighbours.Forest.fit(x[:1000], 3000, trees=3, leaf=300)
    row, leaf, resident = forest.route(x, visits=5, slack=0.1)
    assert (np.bincount(row[resident], minlength=3000) == 3).all()
    assert np.bincount(row).max() <= 5 and len(set(zip(row.tolist(), leaf.tolist()))) == len(row)


def test_clusters_match_brute_force(spark, rows):
    found = {tuple(r)[:2] for r in peaks.clusters(table(spark, rows), "vec_id", "emb").select("head", "key").collect()}
    assert found == brute_clusters(usable(rows))


def test_clusters_described(spark, rows):
    found = peaks.clusters(table(spark, rows), "vec_id", "emb")
    described = peaks.describe(found).collect()
    sizes = {}
    for r in found.collect():
        sizes[r.head] = sizes.get(r.head, 0) + 1
    assert {r.head: r["size"] for r in described} == sizes
    assert all(1 <= len(r.typical) <= 3 for r in described)


def test_pointers_of_a_long_chain(spark):
    df = spark.createDataFrame([(i, max(0, i - 1)) for i in range(70)] + [(100, 100)], "key bigint, parent bigint")
    assert {r.key: r.peak for r in peaks.follow(df).collect()} == {**{i: 0 for i in range(70)}, 100: 100}


def test_peaks_joined_along_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 51)], "a bigint, b bigint")
    assert {r.peak: r.top for r in peaks.join_peaks(links).collect()} == {**{i: 0 for i in range(31)}, 50: 50, 51: 50}


def test_join_with_a_hot_key(spark):
    rows = spark.range(6000).selectExpr("id", "if(id % 3 = 0, 0, id) as k")
    lookup = spark.range(6000).selectExpr("id as k", "id * 2 as v", "if(id = 0, 2000L, 1L) as n")
    for size in ("n", None):
        joined = skew.join_unique(rows, lookup, ["k"], size)
        assert joined.count() == 6000 and joined.where("v <> k * 2").count() == 0
    assert {r.k for r in skew.hot_keys(rows, ["k"], 6000).collect()} == {0}
    assert "Broadcast" in skew.join_unique(rows, lookup, ["k"])._jdf.queryExecution().optimizedPlan().toString() or "broadcast" in skew.join_unique(rows, lookup, ["k"])._jdf.queryExecution().optimizedPlan().toString()


def test_a_key_of_a_third_of_many_rows_is_found(spark):
    rows = spark.range(600_000).selectExpr("if(id % 3 = 0, 0, id) as k")
    assert {r.k for r in skew.hot_keys(rows, ["k"], 600_000).collect()} == {0}


def crowd(seed=7, each=20, dim=48):
    """Two parts of near-copies, 0.7 apart, and a few exact copies: more than LINKS nearer ones inside each."""
    rng = np.random.RandomState(seed)
    a, b = np.linalg.qr(rng.randn(dim, 2))[0].T
    centres = (a, 0.7 * a + np.sqrt(1 - 0.49) * b)
    rows = [(c + 0.005 * rng.randn(dim)).astype(np.float32).tolist() for c in centres for _ in range(each)]
    return list(enumerate(rows)) + [(100 + i, rows[1]) for i in range(5)]


def densities(rows, least=0.6):
    x = np.array([v for _, v in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = x @ x.T
    np.fill_diagonal(s, 0)
    return {i: d for (i, _), d in zip(rows, np.where(s >= least, s, 0).sum(1))}


def test_dense_parts_join_beyond_the_nearest(spark):
    rows = crowd()
    found = peaks.clusters(table(spark, rows), "vec_id", "emb").collect()
    assert {(r.head, r.key) for r in found} == brute_clusters(rows)
    expected = densities(rows)
    assert all(abs(r.density - expected[r.key]) < 2e-4 for r in found)


def test_pairs_that_meet_in_several_leaves_count_once(spark):
    rows = make(seed=2, groups=12, each=40, alone=200)[:680] + [(900 + i, v) for i, v in crowd()]
    x = neighbours.unit(np.array([v for _, v in rows], np.float32))
    forest = neighbours.Forest.fit(x, len(rows), 2, 100)
    lists = neighbours.neighbour_lists(table(spark, rows), "vec_id", "emb", forest, 48, 15, 0.6, visits=50, slack=9.0, whole=True).collect()
    expected = densities(rows)
    copies = {901: 5}  # those of a vector itself are not in the sum
    assert forest.leaves > 4 and len(lists) > 500 and max(len(r.tops) for r in lists) < 50
    assert all(abs(r.mass / 1e6 + copies.get(r.key, 0) - expected[r.key]) < 2e-4 for r in lists)


def test_every_pair_of_blocks_of_a_large_group_meets_once():
    digests = np.arange(700, dtype=np.uint64)
    for n in range(2, 11):
        cells = neighbours.Cells(1000, [(5, n * 100)], 100)
        row, cell, lives = cells.route(np.full(700, 5), digests)
        meet = np.zeros((n, n), int)
        for c in np.unique(cell):
            at = cell == c
            hosts = set((digests[row[at & lives]] % n).tolist())
            guests = set((digests[row[at & ~lives]] % n).tolist())
            assert len(hosts) == 1 and len(guests) <= neighbours.GUESTS
            for h in hosts:
                for g in guests:
                    meet[h, g] += 1
                    meet[g, h] += 1
        assert (meet + np.eye(n, dtype=int) == 1).all()


def test_pairs_of_groups_larger_than_a_block(spark):
    """A group of isotropic noise: its members' nearest are spread over all of it, so any leaf that cuts it loses some."""
    rows = make(seed=9, groups=2, each=400, alone=100)
    found = {tuple(r) for r in neighbours.pairs(table(spark, rows), "vec_id", "emb", 15, 0.6, leaf=100, block=60).collect()}
    assert found == neighbour_pairs(usable(rows))


def test_clusters_of_groups_the_forest_parts(spark):
    """Many small groups in leaves too small and too many to hold each whole."""
    rows = make(seed=10, groups=60, each=6, alone=300)
    found = {(r.head, r.key) for r in peaks.clusters(table(spark, rows), "vec_id", "emb", leaf=64, block=20).collect()}
    expected = brute_clusters(usable(rows))
    assert len(found & expected) >= 0.97 * len(expected) and len(found & expected) >= 0.97 * len(found)
    masses = {r.key: r.density for r in peaks.clusters(table(spark, rows), "vec_id", "emb", leaf=64, block=20).collect()}
    true = densities(usable(rows))
    assert sum(abs(masses[i] - true[i]) < 2e-4 for _, i in found & expected) >= 0.97 * len(found)


@pytest.mark.parametrize("block", [10_000, 60])
def test_whole_groups_are_finished_in_their_cells(spark, rows, monkeypatch, block):
    """Peaks, densities and deltas as tables of links give them; no such table is made for groups that are in one cell."""
    df = table(spark, rows + [(900 + i, v) for i, v in crowd()] + [(2000 + i, v) for i, v in make(seed=9, groups=1, each=90, alone=0)[:90]])
    found = {r.key: r for r in peaks.clusters(df, "vec_id", "emb", block=block).collect()}
    tables = {r.key: r for r in peaks.clusters(df, "vec_id", "emb", block=block, support=1e-9).collect()}
    assert len(tables) > 300 and found.keys() == tables.keys()
    assert all((r.peak, r.delta) == (tables[i].peak, tables[i].delta) and abs(r.density - tables[i].density) < 1e-5 for i, r in found.items())
    ranked, seen = peaks.ranked, []
    monkeypatch.setattr(peaks, "ranked", lambda lists, density: seen.append(density.count()) or ranked(lists, density))
    peaks.clusters(df, "vec_id", "emb", block=block).count()
    assert seen == ([] if block == 10_000 else [90])


def test_every_visitor_of_a_leaf_meets_every_resident():
    """Also one that stands among the first visitors, right behind the residents, and is like the first resident."""
    rng = np.random.RandomState(12)
    residents, visitors = rng.randn(600, 256).astype(np.float32), rng.randn(40, 256).astype(np.float32)
    visitors[:30] = residents[:30] + 0.1 * rng.randn(30, 256).astype(np.float32)
    x, ids = np.r_[residents, visitors], np.r_[np.arange(600), 1000 + np.arange(40)]
    a, b = neighbours._alike(ids, neighbours.sketches(x), np.arange(640) < 600)
    assert dict(zip(a.tolist(), b.tolist())) == {1000 + i: i for i in range(30)}
    assert not len(neighbours._alike(ids, neighbours.sketches(x), np.zeros(640, bool))[0])  # nobody is at home


def test_rows_multiplied_by_threes_are_counted_exactly():
    rng = np.random.RandomState(13)
    a, b = neighbours.sketches(rng.randn(100, 16).astype(np.float32)), neighbours.sketches(rng.randn(70, 16).astype(np.float32))
    a[4], a[5] = b[7], ~b[7]  # the ends of what a digit can be
    signs = lambda s: np.unpackbits(s.view(np.uint8), axis=1)[:, : neighbours._FIRST]
    apart = (signs(a)[:, None] != signs(b)[None]).sum(2)
    rows, cols = neighbours._roughly_alike(neighbours._signs(a), neighbours._signs(b).T)
    assert sorted(zip(rows.tolist(), cols.tolist())) == list(zip(*(i.tolist() for i in np.nonzero(apart <= neighbours._ROUGHLY)))) and len(rows) > 100
    assert (neighbours._apart(a[:70], b) == np.unpackbits((a[:70] ^ b).view(np.uint8), axis=1).sum(1)).all()


def test_links_that_are_joined_leave_the_next_round(spark, monkeypatch):
    """Combs: two ends that point to different tops are joined by their tops, not by all of their links once more."""
    rows = [(10 * g + i, 10 * g) for g in range(40) for i in range(1, 9)] + [(10 * g + 8, 10 * g + 11) for g in range(19)] + [(10 * g + 8, 10 * g + 11) for g in range(20, 39)]
    counts, whole = [], peaks._round
    monkeypatch.setattr(peaks, "_round", lambda df, name, still_open: (lambda r: counts.append((name, r[0].count())) or r)(whole(df, name, still_open)))
    found = {r.peak: r.top for r in peaks.join_peaks(spark.createDataFrame(rows, "a bigint, b bigint")).collect()}
    assert found == {10 * g + i: 0 if g < 20 else 200 for g in range(40) for i in range(9)}
    links = [n for name, n in counts if name == "peak-links"]
    assert links[0] == len(rows) and links[-1] == 0 and sum(links) <= 2 * len(rows)
