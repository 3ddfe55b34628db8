import numpy as np
import pytest
from pyspark.sql import functions as F

from respondo.operators import clustering, evaluation, graph


def points(seed=0, groups=("a",), centres=4, each=12, dim=16):
    rng = np.random.RandomState(seed)
    rows = []
    for g in groups:
        c = rng.randn(centres, dim)
        for i in range(centres * each):
            rows.append((g, i, (c[i % centres] + 0.15 * rng.randn(dim)).tolist(), str(i % centres)))
    return rows


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(points(groups=("a", "b")), "grp string, id bigint, emb array<double>, truth string").cache()


def brute_knn(rows, k):
    out = set()
    for g in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == g]
        x = np.array([r[2] for r in own])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        s = x @ x.T
        for i, r in enumerate(own):
            order = sorted((j for j in range(len(own)) if j != i), key=lambda j: (-round(s[i, j], 12), own[j][1]))[:k]
            out |= {(g, r[1], own[j][1]) for j in order}
    return out


@pytest.mark.parametrize("block", [2048, 10])
def test_knn_matches_brute_force_in_any_blocking(vectors, block):
    rows = points(groups=("a", "b"))
    found = {(r.grp, r.src, r.dst) for r in graph.knn(vectors.select("grp", "id", "emb"), 5, block).collect()}
    assert found == brute_knn(rows, 5)


def test_duplicates_leave_themselves_out_by_id(spark):
    df = spark.createDataFrame([("g", i, [1.0, 0.0]) for i in range(4)], "grp string, id bigint, emb array<double>")
    found = {(r.src, r.dst) for r in graph.knn(df, 2).collect()}
    assert found == {(0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1), (3, 0), (3, 1)}


def test_mcl_both_ways_agree_and_find_the_groups(vectors):
    edges = graph.symmetric(graph.csls(graph.knn(vectors.select("grp", "id", "emb"), 8)))
    dense = {(r.grp, r.id, r.label) for r in graph.mcl_by_group(edges).collect()}
    joined = {(r.grp, r.id, r.label) for r in graph.mcl(edges, iterations=30).collect()}
    assert dense == joined
    by_label = {}
    for g, i, label in dense:
        by_label.setdefault((g, label), set()).add(i % 4)
    assert all(len(v) == 1 for v in by_label.values())


def brute_dbscan(rows, eps, least):
    x = np.array([r[2] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = 1 - x @ x.T <= eps
    core = near.sum(1) >= least
    label, n = {}, 0
    for i in range(len(rows)):
        if core[i] and i not in label:
            stack = [i]
            while stack:
                j = stack.pop()
                if j in label:
                    continue
                label[j] = n
                stack += [m for m in np.flatnonzero(near[j]) if core[m] and m not in label]
            n += 1
    return {i: label[i] if i in label else min((label[j] for j in np.flatnonzero(near[i]) if j in label and core[j]), default=-1) for i in range(len(rows))}


@pytest.mark.parametrize("eps,least", [(0.05, 3), (0.02, 5), (0.5, 3)])
def test_dbscan_matches_brute_force(spark, eps, least):
    rows = points(seed=3)
    df = spark.createDataFrame(rows, "grp string, id bigint, emb array<double>, truth string").select("grp", "id", "emb")
    radii = spark.createDataFrame([("a", 0, eps)], "grp string, eps_ord int, eps double")
    assert {r.id: r.label for r in graph.dbscan(df, radii, least, block=17).collect()} == brute_dbscan(rows, eps, least)


def test_kmeans_small_and_large_groups_agree(vectors, monkeypatch):
    own = vectors.select("grp", "id", "emb")
    small = {(r.grp, r.k, r.id, r.label) for r in graph.kmeans(own, 3, 0.0, rounds=6).collect()}
    monkeypatch.setattr(graph, "DENSE", 10)
    large = {(r.grp, r.k, r.id, r.label) for r in graph.kmeans(own, 3, 0.0, rounds=6).collect()}
    assert small == large


def test_components_of_a_long_path(spark):
    nodes = spark.range(40).select(F.lit("g").alias("grp"), F.col("id"))
    edges = spark.range(39).where("id <> 20").select(F.lit("g").alias("grp"), F.col("id").alias("lo"), (F.col("id") + 1).alias("hi"))
    assert {r.id: r.head for r in graph.components(nodes, edges).collect()} == {i: 0 if i <= 20 else 21 for i in range(40)}


TRUE = [0, 0, 0, 1, 1, 1, 2, 2, 2, 3, 3, 3]


@pytest.mark.parametrize("found,nmi,ari", [(TRUE, 1.0, 1.0), ([0, 0, 1, 1, 1, 1, 2, 2, 2, 3, 3, 3], 0.873710, 0.753363), (list(range(12)), 0.716209, 0.0)])
def test_nmi_and_ari(spark, found, nmi, ari):
    df = spark.createDataFrame(list(zip(TRUE, found)), "t int, p int")
    row = evaluation.agreement(evaluation.contingency(df, [], "t", "p"), []).collect()[0]
    assert abs(row.nmi - nmi) < 1e-6 and abs(row.ari - ari) < 1e-6


def test_scores_fall_with_noise_and_ignore_names(spark):
    rng = np.random.RandomState(1)
    true = np.repeat(range(4), 15)
    score = {}
    for share in (0.0, 0.1, 0.3, 1.0):
        found = np.where(rng.rand(60) < share, rng.randint(0, 6, 60), true)
        for name, labels in ((share, found), (f"{share} renamed", 7 - found)):
            df = spark.createDataFrame([(1, str(a), int(b)) for a, b in zip(true, labels)], "g int, t string, p int")
            score[name] = evaluation.scores(df, ["g"], "t", "p").collect()[0].score
        assert abs(score[share] - score[f"{share} renamed"]) < 1e-9
    assert 1.0 == score[0.0] >= score[0.1] >= score[0.3] >= score[1.0]


def test_no_valid_labels_score_zero(spark):
    df = spark.createDataFrame([(1, "a", -1), (1, "b", -1)], "g int, t string, p int")
    row = evaluation.scores(df, ["g"], "t", "p").collect()[0]
    assert (row.n_valid, row.score, row.grade) == (0, 0.0, "FAIL")


def test_small_clusters_become_single(spark):
    df = spark.createDataFrame([(5, i) for i in range(4)] + [(7, 9)] + [(8, 10 + i) for i in range(3)], "label int, id int")
    assert {r.id: r.new_label for r in evaluation.drop_small(df, [], "label", F.lit(2)).collect()} == {0: 0, 1: 0, 2: 0, 3: 0, 9: -1, 10: 1, 11: 1, 12: 1}


def test_ensemble_finds_the_groups(spark):
    df = spark.createDataFrame(points(seed=5), "grp string, id bigint, emb array<double>, truth string")
    labels, winners = clustering.ensemble(df, df.select("grp", "id", "truth"))
    row = winners.collect()[0]
    assert row.score > 0.9
    assert labels.count() == 48


def test_groups_below_five_have_no_clustering(spark):
    df = spark.createDataFrame(points(centres=1, each=4), "grp string, id bigint, emb array<double>, truth string")
    assert clustering.manual_train(df).count() == 0


def test_groups_below_five_take_part_in_the_ensemble(spark):
    rows = [("four", i, [1.0, 0.01 * i] if i < 2 else [0.01 * i, 1.0], str(i // 2)) for i in range(4)]
    rows += [("two", i, [1.0, 0.1 * i], "0") for i in range(2)] + [("one", 0, [1.0, 0.0], "0")]
    df = spark.createDataFrame(rows + points(centres=2, each=4, dim=2), "grp string, id bigint, emb array<double>, truth string")
    labels, winners = clustering.ensemble(df, df.select("grp", "id", "truth"))
    methods = {r.grp: r.method for r in winners.collect()}
    assert set(methods) == {"four", "two", "one", "a"} and methods["one"] == "fallback_kmeans"
    assert labels.count() == len(rows) + 8
    assert {r.label for r in labels.where("grp = 'one'").collect()} == {0}
    assert {(r.grp, r.label) for r in clustering.trained(df).where("grp <> 'a'").collect()} == {("four", -1), ("two", -1), ("one", -1)}


def test_row_ordinals_are_a_permutation_over_many_partitions(spark):
    from respondo.operators.columns import ordinals

    df = spark.range(2_200_000).select(F.xxhash64("id").alias("h"), "id")
    numbered = ordinals(df, ["h"], "n")
    row = numbered.agg(F.count("*").alias("rows"), F.count_distinct("n").alias("distinct"), F.min("n").alias("lo"), F.max("n").alias("hi")).collect()[0]
    assert tuple(row) == (2_200_000, 2_200_000, 0, 2_199_999)
    first = [r.h for r in numbered.orderBy("n").limit(50).collect()]
    assert first == sorted(first) and first == [r.h for r in df.orderBy("h").limit(50).collect()]


def test_row_ordinals_of_nothing_and_of_ties(spark):
    from respondo.operators.columns import ordinals

    assert ordinals(spark.createDataFrame([], "a int"), ["a"]).count() == 0
    assert sorted(r.id for r in ordinals(spark.createDataFrame([(None,), (1,), (1,)], "a int"), ["a"]).collect()) == [0, 1, 2]


def test_a_column_that_no_attractor_reaches_has_no_cluster():
    m = np.array([[1.0, 0.0, 0.0], [0.0, 0.0, 1.0], [0.0, 1.0, 0.0]])
    assert graph._dense_mcl(m, 2.0, 1, 1e-3).tolist()[0] == 0
    flipped = graph._dense_mcl(np.array([[0.0, 1.0], [1.0, 0.0]]), 2.0, 0, 1e-3)
    assert flipped.tolist() == [-1, -1]


def test_dense_groups_give_a_link_a_point_and_not_all_pairs(spark):
    df = spark.createDataFrame([("g", i, [1.0, 0.0001 * i]) for i in range(200)], "grp string, id bigint, emb array<double>")
    radii = spark.createDataFrame([("g", 0, 0.5)], "grp string, eps_ord int, eps double")
    cores = df.select("grp", "id", F.array(F.struct(F.lit(0).alias("eps_ord"), F.lit(3).alias("least"))).alias("settings"))
    assert graph.density_links(df, radii, cores).count() == 199
    assert {r.n for r in graph.reach(df, radii, block=64).collect()} == {199}


def test_density_grid_equals_single_runs(spark):
    rows = points(seed=4)
    df = spark.createDataFrame(rows, "grp string, id bigint, emb array<double>, truth string").select("grp", "id", "emb")
    radii = spark.createDataFrame([("a", i, e) for i, e in enumerate((0.01, 0.03, 0.3))], "grp string, eps_ord int, eps double")
    found = {}
    for r in graph.dbscan_grid(df, radii, [2, 4], block=20).collect():
        found.setdefault((r.eps_ord, r.least), {})[r.id] = r.label
    assert found == {(i, n): brute_dbscan(rows, e, n) for i, e in enumerate((0.01, 0.03, 0.3)) for n in (2, 4)}


@pytest.mark.parametrize("method", ["consensus", "kmeans", "hierarchical"])
def test_made_up_truths_separate_groups(spark, method):
    df = spark.createDataFrame(points(seed=6, centres=3, each=20), "grp string, id bigint, emb array<double>, truth string")
    found = clustering.synthetic_truth(df, method).join(df.select("id", F.col("truth").alias("true")), "id")
    homes = found.groupBy("truth").agg(F.count_distinct("true").alias("n")).collect()
    assert found.count() == 60 and len(homes) >= 3 and all(r.n == 1 for r in homes)


def test_an_unknown_truth_is_an_error(vectors):
    with pytest.raises(ValueError):
        clustering.synthetic_truth(vectors, "guess")


def test_the_service_reports_what_it_did(vectors):
    truth = vectors.select("grp", "id", "truth")
    done = clustering.serve(vectors, truth, "manual_train")
    assert done.status == "completed" and done.summary == {"groups": 2, "vectors": 96, "per_group": 48.0} and done.rows.count() == 96
    failed = clustering.serve(vectors, truth, "guess")
    assert failed.status == "failed" and "guess" in failed.error and failed.rows is None
