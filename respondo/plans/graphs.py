"""Queries over vectors: neighbours within a question, scaled edges, clusterings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import MAX_K, MIN_CLUSTER_SHARE
from ..functions.vectors import norm, unit
from ..operators import clustering, graph
from ..operators.evaluation import cluster_sizes, drop_small
from ..session import cut
from .base import Catalogue

catalogue = Catalogue()
_V = """v as (select survey_id || '/' || open_question_number as grp, vec_id as id, emb::double[] as emb from answer_vectors
where len(emb) = 384 and (list_max(emb) <> 0 or list_min(emb) <> 0) and survey_id is not null and open_question_number is not null)"""
_KNN = f"""{_V}, s as (select a.grp, a.id as src, b.id as dst, list_cosine_similarity(a.emb, b.emb) as sim from v a join v b on a.grp = b.grp and a.id <> b.id),
knn as (select * from (select *, row_number() over (partition by grp, src order by round(sim, 12) desc, dst) as rank from s) where rank <= 15)"""
_MEAN = f"{_KNN}, mean as (select grp, src as id, avg(sim) as mean_sim from knn group by 1, 2)"
_CSLS = f"""{_MEAN}, csls as (select * from (select k.grp, src, dst, 2 * sim - a.mean_sim - b.mean_sim as w from knn k join mean a on a.grp = k.grp and a.id = src join mean b on b.grp = k.grp and b.id = dst) where w > 0.1)"""
_SYM = "select grp, least(src, dst) as lo, greatest(src, dst) as hi, {agg} as w from {src} group by 1, 2, 3"


def vectors(t):
    rows = t("answer_vectors").where("survey_id is not null and open_question_number is not null").withColumn("grp", F.concat_ws("/", "survey_id", "open_question_number"))
    return graph.valid_vectors(rows, "grp", "vec_id", "emb", 384)


def truth(t):
    return t("answer_vectors").select(F.concat_ws("/", "survey_id", "open_question_number").alias("grp"), F.col("vec_id").alias("id"), F.col("label").alias("truth"))


def _rounded(df, *columns):
    return df.select(*[F.round(c, 6).alias(c) if c in columns else c for c in df.columns])


@catalogue.add(f"with {_KNN} select grp, src, dst, round(sim, 6) as sim, rank from knn")
def q_knn_topk(t):
    return _rounded(graph.knn(vectors(t)), "sim")


@catalogue.add(f"with {_MEAN} select grp, id, round(mean_sim, 6) as mean_sim from mean")
def q_neighbour_mean(t):
    return _rounded(graph.neighbour_mean(graph.knn(vectors(t))), "mean_sim")


@catalogue.add(f"with {_CSLS} select grp, src, dst, round(w, 6) as w from csls")
def q_csls_edges(t):
    return _rounded(graph.csls(cut(graph.knn(vectors(t)), "knn")), "w")


@catalogue.add(f"with {_CSLS}, sym as ({_SYM.format(agg='max(w)', src='csls')}) select grp, lo, hi, round(w, 6) as w from sym")
def q_edges_sym_max(t):
    return _rounded(graph.symmetric(graph.csls(cut(graph.knn(vectors(t)), "knn"))), "w")


_MEAN_SYM = f"{_KNN}, sym as ({_SYM.format(agg='sum(sim) / 2', src='knn')})"


@catalogue.add(f"with {_MEAN_SYM} select grp, lo, hi, round(w, 6) as w from sym")
def q_edges_sym_mean(t):
    return _rounded(graph.symmetric(graph.knn(vectors(t)).withColumnRenamed("sim", "w"), "mean"), "w")


@catalogue.add(f"with {_MEAN_SYM}, m as (select grp, quantile_cont(w, 0.5) as median from sym where w > 0 group by grp) select grp, lo, hi, round(w, 6) as w from sym join m using (grp) where w >= median - 1e-12")
def q_edge_median_cut(t):
    kept = graph.median_cut(graph.symmetric(graph.knn(vectors(t)).withColumnRenamed("sim", "w"), "mean"))
    return _rounded(kept.select("grp", "lo", "hi", "w"), "w")


@catalogue.add(f"""with {_KNN}, near as (select grp, 1 - sim as far from knn where rank = 1)
select grp, round(quantile_cont(far, 0.15), 6) as p15, round(quantile_cont(far, 0.25), 6) as p25, round(quantile_cont(far, 0.35), 6) as p35, round(quantile_cont(far, 0.45), 6) as p45 from near group by grp""")
def q_eps_percentiles(t):
    p = clustering.percentiles(vectors(t))
    return p.groupBy("grp").agg(*[F.round(F.max(F.when(F.col("eps_ord") == i, F.col("eps"))), 6).alias(n) for i, n in enumerate(("p15", "p25", "p35", "p45"))])


@catalogue.add(f"""with {_V}, s as (select a.grp, a.id, count(*) filter (1 - list_cosine_similarity(a.emb, b.emb) <= 0.3) as n from v a join v b on a.grp = b.grp group by 1, 2)
select grp, id from s where n >= 5""")
def q_dbscan_core(t):
    v = vectors(t)
    radii = v.select("grp").distinct().select("grp", F.lit(0).alias("eps_ord"), F.lit(0.3).alias("eps"))
    return graph.reach(v, radii).where(F.col("n") + 1 >= 5).select("grp", "id")


@catalogue.add(f"""with recursive {_V}, e as (select a.grp, a.id as x, b.id as y from v a join v b on a.grp = b.grp and a.id <> b.id where 1 - list_cosine_similarity(a.emb, b.emb) <= 0.3),
core as (select grp, x as id from e group by 1, 2 having count(*) + 1 >= 3), inner_ as (select e.grp, x, y from e join core a on a.grp = e.grp and a.id = x join core b on b.grp = e.grp and b.id = y),
reach(grp, id, head) as (select grp, id, id from core union select i.grp, i.y, r.head from reach r join inner_ i on i.grp = r.grp and i.x = r.id),
heads as (select grp, id, min(head) as head from reach group by 1, 2), lab as (select grp, id, dense_rank() over (partition by grp order by head) - 1 as label from heads),
border as (select e.grp, x as id, min(label) as label from e join lab on lab.grp = e.grp and lab.id = y group by 1, 2)
select v.grp, v.id, coalesce(lab.label, border.label, -1) as label from v left join lab using (grp, id) left join border using (grp, id)""")
def q_dbscan_labels(t):
    v = cut(vectors(t), "vectors")
    radii = v.select("grp").distinct().select("grp", F.lit(0).alias("eps_ord"), F.lit(0.3).alias("eps"))
    return graph.dbscan(v, radii, 3).select("grp", "id", "label")


@catalogue.add()
def q_mcl_labels(t):
    return clustering.scaled_mcl(cut(vectors(t), "vectors"))


@catalogue.add()
def q_mcl_backup_labels(t):
    return clustering.plain_mcl(cut(vectors(t), "vectors"))


@catalogue.add()
def q_kmeans_limited(t):
    return graph.kmeans(cut(clustering.large_enough(vectors(t)), "vectors"), MAX_K, MIN_CLUSTER_SHARE)


@catalogue.add()
def q_ensemble_best(t):
    _, winners = clustering.ensemble(cut(vectors(t), "vectors"), truth(t))
    return winners.select("grp", "method", "param_ord", "score", "grade")


@catalogue.add()
def q_estimate(t):
    return clustering.estimate(cut(vectors(t), "vectors"), truth(t))


@catalogue.add()
def q_manual_train(t):
    return clustering.trained(cut(vectors(t), "vectors"), inflation=1.8, k=10)


@catalogue.add("select vec_id, round(list_dot_product(embedding::double[], embedding::double[]), 6) as squared, len(embedding) as dim from embeddings where embedding is not null")
def q_vector_norms(t):
    return t("embeddings").where("embedding is not null").select("vec_id", F.round(norm(F.col("embedding")) * norm(F.col("embedding")), 6).alias("squared"), F.size("embedding").cast("bigint").alias("dim"))


@catalogue.add("""select vec_id, round(list_sum(list_transform(u, lambda x: x * x)), 6) as one from (
select vec_id, list_transform(embedding::double[], lambda x: x / sqrt(list_dot_product(embedding::double[], embedding::double[]))) as u from embeddings where list_dot_product(embedding::double[], embedding::double[]) > 0)""")
def q_unit_vectors(t):
    u = t("embeddings").select("vec_id", unit(F.col("embedding")).alias("u")).where("u is not null")
    return u.select("vec_id", F.round(F.aggregate("u", F.lit(0.0), lambda s, x: s + x * x), 6).alias("one"))


@catalogue.add("""with s as (select label, count(*) as n from embeddings group by label)
select count(*) filter (label <> -1) as n_clusters, cast(coalesce(sum(n) filter (label = -1), 0) as bigint) as n_noise, cast(sum(n) as bigint) as n_samples,
round(coalesce(avg(n) filter (label <> -1), 0), 6) as avg_size, coalesce(min(n) filter (label <> -1), 0) as min_size, coalesce(max(n) filter (label <> -1), 0) as max_size from s""")
def q_cluster_sizes(t):
    return cluster_sizes(t("embeddings"), [], "label")


@catalogue.add("""with s as (select label, count(*) as n from embeddings group by label), k as (select label, dense_rank() over (order by label) - 1 as new from s
where n >= (select count(*) from embeddings) * 0.1) select vec_id, coalesce(new, -1) as new_label from embeddings left join k using (label)""")
def q_small_to_singleton(t):
    rows = t("embeddings").select("vec_id", "label")
    least = rows.count() * 0.1  # one number
    return drop_small(rows, [], "label", F.lit(least)).select("vec_id", "new_label")


@catalogue.add("select vec_id, dense_rank() over (order by label) - 1 as dense from embeddings where label is not null")
def q_relabel_dense(t):
    rows = t("embeddings").where("label is not null").select(F.lit(0).alias("grp"), F.col("vec_id").alias("id"), "label")
    from pyspark.sql import Window

    names = rows.groupBy("label").agg(F.min("id").alias("head")).withColumn("dense", F.dense_rank().over(Window.partitionBy(F.lit(1)).orderBy("label")) - 1)
    return rows.join(F.broadcast(names), "label").select(F.col("id").alias("vec_id"), "dense")


@catalogue.add(f"""with {_V} select count(distinct grp) as n_questions, count(*) as n_vectors, round(count(*) / greatest(count(distinct grp), 1), 6) as per_question from v""")
def q_data_summary(t):
    return vectors(t).agg(F.count_distinct("grp").alias("n_questions"), F.count("*").alias("n_vectors"), F.round(F.count("*") / F.greatest(F.count_distinct("grp"), F.lit(1)), 6).alias("per_question"))


@catalogue.add()
def q_script_mcl_labels(t):
    return clustering.script_mcl(cut(vectors(t), "vectors"))


@catalogue.add()
def q_classified_answers(t):
    from ..functions.text import has_value, strip

    answers = t("answer_vectors").where(has_value(F.col("text"))).select("survey_id", strip(F.col("text")).alias("text"))
    return clustering.classify(answers, ["survey_id"])


@catalogue.add()
def q_auto_train(t):
    return clustering.auto_train(cut(vectors(t), "vectors"), truth(t)).select("grp", "method", "score", "grade")
