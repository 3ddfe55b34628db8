"""Queries that compare labelings and describe clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import COARSE_GRADES, LAST_COARSE_GRADE
from ..functions.numbers import grade
from ..operators import evaluation as ops
from .base import Catalogue, stripped

catalogue = Catalogue()
#: Human code against the answer's text as its own label, per survey; unlabelled rows carry -1.
_ROWS = f"""r as (select vec_id, survey_id, coalesce(label, '-1') as truth, cast(abs(hash(1)) * 0 + length({stripped("coalesce(text, '')")}) % 7 as varchar) as found from answer_vectors where survey_id is not null)"""
_ROWS = _ROWS.replace("abs(hash(1)) * 0 + ", "")
_CELLS = f"{_ROWS}, cells as (select survey_id, truth as t, found as p, count(*) as n from r where truth <> '-1' group by 1, 2, 3)"
_AGREE = f"""{_CELLS}, m as (select *, sum(n) over (partition by survey_id, t) as a, sum(n) over (partition by survey_id, p) as b, sum(n) over (partition by survey_id) as s from cells),
x as (select survey_id, max(s)::double as n, sum(n / s * ln(s * n / (a * b)::double)) as mi, sum(-n / s * ln(a / s)) as hu, sum(-n / s * ln(b / s)) as hv,
  sum(n * (n - 1) / 2.0) as cn, sum(n / a * (a * (a - 1) / 2.0)) as ca, sum(n / b * (b * (b - 1) / 2.0)) as cb from m group by survey_id),
y as (select *, case when n < 2 then null else ca * cb / (n * (n - 1) / 2.0) end as e from x),
agree as (select survey_id, n, case when hu + hv < 1e-15 then 1.0 else greatest(0.0, mi) / ((hu + hv) / 2) end as nmi,
  case when e is null or abs((ca + cb) / 2 - e) < 1e-12 then 1.0 else (cn - e) / ((ca + cb) / 2 - e) end as ari from y)"""
_SCORES = f"""{_AGREE}, total as (select survey_id, count(*) as n_total from r group by survey_id),
j as (select survey_id, n_total, coalesce(n, 0)::bigint as n_valid, coalesce(n, 0) >= 2 as ok, nmi, ari from total left join agree using (survey_id)),
scores as (select survey_id, n_total, n_valid, case when ok then n_valid / n_total else 0 end as coverage, case when ok then nmi else 0 end as nmi, case when ok then ari else 0 end as ari from j),
graded as (select *, ari * coverage as adjusted_ari, 0.6 * nmi + 0.4 * ari * coverage as score from scores)"""
_GRADE = "case when score >= 0.96 then 'EXCELLENT' when score >= 0.88 then 'GOOD' when score >= 0.83 then 'FAIR' when score >= 0.72 then 'IMPROVE' else 'FAIL' end"


def rows(t):
    from ..functions.text import strip

    found = (F.length(strip(F.coalesce("text", F.lit("")))) % 7).cast("string")
    return t("answer_vectors").where("survey_id is not null").select("vec_id", "survey_id", F.coalesce("label", F.lit("-1")).alias("truth"), found.alias("found"))


@catalogue.add(f"with {_CELLS} select survey_id, t, p, n from cells")
def q_contingency(t):
    return ops.contingency(rows(t), ["survey_id"], "truth", "found")


@catalogue.add(f"with {_AGREE} select survey_id, round(nmi, 6) as nmi from agree")
def q_nmi(t):
    return ops.agreement(ops.contingency(rows(t), ["survey_id"], "truth", "found"), ["survey_id"]).select("survey_id", F.round("nmi", 6).alias("nmi"))


@catalogue.add(f"with {_AGREE} select survey_id, round(ari, 6) as ari from agree")
def q_ari(t):
    return ops.agreement(ops.contingency(rows(t), ["survey_id"], "truth", "found"), ["survey_id"]).select("survey_id", F.round("ari", 6).alias("ari"))


@catalogue.add(f"with {_SCORES} select survey_id, n_total, n_valid, round(coverage, 6) as coverage, round(nmi, 6) as nmi, round(ari, 6) as ari, round(adjusted_ari, 6) as adjusted_ari, round(score, 6) as score, {_GRADE} as grade from graded")
def q_combined_score(t):
    return ops.scores(rows(t), ["survey_id"], "truth", "found")


@catalogue.add("select vec_id, case when label >= 9 then 'A' when label >= 6 then 'B' when label >= 4 then 'C' when label >= 2 then 'D' else 'F' end as coarse from (select vec_id, label * 1.0 as label from embeddings where label is not null)")
def q_quality_grade(t):
    steps = [(x * 10 if x != 0.8 else 9, n) for x, n in COARSE_GRADES]
    return t("embeddings").where("label is not null").select("vec_id", grade(F.col("label"), [(round(s, 6), n) for s, n in steps], LAST_COARSE_GRADE).alias("coarse"))


@catalogue.add("select survey_id, count(*) as n, count(label) as n_valid from answer_vectors group by survey_id")
def q_valid_mask(t):
    return t("answer_vectors").groupBy("survey_id").agg(F.count("*").alias("n"), F.count("label").alias("n_valid"))


@catalogue.add(f"with {_SCORES}, h as (select {_GRADE} as grade, count(*) as n from graded group by 1) select g as grade, coalesce(n, 0) as n from (select unnest(['EXCELLENT', 'GOOD', 'FAIR', 'IMPROVE', 'FAIL']) as g) left join h on h.grade = g")
def q_grade_histogram(t):
    scored = ops.scores(rows(t), ["survey_id"], "truth", "found")
    names = F.array(*map(F.lit, ["EXCELLENT", "GOOD", "FAIR", "IMPROVE", "FAIL"]))
    counts = scored.groupBy("grade").agg(F.count("*").alias("m"))
    grades = scored.sparkSession.range(1).select(F.explode(names).alias("grade"))
    return grades.join(counts, "grade", "left").select("grade", F.coalesce("m", F.lit(0)).alias("n"))


@catalogue.add("""select survey_id, label, count(*) as n, arg_max(text, (length(text), -vec_id)) as representative from answer_vectors where text is not null and label is not null group by 1, 2""")
def q_cluster_representative(t):
    return ops.representatives(t("answer_vectors").where("label is not null"), ["survey_id", "label"], "text", "vec_id")


@catalogue.add("""with d as (select label, text, count(*) as m, min(vec_id) as f from answer_vectors where label is not null and text is not null group by 1, 2)
select label, cast(sum(m) as bigint) as n, count(*) as n_texts, arg_max(text, (length(text), -f)) as representative from d group by label""")
def q_mapping_table(t):
    found = ops.mapping_table(t("answer_vectors").where("label is not null"), ["label"], "text", "vec_id")
    return found.select("label", "n", "n_texts", "representative")


@catalogue.add(r"""with items as (select vec_id, coalesce(slot, '') as c, cast(regexp_extract(label, '\d+') as bigint) as l, text from answer_vectors where label is not null and text is not null),
reps as (select c, l, arg_max(text, (length(text), -vec_id)) as rep from items group by 1, 2),
words as (select c, l, unnest(list_filter(regexp_split_to_array(lower(rep), '[^\p{L}\p{N}\p{M}_]+'), lambda w: w <> '')) as w from reps),
tf as (select c, l, w, count(*) as tf from words group by 1, 2, 3), df as (select w, count(*) as df from tf group by w),
x as (select c, l, w, tf * (ln((1 + (select count(*) from reps)) / (1 + df)) + 1) as x from tf join df using (w)), len as (select c, l, sqrt(sum(x * x)) as len from x group by 1, 2),
u as (select c, l, w, x / len as x from x join len using (c, l)),
s as (select a.c, a.l, b.l as bl, round(sum(a.x * b.x), 9) as sim from u a join u b using (w) where a.c <> 'text_1' and b.c = 'text_1' group by 1, 2, 3),
best as (select * from (select *, row_number() over (partition by c, l order by sim desc, bl) as r from s) where r = 1)
select reps.c as slot, reps.l as label, coalesce(bl, -1) as base_label, round(coalesce(sim, 0), 6) as sim from reps left join best using (c, l) where reps.c <> 'text_1'""")
def q_label_match(t):
    items = t("answer_vectors").where("label is not null and text is not null").select(
        "vec_id", F.coalesce("slot", F.lit("")).alias("slot"), F.regexp_extract("label", r"\d+", 0).cast("bigint").alias("label"), "text"
    )
    return ops.match_labels(items, "slot", "label", "text", "vec_id", "text_1")
