"""The named queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

import secrets
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table, shared_dir


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neighbours import pairs

    found = pairs(read_table(spark, sf_dir, "answer_vectors"), "vec_id", "emb", k=15, least=0.6)
    return found.select(F.col("lo").alias("vec_lo"), F.col("hi").alias("vec_hi"))


def p1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neighbours import neighbours

    found = neighbours(read_table(spark, sf_dir, "answer_vectors"), "vec_id", "emb", k=15)
    return found.select(F.col("key").alias("vec_id"), F.col("other").alias("neighbour_id"), F.round("cosine", 6).alias("cosine"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .peaks import clusters

    found = clusters(read_table(spark, sf_dir, "answer_vectors"), "vec_id", "emb")
    return found.select(F.col("head").alias("head_id"), F.col("key").alias("vec_id"))


def p2_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..session import cut
    from .peaks import clusters, describe

    found = cut(clusters(read_table(spark, sf_dir, "answer_vectors"), "vec_id", "emb"), "clusters")
    return describe(found).select(F.col("head").alias("head_id"), "size", "n_peaks", "typical")


def _sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sentences import fit_model, split_documents

    model = fit_model(read_table(spark, sf_dir, "sentence_analysis"), "analysis_id", "automic_sentence")
    return split_documents(read_table(spark, sf_dir, "grammar_records"), "record_id", "corrected", model)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sentences(spark, sf_dir).select("record_id", "end_pos")


def p3_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sentences(spark, sf_dir)


def _canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lookalikes import canonical_text

    both = [("grammar_records", "record_id", "corrected"), ("survey_questions", "question_key", "question_text")]
    parts = [canonical_text(read_table(spark, sf_dir, t), key, text).withColumn("table_name", F.lit(t)) for t, key, text in both]
    return parts[0].unionByName(parts[1]).withColumnRenamed("key", "row_id")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _canonical(spark, sf_dir).where("changed").select("table_name", "row_id")


def p4_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _canonical(spark, sf_dir).select("table_name", "row_id", "canonical", "changed")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .merkle import copies

    return copies(read_table(spark, sf_dir, "grammar_records"), "record_id", ["survey_id", "open_question_number", "respondent_key"], "corrected")


def p5_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .merkle import collapsed

    return collapsed(read_table(spark, sf_dir, "grammar_records"), "record_id", ["survey_id", "open_question_number", "respondent_key"], "corrected")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .personal import find_mentions

    return find_mentions(read_table(spark, sf_dir, "grammar_records"), "record_id", "corrected").select("record_id", "kind", "start_pos")


def p6_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .personal import replace_mentions

    return replace_mentions(read_table(spark, sf_dir, "grammar_records"), "record_id", "corrected", _secret(spark))


def _secret(spark: SparkSession) -> str:
    """The key of pseudonyms: the setting `spark.respondo.secret`, or a random one for this session."""
    found = spark.conf.get("spark.respondo.secret", None)
    if not found:
        found = spark._respondo_secret = getattr(spark, "_respondo_secret", None) or secrets.token_hex(32)
    return found


def _term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .term_counts import TermStore, svc_roles

    store = TermStore(spark, f"{shared_dir(spark)}/terms-{uuid.uuid4().hex}")
    store.apply(None, read_table(spark, sf_dir, "sentence_analysis"), "analysis_id", ["svc_keywords"], svc_roles)
    return store.counts()


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .term_counts import marks

    marked = marks(_term_counts(spark, sf_dir))
    return marked.where(F.col("mark").isNotNull()).select(F.col("role").alias("svc_role"), "term", "mark")


def p7_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .term_counts import marks

    return marks(_term_counts(spark, sf_dir)).select(F.col("role").alias("svc_role"), "term", "occurrences", F.col("records").alias("n_rows"), "mark")


def p7_after_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts after a change of a loaded store: all terms are put into lower case, and rows that do not answer their
    question are deleted. The change comes in as signed deltas."""
    from .term_counts import TermStore, svc_roles

    old = read_table(spark, sf_dir, "sentence_analysis").select("analysis_id", "svc_keywords", "matching_question")
    low = lambda c: F.transform(c, F.lower)
    fixed = F.transform_values("svc_keywords", lambda _, v: F.struct(low(v["s"]).alias("s"), low(v["v"]).alias("v"), low(v["c"]).alias("c")))
    new = old.where(F.coalesce("matching_question", F.lit(True))).withColumn("svc_keywords", fixed)
    store = TermStore(spark, f"{shared_dir(spark)}/terms-{uuid.uuid4().hex}")
    store.apply(None, old, "analysis_id", ["svc_keywords"], svc_roles)
    store.apply(old, new, "analysis_id", ["svc_keywords"], svc_roles)
    return store.counts().where("role <> '*'").select(F.col("role").alias("svc_role"), "term", "occurrences", F.col("records").alias("n_rows"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .encode import encode_documents

    return encode_documents(read_table(spark, sf_dir, "documents"))


def p8_tokens_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .encode import count_tokens

    sized = count_tokens(read_table(spark, sf_dir, "documents"), ["source"])
    return sized.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.max("n_tokens").alias("longest"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixture import mix

    return mix(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "mix_targets"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..session import cut
    from .mixture import shares

    return shares(cut(p9_mix(spark, sf_dir), "mixture"), read_table(spark, sf_dir, "mix_targets"))


def _subjects(spark: SparkSession, sf_dir: str) -> tuple:
    from . import subjects
    from .sentences import fit_model

    areas = [r.subject for r in read_table(spark, sf_dir, "subject_areas").where(F.col("subject").isNotNull()).select("subject").distinct().orderBy("subject").collect()]
    model = fit_model(read_table(spark, sf_dir, "sentence_analysis"), "analysis_id", "automic_sentence")
    found = subjects.featurise(read_table(spark, sf_dir, "documents"), "doc_id", "text", model, "lang")
    labels = read_table(spark, sf_dir, "subject_labels").select(F.col("doc_id").alias("key"), "subject")
    fitted, data = subjects.fit(found, labels, areas)
    return data, fitted


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .subjects import assign

    return assign(*_subjects(spark, sf_dir)).select(F.col("key").alias("doc_id"), "subject")


def p10_posteriors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .subjects import posteriors

    return posteriors(*_subjects(spark, sf_dir)).select(F.col("key").alias("doc_id"), "subject", "n_sentences", F.round("posterior", 4).alias("posterior"))


_QUERIES = [p1_found, p1_neighbours, p2_found, p2_clusters, p3_found, p3_sentences, p4_found, p4_canonical, p5_found, p5_collapsed, p6_found, p6_redacted, p7_found, p7_counts, p7_after_change, p8_ids, p8_tokens_by_source, p9_mix, p9_shares, p10_found, p10_posteriors]

#: White space as `term_counts.BLANKS` strips it, for DuckDB's regular expressions.
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_COUNTS = rf"""
with lists as (
  select analysis_id, unnest(map_values(svc_keywords)) as x from sentence_analysis {{where}}
), raw as (
  select analysis_id, 's' as svc_role, unnest(x.s) as t from lists
  union all select analysis_id, 'v', unnest(x.v) from lists
  union all select analysis_id, 'c', unnest(x.c) from lists
), terms as (
  select analysis_id, svc_role, regexp_replace({{t}}, '^{_SPACE}+|{_SPACE}+$', '', 'g') as term from raw where t is not null
), counts as (
  select svc_role, term, cast(count(*) as bigint) as occurrences, cast(count(distinct analysis_id) as bigint) as n_rows
  from terms where term <> '' group by svc_role, term
)
"""
_TERMS = _COUNTS.replace("{where}", "").replace("{t}", "t") + """, marked as (
  select *, case when n_rows < 3 then 'rare' when n_rows > 0.05 * (select count(*) from sentence_analysis) then 'common' end as mark from counts
)
"""


def queries() -> dict:
    return {q.__name__: q for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "p7_found": _TERMS + "select svc_role, term, mark from marked where mark is not null",
        "p7_after_change": _COUNTS.replace("{where}", "where coalesce(matching_question, true)").replace("{t}", "lower(t)") + "select svc_role, term, occurrences, n_rows from counts",
        "p7_counts": _TERMS + "select svc_role, term, occurrences, n_rows, mark from marked",
    }
