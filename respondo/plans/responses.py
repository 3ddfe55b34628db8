"""Queries over response tables: cells, profiles, texts, ordinals."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.text import cleaned_number, first_text, has_value, null_tokens, number_text, project_name, strip
from ..operators import columns as ops
from ..providers import encode
from ..session import cut
from .base import FILLERS, TOKENS, Catalogue, stripped

catalogue = Catalogue()
_RANKED = "select survey_id, respondent_key, corrected, row_number() over (partition by survey_id, respondent_key order by record_id) as slot from grammar_records"


def ranked(t):
    """Every record with its place among those of its respondent, from 1."""
    slot = F.row_number().over(Window.partitionBy("survey_id", "respondent_key").orderBy("record_id"))
    return t("grammar_records").select("survey_id", "respondent_key", "record_id", "corrected").withColumn("slot", slot)


@catalogue.add(f"pivot ({_RANKED}) on ('answer_' || slot) using max(corrected) group by survey_id, respondent_key")
def q_wide_responses(t):
    """One row per respondent, a column for each of its answers: as many as the busiest respondent has."""
    slots = cut(ranked(t), "slots")
    most = slots.agg(F.max("slot")).first()[0] or 0  # one number
    columns = [F.max(F.when(F.col("slot") == i + 1, F.col("corrected"))).alias(f"answer_{i + 1}") for i in range(most)]
    keys = ["survey_id", "respondent_key"]
    return slots.groupBy(*keys).agg(*columns) if columns else slots.select(*keys)


@catalogue.add(f"""select * from (select survey_id, respondent_key, 'answer_' || slot as "column", {stripped("corrected")} as "text" from ({_RANKED})) where "text" not in {FILLERS}""")
def q_unpivot_cells(t):
    cells = ranked(t).where(has_value(F.col("corrected")))
    return cells.select("survey_id", "respondent_key", F.concat(F.lit("answer_"), F.col("slot").cast("string")).alias("column"), strip(F.col("corrected")).alias("text"))


@catalogue.add(f"select survey_id, respondent_key, nullif({stripped('arg_min(corrected, slot) filter (corrected is not null)')}, '') as first_text from ({_RANKED}) group by survey_id, respondent_key")
def q_first_nonnull_text(t):
    first = F.min(F.when(F.col("corrected").isNotNull(), F.struct("slot", "corrected")))["corrected"]
    return ranked(t).groupBy("survey_id", "respondent_key").agg(first.alias("first")).select("survey_id", "respondent_key", first_text(F.col("first")).alias("first_text"))


@catalogue.add(f"select survey_id, respondent_key, string_agg(coalesce(corrected, ''), ' ' order by slot) as merged from ({_RANKED}) group by survey_id, respondent_key")
def q_merged_columns(t):
    texts = F.array_sort(F.collect_list(F.struct("slot", F.coalesce("corrected", F.lit("")).alias("text"))))
    return ranked(t).groupBy("survey_id", "respondent_key").agg(F.array_join(texts["text"], " ").alias("merged"))


@catalogue.add("select doc_id, row_number() over (order by created_at, doc_id) - 1 as id from documents where created_at is not null")
def q_row_ordinal(t):
    return ops.ordinals(t("documents").where("created_at is not null").select("doc_id", "created_at"), ["created_at", "doc_id"]).select("doc_id", "id")


@catalogue.add("select record_id, org_text, corrected from grammar_records where org_text is not null or corrected is not null")
def q_drop_all_null(t):
    texts = t("grammar_records").select("record_id", "org_text", "corrected")
    return texts.dropna("all", subset=["org_text", "corrected"])


@catalogue.add("select call_id, record_id as respondent_key from usage_log where record_id is not null")
def q_key_not_null(t):
    return ops.with_key(t("usage_log").select("call_id", "record_id"), "record_id")


@catalogue.add(f"select record_id, case when org_text not in {TOKENS} then org_text end as org_text from grammar_records")
def q_null_tokens(t):
    return t("grammar_records").select("record_id", null_tokens(F.col("org_text")).alias("org_text"))


_CLEAN = r"""case when lower({n}) in ('nan', 'inf', 'infinity') then null else try_cast({n} as double) end"""


def _numbers(column: str) -> str:
    n = rf"regexp_replace(translate({stripped(f'cast({column} as varchar)')}, ',_ -:', ''), '^\((.*)\)$', '-\1')"
    return _CLEAN.format(n=n)


def _profile_sql(table: str, names: list[str]) -> str:
    parts = [
        f"select {i} as ordinal, '{c}' as name, count(*) as n_rows, count({c}) as n_values, count({_numbers(c)}) as n_numbers from {table}" for i, c in enumerate(names)
    ]
    ratio = lambda a, b: f"round(case when {b} = 0 then 0.0 else ({a}) / {b} end, 6)"
    return f"""profiled as (select *, {ratio('n_rows - n_values', 'n_rows')} as null_ratio, {ratio('n_numbers', 'n_values')} as number_ratio,
{ratio('n_values - n_numbers', 'n_values')} as string_ratio from ({' union all '.join(parts)}))"""


ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
CALLS = ["call_id", "record_id", "model_name", "prompt_tokens", "latency_ms", "cost_usd"]
RECORDS = ["record_id", "survey_id", "open_question_number", "respondent_key", "id", "lang", "org_text", "corrected"]


@catalogue.add(f"with {_profile_sql('usage_log', CALLS)} select * from profiled")
def q_column_null_profile(t):
    return ops.profile(t("usage_log").select(*CALLS))


@catalogue.add(f"with {_profile_sql('grammar_records', RECORDS)} select ordinal, name from profiled where n_rows > 0 and (n_numbers + n_rows - n_values) / n_rows < 1.0")
def q_open_columns_ratio(t):
    return ops.open_columns(ops.profile(t("grammar_records").select(*RECORDS))).select("ordinal", "name")


@catalogue.add(f"with {_profile_sql('orders', ORDERS)} select ordinal, name, string_ratio from profiled where n_values > 0 and string_ratio >= 0.8")
def q_objectish_ratio(t):
    return ops.text_columns(ops.profile(t("orders").select(*ORDERS))).select("ordinal", "name", "string_ratio")


@catalogue.add(f"""with {_profile_sql('usage_log', CALLS)}
select ordinal, name, case when lag(n_values, 1) over w = 0 then lag(name, 2) over w else lag(name, 1) over w end as neighbour from profiled window w as (order by ordinal)""")
def q_left_neighbour_column(t):
    return ops.left_neighbours(ops.profile(t("usage_log").select(*CALLS)))


@catalogue.add("select lang, count(*) as n, min(record_id) as first_id from grammar_records where lang is not null group by lang")
def q_distinct_depend(t):
    return t("grammar_records").where("lang is not null").groupBy("lang").agg(F.count("*").alias("n"), F.min("record_id").alias("first_id"))


@catalogue.add(f"select {stripped('corrected')} as answer, count(*) as n, min(record_id) as first_id from grammar_records where {stripped('corrected')} not in {FILLERS} group by 1")
def q_distinct_answers(t):
    return t("grammar_records").where(has_value(F.col("corrected"))).groupBy(strip(F.col("corrected")).alias("answer")).agg(F.count("*").alias("n"), F.min("record_id").alias("first_id"))


@catalogue.add("""select l_orderkey, l_linenumber, coalesce(cast(cast(trunc(try_cast(v as double)) as bigint) as varchar), v) as depend
from (select l_orderkey, l_linenumber, case l_linenumber % 3 when 0 then cast(l_quantity as varchar) when 1 then l_returnflag else null end as v from lineitem)""")
def q_depend_value(t):
    v = F.when(F.col("l_linenumber") % 3 == 0, F.col("l_quantity").cast("string")).when(F.col("l_linenumber") % 3 == 1, F.col("l_returnflag"))
    return t("lineitem").select("l_orderkey", "l_linenumber", number_text(v).alias("depend"))


@catalogue.add(f"""select record_id, {_numbers('v')} as number from (
select record_id, case record_id % 4 when 0 then '(' || cast(id as varchar) || ',5)' when 1 then ' 1_0' || cast(id as varchar) when 2 then '2024-01-0' || cast(record_id % 9 as varchar) else open_question_number end as v from grammar_records)""")
def q_cleaned_numbers(t):
    n = F.col("record_id") % 4
    v = (
        F.when(n == 0, F.concat(F.lit("("), F.col("id").cast("string"), F.lit(",5)")))
        .when(n == 1, F.concat(F.lit(" 1_0"), F.col("id").cast("string")))
        .when(n == 2, F.concat(F.lit("2024-01-0"), (F.col("record_id") % 9).cast("string")))
        .otherwise(F.col("open_question_number"))
    )
    return t("grammar_records").select("record_id", cleaned_number(v).alias("number"))


@catalogue.add(f"select vec_id, slot, {stripped('text')} as answer, len(emb) as dim from answer_vectors where text is not null")
def q_word_flatten(t):
    return t("answer_vectors").where("text is not null").select("vec_id", "slot", strip(F.col("text")).alias("answer"), F.when(F.col("emb").isNotNull(), F.size("emb")).cast("bigint").alias("dim"))


@catalogue.add(r"""select doc_id, coalesce(nullif(lower(regexp_extract(regexp_replace(f, '^[-_\d년월일\s]+', ''), '[A-Za-z가-힣]+')), ''), 'default') as project
from (select doc_id, strftime(created_at, '%Y-%m-%d_') || coalesce(source, '') || '_' || coalesce(survey_id, '') as f from documents where created_at is not null)""")
def q_project_name(t):
    name = F.concat(F.date_format("created_at", "yyyy-MM-dd_"), F.coalesce("source", F.lit("")), F.lit("_"), F.coalesce("survey_id", F.lit("")))
    return t("documents").where("created_at is not null").select("doc_id", project_name(name).alias("project"))


@catalogue.add("select record_id, length(corrected) as n, left(corrected, 20) as head, case when length(corrected) > 80 then 'long' else 'short' end as route from grammar_records where corrected is not null")
def q_length_route(t):
    n = F.length("corrected")
    return t("grammar_records").where("corrected is not null").select("record_id", n.alias("n"), F.left("corrected", F.lit(20)).alias("head"), F.when(n > 80, "long").otherwise("short").alias("route"))


@catalogue.add()
def q_hash_embedding(t):
    return encode(t("answer_vectors").select("vec_id", "text"), "text").select("vec_id", F.size("emb").alias("dim"), F.round(F.aggregate("emb", F.lit(0.0), lambda s, x: s + x.cast("double") * x), 4).alias("length"))
