"""Queries over analysed answers and model output."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import lenient_json, strip
from ..pipeline import analyse
from ..providers import ANALYSIS, RuleProvider, analysis_record, complete
from .base import Catalogue, stripped

catalogue = Catalogue()
_RAW = """case analysis_id % 5 when 0 then j when 1 then '```json' || chr(10) || j || chr(10) || '```' when 2 then 'garbage ' || cast(analysis_id as varchar) when 3 then '{}' else j end"""


def _raw(t):
    """Analyses as the JSON a model would return: plain, fenced, garbage, empty."""
    text = F.concat(F.lit('{"matching_question": '), F.coalesce(F.col("matching_question").cast("string"), F.lit("null")), F.lit(', "pos.neg": "'), F.lower(F.coalesce("pos_neg", F.lit("neutral"))), F.lit('"}'))
    n = F.col("analysis_id") % 5
    raw = F.when(n == 1, F.concat(F.lit("```json\n"), text, F.lit("\n```"))).when(n == 2, F.concat(F.lit("garbage "), F.col("analysis_id").cast("string"))).when(n == 3, "{}").otherwise(text)
    return t("sentence_analysis").select("analysis_id", raw.alias("raw"))


@catalogue.add("""select analysis_id, case when analysis_id % 5 in (0, 1, 4) then matching_question end as matching_question from sentence_analysis""")
def q_json_fence(t):
    return _raw(t).select("analysis_id", lenient_json(F.col("raw"), ANALYSIS, "matching_question")["matching_question"].alias("matching_question"))


@catalogue.add("select event_id, case when event_id % 7 <> 0 then cast(json_extract(props, '$.page') as varchar) end as page from events")
def q_json_lenient(t):
    broken = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("x"), F.col("props"))).otherwise(F.col("props"))
    return t("events").select("event_id", F.get_json_object(broken, "$.page").alias("page"))


@catalogue.add("""select analysis_id, case when analysis_id % 5 in (0, 1, 4) then coalesce(matching_question, false) else false end as matching_question,
  case when analysis_id % 5 in (0, 1, 4) and matching_question is not null then upper(coalesce(pos_neg, 'neutral')) else 'NEUTRAL' end as pos_neg, 0 as n_sentences from sentence_analysis""")
def q_llm_record_defaults(t):
    record = analysis_record(lenient_json(F.col("raw"), ANALYSIS, "matching_question"))
    return _raw(t).select("analysis_id", record.alias("r")).select("analysis_id", "r.matching_question", "r.pos_neg", F.size("r.automic_sentence").alias("n_sentences"))


_POLARITY = rf"""case when upper({stripped("pos_neg")}) like 'POS%' then 'POSITIVE' when upper({stripped("pos_neg")}) like 'NEG%' then 'NEGATIVE' else 'NEUTRAL' end"""


def polarity(c):
    word = F.upper(strip(c))
    return F.when(word.startswith("POS"), "POSITIVE").when(word.startswith("NEG"), "NEGATIVE").otherwise("NEUTRAL")


@catalogue.add(f"select {_POLARITY} as polarity, count(*) as n, count(*) filter (matching_question) as n_matching from sentence_analysis group by 1")
def q_polarity_counts(t):
    return t("sentence_analysis").groupBy(polarity(F.col("pos_neg")).alias("polarity")).agg(F.count("*").alias("n"), F.count_if("matching_question").alias("n_matching"))


_FLAT = ", ".join(f"automic_sentence[{i}] as sentence_{i}, " + ", ".join(f"coalesce(array_to_string(svc_keywords['sentence{i}'].{r}, ', '), '') as {r}_{i}" for r in "svc") for i in (1, 2, 3))


@catalogue.add(f"select analysis_id, {_FLAT} from sentence_analysis")
def q_sentence_flatten(t):
    columns = []
    for i in (1, 2, 3):
        words = F.col("svc_keywords")[f"sentence{i}"]
        columns.append(F.get("automic_sentence", F.lit(i - 1)).alias(f"sentence_{i}"))
        columns += [F.coalesce(F.array_join(words[r], ", "), F.lit("")).alias(f"{r}_{i}") for r in "svc"]
    return t("sentence_analysis").select("analysis_id", *columns)


@catalogue.add(rf"""select doc_id, i as ordinal, part as sentence from (
select doc_id, unnest(list_filter(list_transform(regexp_split_to_array(text, '[.!?。！？\n]+'), lambda x: {stripped("x")}), lambda x: x <> '')[1:3]) as part,
  generate_subscripts(list_filter(list_transform(regexp_split_to_array(text, '[.!?。！？\n]+'), lambda x: {stripped("x")}), lambda x: x <> '')[1:3], 1) as i from documents where text is not null)""")
def q_atomic_top3(t):
    parts = F.slice(F.filter(F.transform(F.split("text", r"[.!?。！？\n]+"), strip), lambda p: p != ""), 1, 3)
    return t("documents").where("text is not null").select("doc_id", F.posexplode(parts).alias("i", "sentence")).select("doc_id", (F.col("i") + 1).cast("bigint").alias("ordinal"), "sentence")


@catalogue.add("""select record_id, min(analysis_id) as first_id, max_by(analysis_id, analysed_at) as last_id, count(*) as n from sentence_analysis where record_id is not null group by record_id having count(distinct analysed_at) = count(*)""")
def q_analysed_twice(t):
    g = t("sentence_analysis").where("record_id is not null").groupBy("record_id")
    rows = g.agg(F.min("analysis_id").alias("first_id"), F.max_by("analysis_id", "analysed_at").alias("last_id"), F.count("*").alias("n"), F.count_distinct("analysed_at").alias("d"))
    return rows.where("d = n").drop("d")


@catalogue.add()
def q_grammar_rule(t):
    asked = complete(t("grammar_records").where("org_text is not null").select("record_id", "org_text"), "org_text", RuleProvider("grammar"))
    return asked.select("record_id", F.coalesce(F.from_json("completion.content", "corrected string")["corrected"], "org_text").alias("corrected"))


@catalogue.add()
def q_sentence_analysis(t):
    results, _ = analyse(t("grammar_records").where(strip(F.col("corrected")) != "").select("record_id", F.col("corrected").alias("text")))
    return results.select("record_id", "analysis.pos_neg", F.size("analysis.automic_sentence").alias("n_sentences"), "error")
