"""Queries over questions: integration, routing, types, anchors, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..context import filled_fields, missing_fields
from ..functions.text import anchor, question_type, strip, template
from ..operators import questions as ops
from ..providers import RuleProvider, complete
from .base import Catalogue, stripped

catalogue = Catalogue()
_LATEST = """latest as (select * from (select *, row_number() over (partition by survey_id, open_question_number order by parsed_at desc, question_key desc) as r from survey_questions) where r = 1)"""
_BRANCH = "case when {t} is null then '__END__' when {s} in ('concept', 'img') then 'WORD' when {s} in ('depend', 'depend_pos_neg', 'pos_neg') then 'SENTENCE' else 'ETC' end"


def _branch(t: str) -> str:
    return _BRANCH.format(t=t, s=stripped(t))


def latest(t):
    return ops.latest(t("survey_questions"), ["survey_id", "open_question_number"], [F.desc("parsed_at"), F.desc("question_key")])


def _answered(t):
    """The column map of every question: the lists of respondents' slots stand for columns."""
    slots = t("answer_vectors").where("slot is not null").select("survey_id", "open_question_number", "slot").distinct()
    return slots.groupBy("survey_id", "open_question_number").agg(F.array_sort(F.collect_list("slot")).alias("matched_columns"))


@catalogue.add(f"with {_LATEST} select question_key, survey_id, open_question_number, question_text from latest")
def q_latest_questions(t):
    return latest(t).select("question_key", "survey_id", "open_question_number", "question_text")


@catalogue.add(f"""with {_LATEST}, m as (select survey_id, open_question_number, string_agg(distinct slot, ',' order by slot) as c from answer_vectors where slot is not null group by 1, 2)
select question_key, survey_id, open_question_number, coalesce(c, '') as columns from latest left join m using (survey_id, open_question_number)""")
def q_integrate_left_default(t):
    found = ops.integrate(latest(t), _answered(t), ["survey_id", "open_question_number"])
    return found.select("question_key", "survey_id", "open_question_number", F.array_join("matched_columns", ",").alias("columns"))


@catalogue.add(f"""with {_LATEST}, a as (select *, row_number() over (partition by survey_id order by ord, question_key) as position from latest),
b as (select survey_id, doc_id, row_number() over (partition by survey_id order by doc_id) as position from documents where survey_id is not null)
select question_key, a.survey_id, position, doc_id from a left join b using (survey_id, position)""")
def q_positional_join(t):
    docs = t("documents").where("survey_id is not null").select("survey_id", "doc_id")
    return ops.by_position(latest(t), docs, [F.col("ord"), F.col("question_key")], [F.col("doc_id")], ["survey_id"]).select("question_key", "survey_id", "position", "doc_id")


@catalogue.add(f"""with {_LATEST} select a.question_key, b.question_text as related_text from latest a left join latest b
on a.survey_id = b.survey_id and a.question_that_is_related = b.open_question_number""")
def q_related_self_join(t):
    return ops.related(latest(t), "survey_id", "open_question_number", "question_that_is_related", "question_text").select("question_key", "related_text")


_CHOICES = rf"""ch as (select question_key, survey_id, open_question_number, i, f, l, x from (
  select question_key, survey_id, open_question_number, generate_subscripts(fs, 1) as i, unnest(fs) as f, unnest(ls) as l, unnest(xs) as x from (
    select question_key, survey_id, open_question_number, {", ".join(rf"regexp_extract_all(question_text, '([①-⑳])\s*(?:[~～-]\s*([①-⑳]))?\s*([^①-⑳~～]*)', {i}) as {n}" for i, n in ((1, "fs"), (2, "ls"), (3, "xs")))} from latest where question_text is not null))),
each as (select question_key, survey_id, open_question_number, i, x, unnest(range(unicode(f) - 9311, greatest(unicode(f), case when l = '' then 0 else unicode(l) end) - 9311 + 1)) as n from ch),
choices as (select question_key, survey_id, open_question_number, cast(n as varchar) as number, {stripped("arg_max(x, i)")} as explanation from each group by 1, 2, 3, 4)"""


@catalogue.add(f"with {_LATEST}, {_CHOICES} select question_key, number as choice, explanation from choices")
def q_choice_table(t):
    return ops.choices(latest(t), ["question_key"], "question_text")


@catalogue.add(f"""with {_LATEST}, {_CHOICES}, a as (select record_id, survey_id, open_question_number, cast(record_id % 3 + 1 as varchar) as number from grammar_records),
w as (select a.*, l.question_text, l.question_type, l.question_that_is_related as other, {stripped("l.question_type")} in ('depend', 'depend_pos_neg') as depends from a left join latest l using (survey_id, open_question_number))
select w.record_id, w.question_text, w.question_type, r.question_text as related_text, coalesce(c.explanation, o.explanation) as explanation from w
left join latest r on r.survey_id = w.survey_id and r.open_question_number = w.other
left join choices c on w.depends and c.survey_id = w.survey_id and c.open_question_number = w.open_question_number and c.number = w.number
left join choices o on w.depends and o.survey_id = w.survey_id and o.open_question_number = w.other and o.number = w.number""")
def q_choice_lookup(t):
    answers = t("grammar_records").select("record_id", "survey_id", "open_question_number", F.concat((F.col("record_id") % 3 + 1).cast("string"), F.lit(".0")).alias("depend"))
    known = ops.context(answers, latest(t), ["survey_id", "open_question_number"], "depend")
    return known.select("record_id", "question_text", "question_type", "related_text", "explanation")


@catalogue.add(f"""with {_LATEST} select record_id, case when l.question_type is not null and {stripped("l.question_type")} in ('depend', 'depend_pos_neg') then 'The answer explains a choice: taste' else 'Split into at most three sentences; give polarity and keywords as JSON.' end
 || chr(10) || 'Question: ' || coalesce(l.question_text, '') || chr(10) || 'Answer: ' || g.corrected as prompt from grammar_records g left join latest l using (survey_id, open_question_number) where g.corrected is not null""")
def q_typed_prompts(t):
    from ..pipeline import analysis_prompt

    answers = t("grammar_records").where("corrected is not null").select("record_id", "survey_id", "open_question_number", "corrected")
    known = answers.join(latest(t).select("survey_id", "open_question_number", "question_text", "question_type"), ["survey_id", "open_question_number"], "left")
    return known.select("record_id", analysis_prompt(F.col("corrected"), F.col("question_text"), F.col("question_type"), F.lit("taste")).alias("prompt"))


@catalogue.add("select record_id, survey_id from grammar_records where (survey_id, open_question_number) in (select (survey_id, open_question_number) from survey_questions)")
def q_semi_existing(t):
    return t("grammar_records").select("record_id", "survey_id", "open_question_number").join(t("survey_questions").select("survey_id", "open_question_number"), ["survey_id", "open_question_number"], "left_semi").select("record_id", "survey_id")


@catalogue.add("""select record_id, survey_id from grammar_records g where not exists (select 1 from sentence_analysis a where a.record_id = g.record_id)""")
def q_except_denylist(t):
    return t("grammar_records").select("record_id", "survey_id").join(t("sentence_analysis").select("record_id"), "record_id", "left_anti")


@catalogue.add(f"select question_key, {_branch('question_type')} as branch from survey_questions")
def q_route_types(t):
    return t("survey_questions").select("question_key", ops.branch(F.col("question_type")).alias("branch"))


@catalogue.add(f"""with {_LATEST}
select survey_id, {_branch('question_type')} as branch, count(*) as n_answers, count(distinct open_question_number) as n_questions
from (select g.survey_id, g.open_question_number, l.question_type from grammar_records g join latest l using (survey_id, open_question_number)
  where {stripped('g.corrected')} <> '') group by 1, 2""")
def q_route_counts(t):
    answers = t("grammar_records").where(strip(F.col("corrected")) != "").select("survey_id", "open_question_number")
    routed = answers.join(latest(t).select("survey_id", "open_question_number", "question_type"), ["survey_id", "open_question_number"])
    return routed.groupBy("survey_id", ops.branch(F.col("question_type")).alias("branch")).agg(F.count("*").alias("n_answers"), F.count_distinct("open_question_number").alias("n_questions"))


_PLAIN = r"regexp_replace({x}, '^0+(\d)', '\1')"
_MAIN, _TAIL = r"regexp_extract({c}, '(\d+)', 1)", r"regexp_extract({c}, '\d+\s*[-_.]\s*(\d+)', 1)"
_FOUR = r"regexp_extract({c}, '^[A-Za-z](\d{{2}})(\d{{2}})[A-Za-z]?$', {i})"


def _anchor(c: str) -> str:
    main, tail, four, sub = _MAIN.format(c=c), _TAIL.format(c=c), _FOUR.format(c=c, i=1), _FOUR.format(c=c, i=2)
    plain = lambda x: _PLAIN.format(x=x)
    return f"case when {four} <> '' then {plain(four)} || '-' || {plain(sub)} when {main} <> '' and {tail} <> '' then {plain(main)} || '-' || {plain(tail)} when {main} <> '' then {plain(main)} end"


@catalogue.add(f"select question_key, {_anchor('open_question_number')} as anchor from survey_questions")
def q_anchor_extract(t):
    return t("survey_questions").select("question_key", anchor(F.col("open_question_number")).alias("anchor"))


_CUE = {
    "etc": "기타|[Oo]ther|その他|其他|etc\\.", "depend": "방금|고르신|답하신|선택하신|[Ww]hy did you|ticked|that answer|Antwort|esa respuesta|その理由|为什么选",
    "img": "떠올릴|생각나는|이미지|comes to mind|zuerst ein|recuerda|思い浮かぶ|想到", "pos_neg": "좋은 점|아쉬운 점|마음에 드|good and bad|Stärken und Schwächen|bueno y lo malo|良い点|优点",
    "concept": "어떻게 느끼|광고|컨셉|concept|advert",
}


@catalogue.add(f"""with c as (select question_key, {", ".join(f"regexp_matches(coalesce(question_text, ''), '{p}') as {n}_" for n, p in _CUE.items())} from survey_questions)
select question_key, case when etc_ and pos_neg_ then 'etc_pos_neg' when depend_ and pos_neg_ then 'depend_pos_neg' when etc_ then 'etc' when depend_ then 'depend'
  when img_ then 'img' when pos_neg_ then 'pos_neg' else 'concept' end as rule_type from c""")
def q_type_precedence(t):
    return t("survey_questions").select("question_key", question_type(F.coalesce("question_text", F.lit(""))).alias("rule_type"))


@catalogue.add(f"""with {_LATEST}, slots as (select distinct survey_id, slot as name, cast(regexp_extract(slot, '(\\d+)', 1) as bigint) as ordinal from answer_vectors where slot is not null),
cols as (select survey_id, ordinal, name, {_anchor('name')} as a from slots), q as (select survey_id, open_question_number, {_anchor('open_question_number')} as a from latest)
select survey_id, open_question_number, coalesce(string_agg(name, ',' order by ordinal, name), '') as columns from q left join cols using (survey_id, a) group by 1, 2""")
def q_column_match(t):
    slots = t("answer_vectors").where("slot is not null").select("survey_id", F.col("slot").alias("name")).distinct()
    columns = slots.withColumn("ordinal", F.regexp_extract("name", r"(\d+)", 1).try_cast("bigint"))
    return ops.match_columns(latest(t), columns, ["survey_id"]).select("survey_id", "open_question_number", F.array_join("matched_columns", ",").alias("columns"))


@catalogue.add(f"""with {_LATEST} select question_key, 'Question ' || coalesce(open_question_number, '') || ' of ' || coalesce(survey_id, '') || ': ' || coalesce(question_text, '') as prompt from latest""")
def q_prompt_template(t):
    text = template("Question {number} of {survey}: {text}", number=F.col("open_question_number"), survey=F.col("survey_id"), text=F.col("question_text"))
    return latest(t).select("question_key", text.alias("prompt"))


@catalogue.add("""select survey_id, open_question_number, cast(len(cols) as int) as n_columns from (
select survey_id, open_question_number, case when question_key % 3 = 0 then [] when question_key % 3 = 1 then ['A1', 'A2'] else ['B1'] end as cols from survey_questions)""")
def q_question_map_json(t):
    key = F.col("question_key") % 3
    raw = F.when(key == 0, "not json").when(key == 1, '{"q": ["A1", "A2"]}').otherwise('{"q": ["B1"]}')
    return t("survey_questions").select("survey_id", "open_question_number", F.size(F.coalesce(ops.column_map(raw)["q"], F.array().cast("array<string>"))).alias("n_columns"))


@catalogue.add()
def q_choice_ranges(t):
    asked = complete(t("survey_questions").where("question_text is not null").select("question_key", "question_text"), "question_text", RuleProvider("choices"))
    parsed = F.from_json("completion.content", "question string, answers map<string,string>")
    return asked.select("question_key", parsed["question"].alias("question"), F.size(parsed["answers"]).alias("n_choices"))


_FIELDS = ["question_text", "question_type", "question_that_is_related", "parsed_at"]


@catalogue.add(f"""select question_key, {" + ".join(f"({c} is not null)::int" for c in _FIELDS)} as n_filled,
  concat_ws(',', {", ".join(f"case when {c} is null then '{c}' end" for c in _FIELDS)}) as missing from survey_questions""")
def q_missing_fields(t):
    return t("survey_questions").select("question_key", filled_fields(_FIELDS).alias("n_filled"), F.array_join(missing_fields(_FIELDS), ",").alias("missing"))


@catalogue.add("""select r_name as header, n_name as name from (select n_nationkey, n_name, n_regionkey from nation) left join region on n_regionkey = r_regionkey""")
def q_header_labels(t):
    names = t("nation").select(F.col("n_nationkey").alias("ordinal"), F.col("n_name").alias("name"))
    cells = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("header"), F.col("n_name").alias("value"))
    return ops.header_labels(cells, names).select(F.col("label").alias("header"), "name")
