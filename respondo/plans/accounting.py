"""Queries over calls, prices and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import cost_text, file_stamp, runtime_text, seconds_between
from ..operators import accounting as ops
from ..streaming.usage import windowed
from .base import Catalogue

catalogue = Catalogue()
SAME = ["record_id", "model_name", "prompt_tokens", "completion_tokens", "latency_ms", "called_at"]


@catalogue.add("""
select call_id, model_name, cast(round(prompt_tokens * cast(input_per_1m as decimal(12,4)) + completion_tokens * cast(output_per_1m as decimal(12,4)), 0) as double) / 1e6 as priced_usd
from usage_log join price_table on model_name = name""")
def q_model_price_cost(t):
    return ops.priced(t("usage_log"), t("price_table")).select("call_id", "model_name", "priced_usd")


@catalogue.add("select call_id, model_name from usage_log where model_name is null or model_name not in (select name from price_table)")
def q_unpriced_calls(t):
    return ops.unpriced(t("usage_log"), t("price_table")).select("call_id", "model_name")


@catalogue.add("""
select round(coalesce(sum(cost_usd), 0), 6) as total_cost_usd, cast(coalesce(sum(prompt_tokens), 0) as bigint) as prompt_tokens,
  cast(coalesce(sum(completion_tokens), 0) as bigint) as completion_tokens from usage_log""")
def q_total_cost(t):
    return ops.summary(t("usage_log"), []).select("total_cost_usd", "prompt_tokens", "completion_tokens")


@catalogue.add("""
select survey_id, count(*) as total_calls, round(coalesce(sum(cost_usd), 0), 6) as total_cost_usd,
  cast(coalesce(sum(prompt_tokens), 0) as bigint) as prompt_tokens, cast(coalesce(sum(completion_tokens), 0) as bigint) as completion_tokens,
  cast(coalesce(sum(coalesce(prompt_tokens, 0) + coalesce(completion_tokens, 0)), 0) as bigint) as total_tokens,
  string_agg(distinct coalesce(model_name, 'unknown'), ', ' order by coalesce(model_name, 'unknown')) as models_used
from usage_log left join (select record_id, survey_id from grammar_records) using (record_id) group by survey_id""")
def q_usage_summary(t):
    calls = t("usage_log").join(t("grammar_records").select("record_id", "survey_id"), "record_id", "left")
    return ops.summary(calls, ["survey_id"])


@catalogue.add("select record_id, model_name, prompt_tokens, completion_tokens, latency_ms, called_at, min(call_id) as call_id from usage_log group by all")
def q_calls_once(t):
    return ops.once(t("usage_log"), SAME, "call_id")


@catalogue.add("""
select call_id, record_id, coalesce(raw_usage['prompt'], prompt_tokens, 0) as prompt_tokens, coalesce(raw_usage['completion'], completion_tokens, 0) as completion_tokens,
  coalesce(model_name, 'unknown') as model_name from usage_log""")
def q_usage_extraction(t):
    u = F.col("raw_usage")
    return t("usage_log").select(
        "call_id", "record_id", F.coalesce(u["prompt"], "prompt_tokens", F.lit(0)).alias("prompt_tokens"),
        F.coalesce(u["completion"], "completion_tokens", F.lit(0)).alias("completion_tokens"), F.coalesce("model_name", F.lit("unknown")).alias("model_name"),
    )


@catalogue.add("""
select call_id, model_name, round(sum(cost_usd) over (partition by model_name order by called_at, call_id rows unbounded preceding), 6) as running_cost
from usage_log where model_name is not null and cost_usd is not null""")
def q_running_cost(t):
    calls = t("usage_log").where("model_name is not null and cost_usd is not null")
    return ops.running(calls, ["model_name"], ["called_at", "call_id"], "cost_usd", "running_cost").select("call_id", "model_name", F.round("running_cost", 6).alias("running_cost"))


@catalogue.add("""
select event_id, user_id, row_number() over w as stage_number, (epoch_us(ts) - epoch_us(first_value(ts) over w)) / 1e6 as cumulative_seconds,
  coalesce((epoch_us(ts) - epoch_us(lag(ts) over w)) / 1e6, 0.0) as stage_seconds
from events window w as (partition by user_id order by ts, event_id)""")
def q_stage_runtime(t):
    return ops.stages(t("events"), "user_id", "ts", "event_id").select("event_id", "user_id", "stage_number", "cumulative_seconds", "stage_seconds")


@catalogue.add("""
with s as (select user_id, event_id, value, row_number() over w as stage_number, (epoch_us(ts) - epoch_us(first_value(ts) over w)) / 1e6 as c
  from events window w as (partition by user_id order by ts, event_id))
select user_id, count(*) as n_stages, max_by(c, stage_number) as runtime_seconds, round(sum(value), 6) as total_cost from s group by user_id""")
def q_history_totals(t):
    return ops.history(ops.stages(t("events"), "user_id", "ts", "event_id"), "user_id", "value")


@catalogue.add("select event_id, user_id, row_number() over (partition by user_id order by ts, event_id) as stage_number from events")
def q_stage_numbering(t):
    return ops.stages(t("events"), "user_id", "ts", "event_id").select("event_id", "user_id", "stage_number")


@catalogue.add("""
select question_key, survey_id, row_number() over w as position, count(*) over (partition by survey_id) as total, lead(open_question_number) over w as next_key
from survey_questions window w as (partition by survey_id order by ord, question_key)""")
def q_progress(t):
    return ops.progress(t("survey_questions"), ["survey_id"], ["ord", "question_key"], "open_question_number").select("question_key", "survey_id", "position", "total", "next_key")


@catalogue.add("""
select o_orderpriority, count(*) as total, count(*) filter (o_orderstatus = 'F') as success, count(*) filter (o_orderstatus <> 'F') as failed,
  round(count(*) filter (o_orderstatus = 'F') / greatest(count(*), 1) * 100, 6) as success_rate from orders group by o_orderpriority""")
def q_success_rate(t):
    return ops.outcome(t("orders"), ["o_orderpriority"], F.col("o_orderstatus") == "F")


@catalogue.add("""
select coalesce(question_type, 'unknown') as question_type, count(*) as n, count(distinct survey_id) as n_surveys from survey_questions group by 1""")
def q_type_statistics(t):
    return t("survey_questions").groupBy(F.coalesce("question_type", F.lit("unknown")).alias("question_type")).agg(F.count("*").alias("n"), F.count_distinct("survey_id").alias("n_surveys"))


@catalogue.add("""
select call_id, case when cost_usd = 0 then '$0.00' when cost_usd < 0.01 then printf('$%.6f', cost_usd) else printf('$%.4f', cost_usd) end as cost_text
from usage_log where cost_usd is not null""")
def q_cost_display(t):
    return t("usage_log").where("cost_usd is not null").select("call_id", cost_text(F.col("cost_usd")).alias("cost_text"))


@catalogue.add("""
select call_id, case when s < 60 then printf('%.1fs', s) when s < 3600 then printf('%dm %.1fs', cast(floor(s / 60) as bigint), s % 60)
  else printf('%dh %dm %.1fs', cast(floor(s / 3600) as bigint), cast(floor((s % 3600) / 60) as bigint), s % 60) end as runtime_text
from (select call_id, (latency_ms // 100) * 7 / 10.0::double as s from usage_log where latency_ms is not null)""")
def q_runtime_display(t):
    return t("usage_log").where("latency_ms is not null").select("call_id", runtime_text(F.floor(F.col("latency_ms") / 100) * 7 / F.lit(10.0)).alias("runtime_text"))


@catalogue.add("select call_id, strftime(called_at, '%Y%m%d_%H%M%S') as stamp, strftime(called_at, '%Y%m%d_%H%M%S_%g') as stamp_ms from usage_log where called_at is not null")
def q_ts_format(t):
    return t("usage_log").where("called_at is not null").select("call_id", file_stamp(F.col("called_at")).alias("stamp"), file_stamp(F.col("called_at"), millis=True).alias("stamp_ms"))


@catalogue.add("select call_id, coalesce((epoch_us(logged_at) - epoch_us(called_at)) / 1e6, 0.0) as seconds from usage_log")
def q_iso_seconds(t):
    return t("usage_log").select("call_id", seconds_between(F.col("called_at").cast("string"), F.col("logged_at").cast("string")).alias("seconds"))


@catalogue.add("""
select date_trunc('hour', called_at) as start, coalesce(model_name, 'unknown') as model_name, count(*) as calls,
  cast(sum(coalesce(prompt_tokens, 0) + coalesce(completion_tokens, 0)) as bigint) as tokens, round(sum(cost_usd), 6) as cost_usd
from usage_log where called_at is not null group by 1, 2""")
def q_usage_windows(t):
    return windowed(t("usage_log").where("called_at is not null")).withColumn("start", F.col("start").cast("timestamp_ntz"))


@catalogue.add("""
with a as (select * from orders where o_orderdate < date '1997-01-01'), b as (select * from orders where o_orderdate >= date '1993-01-01')
select coalesce(a.o_orderkey, b.o_orderkey) as o_orderkey, case when a.o_orderkey is null then 'new' when b.o_orderkey is null then 'deleted' else 'changed' end as change
from a full join (select o_orderkey, o_orderstatus, case when o_orderpriority = '1-URGENT' then o_totalprice + 1 else o_totalprice end as p from b) b on a.o_orderkey = b.o_orderkey
where a.o_orderkey is null or b.o_orderkey is null or a.o_totalprice is distinct from b.p or a.o_orderstatus is distinct from b.o_orderstatus""")
def q_state_diff(t):
    orders = t("orders")
    new = orders.where("o_orderdate >= date '1993-01-01'").withColumn("o_totalprice", F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return ops.difference(orders.where("o_orderdate < date '1997-01-01'"), new, "o_orderkey", ["o_orderstatus", "o_totalprice"])
