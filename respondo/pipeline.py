"""The whole run: questionnaire and responses in, questions, results, clusters and accounts out.

The questions are one table and go through one plan; failures are rows with an error, not exceptions that
end the run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import providers
from .functions.text import has_value, strip
from .operators import clustering, questions
from .operators.columns import left_neighbours, profile, text_columns
from .prompts import DEFAULT, PromptRegistry
from .session import cut, ship
from .sources.documents import read_survey
from .sources.workbook import read_responses


@dataclass
class Run:
    questions: DataFrame
    answers: DataFrame
    results: DataFrame
    vectors: DataFrame
    clusters: DataFrame
    usage: DataFrame
    status: DataFrame


#: The branch of prompts for each question type that sentences are analysed for.
ANALYSED = {"depend": "depend", "depend_pos_neg": "depend", "pos_neg": "sentence"}


def analysis_prompt(text: Column, question: Column, kind: Column | None = None, explanation: Column | None = None, registry: PromptRegistry = DEFAULT) -> Column:
    """The prompt of an answer by its question's type: with the explanation of the choice it depends on where the type has one."""
    plain = registry.messages("sentence", question=question, text=text)
    if kind is None:
        return F.array_join(F.transform(plain, lambda m: m["content"]), "\n")
    depends = strip(kind).isin([k for k, branch in ANALYSED.items() if branch == "depend"]) & explanation.isNotNull()
    typed = F.when(depends, registry.messages("depend", sub_explanation=F.coalesce(explanation, F.lit("")), question=question, text=text)).otherwise(plain)
    return F.array_join(F.transform(typed, lambda m: m["content"]), "\n")


def analyse(answers: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(results, usage): answers corrected, split into at most three sentences and tagged; two calls an
    answer, each distinct prompt asked once; failures keep their row. Where the answers bring question_text,
    question_type and explanation (`questions.context`), the second prompt is that of their type with all three in it; an answer of a type that
    sentences are not analysed for is a row with the error `unsupported_type`."""
    first = providers.complete(answers, text, providers.RuleProvider("grammar"))
    fixed = F.coalesce(F.from_json("completion.content", "corrected string")["corrected"], F.col(text))
    first = first.withColumn("correction", fixed).withColumnRenamed("completion", "call_1")
    if {"question_text", "question_type", "explanation"} <= set(answers.columns):
        kind = F.col("question_type")
        fine = kind.isNull() | strip(kind).isin(list(ANALYSED))
        prompt = analysis_prompt(F.col("correction"), F.col("question_text"), kind, F.col("explanation"))
        first = first.withColumn("_refused", F.when(~fine, "unsupported_type")).withColumn("_prompt_2", F.when(fine, prompt))
    else:
        first = first.withColumn("_refused", F.lit(None).cast("string")).withColumn("_prompt_2", F.col("correction"))
    first = cut(first, "corrected")
    second = providers.complete(first, "_prompt_2", providers.RuleProvider("analysis"))
    record = providers.analysis_record(F.from_json("completion.content", providers.ANALYSIS))
    done = cut(second.withColumn("analysis", record).withColumnRenamed("completion", "call_2"), "analysed")
    calls = done.select(F.explode(F.array("call_1", "call_2")).alias("c")).where("c is not null").select("c.*")
    return done.withColumn("error", F.coalesce("_refused", "call_1.error", "call_2.error")).drop("call_1", "call_2", "_refused", "_prompt_2"), calls


def flat_results(results: DataFrame) -> DataFrame:
    """The nested analysis as flat columns: sentences 1 to 3 and their S, V and C words."""
    columns = [F.col("analysis.pos_neg").alias("pos_neg"), F.col("analysis.matching_question").alias("matching_question")]
    for i in range(3):
        words = F.col("analysis.svc_keywords")[f"sentence{i + 1}"]
        columns.append(F.get("analysis.automic_sentence", F.lit(i)).alias(f"sentence_{i + 1}"))
        columns += [F.coalesce(F.array_join(words[r], ", "), F.lit("")).alias(f"{r}_{i + 1}") for r in ("S", "V", "C")]
    return results.select(*[c for c in results.columns if c != "analysis"], *columns)


def run(spark: SparkSession, survey: str, responses: str, size: int = providers.VECTOR_SIZE) -> Run:
    """A questionnaire (txt, docx) and a response table (xlsx, csv, parquet) through all three stages."""
    ship(spark)
    document = read_survey(spark, survey)
    asked = questions.parse_questionnaire(document.select(F.posexplode(F.split("text", r"\r?\n")).alias("line", "value")), order="line")
    asked = cut(asked.withColumn("survey", F.lit(1)).withColumn("branch", questions.branch(F.col("rule_type"))), "questions")
    table = read_responses(spark, responses)
    profiled = cut(profile(table.table.select(*table.columns)), "profile")
    opened = text_columns(profiled)
    catalogue = opened.select(F.lit(1).alias("survey"), "ordinal", "name")
    matched = cut(asked.join(questions.match_columns(asked, catalogue, ["survey"]), ["survey", "open_question_number"]), "matched")
    names = [r.name for r in opened.select("name").collect()]  # a row a column
    if names:
        cells = table.table.unpivot(["respondent_key"], names, "column", "text").where(has_value(F.col("text")))
    else:
        cells = spark.createDataFrame([], "respondent_key string, column string, text string")
    owner = matched.select("open_question_number", "branch", F.posexplode("matched_columns").alias("slot", "column"))
    answers = cut(cells.join(F.broadcast(owner), "column").select(F.col("open_question_number").alias("qid"), "branch", "respondent_key", "slot", "column", strip(F.col("text")).alias("text")), "answers")
    # the value an answer depends on stands in the column to the left of its own
    left = left_neighbours(profiled).where("neighbour is not null").select(F.col("name").alias("column"), "neighbour")
    beside = [r.neighbour for r in left.join(opened.select(F.col("name").alias("column")), "column", "left_semi").select("neighbour").distinct().collect()]  # a row a column
    spoken = answers.where("branch = 'SENTENCE'").withColumn("survey", F.lit(1)).withColumnRenamed("qid", "open_question_number")
    if beside:
        values = table.table.select("respondent_key", *[F.col(f"`{c}`").cast("string").alias(c) for c in beside]).unpivot(["respondent_key"], beside, "neighbour", "depend")
        spoken = spoken.join(F.broadcast(left), "column", "left").join(values.where("depend is not null"), ["respondent_key", "neighbour"], "left")
    else:
        spoken = spoken.withColumn("depend", F.lit(None).cast("string"))
    asked_types = asked.withColumnRenamed("rule_type", "question_type")
    known = questions.context(spoken, asked_types, ["survey", "open_question_number"], "depend").withColumnRenamed("open_question_number", "qid")
    results, usage = analyse(known.drop("survey", "neighbour"))
    words = answers.where("branch = 'WORD'").select("qid", "respondent_key", "slot", "text")
    sentences = results.select("qid", "respondent_key", F.posexplode("analysis.automic_sentence").alias("slot", "text"))
    vectors = cut(providers.encode(words.unionByName(sentences), "text", size).where(F.size("emb") > 0), "encoded")
    points = vectors.select(F.col("qid").alias("grp"), F.xxhash64("respondent_key", "slot").alias("id"), F.col("emb").cast("array<double>").alias("emb"))
    clusters = clustering.trained(cut(points, "points"))
    status = matched.join(answers.groupBy(F.col("qid").alias("open_question_number")).agg(F.count("*").alias("rows_count")), "open_question_number", "left").select(
        "open_question_number", "branch", F.coalesce("rows_count", F.lit(0)).alias("rows_count"), F.lit("completed").alias("status")
    )
    return Run(matched, answers, flat_results(results), vectors, clusters, usage, status)


def preview(answers: DataFrame, rows: int = 3) -> DataFrame:
    """The flat analysis of the first answers, to look at before a run."""
    return flat_results(analyse(answers.limit(rows))[0])
