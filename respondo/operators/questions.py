"""Questions: latest parse, column maps, routing to branches, related questions, labels of headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import BRANCHES, NO_BRANCH, OTHER_BRANCH
from ..functions.text import anchor, number_text, question_type, strip


def latest(questions: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the last by `order`."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return questions.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def branch(kind: Column) -> Column:
    """The processing branch of a question type."""
    known = F.create_map(*[F.lit(x) for pair in BRANCHES.items() for x in pair])
    return F.when(kind.isNull(), NO_BRANCH).otherwise(F.coalesce(F.try_element_at(known, strip(kind)), F.lit(OTHER_BRANCH)))


def integrate(questions: DataFrame, columns: DataFrame, keys: list[str]) -> DataFrame:
    """Every question with its matched columns, none as an empty array. `columns` is (keys..., matched_columns)."""
    return questions.join(columns, keys, "left").withColumn("matched_columns", F.coalesce("matched_columns", F.array().cast("array<string>")))


def column_map(json_text: Column) -> Column:
    """A question-to-columns map that may arrive as JSON text; unreadable text is an empty map."""
    return F.coalesce(F.from_json(json_text, "map<string,array<string>>"), F.create_map().cast("map<string,array<string>>"))


def by_position(left: DataFrame, right: DataFrame, left_order: list[Column], right_order: list[Column], within: list[str]) -> DataFrame:
    """The i-th row of one side with the i-th of the other, per group; rows beyond stay without partner."""
    a = left.withColumn("position", F.row_number().over(Window.partitionBy(*within).orderBy(*left_order)))
    b = right.withColumn("position", F.row_number().over(Window.partitionBy(*within).orderBy(*right_order)))
    return a.join(b, [*within, "position"], "left")


def related(questions: DataFrame, survey: str, number: str, other: str, text: str) -> DataFrame:
    """Every question with the text of the question it is related to, null where there is none."""
    target = questions.select(F.col(survey), F.col(number).alias(other), F.col(text).alias("related_text"))
    return questions.join(target, [survey, other], "left")


def header_labels(cells: DataFrame, names: DataFrame) -> DataFrame:
    """(ordinal, name, label): the text over a header for every column whose name stands in a label row.
    `cells` is (ordinal, header, value) of the rows above the header; duplicates are kept."""
    return names.join(cells.select(F.col("value").alias("name"), F.col("header").alias("label")), "name", "left").select("ordinal", "name", "label")


def typed(questions: DataFrame, text: str) -> DataFrame:
    """Questions with their anchor and a type from the cues of their text."""
    return questions.withColumn("rule_type", question_type(F.coalesce(F.col(text), F.lit("")))).withColumn("rule_branch", branch(F.col("rule_type")))


def match_columns(questions: DataFrame, columns: DataFrame, survey: list[str]) -> DataFrame:
    """(survey..., open_question_number, matched_columns): columns go to the question whose anchor their
    name carries, or, if no question has it, to that of its main number (Q7_2 to question 7); a column
    without an anchor goes where the last column before it that has one goes."""
    w = Window.partitionBy(*survey).orderBy("ordinal").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    anchored = columns.withColumn("_anchor", F.last(anchor(F.col("name")), ignorenulls=True).over(w))
    keyed = questions.select(*survey, "open_question_number", anchor(F.col("open_question_number")).alias("_anchor"))
    known = keyed.select(*survey, "_anchor").where("_anchor is not null").distinct().withColumn("_known", F.lit(True))
    anchored = anchored.join(known, [*survey, "_anchor"], "left").withColumn("_anchor", F.when(F.col("_known"), F.col("_anchor")).otherwise(F.regexp_extract("_anchor", r"^\d+", 0))).drop("_known")
    found = keyed.join(anchored, [*survey, "_anchor"], "left")
    lists = F.transform(F.array_sort(F.collect_list(F.when(F.col("name").isNotNull(), F.struct("ordinal", "name")))), lambda x: x["name"])
    return found.groupBy(*survey, "open_question_number").agg(lists.alias("matched_columns"))


def choices(questions: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys..., choice, explanation): the circled choices that a question text lists, ranges such as ①~③ spread out; of a
    number that stands twice, the last. Null texts and texts without such signs give none."""
    marks = r"([①-⑳])\s*(?:[~～-]\s*([①-⑳]))?\s*([^①-⑳~～]*)"
    code = lambda c: F.ascii(c) - 9311
    groups = F.arrays_zip(*[F.regexp_extract_all(F.col(text), F.lit(marks), F.lit(i)).alias(n) for i, n in ((1, "first"), (2, "last"), (3, "text"))])
    found = questions.where(F.col(text).isNotNull()).select(*keys, F.posexplode(groups).alias("_at", "m"))
    first = code(F.col("m.first"))
    last = F.when(F.col("m.last") == "", first).otherwise(F.greatest(first, code(F.col("m.last"))))
    spread = found.select(*keys, "_at", strip(F.col("m.text")).alias("explanation"), F.explode(F.sequence(first, last)).alias("choice"))
    return spread.groupBy(*keys, F.col("choice").cast("string").alias("choice")).agg(F.max_by("explanation", "_at").alias("explanation"))


def context(answers: DataFrame, questions: DataFrame, keys: list[str], depend: str) -> DataFrame:
    """Every answer with what its question says about it: question_text, question_type, related_text and explanation, the
    text of the choice named by its `depend` value where its type depends on one, else null.

    `questions` has one row per `keys` (survey, number) with question_text, question_type and question_that_is_related. A choice
    listed by the related question explains as well as one listed by the question itself. Joins are on the keys of the questions, which are few
    beside the answers; answers of unknown questions keep nulls."""
    survey, number = keys
    linked = related(questions.select(*keys, "question_text", "question_type", "question_that_is_related"), survey, number, "question_that_is_related", "question_text")
    own = choices(questions, keys, "question_text")
    theirs = own.withColumnRenamed(number, "question_that_is_related").withColumnRenamed("explanation", "_other")
    depends = strip(F.col("question_type")).isin("depend", "depend_pos_neg")
    wanted = answers.join(linked, keys, "left").withColumn("choice", F.when(depends, number_text(F.col(depend))))
    known = wanted.join(own, [*keys, "choice"], "left").join(theirs, [survey, "question_that_is_related", "choice"], "left")
    return known.withColumn("explanation", F.coalesce("explanation", "_other")).drop("_other", "choice", "question_that_is_related")


#: Words that refer to the question before.
_BEFORE = r"앞선|앞 문항|위 문항|윗 문항|바로 앞|방금|이전 문항|고르신|선택하신|답하신|ticked|that answer|your previous|diese Antwort|esa respuesta|その理由|上一题"
_NUMBER = r"(?:SQ|DQ|Q|문|B)\s?\d+(?:-\d+)?"


def parse_questionnaire(lines: DataFrame, text: str = "value", order: str | None = None) -> DataFrame:
    """(open_question_number, question_text, rule_type, question_that_is_related): the open questions of a questionnaire's lines:
    those that ask for free text or leave a blank to fill in. A question without a number such as Q1., 문4) or SQ2) gets one by
    its place among those without (N1, N2, ...). It is related to the question whose number it names, or, where it only refers to
    the one before, to that. `order` is a column that orders the lines, a questionnaire's, so one window over them is small."""
    w = Window.partitionBy(F.lit(1)).orderBy(order or F.monotonically_increasing_id())
    number = F.regexp_replace(F.regexp_extract(F.col(text), rf"^\s*({_NUMBER})\s*[.):]", 1), r"\s", "")
    body = strip(F.regexp_replace(F.col(text), rf"^\s*{_NUMBER}\s*[.):]\s*", ""))
    asks = F.col("question_text").rlike(r"_{3,}|자유롭게|구체적으로|적어 주|써 주|말씀해|추가 문항|이유|근거|불만|개선|[Ww]hy|[Ww]hat|[Hh]ow|Was |Warum|Qué|何|なぜ|什么|为什么")
    asking = F.col("question_text").rlike(r"[?？]|_{3,}|주세요|주십시오|바랍니다|please")
    found = lines.select(number.alias("own"), body.alias("question_text"), F.row_number().over(w).alias("_line"))
    found = found.where(asks & ((F.col("own") != "") | asking))
    w = Window.partitionBy(F.lit(1)).orderBy("_line")
    bare = F.sum((F.col("own") == "").cast("int")).over(w)
    numbered = found.withColumn("open_question_number", F.when(F.col("own") == "", F.concat(F.lit("N"), bare.cast("string"))).otherwise(F.col("own")))
    named = F.regexp_replace(F.regexp_extract("question_text", rf"({_NUMBER})(?!\d)", 1), r"\s", "")
    before = F.when(F.col("question_text").rlike(_BEFORE), F.lag("open_question_number").over(w))
    target = F.when((named != "") & (named != F.col("open_question_number")), named).otherwise(before)
    return numbered.select("open_question_number", "question_text", question_type(F.col("question_text")).alias("rule_type"), target.alias("question_that_is_related"))
