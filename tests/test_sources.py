import base64
import zipfile

import pytest
from pyspark.sql import functions as F

from respondo import pipeline, providers
from respondo.context import RunContext
from respondo.operators import columns
from respondo.prompts import DEFAULT, PromptRegistry
from respondo.sources import documents, sinks, tables, workbook

_TYPES = '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"></Types>'


def write_xlsx(path, sheets):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("[Content_Types].xml", _TYPES)
        names = "".join(f'<sheet name="{n}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, n in enumerate(sheets))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{workbook._NS["m"]}" xmlns:r="{workbook._NS["r"]}"><sheets>{names}</sheets></workbook>')
        rels = "".join(f'<Relationship Id="rId{i + 1}" Target="worksheets/sheet{i + 1}.xml"/>' for i in range(len(sheets)))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rels}</Relationships>')
        for i, rows in enumerate(sheets.values()):
            body = ""
            for r, row in enumerate(rows):
                cells = "".join(f'<c r="{chr(65 + c)}{r + 1}" t="inlineStr"><is><t>{v}</t></is></c>' for c, v in enumerate(row) if v is not None)
                body += f'<row r="{r + 1}">{cells}</row>'
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml", f'<worksheet xmlns="{workbook._NS["m"]}"><sheetData>{body}</sheetData></worksheet>')


def write_docx(path, paragraphs):
    body = "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in paragraphs)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{documents._W[1:-1]}"><w:body>{body}<w:tbl><w:p><w:r><w:t>cell</w:t></w:r></w:p></w:tbl></w:body></w:document>')


def test_documents(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("﻿문1) 이유는?".encode())
    (tmp_path / "b.PDF").write_bytes(b"%PDF-1.4")
    write_docx(tmp_path / "c.docx", ["one", "two"])
    row = documents.read_survey(spark, str(tmp_path / "a.txt")).collect()[0]
    assert (row.type, row.text, row.meta.size_bytes) == ("txt", "문1) 이유는?", len("﻿문1) 이유는?".encode()))
    assert base64.b64decode(documents.read_survey(spark, str(tmp_path / "b.PDF")).collect()[0].text) == b"%PDF-1.4"
    assert documents.read_survey(spark, str(tmp_path / "c.docx")).collect()[0].text == "one\ntwo"
    with pytest.raises(providers.UnsupportedFileError):
        documents.read_survey(spark, str(tmp_path / "d.hwp"))


def test_workbook_takes_the_last_header_with_a_key(spark, tmp_path):
    path = str(tmp_path / "r.xlsx")
    write_xlsx(path, {"notes": [["x", "y"]], "data": [["Why?", None, None], ["A label", "ID", "Q1"], ["no", "IDKEY", "Q2"], ["a", "1", "good"], ["NA", "2", None], [None, None, None], ["z", None, "lost"]]})
    found = workbook.read_responses(spark, path)
    assert (found.sheet_name, found.skiprows, found.index_col) == ("data", 2, "IDKEY")
    rows = {r.respondent_key: (r["no"], r["Q2"]) for r in found.table.collect()}
    assert rows == {"1": ("a", "good"), "2": (None, None)}


def test_workbook_without_key_is_an_error(spark, tmp_path):
    path = str(tmp_path / "n.xlsx")
    write_xlsx(path, {"s": [["x"], ["y"]]})
    with pytest.raises(ValueError):
        workbook.read_responses(spark, path)


def test_profiles(spark):
    df = spark.createDataFrame([("1", "a", None), ("(2)", "b", None), (None, "3", None)], "n string, s string, e string")
    rows = {r.name: r for r in columns.profile(df).collect()}
    assert rows["n"].n_numbers == 2 and rows["n"].null_ratio == 0.333333
    assert [r.name for r in columns.open_columns(columns.profile(df)).collect()] == ["s"]
    assert [r.name for r in columns.text_columns(columns.profile(df), 0.6).collect()] == ["s"]
    assert columns.open_columns(columns.profile(df.limit(0))).count() == 0
    assert {r.name: r.neighbour for r in columns.left_neighbours(columns.profile(df.select("n", "e", "s"))).collect()} == {"n": None, "e": "n", "s": "n"}


def test_ordinals_follow_the_order(spark):
    df = spark.createDataFrame([(i * 7 % 50, i) for i in range(50)], "o int, v int")
    assert {r.o: r.id for r in columns.ordinals(df, ["o"]).collect()} == {i: i for i in range(50)}


def test_names():
    assert columns.flat_names([("a", "nan"), ("b", " c ")]) == ["a", "b_c"]
    assert columns.clean_names([" Unnamed: 0", "x "]) == ["0", "x"]
    assert columns.key_column(["x", "idkey", "uid"]) == "idkey" and columns.key_column(["x"]) is None


def test_sinks_and_states(spark, tmp_path):
    df = spark.createDataFrame([("q1", "a", [1.0, 2.0]), ("q2", "b", [])], "qid string, text_1 string, embed_text_1 array<double>")
    sinks.write_results(df, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    sinks.write_csv(df.withColumnRenamed("qid", "question_id"), str(tmp_path / "csv"))
    long = {(r.qid, r.text): r.emb for r in tables.read_stage_results(spark, str(tmp_path / "csv")).collect()}
    assert long == {("q1", "a"): [1.0, 2.0], ("q2", "b"): []}
    sinks.save_state(df, str(tmp_path / "state"))
    assert tables.read_state(spark, str(tmp_path / "state")).count() == 2
    assert tables.read_state(spark, str(tmp_path / "none")) is None
    sinks.append_history(df, str(tmp_path / "history"), "stage1")
    sinks.append_history(df, str(tmp_path / "history"), "stage2")
    assert spark.read.parquet(str(tmp_path / "history")).count() == 4
    assert tables.listing(spark, str(tmp_path / "history"), "*.parquet").count() >= 2


def test_providers_keep_failed_rows_and_ask_once(spark):
    class Failing:
        model = "m"

        def complete(self, system, user):
            if user == "b":
                raise providers.CreditError("none left")
            return user.upper()

    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "p string")
    rows = sorted(((r.p, r.completion and r.completion.content, r.completion and r.completion.error) for r in providers.complete(df, "p", Failing()).collect()), key=str)
    assert rows == [("a", "A", None), ("a", "A", None), ("b", None, "credit"), (None, None, None)]
    recorded = spark.createDataFrame([("a", "yes")], "p string, content string").select(F.sha2("p", 256).alias("digest"), "content")
    assert {r.p: r.content for r in providers.replay(df.distinct(), "p", recorded).collect()} == {"a": "yes", "b": None, None: None}


def test_rules():
    assert providers.corrected("nan  good!!Really") == "good! Really"
    assert providers.choices("무엇을 고르셨나요? ① 맛 ② 값 ③ 기타")["answers"] == {"1": "맛", "2": "값", "3": "기타"}
    assert providers.analysis("품질이 좋습니다. 값은 비쌉니다.")["automic_sentence"] == ["품질이 좋습니다.", "값은 비쌉니다."]
    assert abs(float((providers.hash_vector("abc") ** 2).sum()) - 1) < 1e-5 and not providers.hash_vector(" ").any()


def test_prompts(spark):
    registry = PromptRegistry({"defaults": {"model": "m", "parameters": {"temperature": 0, "n": 1}}, "branches": {"a": {"user": "Hi {x}", "parameters": {"n": 2}}, "b": {"user": "u", "model": "g", "sampling": False}, "c": {}}})
    assert registry.get("a", top=3).parameters == {"temperature": 0, "n": 2, "top": 3}
    assert registry.get("b").parameters == {"n": 1}
    with pytest.raises(KeyError):
        registry.get("nope")
    with pytest.raises(ValueError):
        registry.get("c")
    df = spark.createDataFrame([("you",)], "x string").select(registry.messages("a", x=F.col("x")).alias("m"))
    assert [(m.role, m.content) for m in df.collect()[0].m] == [("system", ""), ("user", "Hi you")]
    assert DEFAULT.get("sentence").names() == ["question", "text"]


def test_context(spark, tmp_path):
    from datetime import datetime

    run = RunContext("p", str(tmp_path))
    run.create()
    run.add_stage("one", "completed", datetime.now(), 2, 0.5, 10)
    run.add_stage("two", "failed", datetime.now(), 1, 0.25, 5)
    row = run.report(spark).collect()[0]
    assert (row.n_stages, row.calls, row.cost_usd, row.tokens, row.failed) == (2, 3, 0.75, 15, 1)


def test_whole_run(spark, tmp_path):
    (tmp_path / "s.txt").write_text("Q1. 떠올릴 때 생각나는 것을 적어 주십시오. ____\nQ2. 방금 고르신 이유를 구체적으로 적어 주세요. ____\n안내문\n", encoding="utf-8")
    words = ["가격", "품질", "디자인", "배송", "포장", "가격표"]
    rows = [["IDKEY", "Q1_1", "Q2_1", "AGE"]] + [[str(i), words[i % 6], f"품질이 {words[i % 6]} 때문에 좋습니다. 값은 비쌉니다.", str(20 + i)] for i in range(12)]
    write_xlsx(str(tmp_path / "r.xlsx"), {"data": rows})
    found = pipeline.run(spark, str(tmp_path / "s.txt"), str(tmp_path / "r.xlsx"), size=64)
    assert {(r.open_question_number, r.branch, r.rows_count, r.status) for r in found.status.collect()} == {("Q1", "WORD", 12, "completed"), ("Q2", "SENTENCE", 12, "completed")}
    first = found.results.orderBy("respondent_key").collect()[0]
    assert first.sentence_1.startswith("품질이") and first.sentence_3 is None and first.error is None
    assert found.vectors.count() == 36 and found.usage.count() == 24
    assert found.clusters.select("grp").distinct().count() == 2


def test_stream_equals_batch(spark, data, tmp_path):
    from respondo.streaming import usage

    calls = spark.read.parquet(f"{data}/usage_log.parquet").where("called_at is not null")
    calls.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = usage.windowed(usage.read_calls(spark, str(tmp_path / "in"), calls.schema), late="4000 days")
    query = stream.writeStream.outputMode("complete").format("memory").queryName("hours").start()
    query.processAllAvailable()
    query.stop()
    got = {(r.start, r.model_name): (r.calls, r.tokens) for r in spark.table("hours").collect()}
    assert got == {(r.start, r.model_name): (r.calls, r.tokens) for r in usage.windowed(calls).collect()}


def test_questionnaires_number_and_relate_questions(spark):
    from respondo.operators.questions import parse_questionnaire

    lines = ["Q1. 왜 그렇게 생각하십니까? 구체적으로 적어 주세요.", "안내문입니다.", "방금 답하신 이유는 무엇입니까?", "Q3) What did Q1 make you think of? ____", "Q4. 몇 번 가셨습니까?", "추가 문항: 개선할 점을 적어 주세요."]
    df = spark.createDataFrame(list(enumerate(lines)), "line int, value string")
    found = {r.open_question_number: (r.rule_type, r.question_that_is_related) for r in parse_questionnaire(df, order="line").collect()}
    assert found == {"Q1": ("concept", None), "N1": ("depend", "Q1"), "Q3": ("concept", "Q1"), "N2": ("concept", None)}


def test_answers_are_analysed_by_type(spark):
    from respondo import pipeline
    from respondo.operators.questions import context

    questions = spark.createDataFrame(
        [("s", "Q1", "고르세요 ① 좋은 맛 ②~③ 비싸요", "etc", None), ("s", "Q2", "방금 고르신 이유는?", "depend", "Q1"), ("s", "Q3", "떠오르는 것은?", "img", None)],
        "survey string, number string, question_text string, question_type string, question_that_is_related string",
    )
    answers = spark.createDataFrame([(1, "s", "Q2", "1.0", "그냥요"), (2, "s", "Q2", "3", "그냥요"), (3, "s", "Q2", "9", "그냥요"), (4, "s", "Q3", "1", "맛"), (5, "s", "Q9", None, "none"), (6, "s", "Q2", "1", None)], "id int, survey string, number string, depend string, text string")
    known = context(answers, questions, ["survey", "number"], "depend")
    assert {r.id: r.explanation for r in known.collect()} == {1: "좋은 맛", 2: "비싸요", 3: None, 4: None, 5: None, 6: "좋은 맛"}
    results, calls = pipeline.analyse(known)
    rows = {r.id: r for r in results.collect()}
    assert [rows[i].analysis.pos_neg for i in (1, 2, 3)] == ["POSITIVE", "NEGATIVE", "NEUTRAL"]
    assert rows[4].error == "unsupported_type" and rows[1].error is None and len(rows) == 6
    assert rows[1].analysis.matching_question and not rows[5].analysis.matching_question
    assert calls.count() > 0


def test_history_of_several_runs(spark, tmp_path):
    from datetime import datetime

    from respondo.context import RunContext

    for name, status in (("one", "completed"), ("two", "failed")):
        run = RunContext("p", str(tmp_path), pipeline=name)
        run.add_stage("load", "completed", datetime.now(), 1, 0.25)
        run.add_stage("analyse", status, datetime.now(), 2, 0.5)
        run.save_history(spark)
    assert {r.pipeline: (r.n_stages, r.cost_usd, r.failed) for r in RunContext.registry(spark, str(tmp_path), "p").collect()} == {"one": (2, 0.75, 0), "two": (2, 0.75, 1)}
